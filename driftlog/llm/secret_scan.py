"""Secrets by patterns and by dictionary-primed zstandard novelty.

Patterns find assignments, access ids and long hex strings.  Beyond them, a run
of credential characters near a sensitive word is a candidate, and its novelty is
measured: the bytes that zstandard needs for its surroundings with it, less those
for the surroundings alone.  The compressor is primed with a dictionary of
identifiers, the names that fill most of the corpus, counted over all documents.
A name, a path or anything that repeats what stands around it adds few bytes; a
random string adds nearly all of its own, and is reported.

Both passes read each text once and whole, in Arrow batches; the only shuffle is
that of word counts, and the only thing that the tasks share is the dictionary,
whose size is fixed.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlog.llm.common import staged, table, text_bytes

# The patterns of the base kinds, and the least length of what they must find.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "novel")
#: Words that make their surroundings sensitive, as parts of words, in either case.
SENSITIVE = ("passw", "pwd", "secret", "token", "api_key", "apikey", "credential", "bearer", "private_key", "access_key", "auth")
#: A candidate is a whole run of these characters, at least so many, that begins at most so far from a sensitive word.
RUN = r"[A-Za-z0-9+/_~-]"
LEAST_RUN = 16
NEAR = 64
#: Characters on either side that count as surroundings, and the share of its bytes that a novel run adds at least.
AROUND = 200
NOVELTY = 0.7
#: Bytes of the dictionary, lengths of its identifiers, and zstandard's level.
DICTIONARY_BYTES = 32 << 10
NAME_LENGTHS = (4, 32)
LEVEL = 3
#: Distinct names that a task counts before it hands them on.
COUNTED = 500_000

_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(rf"AKIA[A-Z0-9]{{{LEAST['access'] - 4},}}")
_HEX = re.compile(rf"[0-9a-f]{{{LEAST['hex']},}}")
_SENSITIVE = re.compile("|".join(SENSITIVE), re.IGNORECASE | re.ASCII)
_RUN = re.compile(RUN + f"{{{LEAST_RUN},}}")
_RUN_CHARS = frozenset(filter(re.compile(RUN).match, map(chr, range(128))))
_STEMS = tuple(x.encode() for x in ("api", *(s for s in SENSITIVE if not s.startswith("api"))))
_HEX_MARKS = bytes(1 if c in b"0123456789abcdef" else 0 for c in range(256))
_HEX_RUN = b"\x01" * LEAST["hex"]
_NAME_CHARS = bytes(c if chr(c).isalpha() and c < 128 or c == 95 else 32 for c in range(256))

SPAN = "struct<kind:string,start:bigint,end:bigint,text:string,marginal_bytes:bigint>"


# --- the dictionary of identifiers ---------------------------------------------


def identifier_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``name, n``: how often each identifier (letters and underscores, of ``NAME_LENGTHS``) stands in the texts."""
    low, high = NAME_LENGTHS

    def count(batches):
        import pyarrow as pa
        found: Counter = Counter()

        def rows():
            names = [(w, n) for w, n in found.items() if low <= len(w) <= high]
            return pa.RecordBatch.from_arrays([pa.array([w.decode() for w, _ in names], pa.string()),
                                               pa.array([n for _, n in names], pa.int64())], ["name", "n"])

        for batch in batches:
            for text in text_bytes(batch.column(0)):
                found.update(text.translate(_NAME_CHARS).split())
                if len(found) > COUNTED:
                    yield rows()
                    found.clear()
        yield rows()

    counted = docs.select(F.col(text_col).cast("string")).mapInArrow(count, "name string, n bigint")
    return counted.groupBy("name").agg(F.sum("n").alias("n"))


def identifier_dictionary(docs: DataFrame, text_col: str = "text", size: int = DICTIONARY_BYTES) -> bytes:
    """The identifiers that fill most of the corpus, space-joined, the greatest last (nearest to what is compressed).

    A name fills its length times its count.  The names that can be among the
    greatest are found by a histogram of these by powers of two (64 rows), so only
    they are sorted; at most ``size / NAME_LENGTHS[0]`` come to the driver.
    """
    fills = F.col("n") * F.length("name")
    counts = staged(identifier_counts(docs, text_col).where("n > 1").withColumn("fills", fills), "identifiers")
    steps = counts.groupBy(F.floor(F.log2("fills")).cast("int").alias("step")).agg(F.sum(F.length("name") + 1).alias("b"))
    least, held = 0, 0
    for row in steps.orderBy(F.desc("step")).collect():
        least, held = row.step, held + row.b
        if held > size:
            break
    first = counts.where(F.col("fills") >= (1 << least)).orderBy(F.desc("fills"), "name").limit(size // NAME_LENGTHS[0])
    names, used = [], 0
    for row in first.collect():
        used += len(row.name) + 1
        if used > size:
            break
        names.append(row.name)
    return " ".join(reversed(names)).encode()


class Novelty:
    """Marginal compressed bytes of a string between its surroundings."""

    def __init__(self, dictionary: bytes, level: int = LEVEL) -> None:
        import zstandard
        options = {}
        if len(dictionary) >= 8:  # zstandard ignores anything shorter
            primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            primed.precompute_compress(level=level)
            options["dict_data"] = primed
        self.compress = zstandard.ZstdCompressor(level=level, write_checksum=False, write_content_size=False, **options).compress

    def marginal(self, before: str, candidate: str, after: str) -> int:
        with_it = self.compress((before + candidate + after).encode())
        return len(with_it) - len(self.compress((before + after).encode()))


# --- spans of a text -----------------------------------------------------------


def base_spans(raw: bytes, text: str | None = None) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of the patterns in a text (code points, end exclusive).

    A failing assignment is dropped but still hides what it covers; runs of hex
    digits and of access ids are whole runs, so they can be asked for by length.
    """
    low, spans = raw.lower(), []
    assign, access = any(s in low for s in (b"passw", b"secret", b"token", b"api")), b"AKIA" in raw
    hexes = _HEX_RUN in raw.translate(_HEX_MARKS)
    if not (assign or access or hexes):
        return spans
    text = raw.decode() if text is None else text
    if assign:
        spans += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    if access:
        spans += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    if hexes:
        spans += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return spans


def candidates(text: str):
    """Whole runs of credential characters that begin near a sensitive word, each once, in one sweep."""
    seen = 0
    for word in _SENSITIVE.finditer(text):
        low, high = word.start() - NEAR, word.end() + NEAR
        low = max(low, seen)
        while low > seen and text[low - 1] in _RUN_CHARS:  # inside a run: back to its first character
            low -= 1
        while low < high:
            found = _RUN.search(text, low, high + LEAST_RUN)
            if not found or found.start() >= high:
                break
            start, low = found.start(), _RUN.match(text, found.start()).end()
            if start >= word.start() - NEAR:
                yield start, low
        seen = max(seen, low, high)


def novel_spans(text: str, base: list[tuple[str, int, int]], novelty: Novelty, share: float = NOVELTY) -> list[tuple[str, int, int, int]]:
    """``(novel, start, end, marginal bytes)`` of the incompressible candidates that meet no base span."""
    out, taken, k, reach = [], sorted((a, b) for _, a, b in base), 0, 0
    for start, end in candidates(text):
        while k < len(taken) and taken[k][0] < end:
            reach = max(reach, taken[k][1])
            k += 1
        if reach > start:
            continue
        added = novelty.marginal(text[max(0, start - AROUND):start], text[start:end], text[end:end + AROUND])
        if added >= share * (end - start):
            out.append(("novel", start, end, added))
    return out


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", dictionary: bytes | None = None,
                 share: float = NOVELTY) -> DataFrame:
    """``doc_id, spans`` of every document; a span has ``kind, start, end, text, marginal_bytes`` (null for base kinds).

    Spans are sorted by start, then kind (assign, access, hex, novel).  Null and
    empty texts have none, a text of any length is searched whole; repeated rows
    give a row each, a null id stays null; extra columns are ignored; an empty
    table gives no rows.  ``dictionary`` primes the compressor; by default the
    identifiers of these documents.
    """
    primed = identifier_dictionary(docs, text_col) if dictionary is None else dictionary
    kept = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def scan(batches):
        import pyarrow as pa
        novelty = Novelty(primed)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("text", pa.string()),
                                   ("marginal_bytes", pa.int64())]))
        for batch in batches:
            rows = []
            for raw in text_bytes(batch.column(1)):
                low = raw.lower()
                sensitive = any(s in low for s in _STEMS)
                text = raw.decode() if sensitive else None
                base = base_spans(raw, text)
                found = [(*x, None) for x in base] + (novel_spans(text, base, novelty, share) if sensitive else [])
                if found:
                    text = raw.decode() if text is None else text
                    found.sort(key=lambda x: (x[1], KINDS.index(x[0])))
                rows.append([{"kind": k, "start": a, "end": b, "text": text[a:b], "marginal_bytes": n} for k, a, b, n in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], ["doc_id", "spans"])

    return kept.mapInArrow(scan, f"doc_id {docs.schema[id_col].dataType.simpleString()}, spans array<{SPAN}>")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op12_secret_scan(spark, sf_dir: str) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of every document."""
    found = find_secrets(table(spark, sf_dir, "documents"))
    number = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return found.select("doc_id", *map(number, KINDS[:3]), F.sha2(_listed(base), 256).alias("base_sha256"),
                        _listed(F.col("spans")).alias("spans"))
