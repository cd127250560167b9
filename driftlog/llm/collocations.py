"""Phrases of a corpus by Toivonen's sampling: propose from a sample, count everything, repeat until closed.

A sample of the documents proposes phrases (those over a lowered threshold).  One
pass over all documents counts the proposed phrases and their negative border
exactly: every word, and every longer phrase whose first and last part (one word
shorter) are both proposed.  When no counted frequent phrase is missing from the
proposals, none is uncounted: the shortest uncounted frequent phrase would have
two frequent parts, both counted, so both proposed, so it would be counted.  If a
phrase of the border is frequent all the same, the sample had missed it: it joins
the proposals, and an expansion pass counts all that this may add, length by
length: phrases whose parts are each proposed or new in this pass.  That closes
the proposals, by the same argument.

The corpus is written once as blocks of word numbers.  A pass sends the distinct
phrases of each block, as sorted hashes with counts, through levels of hash
ranges: each level merges the arrays of many blocks and splits them into finer
ranges, so that a row stays large and a group bounded however many blocks there
are; a phrase in a third of all documents is one entry of each block.

The proposals reach the tasks as a Bloom filter of bounded size
(``FILTER_BYTES``).  A false hit only makes a few more phrases be counted, never
fewer, so results are exact for any filter.  Phrases are compared by 64-bit
hashes; the texts of the frequent ones are read back from the blocks.
"""

from __future__ import annotations

import pickle
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from driftlog.llm.blocks import BUCKET_KEYS, WordHashes, mixed, pack, task_count, unpack, write_blocks
from driftlog.llm.common import new_folder, read_file, staged, table, write_file

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
#: One document in ``SAMPLE`` proposes; a phrase needs ``LOWERED`` of the share of the threshold that falls on the sample.
SAMPLE = 10
LOWERED = 0.4
BLOCK_BYTES = 8 << 20
#: Most bytes of one filter, its parts, bits for a proposal, and places of a proposal.
FILTER_BYTES = 64 << 20
SEGMENTS = 64
FILTER_BITS = 16
#: A level of the exchange splits a range into 2 ** FAN finer ones and merges about so many keys in a task.
FAN = 8
LEVEL_KEYS = 4_000_000

_BREAK, _END = b"\xff", b"\xfe"  # not bytes of any UTF-8 text
# The characters that end a piece.
_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + _PIECE_ENDS + b"\t", b"abcdefghijklmnopqrstuvwxyz" + _BREAK * len(_PIECE_ENDS) + b" ")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_PROBES = tuple(np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))
_HASHES = WordHashes()


# --- blocks ----------------------------------------------------------------------


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _encode(ids: list, texts: list[bytes], rest: list) -> tuple[bytes, int]:
    """A block: a short head (words per language), then word numbers, vocabulary, languages and sample marks."""
    langs, numbers = _Numbers(), _Numbers({_BREAK: 0, _END: 1})
    lang_of = np.array([langs[r[0]] for r in rest], np.int32)
    tokens = (b" " + _END + b" ").join(t.translate(_TABLE).replace(_BREAK, b" " + _BREAK + b" ") for t in texts).split()
    at = np.fromiter(map(numbers.__getitem__, tokens), np.uint32, len(tokens))
    words = np.bincount(lang_of[np.cumsum(at == 1)[at > 1]], minlength=len(langs))
    head = pickle.dumps([(lang, int(n)) for lang, n in zip(langs, words)])
    body = pickle.dumps((b"\n".join(list(numbers)[2:]), pack(at, lang_of, np.array([bool(r[1]) for r in rest])), list(langs)), protocol=5)
    return len(head).to_bytes(8, "little") + head + zlib.compress(body, 1), int(words.sum())


class _Block:
    """Word numbers of a block and the hashes of its phrases."""

    def __init__(self, data: bytes) -> None:
        size = int.from_bytes(data[:8], "little")
        vocabulary, arrays, self.langs = pickle.loads(zlib.decompress(data[8 + size:]))
        self.at, lang_of, sampled = unpack(arrays)
        self.words = vocabulary.split(b"\n") if vocabulary else []
        self.doc = np.cumsum(self.at == 1)
        self.lang, self.sampled, self.is_word = lang_of, sampled, self.at > 1
        self.h = np.concatenate([np.zeros(2, np.uint64), _HASHES.of(self.words)])[self.at]

    def phrases(self, longest: int, known, inside: np.ndarray | None = None, counted: dict[int, np.ndarray] | None = None):
        """For each length: places and keys of the phrases whose two parts are ``known(keys)``; all words.

        With ``counted`` (places by length), a part that does not stand there will do, too.
        """
        seeds = np.array([xxh64_intdigest(x.encode(), 7) for x in self.langs] or [0], np.uint64)
        place = np.flatnonzero(self.is_word if inside is None else self.is_word & inside)
        key = mixed(self.h[place] ^ seeds[self.lang[self.doc[place]]]) if len(place) else np.zeros(0, np.uint64)
        yield 1, place, key
        for k in range(2, longest + 1):
            hit = known(key)
            if counted is not None:
                hit |= ~np.isin(place, counted[k - 1], assume_unique=True)
            place, key = place[hit], key[hit]
            goes_on = np.flatnonzero(np.diff(place) == 1)  # the last part begins one word later and is known, too
            place = place[goes_on]
            with np.errstate(over="ignore"):
                key = mixed(key[goes_on] * _FACTOR + self.h[place + k - 1])
            yield k, place, key

    def text(self, place: int, k: int) -> str:
        return b" ".join(self.words[x - 2] for x in self.at[place:place + k].tolist()).decode()


def _everything(keys: np.ndarray) -> np.ndarray:
    return np.ones(len(keys), bool)


# --- bounded filters of the proposals ----------------------------------------------


class _Filter:
    _held: dict[str, "_Filter"] = {}

    def __init__(self, folder: str, bits: int) -> None:
        self.bits, self.table = bits, np.zeros((SEGMENTS, 1 << bits - 3), np.uint8)
        for k in range(SEGMENTS):
            self.table[k] = np.frombuffer(read_file(f"{folder}/{k:02d}"), np.uint8)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        segment, found = keys >> np.uint64(58), np.ones(len(keys), bool)
        for where, bit in _spots(keys, self.bits):
            found &= (self.table[segment, where] >> bit) & 1 == 1
        return found

    @classmethod
    def of(cls, given: tuple[str, int]) -> "_Filter":
        """One copy per Python worker; those of an earlier run go."""
        if given[0] not in cls._held:
            if len(cls._held) > 8:
                cls._held.clear()
            cls._held[given[0]] = cls(*given)
        return cls._held[given[0]]


def _spots(keys: np.ndarray, bits: int):
    with np.errstate(over="ignore"):
        for odd in _PROBES:
            at = (keys * odd) >> np.uint64(64 - bits)
            yield at >> np.uint64(3), (at & np.uint64(7)).astype(np.uint8)


def _known(filters: list[tuple[str, int]]):
    """Is a key in any of the filters?"""
    held = [_Filter.of(f) for f in filters]

    def known(keys: np.ndarray) -> np.ndarray:
        found = np.zeros(len(keys), bool)
        for f in held:
            found |= f(keys)
        return found

    return known


def _write_filter(missing: DataFrame, folder: str, most_bytes: int) -> tuple[str, int] | None:
    """A filter of the keys in rows ``segment, salt, n, payload``; None if there are none."""
    n = missing.agg(F.sum("n")).first()[0] or 0
    if not n:
        return None
    most = (most_bytes * 8 // SEGMENTS).bit_length() - 1
    bits = min(max(6, (FILTER_BITS * n // SEGMENTS).bit_length()), most)
    parts = max(1, n // SEGMENTS // LEVEL_KEYS)

    def mark(frame):
        import pandas as pd
        out = np.zeros(1 << bits - 3, np.uint8)
        for payload in frame["payload"]:
            for where, bit in _spots(unpack(payload)[0], bits):
                np.bitwise_or.at(out, where, np.uint8(1) << bit)
        return pd.DataFrame({"segment": [int(frame["segment"].iloc[0])], "bitmap": [out.tobytes()]})

    def merge(frame):
        import pandas as pd
        segment = int(frame["segment"].iloc[0])
        out = np.zeros(1 << bits - 3, np.uint8)
        for bitmap in frame["bitmap"].dropna():
            out |= np.frombuffer(bitmap, np.uint8)
        write_file(f"{folder}/{segment:02d}", out.tobytes())
        return pd.DataFrame({"segment": [segment]})

    marks = missing.withColumn("part", F.pmod("salt", F.lit(parts))).groupBy("segment", "part").applyInPandas(mark, "segment int, bitmap binary")
    empty = missing.sparkSession.range(SEGMENTS).select(F.col("id").cast("int").alias("segment"), F.lit(None).cast("binary").alias("bitmap"))
    staged(marks.unionByName(empty).groupBy("segment").applyInPandas(merge, "segment int"), "filter-parts")
    return folder, bits


# --- counting through levels of hash ranges ------------------------------------------

_SENT = "bucket long, salt long, payload binary"


def _split(keys: np.ndarray, bits: int, *arrays: np.ndarray):
    """``(range, its arrays packed)`` of ascending keys, over ranges of the first ``bits`` bits."""
    ranges = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    found, begin = np.unique(ranges, return_index=True)
    for bucket, a, b in zip(found.tolist(), begin, np.append(begin[1:], len(keys))):
        yield bucket, pack(keys[a:b], *(x[a:b] for x in arrays))


def _merged(payloads):
    """Keys, summed counts, lengths and least blocks of many packed arrays."""
    keys, counts, lengths, source = (np.concatenate(x) for x in zip(*map(unpack, payloads)))
    order = np.argsort(keys, kind="stable")
    keys, counts, lengths, source = keys[order], counts[order], lengths[order], source[order]
    begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[begin], np.add.reduceat(counts, begin), lengths[begin], np.minimum.reduceat(source, begin)


def _splitter(bits: int):
    def split(frame):
        import pandas as pd
        got = _merged(frame["payload"])
        rows = list(_split(got[0], bits, *got[1:]))
        return pd.DataFrame({"bucket": [r[0] for r in rows], "salt": int(frame["salt"].iloc[0]), "payload": [r[1] for r in rows]})

    return split


def _levels(sent: DataFrame, keys: int, bits: int, fan: int) -> DataFrame:
    """Rows ``bucket, salt, payload`` brought from ``fan`` bits of the keys to ``bits``, level by level."""
    done = min(fan, bits)
    while done < bits:
        finer = min(done + fan, bits)
        salts = max(1, keys // (LEVEL_KEYS << done))

        dealt = sent.withColumn("salt", F.pmod("salt", F.lit(salts)))
        sent, done = dealt.groupBy("bucket", "salt").applyInPandas(_splitter(finer), _SENT), finer
    return sent


def _number(block: str) -> int:
    part, k = block.split("-")
    return int(part) * 10**6 + int(k)


def _name(number: int) -> str:
    return f"{number // 10**6:06d}-{number % 10**6:06d}"


def _count(blocks: DataFrame, folder: str, listed, minimum: int, keys: int, bits: int, fan: int, wanted, name: str) -> DataFrame:
    """Phrases that occur ``minimum`` times among those that ``listed(block)`` gives.

    Staged rows: ``block, payload`` (keys and counts that this block is to spell
    out) and ``segment, salt, n, payload`` (keys for which ``wanted(keys, lengths)``).
    """
    first, spell = min(fan, bits), name != "proposed"

    def send(batches):
        import pyarrow as pa
        for batch in batches:
            for block in batch.column(0).to_pylist():
                found = [(k, *np.unique(key, return_counts=True)) for k, key in listed(_Block(read_file(f"{folder}/{block}")))]
                key = np.concatenate([x[1] for x in found])
                order = np.argsort(key, kind="stable")
                n = np.concatenate([x[2] for x in found])[order]
                length = np.concatenate([np.full(len(x[1]), x[0], np.uint8) for x in found])[order]
                number = _number(block)
                for bucket, payload in _split(key[order], first, n, length, np.full(len(key), number)):
                    yield pa.RecordBatch.from_pydict({"bucket": [bucket], "salt": [number], "payload": [payload]})

    def finish(frame):
        import pandas as pd
        key, n, length, source = _merged(frame["payload"])
        often = n >= minimum
        key, n, length, source = key[often], n[often], length[often], source[often]
        rows = []
        if spell:
            for block in np.unique(source).tolist():
                mine = source == block
                rows.append((_name(block), -1, 0, int(mine.sum()), pack(key[mine], n[mine])))
        want = wanted(key, length)
        for segment, payload in _split(key[want], 6):
            rows.append((None, segment, int(frame["bucket"].iloc[0]), len(unpack(payload)[0]), payload))
        return pd.DataFrame(rows, columns=["block", "segment", "salt", "n", "payload"])

    sent = blocks.select("block").repartition(task_count(blocks)).mapInArrow(send, _SENT)
    merged = _levels(sent, keys, bits, fan).groupBy("bucket")
    return staged(merged.applyInPandas(finish, "block string, segment int, salt long, n long, payload binary"), name)


# --- the miner -------------------------------------------------------------------------


def _prepared(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample: int) -> DataFrame:
    text, lang = F.col(text_col).cast("string"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    marked = F.pmod(F.xxhash64(F.col(id_col).cast("string"), lang, text), F.lit(sample)) == 0
    return docs.select(F.lit(0).cast("long").alias("__id"), text.alias("__text"), lang.alias("__lang"), marked.alias("__sampled"))


def frequent_phrases(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
                     max_words: int = MAX_WORDS, sample: int = SAMPLE, lowered: float = LOWERED, block_bytes: int = BLOCK_BYTES,
                     filter_bytes: int = FILTER_BYTES, bucket_keys: int = BUCKET_KEYS, fan: int = FAN,
                     passes: list | None = None) -> tuple[DataFrame, DataFrame]:
    """``(lang, k, phrase, a)`` of every phrase of up to ``max_words`` words with ``a >= min_count``, and ``(lang, n)``.

    Words and pieces as in ``collocations``.  ``passes``, if given, gets the number
    of phrases that the sample had missed, then, if there are any, of the frequent
    phrases that the expansion pass added.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "phrases")
    blocks = write_blocks(_prepared(docs, id_col, text_col, lang_col, sample), folder, _encode, "__id", "__text",
                          block_bytes=block_bytes, carry=("__lang", "__sampled"))
    words = blocks.agg(F.coalesce(F.sum("n_keys"), F.lit(0))).first()[0]
    schema = "lang string, k int, phrase string, a bigint"
    if not words:
        return spark.createDataFrame([], schema), spark.createDataFrame([], "lang string, n bigint")
    bits = max(0, (-(-words // bucket_keys) - 1).bit_length())
    fewest = max(1, int(min_count * lowered / sample))

    def in_sample(block):
        inside = block.sampled[block.doc] if len(block.doc) else block.is_word
        for k, _, key in block.phrases(max_words - 1, _everything, inside):
            yield k, key

    proposed = _count(blocks, folder, in_sample, fewest, words, bits, fan, lambda key, k: np.ones(len(key), bool), "proposed")
    first = _write_filter(proposed, f"{folder}/filter-0", filter_bytes)
    filters = [first] if first else []
    border = list(filters)

    def missed(key, k):
        return (k < max_words) & ~_known(border)(key)

    def in_border(block):
        for k, _, key in block.phrases(max_words, _known(border)):
            yield k, key

    counted = _count(blocks, folder, in_border, min_count, words, bits, fan, missed, "counted")
    asked = counted.where("block IS NOT NULL").select("block", "payload")
    more = _write_filter(counted.where("block IS NULL"), f"{folder}/filter-1", filter_bytes)

    def found_in(block):
        """Everything that is counted, and what of it the first pass counted."""
        if not more:
            return block.phrases(max_words, _known(border)), {}
        old = {k: place for k, place, _ in block.phrases(max_words, _known(border))}
        return block.phrases(max_words, _known(filters), counted=old), old

    if more:
        filters.append(more)

        def expansion(block):
            everything, old = found_in(block)
            for k, place, key in everything:
                yield k, key[~np.isin(place, old[k], assume_unique=True)]

        added = _count(blocks, folder, expansion, min_count, words, bits, fan, lambda key, k: np.zeros(len(key), bool), "expanded")
        asked = asked.unionByName(added.select("block", "payload"))
    if passes is not None:
        passes += [x.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] for x in [counted.where("block IS NULL")] + ([added] if more else [])]

    def spell(frame):
        import pandas as pd
        block = _Block(read_file(f"{folder}/{frame['block'].iloc[0]}"))
        keys, counts = (np.concatenate(x) for x in zip(*map(unpack, frame["payload"])))
        order = np.argsort(keys)
        keys, counts, rows = keys[order], counts[order], []
        for k, place, key in found_in(block)[0]:
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = np.flatnonzero(keys[at] == key)
            for j, first_hit in zip(*np.unique(at[hit], return_index=True)):
                p = int(place[hit[first_hit]])
                rows.append((block.langs[block.lang[block.doc[p]]], k, block.text(p, k), int(counts[j])))
        return pd.DataFrame(rows, columns=["lang", "k", "phrase", "a"])

    phrases = staged(asked.repartition(task_count(blocks), "block").groupBy("block").applyInPandas(spell, schema), "frequent")

    def heads(batches):
        import pyarrow as pa
        for batch in batches:
            for block in batch.column(0).to_pylist():
                path = f"{folder}/{block}"
                rows = pickle.loads(read_file(path, 8, int.from_bytes(read_file(path, 0, 8), "little")))
                yield pa.RecordBatch.from_pydict({"lang": [r[0] for r in rows], "n": [r[1] for r in rows]})

    totals = blocks.select("block").mapInArrow(heads, "lang string, n bigint").groupBy("lang").agg(F.sum("n").alias("n"))
    return phrases, staged(totals, "word-totals")


def _joined(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
                 top: int | None = None, **options) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's phrases, the first ``top`` or all.

    A text is lower-cased (A-Z), cut into pieces at ``. , ; : ! ?`` and U+000A to
    U+000D, and these into words at spaces and tabs.  ``a`` counts a phrase's
    occurrences within pieces, ``n`` all words of the language (null: ``und``).
    ``score`` is the least ``floor(1000 * a * n / (l * r))`` over all cuts into two
    parts that occur ``l`` and ``r`` times, ties to the earliest cut; sums and
    products are exact (38 digits).  A phrase goes if a longer one holds it and
    occurs as often.  Null and empty texts give no words; repeated rows count each;
    a word or phrase of any length is one; extra columns are ignored; an empty
    table gives no rows.
    """
    found, totals = frequent_phrases(docs, id_col, text_col, lang_col, min_count, **options)
    words = F.split("phrase", " ")
    cand = found.where("k >= 2")
    # a longer phrase that occurs as often has a part, one word longer than this one, that does, too
    inner = found.where("k >= 3").select("lang", "a", F.explode(F.array(_joined(words, 1, F.col("k") - 1), _joined(words, 2, F.col("k") - 1))).alias("phrase"))
    cand = cand.join(inner.distinct(), ["lang", "phrase", "a"], "left_anti")
    cuts = cand.select("lang", "phrase", "a", "k", words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "lang", "phrase", "a", "cut", _joined(F.col("w"), 1, F.col("cut")).alias("first"),
        _joined(F.col("w"), F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"))
    left = found.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = found.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    whole = "decimal(19,0)"
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang").withColumn(
        "score", F.expr(f"(cast(a AS {whole}) * cast(n AS {whole}) * 1000BD) div (cast(l AS {whole}) * cast(r AS {whole}))"))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("x")).select("lang", "phrase", "x.*")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    if top is not None:  # first within parts of a language, so that no task sorts all of a large one
        best = best.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    ranked = ranked if top is None else ranked.where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_phrase_collocations(spark, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of each language of ``documents``."""
    return collocations(table(spark, sf_dir, "documents"), top=TOP)


ORACLE_OP11 = rf"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
     p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS s FROM d),
     w AS (SELECT lang, list_filter(regexp_split_to_array(s, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
     g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
           FROM w, range(1, {MAX_WORDS + 1}) t(k) WHERE len(ws) >= k),
     f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
     n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
     c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2 AND a >= {MIN_COUNT}),
     kept AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM c q WHERE q.lang = c.lang AND q.k > c.k AND 100 * q.a >= 100 * c.a
                                                AND contains(' ' || q.phrase || ' ', ' ' || c.phrase || ' '))),
     cut AS (SELECT lang, k, phrase, a, j, array_to_string(ws[1:j], ' ') AS x, array_to_string(ws[j + 1:k], ' ') AS y
             FROM kept, range(1, {MAX_WORDS}) t(j) WHERE j < k),
     s AS (SELECT cut.lang, cut.phrase, cut.a, fl.a AS l, fr.a AS r, n.n,
                  ((1000::HUGEINT * cut.a * n.n) // (fl.a::HUGEINT * fr.a))::BIGINT AS score
           FROM cut JOIN f fl ON fl.lang = cut.lang AND fl.phrase = cut.x JOIN f fr ON fr.lang = cut.lang AND fr.phrase = cut.y
           JOIN n ON n.lang = cut.lang
           QUALIFY row_number() OVER (PARTITION BY cut.lang, cut.phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM s QUALIFY rank <= {TOP}
"""
