"""Token ids as grammar-compressed shard files (Re-Pair).

Documents are ordered by id, encoded, and written as shard files.  In each
shard the frequent pairs of neighbouring symbols are repeatedly replaced by a
new symbol (a rule), never across a document's end.  A file holds the alphabet,
the rules, the expansion length of each symbol and each document's place, so a
document, or a part of one, is decoded without the rest.

File layout, little-endian: the magic, seven unsigned 64-bit numbers (alphabet
size, rules, symbols in the sequence, documents, bytes per symbol, first row
number, 0), the alphabet (4 bytes each), the rules (two symbols of 4 bytes
each), the expansion lengths of the rules (8 bytes each), the documents (id,
whether the id is known, first symbol, ids: 8 bytes each), the sequence.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftlog.llm.common import default_tokenizer, id_encoder, new_folder, read_file, staged, table, write_file

MAGIC = b"RPIDS01\n"
HEAD = struct.Struct("<7Q")
END_ID = 0
#: A shard is closed once it holds this many ids; a longer document is a shard of its own.
SHARD_IDS = 1 << 21
#: Pairs that occur less often are left alone: a rule must save more than it costs.
LEAST_COUNT = 16
#: Text bytes of one range of documents (one task).
RANGE_BYTES = 24 << 20
SMALL_SYMBOLS = 1 << 16
_BUCKET_BITS = 18


def _counts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, ascending, and how often each occurs."""
    ordered = np.sort(keys)
    at = np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1, [len(ordered)]])
    return ordered[at[:-1]], np.diff(at)


def compress(ids: np.ndarray, ends: np.ndarray, least_count: int = LEAST_COUNT):
    """Re-Pair of one shard: ``(alphabet, rules, sequence, document ends in the sequence)``.

    ``ends``: the place after each document's last id.  A round replaces all
    pairs that occur at least ``floor`` times (left to right where they overlap);
    ``floor`` falls by a factor of four from the most frequent pair's count to
    ``least_count``, and rounds go on there while they shorten the sequence by
    one percent.
    """
    alphabet = np.flatnonzero(np.bincount(ids)) if len(ids) else np.zeros(0, np.int64)
    size = len(alphabet)
    wide = size > SMALL_SYMBOLS - 4096
    kind, shift = (np.uint64, 32) if wide else (np.uint32, 16)
    limit = 2 * size if wide else SMALL_SYMBOLS - 1  # the last symbol marks pairs across an end
    mark, odd, high = kind(np.iinfo(kind).max), kind(0x9E3779B97F4A7C15 if wide else 0x9E3779B1), kind(2 * shift - _BUCKET_BITS)
    place = np.zeros(int(alphabet[-1]) + 1 if size else 0, kind)
    place[alphabet] = np.arange(size, dtype=kind)
    seq, cut = place[ids], ends.astype(np.int64)
    rules: list[np.ndarray] = []
    floor = None
    while len(seq) > 1 and size < limit:
        keys = (seq[:-1] << kind(shift)) | seq[1:]
        keys[cut[(cut > 0) & (cut < len(seq))] - 1] = mark
        pairs, counts = _counts(keys)
        if pairs[-1] == mark:
            pairs, counts = pairs[:-1], counts[:-1]
        top = int(counts.max(initial=0))
        if top < least_count:
            break
        last_level = floor == least_count
        floor = max(least_count, top // 4 if floor is None else min(top, floor // 4))
        pick = np.flatnonzero(counts >= floor)
        pick = np.sort(pick[np.argsort(-counts[pick], kind="stable")][:limit - size])
        chosen = pairs[pick]
        # a small table tells most places without such a pair
        held = np.zeros(1 << _BUCKET_BITS, bool)
        held[(chosen * odd) >> high] = True
        maybe = np.flatnonzero(held[(keys * odd) >> high])
        at = np.minimum(np.searchsorted(chosen, keys[maybe]), len(chosen) - 1)
        same = chosen[at] == keys[maybe]
        maybe, at = maybe[same], at[same]
        # of neighbouring matches every other one, from the left
        fresh = np.ones(len(maybe), bool)
        fresh[1:] = np.diff(maybe) != 1
        run = np.maximum.accumulate(np.where(fresh, np.arange(len(maybe)), 0))
        taken = (np.arange(len(maybe)) - run) % 2 == 0
        maybe, at = maybe[taken], at[taken]
        used, at = np.unique(at, return_inverse=True)
        rules.append(np.stack([chosen[used] >> kind(shift), chosen[used] & kind((1 << shift) - 1)], axis=1))
        before = len(seq)
        seq[maybe] = (size + at).astype(kind)
        keep = np.ones(len(seq), bool)
        keep[maybe + 1] = False
        seq = seq[keep]
        cut = cut - np.searchsorted(maybe + 1, cut, "left")
        size += len(used)
        if last_level and 100 * (before - len(seq)) < before:
            break
    found = np.concatenate(rules) if rules else np.zeros((0, 2), kind)
    return alphabet.astype("<u4"), found.astype("<u4"), seq, cut


def pack_shard(doc_ids: list, ids: np.ndarray, ends: np.ndarray, first_row: int = 0) -> bytes:
    """A shard file's bytes."""
    alphabet, rules, seq, seq_ends = compress(ids, ends)
    a = len(alphabet)
    lengths = np.ones(a + len(rules), "<u8")
    for k, (x, y) in enumerate(rules.tolist()):
        lengths[a + k] = lengths[x] + lengths[y]
    width = 2 if a + len(rules) <= SMALL_SYMBOLS else 4
    docs = np.zeros((len(ends), 4), "<i8")
    docs[:, 0] = [x or 0 for x in doc_ids]
    docs[:, 1] = [x is not None for x in doc_ids]
    docs[1:, 2] = seq_ends[:-1]
    docs[:, 3] = np.diff(np.concatenate([[0], ends]))
    return b"".join([MAGIC, HEAD.pack(a, len(rules), len(seq), len(ends), width, first_row, 0), alphabet.tobytes(),
                     rules.tobytes(), lengths[a:].tobytes(), docs.tobytes(), seq.astype(f"<u{width}").tobytes()])


class Shard:
    """A shard file opened for decoding."""

    def __init__(self, data: bytes) -> None:
        if data[:len(MAGIC)] != MAGIC:
            raise ValueError("not a shard of ids")
        a, r, n, d, width, self.first_row, _ = HEAD.unpack_from(data, len(MAGIC))
        at = len(MAGIC) + HEAD.size

        def part(count: int, kind: str) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, count, at)
            at += found.nbytes
            return found

        alphabet = part(a, "<u4")
        self.rules = part(2 * r, "<u4").reshape(r, 2)
        self.lengths = np.concatenate([np.ones(a, np.int64), part(r, "<u8").astype(np.int64)])
        self.docs = part(4 * d, "<i8").reshape(d, 4)
        self.seq = part(n, f"<u{width}")
        # what every symbol stands for, one after the other
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.flat = np.empty(int(self.starts[-1]), "<u4")
        self.flat[:a] = alphabet
        for k, (x, y) in enumerate(self.rules.tolist()):
            to, mid = self.starts[a + k], self.starts[a + k] + self.lengths[x]
            self.flat[to:mid] = self.flat[self.starts[x]:self.starts[x + 1]]
            self.flat[mid:self.starts[a + k + 1]] = self.flat[self.starts[y]:self.starts[y + 1]]

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        lengths = self.lengths[symbols]
        ends = np.cumsum(lengths)
        if not len(ends):
            return np.zeros(0, "<u4")
        shift = np.repeat(self.starts[symbols] - (ends - lengths), lengths)
        return self.flat[shift + np.arange(int(ends[-1]))]

    def _symbols(self, doc: int) -> np.ndarray:
        end = self.docs[doc + 1, 2] if doc + 1 < len(self.docs) else len(self.seq)
        return self.seq[self.docs[doc, 2]:end]

    def ids(self, doc: int, start: int = 0, length: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``start + length`` of a document; only the symbols that hold them are expanded."""
        total = int(self.docs[doc, 3])
        stop = total if length is None else min(total, start + length)
        if stop <= start:
            return np.zeros(0, "<u4")
        symbols = self._symbols(doc)
        ends = np.cumsum(self.lengths[symbols])
        a, b = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, stop, "left")) + 1
        skip = start - (int(ends[a - 1]) if a else 0)
        return self.expand(symbols[a:b])[skip:skip + stop - start]


def write_ids(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
              tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write the shard files in ascending id order; returns their list, in order:
    ``part, shard, file, n_docs, n_ids, n_bytes`` (already written, so files and list agree).
    """
    path = tokenizer or default_tokenizer()
    end = np.array([end_id], "<u4").tobytes()
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // RANGE_BYTES))
    ordered = rows.repartitionByRange(parts, F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first())

    def write(batches):
        import pandas as pd
        from pyspark import TaskContext
        encoder, part = id_encoder(path), TaskContext.get().partitionId()
        doc_ids, raws, held, shard, out = [], [], 0, 0, []

        def close():
            nonlocal doc_ids, raws, held, shard
            ends = np.cumsum([len(x) // 4 for x in raws])
            data = pack_shard(doc_ids, np.frombuffer(b"".join(raws), "<u4"), ends)
            name = f"{folder}/part-{part:06d}-{shard:06d}.ids"
            write_file(name, data)
            out.append((part, shard, name, len(doc_ids), int(ends[-1]), len(data)))
            doc_ids, raws, held, shard = [], [], 0, shard + 1

        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            for i, raw in zip(batch.column(0).to_pylist(), encoder.encode_all(texts)):
                doc_ids.append(i)
                raws.append(raw + end)
                held += len(raw) // 4 + 1
                if held >= SHARD_IDS:
                    close()
        if doc_ids:
            close()
        import pyarrow as pa
        yield from pa.Table.from_pandas(pd.DataFrame(out, columns=["part", "shard", "file", "n_docs", "n_ids", "n_bytes"])
                                        .astype({"part": "int64", "shard": "int64", "file": "str", "n_docs": "int64",
                                                 "n_ids": "int64", "n_bytes": "int64"}), preserve_index=False).to_batches()

    schema = "part bigint, shard bigint, file string, n_docs bigint, n_ids bigint, n_bytes bigint"
    return staged(ordered.mapInArrow(write, schema), "id-files")


def read_ids(files: DataFrame, with_ids: bool = False) -> DataFrame:
    """Decode the listed files: ``doc_id, start, n_tokens, ids_crc32`` per document, and ``ids`` if asked.

    ``start`` counts all ids of all documents before it: the files' sums are
    added up over the list (one row per file), the rest inside each file.
    """
    order = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    based = files.withColumn("base", F.coalesce(F.sum("n_ids").over(order), F.lit(0)))
    n = max(1, files.count())
    spread = based.select("file", "base").repartition(min(n, 100_000), "file")

    def read(batches):
        import pyarrow as pa
        for batch in batches:
            for file, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard = Shard(read_file(file))
                flat = shard.expand(shard.seq)
                ends = np.cumsum(shard.docs[:, 3])
                starts = ends - shard.docs[:, 3]
                raws = [flat[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist())]
                columns = [pa.array(shard.docs[:, 0].copy(), pa.int64(), mask=shard.docs[:, 1] == 0),
                           pa.array(starts + base), pa.array(shard.docs[:, 3].copy()),
                           pa.array([zlib.crc32(x) for x in raws], pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array(raws, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return spread.mapInArrow(read, schema + (", ids binary" if with_ids else ""))


def encode_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Write all documents as shard files into the shared folder and read them back.

    Null and empty texts are their end id alone; null ids come first; repeated
    ids stay repeated, in any order among themselves; extra columns are ignored;
    an empty table gives no file and no rows.
    """
    folder = new_folder(docs.sparkSession, "ids")
    return read_ids(write_ids(docs, folder, id_col, text_col, **options))


def op9_repair_ids(spark, sf_dir: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read back from the files."""
    return encode_corpus(table(spark, sf_dir, "documents"))
