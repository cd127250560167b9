"""Blocks of documents that exchange packed arrays with buckets of keys.

Some operators must look up many keys (word windows, word pairs) of every
document in the whole corpus.  One row per key would shuffle several times the
text; instead a task gathers a block of documents, finds the distinct keys of
the block, and sends each bucket (a range of key hashes) one packed array.  A
bucket merges the arrays of all blocks and answers each of them, in the order it
was asked; a key that is in a third of all documents is sent once per block.

Blocks are written to the shared folder once, under their own name, so that the
later steps, and a step that is repeated after an executor was lost, read the
same ones.  A block is bounded in bytes (one longer document is a block of its
own), a bucket by the number of buckets.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from driftlog.llm.common import read_file, staged, write_file

BLOCK_BYTES = 16 << 20
#: Keys of one bucket, on average.
BUCKET_KEYS = 1_000_000

UP = "bucket long, block string, payload binary"
DOWN = "block string, bucket long, reply binary, figures array<double>"


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes, compressed by byte planes (the high bytes of small numbers shrink to nothing)."""
    import pickle
    held = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        planes = a.view(np.uint8).reshape(len(a), a.itemsize).T if len(a) else a.view(np.uint8)
        held.append((a.dtype.str, len(a), zlib.compress(np.ascontiguousarray(planes).tobytes(), 1)))
    return pickle.dumps(held, protocol=5)


def unpack(data: bytes) -> list[np.ndarray]:
    import pickle
    out = []
    for kind, n, raw in pickle.loads(data):
        planes = np.frombuffer(zlib.decompress(raw), np.uint8)
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(planes.reshape(size, n).T).view(kind).reshape(n) if n else np.zeros(0, kind))
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers spread over the whole range (a bijection)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def bucket_edges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's range begins in ascending spread keys (``buckets + 1`` places)."""
    step = (1 << 64) // buckets
    return np.concatenate([[0], np.searchsorted(keys, np.array([k * step for k in range(1, buckets)], np.uint64)), [len(keys)]])


class WordHashes(dict):
    """XXH64 of words, remembered; emptied when it has grown too large."""

    LIMIT = 500_000

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxh64_intdigest(word, 42)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.LIMIT:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def write_blocks(docs: DataFrame, folder: str, encode: Callable[[list, list[bytes], list], tuple[bytes, int]],
                 id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES, carry: tuple[str, ...] = ()) -> DataFrame:
    """Write every document into a block; returns the staged list of ``block, n_docs, n_keys``.

    ``encode(ids, texts, rest)`` gives a block's bytes and a number of keys;
    ``ids`` are integers or None, ``rest`` each row's ``carry`` columns.
    """
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"), *carry)

    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        from driftlog.llm.common import text_bytes
        part, out, ids, texts, rest, held = TaskContext.get().partitionId(), [], [], [], [], 0

        def close():
            nonlocal ids, texts, rest, held
            data, keys = encode(ids, texts, rest)
            block = f"{part:06d}-{len(out):06d}"
            write_file(f"{folder}/{block}", data)
            out.append((block, len(ids), keys))
            ids, texts, rest, held = [], [], [], 0

        for batch in batches:
            more = zip(*(c.to_pylist() for c in batch.columns[2:])) if carry else [()] * batch.num_rows
            for i, text, others in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), more):
                if ids and held + len(text) > block_bytes:
                    close()
                ids.append(i)
                texts.append(text)
                rest.append(others)
                held += len(text) + 1
        if ids:
            close()
        names = ["block", "n_docs", "n_keys"]
        kinds = [pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)], names)

    return staged(rows.mapInArrow(write, "block string, n_docs bigint, n_keys bigint"), "blocks")


def bucket_count(keys: int, per_bucket: int = BUCKET_KEYS) -> int:
    return max(1, -(-keys // per_bucket))


def send(blocks: DataFrame, folder: str, make: Callable[[str, bytes], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """``make(block, its bytes)`` for each block: rows ``bucket, block, payload``."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for block in batch.column(0).to_pylist():
                for bucket, payload in make(block, read_file(f"{folder}/{block}")):
                    yield pa.RecordBatch.from_pydict({"bucket": [bucket], "block": [block], "payload": [payload]})

    return blocks.select("block").repartition(task_count(blocks)).mapInArrow(run, UP)


def task_count(blocks: DataFrame) -> int:
    """A task for each block, as far as a scheduler takes them.

    The work of a block is not in the bytes of its rows, so Spark must not join
    small partitions of them.
    """
    return min(max(1, blocks.count()), 100_000)


def answer(sent: DataFrame, merge: Callable, name: str = "replies") -> DataFrame:
    """``merge(bucket, blocks, payloads)`` gives one reply per block, or ``(replies, figures)``.

    Staged rows ``block, bucket, reply, figures``; a bucket's figures (a few
    numbers to be summed over all buckets) stand in its first row only.
    """
    def run(frame):
        import pandas as pd
        frame = frame.sort_values("block")
        bucket, names = int(frame["bucket"].iloc[0]), frame["block"].tolist()
        replies = merge(bucket, names, frame["payload"].tolist())
        replies, figures = replies if isinstance(replies, tuple) else (replies, [])
        return pd.DataFrame({"block": names, "bucket": bucket, "reply": replies,
                             "figures": [[float(x) for x in figures]] + [None] * (len(names) - 1)})

    return staged(sent.groupBy("bucket").applyInPandas(run, DOWN), name)


def figures_of(replies: DataFrame, count: int) -> list[float]:
    """The sums of the buckets' figures."""
    row = replies.agg(*[F.coalesce(F.sum(F.get("figures", F.lit(k))), F.lit(0.0)) for k in range(count)]).first()
    return [float(x) for x in row]


def each_block(replies: DataFrame, folder: str, tasks: int, work: Callable, schema: str) -> DataFrame:
    """``work(block, its bytes, {bucket: reply})`` for each block, in ``tasks`` tasks; gives the rows of a frame."""
    def run(frame):
        block = frame["block"].iloc[0]
        return work(block, read_file(f"{folder}/{block}"), dict(zip(frame["bucket"].tolist(), frame["reply"].tolist())))

    return replies.select("block", "bucket", "reply").repartition(tasks, "block").groupBy("block").applyInPandas(run, schema)
