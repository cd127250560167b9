"""Sequence packing by multiway differencing (Karmarkar-Karp).

Documents are encoded once.  Every full window of a document is a sequence of
its own; what is left of it is cut into pieces no longer than ``piece_tokens``.
The pieces are dealt into groups of bounded size, and each group is divided over
its windows: partial partitions start with one piece each, and the two with the
largest spread between their fullest and emptiest window are merged with
opposite order, until one partition is left.  If its fullest window exceeds the
capacity, the group gets another window and is divided anew.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlog.llm.common import default_tokenizer, id_encoder, staged, table

CAPACITY = 2048
END_ID = 1
#: Longest piece of a document's last, partial window.
PIECE_TOKENS = 512
#: Pieces of one group, on average; a group is one task's work.
GROUP_PIECES = 1024


def difference(sizes: list[int], windows: int) -> np.ndarray:
    """The window of each size: ``windows`` nearly equal sums by multiway differencing.

    A partial partition is the ascending array of its windows' sums.  Merging
    adds one partition's fullest windows to the other's emptiest; the
    permutations of the merges, replayed from the last to the first, tell where
    each size went.
    """
    where = np.zeros(len(sizes), np.int64)
    nodes: list = []  # a size's index, or (permutation, node, node)
    heap = []
    for i, size in enumerate(sizes):
        sums = np.zeros(windows, np.int64)
        sums[-1] = size
        nodes.append(i)
        heap.append((-size, i, sums))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, i, sums = heapq.heappop(heap)
        _, j, others = heapq.heappop(heap)
        sums = sums + others[::-1]
        order = np.argsort(sums, kind="stable")
        sums = sums[order]
        heapq.heappush(heap, (int(sums[0] - sums[-1]), len(nodes), sums))
        nodes.append((order, i, j))
    todo = [(heap[0][1], np.arange(windows))] if heap else []
    while todo:
        node, window = todo.pop()
        if isinstance(nodes[node], int):
            where[nodes[node]] = window[-1]
            continue
        order, i, j = nodes[node]
        mine = np.empty(windows, np.int64)
        mine[order] = window
        todo += [(i, mine), (j, mine[::-1])]
    return where


def pack_group(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Near-equal windows of at most ``capacity``; one more window whenever one would overflow.

    Every size must be at most ``capacity``, so as many windows as pieces always fit.
    """
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        where = difference(sizes, windows)
        if np.bincount(where, weights=sizes, minlength=1).max(initial=0) <= capacity:
            order = np.argsort(where, kind="stable")
            cut = np.flatnonzero(np.diff(where[order])) + 1
            return [x.tolist() for x in np.split(order, cut)]
        windows += 1


def cuts(tokens: int, capacity: int = CAPACITY, piece: int = PIECE_TOKENS) -> list[tuple[int, int]]:
    """``(start, length)`` of a document's pieces: full windows, then near-equal pieces of the rest."""
    full, rest = divmod(tokens, capacity)
    out = [(k * capacity, capacity) for k in range(full)]
    n = -(-rest // piece)
    for k in range(n):
        a, b = rest * k // n, rest * (k + 1) // n
        out.append((full * capacity + a, b - a))
    return out


def document_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
                    end_id: int = END_ID, capacity: int = CAPACITY, piece_tokens: int = PIECE_TOKENS,
                    with_ids: bool = False) -> DataFrame:
    """Encode every text, end it with ``end_id`` and cut it.

    ``(id_col, row_key, start, length, ids_crc32, doc_tokens)`` per piece, and
    ``ids`` (little-endian unsigned 32-bit) with ``with_ids``.  ``row_key`` tells
    repeated rows apart.
    """
    path = tokenizer or default_tokenizer()
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches):
        import pyarrow as pa
        encoder = id_encoder(path)
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            at, starts, lengths, sums, totals, raws = [], [], [], [], [], []
            for k, ids in enumerate(encoder.encode_all(texts)):
                ids += end
                n = len(ids) // 4
                for start, length in cuts(n, capacity, piece_tokens):
                    part = ids[4 * start:4 * (start + length)]
                    at.append(k)
                    starts.append(start)
                    lengths.append(length)
                    sums.append(zlib.crc32(part))
                    totals.append(n)
                    if with_ids:
                        raws.append(part)
            rows = batch.column(0).take(pa.array(at, pa.int64()))
            keys = batch.column(2).take(pa.array(at, pa.int64()))
            columns = [rows, keys, *(pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals))]
            if with_ids:
                columns.append(pa.array(raws, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names)

    kept = docs.select(id_col, F.col(text_col).cast("string"), F.monotonically_increasing_id().alias("row_key"))
    names = [id_col, "row_key", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    kind = kept.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, row_key bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    return kept.mapInArrow(encode, schema + (", ids binary" if with_ids else ""))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         group_pieces: int = GROUP_PIECES, **options) -> DataFrame:
    """Pack every document into sequences of at most ``capacity`` ids.

    Returns the pieces with ``sequence_id`` and ``offset`` (gapless from 0 in
    each sequence).  Every id of every document, its end id included, is in
    exactly one piece.  Null and empty texts are their end id alone; null ids and
    repeated rows are packed like others; extra columns are ignored; an empty
    table gives no rows.
    """
    pieces = staged(document_pieces(docs, id_col, text_col, capacity=capacity, **options), "pieces")
    groups = max(1, -(-pieces.count() // group_pieces))
    place = F.pmod(F.xxhash64(F.col(id_col), "row_key", "start"), F.lit(groups))

    def divide(frame):
        frame = frame.sort_values(["row_key", "start"], kind="stable").reset_index(drop=True)
        sizes = frame["length"].to_numpy()
        whole = np.flatnonzero(sizes == capacity)
        parts = np.flatnonzero(sizes != capacity)
        windows = [[int(i)] for i in whole]
        windows += [[int(parts[i]) for i in w] for w in pack_group(sizes[parts].tolist(), capacity)] if len(parts) else []
        sequence, offset = np.zeros(len(frame), np.int64), np.zeros(len(frame), np.int64)
        base = int(frame["group"].iloc[0]) << 32
        for k, window in enumerate(windows):
            sequence[window] = base + k
            offset[window] = np.cumsum([0, *sizes[window][:-1]])
        return frame.assign(sequence_id=sequence, offset=offset).drop(columns=["group", "row_key"])

    # an id may be null: it travels as text beside the packing columns
    kind = pieces.schema[id_col].dataType.simpleString()
    rest = [c for c in pieces.columns if c not in (id_col, "row_key")]
    schema = ", ".join(["__id string", *(f"{c} {pieces.schema[c].dataType.simpleString()}" for c in rest),
                        "sequence_id bigint", "offset bigint"])
    packed = (pieces.select(F.col(id_col).cast("string").alias("__id"), "row_key", *rest, place.alias("group"))
              .groupBy("group").applyInPandas(divide, schema))
    return packed.select(F.col("__id").cast(kind).alias(id_col), *rest, "sequence_id", "offset")


def op7_kk_packing(spark, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return pack(table(spark, sf_dir, "documents"))
