"""Hard negatives by exact scores from Four-Russians tables.

Vectors become integers (``floor(scale * x)``).  A candidate is kept as bit
planes: plane ``p`` holds bit ``p`` of each component (two's complement), packed
eight dimensions to a byte.  For each anchor and each group of eight dimensions
a table holds the sums of all 256 subsets of the anchor's components, so one byte
of a plane looks up eight dimensions at once; the planes are added with shifts,
the sign plane negatively, which gives the full integer inner product.

Candidates are written once into blocks of the shared folder, anchors into
blocks of ``ANCHORS``.  A task takes one anchor block and one group of candidate
blocks (bounded rows), and keeps only the best few rows of each anchor: first of
its own label (its positives, merged over all groups), then, for each positive,
of the other labels within the positive's score band.  Nothing is sampled; a hot
label or many equal vectors only make more rows that are scored and passed over.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftlog.llm.blocks import pack, unpack
from driftlog.llm.common import new_folder, read_file, staged, table, write_file

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: A negative scores 30 to 90 percent of the positive.
BAND = (30, 90)
#: Anchors and candidates of one block, candidates scored by one task, and rows scored at once.
ANCHORS = 256
BLOCK_ROWS = 1 << 14
GROUP_ROWS = 1 << 18
CHUNK = 2048
#: Scaled components stay below this, so that scores of up to 8,191 dimensions fit 64 bits.
LARGEST = 1 << 25
_LEAST, _MOST = -(1 << 62), 1 << 62


# --- vectors, bit planes and tables ------------------------------------------


def _matrix(column) -> np.ndarray:
    """Scaled integers of an Arrow list column; shorter vectors end in zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int64)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = values
    return out


def _stacked(parts: list[np.ndarray]) -> np.ndarray:
    wide = max(p.shape[1] for p in parts)
    return np.concatenate([np.pad(p, ((0, 0), (0, wide - p.shape[1]))) for p in parts])


def bit_planes(x: np.ndarray) -> np.ndarray:
    """``(planes, groups of eight dimensions, rows)`` bytes; the last plane is the sign."""
    most = int(np.where(x < 0, ~x, x).max(initial=0))
    planes = [np.packbits(((x >> p) & 1).astype(np.uint8), axis=1, bitorder="little").T for p in range(most.bit_length() + 1)]
    return np.ascontiguousarray(np.stack(planes))


def subset_tables(a: np.ndarray, kind) -> np.ndarray:
    """``(groups, 256, anchors)``: for each byte the sum of the components whose bits are set."""
    groups = -(-a.shape[1] // 8)
    a = np.pad(a, ((0, 0), (0, 8 * groups - a.shape[1])))
    out = np.zeros((groups, 256, len(a)), kind)
    for g in range(groups):
        for d in range(8):
            out[g, 1 << d:2 << d] = out[g, :1 << d] + a[:, 8 * g + d].astype(kind)
    return out


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """``(rows, anchors)`` inner products by lookups, shifts and additions."""
    rows, total = planes.shape[2], None
    for plane in planes[::-1]:
        if total is not None:
            total <<= 1
        added = np.zeros((rows, tables.shape[2]), tables.dtype) if total is None else total
        for entries, at in zip(tables, plane):
            added += entries[at]
        total = -added if total is None else added
    return total


# --- the best few rows of each anchor ----------------------------------------


class _Best:
    """For each slot the ``k`` first rows by score descending, id ascending."""

    def __init__(self, slots: int, k: int) -> None:
        self.k, self.score, self.id = k, np.full((slots, k), _LEAST), np.full((slots, k), _MOST)

    def offer(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        better = (score > self.score[slot, -1]) | ((score == self.score[slot, -1]) & (ids < self.id[slot, -1]))
        slot, score, ids = slot[better], score[better], ids[better]
        if not len(slot):
            return
        touched = np.unique(slot)
        slot = np.concatenate([np.repeat(touched, self.k), slot])
        score = np.concatenate([self.score[touched].ravel(), score])
        ids = np.concatenate([self.id[touched].ravel(), ids])
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        begin = np.searchsorted(slot, touched)
        rank = np.arange(len(slot)) - np.repeat(begin, np.diff(np.append(begin, len(slot))))
        first = rank < self.k
        self.score[slot[first], rank[first]] = score[first]
        self.id[slot[first], rank[first]] = ids[first]

    def rows(self):
        """``slot, score, id`` of what is held."""
        slot, place = np.nonzero(self.score > _LEAST)
        return slot, self.score[slot, place], self.id[slot, place]


def _score_type(a: np.ndarray, planes: np.ndarray):
    bound = a.shape[1] * int(np.abs(a).max(initial=0)) * (1 << planes.shape[0])
    return np.int32 if bound < 1 << 30 else np.int64


class _Anchors:
    """An anchor block: ids, labels and components, by label."""

    def __init__(self, data: bytes) -> None:
        self.ids, self.labels, flat = unpack(data)
        self.x = flat.reshape(len(self.ids), -1)
        self._tables: dict = {}

    def tables(self, planes: np.ndarray) -> np.ndarray:
        kind = _score_type(self.x, planes)
        if kind not in self._tables:
            self._tables[kind] = subset_tables(self.x, kind)
        return self._tables[kind]


def _candidates(data: bytes):
    ids, labels, shape, flat = unpack(data)
    return ids, labels, flat.reshape(tuple(shape))


def _positives(anchors: _Anchors, blocks, k: int) -> _Best:
    """The first ``k`` other rows of each anchor's label."""
    best = _Best(len(anchors.ids), k)
    kinds, begin = np.unique(anchors.labels, return_index=True)
    ends = np.append(begin[1:], len(anchors.ids))
    for ids, labels, planes in blocks:
        tables = anchors.tables(planes)
        for label, a, b in zip(kinds, begin, ends):
            low, high = np.searchsorted(labels, [label, label + 1])
            for r in range(low, high, CHUNK):
                some = slice(r, min(r + CHUNK, high))
                s = scores(tables[:, :, a:b], planes[:, :, some])
                row, col = np.nonzero((s >= best.score[a:b, -1]) & (ids[some][:, None] != anchors.ids[a:b]))
                best.offer(a + col, s[row, col].astype(np.int64), ids[some][row])
    return best


def _negatives(anchors: _Anchors, given: np.ndarray, blocks, k: int, band: tuple[int, int]) -> _Best:
    """Slot ``anchor * positives + place``: the first ``k`` rows of other labels within that positive's band."""
    count = given.shape[1]
    best = _Best(len(anchors.ids) * count, k)
    there = given > _LEAST
    low = np.where(there, -((-band[0] * given) // 100), _MOST)
    high = np.where(there, (band[1] * given) // 100, _LEAST)
    for ids, labels, planes in blocks:
        tables = anchors.tables(planes)
        limit = np.iinfo(tables.dtype)
        for r in range(0, len(ids), CHUNK):
            some = slice(r, r + CHUNK)
            s = scores(tables, planes[:, :, some])
            other = labels[some][:, None] != anchors.labels
            for place in range(count):
                floor = np.maximum(low[:, place], best.score[place::count, -1])
                lo, hi = (np.clip(v, limit.min, limit.max).astype(s.dtype) for v in (floor, high[:, place]))
                open_ = floor <= high[:, place]
                row, col = np.nonzero((s >= lo) & (s <= hi) & other & open_)
                best.offer(col * count + place, s[row, col].astype(np.int64), ids[some][row])
    return best


# --- Spark jobs ----------------------------------------------------------------


def _write_blocks(rows: DataFrame, folder: str, per_block: int, planes: bool) -> DataFrame:
    """Write ``id, label, vector`` rows into blocks, by label and id; the staged list of ``block, n``."""
    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        part, out, held, n = TaskContext.get().partitionId(), [], [], 0

        def close():
            nonlocal held, n
            ids, labels = (np.concatenate([h[k] for h in held]) for k in (0, 1))
            order = np.lexsort((ids, labels))
            ids, labels, x = ids[order], labels[order], _stacked([h[2] for h in held])[order]
            if planes:
                bits = bit_planes(x)
                data = pack(ids, labels, np.array(bits.shape), bits.ravel())
            else:
                data = pack(ids, labels, x.ravel())
            name = f"{part:06d}-{len(out):06d}"
            write_file(f"{folder}/{name}", data)
            out.append((name, len(ids)))
            held, n = [], 0

        for batch in batches:
            for k in range(0, batch.num_rows, per_block):
                some = batch.slice(k, per_block)
                if n + some.num_rows > per_block and n:
                    close()
                held.append((some.column(0).to_numpy(), some.column(1).to_numpy(), _matrix(some.column(2))))
                n += some.num_rows
        if n:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int64())],
                                         ["block", "n"])

    return staged(rows.mapInArrow(write, "block string, n bigint"), "vector-blocks")


def taking_part(rows: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """``id, label, vector`` of the rows with an id, a label and a finite vector."""
    x = F.col(vec_col).cast("array<double>")
    small = F.forall(x, lambda v: F.coalesce(F.abs(v) < LARGEST / SCALE, F.lit(False)) & ~F.isnan(v))
    return rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull() & small).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), x.alias("vector"))


def hard_negatives(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding",
                   label_col: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES,
                   band: tuple[int, int] = BAND, anchors_in_block: int = ANCHORS, block_rows: int = BLOCK_ROWS,
                   group_rows: int = GROUP_ROWS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    For each anchor (a row where ``is_anchor``, over the columns of ``rows``) the
    first ``positives`` other ids of its label by score descending, then id; for
    each of these the first ``negatives`` rows of other labels whose score is
    within ``band`` percent of the positive's.

    Rows with a null id, label or vector, a null or non-finite component, or one
    of ``LARGEST / SCALE`` or more (its scores may pass 64 bits) take no part.
    Vectors of different lengths are compared as if the shorter ended in zeros; an
    empty one scores zero.  Rows that repeat an id are candidates each; an anchor's
    id counts once, with its least label and vector, and is never its own positive.
    An empty table, or no anchor, gives no rows.  Other columns are ignored.
    """
    spark = rows.sparkSession
    folder = new_folder(spark, "hard-negatives")
    chosen = taking_part(rows.where(is_anchor), id_col, vec_col, label_col)
    chosen = chosen.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("v")).select("id", "v.*")
    chosen = staged(chosen, "anchors")
    blocks = max(1, -(-chosen.count() // anchors_in_block))
    anchors = _write_blocks(chosen.repartition(blocks, "id"), f"{folder}/anchors", anchors_in_block, planes=False)
    held = _write_blocks(taking_part(rows, id_col, vec_col, label_col), f"{folder}/rows", block_rows, planes=True)
    groups = max(1, -(-(held.agg(F.sum("n")).first()[0] or 0) // group_rows))
    grouped = held.select(F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int").alias("g"), "block").groupBy("g").agg(
        F.sort_array(F.collect_list("block")).alias("names"))
    tasks = anchors.select(F.col("block").alias("anchors"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"))
    tasks = staged(tasks.join(grouped, "g").select("anchors", "g", "names"), "scoring-tasks")
    width = min(max(1, tasks.count()), 100_000)

    def read(names):
        return (_candidates(read_file(f"{folder}/rows/{x}")) for x in names)

    def find_positives(batches):
        import pyarrow as pa
        for batch in batches:
            for name, names in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                block = _Anchors(read_file(f"{folder}/anchors/{name}"))
                slot, score, ids = _positives(block, read(names), positives).rows()
                yield pa.RecordBatch.from_pydict({"anchors": [name] * len(slot), "a": slot, "score": score, "id": ids})

    first = Window.partitionBy("anchors", "a").orderBy(F.desc("score"), "id")
    found = (tasks.select("anchors", "names").repartition(width).mapInArrow(find_positives, "anchors string, a bigint, score bigint, id bigint")
             .withColumn("place", F.row_number().over(first) - 1).where(F.col("place") < positives))
    given = found.groupBy("anchors").agg(F.sort_array(F.collect_list(F.struct("a", "place", "score", "id"))).alias("given"))
    work = staged(tasks.join(given, "anchors").select("anchors", "names", "given"), "scoring-tasks")

    def find_negatives(batches):
        import pyarrow as pa
        for batch in batches:
            for name, names, known in zip(*(c.to_pylist() for c in batch.columns)):
                block = _Anchors(read_file(f"{folder}/anchors/{name}"))
                score, ids = (np.full((len(block.ids), positives), _LEAST) for _ in range(2))
                for x in known:
                    score[x["a"], x["place"]], ids[x["a"], x["place"]] = x["score"], x["id"]
                slot, s, negative = _negatives(block, score, read(names), negatives, band).rows()
                a, place = np.divmod(slot, positives)
                yield pa.RecordBatch.from_pydict({"anchor_id": block.ids[a], "place": place, "positive_id": ids[a, place],
                                                  "positive_score": score[a, place], "negative_id": negative, "negative_score": s})

    schema = "anchor_id bigint, place bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"
    best = Window.partitionBy("anchor_id", "place").orderBy(F.desc("negative_score"), "negative_id")
    out = (work.repartition(width).mapInArrow(find_negatives, schema)
           .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives))
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of every row whose id is divisible by 100, against all rows of ``embeddings``."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.col("label").cast("long").alias("label"))
    moved = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(moved, F.col("vec_id") % 100 == 0)


ORACLE_OP13 = f"""
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
     s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
                  list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i]))::BIGINT AS score
           FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
     p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
           QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES})
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND {BAND[0]} * positive_score <= 100 * score AND 100 * score <= {BAND[1]} * positive_score
QUALIFY rank <= {NEGATIVES}
"""
