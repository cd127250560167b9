"""Sharding by extendible hashing (DataFrame functions only).

A directory is indexed by the leading bits of a hash; a bucket that is larger
than the byte limit splits on one more bit, all others stay as they are.  The
splits are decided on totals: rows are summed per directory cell first (combined
before the shuffle), each cell is rolled up to all its shorter prefixes, and a
cell's shard is the shortest prefix that fits.  Cells that are still too large
at the deepest bit looked at go on to a deeper directory, until none is left.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlog.llm.common import staged, table

LIMIT_BYTES = 1024 * 1024
#: The hash is two words of 60 bits, so that each is a positive long.
WORD_BITS = 60
HASH_BITS = 2 * WORD_BITS
STEP_BITS = 8


def hash_words(key: Column) -> tuple[Column, Column]:
    """The first and second 60 bits of the MD5 of ``key`` as text (null: of the empty text)."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    word = lambda start: F.conv(F.substring(digest, start, 15), 16, 10).cast("long")
    return word(1), word(16)


def prefix(high: Column, low: Column, bits: int) -> Column:
    """The leading ``bits`` of the hash, as ``0`` and ``1``."""
    text = F.concat(F.lpad(F.bin(high), WORD_BITS, "0"), F.lpad(F.bin(low), WORD_BITS, "0"))
    return F.substring(text, 1, bits)


def directory(rows: DataFrame, limit_bytes: int) -> DataFrame:
    """``(shard, depth, shard_rows, shard_bytes)``, the leaves, from rows ``(high, low, bytes)``.

    A leaf fits the limit, or cannot be split: it holds one row, or rows whose
    hashes are equal in all bits (one key); ``assign`` splits those by pieces.
    """
    total = rows.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    if not rows.take(1):
        return rows.sparkSession.createDataFrame([], "shard string, depth int, shard_rows long, shard_bytes long")
    deep = min(HASH_BITS, max(0, math.ceil(math.log2(max(1, total / limit_bytes)))) + 4)
    first, leaves, rest = 0, [], rows
    while True:
        cells = staged(rest.groupBy(prefix(F.col("high"), F.col("low"), deep).alias("cell"))
                       .agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"),
                            F.min(F.struct("high", "low")).alias("a"), F.max(F.struct("high", "low")).alias("z")),
                       "cells")
        rolled = (cells.select("n", "bytes", "a", "z", F.explode(F.sequence(F.lit(first), F.lit(deep))).alias("depth"), "cell")
                  .withColumn("shard", F.expr("substring(cell, 1, depth)"))
                  .groupBy("depth", "shard")
                  .agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.min("a").alias("a"), F.max("z").alias("z")))
        fit = (F.col("bytes") <= limit_bytes) | (F.col("n") == 1) | (F.col("a") == F.col("z"))
        rolled = staged(rolled.select("depth", "shard", F.col("n").alias("shard_rows"), F.col("bytes").alias("shard_bytes"),
                                      fit.alias("fits")), "prefixes")
        # a leaf fits while the prefix one bit shorter does not
        split = rolled.where("not fits").select((F.col("depth") + 1).alias("depth"), F.col("shard").alias("parent"))
        below = (rolled.where(F.col("fits") & (F.col("depth") > first))
                 .withColumn("parent", F.expr("substring(shard, 1, depth - 1)")).join(split, ["depth", "parent"], "left_semi"))
        leaves.append(rolled.where(F.col("fits") & (F.col("depth") == first)).drop("fits")
                      .unionByName(below.drop("fits", "parent")))
        open_cells = rolled.where(~F.col("fits") & (F.col("depth") == deep)).select(F.col("shard").alias("cell"))
        if not open_cells.take(1):
            break
        at = prefix(F.col("high"), F.col("low"), deep)
        rest = rest.withColumn("cell", at).join(open_cells, "cell", "left_semi").drop("cell")
        first, deep = deep + 1, min(HASH_BITS, deep + STEP_BITS)
    out = leaves[0]
    for more in leaves[1:]:
        out = out.unionByName(more)
    return out.select("shard", F.col("depth").cast("int").alias("depth"), "shard_rows", "shard_bytes")


def assign(rows: DataFrame, limit_bytes: int = LIMIT_BYTES, key_col: str = "doc_id", text_col: str = "text",
           row_cols: tuple[str, ...] = ()) -> DataFrame:
    """Every row's shard: ``key_col, row_cols, bytes, shard, depth, piece, shard_rows, shard_bytes``.

    ``shard`` is the hash prefix (empty: no split was needed).  ``piece`` is 0
    except for a key whose rows alone exceed the limit: no bit tells them apart,
    so they are dealt over pieces by a hash of the row.  A row that is larger
    than the limit has a shard of its own.  Null keys are one key (empty text);
    null texts have no bytes; repeated rows are rows like any other; extra
    columns are ignored; an empty table gives no rows.
    """
    high, low = hash_words(F.col(key_col))
    size = F.octet_length(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).cast("long")
    sized = staged(rows.select(key_col, *row_cols, high.alias("high"), low.alias("low"), size.alias("bytes"),
                               F.xxhash64(text_col, *row_cols).alias("row_hash")), "sized")
    leaves = staged(directory(sized.select("high", "low", "bytes"), limit_bytes), "directory")
    depths = sorted(r[0] for r in leaves.select("depth").distinct().collect())  # at most HASH_BITS + 1 numbers
    if not depths:
        return sized.select(key_col, *row_cols, "bytes").select(
            "*", F.lit("").alias("shard"), F.lit(0).alias("depth"), F.lit(0).cast("long").alias("piece"),
            F.lit(0).cast("long").alias("shard_rows"), F.lit(0).cast("long").alias("shard_bytes"))
    deepest, held = depths[-1], prefix(F.col("high"), F.col("low"), depths[-1])
    # a full directory: one entry per used cell of the deepest level, pointing to its leaf
    cells = sized.groupBy(held.alias("cell")).agg(F.count(F.lit(1)).alias("_n"))
    tries = F.array(*[F.struct(F.lit(d).alias("depth"), F.substring("cell", 1, d).alias("shard")) for d in depths])
    entries = cells.select("cell", F.inline(tries)).join(leaves, ["depth", "shard"])
    out = sized.withColumn("cell", held).join(entries, "cell")
    pieces = F.greatest(F.lit(1), F.ceil(F.col("shard_bytes") / limit_bytes)).cast("long")
    over = (F.col("shard_bytes") > limit_bytes) & (F.col("shard_rows") > 1)
    piece = F.when(over, F.pmod(F.col("row_hash"), 2 * pieces)).otherwise(F.lit(0))
    return out.select(key_col, *row_cols, "bytes", "shard", F.col("depth").cast("int").alias("depth"),
                      piece.cast("long").alias("piece"), "shard_rows", "shard_bytes")


def op4_extendible_sharding(spark, sf_dir: str) -> DataFrame:
    """``doc_id, bytes, shard, depth, piece, shard_rows, shard_bytes`` of every document, sharded by its id."""
    return assign(table(spark, sf_dir, "documents"))


def oracle_op4(limit_bytes: int = LIMIT_BYTES, bits: int = 40) -> str:
    """The same shards by one top-down recursion over all prefixes."""
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT AS bytes,
         right(repeat('0', 60) || ltrim(format('{{:b}}', ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT), ' '), 60) AS h
  FROM documents),
t(depth, shard, shard_rows, shard_bytes) AS (
  SELECT 0, '', count(*)::BIGINT, sum(bytes)::BIGINT FROM d
  UNION ALL
  (WITH open AS (SELECT depth, shard FROM t WHERE shard_bytes > {limit_bytes} AND shard_rows > 1 AND depth < {bits})
   SELECT open.depth + 1, substr(d.h, 1, open.depth + 1), count(*)::BIGINT, sum(d.bytes)::BIGINT
   FROM open JOIN d ON substr(d.h, 1, open.depth) = open.shard GROUP BY 1, 2))
SELECT doc_id, bytes, shard, depth, 0::BIGINT AS piece, shard_rows, shard_bytes
FROM d JOIN t ON substr(d.h, 1, t.depth) = t.shard
WHERE (shard_bytes <= {limit_bytes} OR shard_rows = 1) AND shard_rows > 0
"""
