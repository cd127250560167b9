"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlog.llm.common import staged

MAX_ROUNDS = 60
#: Small rounds are written by few tasks: one for this many edges.
EDGES_PER_TASK = 200_000


def _fingerprint(edges: DataFrame) -> tuple:
    """Two numbers that change whenever the set of edges does."""
    mixed = F.xxhash64("u", "v").cast("decimal(38,0)")
    row = edges.agg(F.count(F.lit(1)), F.sum(mixed)).first()
    return row[0], row[1]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of the undirected edges ``(a, b)``.

    ``component`` is the smallest node that can be reached.  Alternates two
    steps until nothing changes: every node links its larger neighbours to the
    smallest node it knows, then itself and its smaller neighbours.  Both are a
    minimum per node (combined before the shuffle) and a join on the node, whose
    hot partitions Spark splits; no neighbour list is ever gathered.  The number
    of rounds grows with the logarithm of the longest path.  Each round is
    written to the shared folder, so a lost executor repeats one round at most.

    Nulls and self-loops in the edges are ignored; repeated edges count once;
    an empty table gives an empty result.
    """
    u, v = F.least(a, b), F.greatest(a, b)
    links = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    now = staged(links.select(v.alias("u"), u.alias("v")).distinct(), "edges")  # u > v
    before = _fingerprint(now)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        tasks = 1 + before[0] // EDGES_PER_TASK
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # larger neighbours of u go to the smallest node u knows
        wide = (now.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u")
                .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        wide = staged(wide.coalesce(tasks), "wide")
        # u and its smaller neighbours go to the smallest of them
        small = wide.groupBy("u").agg(F.min("v").alias("m"))
        near = wide.join(small, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = staged(near.union(small.select("u", F.col("m").alias("v"))).distinct().coalesce(tasks), "edges")
        after = _fingerprint(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
