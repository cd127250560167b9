"""SimHash near-duplicates by multi-index hashing.

Fingerprints are cut into segments; a table holds every distinct fingerprint
under each of its segments.  Two fingerprints within ``max_bits`` differ in at
most ``max_bits // segments`` bits in one segment at least, so each fingerprint
looks up that small Hamming ball around each of its segments and every match is
verified by the complete distance.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlog.llm.common import shared_folder, staged, text_bytes
from driftlog.llm.components import connected_components

SEED = 42
BITS = 64
SHINGLE_WORDS = 3
MAX_BITS = 3
SEGMENTS = 2

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def simhash(hashes: np.ndarray) -> int:
    """64-bit SimHash of unsigned 64-bit hashes: a bit is 1 if set in over half of them."""
    n = len(hashes)
    if not n:
        return 0
    octets = np.ascontiguousarray(hashes, dtype="<u8").view(np.uint8).reshape(n, 8)
    counts = np.concatenate([np.bincount(octets[:, k], minlength=256) @ _BYTE_BITS for k in range(8)])
    bits = (2 * counts > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def shingle_hashes(words: list[bytes], size: int = SHINGLE_WORDS, seed: int = SEED) -> np.ndarray:
    """XXH64 of each space-joined shingle, repeats included; fewer words: of the whole sequence."""
    from xxhash import xxh64_intdigest
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= size:
        return np.array([xxh64_intdigest(b" ".join(words), seed)], np.uint64)
    rows = map(b" ".join, zip(*[words[k:] for k in range(size)]))
    return np.fromiter((xxh64_intdigest(x, seed) for x in rows), np.uint64, len(words) - size + 1)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """``(id_col, fp)``: the signed 64-bit SimHash of each whole text (null or wordless: 0)."""
    def compute(batches):
        import pyarrow as pa
        for batch in batches:
            out = np.fromiter((simhash(shingle_hashes(t.lower().split(), shingle_words, seed))
                               for t in text_bytes(batch.column(1))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], [id_col, "fp"])

    kept = docs.select(id_col, text_col)
    kind = kept.schema[id_col].dataType.simpleString()
    return kept.mapInArrow(compute, f"`{id_col}` {kind}, fp bigint")


def _segments(segments: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment."""
    edges = [BITS * k // segments for k in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def near_pairs(fps: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """Pairs ``(a, b)``, ``a < b``, of distinct fingerprints ``fp`` that differ in 1 to ``max_bits`` bits.

    A pair that differs in some bits of a segment is looked up from one side
    only: the one with a 0 in the highest differing bit of that segment.  The
    same pair may be found in several segments and is then returned repeatedly.
    """
    radius = max_bits // segments
    probes, shelves = [], []
    fp = F.col("fp")
    for k, (low, width) in enumerate(_segments(segments)):
        part = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1)) if width < 64 else fp
        shelves.append(F.struct(F.lit(k).alias("k"), part.alias("part")))
        for flips in range(radius + 1):
            for ball in combinations(range(width), flips):
                mask = sum(1 << i for i in ball)
                here = F.struct(F.lit(k).alias("k"), part.bitwiseXOR(F.lit(mask)).alias("part"))
                if ball:
                    here = F.when(part.bitwiseAND(F.lit(1 << ball[-1])) == 0, here)
                probes.append(here)
    look = (fps.select(fp.alias("a"), F.explode(F.filter(F.array(*probes), lambda x: x.isNotNull())).alias("x"))
            .select("a", "x.k", "x.part"))
    held = fps.select(fp.alias("b"), F.explode(F.array(*shelves)).alias("x")).select("b", "x.k", "x.part")
    found = look.join(held, ["k", "part"])
    far = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return (found.where((F.col("a") != F.col("b")) & (far <= max_bits))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                   segments: int = SEGMENTS) -> DataFrame:
    """``(id_col, fp, component_id)`` per document; ``component_id`` is the smallest id reachable.

    Equal fingerprints are one node, so copies are never paired with each other.
    Null and wordless texts have fingerprint 0 and are linked like any other; a
    null id takes part but is never a component's id unless alone; repeated rows
    stay repeated; extra columns are ignored; an empty table gives no rows.
    """
    shared_folder(docs.sparkSession)
    prints = staged(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    nodes = staged(prints.groupBy("fp").agg(F.min(id_col).alias("least_id")), "nodes")
    linked = connected_components(near_pairs(nodes.select("fp"), max_bits, segments))
    named = (nodes.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
             .select("fp", "least_id", F.coalesce("component", "fp").alias("component")))
    roots = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = named.join(roots, "component").select("fp", "component_id")
    return prints.join(named, "fp").select(id_col, "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that are the smallest id of their component, with all their columns.

    Rows with a null id stay only if their whole component has none; of rows
    that share the smallest id, all stay.
    """
    groups = simhash_groups(docs, id_col, text_col, **options)
    roots = groups.where(F.col(id_col).eqNullSafe(F.col("component_id"))).select(id_col).distinct()
    roots = roots.withColumnRenamed(id_col, "__root")
    return docs.join(roots, F.col(id_col).eqNullSafe(F.col("__root")), "left_semi")


def op8_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every document."""
    from driftlog.llm.common import table
    groups = simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
