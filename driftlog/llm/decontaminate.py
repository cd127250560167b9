"""Benchmark decontamination with item-sized SimHash windows (DataFrame functions only).

A document's windows are as long as a benchmark item.  Two windows of ``n``
shingles reach a similarity of 0.8 only if they share ``8 n / 9`` of them, so only
windows with that many shingles of some item of their length are fingerprinted;
this loses no pair.

Windows and items of one length meet by multi-index hashing of 256-bit SimHash
fingerprints: of 32 blocks of eight bits, two fingerprints that lie within 63 bits
agree in some block up to one bit.  Each item enters, for each block, all values
that are at most one bit away from its own, each window its own values, so every
pair within the radius meets for certain; the whole distance is checked next, and
the exact weighted similarity of the word shingles (each weighted by how often it
occurs) last.  A pair at a similarity of 0.8 differs in about 15 percent of the
bits, 39 of 256, with a standard deviation below 6; more than 63 are one case in
about 100,000 there, and rarer for closer pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlog.llm.common import let, staged, table

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: Bits of one hash, hashes of a fingerprint (one for each seed), and bits of a block.
BITS = 64
SEEDS = 4
BLOCK_BITS = 8
BLOCKS = SEEDS * BITS // BLOCK_BITS
#: Any two fingerprints within so many bits have a block in which they differ by one bit at most.
RADIUS = 2 * BLOCKS - 1
#: Benchmark shingles (16 bytes each) are broadcast up to this many rows, else joined by a shuffle.
BROADCAST_SHINGLES = 250_000


def plain_words(text: Column) -> Column:
    """Lower-case words of letters and digits (null: none)."""
    parts = F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.array_remove(parts, "")


def shingles(words: Column, width: int) -> Column:
    """Hashes of all shingles of ``width`` words, in order, repeats included."""
    def of(h: Column) -> Column:
        return F.when(F.size(h) >= width, F.transform(
            F.sequence(F.lit(1), F.size(h) - (width - 1)), lambda i: F.xxhash64(F.slice(h, i, width)))
        ).otherwise(F.array().cast("array<bigint>"))
    return let(F.transform(words, lambda w: F.xxhash64(w)), of)


def simhash(hashes: Column) -> Column:
    """256-bit SimHash of an array of hashes, as four longs: a bit is set if it is in over half of them."""
    def votes(some: Column, bit: Column) -> Column:
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
        ones = F.size(F.filter(some, lambda x: x.bitwiseAND(mask) != 0))
        return F.when(2 * ones > F.size(some), mask).otherwise(F.lit(0).cast("long"))

    def word(some: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(0).cast("long"), lambda fp, bit: fp.bitwiseOR(votes(some, bit)))

    return F.transform(F.sequence(F.lit(0), F.lit(SEEDS - 1)),
                       lambda seed: let(F.transform(hashes, lambda x: F.xxhash64(x, seed)), word))


def distance(f: Column, g: Column) -> Column:
    """Bits in which two fingerprints differ."""
    parts = [F.bit_count(F.get(f, F.lit(k)).bitwiseXOR(F.get(g, F.lit(k)))) for k in range(SEEDS)]
    return parts[0] + parts[1] + parts[2] + parts[3]


def blocks(fp: Column, ball: bool) -> Column:
    """``(block, value)`` of each block of a fingerprint; with ``ball`` also the values one bit away."""
    in_word = BITS // BLOCK_BITS
    number = F.sequence(F.lit(0), F.lit(BLOCKS - 1))
    masks = F.array(F.lit(0).cast("long"), *[F.lit(1 << i).cast("long") for i in range(BLOCK_BITS if ball else 0)])

    def value(k: Column) -> Column:
        word = F.get(fp, F.floor(k / in_word).cast("int"))
        return F.call_function("shiftrightunsigned", word, (k % in_word) * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1).cast("long"))

    return F.flatten(F.transform(number, lambda k: F.transform(masks, lambda m: F.struct(
        k.alias("block"), value(k).bitwiseXOR(m).alias("value")))))


def _shared(a: Column, b: Column) -> Column:
    """Size of the intersection of two arrays as multisets."""
    times = lambda x, items: F.size(F.filter(items, lambda y: y == x))
    return F.aggregate(F.array_distinct(a), F.lit(0), lambda n, x: n + F.least(times(x, a), times(x, b)))


def _items(benchmark: DataFrame) -> DataFrame:
    """``item_id, size, width, s, fp`` of the items with words."""
    rows = benchmark.select(F.col("item_id"), F.inline(F.array(F.struct(plain_words(F.col("text")).alias("w")))))
    rows = rows.where(F.size("w") > 0).select("item_id", F.size("w").alias("size"), "w")
    width = F.least(F.col("size"), F.lit(SHINGLE_WORDS))
    of = F.lit(None).cast("array<bigint>")
    for k in range(1, SHINGLE_WORDS + 1):
        of = F.when(F.col("width") == k, shingles(F.col("w"), k)).otherwise(of)
    rows = rows.withColumn("width", width).select("item_id", "size", "width", of.alias("s"))
    return staged(rows.select("item_id", "size", "width", "s", let(F.col("s"), simhash).alias("fp")), "items")


def _needed(n: Column, m: Column, similarity: float) -> Column:
    """Fewest shared shingles with which ``n`` and ``m`` shingles reach the similarity."""
    return F.ceil((n + m) * (similarity / (1 + similarity)) - 1e-9).cast("int")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """``id_col, item_id, similarity, start, n_words``: each item found in each document.

    The best window of the pair (the first of the best); ``start`` counts words
    of letters and digits.  A text shorter than an item is one window itself.
    Items of fewer than five words are compared as one shingle; items and texts
    without words (null, empty) match nothing; repeated rows each get their
    rows; equal texts are searched once; extra columns are ignored; an empty
    table on either side gives no rows.  ``radius`` is at most ``RADIUS``, up to
    which no pair of fingerprints is lost.
    """
    if radius > RADIUS:
        raise ValueError(f"blocks find all pairs within {RADIUS} bits only")
    items = _items(benchmark)
    known = items.select("width", "size", F.explode(F.array_distinct("s")).alias("h")).distinct()
    known = staged(known, "item-shingles")
    small = known.count() <= BROADCAST_SHINGLES
    widths = sorted(r[0] for r in known.select("width").distinct().collect())  # at most five numbers
    keyed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                        F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("key"))

    def cut(rows: DataFrame, *keep: str) -> DataFrame:
        """Rows with ``s``, their shingles of each width in use."""
        by_width = lambda w: F.array(*[F.struct(F.lit(k).alias("width"), shingles(w, k).alias("s")) for k in widths])
        once = rows.select(*keep, F.inline(F.array(F.struct(plain_words(F.col("text")).alias("w")))))
        return once.select(*keep, F.inline(by_width(F.col("w"))))

    if not widths:
        kinds = {"item_id": benchmark.schema["item_id"].dataType, "similarity": "double", "start": "int", "n_words": "int"}
        return docs.where(F.lit(False)).select(id_col, *[F.lit(None).cast(k).alias(c) for c, k in kinds.items()])
    # 1. where shingles of items stand
    placed = cut(keyed, "id", "key").select("id", "key", "width", F.size("s").alias("m"), F.posexplode("s").alias("pos", "h"))
    hits = placed.join(F.broadcast(known) if small else known, ["width", "h"])
    spots = (hits.groupBy("key", "width", "size", "m")
             .agg(F.array_sort(F.collect_set("pos")).alias("p"), F.min("id").alias("id")))
    n = F.col("size") - F.col("width") + 1
    m = F.least(n, F.col("m"))
    spots = spots.select("key", "id", "width", "size", "p", n.alias("n"), m.alias("m"), F.col("m").alias("of"),
                         _needed(n, m, similarity).alias("need")).where(F.size("p") >= F.col("need"))
    # 2. windows with enough of them: those whose first such shingle is the i-th
    at = lambda i: F.get("p", i)
    low = lambda i: F.greatest(F.coalesce(at(i - 1), F.lit(-1)) + 1, at(i + F.col("need") - 1) - F.col("m") + 1, F.lit(0))
    high = lambda i: F.least(at(i), F.col("of") - F.col("m"))
    ranges = F.transform(F.sequence(F.lit(0), F.size("p") - F.col("need")), lambda i: F.struct(low(i).alias("a"), high(i).alias("b")))
    spots = staged(spots.select("key", "id", "width", "size", "n", "m", F.explode(ranges).alias("r"))
                   .where("r.a <= r.b").select("key", "id", "width", "size", "n", "m", F.explode(F.sequence("r.a", "r.b")).alias("start")),
                   "window-places")
    holders = staged(spots.select("key", "id").distinct(), "window-texts")
    texts = keyed.join(holders, (keyed["key"] == holders["key"]) & keyed["id"].eqNullSafe(holders["id"])).select(
        keyed["key"], keyed["text"]).dropDuplicates(["key"])
    windows = (spots.join(cut(texts, "key"), ["key", "width"])
               .select("key", "size", "n", "start", F.slice("s", F.col("start") + 1, F.col("m")).alias("s"))
               .withColumn("same", F.xxhash64("s")))
    windows = staged(windows, "windows")
    # 3. equal windows are taken once, and meet the items of their size
    own = windows.select("size", "n", "same", "s").dropDuplicates(["size", "same"])
    held = F.size("s")
    own = own.where(held >= _needed(F.col("n"), held, similarity))  # the others are too short for any item of their length
    own = staged(own.select("size", "n", "same", "s", let(F.col("s"), simhash).alias("fp")), "fingerprints")
    left = own.select("size", "same", F.col("fp").alias("f"), F.inline(blocks(F.col("fp"), ball=False)))
    right = items.select("size", "item_id", F.col("fp").alias("g"), F.inline(blocks(F.col("fp"), ball=True)))
    near = left.join(right, ["size", "block", "value"]).where(distance(F.col("f"), F.col("g")) <= radius)
    near = near.select("size", "same", "item_id").distinct()
    both = (near.join(own.select("size", "same", "s"), ["size", "same"])
            .join(items.select("item_id", "size", F.col("s").alias("t")), ["item_id", "size"]))
    shared = both.select("size", "same", "item_id", (F.size("s") + F.size("t")).alias("all"), _shared(F.col("t"), F.col("s")).alias("i"))
    found = shared.select("size", "same", "item_id", (F.col("i") / (F.col("all") - F.col("i"))).alias("similarity"))
    found = staged(found.where(F.col("similarity") >= similarity), "found")
    # 4. the best window of each text and item, for all documents with that text
    best = (windows.select("key", "size", "same", "start").join(found, ["size", "same"])
            .groupBy("key", "item_id").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "start", "size")).alias("b")))
    best = best.select("key", "item_id", (-F.col("b.s")).alias("similarity"), F.col("b.start").alias("start"), F.col("b.size").alias("n_words"))
    return keyed.select(F.col("id").alias(id_col), "key").join(staged(best, "best"), "key").drop("key")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents in which no item was found, with all their columns (a null id is compared like a value)."""
    bad = contaminated(docs, benchmark, id_col, text_col, **options).select(F.col(id_col).alias("__bad")).distinct()
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col("__bad")), "left_anti")


def op6_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """Every benchmark item found in every document."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_PLAIN = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"

#: Every window against every item that shares a shingle, without fingerprints (items and texts of five words or more).
ORACLE_OP6 = rf"""
WITH it AS (SELECT item_id, {_PLAIN} AS w FROM benchmark),
     items AS (SELECT item_id, w, len(w) AS size, len(w) - {SHINGLE_WORDS - 1} AS n FROM it WHERE len(w) >= {SHINGLE_WORDS}),
     ish AS (SELECT item_id, array_to_string(w[i:i + {SHINGLE_WORDS - 1}], ' ') AS h, count(*) AS c
             FROM (SELECT item_id, w, unnest(range(1, n + 1)) AS i FROM items) GROUP BY 1, 2),
     d AS (SELECT doc_id, {_PLAIN} AS w FROM documents),
     dsh AS (SELECT doc_id, len(w) - {SHINGLE_WORDS - 1} AS m, i - 1 AS pos, array_to_string(w[i:i + {SHINGLE_WORDS - 1}], ' ') AS h
             FROM (SELECT doc_id, w, unnest(range(1, len(w) - {SHINGLE_WORDS - 2})) AS i FROM d)),
     hit AS (SELECT doc_id, dsh.m, pos, h, item_id, ish.c, items.n, items.size
             FROM dsh JOIN ish USING (h) JOIN items USING (item_id)),
     st AS (SELECT DISTINCT doc_id, item_id, m, n, size, unnest(range(greatest(0, pos - n + 1), least(pos, greatest(m - n, 0)) + 1)) AS start FROM hit),
     inter AS (SELECT st.doc_id, st.item_id, st.start, st.size, least(st.n, st.m) + st.n AS both_sizes, hit.h, least(count(*), any_value(hit.c)) AS c
               FROM st JOIN hit ON hit.doc_id = st.doc_id AND hit.item_id = st.item_id AND hit.pos BETWEEN st.start AND st.start + st.n - 1
               GROUP BY 1, 2, 3, 4, 5, 6),
     sim AS (SELECT doc_id, item_id, start, size, sum(c)::DOUBLE / (any_value(both_sizes) - sum(c)) AS similarity
             FROM inter GROUP BY 1, 2, 3, 4),
     best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) AS r
              FROM sim WHERE similarity >= {SIMILARITY})
SELECT doc_id, item_id, similarity, start::INTEGER AS start, size::INTEGER AS n_words FROM best WHERE r = 1
"""
