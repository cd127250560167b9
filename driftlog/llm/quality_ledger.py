"""Quality rules as a bitmask ledger (DataFrame functions only).

``ledger`` measures every text once and stores the measurements and one failure
bit per rule.  A policy is a version name and a mask of the rules it applies, so
a verdict, a new policy version or an ablation is a bitwise operation on the
ledger; texts are never read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlog.llm.common import SPACES, let, table, words_of

WINDOW_WORDS = 8
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Rule name -> condition on the measurements under which a text fails; bit = place in this list.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "100 * n_symbols > 10 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 15 * n_words"),
    ("upper_case", "100 * n_upper > 40 * word_chars"),
    ("same_word_again", "100 * n_same_again > 50 * n_words"),
]
BASE_RULES = ("few_words", "repeated_windows")


def mask_of(rules) -> int:
    names = [name for name, _ in RULES]
    return sum(1 << names.index(r) for r in rules)


#: Policy version -> rules applied.
POLICIES: dict[str, tuple[str, ...]] = {
    "1": BASE_RULES,
    "2": (*BASE_RULES, "symbols", "repeated_lines", "short_words", "long_words"),
    "3": tuple(name for name, _ in RULES),
}
CURRENT_POLICY = "3"


def _repeated_positions(sorted_pairs: Column) -> Column:
    """Sorted places of values that occur twice or more among sorted (value, place) pairs."""
    n = F.size(sorted_pairs)
    value = lambda j: F.get(sorted_pairs, j)["x"]
    twice = F.filter(F.sequence(F.lit(0), n - 1), lambda j: F.coalesce(
        (value(j) == value(j + 1)) | (value(j) == value(j - 1)), value(j) == value(j + 1),
        value(j) == value(j - 1), F.lit(False)))
    return F.array_sort(F.transform(twice, lambda j: F.get(sorted_pairs, j)["i"]))


def _covered(places: Column, width: int) -> Column:
    """Number of places covered by windows of ``width`` that begin at the sorted ``places``."""
    steps = F.zip_with(F.slice(places, 2, F.size(places)), F.slice(places, 1, F.size(places) - 1),
                       lambda b, a: F.least(b - a, F.lit(width)))
    return F.aggregate(steps, F.lit(width), lambda total, x: total + x)


def _repeat_words(hashes: Column, width: int = WINDOW_WORDS) -> Column:
    """Words in windows of ``width`` words found twice or more; ``hashes``: the words' hashes."""
    windows = F.when(F.size(hashes) > width, F.transform(
        F.sequence(F.lit(1), F.size(hashes) - (width - 1)), lambda i: F.xxhash64(F.slice(hashes, i, width)))
    ).otherwise(F.array().cast("array<bigint>"))

    def count(w: Column) -> Column:
        pairs = F.array_sort(F.transform(w, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        # most texts repeat no window: one pass over a hash set tells
        return F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(
            let(let(pairs, _repeated_positions), lambda p: _covered(p, width)))

    return let(windows, count)


def _measures(text: Column, words: Column) -> list[Column]:
    letters = F.translate(text, SPACES, "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    line_counts = let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d")))

    def word_counts(h: Column) -> Column:
        again = F.zip_with(F.slice(h, 2, F.size(h)), F.slice(h, 1, F.greatest(F.size(h) - 1, F.lit(0))),
                           lambda b, a: b == a)
        return F.struct(_repeat_words(h).alias("repeat"), F.size(F.filter(again, lambda x: x)).alias("again"))

    return [
        F.size(words).cast("long").alias("n_words"),
        let(letters, lambda x: F.struct(
            F.length(x).cast("long").alias("chars"),
            (F.length(x) - F.length(F.translate(x, SYMBOLS, ""))).cast("long").alias("symbols"),
            (F.length(x) - F.length(F.translate(x, UPPER, ""))).cast("long").alias("upper"))).alias("_c"),
        line_counts.alias("_l"),
        let(F.transform(words, lambda x: F.xxhash64(x)), word_counts).alias("_w"),
    ]


MEASURES = ("n_words", "word_chars", "n_symbols", "n_upper", "n_lines", "n_dup_lines", "n_repeat_words", "n_same_again")


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, the measurements and ``fail_bits`` (one bit per rule) of every row.

    Windows are compared by a 64-bit hash of their eight words' hashes, within
    one text.  Null and empty texts measure zero and fail ``few_words``; repeated
    rows and null ids are rows like any other; extra columns are ignored; an
    empty table gives an empty ledger.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col), F.inline(F.transform(
        F.array(F.struct(text.alias("t"), words_of(F.col(text_col).cast("string")).alias("w"))),
        lambda x: F.struct(*_measures(x["t"], x["w"])))))
    measured = rows.select(
        id_col, "n_words", F.col("_c.chars").alias("word_chars"), F.col("_c.symbols").alias("n_symbols"),
        F.col("_c.upper").alias("n_upper"), F.col("_l.n").cast("long").alias("n_lines"),
        (F.col("_l.n") - F.col("_l.d")).cast("long").alias("n_dup_lines"),
        F.col("_w.repeat").cast("long").alias("n_repeat_words"), F.col("_w.again").cast("long").alias("n_same_again"))
    bits = " + ".join(f"if({fails}, {1 << bit}L, 0L)" for bit, (_, fails) in enumerate(RULES))
    return measured.withColumn("fail_bits", F.expr(bits))


def with_verdict(book: DataFrame, policy: str = CURRENT_POLICY) -> DataFrame:
    """The ledger with ``kept``: no failure bit inside the policy's mask."""
    return book.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(mask_of(POLICIES[policy]))) == 0)


def ablations(book: DataFrame) -> DataFrame:
    """What each rule of each policy decides: ``policy, rule, rejected, rejected_without, only_this``.

    The ledger is counted by its bits first (at most ``2 ** rules`` rows); every
    figure then comes from bitwise tests on those counts.
    """
    counts = book.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    tests = [F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"), F.lit(mask_of(rules)).cast("long").alias("mask"),
                      F.lit(mask_of([r])).cast("long").alias("bit")) for p, rules in POLICIES.items() for r in rules]
    each = counts.select("fail_bits", "n", F.inline(F.array(*tests)))
    hit = F.col("fail_bits").bitwiseAND(F.col("mask"))
    without = hit.bitwiseAND(F.bitwise_not("bit"))
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    return each.groupBy("policy", "rule").agg(
        total(hit != 0).alias("rejected"), total(without != 0).alias("rejected_without"),
        total((hit != 0) & (without == 0)).alias("only_this"))


def keep_passing(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 policy: str = CURRENT_POLICY) -> DataFrame:
    """The rows that pass the policy, with all their columns (nothing is joined or shuffled)."""
    kept = ledger(docs.select(F.struct("*").alias("__row"), F.col(text_col).alias("__text")), "__row", "__text")
    return with_verdict(kept, policy).where("kept").select("__row.*")


def op5_quality_ledger(spark, sf_dir: str) -> DataFrame:
    """Measurements, base failure and verdict of the current policy for every document."""
    book = with_verdict(ledger(table(spark, sf_dir, "documents")))
    base = F.col("fail_bits").bitwiseAND(F.lit(mask_of(BASE_RULES))) != 0
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
        (F.col("kept") & ~base).alias("kept"), "n_upper", "n_lines", "n_same_again", "fail_bits")


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_FAILS = " + ".join(f"CASE WHEN {fails} THEN {1 << bit} ELSE 0 END" for bit, (_, fails) in enumerate(RULES))

ORACLE_OP5 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w,
                  row_number() OVER () AS r FROM documents),
     line AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
     l AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM line
           WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
     p AS (SELECT r, w, unnest(range(1, len(w) - {WINDOW_WORDS - 2})) AS i FROM d),
     win AS (SELECT r, i, array_to_string(w[i:i + {WINDOW_WORDS - 1}], ' ') AS s FROM p),
     twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM win) WHERE n > 1),
     cover AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(0, {WINDOW_WORDS}) t(k) GROUP BY r),
     m AS (SELECT doc_id, len(w)::BIGINT AS n_words,
                  length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
                  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                  coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
                  coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
                  length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_upper,
                  coalesce(n_lines, 0)::BIGINT AS n_lines,
                  len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1]))::BIGINT AS n_same_again
           FROM d LEFT JOIN l USING (r) LEFT JOIN cover USING (r)),
     f AS (SELECT *, ({_FAILS})::BIGINT AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (fail_bits & {mask_of(BASE_RULES)}) <> 0 AS base_failed,
       (fail_bits & {mask_of(POLICIES[CURRENT_POLICY])}) = 0 AS kept,
       n_upper, n_lines, n_same_again, fail_bits
FROM f
"""
