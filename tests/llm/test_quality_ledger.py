import re

from llm_cases import odd_rows
from pyspark.sql import functions as F

from driftlog.llm import quality_ledger as q

WORD = re.compile("[^\x20\x09-\x0D]+")


def slow_measures(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(8)} if len(w) < 1000 else set()
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in q.SYMBOLS), sum("A" <= c <= "Z" for c in text), len(lines),
            len(lines) - len(set(lines)), len(covered), sum(a == b for a, b in zip(w, w[1:])))


def test_measures_match_brute_force(spark, odd_docs):
    extra = ["a b c d e f g h " * 3, "a b c d e f g h i a b c d e f g h", " ".join("abcdefgh"), "# $ %\n# $ %\n\n#", "SHOUT IT " * 20]
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(extra, 100)), "doc_id long, text string"))
    got = sorted((tuple(r) for r in q.ledger(docs).select("doc_id", *q.MEASURES).collect()), key=repr)
    rows = [(r[0], r[1]) for r in odd_rows()] + list(enumerate(extra, 100))
    assert got == sorted(((i, *slow_measures(t)) for i, t in rows), key=repr)


def test_bits_policies_and_ablations(odd_docs, no_docs):
    book = q.ledger(odd_docs).cache()
    rows = book.collect()
    names = [n for n, _ in q.RULES]
    for r in rows:
        for bit, (_, fails) in enumerate(q.RULES):
            assert bool(r.fail_bits >> bit & 1) == eval(fails.replace("100 *", "100*"), {}, r.asDict())
    for policy, rules in q.POLICIES.items():
        mask = q.mask_of(rules)
        kept = {(r.doc_id, r.kept) for r in q.with_verdict(book, policy).collect()}
        assert kept == {(r.doc_id, r.fail_bits & mask == 0) for r in rows}
        found = {r.rule: (r.rejected, r.rejected_without, r.only_this)
                 for r in q.ablations(book).where(F.col("policy") == policy).collect()}
        for rule in rules:
            bit = 1 << names.index(rule)
            assert found[rule] == (sum(bool(r.fail_bits & mask) for r in rows),
                                   sum(bool(r.fail_bits & mask & ~bit) for r in rows),
                                   sum(r.fail_bits & mask == bit for r in rows))
    book.unpersist()
    assert q.ledger(no_docs).count() == 0 and q.ablations(q.ledger(no_docs)).count() == 0


def test_kept_documents_are_unchanged(odd_docs):
    kept = q.keep_passing(odd_docs)
    assert kept.columns == odd_docs.columns and kept.dtypes == odd_docs.dtypes
    got = sorted(map(tuple, kept.collect()), key=repr)
    assert got and set(map(repr, got)) <= set(map(repr, odd_rows()))
    ids = {r[0] for r in got}
    assert {1, 2, 3, 9} <= ids and not ids & {4, 5, 6, 7, 8, 10}


def test_no_python_in_the_plan(spark, odd_docs):
    text = q.ledger(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", text)
