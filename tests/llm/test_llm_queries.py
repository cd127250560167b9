"""The registered queries against their SQL, and the pipeline against brute force."""

import duckdb
import pytest
from llm_cases import union_find

import corpus_pipeline
from driftlog.llm import line_dedup, packing, queries
from driftlog.llm.common import id_encoder, default_tokenizer, staged, table

SMALL = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "embeddings")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_query_matches_its_sql(spark, duck, key):
    df = queries.QUERIES[key](spark, SMALL)
    res = duck.execute(queries.ORACLE[key])
    names = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(repr, map(tuple, df.select(*names).collect()))) == sorted(map(repr, res.fetchall()))


#: Not a row per document: phrases, and negatives of anchors.
OTHER_ROWS = ("op11_phrase_collocations", "op13_hard_negatives")


@pytest.mark.parametrize("key", sorted(set(queries.QUERIES) - set(OTHER_ROWS)))
def test_a_row_per_document(spark, key):
    rows = queries.QUERIES[key](spark, SMALL)
    source, column = ("pages", "page_id") if key.startswith("op3") else ("documents", "doc_id")
    ids = {r[0] for r in table(spark, SMALL, source).select(column).collect()}
    found = [r[0] for r in rows.select(column).collect()]
    if key.startswith(("op6", "op7")):
        assert set(found) <= ids
    else:
        assert sorted(found) == sorted(ids)


def test_each_operator_has_one_query():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))


def test_stages(spark):
    """Each stage on what the one before kept, checked against a plain reading of the texts."""
    from test_decontaminate import grams, similarity, slow_words
    from test_quality_ledger import slow_measures
    from test_simhash_dedup import slow_fingerprint

    docs = table(spark, SMALL, "documents")
    columns = docs.columns
    outs = [docs]
    for name, stage in corpus_pipeline.STAGES:
        outs.append(staged(stage(spark, outs[-1], SMALL), name))
        if name != "packing":
            assert outs[-1].columns == columns
    rows = [{r.doc_id: r for r in x.collect()} for x in outs[:5]]
    # quality rules
    kept = set()
    for i, r in rows[0].items():
        n, chars, symbols, upper, n_lines, dup, repeat, again = slow_measures(r.text)
        if not (n < 20 or 100 * repeat > 30 * n or 10 * symbols > n or 2 * dup > n_lines or chars < 2 * n or chars > 15 * n
                or 100 * upper > 40 * chars or 2 * again > n):
            kept.add(i)
    long = {i for i, r in rows[0].items() if len(r.text.split()) >= 1000}  # too long for the slow count of windows
    assert set(rows[1]) - long == kept - long and len(kept) > 100
    assert all(rows[1][i] == rows[0][i] for i in rows[1])
    # lines
    first, texts = {}, {i: rows[1][i].text for i in sorted(rows[1])}
    for i, t in texts.items():
        for k, x in enumerate(t.split("\n")):
            first.setdefault(line_dedup.normalised(x), (i, k))
    first.pop("", None)
    keys = list(first)
    prints = line_dedup.fingerprints(keys)
    links = [(a, int(b)) for a in range(len(keys)) for b in (line_dedup.distances(prints[a], prints[:a]) <= line_dedup.RADIUS).nonzero()[0]
             if line_dedup.similar(keys[a], keys[int(b)])]
    best = {}
    for k, root in zip(keys, union_find(len(keys), links)):
        best[root] = min(best.get(root, (1 << 60, 0)), first[k])
    stay = set(best.values())
    want = {}
    for i, t in texts.items():
        left = [x for k, x in enumerate(t.split("\n")) if not line_dedup.normalised(x) or (i, k) in stay]
        if any(map(line_dedup.normalised, left)):
            want[i] = "\n".join(left)
    assert {i: r.text for i, r in rows[2].items()} == want
    assert all(r.n_chars == len(r.text) and r.lang == rows[0][i].lang for i, r in rows[2].items())
    # near copies
    ids = sorted(want)
    prints = [slow_fingerprint(want[i]) for i in ids]
    root = union_find(len(ids), [(a, b) for a in range(len(ids)) for b in range(a) if bin(prints[a] ^ prints[b]).count("1") <= 3])
    assert set(rows[3]) == {ids[x] for x in set(root)}
    # benchmark items
    items = [slow_words(r.text) for r in table(spark, SMALL, "benchmark").collect()]
    known = {g for t in items for g in grams(t, 5)}
    bad = set()
    for i in rows[3]:
        w = slow_words(want[i])
        if known.intersection(grams(w, 5)):
            bad |= {i for t in items for s in range(max(1, len(w) - len(t) + 1))
                    if similarity(grams(w[s:s + len(t)], 5), grams(t, 5)) >= 0.8}
    assert set(rows[4]) == set(rows[3]) - bad
    # packing
    order = sorted(rows[4])
    encoded = id_encoder(default_tokenizer()).encode_all([want[i] for i in order])
    sizes = {i: len(x) // 4 + 1 for i, x in zip(order, encoded)}
    packed = outs[5].collect()
    assert sum(r.length for r in packed) == sum(sizes.values()) and {r.doc_id: r.doc_tokens for r in packed} == sizes
    assert max(r.offset + r.length for r in packed) <= packing.CAPACITY


def test_pipeline_of_nothing(spark):
    docs = table(spark, SMALL, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0
