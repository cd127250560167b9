import random

import numpy as np
from llm_cases import odd_rows, union_find, words
from xxhash import xxh64_intdigest

from driftlog.llm import common
from driftlog.llm import line_dedup as lines
from driftlog.llm import relative_lz as lz


def slow_spans(rows, width):
    """Words of each row that a repeated window covers; rows in order of id (null first)."""
    seen, out = set(), []
    for _, text in rows:
        w = (text or "").encode().split()
        gone = set()
        for s in range(len(w) - width + 1):
            x = tuple(w[s:s + width])
            if x in seen:
                gone |= set(range(s, s + width))
            seen.add(x)
        out.append((len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return out


def span_rows():
    rnd = random.Random(9)
    passages = [words(rnd, n, 500) for n in (25, 60, 200)]
    rows = []
    for i in range(60):
        w = words(rnd, rnd.randrange(0, 120), 40 if i % 7 == 0 else 500)
        for p in rnd.sample(passages, rnd.randrange(3)):
            a = rnd.randrange(3)
            at = rnd.randrange(len(w) + 1)
            w[at:at] = p[a:len(p) - rnd.randrange(3)]
        rows.append((i, " ".join(w)))
    rows += [(100, rows[5][1]), (101, "r " * 70), (102, "r " * 70), (103, None), (104, ""), (105, " ".join(passages[2]))]
    return rows


def test_removed_words_match_brute_force(spark):
    rows = span_rows()
    want = {r[0]: x for r, x in zip(rows, slow_spans(rows, 20))}
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, block string, n_words int")
    for block_bytes in (700, 1 << 24):
        out = lz.without_duplicate_spans(frame.repartition(3), block_bytes=block_bytes).collect()
        assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in out} == want and len(out) == len(rows)
    assert sum(x[1] for x in want.values()) > 1000


def test_factors_point_at_their_source(spark):
    rows = span_rows()
    text = {i: (t or "").split() for i, t in rows}
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    covered = {}
    for r in lz.duplicate_spans(frame, block_bytes=900).collect():
        assert r.length >= 20 and (r.source_id, r.source_start) < (r.doc_id, r.start)
        assert text[r.doc_id][r.start:r.start + r.length] == text[r.source_id][r.source_start:r.source_start + r.length]
        covered.setdefault(r.doc_id, set()).update(range(r.start, r.start + r.length))
    assert {i: len(x) for i, x in covered.items()} == {r[0]: x[1] for r, x in zip(rows, slow_spans(rows, 20)) if x[1]}


def test_spans_of_odd_rows(odd_docs, no_docs):
    rows = sorted(((r[0], r[1]) for r in odd_rows()), key=lambda r: (r[0] is not None, r[0] or 0))
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in lz.without_duplicate_spans(odd_docs, block_bytes=10_000).collect()), key=repr)
    assert got == sorted(((r[0], x[0], x[1]) for r, x in zip(rows, slow_spans(rows, 20))), key=repr)
    assert lz.without_duplicate_spans(no_docs).count() == 0 and lz.duplicate_spans(no_docs).count() == 0


def slow_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_edit_distance():
    rnd = random.Random(10)
    for _ in range(400):
        a, b = ("".join(rnd.choice("abé") for _ in range(rnd.randrange(0, 80))) for _ in range(2))
        if rnd.random() < 0.5:
            b = a[:5] + b[:3] + a[7:]
        assert lines.edit_distance(a, b) == slow_distance(a, b)


def line_rows():
    rnd = random.Random(11)
    base = [" ".join(words(rnd, rnd.randrange(1, 60))) for _ in range(40)]
    rows = []
    for i in range(50):
        some = rnd.sample(base, 4)
        for k in range(4):
            w = some[k].split()
            if rnd.random() < 0.6:
                w[rnd.randrange(len(w))] = rnd.choice(["edited", "w1x", w[0].upper() + "!"])
            some[k] = " ".join(w)
        rows.append((i, "\n".join([*some, "", "--", "The same line everywhere"])))
    # one fingerprint, other words: the same words in another order fail the edit similarity
    w = words(rnd, 30)
    for i in range(60, 66):
        rnd.shuffle(w)
        rows.append((i, " ".join(w)))
    return rows + [(90, None), (91, ""), (92, "\n\n"), (None, base[0] + "\n" + base[1])]


def slow_lines(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    first = {}
    for d, (_, text) in enumerate(order):
        for k, x in enumerate((text or "").split("\n")):
            if lines.normalised(x):
                first.setdefault(lines.normalised(x), (d, k))
    keys = list(first)
    prints = lines.fingerprints(keys)
    links, failed = [], 0
    for a in range(len(keys)):
        for b in range(a):
            if int(lines.distances(prints[a], prints[b:b + 1])[0]) <= lines.RADIUS:
                if lines.similar(keys[a], keys[b]):
                    links.append((a, b))
                else:
                    failed += 1
    root = union_find(len(keys), links)
    best = {}
    for k, x in zip(keys, root):
        best[x] = min(best.get(x, (10 ** 9, 0)), first[k])
    stay = set(best.values())
    out = []
    for d, (i, text) in enumerate(order):
        all_lines = (text or "").split("\n")
        kept = [x for k, x in enumerate(all_lines) if not lines.normalised(x) or (d, k) in stay]
        out.append((i, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return out, len(links), failed


def test_lines_match_brute_force(spark):
    rows = line_rows()
    want, linked, failed = slow_lines(rows)
    assert linked > 30 and failed > 3
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, line string, block int")
    for block_bytes in (3000, 1 << 24):
        got = [tuple(r) for r in lines.dedup_lines(frame.repartition(2), block_bytes=block_bytes).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)


def test_documents_keep_their_columns(spark, odd_docs, no_docs):
    got = lines.without_repeated_lines(odd_docs, length_col="n")
    assert got.columns == odd_docs.columns and got.dtypes == odd_docs.dtypes
    rows = {r.doc_id: r for r in got.where("doc_id is not null").collect()}
    assert rows[11].text == "line a b c d e f\n\nother line here" and rows[11].n == len(rows[11].text)
    assert 2 not in rows and 8 not in rows  # nothing of them is left
    assert rows[4].text == "" and rows[5].text == "" and rows[7].text == "one"
    assert lines.without_repeated_lines(no_docs).count() == 0 and lines.dedup_lines(no_docs).count() == 0


def changed_lines(length, changes, n=60):
    """Pairs of lines with so many words replaced, as a text per line, and those whose edit similarity is 0.8 or more."""
    rnd = random.Random(100 * length + changes)
    rows, near = [], 0
    for k in range(n):
        w = words(rnd, length, 3000)
        v = list(w)
        for at in rnd.sample(range(length), changes):
            v[at] = f"w{rnd.randrange(3000)}x"
        rows += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(v))]
        near += lines.similar(rows[-1][1], rows[-2][1])
    return rows, near


def test_recall_against_edit_similarity_alone(spark):
    """No radius in the brute force: short and long lines with a few words replaced."""
    rows, near = [], 0
    for length, changes in ((10, 1), (12, 1), (20, 1), (20, 2), (40, 2), (60, 6)):
        some, count = changed_lines(length, changes)
        rows += [(len(rows) + k, text) for k, (_, text) in enumerate(some)]
        near += count
    # one template of many lines, and short lines that differ in one character
    rnd = random.Random(13)
    base = words(rnd, 14)
    rows += [(10_000 + k, " ".join([*base[:6], f"v{k}y", *base[7:]])) for k in range(150)]
    near += 149
    rows += [(20_000, "abcdefgh ijk"), (20_001, "abcdefgx ijk")]
    near += 1
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    removed = sum(r.n_removed for r in lines.dedup_lines(frame, block_bytes=5000).collect())
    assert near > 400 and 0.99 * near <= removed <= near


def test_blocks_find_all_lines_within_three_bits():
    """Also where a block value is split: the lines that share it meet by one of the other bits' blocks."""
    rnd = np.random.default_rng(6)
    one = rnd.integers(0, 1 << 16, (3000, lines.PARTS), np.uint16)
    two = one.copy()
    for k in range(len(one)):
        for bit in rnd.choice(128, k % lines.PIGEONS, replace=False):
            two[k, bit // 16] ^= np.uint16(1 << bit % 16)
    a, b = lines.block_keys(one), lines.block_keys(two)
    assert (a == b).any(axis=1).all() and not (a[1:] == a[:-1]).any()
    row, block = np.nonzero(a == b)
    finer = [lines.finer_keys(x[row], block, a[row, block]) for x in (one, two)]
    assert (finer[0] == finer[1]).any(axis=1).all()


def test_no_run_is_dropped_for_its_many_lines(spark):
    """Each line has runs that far more than ``FULL`` lines share, and a partner that is like it but shares no rarer run."""
    rnd = random.Random(23)
    rows, near = [], 0
    common = [words(rnd, lines.RUN, 40) for _ in range(3)]
    for k in range(120):  # few words: the radius does not bind them, their fingerprints are far apart
        w = ["".join(rnd.choice("bcdfghjklmnpqrstvwxz") for _ in range(9)) for _ in range(4)]
        v = [x[:4] + rnd.choice("aeiou") + x[5:] for x in w]
        for text in ((*common[0], *w), (*common[0], *v)):
            rows.append((len(rows), " ".join(text)))
        near += lines.similar(rows[-1][1], rows[-2][1])
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    removed = sum(r.n_removed for r in lines.dedup_lines(frame, block_bytes=4000).collect())
    assert near == 120 and removed == near


def test_tiles_hold_every_pair_of_a_key():
    rnd = np.random.default_rng(8)
    hashes = rnd.integers(0, 1 << 63, 200, np.uint64)
    for parts in (1, 2, 3, 7):
        keys, of = lines.tiles(np.full(200, 99, np.uint64), hashes, np.full(200, parts, np.int64))
        together = np.eye(200, dtype=bool)
        for key in np.unique(keys):
            here = of[keys == key]
            together[np.ix_(here, here)] = True
            assert len(set((hashes[here] % np.uint64(parts)).tolist())) <= 2
        assert together.all() and len(keys) == 200 * max(1, parts - 1)


def test_edit_distances_of_many_pairs():
    """Pairs of every length and alphabet at once, against the one-by-one form; the word bound never below the distance."""
    rnd = random.Random(17)
    pairs = [("", ""), ("", "abc"), ("abc", ""), ("a" * 64, "a" * 65), ("ab" * 64, "ba" * 64), ("x" * 300, "y" * 10)]
    for _ in range(400):
        alphabet = rnd.choice(["ab", "abcdefghij klm", "日本語é𝔘 z"])
        a = "".join(rnd.choice(alphabet) for _ in range(rnd.choice([1, 5, 63, 64, 65, 128, 200])))
        b = list(a)
        for _ in range(rnd.randrange(12)):
            at = rnd.randrange(len(b) + 1)
            b[at:at + rnd.randrange(2)] = rnd.choice(alphabet) * rnd.randrange(2)
        pairs.append((a, "".join(b) if rnd.random() < 0.8 else "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(150)))))
    want = [lines.edit_distance(a, b) for a, b in pairs]
    assert lines.edit_distances(pairs).tolist() == want
    assert all(lines.word_bound(a, b) >= d for (a, b), d in zip(pairs, want))
    for least in (0.5, 0.8, 0.95):
        assert lines.all_similar(pairs, least) == [lines.similar(a, b, least) for a, b in pairs]
    assert lines.all_similar([]) == []


def test_pairs_that_fail_are_not_rows(spark, monkeypatch):
    """Lines of the same words in another order share all block keys and fail; some have a partner that only a pair between parts finds."""
    rnd = random.Random(29)
    w = words(rnd, 40)
    rows = []
    for _ in range(90):
        rnd.shuffle(w)
        rows.append((len(rows), " ".join(w)))
    for k in range(0, 90, 3):
        v = rows[k][1].split()
        v[5:7] = v[6:4:-1]
        rows.append((len(rows), " ".join(v)))
    sizes, staged = {}, lines.staged

    def counted(frame, name):
        out = staged(frame, name)
        sizes[name] = sizes.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(lines, "staged", counted)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id for r in lines.dedup_lines(frame, block_bytes=4000).collect() if r.n_removed}
    assert got == set(range(90, 120))
    assert max(sizes.values()) < 4 * len(rows)


def test_tiles_have_each_pair_once():
    rnd = np.random.default_rng(9)
    hashes = rnd.integers(0, 1 << 63, 150, np.uint64)
    for n in (1, 2, 3, 7):
        parts = np.full(150, n, np.int64)
        keys, of = lines.tiles(np.full(150, 99, np.uint64), hashes, parts)
        side, own = lines.sides(hashes, parts)
        seen = np.zeros((150, 150), int)
        for key in np.unique(keys):
            here = np.flatnonzero(keys == key)
            for x in here:
                for y in here:
                    seen[of[x], of[y]] += bool(x != y and (own[x] or side[x] != side[y]))
        assert (seen + np.eye(150, dtype=int) == 1).all()


def test_long_pairs_settled_by_their_heads():
    rnd = random.Random(31)
    pairs = []
    for _ in range(160):
        a = "".join(rnd.choice("abcd ") for _ in range(rnd.randrange(180, 260)))
        b = list(a)
        for _ in range(rnd.choice([5, 30, 45, 60])):
            b[rnd.randrange(len(b))] = rnd.choice("abcd")
        pairs.append((a, "".join(b) if rnd.random() < 0.6 else "".join(rnd.choice("abcd ") for _ in range(len(a)))))
    want = [lines.similar(a, b) for a, b in pairs]
    assert 40 < sum(want) < 120 and lines.all_similar(pairs) == want
    heads = [("", "abc"), ("ab", ""), *((a[:rnd.randrange(90)], b[:rnd.randrange(130)]) for a, b in pairs[:12])]
    assert lines.edit_distances(heads, True).tolist() == [min(slow_distance(a, b[:k]) for k in range(len(b) + 1)) for a, b in heads]


def test_keys_fill_their_buckets_evenly():
    """Runs are the smallest hashes of many; as keys they are spread, so that no bucket holds much more than its share."""
    rnd = random.Random(37)
    texts = ["\n".join(" ".join(words(rnd, 60, 5000)) for _ in range(20)).encode() for _ in range(40)]
    block = lines._Block(lines._encode(list(range(len(texts))), texts, [()] * len(texts))[0])
    held = np.diff(lines.bucket_edges(np.sort(block.runs), 16))
    assert held.sum() == 800 * (lines.KEYS + lines.PIGEONS) and held.max() < 1.5 * held.mean()


def test_pairs_within_their_limit():
    """Just at the distance and just below it, also where the columns near the diagonal are few, against the one-by-one form."""
    rnd = random.Random(41)
    pairs = []
    for _ in range(500):
        alphabet = rnd.choice(["ab", "abcdefghij klm", "日本語é𝔘 z", "".join(chr(300 + k) for k in range(200))])
        a = "".join(rnd.choice(alphabet) for _ in range(rnd.choice([1, 2, 63, 64, 65, 128, 129, 300, 700])))
        b = list(a)
        for _ in range(1 + int(rnd.choice([0, 0.05, 0.2, 0.5]) * len(a))):
            at = rnd.randrange(len(b) + 1)
            b[at:at + rnd.randrange(2)] = rnd.choice(alphabet) * rnd.randrange(2)
        cut = rnd.randrange(1 + len(a) // 8)
        b = "".join(b[cut:] + b[:cut]) or "a"
        pairs += [(a, b), (b, a)]
    far = np.array([lines.edit_distance(a, b) for a, b in pairs])
    assert lines.within(pairs, far.astype(float)).all()
    some = [k for k, (a, b) in enumerate(pairs) if far[k] > max(1, abs(len(a) - len(b)))]
    assert len(some) > 300 and not lines.within([pairs[k] for k in some], far[some] - 1.0).any()


def test_each_pair_is_compared_once():
    """Only where the lowest key that both lines have is; and of pairs that wait, the nearest of each part first."""
    rnd = np.random.default_rng(43)
    keys = np.zeros((60, 10), np.uint64)
    for row in keys:
        n = rnd.integers(1, 11)
        row[:n] = np.sort(rnd.choice(25, n, replace=False) + 1)
    held = {k: [x for x in range(60) if k in keys[x]] for k in range(1, 26)}
    seen = np.zeros((60, 60), int)
    for key, some in held.items():
        x, y = (np.array(z) for z in zip(*[(x, y) for x in some for y in some if x < y]))
        ok = lines.lowest_shared(keys, x, y, np.full(len(x), key, np.uint64))
        seen[x[ok], y[ok]] += 1
    for x in range(60):
        for y in range(x + 1, 60):
            assert seen[x, y] == bool(set(keys[x]) & set(keys[y]) - {0})
    one, two = np.array([3, 3, 5, 7, 3]), np.array([5, 7, 7, 8, 8])
    assert lines.nearest(one, two, 1).tolist() == [True, True, False, True, False]
    assert lines.nearest(one, two, 2).tolist() == [True, True, True, True, True]
    parts = lines._Parts(6)
    assert parts.join([(4, 5), (1, 4), (5, 1), (0, 2)]) == [(4, 5), (1, 4), (0, 2)] and parts.root.tolist() == [0, 1, 0, 3, 1, 1]


def test_whole_texts_are_normalised_as_their_lines():
    texts = ["", "\n\n", "A b_C\n\n ...\nd\te ", "İstanbul ΣΑΣ σας\nx", "É ß ẞ ǅ 日本 語\x1f1²³½ Ⅷ\n_", "w " * 40 + "x" * 33 + "\r\n" + "y" * 32, "ab cd"]
    plain = [lines.normalised(x) for t in texts for x in t.split("\n")]
    places, some = lines.plain_lines(texts)
    assert places.tolist() == [k for k, x in enumerate(plain) if x] and some == [x for x in plain if x]
    counts, hashes = lines.word_hashes(some)
    want = [xxh64_intdigest(w.encode(), 42) for x in some for w in x.split()]
    assert counts.tolist() == [len(x.split()) for x in some] and hashes.tolist() == want
    for x in some:  # a majority of the words' bits
        both = [(h, int(lines.mixed(np.array([h ^ 0x9E3779B97F4A7C15], np.uint64))[0])) for h in (xxh64_intdigest(w.encode(), 42) for w in x.split())]
        bits = [sum(2 * sum(p[k] >> b & 1 for p in both) > len(both) and 1 << b for b in range(64)) for k in range(2)]
        assert lines.fingerprints([x]).view("<u8")[0].tolist() == bits


def test_a_reused_worker_lets_go_of_its_tokenizers():
    common._TOKENIZERS["x"] = object()
    lines._encode([1], [b"some line"], [()])
    assert not common._TOKENIZERS
