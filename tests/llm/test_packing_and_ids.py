import random
import zlib

import numpy as np
import pytest
from llm_cases import odd_rows
from tokenizers import Tokenizer

from driftlog.llm import common, packing, repair_ids


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(common.default_tokenizer())


def ids_of(tokenizer, text, end):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_encoder_equals_the_library(tokenizer, monkeypatch):
    rnd = random.Random(3)
    parts = ["a", "B", "é", ".", ",", " ", "  ", "\n", "\t", "1", "'", "s", " ", "<|endoftext|>", "!", "日", "\x1c", "\x85"]
    texts = ["", " ", "a\nb c", "a \n b", "don't we'll.", " lead", "trail "]
    texts += ["".join(rnd.choice(parts) for _ in range(rnd.randrange(14))) for _ in range(1500)]
    monkeypatch.setattr(common, "CACHE_PIECES", 200)
    monkeypatch.setattr(common, "CHUNK_CHARS", 500)
    encoder = common.IdEncoder(common.default_tokenizer())
    for text, raw in zip(texts, encoder.encode_all(texts)):
        assert raw == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def check_pieces(rows, got, tokenizer, capacity):
    want = {}
    for r in rows:
        want.setdefault(r[0], []).append(ids_of(tokenizer, r[1], packing.END_ID))
    total = sum(len(x) for v in want.values() for x in v)
    assert sum(r.length for r in got) == total
    for r in got:
        whole = [x for x in want[r.doc_id] if len(x) == r.doc_tokens]
        assert any(zlib.crc32(x[r.start:r.start + r.length].tobytes()) == r.ids_crc32 for x in whole)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spots in places.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places), total


def test_every_id_is_packed_once(odd_docs, tokenizer):
    rows = odd_rows()
    for capacity, group in ((64, 16), (2048, 1024)):
        got = packing.pack(odd_docs, capacity=capacity, group_pieces=group, piece_tokens=capacity // 4).collect()
        check_pieces(rows, got, tokenizer, capacity)


def test_padding_is_small():
    rnd = random.Random(5)
    sizes = [n for t in range(500) for _, n in packing.cuts(int(rnd.lognormvariate(6.5, 1)) + 1) if n != packing.CAPACITY]
    windows = packing.pack_group(sizes)
    assert sorted(i for w in windows for i in w) == list(range(len(sizes)))
    assert max(sum(sizes[i] for i in w) for w in windows) <= packing.CAPACITY
    assert len(windows) * packing.CAPACITY < 1.03 * sum(sizes) + packing.CAPACITY


def test_differencing_balances():
    rnd = random.Random(6)
    for _ in range(30):
        sizes = [rnd.randrange(1, 100) for _ in range(rnd.randrange(0, 60))]
        m = rnd.randrange(1, 9)
        sums = np.bincount(packing.difference(sizes, m), weights=sizes, minlength=m) if sizes else np.zeros(m)
        assert sums.sum() == sum(sizes) and sums.max() - sums.min() <= max(sizes, default=0)


def test_windows_rise_when_the_capacity_is_exceeded():
    assert len(packing.pack_group([6, 6, 6], 10)) == 3


def test_nothing_to_pack(no_docs):
    assert packing.pack(no_docs).count() == 0


def test_shards_round_trip():
    rnd = random.Random(7)
    cases = [[], [5], [7] * 300, [1, 2] * 500 + list(range(70_000)), [rnd.choice([3, 4, 5, 6]) for _ in range(5000)]]
    for ids in cases:
        x = np.array(ids, "<u4")
        cut = sorted({rnd.randrange(len(ids) + 1) for _ in range(9)} | {len(ids)})
        ends = np.array([cut[0], *cut])
        data = repair_ids.pack_shard([None, *range(len(cut))], x, ends)
        shard = repair_ids.Shard(data)
        assert (shard.expand(shard.seq) == x).all()
        starts = np.concatenate([[0], ends[:-1]])
        for k in range(len(ends)):
            whole = x[starts[k]:ends[k]]
            assert (shard.ids(k) == whole).all()
            for _ in range(5):
                a, n = rnd.randrange(len(whole) + 1), rnd.randrange(20)
                assert (shard.ids(k, a, n) == whole[a:a + n]).all()
    assert len(shard.rules) and len(shard.seq) < len(x) / 2


def test_rules_do_not_cross_documents():
    x = np.array([1, 2] * 200, "<u4")
    shard = repair_ids.Shard(repair_ids.pack_shard(list(range(400)), x, np.arange(1, 401)))
    assert len(shard.rules) == 0 and len(shard.seq) == 400


def test_corpus_reads_back(odd_docs, no_docs, tokenizer, monkeypatch):
    got = [tuple(r) for r in repair_ids.encode_corpus(odd_docs).collect()]
    rows = sorted(odd_rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    by_id, at = {}, 0
    for r in sorted(got, key=lambda r: r[1]):
        assert r[1] == at
        at += r[2]
        by_id.setdefault(r[0], []).append(r[2:])
    assert [r[0] for r in sorted(got, key=lambda r: r[1])] == [r[0] for r in rows]
    for i, found in by_id.items():
        want = [ids_of(tokenizer, r[1], repair_ids.END_ID) for r in rows if r[0] == i]
        assert sorted(found) == sorted((len(x), zlib.crc32(x.tobytes())) for x in want)
    assert repair_ids.encode_corpus(no_docs).count() == 0
