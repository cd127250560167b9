"""Language-model scores by a hierarchical Pitman-Yor model of word pairs.

Every word is a context restaurant; its customers are the words that follow it.
All context restaurants share one parent, the restaurant of single words, whose
customers are their tables, and whose own base is uniform over the known words
and one unknown word.  Seating arrangements are sampled by Gibbs, a cell at a
time: all its customers are seated anew by drawing its number of tables from the
distribution that moving them one by one for ever would lead to (``draw_tables``).
Predictive probabilities are averaged over the samples after burn-in.

Customers of one word in one context form a cell, and given the parent and the
context's number of tables, cells are independent; so a bucket of words samples
its cells by itself.  Inside a sweep a cell sees the number of tables of its
context as estimated from the bucket (buckets hold words by hash, so each is a
fair share of a context's words); the final sums are exact, and probabilities
add up to one in every context.

Blocks of documents and buckets exchange packed arrays (``blocks``): first each
distinct word of a block with its count, then each distinct pair, then the
restaurants' sums.  A word so frequent that its pairs would fill several buckets
is dealt over that many by a hash of the context.
"""

from __future__ import annotations

import pickle
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlog.llm.blocks import (BUCKET_KEYS, UP, WordHashes, answer, bucket_count, bucket_edges, each_block, figures_of,
                                 mixed, pack, send, task_count, unpack, write_blocks)
from driftlog.llm.common import new_folder, staged, table

#: Discount and strength of the context restaurants and of their parent.
DISCOUNT, STRENGTH = 0.85, 1.0
PARENT_DISCOUNT, PARENT_STRENGTH = 0.6, 10.0
#: Sweeps before samples count (tables of cells, contexts and the parent draw each other along slowly), and sweeps that count.
BURN_IN, SAMPLES = 60, 3
#: Cells of up to so many customers are drawn from the exact distribution, larger ones from its limit form.
EXACT = 1024
HELD_OUT_OF, HELD_OUT = 7, 2
BLOCK_BYTES = 16 << 20

#: No word has a space in it.
END_HASH = 0x5EED0FE9D5EED0FE
_HASHES = WordHashes()
_ODD = np.uint64(0x9E3779B97F4A7C15)
_WORDS, _PAIRS, _SUMS = 0, 1, 2  # kinds of replies


# --- seating ---------------------------------------------------------------------

class Seating:
    """Tables of many cells: ``cell`` (ascending) and ``size`` of each table (one move at a time, to hold ``draw_tables`` against)."""

    def __init__(self, customers: np.ndarray, alpha: np.ndarray, rng) -> None:
        """A first arrangement with about as many tables as customers who come one by one would open."""
        self.customers, self.rng = customers, rng
        n = len(customers)
        expected = 1 + alpha * np.log1p((customers - 1) / (alpha + 1))
        tables = np.minimum(customers, np.floor(np.minimum(expected, customers) + rng.random(n)).astype(np.int64)).clip(1)
        self.cell = np.repeat(np.arange(n), tables)
        place = np.arange(len(self.cell)) - np.repeat(np.cumsum(tables) - tables, tables)
        weight = 1.0 / (place + 1)
        spare = (customers - tables)[self.cell] * weight / np.bincount(self.cell, weight, n)[self.cell]
        self.size = 1 + np.floor(spare).astype(np.int64)
        first = np.cumsum(tables) - tables
        self.size[first] += customers - np.bincount(self.cell, self.size, n).astype(np.int64)

    def tables(self) -> np.ndarray:
        return np.bincount(self.cell, minlength=len(self.customers))

    def move(self, alpha: np.ndarray, discount: float) -> None:
        """Take one random customer of every cell from the table and seat it again.

        An occupied table attracts by its size less the discount, a new one by ``alpha``.
        """
        n = len(self.customers)
        if not n:
            return
        ends = np.cumsum(self.size)
        begin = np.cumsum(self.customers) - self.customers
        who = begin + (self.rng.random(n) * self.customers).astype(np.int64)
        self.size[np.searchsorted(ends, who, "right")] -= 1
        weight = np.where(self.size > 0, self.size - discount, 0.0)
        total = np.bincount(self.cell, weight, n)
        draw = self.rng.random(n) * (alpha + total)
        new = draw < alpha
        old = np.flatnonzero(~new)
        sums = np.cumsum(weight)
        before = np.cumsum(total) - total
        at = np.searchsorted(sums, before[old] + (draw - alpha)[old], "right")
        # rounding may point past the cell or at an empty table: then its fullest one
        at = np.minimum(at, len(self.cell) - 1)
        wrong = np.flatnonzero((self.cell[at] != old) | (self.size[at] == 0))
        for k in wrong.tolist():
            a, b = np.searchsorted(self.cell, [old[k], old[k] + 1])
            at[k] = a + int(self.size[a:b].argmax())
        self.size[at] += 1
        kept = self.size > 0
        cell = np.concatenate([self.cell[kept], np.flatnonzero(new)])
        size = np.concatenate([self.size[kept], np.ones(int(new.sum()), np.int64)])
        order = np.argsort(cell, kind="stable")
        self.cell, self.size = cell[order], size[order]


_STIRLING: dict[float, list[np.ndarray]] = {}


def log_stirling(discount: float, customers: int) -> list[np.ndarray]:
    """Logarithms of the generalised Stirling numbers: row ``n`` for 1 to ``n`` tables, up to ``customers``.

    ``S(n, t)`` is the weight of all arrangements of ``n`` customers at ``t`` tables.
    """
    rows = _STIRLING.setdefault(discount, [np.zeros(0), np.zeros(1)])
    while len(rows) <= customers:
        n, last = len(rows) - 1, rows[-1]
        row = np.full(n + 1, -np.inf)
        row[:n] = last + np.log(n - discount * np.arange(1, n + 1))
        row[1:] = np.logaddexp(row[1:], last)
        rows.append(row)
    return rows


def draw_tables(customers: np.ndarray, alpha: np.ndarray, discount: float, rng) -> np.ndarray:
    """Number of tables of each cell, all its customers seated anew: ``t`` with weight ``S(customers, t) alpha ** t``.

    This is where single moves (an occupied table attracts by its size less the
    discount, a new one by ``alpha``) settle.  Beyond ``EXACT`` customers: tables
    come as a Poisson number of independent sizes that add up to the customers;
    given that sum, their mean and variance are those of a binomial number.
    """
    out = np.ones(len(customers), np.int64)
    small = np.flatnonzero((customers > 1) & (customers <= EXACT))
    if (np.diff(customers[small]) < 0).any():
        small = small[np.argsort(customers[small], kind="stable")]
    sizes, first = np.unique(customers[small], return_index=True)
    rows = log_stirling(discount, int(sizes[-1])) if len(sizes) else []
    for n, at in zip(sizes.tolist(), np.split(small, first[1:])):
        if n == 2:
            out[at] += rng.random(len(at)) * (alpha[at] + 1 - discount) < alpha[at]
            continue
        for k in range(0, len(at), 1 + 1_000_000 // n):
            some = at[k:k + 1 + 1_000_000 // n]
            weight = rows[n] + np.log(alpha[some])[:, None] * np.arange(1, n + 1)
            total = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
            out[some] = 1 + (total < (rng.random(len(some)) * total[:, -1])[:, None]).sum(axis=1)
    large = np.flatnonzero(customers > EXACT)
    if len(large):
        n, a = customers[large].astype(float), alpha[large]
        # x, by which sizes are tilted so that alpha * x * (1 - x) ** (discount - 1), the expected sum, is n: by log(1 - x)
        low, high = np.full(len(n), -745.0), np.zeros(len(n))
        for _ in range(60):
            y = (low + high) / 2
            more = np.log(a) + np.log(np.maximum(-np.expm1(y), 1e-300)) + (discount - 1) * y < np.log(n)
            low, high = np.where(more, low, y), np.where(more, y, high)
        rest = np.exp(y)
        x = -np.expm1(y)
        g = -np.expm1(discount * y) / discount
        mean = x * np.exp((discount - 1) * y) / g
        square = mean * (1 + (1 - discount) * x / rest)
        p = np.clip(mean * mean / square, 1e-12, 1.0)
        times = (a * g) / p
        whole = np.floor(times)
        out[large] = 1 + rng.binomial((whole + (rng.random(len(n)) < times - whole)).astype(np.int64), p)
    return np.minimum(out, customers).clip(1)


def sample_cells(word: np.ndarray, context: np.ndarray, count: np.ndarray, split: np.ndarray, context_count: np.ndarray,
                 words_known: int, share: int, seed: int):
    """Gibbs over the cells of a bucket.

    ``word`` (ascending) and ``context`` number the cells, ``split[word]`` tells
    over how many buckets a word's cells are dealt, ``share`` the number of
    buckets.  Returns the mean tables of each cell and, for each word, the
    parent's mean customers and tables (this bucket's part of them).
    """
    rng = np.random.default_rng(seed)
    n_words, n_contexts = len(split), len(context_count)
    many = np.flatnonzero(count > 1)
    many = many[np.argsort(count[many], kind="stable")]
    tables = np.maximum(1, np.round(count ** DISCOUNT)).astype(np.int64)
    sums = np.zeros(len(word))
    # cells of one customer keep their table: counted once
    single = np.flatnonzero(count == 1)
    word_once, context_once = np.bincount(word[single], minlength=n_words), np.bincount(context[single], minlength=n_contexts)
    many_word, many_context, many_count, now = word[many], context[many], count[many], tables[many]
    customers_sum, tables_sum = np.zeros(n_words), np.zeros(n_words)
    for sweep in range(BURN_IN + SAMPLES):
        customers = (word_once + np.bincount(many_word, now, n_words).astype(np.int64)) * split
        shared = np.flatnonzero(customers > 1)
        parent = np.minimum(customers, 1)
        opened = parent.sum() * share
        base = (PARENT_STRENGTH + PARENT_DISCOUNT * opened) / (words_known + 1)
        parent[shared] = draw_tables(customers[shared], np.full(len(shared), base), PARENT_DISCOUNT, rng)
        base = (PARENT_STRENGTH + PARENT_DISCOUNT * (parent / split).sum() * share) / (words_known + 1)
        all_customers = (customers / split).sum() * share
        probability = (customers - PARENT_DISCOUNT * parent + base) / (PARENT_STRENGTH + all_customers)
        # a context's tables: this bucket's, and those like them elsewhere
        here = context_once + np.bincount(many_context, now, n_contexts)
        there = np.clip(here + (share - 1) * (here - 1), here, np.maximum(context_count, here))
        alpha = (STRENGTH + DISCOUNT * there)[many_context] * probability[many_word]
        now = draw_tables(many_count, alpha, DISCOUNT, rng)
        if sweep >= BURN_IN:
            sums[many] += now
            customers_sum += word_once + np.bincount(many_word, now, n_words)
            tables_sum += parent / split
    sums[single] = SAMPLES
    return sums / SAMPLES, customers_sum / SAMPLES, tables_sum / SAMPLES


# --- blocks ----------------------------------------------------------------------

def is_held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % HELD_OUT_OF == HELD_OUT


def _encode(ids: list, texts: list[bytes], rest: list) -> tuple[bytes, int]:
    """A block: its distinct word hashes and each token as a place among them."""
    lengths, hashes = [], []
    end = np.array([END_HASH], np.uint64)
    for text in texts:
        h = _HASHES.of(text.lower().split())
        lengths.append(len(h) + 1)
        hashes += [h, end]
    known, tokens = np.unique(np.concatenate(hashes), return_inverse=True)
    return pickle.dumps((ids, pack(np.array(lengths), known, tokens.astype(np.uint32))), protocol=5), len(tokens)


class _Block:
    def __init__(self, data: bytes) -> None:
        self.ids, packed = pickle.loads(data)
        self.lengths, self.known, tokens = unpack(packed)
        self.tokens = tokens.astype(np.int64)
        self.held_out = np.array([is_held_out(i) for i in self.ids])
        self.training = np.repeat(~self.held_out, self.lengths)
        self.counts = np.bincount(self.tokens[self.training], minlength=len(self.known))

    def pairs(self):
        """Distinct (context, word) as places among the known words, training counts, and each token's pair."""
        end = int(np.searchsorted(self.known, np.uint64(END_HASH)))
        before = np.empty(len(self.tokens), np.int64)
        before[1:] = self.tokens[:-1]
        before[0] = end  # every later document follows an end
        codes, which = np.unique(before * len(self.known) + self.tokens, return_inverse=True)
        return codes // len(self.known), codes % len(self.known), np.bincount(which[self.training], minlength=len(codes)), which, before

    def word_replies(self, replies: dict[int, bytes], buckets: int):
        """Corpus count and corpus number of the known words (both in their order)."""
        counts, numbers = [], []
        for bucket in range(buckets):
            if bucket in replies:
                c, rank = unpack(replies[bucket])
                counts.append(c)
                numbers.append(rank.astype(np.uint64) | (np.uint64(bucket) << np.uint64(32)))
        return np.concatenate(counts).astype(np.int64), np.concatenate(numbers)


def _ordered_pairs(block: _Block, counts: np.ndarray, numbers: np.ndarray, buckets: int):
    """The block's pairs in the order in which they are sent, and where each bucket's part begins."""
    context, word, here, which, before = block.pairs()
    split = 1 + counts // BUCKET_KEYS
    salt = np.zeros(len(word), np.uint64)
    dealt = np.flatnonzero(split[word] > 1)
    if len(dealt):
        salt[dealt] = mixed(numbers[context[dealt]]) % split[word[dealt]].astype(np.uint64)
    with np.errstate(over="ignore"):
        key = mixed(numbers[word] + _ODD * (salt + np.uint64(1)))
    order = np.lexsort((numbers[context], numbers[word], key))
    return order, bucket_edges(key[order], buckets), context, word, here, which, before, split


def _merge_words(bucket: int, names: list[str], payloads: list[bytes]):
    arrays = [unpack(p) for p in payloads]
    keys, which = np.unique(np.concatenate([a[0] for a in arrays]), return_inverse=True)
    counts = np.bincount(which, np.concatenate([a[1] for a in arrays]), len(keys)).astype(np.int64)
    cut = np.cumsum([len(a[0]) for a in arrays])[:-1]
    replies = [pack(counts[w], w.astype(np.uint32)) for w in np.split(which, cut)]
    return replies, [counts.sum(), (counts > 0).sum()]


def _merge_sums(requests_and_sums):
    """Of one bucket of words: the contexts' tables, the parent's customers and tables of each word asked for."""
    requests, sums = requests_and_sums
    size = 1 + max([int(r.max(initial=0)) for _, r in requests] + [int(s[0].max(initial=0)) for s in sums], default=0)
    total = np.zeros((3, size))
    for kind, rank, a, b in ((s[3][0], *s[:3]) for s in sums):
        if kind == 0:  # contexts
            total[0] += np.bincount(rank, a, size)
        else:  # words
            total[1] += np.bincount(rank, a, size)
            total[2] += np.bincount(rank, b, size)
    return [pack(*total[:, rank]) for _, rank in requests], [total[1].sum(), total[2].sum()]


def pitman_yor_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **block_options) -> DataFrame:
    """Score every text, learning from those that are not held out.

    ``id_col, held_out, n_tokens, n_known, train_tokens, base_score, score``; the
    scores are log10 probabilities of the whole text with its end.  Null and
    empty texts are their end alone; a null id counts as an empty one (training);
    repeated rows are trained on and scored as often as they stand; extra columns
    are ignored; an empty table gives no rows.  If all texts are held out, every
    word is unknown.
    """
    folder = new_folder(docs.sparkSession, "word-blocks")
    blocks = write_blocks(docs, folder, _encode, id_col, text_col, **{"block_bytes": BLOCK_BYTES, **block_options})
    tasks = task_count(blocks)
    tokens = int(blocks.agg(F.coalesce(F.sum("n_keys"), F.lit(0))).first()[0])
    word_buckets, pair_buckets = bucket_count(tokens // 8), bucket_count(tokens // 2)

    # 1. words: corpus counts
    def words_of(name, data):
        block = _Block(data)
        edges = bucket_edges(block.known, word_buckets)
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            if b > a:
                yield k, pack(block.known[a:b], block.counts[a:b])

    known = answer(send(blocks, folder, words_of), _merge_words, "words")
    train_tokens, words_known = (int(x) for x in figures_of(known, 2))

    # 2. pairs: merged and sampled
    def pairs_of(name, data, replies):
        import pandas as pd
        block = _Block(data)
        counts, numbers = block.word_replies(replies, word_buckets)
        order, edges, context, word, here, _, _, split = _ordered_pairs(block, counts, numbers, pair_buckets)
        context, word, here = context[order], word[order], here[order]
        rows = []
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            if b > a:
                u, w = context[a:b], word[a:b]
                rows.append((k, pack(numbers[w], numbers[u], here[a:b], split[w], counts[u])))
        return pd.DataFrame({"bucket": [r[0] for r in rows], "block": name, "payload": [r[1] for r in rows]})

    def seat(frame):
        import pandas as pd
        frame = frame.sort_values("block")
        bucket, names = int(frame["bucket"].iloc[0]), frame["block"].tolist()
        arrays = [unpack(p) for p in frame["payload"]]
        w, u, here, split, in_corpus = (np.concatenate([a[k] for a in arrays]) for k in range(5))
        words, word = np.unique(w, return_inverse=True)
        contexts, context = np.unique(u, return_inverse=True)
        cells, which = np.unique(word * len(contexts) + context, return_inverse=True)
        count = np.bincount(which, here, len(cells)).astype(np.int64)
        split_of, corpus_of = np.ones(len(words), np.int64), np.ones(len(contexts), np.int64)
        split_of[word], corpus_of[context] = split, in_corpus
        seen = np.flatnonzero(count > 0)
        cell_word, cell_context = cells[seen] // len(contexts), cells[seen] % len(contexts)
        tables, customers, parent = sample_cells(cell_word, cell_context, count[seen], split_of, corpus_of, words_known,
                                                 pair_buckets, bucket)
        weight = np.zeros(len(cells), np.float32)
        weight[seen] = count[seen] - DISCOUNT * tables
        cut = np.cumsum([len(a[0]) for a in arrays])[:-1]
        rows = [(name, bucket * 4 + _PAIRS, pack(x)) for name, x in zip(names, np.split(weight[which], cut))]
        # sums for the buckets of words: each context's tables, each word's share of the parent
        for kind, numbers, a, b in ((0, contexts, np.bincount(cell_context, tables, len(contexts)), np.zeros(len(contexts))),
                                    (1, words, customers, parent)):
            home = (numbers >> np.uint64(32)).astype(np.int64)
            rank = (numbers & np.uint64(0xFFFFFFFF)).astype(np.int64)
            edges = np.searchsorted(home, np.arange(word_buckets + 1))
            for k, (x, y) in enumerate(zip(edges, edges[1:])):
                if y > x:
                    rows.append((None, k, pack(rank[x:y], a[x:y], b[x:y], np.array([kind]))))
        return pd.DataFrame(rows, columns=["block", "bucket", "reply"])

    asked = each_block(known, folder, tasks, pairs_of, UP)
    seated = staged(asked.groupBy("bucket").applyInPandas(seat, "block string, bucket long, reply binary"), "pairs")

    # 3. restaurants: sums for every block's words
    def sums_of(frame):
        import pandas as pd
        bucket = int(frame["bucket"].iloc[0])
        asks, sums = frame[frame["block"].notna()], frame[frame["block"].isna()]
        requests = [(name, unpack(r)[1]) for name, r in zip(asks["block"], asks["reply"])]
        replies, figures = _merge_sums((requests, [unpack(r) for r in sums["reply"]]))
        return pd.DataFrame({"block": [r[0] for r in requests], "bucket": bucket * 4 + _SUMS, "reply": replies,
                             "figures": [[float(x) for x in figures]] + [None] * (len(requests) - 1)})

    both = known.select("block", "bucket", "reply").unionByName(seated.where("block is null"))
    sums = staged(both.groupBy("bucket").applyInPandas(sums_of, "block string, bucket long, reply binary, figures array<double>"), "sums")
    all_customers, all_tables = figures_of(sums, 2)

    # 4. scores
    base_share = (PARENT_STRENGTH + PARENT_DISCOUNT * all_tables) / (words_known + 1)

    def score(name, data, replies):
        import pandas as pd
        block = _Block(data)
        kinds: list[dict] = [{}, {}, {}]
        for bucket, reply in replies.items():
            kinds[bucket % 4][bucket // 4] = reply
        counts, numbers = block.word_replies(kinds[_WORDS], word_buckets)
        order, edges, context, word, here, which, before, _ = _ordered_pairs(block, counts, numbers, pair_buckets)
        weight = np.empty(len(order))
        weight[order] = np.concatenate([unpack(kinds[_PAIRS][k])[0] for k in sorted(kinds[_PAIRS])])
        parts = [unpack(kinds[_SUMS][k]) for k in sorted(kinds[_SUMS])]
        tables, customers, parent = (np.concatenate([p[k] for p in parts]) for k in range(3))
        single = (customers - PARENT_DISCOUNT * parent + base_share) / (PARENT_STRENGTH + all_customers)
        back = (STRENGTH + DISCOUNT * tables) / (STRENGTH + counts)
        pair = np.log10(weight / (STRENGTH + counts[context]) + back[context] * single[word])
        plain = np.log10((counts + 1) / (train_tokens + words_known + 1))
        first = np.cumsum(block.lengths) - block.lengths
        per_doc = lambda x: np.add.reduceat(x, first)
        return pd.DataFrame({
            "id": pd.array(block.ids, "Int64"), "held_out": block.held_out, "n_tokens": block.lengths,
            "n_known": per_doc((counts[block.tokens] > 0).astype(np.int64)), "train_tokens": train_tokens,
            "base_score": per_doc(plain[block.tokens]), "score": per_doc(pair[which])})

    kept = (known.select("block", (F.col("bucket") * 4 + _WORDS).alias("bucket"), "reply")
            .unionByName(seated.where("block is not null")).unionByName(sums.select("block", "bucket", "reply")))
    out = each_block(kept, folder, tasks, score, "id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
                                          "base_score double, score double")
    return out.withColumnRenamed("id", id_col)


def op1_pitman_yor(spark, sf_dir: str) -> DataFrame:
    """Scores of every document under the hierarchical Pitman-Yor model and under the base model."""
    return pitman_yor_scores(table(spark, sf_dir, "documents"))
