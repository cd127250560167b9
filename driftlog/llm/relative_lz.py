"""Duplicate spans by relative Lempel-Ziv parsing.

The corpus is cut into reference blocks.  Each block indexes the windows of
``width`` words of its documents; the indexes are merged by ranges of window
hashes, so a document is parsed against every block at once.  A factor is the
longest run of words that stands, in one piece, earlier in the corpus: at each
word the earliest place of the window that begins there is looked up, and the
factor goes on while the next window's earliest place is the next word of the
same source.  Where it ends, the windows across the boundary have been looked up
as well, so no repeated window is lost between two factors.  Factors of
``width`` words or more are the duplicate spans.

Only windows that can be repeated are looked up: each window names its smallest
run of ``GRAM`` words (a function of the window's words alone); the runs that
stand at one place of the corpus only are found first, and the windows that name
them are unique.
"""

from __future__ import annotations

import hashlib
import pickle
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlog.llm.blocks import (UP, WordHashes, answer, bucket_count, bucket_edges, each_block, mixed, pack, send, task_count, unpack,
                                 write_blocks)
from driftlog.llm.common import new_folder, staged, table

WIDTH = 20
GRAM = 8
_HASHES = WordHashes()
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
LEAST_ID = -(1 << 63)
BLOCK_BYTES = 8 << 20


def _encode(ids: list, texts: list[bytes], rest: list) -> tuple[bytes, int]:
    """A block: its documents by ascending id (null first), and its number of words."""
    order = sorted(range(len(ids)), key=lambda k: (LEAST_ID if ids[k] is None else ids[k], k))
    n = sum(len(t.split()) for t in texts)
    return zlib.compress(pickle.dumps(([ids[k] for k in order], [texts[k] for k in order]), protocol=5), 1), n


def _rolled(h: np.ndarray, width: int) -> np.ndarray:
    """Spread hashes of all runs of ``width`` words."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        x = h[:n].copy()
        for j in range(1, width):
            x *= _FACTOR
            x += h[j:j + n]
    return mixed(x)


class _Block:
    """A block's documents, words and windows, one after the other."""

    def __init__(self, data: bytes, width: int) -> None:
        self.ids, texts = pickle.loads(zlib.decompress(data))
        self.words = [t.split() for t in texts]
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        self.ends = np.cumsum(self.lengths)
        h = np.concatenate([_HASHES.of(w) for w in self.words]) if len(self.words) else np.zeros(0, np.uint64)
        self.h, self.width = h, width
        # windows that lie in one document
        end_of = np.repeat(self.ends, self.lengths)
        self.starts = np.flatnonzero(np.arange(len(h)) + width <= end_of)
        grams = _rolled(h, GRAM)
        span = width - GRAM + 1
        if len(self.starts):
            n = len(grams) - span + 1
            least, place = grams[:n].copy(), np.zeros(n, np.uint8)
            for j in range(1, span):
                smaller = grams[j:j + n] < least
                place[smaller] = j
                np.minimum(least, grams[j:j + n], out=least)
            named = self.starts + place[self.starts]
        else:
            named = self.starts
        places, self.place_of = np.unique(named, return_inverse=True)
        # the values of the named runs, spread again: minima are small numbers
        self.runs, self.run_of, counts = np.unique(mixed(grams[places]) if len(places) else np.zeros(0, np.uint64),
                                                   return_inverse=True, return_counts=True)
        self.several = counts > 1

    def candidates(self, repeated: np.ndarray):
        """Windows whose named run is repeated: distinct hashes, the first place of each, and all places."""
        at = self.starts[repeated[self.run_of][self.place_of]] if len(self.starts) else self.starts
        hashes = _rolled(self.h, self.width)[at] if len(at) else np.zeros(0, np.uint64)
        keys, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        return keys, at[first] if len(at) else at, at, which, first

    def position(self, at: np.ndarray):
        """Document number and word number of places."""
        doc = np.searchsorted(self.ends, at, "right")
        return doc, at - (self.ends - self.lengths)[doc]

    def known_ids(self) -> np.ndarray:
        return np.array([LEAST_ID if i is None else i for i in self.ids], np.int64)


def _deal(keys: np.ndarray, buckets: int, *values: np.ndarray):
    edges = bucket_edges(keys, buckets)
    for k, (a, b) in enumerate(zip(edges, edges[1:])):
        if b > a or k == 0:
            yield k, pack(keys[a:b], *(v[a:b] for v in values))


def _gather(replies: dict[int, bytes], fields: int) -> list[np.ndarray]:
    """The replies of all buckets, in the order of the keys."""
    parts = [unpack(replies[k]) for k in sorted(replies)]
    return [np.concatenate([p[f] for p in parts]) for f in range(fields)]


def _repeated_runs(bucket: int, names: list[str], payloads: list[bytes]) -> list[bytes]:
    arrays = [unpack(p) for p in payloads]
    keys, which, counts = np.unique(np.concatenate([a[0] for a in arrays]), return_inverse=True, return_counts=True)
    several = np.bincount(which, weights=np.concatenate([a[1] for a in arrays]), minlength=len(keys)) > 0
    flags = (several | (counts > 1))[which]
    cut = np.cumsum([len(a[0]) for a in arrays])[:-1]
    return [pack(x) for x in np.split(flags, cut)]


def _earliest(bucket: int, names: list[str], payloads: list[bytes]) -> list[bytes]:
    """For each block's windows: whether its first place is the corpus's, and the corpus's first place."""
    arrays = [unpack(p) for p in payloads]
    keys, docs, words = (np.concatenate([a[k] for a in arrays]) for k in range(3))
    block = np.repeat(np.arange(len(arrays)), [len(a[0]) for a in arrays])
    order = np.lexsort((words, block, docs, keys))
    head = np.ones(len(keys), bool)
    head[1:] = keys[order][1:] != keys[order][:-1]
    leader = order[np.maximum.accumulate(np.where(head, np.arange(len(keys)), 0))]
    lead = np.empty(len(keys), np.int64)
    lead[order] = leader
    own = lead == np.arange(len(keys))
    cut = np.cumsum([len(a[0]) for a in arrays])[:-1]
    return [pack(*x) for x in zip(np.split(own, cut), np.split(docs[lead], cut), np.split(words[lead], cut))]


def _parse(block: _Block, replies: dict[int, bytes], repeated: np.ndarray):
    """Places of repeated windows, and the source (id, word) of each."""
    keys, first, at, which, first_index = block.candidates(repeated)
    own, source, word = _gather(replies, 3)
    original = np.zeros(len(at), bool)
    original[first_index] = own
    return at[~original], source[which][~original], word[which][~original]


def _factors(block: _Block, at: np.ndarray, source: np.ndarray, word: np.ndarray):
    """Greedy factors: runs of repeated windows that follow one source word by word."""
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), source, word
    doc, _ = block.position(at)
    on = (np.diff(at) == 1) & (np.diff(doc) == 0) & (np.diff(source) == 0) & (np.diff(word) == 1)
    begin = np.flatnonzero(np.concatenate([[True], ~on]))
    length = np.diff(np.concatenate([begin, [len(at)]])) + block.width - 1
    return at[begin], length, source[begin], word[begin]


def _covered(block: _Block, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Which words the factors cover."""
    change = np.zeros(len(block.h) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change[:-1]) > 0


def parse(docs: DataFrame, make, schema: str, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
          **block_options) -> DataFrame:
    """Parse all documents; ``make(block, factors, covered words)`` gives the rows of each block."""
    folder = new_folder(docs.sparkSession, "reference-blocks")
    blocks = write_blocks(docs, folder, _encode, id_col, text_col, **{"block_bytes": BLOCK_BYTES, **block_options})
    tasks = task_count(blocks)
    words = blocks.agg(F.coalesce(F.sum("n_keys"), F.lit(0))).first()[0]
    buckets = bucket_count(words // 4)

    def runs(name, data):
        block = _Block(data, width)
        yield from _deal(block.runs, buckets, block.several)

    def windows(name, data, replies):
        import pandas as pd
        block = _Block(data, width)
        repeated, = _gather(replies, 1)
        keys, first, *_ = block.candidates(repeated)
        doc, word = block.position(first)
        rows = list(_deal(keys, buckets, block.known_ids()[doc] if len(doc) else doc, word.astype(np.int64)))
        # the flags of the runs go along, so the last step needs no second join
        rows.append((-1, pack(np.packbits(repeated), np.array([len(repeated)]))))
        return pd.DataFrame({"bucket": [r[0] for r in rows], "block": name, "payload": [r[1] for r in rows]})

    def finish(name, data, replies):
        block = _Block(data, width)
        bits, n = unpack(replies.pop(-1))
        repeated = np.unpackbits(bits, count=int(n[0])).astype(bool)
        factors = _factors(block, *_parse(block, replies, repeated))
        return make(block, factors, _covered(block, factors[0], factors[1]))

    known = answer(send(blocks, folder, runs), _repeated_runs)
    asked = staged(each_block(known, folder, tasks, windows, UP), "windows")
    flags = asked.where("bucket < 0").select("block", "bucket", F.col("payload").alias("reply"))
    found = answer(asked.where("bucket >= 0"), _earliest)
    return each_block(found.select("block", "bucket", "reply").unionByName(flags), folder, tasks, finish, schema)


def _frame_of(block: _Block, **columns):
    import pandas as pd
    return pd.DataFrame({"__id": pd.array(block.ids, "Int64"), **columns})


def duplicate_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                            **block_options) -> DataFrame:
    """``doc_id, start, length, source_id, source_start`` of every factor of ``width`` words or more."""
    def make(block, factors, covered):
        import pandas as pd
        starts, lengths, source, word = factors
        doc, first = block.position(starts) if len(starts) else (starts, starts)
        ids = pd.array(block.ids, "Int64")
        return pd.DataFrame({"doc_id": ids[doc], "start": first, "length": lengths,
                             "source_id": pd.array(np.where(source == LEAST_ID, 0, source), "Int64"), "source_start": word})

    schema = "doc_id bigint, start bigint, length bigint, source_id bigint, source_start bigint"
    return parse(docs, make, schema, id_col, text_col, width, **block_options)


def without_duplicate_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                            **block_options) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: the words of each document outside all duplicate spans, space-joined.

    A word goes if a window of ``width`` words that covers it also starts earlier:
    in a smaller id (null counts as the smallest) or earlier in the same document.
    Rows that share an id are taken one after the other.  Null, empty and short
    texts lose nothing; extra columns are ignored; an empty table gives no rows.
    Windows are compared by 64-bit hashes.
    """
    def make(block, factors, covered):
        kept, removed = [], []
        for words, end, n in zip(block.words, block.ends.tolist(), block.lengths.tolist()):
            gone = covered[end - n:end]
            removed.append(int(gone.sum()))
            kept.append(b" ".join(words if not removed[-1] else [w for w, x in zip(words, gone.tolist()) if not x]).decode())
        return _frame_of(block, n_words=block.lengths, n_removed=removed, kept=kept).rename(columns={"__id": "doc_id"})

    return parse(docs, make, "doc_id bigint, n_words bigint, n_removed bigint, kept string", id_col, text_col, width, **block_options)


def op10_relative_lz(spark, sf_dir: str) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every document."""
    def make(block, factors, covered):
        sums, removed = [], []
        for words, end, n in zip(block.words, block.ends.tolist(), block.lengths.tolist()):
            gone = covered[end - n:end]
            removed.append(int(gone.sum()))
            left = words if not removed[-1] else [w for w, x in zip(words, gone.tolist()) if not x]
            sums.append(hashlib.sha256(b" ".join(left)).hexdigest())
        return _frame_of(block, n_words=block.lengths, n_removed=removed, kept_sha256=sums).rename(columns={"__id": "doc_id"})

    return parse(table(spark, sf_dir, "documents"), make,
                 "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")


ORACLE_OP10 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
     p AS (SELECT doc_id, w, unnest(range(1, len(w) - {WIDTH - 2})) AS i FROM d),
     win AS (SELECT doc_id, i, array_to_string(w[i:i + {WIDTH - 1}], ' ') AS s FROM p),
     again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
     gone AS (SELECT doc_id, list(DISTINCT i + k) AS g FROM again, range(0, {WIDTH}) t(k) GROUP BY doc_id),
     l AS (SELECT d.doc_id, w, unnest(range(1, len(w) + 1)) AS j FROM d),
     kept AS (SELECT l.doc_id, string_agg(l.w[l.j], ' ' ORDER BY l.j) AS t FROM l
              LEFT JOIN (SELECT doc_id, unnest(g) AS j FROM gone) x ON x.doc_id = l.doc_id AND x.j = l.j
              WHERE x.j IS NULL GROUP BY l.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(g), 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
