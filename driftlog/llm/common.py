"""Helpers shared by the training-data operators.

Staged tables and files go to the folder in ``spark.checkpoint.dir``, which the
driver and all executors share.  Only a local session without that setting gets
a temporary folder of its own.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Word separators of every operator here: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = "file://" + tempfile.mkdtemp(prefix="driftlog-llm-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back.

    Cuts the lineage; a lost executor loses nothing of it.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def filesystem(path: str):
    """``(pyarrow filesystem, path in it)`` of a shared path, for use inside tasks."""
    from pyarrow import fs
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def write_file(path: str, data: bytes) -> None:
    """Write a whole file under its final name only once it is complete.

    A retried or speculative attempt writes the same bytes and replaces it.
    """
    files, at = filesystem(path)
    files.create_dir(os.path.dirname(at), recursive=True)
    part = f"{at}.{uuid.uuid4().hex[:8]}.part"
    with files.open_output_stream(part, compression=None) as out:
        out.write(data)
    files.move(part, at)


def read_file(path: str, start: int = 0, length: int | None = None) -> bytes:
    files, at = filesystem(path)
    with files.open_input_file(at) as f:
        f.seek(start)
        return f.read() if length is None else f.read(length)


def words_of(text: Column) -> Column:
    """Words of a text as an array, JVM-side (null: empty array)."""
    parts = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    return F.array_remove(parts, "")


def lower_ascii(text: Column) -> Column:
    """``A-Z`` to ``a-z``, everything else unchanged."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A lambda variable is bound to a value; a plain reference would be
    re-evaluated for every element of the lambdas inside ``body``.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def text_bytes(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column (null: empty)."""
    import pyarrow as pa
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


# --- tokenizer ids -------------------------------------------------------------

_TOKENIZERS: dict = {}
_TWO_SPACES = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
#: Distinct pieces that a worker remembers, and texts (in characters) encoded together.
CACHE_PIECES = 1_000_000
CHUNK_CHARS = 2_000_000
_BATCH = 2_000
_MARKS = ".,;:!?"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class _Codes(dict):
    """Numbers of pieces; a new piece gets the next one and is noted in ``fresh``."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        code = self[piece] = len(self)
        self.fresh.append(piece)
        return code


class IdEncoder:
    """Ids of whole texts by the ``tokenizers`` library, each distinct piece encoded once.

    The byte-level pre-tokenizer always starts a new piece at a lone space or
    line feed between two other characters, so a text may be cut there and its
    ids are those of its pieces, one after the other.  Pieces are looked up in
    a bounded cache; new ones are encoded many at a time and told apart by the
    space or line feed that each begins with.  Any other kind of tokenizer gets
    its texts whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        before = self.tokenizer.pre_tokenizer
        self.by_piece = isinstance(before, ByteLevel) and not before.add_prefix_space and self.tokenizer.normalizer is None
        vocab = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocab.values()) + 1, bool)
        for piece, i in vocab.items():
            self.begins[i] = piece.startswith(("Ġ", "Ċ"))
        self.codes, self.known = _Codes(), []
        self.marks = {c: self._ids(c).tobytes() for c in _MARKS}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _learn(self) -> None:
        """Encode the fresh pieces.  A piece stands for itself behind a space, or as it is behind a line feed."""
        codes, known = self.codes, self.known
        fresh, ended = codes.fresh, []
        codes.fresh = []
        for p in fresh:  # a word with one mark behind it is that word and that mark
            if p[-1:] in self.marks and p[:-1].isalpha():
                ended.append((codes[p], codes[p[:-1]], self.marks[p[-1]]))
        after = {x[0] for x in ended}
        todo = [(codes[p], p if p[:1] == "\n" else " " + p) for p in fresh + codes.fresh if codes[p] not in after]
        codes.fresh = []
        known.extend([None] * (len(codes) - len(known)))
        plain = [x for x in todo if x[1][1:].split() == [x[1][1:]]]
        for k in range(0, len(plain), _BATCH):
            some = plain[k:k + _BATCH]
            ids = self._ids("".join([x[1] for x in some]))
            at = np.flatnonzero(self.begins[ids])
            if len(at) == len(some):
                raw, cut = ids.tobytes(), [*(4 * at).tolist(), 4 * len(ids)]
                for (code, _), a, b in zip(some, cut, cut[1:]):
                    known[code] = raw[a:b]
        for code, piece in todo:
            if known[code] is None:  # with other white space in it, or not told apart
                known[code] = self._ids(piece).tobytes()
        for code, word, mark in ended:
            known[code] = known[word] + mark

    def _chunk(self, texts: list[str]) -> list[bytes]:
        if len(self.codes) > CACHE_PIECES:
            self.codes, self.known = _Codes(), []
        look, rows = self.codes.__getitem__, []
        for text in texts:
            if _TWO_SPACES.search(text):
                parts = [p[1:] if k and p[0] == " " else p for k, p in enumerate(_CUT.split(text))]
            else:
                parts = text.replace("\n", " \n").split(" ")
            first = parts[0]
            direct = first[:1].isspace()  # else: the first piece is looked up behind a line feed, and that taken off
            rows.append((self._ids(first).tobytes() if direct else None, look("\n" + first) if first and not direct else None,
                         list(map(look, parts[1:]))))
        self._learn()
        known = self.known
        return [b"".join([head if head is not None else known[first][4:] if first is not None else b"",
                          *map(known.__getitem__, rest)]) for head, first, rest in rows]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if not self.by_piece:
            return [self._ids(x).tobytes() for x in texts]
        out, some, held = [], [], 0
        for text in texts:
            some.append(text)
            held += len(text)
            if held >= CHUNK_CHARS:
                out += self._chunk(some)
                some, held = [], 0
        return out + self._chunk(some) if some else out


def id_encoder(path: str) -> IdEncoder:
    """One encoder per Python worker and file."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = IdEncoder(path)
    return _TOKENIZERS[path]


def forget_tokenizers() -> None:
    """Lets go of this Python worker's encoders and their pieces, which a reused worker would hold through other steps."""
    _TOKENIZERS.clear()
