"""WARC archives: writing, normalising whole-file gzip, and reading by index.

``write_archives`` writes each part of the pages as one gzip stream over the
whole file, the form some crawlers leave behind.  ``normalise`` inflates such a
stream once, rewrites every record as a gzip member of its own, and writes a
sidecar index with each member's offset and length, after which any record can
be read alone.  Files live in the shared folder; a file gets its final name only
once it is complete, so a retried task replaces it with an equal one.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlog.llm.common import filesystem, new_folder, staged, table

#: Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_TYPES = ("warcinfo", "response", "revisit")

DATE = "1970-01-01T00:00:00Z"
#: Smaller payloads are always stored.
LEAST_REVISIT_BYTES = 100
#: An archive is closed once its records exceed this (before compression).
ARCHIVE_BYTES = 64 << 20
_CHUNK = 1 << 20


def record_plan(pages: DataFrame, least_bytes: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """``page_id, url, payload, payload_digest, refers_to``: which page stores a payload and which refers to it.

    Digests are reduced to one row each (combined before the shuffle); only the
    digests that several pages share are joined back, and Spark splits a hot one.
    """
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha2("payload", 256))
    shared = (rows.where(F.octet_length("payload") >= least_bytes).groupBy("payload_digest")
              .agg(F.min("page_id").alias("first_page"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    joined = rows.join(shared, "payload_digest", "left")
    refers = F.when(F.col("page_id") != F.col("first_page"), F.col("first_page"))
    return joined.select("page_id", "url", "payload", "payload_digest", refers.alias("refers_to"))


def _name(page_id, salt: int) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:page:none-{salt}>"


def _header(kind: str, record_id: str, length: int, fields: list[tuple[str, str]]) -> bytes:
    lines = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", DATE), *fields, ("Content-Length", str(length))]
    text = "".join(f"{k}: {v}\r\n" for k, v in lines)
    return VERSION + b"\r\n" + text.encode() + b"\r\n"


def page_record(page_id, url, payload: bytes, digest: str, refers_to, salt: int = 0) -> bytes:
    """One WARC record: a response with the payload, or a revisit that names the response."""
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url) if url else _name(page_id, salt)[1:-1]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    fields = [("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if refers_to is None:
        block = http + payload
        fields.append(("Content-Type", "application/http;msgtype=response"))
        return _header("response", _name(page_id, salt), len(block), fields) + block + b"\r\n\r\n"
    fields += [("WARC-Refers-To", _name(refers_to, 0)), ("WARC-Profile", REVISIT_PROFILE),
               ("Content-Type", "application/http;msgtype=response")]
    return _header("revisit", _name(page_id, salt), len(http), fields) + http + b"\r\n\r\n"


class _NewFile:
    """A file in the shared folder that appears under its name when closed well."""

    def __init__(self, path: str) -> None:
        self.files, self.to = filesystem(path)
        self.files.create_dir(os.path.dirname(self.to), recursive=True)
        self.part = f"{self.to}.{uuid.uuid4().hex[:8]}.part"
        self.out, self.at = self.files.open_output_stream(self.part, compression=None), 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def close(self) -> None:
        self.out.close()
        self.files.move(self.part, self.to)


def write_archives(plan: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the planned records as whole-file gzip archives; returns the staged list of ``file, n_records``."""
    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        part, files, counts = TaskContext.get().partitionId(), [], []
        out = packer = None
        held = 0

        def close():
            out.write(packer.flush())
            out.close()

        for batch in batches:
            for k, (page, url, payload, digest, refers) in enumerate(zip(*(c.to_pylist() for c in batch.columns))):
                if out is None or held > archive_bytes:
                    if out is not None:
                        close()
                    files.append(f"{folder}/part-{part:06d}-{len(files):06d}.warc.gz")
                    counts.append(0)
                    out, packer, held = _NewFile(files[-1]), zlib.compressobj(6, zlib.DEFLATED, 31), 0
                    info = b"format: WARC File Format 1.1\r\n"
                    fields = [("Content-Type", "application/warc-fields")]
                    first = _header("warcinfo", f"<urn:archive:{part}-{len(files)}>", len(info), fields) + info + b"\r\n\r\n"
                    out.write(packer.compress(first))
                salt = f"{part}-{len(files)}-{counts[-1]}"
                record = page_record(page, url, payload, digest, refers, salt)
                out.write(packer.compress(record))
                held += len(record)
                counts[-1] += 1
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(counts, pa.int64())], ["file", "n_records"])

    return staged(plan.mapInArrow(write, "file string, n_records bigint"), "archives")


def inflated(path: str):
    """The bytes of a gzip file of any number of members, in chunks."""
    files, at = filesystem(path)
    with files.open_input_stream(at, compression=None) as f:
        unzip = zlib.decompressobj(31)
        while data := f.read(_CHUNK):
            while data:
                yield unzip.decompress(data)
                data = unzip.unused_data
                if unzip.eof:
                    unzip = zlib.decompressobj(31)
        if tail := unzip.flush():
            yield tail


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def records(chunks):
    """``(header bytes, fields, iterator of block chunks)`` for each record of an inflated stream.

    A block is handed on in chunks, so a record larger than memory passes through.
    """
    buffer, chunks = bytearray(), iter(chunks)

    def more() -> bool:
        data = next(chunks, None)
        if data is None:
            return False
        buffer.extend(data)
        return True

    while True:
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            if not more():
                if bytes(buffer).strip():
                    raise ValueError("the archive ends inside a header")
                return
        head = bytes(buffer[:end + 4])
        fields = _fields(head)
        left = int(fields["content-length"]) + 4
        del buffer[:end + 4]

        def block():
            nonlocal left
            while left:
                if not buffer and not more():
                    raise ValueError("the archive ends inside a record")
                part = bytes(buffer[:left])
                del buffer[:len(part)]
                left -= len(part)
                yield part

        yield head, fields, block()
        for _ in block():  # whatever the caller left
            pass


INDEX_SCHEMA = "file string, offset long, length long, type string, record_id string, refers_to string, digest string"


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite each listed archive record by record; returns the staged list of ``file, index, n_records``."""
    n = max(1, min(archives.count(), 100_000))

    def rewrite(batches):
        import pyarrow as pa
        for batch in batches:
            for path in batch.column(0).to_pylist():
                to = f"{folder}/{os.path.basename(path)}"
                out, index, count = _NewFile(to), _NewFile(f"{folder}/index/{os.path.basename(path)}.json"), 0
                for head, fields, block in records(inflated(path)):
                    start, member = out.at, zlib.compressobj(6, zlib.DEFLATED, 31)
                    out.write(member.compress(head))
                    for part in block:
                        out.write(member.compress(part))
                    out.write(member.flush())
                    index.write(json.dumps({
                        "file": to, "offset": start, "length": out.at - start, "type": fields.get("warc-type"),
                        "record_id": fields.get("warc-record-id"), "refers_to": fields.get("warc-refers-to"),
                        "digest": fields.get("warc-payload-digest")}).encode() + b"\n")
                    count += 1
                out.close()
                index.close()
                yield pa.RecordBatch.from_pydict({"file": [to], "index": [f"{folder}/index/{os.path.basename(path)}.json"],
                                                  "n_records": [count]})

    spread = archives.select("file").repartition(n, "file")
    return staged(spread.mapInArrow(rewrite, "file string, index string, n_records bigint"), "normalised")


def read_index(spark, folder: str) -> DataFrame:
    """The sidecar index of a folder of normalised archives, one row per record."""
    return spark.read.schema(INDEX_SCHEMA).json(f"{folder}/index")


def read_records(index: DataFrame) -> DataFrame:
    """Read each indexed record by its offset: ``type, record_id, refers_to, digest, payload``.

    ``payload``: what follows the HTTP header, null for revisits.
    """
    def read(batches):
        import pyarrow as pa
        opened: dict = {}
        try:
            for batch in batches:
                payloads = []
                for file, offset, length, kind in zip(*(batch.column(k).to_pylist() for k in range(4))):
                    if file not in opened:
                        for f in opened.values():
                            f.close()
                        opened.clear()
                        files, at = filesystem(file)
                        opened[file] = files.open_input_file(at)
                    opened[file].seek(offset)
                    raw = zlib.decompress(opened[file].read(length), 31)
                    end = raw.index(b"\r\n\r\n") + 4
                    size = int(_fields(raw[:end])["content-length"])
                    payloads.append(raw[end:end + size].partition(b"\r\n\r\n")[2] if kind == "response" else None)
                yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in (3, 4, 5, 6)), pa.array(payloads, pa.binary())],
                                                 ["type", "record_id", "refers_to", "digest", "payload"])
        finally:
            for f in opened.values():
                f.close()

    return index.where("type != 'warcinfo'").mapInArrow(
        read, "type string, record_id string, refers_to string, digest string, payload binary")


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages to archives, normalised, and read back by index:
    ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    Of equal payloads of at least 100 bytes the smallest page_id is stored (all
    rows, if repeated); a null page_id is always stored and reads back as null;
    null html is an empty payload; a null url
    is replaced by the record's name; extra columns are ignored; an empty table
    gives no archives and no rows.
    """
    spark = pages.sparkSession
    raw, clean = new_folder(spark, "warc-raw"), new_folder(spark, "warc")
    lists = normalise(write_archives(record_plan(pages), raw), clean)
    if not lists.take(1):
        return spark.createDataFrame(
            [], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    found = read_records(read_index(spark, clean)).select(
        page("record_id").alias("page_id"), F.col("type").alias("record_type"), page("refers_to").alias("refers_to"),
        F.octet_length("payload").cast("long").alias("own_bytes"), F.sha2("payload", 256).alias("own_digest"),
        F.regexp_replace("digest", "^sha256:", "").alias("digest"))
    found = staged(found, "records")
    stored = (found.where("record_type = 'response' and page_id is not null")
              .select(F.col("page_id").alias("stored_page"), F.col("own_bytes").alias("stored_bytes"),
                      F.col("own_digest").alias("stored_digest")).dropDuplicates(["stored_page"]))
    named = found.where("record_type = 'revisit'").select("refers_to").distinct()
    stored = stored.join(named, F.col("stored_page") == F.col("refers_to"), "left_semi")
    out = found.join(stored, F.col("refers_to") == F.col("stored_page"), "left")
    return out.select("page_id", F.coalesce("own_bytes", "stored_bytes").alias("payload_bytes"),
                      F.coalesce("own_digest", "stored_digest").alias("payload_digest"), "record_type", "refers_to")


def op3_warc_normalise(spark, sf_dir: str) -> DataFrame:
    """Every page's record as read back from the normalised archives."""
    return round_trip(table(spark, sf_dir, "pages"))


ORACLE_OP3 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
     f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_page FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {LEAST_REVISIT_BYTES} AND page_id <> first_page THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {LEAST_REVISIT_BYTES} AND page_id <> first_page THEN first_page END AS refers_to
FROM f
"""
