"""Protobuf log batches: ``LogBeans { repeated LogBean logBeans = 1; }``.

Decoding flattens each batch into one row per ``LogBean``.  When the
spark-protobuf package is on the classpath, ``from_protobuf`` (JVM, codegen)
+ ``explode`` is used; otherwise the batches are parsed in
``mapInArrow`` with one message class per task (the upb C parser does the
per-message work), in frames of a bounded number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftlog.schemas import LOG_BEAN

# The log schema -- field names, numbers and types.
PROTO_PACKAGE = "driftlog.log"
LOG_BEAN_FIELDS = (
    ("uid", 1, "string"),
    ("event_id", 2, "string"),
    ("event_name", 3, "string"),
    ("province", 4, "string"),
    ("city", 5, "string"),
    ("district", 6, "string"),
    ("longitude", 7, "double"),
    ("latitude", 8, "double"),
)
BATCH_FIELD = ("logBeans", 1)


def descriptor_set() -> bytes:
    """Serialized ``FileDescriptorSet`` of the log schema (also usable by ``from_protobuf``)."""
    from google.protobuf import descriptor_pb2

    fdp = descriptor_pb2.FileDescriptorProto(name="driftlog_log.proto", package=PROTO_PACKAGE,
                                             syntax="proto3")
    bean = fdp.message_type.add(name="LogBean")
    kinds = {"string": descriptor_pb2.FieldDescriptorProto.TYPE_STRING,
             "double": descriptor_pb2.FieldDescriptorProto.TYPE_DOUBLE}
    for name, number, kind in LOG_BEAN_FIELDS:
        bean.field.add(name=name, number=number, type=kinds[kind],
                       label=descriptor_pb2.FieldDescriptorProto.LABEL_OPTIONAL)
    beans = fdp.message_type.add(name="LogBeans")
    beans.field.add(name=BATCH_FIELD[0], number=BATCH_FIELD[1],
                    type=descriptor_pb2.FieldDescriptorProto.TYPE_MESSAGE,
                    type_name=f".{PROTO_PACKAGE}.LogBean",
                    label=descriptor_pb2.FieldDescriptorProto.LABEL_REPEATED)
    return descriptor_pb2.FileDescriptorSet(file=[fdp]).SerializeToString()


def message_classes():
    """(LogBeans, LogBean) classes built from the runtime descriptor."""
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

    pool = descriptor_pool.DescriptorPool()
    fds = descriptor_pb2.FileDescriptorSet.FromString(descriptor_set())
    for f in fds.file:
        pool.Add(f)
    beans = message_factory.GetMessageClass(pool.FindMessageTypeByName(f"{PROTO_PACKAGE}.LogBeans"))
    bean = message_factory.GetMessageClass(pool.FindMessageTypeByName(f"{PROTO_PACKAGE}.LogBean"))
    return beans, bean


_NAMES = [f[0] for f in LOG_BEAN_FIELDS]

#: Decoded rows handed on in one frame, whatever the number of rows in a payload.
FRAME_ROWS = 10_000


def native_available(spark) -> bool:
    """Whether the JVM has spark-protobuf (then payloads are decoded without Python)."""
    try:
        loader = spark.sparkContext._jvm.java.lang.Thread.currentThread().getContextClassLoader()
        loader.loadClass("org.apache.spark.sql.protobuf.ProtobufDataToCatalyst")
        return True
    except Exception:  # not on the classpath, or a session without a JVM gateway
        return False

_OUT_SCHEMA = ", ".join(f"{n} {k}" for n, _, k in LOG_BEAN_FIELDS)


def decode_log_batches(df: DataFrame, payload_col: str = "payload", on_corrupt: str = "error",
                       native: bool | None = None, keep: tuple[str, ...] = (),
                       item_col: str | None = None, frame_rows: int = FRAME_ROWS) -> DataFrame:
    """Binary ``LogBeans`` batches -> one row per ``LogBean`` (0..n per batch).

    ``keep`` columns of the batch row are repeated on each of its rows and
    ``item_col`` (if given) numbers the rows inside their batch, so
    ``(batch seq, item)`` orders decoded rows deterministically.
    ``on_corrupt``: ``"error"`` fails the task on bytes that do not parse
    (the reference's behaviour), ``"drop"`` skips the whole batch.
    Unset strings decode as ``""`` and unset doubles as ``0.0`` (proto3).
    ``native=None`` uses the JVM decoder wherever it is there.
    """
    if native is None:
        native = native_available(df.sparkSession)
    if on_corrupt not in ("error", "drop"):
        raise ValueError("on_corrupt must be 'error' or 'drop'")
    keep = tuple(keep)
    if native:
        from pyspark.sql.protobuf.functions import from_protobuf

        mode = "FAILFAST" if on_corrupt == "error" else "PERMISSIVE"
        msg = from_protobuf(F.col(payload_col), f"{PROTO_PACKAGE}.LogBeans",
                            binaryDescriptorSet=descriptor_set(), options={"mode": mode})
        items = F.posexplode(msg[BATCH_FIELD[0]]).alias("_i", "_b")
        out = df.select(*keep, items)
        return out.select(*keep, *([F.col("_i").cast("long").alias(item_col)] if item_col else []),
                          *[F.col("_b")[n].alias(n) for n in _NAMES])

    strict = on_corrupt == "error"
    extra = [df.schema[c] for c in keep]
    out_schema = T.StructType(extra + ([T.StructField(item_col, T.LongType())] if item_col else [])
                              + list(LOG_BEAN.fields))
    out_names = [f.name for f in out_schema.fields]

    def decode(batches):
        from operator import attrgetter

        import pyarrow as pa
        from google.protobuf.message import DecodeError

        beans_cls, _ = message_classes()
        fields = attrgetter(*_NAMES)
        kinds = [pa.string() if kind == "string" else pa.float64() for _, _, kind in LOG_BEAN_FIELDS]

        def frame(batch, values: list, owners: list, items: list) -> pa.RecordBatch:
            owner = pa.array(owners, pa.int64())
            columns = [batch.column(c).take(owner) for c in keep] + ([pa.array(items, pa.int64())] if item_col else [])
            columns += [pa.array(x, kind) for x, kind in zip(zip(*values), kinds)]
            return pa.RecordBatch.from_arrays(columns, out_names)

        # of a batch, only the rows of one frame are held beside its bytes
        for batch in batches:
            values: list[tuple] = []
            owners: list[int] = []
            items: list[int] = []
            for r, payload in enumerate(batch.column(payload_col)):
                if not payload.is_valid:
                    continue
                try:
                    msg = beans_cls.FromString(payload.as_py())
                except DecodeError:
                    if strict:
                        raise
                    continue
                beans = getattr(msg, BATCH_FIELD[0])
                for start in range(0, len(beans), frame_rows):
                    part = beans[start:start + frame_rows]
                    values.extend(map(fields, part))
                    owners.extend([r] * len(part))
                    items.extend(range(start, start + len(part)))
                    if len(values) >= frame_rows:
                        yield frame(batch, values, owners, items)
                        values, owners, items = [], [], []
            if values:
                yield frame(batch, values, owners, items)

    return df.select(*keep, payload_col).mapInArrow(decode, out_schema)


def encode_log_batches(df: DataFrame, rows_per_batch: int = 100, out_col: str = "payload",
                       seq_col: str | None = None) -> DataFrame:
    """Rows with the ``LogBean`` columns -> binary ``LogBeans`` batches.

    Batches are cut inside each partition (no shuffle); a batch holds at
    most ``rows_per_batch`` rows.  Null strings are left unset (proto3).
    With ``seq_col`` each batch also carries the ``seq_col`` value of its
    first row (like a record offset).
    """
    present = [n for n in _NAMES if n in df.columns]

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        beans_cls, _ = message_classes()
        for pdf in batches:
            out = []
            firsts = pdf[seq_col].iloc[::rows_per_batch].tolist() if seq_col else None
            # proto3 has no nulls: a null field is simply left unset
            records = [{k: v for k, v in rec.items() if v is not None and v == v}
                       for rec in pdf[present].to_dict("records")]
            for start in range(0, len(records), rows_per_batch):
                msg = beans_cls()
                items = getattr(msg, BATCH_FIELD[0])
                for rec in records[start:start + rows_per_batch]:
                    items.add(**rec)
                out.append(msg.SerializeToString())
            if out:
                frame = {seq_col: firsts, out_col: out} if seq_col else {out_col: out}
                yield pd.DataFrame(frame)

    schema = f"{seq_col} {df.schema[seq_col].dataType.simpleString()}, {out_col} binary" if seq_col \
        else f"{out_col} binary"
    return df.select(*([seq_col] if seq_col else []), *present).mapInPandas(encode, schema)
