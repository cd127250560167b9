import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from driftlog.sources.protobuf import decode_log_batches, encode_log_batches, message_classes

# One row u001, event 1, longitude 116.480881, latitude 39.989410.
GOLDEN = bytes.fromhex("0a1b0a04753030311201313923111ac1c61e5d4041ed2aa4fca4fe4340")
CORRUPT = bytes.fromhex("0a056162")


def _payloads(spark, items):
    return spark.createDataFrame([(i, p) for i, p in enumerate(items)], "seq long, payload binary")


def test_golden_message(spark):
    rows = decode_log_batches(_payloads(spark, [GOLDEN])).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.uid, r.event_id, r.event_name, r.province, r.city, r.district) == ("u001", "1", "", "", "", "")
    assert (r.longitude, r.latitude) == (116.480881, 39.98941)


def test_empty_batch_and_several_rows(spark):
    beans, _ = message_classes()
    m = beans()
    for i in range(3):
        b = m.logBeans.add()
        b.uid = f"u{i}"
        b.latitude = float(i)
    rows = decode_log_batches(_payloads(spark, [b"", m.SerializeToString()]), keep=("seq",),
                              item_col="item").collect()
    assert [(r.seq, r.item, r.uid, r.latitude) for r in rows] == [(1, 0, "u0", 0.0), (1, 1, "u1", 1.0),
                                                                  (1, 2, "u2", 2.0)]


def test_corrupt_bytes(spark):
    df = _payloads(spark, [GOLDEN, CORRUPT])
    with pytest.raises(PySparkException):
        decode_log_batches(df).collect()
    assert decode_log_batches(df, on_corrupt="drop").count() == 1


text = st.text(alphabet=st.characters(min_codepoint=32, max_codepoint=0x2FFF), max_size=8)
bean = st.tuples(text, text, text, text, text, text,
                 st.floats(allow_nan=False, allow_infinity=False),
                 st.floats(allow_nan=False, allow_infinity=False))


@settings(max_examples=8, deadline=None)
@given(st.lists(bean, min_size=0, max_size=60), st.integers(1, 7))
def test_round_trip(spark, rows, per_batch):
    schema = ("uid string, event_id string, event_name string, province string, city string, "
              "district string, longitude double, latitude double")
    df = spark.createDataFrame(rows, schema)
    back = decode_log_batches(encode_log_batches(df, rows_per_batch=per_batch))
    norm = sorted(tuple(0.0 if isinstance(v, float) and v == 0 else v for v in r) for r in back.collect())
    want = sorted(tuple(0.0 if isinstance(v, float) and v == 0 else v for v in r) for r in rows)
    assert norm == want


def test_golden_message_with_all_fields(spark):
    """Bytes written out by hand: tags 1 to 6 are texts, 7 and 8 little-endian doubles."""
    import struct
    texts = b"".join(bytes([n << 3 | 2, 1]) + c for n, c in zip(range(1, 7), (b"u", b"2", b"n", b"p", b"c", b"d")))
    bean = texts + b"\x39" + struct.pack("<d", 1.5) + b"\x41" + struct.pack("<d", -2.0)
    r = decode_log_batches(_payloads(spark, [b"\x0a" + bytes([len(bean)]) + bean])).collect()
    assert [tuple(x) for x in r] == [("u", "2", "n", "p", "c", "d", 1.5, -2.0)]


def test_frames_are_bounded_and_complete(spark):
    from driftlog.sources.protobuf import native_available
    beans, _ = message_classes()
    m = beans()
    for i in range(25):
        m.logBeans.add().uid = f"u{i}"
    df = _payloads(spark, [m.SerializeToString(), b"", m.SerializeToString()])
    got = decode_log_batches(df, native=False, item_col="item", frame_rows=4).collect()
    assert sorted((r.uid, r.item) for r in got) == sorted(2 * [(f"u{i}", i) for i in range(25)])
    assert native_available(spark) in (True, False)


def test_decoder_holds_one_small_frame_and_keeps_columns_exact(spark):
    """Rows leave in frames of at most ten thousand; kept whole numbers with nulls among them do not pass through pandas."""
    from driftlog.sources import protobuf
    beans, _ = message_classes()
    m = beans()
    m.logBeans.add().uid = "u"
    df = spark.createDataFrame([(None, m.SerializeToString()), ((1 << 60) + 1, m.SerializeToString())], "seq long, payload binary").coalesce(1)
    got = decode_log_batches(df, native=False, keep=("seq",)).collect()
    assert {r.seq for r in got} == {None, (1 << 60) + 1} and protobuf.FRAME_ROWS <= 10_000
