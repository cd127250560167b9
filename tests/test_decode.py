import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from driftlog.operators.decode import encode_json_events, parse_csv_events, parse_json_events

CSV_CASES = [
    ("u1,act1,2024-01-01 08:00:00,1,p1", ("u1", "act1", "2024-01-01 08:00:00", "1", "p1")),
    ("u1,act1,2024-01-01 08:00:00,1,", None),
    ("u1,act1,2024-01-01 08:00:00", None),
    ("u1,,2024-01-01 08:00:00,1,p1", ("u1", "", "2024-01-01 08:00:00", "1", "p1")),
    ("u1,act1,2024-01-01 08:00:00,1,p1,x", ("u1", "act1", "2024-01-01 08:00:00", "1", "p1")),
    ("", None),
    (",,,,", None),
    (None, None),
]


def _lines(spark, lines):
    return spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "seq long, line string")


def test_csv_edge_rows(spark):
    df = _lines(spark, [c[0] for c in CSV_CASES])
    got = {r.seq: (r.uid, r.event_name, r.time, r.type_id, r.province, r.cnt)
           for r in parse_csv_events(df).collect()}
    want = {i: exp + (1,) for i, (_, exp) in enumerate(CSV_CASES) if exp is not None}
    assert got == want


def test_csv_flag_and_error_policies(spark):
    df = _lines(spark, [c[0] for c in CSV_CASES])
    flagged = parse_csv_events(df, on_corrupt="flag")
    assert flagged.count() == len(CSV_CASES)
    assert flagged.where("_corrupt").count() == sum(1 for c in CSV_CASES if c[1] is None)
    with pytest.raises(PySparkException):
        parse_csv_events(df, on_corrupt="error").collect()
    good = _lines(spark, ["a,b,c,d,e"])
    assert parse_csv_events(good, on_corrupt="error").count() == 1


JSON_CASES = [
    ('{"uid":"a","eventType":"flow_x","jd":116.4,"wd":39.9}', ("a", "flow_x", 116.4, 39.9)),
    ('{"uid":"a","jd":116.4,"extra":1}', ("a", None, 116.4, 0.0)),
    ("{}", (None, None, 0.0, 0.0)),
    ('{"uid":5,"jd":"116.4"}', ("5", None, 116.4, 0.0)),
    ('{"uid":"a","jd":null}', ("a", None, 0.0, 0.0)),
    ('{"uid":"a","jd":"abc"}', None),
    ("not json", None),
    ("null", None),
    ("[1]", None),
    ('[{"uid":"z"}]', None),
    ("", None),
    (None, None),
]


def test_json_edge_rows(spark):
    df = _lines(spark, [c[0] for c in JSON_CASES])
    got = {r.seq: (r.uid, r.event_type, r.jd, r.wd) for r in parse_json_events(df).collect()}
    want = {i: exp for i, (_, exp) in enumerate(JSON_CASES) if exp is not None}
    assert got == want


def test_json_encode_omits_nulls_and_sorts_keys(spark):
    df = spark.createDataFrame([(1, "u", "2024-01-01 00:00:00", "flow_a", 116.5, 39.9, None, None, None)],
                               "seq long, uid string, time string, event_type string, jd double, wd double,"
                               " province string, city string, area string")
    r = encode_json_events(df).first()
    assert r.json == '{"eventType":"flow_a","jd":116.5,"time":"2024-01-01 00:00:00","uid":"u","wd":39.9}'


def test_json_round_trip(spark):
    df = spark.createDataFrame([(1, "u1", "t", "flow_a", 1.5, -2.25, "p", "c", "d")],
                               "seq long, uid string, time string, event_type string, jd double, wd double,"
                               " province string, city string, area string")
    back = parse_json_events(encode_json_events(df).withColumnRenamed("json", "line"))
    assert back.drop("seq").collect() == df.drop("seq").collect()


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

field = st.text(alphabet=st.characters(blacklist_characters=",\n\r", min_codepoint=32, max_codepoint=0x2FFF),
                max_size=6)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(field, field, field, field, field.filter(lambda s: s != "")), max_size=30))
def test_csv_round_trip(spark, rows):
    lines = [(i, ",".join(r)) for i, r in enumerate(rows)]
    df = spark.createDataFrame(lines, "seq long, line string")
    got = {r.seq: (r.uid, r.event_name, r.time, r.type_id, r.province) for r in parse_csv_events(df).collect()}
    assert got == {i: r for i, r in enumerate(rows)}


text = st.one_of(st.none(), st.text(max_size=8))
num = st.floats(allow_nan=False, allow_infinity=False, width=64)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(text, text, text, num, num, text, text, text), max_size=30))
def test_json_round_trip_property(spark, rows):
    data = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "seq long, uid string, time string, event_type string, jd double, wd double,"
                                     " province string, city string, area string")
    back = parse_json_events(encode_json_events(df).withColumnRenamed("json", "line"))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)


def test_text_behind_the_object_is_corrupt(spark):
    lines = ['{"uid":"a"}{"uid":"b"}', '{"uid":"a"} garbage', '{"uid":"a"}]', '{"uid":"a"}}', '{"uid":"a"},{"uid":"b"}',
             '{"uid":"ok"} \n', ' {"uid":"ok2","jd":"","wd":"1.5"}', "", "null", "[1]"]
    df = spark.createDataFrame(list(enumerate(lines)), "seq long, line string")
    got = {r.seq: (r.uid, r.jd, r.wd) for r in parse_json_events(df).collect()}
    assert got == {5: ("ok", 0.0, 0.0), 6: ("ok2", 0.0, 1.5)}


def test_line_end_is_a_last_field(spark):
    lines = ["u,e,t,1,\n", "u,e,t,1,\r", "u,e,t,1,", "u,e,t,1,p\n", "u,e,t,1,,,\n"]
    df = spark.createDataFrame(list(enumerate(lines)), "seq long, line string")
    got = {r.seq: r.province for r in parse_csv_events(df).collect()}
    assert got == {0: "\n", 1: "\r", 3: "p\n", 4: ""}


def test_a_line_that_closes_the_wrapper_itself_is_corrupt(spark):
    """Text behind the object, also where it closes the array that the line is parsed in."""
    good = '{"uid":"a","time":"t","eventType":"e","jd":1,"wd":2}'
    tails = ["", "  ", "}]garbage", "}]", '},{"v":1}]', '}, {"uid":"b"}]x', ',"x":1', ',{"_end_of_line":1},{}', "]", '}]{"v":{"uid":"b"}']
    df = spark.createDataFrame([(i, good + t) for i, t in enumerate(tails)], "seq long, line string")
    assert sorted(r.seq for r in parse_json_events(df).collect()) == [0, 1]
    flagged = {r.seq: r._corrupt for r in parse_json_events(df, on_corrupt="flag").collect()}
    assert flagged == {i: i > 1 for i in range(len(tails))}
