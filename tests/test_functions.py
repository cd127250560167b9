from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from driftlog.functions import GEOHASH_ALPHABET, date_part, geohash5, hour_folder, split_drop_trailing


def bisection_geohash(lat, lon, precision=5):
    """Textbook geohash by interval halving (reference implementation for the test)."""
    lat_lo, lat_hi, lon_lo, lon_hi = -90.0, 90.0, -180.0, 180.0
    bits, even, out, ch = 0, True, [], 0
    while len(out) < precision:
        if even:
            mid = (lon_lo + lon_hi) / 2
            if lon >= mid:
                ch = ch * 2 + 1
                lon_lo = mid
            else:
                ch = ch * 2
                lon_hi = mid
        else:
            mid = (lat_lo + lat_hi) / 2
            if lat >= mid:
                ch = ch * 2 + 1
                lat_lo = mid
            else:
                ch = ch * 2
                lat_hi = mid
        even = not even
        bits += 1
        if bits == 5:
            out.append(GEOHASH_ALPHABET[ch])
            bits, ch = 0, 0
    return "".join(out)


def _hash(spark, pts):
    df = spark.createDataFrame(pts, "lat double, lon double")
    return [r[0] for r in df.select(geohash5("lat", "lon")).collect()]


def test_geohash_known_points(spark):
    got = _hash(spark, [(39.98941, 116.480881), (0.0, 0.0), (42.605, -5.603)])
    assert got == ["wx4g6", "s0000", "ezs42"]


def test_geohash_corners_edges_and_out_of_range(spark):
    pts = [(90.0, 180.0), (-90.0, -180.0), (90.0, -180.0), (-90.0, 180.0)]
    pts += [(10.0, -180.0 + 45.0 * k / 1024.0) for k in range(0, 8192, 977)]
    got = _hash(spark, pts)
    for (lat, lon), g in zip(pts, got):
        # the top edge belongs to the last cell in both algorithms (clamped)
        lat_c, lon_c = min(lat, 90.0 - 1e-12), min(lon, 180.0 - 1e-12)
        assert g == bisection_geohash(lat_c, lon_c), (lat, lon)
    assert _hash(spark, [(91.0, 0.0), (0.0, 180.5), (None, 1.0)]) == [None, None, None]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.floats(-90, 89.999), st.floats(-180, 179.999)), min_size=1, max_size=200))
def test_geohash_matches_bisection(spark, pts):
    assert _hash(spark, pts) == [bisection_geohash(a, b) for a, b in pts]


def test_geohash_matches_bisection_dense(spark):
    import random
    rnd = random.Random(7)
    pts = [(rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for _ in range(3000)]
    pts += [(0.0, -1e-51), (-1e-300, 0.0), (5e-324, -5e-324)]
    pts += [(-90 + 180 * k / 4096, -180 + 360 * k / 8192) for k in range(0, 4096, 13)]
    assert _hash(spark, pts) == [bisection_geohash(a, b) for a, b in pts]


def test_split_drop_trailing_java_semantics(spark):
    lines = ["a,b,c", "a,b,,", ",,,,", "", ",a", "a,,b"]
    df = spark.createDataFrame([(x,) for x in lines], "s string")
    got = [r[0] for r in df.select(split_drop_trailing("s")).collect()]
    assert got == [["a", "b", "c"], ["a", "b"], [""], [""], ["", "a"], ["a", "", "b"]]


def test_date_part_and_hour_folder(spark):
    df = spark.createDataFrame([("2024-01-01 17:30:00",)], "t string") \
        .withColumn("ts", F.to_timestamp("t"))
    r = df.select(date_part("t").alias("d"), hour_folder("ts").alias("h"),
                  hour_folder(F.col("ts").cast("timestamp_ntz")).alias("h2")).first()
    assert (r.d, r.h, r.h2) == ("2024-01-01", "2024-01-02--01", "2024-01-02--01")


def test_staged_and_column_forms_agree(spark):
    from driftlog.functions import with_geohash
    import random
    rnd = random.Random(11)
    pts = [(rnd.uniform(-95, 95), rnd.uniform(-185, 185)) for _ in range(500)] + [(None, 3.0)]
    df = spark.createDataFrame(pts, "lat double, lon double")
    a = with_geohash(df, "lat", "lon", "g").select("g").collect()
    b = df.select(geohash5("lat", "lon").alias("g")).collect()
    assert a == b
