from driftlog.operators.places import (decode_place_text, encode_place_text, enrich_places,
                                       enrich_with_fill, fill_place_cache, missing_cells,
                                       parse_geocoder_response)

PLACE_SCHEMA = "geohash5 string, province string, city string, district string"


def _resolver(cells):
    from pyspark.sql import functions as F
    return cells.select("geohash5", F.concat(F.lit("P@"), F.col("lon").cast("string")).alias("province"),
                        F.lit("C").alias("city"), F.lit("D").alias("district"))


def test_cache_fill_cases(spark):
    # wx4g6: hit; s0000: stored as empty text (miss); ezs42: two events, first one decides
    places = spark.createDataFrame([("wx4g6", "P1", "C1", "D1"), ("s0000", "", "", "")], PLACE_SCHEMA)
    facts = spark.createDataFrame(
        [(0, 39.98941, 116.480881), (1, 0.0, 0.0), (5, 42.605, -5.603), (3, 42.6051, -5.6031)],
        "seq long, lat double, lon double")
    enriched, grown = enrich_with_fill(facts, places, _resolver)
    g = {r.geohash5: (r.province, r.city, r.district) for r in grown.collect()}
    assert g == {"wx4g6": ("P1", "C1", "D1"), "s0000": ("P@0.0", "C", "D"), "ezs42": ("P@-5.6031", "C", "D")}
    e = {r.seq: r.province for r in enriched.collect()}
    assert e == {0: "P1", 1: "P@0.0", 5: "P@-5.6031", 3: "P@-5.6031"}
    assert missing_cells(enriched.drop("province"), grown).count() == 0


def test_enrich_left_join_keeps_unknown(spark):
    places = spark.createDataFrame([("wx4g6", "P1", "C1", "D1")], PLACE_SCHEMA)
    facts = spark.createDataFrame([(0, "wx4g6", "old"), (1, "zzzzz", "old")], "seq long, geohash5 string, province string")
    got = {r.seq: (r.province, r.city) for r in enrich_places(facts, places).collect()}
    assert got == {0: ("P1", "C1"), 1: (None, None)}


def test_codec_trailing_empty_and_round_trip(spark):
    enc = spark.createDataFrame([("c1", "a,b,"), ("c2", "a,b,c"), ("c3", "")], "geohash5 string, text string")
    got = {r.geohash5: (r.province, r.city, r.district) for r in decode_place_text(enc).collect()}
    assert got == {"c1": ("a", "b", None), "c2": ("a", "b", "c"), "c3": (None, None, None)}
    p = spark.createDataFrame([("c1", "x", None, "z")], PLACE_SCHEMA)
    assert [tuple(r) for r in decode_place_text(encode_place_text(p)).collect()] == [("c1", "x", None, "z")]


def test_geocoder_response_parse(spark):
    docs = [("c1", '{"regeocode":{"addressComponent":{"province":"P","city":"C","district":"D"}}}'),
            ("c2", '{"regeocode":{"addressComponent":{"province":"P","city":[],"district":"D"}}}'),
            ("c3", '{"regeocode":{"addressComponent":{"province":"P","city":"","district":"D"}}}')]
    df = spark.createDataFrame(docs, "geohash5 string, response string")
    got = {r.geohash5: (r.province, r.city, r.district) for r in parse_geocoder_response(df).collect()}
    assert got == {"c1": ("P", "C", "D"), "c2": ("P", None, "D"), "c3": ("P", None, "D")}


def test_fill_with_python_geocoder(spark):
    from driftlog.operators.places import geocoder_resolver

    def factory():
        calls = []

        def fetch(lon, lat):
            calls.append((lon, lat))
            return ('{"regeocode":{"addressComponent":{"province":"G%.1f","city":"c","district":"d"}}}' % lon)
        return fetch

    places = spark.createDataFrame([], PLACE_SCHEMA)
    facts = spark.createDataFrame([(0, 10.0, 20.0), (1, 10.0, 20.0)], "seq long, lat double, lon double")
    from driftlog.operators.places import with_geohash5
    grown = fill_place_cache(with_geohash5(facts), places, geocoder_resolver(factory))
    assert [(r.province, r.city) for r in grown.collect()] == [("G20.0", "c")]
