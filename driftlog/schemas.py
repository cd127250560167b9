"""Record schemas of the three log formats and the dimension tables."""

from pyspark.sql import types as T

# One decoded protobuf log row (proto3: strings default to "", doubles to 0.0).
LOG_BEAN = T.StructType([
    T.StructField("uid", T.StringType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("province", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("district", T.StringType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
])

# CSV line fields in order: uid,eventName,time,eventTypeId,province
CSV_FIELDS = ["uid", "event_name", "time", "type_id", "province"]

# JSON log line, read with every field as text so that quoted numbers survive
# (they are converted with try_cast afterwards).
JSON_TEXT = T.StructType([
    T.StructField("uid", T.StringType()),
    T.StructField("time", T.StringType()),
    T.StructField("eventType", T.StringType()),
    T.StructField("jd", T.StringType()),
    T.StructField("wd", T.StringType()),
    T.StructField("province", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("area", T.StringType()),
])

# Event dictionary rows as stored in the source database.
DICTIONARY = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("last_update", T.StringType()),
])

# Place dictionary keyed by geohash cell.
PLACES = T.StructType([
    T.StructField("geohash5", T.StringType()),
    T.StructField("province", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("district", T.StringType()),
])
