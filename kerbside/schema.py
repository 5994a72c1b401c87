"""Fixed schemas of the tables that enter and leave the library."""

from pyspark.sql import types as T

# One row per vehicle seen by a road sensor.
PASSAGES = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("highway_id", T.IntegerType()),
        T.StructField("plate", T.StringType()),
        T.StructField("speed", T.DoubleType()),
        T.StructField("ev", T.BooleanType()),
    ]
)

# The same row as it travels in text form (CSV cell or JSON member): the time
# is still text and may be malformed.
RAW_PASSAGES = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("highway_id", T.IntegerType()),
        T.StructField("plate", T.StringType()),
        T.StructField("speed", T.DoubleType()),
        T.StructField("ev", T.BooleanType()),
    ]
)

# Keyed records of a topic.
RECORDS = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
    ]
)

# Output of the trailing mean.
AVERAGES = T.StructType(
    [
        T.StructField("highway_id", T.StringType()),
        T.StructField("avg_speed", T.DoubleType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
    ]
)

# A log line with its labels; ``id`` makes every order total.
LOGS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
        T.StructField("line", T.StringType()),
    ]
)

DETAIL_COLUMNS = ["timestamp", "highway_id", "plate", "speed", "ev"]
