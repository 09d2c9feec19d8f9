"""Types and fixed values of the telemetry data."""

from pyspark.sql import types as T

# ---- fixed values -----------------------------------------------------------------

# Key given to a message that arrives without one.
DEFAULT_KEY = "unknown_station"

# Humidity above which an alert is raised.
ALERT_THRESHOLD = 70

# Alert texts; the placeholders are humidity and temperature.
ALERT_TEXT = '{\n    "alert": "RAIN DETECTED",\n    "humidity": %d,\n    "temperature": %d\n}\n'
ALERT_INVALID_TEXT = '{\n    "alert": "INVALID DATA"\n}\n'

# Battery level reported for readings of an external feed.
FEED_BATTERY = "high"

# Header of the snapshot export.
SNAPSHOT_HEADER = "key,value"

# A log file ends at 64 MB; a message has about 200 bytes.
LOG_ROWS_PER_FILE = 64 * 1024 * 1024 // 200

# How often the topic is polled.
POLL_INTERVAL = "100 milliseconds"

# The ingest writes files, so a batch waits for so many rows or so long.
BATCH_ROWS = 10_000
BATCH_DELAY = "1 minute"

# ---- messages ---------------------------------------------------------------------

MESSAGE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# Flat readings, in the order of the archive.
READING = T.StructType(
    [
        T.StructField("station_id", T.LongType()),
        T.StructField("s_no", T.LongType()),
        T.StructField("battery_status", T.StringType()),
        T.StructField("status_timestamp", T.LongType()),
        T.StructField("humidity", T.IntegerType()),
        T.StructField("temperature", T.IntegerType()),
        T.StructField("wind_speed", T.IntegerType()),
    ]
)

# The wire form nests these fields under one object.
NESTED = "weather"
NESTED_FIELDS = ("humidity", "temperature", "wind_speed")

# ---- change log, feed -------------------------------------------------------------

LOG = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("version", T.LongType()),
    ]
)

# Log of messages. Batch ids follow arrival, and the epoch grows with each new checkpoint,
# so a message that arrives later counts as later even if offsets begin anew or its key
# moves to another partition. Inside a batch the record's time comes first; it can be set
# by the producer, so it must not decide over batches.
ARRIVAL = ["epoch", "batch", "timestamp", "partition", "offset"]
ARRIVALS = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("epoch", T.LongType()),
        T.StructField("batch", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)

# Documents of the external feed. Leaves are text because the numbers are coerced
# leniently, see functions.json_text.
FEED = T.StructType(
    [
        T.StructField(
            "current",
            T.StructType(
                [
                    T.StructField("time", T.StringType()),
                    T.StructField("interval", T.StringType()),
                    T.StructField("temperature_2m", T.StringType()),
                    T.StructField("relative_humidity_2m", T.StringType()),
                    T.StructField("wind_speed_10m", T.StringType()),
                ]
            ),
        )
    ]
)
