"""Schemas shared by sources, transforms and sinks."""

from pyspark.sql import types as T

# --- Fixed values: record layouts that must match the producer and the tables ---
# JSON envelope payload as the producer writes it (timestamp is a string).
EVENT_JSON_SCHEMA = T.StructType([
    T.StructField("user_id", T.IntegerType(), False),
    T.StructField("product_id", T.IntegerType(), False),
    T.StructField("action", T.StringType(), False),
    T.StructField("timestamp", T.StringType(), False),
    T.StructField("device_id", T.StringType(), True),
    T.StructField("device_type", T.StringType(), True),
    T.StructField("location", T.StringType(), True),
    T.StructField("user_segment", T.StringType(), True),
    T.StructField("ip_address", T.StringType(), True),
])

# Columns of the raw event sink, in order (event_time is dropped at the sink).
RAW_COLS = [
    "user_id", "product_id", "action", "timestamp", "device_id",
    "device_type", "location", "user_segment", "ip_address",
]

# Columns a decoded event must carry to be analysable.
REQUIRED_COLS = ["user_id", "product_id", "action", "event_time"]

# Natural key of the raw event table.
RAW_KEY = ["user_id", "timestamp", "action", "device_id"]

# The same over the typed time, as the sink stores it.
RAW_TIME_KEY = ["user_id", "event_time", "action", "device_id"]

# Key of the summary and anomaly tables.
SUMMARY_KEY = ["user_id", "window_start", "window_end"]

# Alert record: one common shape for every detector.
ALERT_SCHEMA = T.StructType([
    T.StructField("user_id", T.IntegerType(), True),
    T.StructField("user_name", T.StringType(), True),
    T.StructField("region", T.StringType(), True),
    T.StructField("window_start", T.StringType(), True),
    T.StructField("window_end", T.StringType(), True),
    T.StructField("event_count", T.LongType(), True),
    T.StructField("detector_type", T.StringType(), True),
    T.StructField("score", T.DoubleType(), True),
    T.StructField("threshold", T.DoubleType(), True),
    T.StructField("severity", T.StringType(), True),
    T.StructField("reason", T.StringType(), True),
    T.StructField("detected_at", T.StringType(), True),
    T.StructField("batch_id", T.LongType(), True),
])

# Fields an alert must carry to be formatted for notification.
ALERT_REQUIRED = ["user_id", "event_count", "window_start", "window_end", "score", "severity"]

# JSON timestamp formats with full microsecond precision; Spark's defaults
# keep only milliseconds. Used by every to_json / from_json in the engine.
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
