"""Alert records, their JSON transport, and the alert stream (validate, format,
notify), re-expressed as DataFrame transforms instead of a polling consumer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventide.schemas import ALERT_REQUIRED, ALERT_SCHEMA, JSON_OPTIONS

from eventide.config import (ALERT_MESSAGE_FORMAT, ALERT_TS_FORMAT as ISO_SECONDS,
                             NOTIFY_SEVERITIES, UNKNOWN)


def iso(c: Column) -> Column:
    return F.date_format(c, ISO_SECONDS)


def alert_records(anomalies: DataFrame, batch_id: int | Column | None = None,
                  detected_at: Column | None = None) -> DataFrame:
    """Common alert shape for every detector (``ALERT_SCHEMA`` order).

    ``anomalies`` carries window_start/end, user_id, event_count, the detector
    columns and optionally user_name/region."""
    cols = set(anomalies.columns)
    bid = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    return anomalies.select(
        F.col("user_id").cast("int").alias("user_id"),
        (F.col("user_name") if "user_name" in cols else F.lit(None)).cast("string").alias("user_name"),
        (F.col("region") if "region" in cols else F.lit(None)).cast("string").alias("region"),
        iso(F.col("window_start")).alias("window_start"),
        iso(F.col("window_end")).alias("window_end"),
        F.col("event_count").cast("long").alias("event_count"),
        F.col("detector_type"), F.col("score").cast("double").alias("score"),
        F.col("threshold").cast("double").alias("threshold"),
        F.col("severity"), F.col("reason"),
        iso(detected_at if detected_at is not None else F.current_timestamp()).alias("detected_at"),
        bid.cast("long").alias("batch_id"),
    )


def to_kafka_rows(records: DataFrame, key_col: str = "user_id") -> DataFrame:
    """``(key, value)`` strings, the shape of a Kafka or JSON-lines sink."""
    return records.select(F.col(key_col).cast("string").alias("key"),
                          F.to_json(F.struct(*[F.col(c) for c in records.columns]), JSON_OPTIONS).alias("value"))


def anomaly_documents(records: DataFrame) -> DataFrame:
    """Search-index documents for anomalies (one JSON document per row)."""
    doc = F.struct(F.lit("anomaly").alias("type"), "user_id", "event_count", "window_start",
                   "window_end", F.col("score").alias("distance"), "detector_type", "severity",
                   "user_name", "region", "detected_at", "batch_id")
    return records.select(F.to_json(doc, JSON_OPTIONS).alias("value"))


def parse_alerts(raw: DataFrame) -> DataFrame:
    """JSON ``value`` → alert columns; fields absent from the payload are NULL."""
    return raw.select(F.from_json(F.col("value").cast("string"), ALERT_SCHEMA, JSON_OPTIONS).alias("a"),
                      F.col("value").cast("string").alias("payload")).select("a.*", "payload")


def split_alerts(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(well-formed, invalid-schema) by the required fields.

    Persist ``parsed`` first when both sides (or further filters) are used:
    otherwise Catalyst pushes the filters below the ``from_json`` projection
    and each alert is parsed again inside the filter."""
    ok = F.lit(True)
    for c in ALERT_REQUIRED:
        ok = ok & F.col(c).isNotNull()
    tagged = parsed.withColumn("_ok", F.coalesce(ok, F.lit(False)))
    return tagged.filter("_ok").drop("_ok"), tagged.filter(~F.col("_ok")).drop("_ok")


def alert_message() -> Column:
    """Multi-line notification text; unknown name or region reads ``Unknown``."""
    return F.format_string(
        ALERT_MESSAGE_FORMAT,
        F.col("user_id"), F.coalesce(F.col("user_name"), F.lit(UNKNOWN)),
        F.coalesce(F.col("region"), F.lit(UNKNOWN)), F.col("event_count"),
        F.col("window_start"), F.col("window_end"),
        F.coalesce(F.col("detector_type"), F.lit("unknown")), F.round(F.col("score"), 4),
        F.col("severity"))


def notifications(valid: DataFrame, severities=NOTIFY_SEVERITIES) -> DataFrame:
    """Messages to deliver: only the listed severities are notified."""
    return (valid.filter(F.coalesce(F.col("severity").isin(*severities), F.lit(False)))
            .select("user_id", "severity", alert_message().alias("message")))
