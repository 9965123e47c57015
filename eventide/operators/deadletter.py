"""Dead-letter records for rows rejected by parsing, validation or sink constraints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from eventide.schemas import JSON_OPTIONS, RAW_COLS

#: The raw table's unique key is taken, by an earlier batch or a row of this one.
REASON_KEY_CLASH = "sink_key_clash"


def dlq_records(rejected: DataFrame, batch_id: int | Column, reason_col: str = "dq_reason",
                row_cols: Sequence[str] | None = None, reported_at: Column | None = None) -> DataFrame:
    """``(batch_id long, row struct, reason, reported_at)`` — one record per rejected row."""
    cols = [c for c in (row_cols or [c for c in rejected.columns if c != reason_col])]
    bid = batch_id if isinstance(batch_id, Column) else F.lit(int(batch_id))
    ts = reported_at if reported_at is not None else F.current_timestamp()
    return rejected.select(bid.cast("long").alias("batch_id"),
                           F.struct(*[F.col(c) for c in cols]).alias("row"),
                           F.col(reason_col).alias("reason"),
                           F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("reported_at"))


def dlq_json(records: DataFrame) -> DataFrame:
    """JSON transport form: ``(key, value)``."""
    return records.select(F.col("batch_id").cast("string").alias("key"),
                          F.to_json(F.struct(*[F.col(c) for c in records.columns]), JSON_OPTIONS).alias("value"))


def sink_violations(df: DataFrame, max_lengths: dict, required: Sequence[str] = ("user_id", "product_id", "action", "timestamp")) -> Column:
    """Per-row check of the raw table's constraints (NOT NULL, column widths):
    the reason text (``sink_`` prefixed, so it never reads as a data-quality
    reason), or NULL when the row fits. Replaces all-or-nothing chunk failures
    with per-row routing."""
    parts = [F.when(F.col(c).isNull(), F.lit(f"sink_null_{c}")) for c in required if c in df.columns]
    for c, n in max_lengths.items():
        if c in df.columns:
            parts.append(F.when(F.length(F.col(c)) > n, F.lit(f"sink_{c}_too_long")))
    return F.nullif(F.concat_ws(",", *parts), F.lit(""))


def raw_sink_rows(df: DataFrame) -> DataFrame:
    """The raw table's projection: the nine event columns, timestamp typed."""
    out = df
    if "event_time" in df.columns:
        out = out.withColumn("timestamp", F.col("event_time"))
    return out.select(*RAW_COLS)
