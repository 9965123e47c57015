"""Per-batch metric rows (records, anomalies, rejects) without extra passes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

METRICS_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("window_type", T.StringType()),
    T.StructField("records", T.LongType()),
    T.StructField("anomalies", T.LongType()),
    T.StructField("rejected", T.LongType()),
    T.StructField("groups", T.LongType()),
    T.StructField("logged_at", T.TimestampType()),
])


def observed(df: DataFrame, name: str, moments_of: str | None = None
             ) -> tuple[DataFrame, Observation]:
    """Attach a row counter (and, with ``moments_of``, the mean and sample
    standard deviation of that column) that fills in as a side effect of the
    next action."""
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    if moments_of:
        v = F.col(moments_of).cast("double")
        metrics += [F.avg(v).alias("mean"), F.stddev_samp(v).alias("std")]
    return df.observe(obs, *metrics), obs


def observed_moments(obs: Observation) -> tuple[float | None, float | None]:
    got = obs.get
    return got.get("mean"), got.get("std")


def observed_rows(obs: Observation) -> int:
    """Rows counted by the action that ran the observed plan."""
    return int(obs.get["rows"])


def metrics_row(spark: SparkSession, kind: str, batch_id: int, records: int = 0,
                anomalies: int = 0, rejected: int = 0, groups: int = 0,
                window_type: str | None = None) -> DataFrame:
    """One metrics document per batch, emitted for every non-empty batch.
    Built as a JVM-side projection (no Python rows shipped)."""
    return spark.range(1).select(
        F.lit(kind).alias("type"), F.lit(int(batch_id)).cast("long").alias("batch_id"),
        F.lit(window_type).cast("string").alias("window_type"),
        F.lit(int(records)).cast("long").alias("records"),
        F.lit(int(anomalies)).cast("long").alias("anomalies"),
        F.lit(int(rejected)).cast("long").alias("rejected"),
        F.lit(int(groups)).cast("long").alias("groups"),
        F.current_timestamp().alias("logged_at"))
