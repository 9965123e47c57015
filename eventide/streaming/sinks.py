"""Sink layout of a pipeline run and idempotent per-batch writers.

Every per-batch writer replaces the folder ``batch_id=N`` it owns, so what a
micro-batch wrote before a failure is gone when its replay has been written, also
where the replay yields no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventide.operators.changelog import append_batch, batch_path, complete_batches
from eventide.operators.keyed_table import KeyedTable
from eventide.operators.moments import Moments
from eventide.operators.reconcile import settled
from eventide.schemas import SUMMARY_KEY


@dataclass(frozen=True)
class SinkPaths:
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def raw(self) -> str: return self.path("raw_events")
    @property
    def dlq(self) -> str: return self.path("dead_letter")
    @property
    def archive(self) -> str: return self.path("archive")

    def summary(self, window_type: str) -> str: return self.path(f"summary_{window_type}")
    def anomalies(self, window_type: str) -> str: return self.path(f"anomalies_{window_type}")
    def base(self, name: str) -> str: return self.path(f"_tables/{name}")
    def checkpoint(self, query: str) -> str: return self.path(f"_checkpoints/{query}")


#: Base parts of the keyed tables: one for each date of their windows.
WINDOW_DATE = "to_date(window_start)"


def summary_table(spark: SparkSession, sinks: SinkPaths, window_type: str) -> KeyedTable:
    """The keyed summary of one window size: the last write of a user and window wins."""
    return KeyedTable(spark, sinks.summary(window_type), sinks.base(f"summary_{window_type}"), SUMMARY_KEY, part=WINDOW_DATE)


def anomaly_table(spark: SparkSession, sinks: SinkPaths, window_type: str) -> KeyedTable:
    """The keyed anomalies of one output: the first detection of a user and window wins."""
    return KeyedTable(spark, sinks.anomalies(window_type), sinks.base(f"anomalies_{window_type}"), SUMMARY_KEY, keep="first",
                      order_cols=("detected_at", "detector_type", "batch_id"), part=WINDOW_DATE)


def correction_table(spark: SparkSession, sinks: SinkPaths, window_type: str) -> KeyedTable:
    """Counts of late rows, which the stream dropped, of one window size."""
    return KeyedTable(spark, sinks.path(f"corrections_{window_type}"), sinks.base(f"corrections_{window_type}"), SUMMARY_KEY,
                      part=WINDOW_DATE)


def settled_summary(spark: SparkSession, sinks: SinkPaths, window_type: str) -> DataFrame | None:
    """The keyed summary with the corrections of late rows; None where nothing was written."""
    rows = summary_table(spark, sinks, window_type).read()
    return None if rows is None else settled(rows, correction_table(spark, sinks, window_type).read())


def moments_so_far(spark: SparkSession, sinks: SinkPaths, window_type: str, below: int | None = None) -> Moments:
    """Moments of the counts of all final windows up to the last batch (below an id):
    the same numbers whatever micro-batches the windows came in."""
    path = sinks.path(f"moments_{window_type}")
    ids = [b for b in complete_batches(spark, path) if below is None or b < below]
    if not ids:
        return Moments()
    row = spark.read.parquet(batch_path(path, ids[-1])).first()
    return Moments(row["total_n"], row["total_mean"], row["total_m2"])


# One micro-batch into a change log under ``batch_id=<id>`` (replay-safe).
write_batch_parquet = append_batch


def write_batch_json(df: DataFrame, path: str, batch_id: int, value_col: str = "value") -> None:
    """JSON-lines documents under ``batch_id=N`` (a topic / index stand-in)."""
    df.select(F.col(value_col).alias("value")).write.mode("overwrite").text(batch_path(path, batch_id))


def write_batch_kafka(df: DataFrame, brokers: str, topic: str) -> None:
    """``(key, value)`` rows to a Kafka topic (at-least-once; consumers dedupe on batch_id)."""
    (df.select(F.col("key").cast("string"), F.col("value").cast("string"))
       .write.format("kafka").option("kafka.bootstrap.servers", brokers)
       .option("topic", topic).save())
