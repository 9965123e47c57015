"""The alert consumer as a streaming job: decode alert JSON, split well-formed
from invalid-schema alerts, archive every payload, and emit notification
messages for the notifiable severities.

Size-or-time batching becomes a processing-time trigger plus a per-trigger
rate limit on the source; a trailing partial batch is not held back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from eventide.operators.alerts import NOTIFY_SEVERITIES, notifications, parse_alerts, split_alerts
from eventide.operators.changelog import batch_path, complete_batches
from eventide.streaming.sinks import SinkPaths, write_batch_json, write_batch_parquet


#: What makes an alert the same one, wherever its payload was read; one that carries no
#: batch id is known by its whole payload.
ALERT_KEY = ["batch_id", "window_start", "window_end", "user_id", "detector_type", "unbatched"]


def keyed(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn("unbatched", F.when(F.col("batch_id").isNull(), F.sha2("payload", 256)))


def unnotified(alerts: DataFrame, told: DataFrame | None) -> DataFrame:
    """One row for each alert that ``told`` does not hold. A key part that is null
    is a value like any other, so an alert without one is not told twice either."""
    once = alerts.dropDuplicates(ALERT_KEY)
    if told is None:
        return once
    seen = told.select(*[F.col(c).alias(f"_t_{c}") for c in ALERT_KEY])
    return once.join(seen, [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in ALERT_KEY], "left_anti")


class AlertJob:
    def __init__(self, spark: SparkSession, sinks: SinkPaths,
                 severities: Sequence[str] = NOTIFY_SEVERITIES):
        self.spark, self.sinks, self.severities = spark, sinks, tuple(severities)
        self.query: StreamingQuery | None = None

    def handle(self, batch_df: DataFrame, batch_id: int) -> None:
        df = batch_df.persist()
        try:
            if df.isEmpty():
                return
            parsed = parse_alerts(df).persist()
            valid, invalid = split_alerts(parsed)
            write_batch_json(parsed.select(F.col("payload").alias("value")),
                             self.sinks.path("alert_archive"), batch_id)
            # the same alert in an earlier batch of this job (a replayed upstream batch) is told once
            fresh = unnotified(keyed(valid), self.ledger(batch_id)).persist()
            notes = notifications(fresh, self.severities)
            write_batch_json(notes.select(F.to_json(F.struct("user_id", "severity", "message"))
                                          .alias("value")),
                             self.sinks.path("notifications"), batch_id)
            write_batch_json(invalid.select(F.col("payload").alias("value")),
                             self.sinks.path("alert_invalid"), batch_id)
            # last: until it stands, a replay of this batch writes the same notes again
            write_batch_parquet(fresh.select(*ALERT_KEY).dropDuplicates(), self.sinks.path("alert_ledger"), batch_id)
            fresh.unpersist()
            parsed.unpersist()
        finally:
            df.unpersist()

    def ledger(self, batch_id: int) -> DataFrame | None:
        """Keys of the alerts that other batches of this job have told."""
        path = self.sinks.path("alert_ledger")
        ids = [b for b in complete_batches(self.spark, path) if b != batch_id]
        if not ids:
            return None
        return self.spark.read.parquet(*[batch_path(path, b) for b in ids]).select(*ALERT_KEY)

    def start(self, alerts: DataFrame, trigger: str | None = "1 second") -> StreamingQuery:
        w = (alerts.select("value").writeStream.foreachBatch(self.handle)
             .option("checkpointLocation", self.sinks.checkpoint("alerts")))
        if trigger == "availableNow":
            w = w.trigger(availableNow=True)
        elif trigger:
            w = w.trigger(processingTime=trigger)
        self.query = w.start()
        return self.query


def alert_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None
                 ) -> DataFrame:
    """JSON-lines alerts under ``path`` (any depth), one ``value`` per line."""
    r = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)
