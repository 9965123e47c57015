"""The streaming application: one parsed stream, four concurrent queries.

- ``raw_route``   validate every row; valid rows → raw table change log,
                  rejected rows → dead letter (with reason), one metrics row.
- ``archive``     parsed events → parquet, partitioned by event date.
- ``summary_<w>`` event-time window counts with a watermark, update mode;
                  each batch → summary change log, enrichment, detectors,
                  anomaly change log, alerts, documents, metrics.

Every transform is the batch transform from ``eventide.operators``; only the
wiring lives here.
"""

from __future__ import annotations

import logging
import signal
import threading
import time
from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from eventide.config import EngineConfig
from eventide.functions import quality
from eventide.functions.decode import parse_events
from eventide.functions.text import to_copy_text
from eventide.operators import changelog, reconcile, windows
from eventide.operators.alerts import alert_records, anomaly_documents, to_kafka_rows
from eventide.operators.deadletter import REASON_KEY_CLASH, dlq_json, dlq_records, raw_sink_rows, sink_violations
from eventide.operators.detect import Detector, detect
from eventide.operators.enrich import enrich
from eventide.operators.key_index import KeyIndex
from eventide.operators.metrics import metrics_row, observed, observed_moments, observed_rows
from eventide.operators.moments import Moments
from eventide.schemas import RAW_COLS, RAW_TIME_KEY, REQUIRED_COLS
from eventide.sources.jdbc import write_jdbc
from eventide.streaming.sinks import (SinkPaths, anomaly_table, correction_table, moments_so_far, summary_table, write_batch_json,
                                      write_batch_kafka, write_batch_parquet)

log = logging.getLogger(__name__)


class RefreshingDimension:
    """A static dimension for stream-static joins, reloaded every
    ``refresh_seconds`` (None: loaded once) instead of frozen at start-up."""

    def __init__(self, loader: Callable[[], DataFrame], refresh_seconds: float | None = None):
        self.loader, self.refresh_seconds = loader, refresh_seconds
        self._df: DataFrame | None = None
        self._previous: DataFrame | None = None   # a handler may still read it
        self._loaded_at = 0.0
        self._lock = threading.Lock()   # handlers of concurrent queries share it

    def get(self) -> DataFrame:
        """The current dimension. The one before it stays cached until the next
        reload, as other handlers may be reading it."""
        with self._lock:
            stale = self.refresh_seconds is not None and \
                time.time() - self._loaded_at > self.refresh_seconds
            if self._df is None or stale:
                if self._previous is not None:
                    self._previous.unpersist()
                self._previous, self._df = self._df, self.loader().persist()
                self._loaded_at = time.time()
            return self._df


#: State partitions a drain may have at least, however few executors have registered.
LEAST_STATE_PARTITIONS = 24


def drain_state_partitions(spark: SparkSession) -> int:
    """``state_partitions`` for a drain with a checkpoint of its own: the session's shuffle
    partitions, but at most two for each core of the cluster. A stateful operator has a
    metric for every one of its partitions and each of its tasks sends them all, so
    what reaches the driver grows with the square of this number; and each partition
    is opened and committed once a batch, with or without rows."""
    most = max(LEAST_STATE_PARTITIONS, 2 * spark.sparkContext.defaultParallelism)
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), most)


class EventStreamApp:
    def __init__(self, spark: SparkSession, sinks: SinkPaths, cfg: EngineConfig | None = None,
                 users: RefreshingDimension | None = None,
                 detectors: Sequence[Detector] | Callable[[], Sequence[Detector]] = (),
                 fmt: str = "json", avro_schema: str | None = None, framed: bool = False,
                 dedup_raw: bool = False, repartition_by_user: int | None = None,
                 kafka_brokers: str | None = None, raw_jdbc: dict | None = None,
                 copy_text: bool = False, action_detectors: Sequence[Detector] = (),
                 state_partitions: int | None = None, summary_source: str = "raw",
                 sink_files: int | None = None, fold_every: int | None = None, final_windows: bool = False, unique_raw: bool = False):
        """``repartition_by_user``: hash-partition parsed rows by user_id into
        that many partitions (off by default: the stateful aggregation
        re-shuffles on (window, user_id) anyway). ``kafka_brokers``: also send
        dead letters and alerts to the configured topics. ``raw_jdbc``:
        ``{"url", "table", "properties"}`` to also append valid rows over JDBC in
        batches of ``copy_chunk`` rows (at-least-once). ``copy_text``: also write
        valid rows as tab-separated bulk-load text under ``raw_copy``.
        ``dedup_raw``: one row per raw key within a micro-batch; duplicates in
        other batches are settled by the keyed raw view (``changelog.dedup_rows``
        over the log), so no late row is lost to a watermark.
        ``action_detectors``: detectors whose model works on (window, user,
        action) counts; they get their own aggregation at that grain (queries
        ``actions_5s`` / ``actions_1min``), so scoring matches training.
        ``state_partitions``: shuffle partitions of the stateful window
        queries. Streaming disables AQE and a checkpoint freezes this number at
        the first start, so size it for the state (keys per partition), not
        the session default. ``summary_source="archive"``: the window queries
        read the archive (an exactly-once parquet file sink) as a stream instead
        of decoding the topic again, so each event is decoded twice (route,
        archive) rather than four times; the windows then trail the archive by
        one trigger. ``sink_files``: merge each micro-batch's output into at
        most that many files per sink (the batch is cached, so only the write
        tasks are merged). ``fold_every``: fold the summary and anomaly logs of a
        window query into their keyed tables' bases after every that many
        batches; a fold reads the new batches and the dates they touch.
        ``final_windows``: emit every window once, when the watermark has passed
        it (append mode, counted from panes: a slide's pane is one state row),
        instead of each change; detectors then score against the moments of
        all windows so far, not of one micro-batch. ``unique_raw``: the raw key is
        unique over all batches: an index of the accepted keys tells rows whose
        key is there, however long ago, and they go to the dead letter as
        ``sink_key_clash``."""
        if summary_source not in ("raw", "archive"):
            raise ValueError("summary_source must be 'raw' or 'archive'")
        self.summary_source = summary_source
        self.spark, self.sinks, self.cfg = spark, sinks, cfg or EngineConfig()
        self.users, self.detectors = users, detectors
        self.fmt, self.avro_schema, self.framed = fmt, avro_schema, framed
        self.dedup_raw, self.repartition_by_user = dedup_raw, repartition_by_user
        self.kafka_brokers, self.raw_jdbc, self.copy_text = kafka_brokers, raw_jdbc, copy_text
        self.action_detectors = list(action_detectors)
        self.state_partitions = state_partitions
        self.sink_files, self.fold_every, self.final_windows = sink_files, fold_every, final_windows
        self.key_index = KeyIndex(spark, sinks.path("_keys/raw"), RAW_TIME_KEY) if unique_raw else None
        self.queries: dict[str, StreamingQuery] = {}

    # --- plan pieces -----------------------------------------------------------

    def parsed(self, raw: DataFrame, keep_rejects: bool = False, fields: tuple[str, ...] | None = None) -> DataFrame:
        df = parse_events(raw, self.cfg, self.fmt, self.avro_schema, self.framed, keep_rejects, fields=fields)
        if self.repartition_by_user:
            df = df.repartition(self.repartition_by_user, "user_id")
        return windows.to_event_timestamp(df)

    def archived(self) -> DataFrame:
        """The archive as a streaming source (reads only committed files)."""
        from eventide.schemas import EVENT_JSON_SCHEMA
        from pyspark.sql import types as T
        schema = T.StructType(list(EVENT_JSON_SCHEMA.fields) + [
            T.StructField("event_time", T.TimestampType()),
            T.StructField("event_date", T.DateType())])
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.sinks.archive)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
        df = self.spark.readStream.schema(schema).parquet(self.sinks.archive)
        return df.drop("event_date")

    def counted_input(self, raw: DataFrame) -> DataFrame:
        """What the windows count. Events of the future are left out in any case:
        they reach the dead letter by the route, and one of them would push the
        watermark past everybody else's events."""
        if self.summary_source == "archive":
            df = self.archived()
        else:
            fields = (*REQUIRED_COLS, "timestamp", "location") if self.cfg.count_input == "valid" \
                else (*REQUIRED_COLS, "timestamp")
            df = self.parsed(raw, fields=fields)
        df = df.filter(F.col("event_time") <= F.current_timestamp())
        if self.cfg.count_input == "valid":
            df = df.filter(quality.dq_reason(self.cfg).isNull())
        return df

    def _detectors(self) -> Sequence[Detector]:
        return self.detectors() if callable(self.detectors) else self.detectors

    # --- foreachBatch handlers --------------------------------------------------

    def _files(self, df: DataFrame) -> DataFrame:
        return df.coalesce(self.sink_files) if self.sink_files else df

    def route_batch(self, batch_df: DataFrame, batch_id: int) -> None:
        """Validate and route one micro-batch (tagged and cached once, read by each sink)."""
        reason = F.coalesce(F.col("parse_reason"), F.col("dq_reason"),
                            sink_violations(raw_sink_rows(batch_df), self.cfg.sink_max_lengths))
        tagged = quality.with_dq_reason(batch_df, self.cfg).withColumn("reject_reason", reason)
        tagged, marked = tagged.persist(), None
        try:
            if tagged.isEmpty():
                return
            valid = tagged.filter(F.col("reject_reason").isNull())
            rejected = tagged.filter(F.col("reject_reason").isNotNull())
            if self.dedup_raw:
                valid = changelog.dedup_rows(valid)
            if self.key_index:
                marked = self.key_index.mark(valid, batch_id).persist()
                valid = marked.filter(~F.col("key_clash")).drop("key_clash")
                clashed = marked.filter("key_clash").withColumn("reject_reason", F.lit(REASON_KEY_CLASH))
                rejected = rejected.unionByName(clashed.drop("key_clash"))
            good, good_obs = observed(
                raw_sink_rows(valid).withColumn("event_time", F.col("timestamp")), f"raw_{batch_id}")
            write_batch_parquet(self._files(good), self.sinks.raw, batch_id)
            if self.key_index:  # a replay before this line finds the index as it was
                self.key_index.add(valid, batch_id)
                if self.fold_every and (batch_id + 1) % self.fold_every == 0:
                    self.key_index.fold()
            if self.copy_text:
                write_batch_json(to_copy_text(raw_sink_rows(valid), RAW_COLS), self.sinks.path("raw_copy"),
                                 batch_id, value_col="line")
            if self.raw_jdbc:
                write_jdbc(raw_sink_rows(valid), self.raw_jdbc["url"], self.raw_jdbc["table"],
                           self.raw_jdbc.get("properties"), batch_size=self.cfg.copy_chunk)
            recs = dlq_records(rejected, batch_id, reason_col="reject_reason",
                               row_cols=RAW_COLS + ["event_time", "_raw"])
            bad, bad_obs = observed(dlq_json(recs), f"dlq_{batch_id}")
            write_batch_json(self._files(bad), self.sinks.dlq, batch_id)
            if self.kafka_brokers:
                write_batch_kafka(dlq_json(recs), self.kafka_brokers, self.cfg.dlq_topic)
            write_batch_parquet(metrics_row(self.spark, "raw_batch", batch_id,
                                            records=observed_rows(good_obs),
                                            rejected=observed_rows(bad_obs)),
                                self.sinks.path("metrics_raw"), batch_id)
        finally:
            tagged.unpersist()
            if marked is not None:
                marked.unpersist()

    def summary_batch(self, batch_df: DataFrame, batch_id: int, window_type: str,
                      detectors: Sequence[Detector] | None = None) -> None:
        """Persist the changed window counts, detect, enrich the anomalies, alert."""
        summary = windows.to_wall_clock(windows.flatten_window(batch_df)).persist()
        try:
            if summary.isEmpty():
                return
            keys = ["window_start", "window_end", "user_id"] + \
                (["action"] if "action" in summary.columns else [])
            out, obs = observed(summary.select(*keys, "event_count"),
                                f"summary_{window_type}_{batch_id}", moments_of="event_count")
            write_batch_parquet(self._files(out), self.sinks.summary(window_type), batch_id)
            n_records = observed_rows(obs)
            stats = observed_moments(obs)
            if self.final_windows:
                stats = self._history(window_type, batch_id, Moments.of(n_records, *stats))
            n_anom = 0
            dets = self._detectors() if detectors is None else detectors
            # the z-score statistics were observed during the write: no extra pass
            found = detect(summary, dets, eager=True,
                           stats={"event_count": stats})
            if found is not None:
                # names and regions are looked up for the anomalies only
                if self.users is not None:
                    found = enrich(found, self.users.get())
                found = found.persist()
                anom, anom_obs = observed(
                    found.select(*keys, "event_count",
                                 "detector_type", "score", "threshold", "severity", "reason",
                                 F.current_timestamp().alias("detected_at")),
                    f"anomalies_{window_type}_{batch_id}")
                write_batch_parquet(self._files(anom), self.sinks.anomalies(window_type), batch_id)
                n_anom = observed_rows(anom_obs)
                recs = alert_records(found, batch_id)
                write_batch_json(to_kafka_rows(recs), self.sinks.path(f"alerts_{window_type}"),
                                 batch_id)
                if self.kafka_brokers:
                    write_batch_kafka(to_kafka_rows(recs), self.kafka_brokers,
                                      self.cfg.alert_topic)
                self.write_documents(anomaly_documents(recs), window_type, batch_id)
                found.unpersist()
            write_batch_parquet(metrics_row(self.spark, "agg_batch", batch_id, records=n_records,
                                            anomalies=n_anom, window_type=window_type),
                                self.sinks.path(f"metrics_{window_type}"), batch_id)
            self._fold(window_type, batch_id, found is not None)
        finally:
            summary.unpersist()

    def _history(self, window_type: str, batch_id: int, own: Moments) -> tuple[float | None, float | None]:
        """Mean and deviation of all final windows up to this batch. A batch's folder holds
        its own moments and those of everything up to it, so the one before it
        is all there is to read, and a replay starts from the same."""
        before = moments_so_far(self.spark, self.sinks, window_type, below=batch_id)
        total = before + own
        row = self.spark.range(1).select(
            *[F.lit(v).alias(f"{kind}{c}") for kind, m in (("", own), ("total_", total))
              for c, v in (("n", m.n), ("mean", m.mean), ("m2", m.m2))])
        write_batch_parquet(row, self.sinks.path(f"moments_{window_type}"), batch_id)
        return total.stats

    def _fold(self, window_type: str, batch_id: int, with_anomalies: bool) -> None:
        if not self.fold_every or (batch_id + 1) % self.fold_every:
            return
        if not window_type.endswith("_action"):  # that grain has a key of its own
            summary_table(self.spark, self.sinks, window_type).fold()
        if with_anomalies:
            anomaly_table(self.spark, self.sinks, window_type).fold()

    def write_documents(self, documents: DataFrame, window_type: str, batch_id: int) -> None:
        """Where the documents of the anomalies go; override for another store."""
        write_batch_json(documents, self.sinks.path(f"documents_{window_type}"), batch_id)

    # --- queries -----------------------------------------------------------------

    def _windows(self, raw: DataFrame, duration: str, watermark: str, keys=("user_id",)) -> DataFrame:
        counted, slide = self.counted_input(raw), self.cfg.window_slide
        if self.final_windows:
            return windows.pane_counts(counted, duration, slide, watermark, keys=keys)
        return windows.block_counts(counted, duration, slide, watermark, keys=keys)

    def _trigger(self, w, trigger):
        if trigger == "availableNow":
            return w.trigger(availableNow=True)
        if trigger:
            return w.trigger(processingTime=trigger)
        return w

    def _start_stateful(self, writer):
        """Start a stateful query with ``state_partitions`` shuffle partitions
        (the session value is restored afterwards)."""
        if not self.state_partitions:
            return writer.start()
        conf = self.spark.conf
        before = conf.get("spark.sql.shuffle.partitions")
        conf.set("spark.sql.shuffle.partitions", str(self.state_partitions))
        try:
            return writer.start()
        finally:
            conf.set("spark.sql.shuffle.partitions", before)

    def start(self, raw: DataFrame, trigger: str | None = None,
              which: Sequence[str] = ("raw_route", "archive", "summary_5s", "summary_1min")
              ) -> dict[str, StreamingQuery]:
        """Start the named queries; ``trigger`` is a processing-time interval,
        ``"availableNow"`` (drain and stop), or None for the configured one.
        The short-window summary runs without a trigger, as fast as possible."""
        cfg = self.cfg
        trig = trigger if trigger is not None else cfg.trigger
        mode = "append" if self.final_windows else "update"
        if "raw_route" in which:
            routed = self.parsed(raw, keep_rejects=True)
            w = (routed.writeStream.outputMode("append")
                 .foreachBatch(self.route_batch)
                 .option("checkpointLocation", self.sinks.checkpoint("raw_route")))
            self.queries["raw_route"] = self._trigger(w, trig).start()
        if "archive" in which or self.summary_source == "archive":
            arch = self.parsed(raw).withColumn("event_date", F.to_date("event_time"))
            w = (arch.writeStream.format("parquet").outputMode("append")
                 .option("path", self.sinks.archive)
                 .option("checkpointLocation", self.sinks.checkpoint("archive"))
                 .partitionBy("event_date"))
            self.queries["archive"] = self._trigger(w, trig).start()
            if self.summary_source == "archive" and trigger == "availableNow":
                # a drain reads what the archive has committed: let it finish first
                self.queries["archive"].awaitTermination()
        for name, dur, wm, trig_q in (
                ("summary_5s", cfg.window_short, cfg.watermark_short,
                 "availableNow" if trigger == "availableNow" else None),
                ("summary_1min", cfg.window_long, cfg.watermark_long, trig)):
            if name not in which:
                continue
            counts = self._windows(raw, dur, wm)
            w = (counts.writeStream.outputMode(mode)
                 .foreachBatch(partial(self.summary_batch, window_type=name.split("_", 1)[1]))
                 .option("checkpointLocation", self.sinks.checkpoint(name)))
            self.queries[name] = self._start_stateful(self._trigger(w, trig_q))
            if self.action_detectors:
                aname = name.replace("summary", "actions")
                counts = self._windows(raw, dur, wm, ("user_id", "action"))
                w = (counts.writeStream.outputMode(mode)
                     .foreachBatch(partial(self.summary_batch,
                                           window_type=aname.split("_", 1)[1] + "_action",
                                           detectors=self.action_detectors))
                     .option("checkpointLocation", self.sinks.checkpoint(aname)))
                self.queries[aname] = self._start_stateful(self._trigger(w, trig_q))
        return self.queries

    def reconcile(self, window_type: str, closed_before=None) -> int | None:
        """Recount the windows of one size whose archive holds more events than the stream
        counted, and log the corrections; the batch id, None without a summary.
        ``closed_before`` leaves out windows that the stream still counts."""
        summary = summary_table(self.spark, self.sinks, window_type).read()
        if summary is None:
            return None
        found = correction_table(self.spark, self.sinks, window_type).read()
        duration = self.cfg.window_short if window_type == "5s" else self.cfg.window_long
        archive = self.spark.read.parquet(self.sinks.archive).filter(F.col("event_time") <= F.current_timestamp())
        if self.cfg.count_input == "valid":
            archive = archive.filter(quality.dq_reason(self.cfg).isNull())
        return reconcile.reconcile(self.spark, archive, reconcile.settled(summary, found),
                                   self.sinks.path(f"corrections_{window_type}"), duration, self.cfg.window_slide, closed_before)

    def await_all(self, timeout: float | None = None) -> None:
        for q in self.queries.values():
            q.awaitTermination(timeout)
        for name, q in self.queries.items():
            if q.exception() is not None:
                raise RuntimeError(f"query {name} failed: {q.exception()}")

    def stop(self) -> None:
        for q in self.queries.values():
            try:
                q.stop()
            except Exception:  # noqa: BLE001
                log.exception("stopping %s", q.name)

    def run_forever(self) -> None:
        """Await any termination; stop every query on SIGTERM/SIGINT or failure."""
        def _stop(signum, frame):
            self.stop()
        signal.signal(signal.SIGTERM, _stop)
        signal.signal(signal.SIGINT, _stop)
        try:
            self.spark.streams.awaitAnyTermination()
        finally:
            self.stop()
