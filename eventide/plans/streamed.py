"""Streaming plans over the driver tables.

The events are written once as a JSON-lines topic stand-in (derived by Spark
from the tables), then the streaming application drains it with an
``availableNow`` trigger into its sinks under the shared checkpoint folder;
each query reads one sink back. Results must equal the batch forms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventide.config import interval_seconds
from eventide.operators import changelog
from eventide.operators.detect import ZScoreDetector
from eventide.plans.batch import CFG
from eventide.schemas import JSON_OPTIONS, RAW_COLS, SUMMARY_KEY
from eventide.session import shared_dir
from eventide.sources.stream import file_source, write_json_lines
from eventide.sources.tables import events_from_tables, json_envelope, users_from_tables
from eventide.streaming.application import EventStreamApp, RefreshingDimension, drain_state_partitions
from eventide.streaming.sinks import SinkPaths, moments_so_far, settled_summary, summary_table

_RUNS: dict = {}


def prepare_topic(spark: SparkSession, sf_dir: str) -> str:
    """Write the events of ``sf_dir`` once as a JSON-lines topic stand-in;
    returns the run folder (the topic is ``<folder>/topic``)."""
    key = ("topic", spark.sparkContext.applicationId, sf_dir)
    if key not in _RUNS:
        root = shared_dir(spark, "stream")
        write_json_lines(json_envelope(events_from_tables(spark, sf_dir, CFG)), f"{root}/topic")
        _RUNS[key] = root
    return _RUNS[key]


def run_stream(spark: SparkSession, sf_dir: str,
               which=("raw_route", "archive", "summary_5s", "summary_1min")) -> SinkPaths:
    """Drain the event stream of ``sf_dir`` once per session; reuse the sinks."""
    key = (spark.sparkContext.applicationId, sf_dir, tuple(which))
    if key in _RUNS:
        return _RUNS[key]
    root = prepare_topic(spark, sf_dir)
    raw = file_source(spark, f"{root}/topic", fmt="text")
    users = RefreshingDimension(lambda: users_from_tables(spark, sf_dir, CFG))
    det = [ZScoreDetector(CFG.z_threshold, high_factor=CFG.severity_high_factor)]
    sinks = SinkPaths(f"{root}/sinks")
    pipe = EventStreamApp(spark, sinks, CFG, users=users, detectors=det, state_partitions=drain_state_partitions(spark))
    try:
        pipe.start(raw, trigger="availableNow", which=which)
        pipe.await_all()
    finally:
        pipe.stop()
    _RUNS[key] = sinks
    return sinks


SLICES = 7


def sliced_topic(spark: SparkSession, sf_dir: str, slices: int = SLICES, newest_first: bool = False) -> str:
    """The topic as ``slices`` files of equal spans of event time, written one after the
    other, so that a stream that takes a file at a time sees them in that order."""
    key = ("slices", spark.sparkContext.applicationId, sf_dir, slices, newest_first)
    if key not in _RUNS:
        root = shared_dir(spark, "sliced")
        rows = json_envelope(events_from_tables(spark, sf_dir, CFG))
        lo, hi = rows.agg(F.min("event_time"), F.max("event_time")).first()
        rows = rows.withColumn("_slice", F.lit(0) if lo is None else F.coalesce(F.least(F.lit(slices - 1), F.floor(
            F.lit(slices) * (F.unix_micros(F.col("event_time").cast("timestamp")) - F.unix_micros(F.lit(lo).cast("timestamp")))
            / F.lit(max(1, int((hi - lo).total_seconds() * 1_000_000))))), F.lit(0)))
        rows.write.partitionBy("_slice").parquet(f"{root}/rows")
        staged = spark.read.parquet(f"{root}/rows")
        for k in sorted(range(slices), reverse=newest_first):
            (staged.filter(F.col("_slice") == k).select("value").coalesce(1)
             .write.mode("append").text(f"{root}/topic"))
        _RUNS[key] = root
    return _RUNS[key]


def run_final_windows(spark: SparkSession, sf_dir: str, slices: int = SLICES) -> SinkPaths:
    """Drain the sliced topic a file at a time with every window emitted once."""
    key = ("final", spark.sparkContext.applicationId, sf_dir, slices)
    if key not in _RUNS:
        raw = file_source(spark, f"{sliced_topic(spark, sf_dir, slices)}/topic", fmt="text", max_files_per_trigger=1)
        sinks = SinkPaths(shared_dir(spark, "final-windows"))
        det = [ZScoreDetector(CFG.z_threshold, high_factor=CFG.severity_high_factor)]
        pipe = EventStreamApp(spark, sinks, CFG, detectors=det, final_windows=True, fold_every=3,
                              state_partitions=drain_state_partitions(spark))
        try:
            pipe.start(raw, trigger="availableNow", which=("summary_1min",))
            pipe.await_all()
        finally:
            pipe.stop()
        _RUNS[key] = sinks
    return _RUNS[key]


def _no_counts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "user_id int, window_start timestamp_ntz, window_end timestamp_ntz, event_count long")


def stream_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding counts of a stream in seven micro-batches, counted from panes: every
    window that the watermark has closed, once, read from the keyed table."""
    rows = summary_table(spark, run_final_windows(spark, sf_dir), "1min").read()
    return (_no_counts(spark) if rows is None else rows).select("window_start", "window_end", "user_id", "event_count")


def stream_anomalies_history(spark: SparkSession, sf_dir: str, slices: int = SLICES) -> DataFrame:
    """Anomalies against the moments of all closed windows, merged over the
    micro-batches: the number of those does not matter."""
    sinks = run_final_windows(spark, sf_dir, slices)
    rows = summary_table(spark, sinks, "1min").read()
    det = ZScoreDetector(CFG.z_threshold, high_factor=CFG.severity_high_factor)
    found = det.anomalies(_no_counts(spark) if rows is None else rows,
                          stats={"event_count": moments_so_far(spark, sinks, "1min").stats})
    return found.select("window_start", "window_end", "user_id", "event_count", F.round("score", 6).alias("score"), "severity")


def stream_late_recount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed that brings its newest events first: the stream's tumbling counts drop
    what comes behind the watermark, the recount from the archive settles them."""
    key = ("late", spark.sparkContext.applicationId, sf_dir)
    if key not in _RUNS:
        raw = file_source(spark, f"{sliced_topic(spark, sf_dir, newest_first=True)}/topic", fmt="text", max_files_per_trigger=1)
        sinks = SinkPaths(shared_dir(spark, "late"))
        pipe = EventStreamApp(spark, sinks, CFG, state_partitions=drain_state_partitions(spark))
        try:
            pipe.start(raw, trigger="availableNow", which=("archive", "summary_5s"))
            pipe.await_all()
        finally:
            pipe.stop()
        pipe.reconcile("5s")
        _RUNS[key] = sinks
    return settled_summary(spark, _RUNS[key], "5s").select("window_start", "window_end", "user_id", "event_count")


def _latest_summary(spark: SparkSession, path: str) -> DataFrame:
    log = spark.read.parquet(path)
    return changelog.latest_by_key(log, SUMMARY_KEY).select(
        "window_start", "window_end", "user_id", "event_count")


def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest_summary(spark, run_stream(spark, sf_dir).summary("5s"))


def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest_summary(spark, run_stream(spark, sf_dir).summary("1min"))


def stream_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid rows from the raw sink plus rejected rows from the dead letter."""
    sinks = run_stream(spark, sf_dir)
    valid = spark.read.parquet(sinks.raw).select(
        "user_id", "product_id", "action",
        F.col("event_time").cast("timestamp_ntz").alias("event_time"),
        F.lit(None).cast("string").alias("dq_reason"))
    schema = ("batch_id long, row struct<user_id int, product_id int, action string, "
              "event_time timestamp>, reason string")
    dead = spark.read.text(sinks.dlq).select(F.from_json("value", schema, JSON_OPTIONS).alias("d"))
    dead = dead.select(F.col("d.row.user_id").alias("user_id"),
                       F.col("d.row.product_id").alias("product_id"),
                       F.col("d.row.action").alias("action"),
                       F.col("d.row.event_time").cast("timestamp_ntz").alias("event_time"),
                       F.col("d.reason").alias("dq_reason"))
    return valid.unionByName(dead)


def stream_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    sinks = run_stream(spark, sf_dir)
    arch = spark.read.parquet(sinks.archive)
    return arch.select(*RAW_COLS, F.col("event_time").cast("timestamp_ntz").alias("event_time"))


ANOMALY_LOG_SCHEMA = ("window_start timestamp, window_end timestamp, user_id int, "
                      "event_count long, batch_id long")


def _exists(spark: SparkSession, path: str) -> bool:
    from eventide.sources.artifacts import _path_exists
    return _path_exists(spark, path)


def stream_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Z-score anomalies of the 1-minute sliding stream, insert-ignore view. The
    score is per micro-batch; the drain takes the topic as one, so the SQL's
    statistics over everything are the batch's."""
    sinks = run_stream(spark, sf_dir)
    path = sinks.anomalies("1min")
    if _exists(spark, path):
        log = spark.read.parquet(path).select(*SUMMARY_KEY, "batch_id", "event_count")
    else:
        log = spark.createDataFrame([], ANOMALY_LOG_SCHEMA)
    view = changelog.first_by_key(log, SUMMARY_KEY).drop("batch_id")
    return view.select("user_id", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                       F.col("window_end").cast("timestamp_ntz").alias("window_end"), "event_count")


def stream_alert_notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of the 1-minute sliding stream, consumed by the alert job:
    notification messages for high/medium severities."""
    from eventide.streaming.alerts import AlertJob, alert_source
    sinks = run_stream(spark, sf_dir)
    key = ("alerts", spark.sparkContext.applicationId, sf_dir)
    out = _RUNS.get(key)
    if out is None:
        out = SinkPaths(shared_dir(spark, "alert-job"))
        job = AlertJob(spark, out)
        src = sinks.path("alerts_1min")
        if not _exists(spark, src):
            return spark.createDataFrame([], "user_id int, severity string, message string")
        q = job.start(alert_source(spark, src), trigger="availableNow")
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        _RUNS[key] = out
    if not _exists(spark, out.path("notifications")):
        return spark.createDataFrame([], "user_id int, severity string, message string")
    notes = spark.read.option("recursiveFileLookup", "true").text(out.path("notifications"))
    return notes.select(F.from_json("value", "user_id int, severity string, message string")
                        .alias("n")).select("n.*")


def stream_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search documents of the 1-minute stream's anomalies, read back."""
    sinks = run_stream(spark, sf_dir)
    schema = "type string, user_id int, event_count long, distance double, detector_type string, severity string, " \
             "user_name string, region string, window_start string"
    docs = spark.read.text(sinks.path("documents_1min")).select(F.from_json("value", schema).alias("d")).select("d.*")
    return docs.withColumn("distance", F.round("distance", 6))


def stream_alert_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every alert payload that the alert job archived, whatever its severity."""
    stream_alert_notifications(spark, sf_dir)
    out = _RUNS[("alerts", spark.sparkContext.applicationId, sf_dir)]
    kept = spark.read.text(out.path("alert_archive")).select(
        F.from_json("value", "user_id int, event_count long, window_end string, severity string").alias("a"))
    return kept.select("a.*")


def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-batch metric rows of the stream, totalled per output: records,
    rejects and anomalies of the raw route and of both window queries."""
    sinks = run_stream(spark, sf_dir)
    parts = [spark.read.parquet(sinks.path(f"metrics_{name}"))
             for name in ("raw", "5s", "1min")]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return (rows.groupBy("type", F.coalesce("window_type", F.lit("")).alias("window_type"))
            .agg(F.sum("records").alias("records"), F.sum("rejected").alias("rejected"),
                 F.sum("anomalies").alias("anomalies")))


def registered() -> dict:
    return {
        "stream_tumbling": stream_tumbling,
        "stream_sliding": stream_sliding,
        "stream_route": stream_route,
        "stream_archive": stream_archive,
        "stream_anomalies": stream_anomalies,
        "stream_alert_notifications": stream_alert_notifications,
        "stream_metrics": stream_metrics,
        "stream_documents": stream_documents,
        "stream_alert_archive": stream_alert_archive,
        "stream_panes": stream_panes,
        "stream_late_recount": stream_late_recount,
        "stream_anomalies_history": stream_anomalies_history,
    }


def oracles(batch_sql: dict[str, str]) -> dict[str, str]:
    from eventide.config import ALERT_MESSAGE_FORMAT as MSG, UNKNOWN
    from eventide.plans import oracle as O
    req = ("user_id IS NOT NULL AND product_id IS NOT NULL AND action IS NOT NULL "
           "AND event_time IS NOT NULL")
    parsed = f"parsed AS (SELECT * FROM ev WHERE {req})"
    sink_reason = "NULLIF(concat_ws(',', " + ", ".join(
        f"CASE WHEN length({c}) > {n} THEN 'sink_{c}_too_long' END"
        for c, n in CFG.sink_max_lengths.items()) + "), '')"
    z = CFG.z_threshold
    zcol = "(event_count - avg(event_count) OVER ()) / NULLIF(stddev_samp(event_count) OVER (), 0)"
    # scored by window aggregates and filtered before the users are joined
    zs = f"""WITH {O.EVENTS_CTE.strip()}, {parsed},
{O.USERS_CTE.strip()},
z AS (SELECT *, {zcol} AS score FROM ({O._sliding(60, 5, 'parsed')})),
a AS (SELECT f.*, u.name AS user_name, u.region FROM (SELECT * FROM z WHERE score > {z}) f LEFT JOIN users u USING (user_id))"""
    sev = O._severity("score", str(z))
    metrics = f"""WITH {O.TAGGED_CTE.strip()},
parsed AS (SELECT * FROM ev WHERE {req}),
route AS (SELECT coalesce(dq_reason, {sink_reason}) AS reason FROM tagged),
w5 AS (SELECT {zcol} AS score FROM ({O._tumbling(5, 'parsed')})),
w60 AS (SELECT {zcol} AS score FROM ({O._sliding(60, 5, 'parsed')}))
SELECT 'raw_batch' AS type, '' AS window_type,
       count(*) FILTER (WHERE reason IS NULL) AS records,
       count(*) FILTER (WHERE reason IS NOT NULL) AS rejected,
       CAST(0 AS BIGINT) AS anomalies FROM route
UNION ALL
SELECT 'agg_batch', '5s', count(*), CAST(0 AS BIGINT), count(*) FILTER (WHERE score > {z}) FROM w5
UNION ALL
SELECT 'agg_batch', '1min', count(*), CAST(0 AS BIGINT), count(*) FILTER (WHERE score > {z}) FROM w60"""
    closed = f"""WITH {O.EVENTS_CTE.strip()}, {parsed},
top AS (SELECT max(event_time) - to_microseconds({int(interval_seconds(CFG.watermark_long) * 1_000_000)}) AS mark FROM parsed),
s AS (SELECT t.* FROM ({O._sliding(60, 5, 'parsed')}) t CROSS JOIN top WHERE t.window_end <= mark)"""
    iso = "'%Y-%m-%dT%H:%M:%S'"
    return {
        "stream_documents": zs + f"""
SELECT 'anomaly' AS type, user_id, event_count, round(score, 6) AS distance, 'zscore' AS detector_type, {sev} AS severity,
       user_name, region, strftime(window_start, {iso}) AS window_start FROM a WHERE score > {z}""",
        "stream_alert_archive": zs + f"""
SELECT user_id, event_count, strftime(window_end, {iso}) AS window_end, {sev} AS severity FROM a WHERE score > {z}""",
        "stream_metrics": metrics,
        "stream_late_recount": f"WITH {O.EVENTS_CTE.strip()}, {parsed}\n{O._tumbling(5, 'parsed')}",
        "stream_panes": closed + " SELECT window_start, window_end, user_id, event_count FROM s",
        "stream_anomalies_history": closed + f""",
z AS (SELECT *, {zcol} AS score FROM s)
SELECT window_start, window_end, user_id, event_count, round(score, 6) AS score, {sev} AS severity
FROM z WHERE score > {z}""",
        "stream_anomalies": zs + f"""
SELECT user_id, window_start, window_end, event_count FROM a WHERE score > {z}""",
        "stream_alert_notifications": zs + f"""
SELECT user_id, {sev} AS severity,
       printf('{MSG}',
              user_id, coalesce(user_name, '{UNKNOWN}'), coalesce(region, '{UNKNOWN}'), event_count,
              strftime(window_start, '%Y-%m-%dT%H:%M:%S'), strftime(window_end, '%Y-%m-%dT%H:%M:%S'),
              'zscore', round(score, 4), {sev}) AS message
FROM a WHERE score > {z}""",
        "stream_tumbling": f"WITH {O.EVENTS_CTE.strip()}, {parsed}\n{O._tumbling(5, 'parsed')}",
        "stream_sliding": f"WITH {O.EVENTS_CTE.strip()}, {parsed}\n{O._sliding(60, 5, 'parsed')}",
        "stream_archive": f"WITH {O.EVENTS_CTE.strip()}, {parsed}\n"
                          f"SELECT {O.RAW_COLS_SQL}, event_time FROM parsed",
        "stream_route": f"""WITH {O.TAGGED_CTE.strip()}
SELECT user_id, product_id, action, event_time,
       CASE WHEN coalesce(CAST(user_id AS VARCHAR), CAST(product_id AS VARCHAR), action, "timestamp", location) IS NULL
            THEN 'malformed_record' ELSE coalesce(dq_reason, {sink_reason}) END AS dq_reason
FROM tagged""",
    }
