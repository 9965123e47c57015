"""Command line: ``python -m eventide.app stream|train|alerts ...``.

stream  run the four streaming queries until stopped (SIGTERM/SIGINT)
train   fit the distance detector on an event history and save the artefacts
alerts  run the alert consumer over an alert topic or directory
"""

from __future__ import annotations

import argparse
import logging

from eventide.config import EngineConfig


def _jdbc_bounds(p: argparse.ArgumentParser) -> None:
    p.add_argument("--jdbc-partition-column", help="numeric column that splits the JDBC scan")
    p.add_argument("--jdbc-lower", type=int)
    p.add_argument("--jdbc-upper", type=int)
    p.add_argument("--jdbc-partitions", type=int)


def _scan_jdbc(spark, url: str, table: str, args):
    from eventide.sources.jdbc import read_jdbc
    return read_jdbc(spark, url, table, {"user": args.jdbc_user or "", "password": args.jdbc_password or ""},
                     args.jdbc_partition_column, args.jdbc_lower, args.jdbc_upper, args.jdbc_partitions)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="eventide")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("stream")
    s.add_argument("--kafka", help="bootstrap servers; else --source is a JSON-lines directory")
    s.add_argument("--source", help="directory of JSON-lines event files")
    s.add_argument("--format", default="json", choices=["json", "avro"])
    s.add_argument("--avro-schema", help="path of the Avro writer schema (.avsc)")
    s.add_argument("--framed", action="store_true", help="Avro values carry a 5-byte registry header")
    s.add_argument("--sinks", required=True, help="shared output folder")
    s.add_argument("--users", help="users dimension: parquet path, or a jdbc: URL (table users)")
    s.add_argument("--jdbc-user")
    s.add_argument("--jdbc-password")
    s.add_argument("--users-refresh-seconds", type=float)
    s.add_argument("--model", help="saved pipeline model folder")
    s.add_argument("--threshold", help="saved threshold parquet folder")
    s.add_argument("--detectors", default="zscore", help="comma list: zscore,fixed_count,kmeans")
    s.add_argument("--available-now", action="store_true", help="drain what is there and stop")
    s.add_argument("--copy-text", action="store_true", help="also write bulk-load text of valid rows")
    s.add_argument("--dedup", action="store_true", help="one raw row per key in each batch; the view user_events settles the rest")
    s.add_argument("--max-offsets", type=int, help="Kafka records per trigger and query (default: no cap)")
    s.add_argument("--state-partitions", type=int, help="shuffle partitions of the window queries")
    s.add_argument("--sink-files", type=int, help="files per sink and micro-batch, at most")
    s.add_argument("--final-windows", action="store_true",
                   help="emit each window once, when the watermark has passed it, counted from panes")
    s.add_argument("--unique", action="store_true", help="send rows whose raw key was accepted before to the dead letter")
    s.add_argument("--fold-every", type=int, help="fold the keyed tables after every so many micro-batches")
    s.add_argument("--summary-source", default="raw", choices=["raw", "archive"])
    s.add_argument("--count-input", choices=["parsed", "valid"])
    _jdbc_bounds(s)
    t = sub.add_parser("train")
    t.add_argument("--history", help="parquet of typed events (event model)")
    t.add_argument("--jdbc-url", help="read the history over JDBC instead")
    t.add_argument("--jdbc-table", default="user_events")
    t.add_argument("--jdbc-user")
    t.add_argument("--jdbc-password")
    t.add_argument("--out", required=True, help="folder for model and threshold")
    t.add_argument("--window", default="1 day")
    _jdbc_bounds(t)
    v = sub.add_parser("views", help="fold change logs into the keyed tables")
    v.add_argument("--sinks", required=True)
    v.add_argument("--out", help="parquet folder for the tables")
    v.add_argument("--jdbc-url", help="also overwrite the tables over JDBC")
    v.add_argument("--jdbc-user")
    v.add_argument("--jdbc-password")
    c = sub.add_parser("compact", help="merge the archive's small files of closed dates")
    c.add_argument("--sinks", required=True)
    c.add_argument("--before", help="dates (yyyy-mm-dd) below this one only")
    f = sub.add_parser("fold", help="fold new batches into the keyed tables' bases")
    f.add_argument("--sinks", required=True)
    a = sub.add_parser("alerts")
    a.add_argument("--source", help="folder of alert JSON lines")
    a.add_argument("--kafka", help="bootstrap servers; read the alert topic instead")
    a.add_argument("--sinks", required=True)
    a.add_argument("--available-now", action="store_true")
    return p


SUMMARY_TYPES, ANOMALY_TYPES = ("5s", "1min"), ("5s", "1min", "5s_action", "1min_action")


def keyed_tables(spark, sinks) -> dict[str, list]:
    """The lasting tables behind the views, by view; only those with batches."""
    from eventide.streaming.sinks import anomaly_table, summary_table
    tables = {"user_activity_summary": [summary_table(spark, sinks, w) for w in SUMMARY_TYPES],
              "anomalous_events": [anomaly_table(spark, sinks, w) for w in ANOMALY_TYPES]}
    return {name: [t for t in ts if t.exists()] for name, ts in tables.items()}


def fold_tables(spark, sinks) -> dict[str, list]:
    """Fold every table's new batches into its base; the manifests written."""
    return {name: [m for t in ts if (m := t.fold())] for name, ts in keyed_tables(spark, sinks).items()}


def keyed_views(spark, sinks) -> dict:
    """The keyed tables: ``user_activity_summary`` (last wins per user and window,
    over both window sizes) and ``anomalous_events`` (first wins), each from
    its folded base and the batches since; ``user_events`` from the raw log."""
    from eventide.operators import changelog
    from eventide.schemas import SUMMARY_KEY
    from eventide.sources.artifacts import _path_exists
    views, tables = {}, keyed_tables(spark, sinks)

    def read_all(ts, cols):
        parts = [t.read().select(*cols) for t in ts]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    if tables["user_activity_summary"]:
        # the two window sizes share no key, so their tables need no further merge
        views["user_activity_summary"] = read_all(tables["user_activity_summary"], [*SUMMARY_KEY, "event_count", "batch_id"])
    if _path_exists(spark, sinks.raw):
        views["user_events"] = changelog.dedup_rows(spark.read.parquet(sinks.raw).drop("batch_id"))
    if tables["anomalous_events"]:
        log = read_all(tables["anomalous_events"], [*SUMMARY_KEY, "event_count", "detected_at", "detector_type",
                                                    "severity", "batch_id"])
        views["anomalous_events"] = changelog.first_by_key(
            log, SUMMARY_KEY, order_cols=("detected_at", "detector_type", "batch_id")).drop("batch_id")
    return views


def write_views(spark, sinks, out: str | None, jdbc_url: str | None, props: dict) -> None:
    from eventide.sources.jdbc import write_jdbc
    for name, df in keyed_views(spark, sinks).items():
        if out:
            df.write.mode("overwrite").parquet(f"{out}/{name}")
        if jdbc_url:
            write_jdbc(df, jdbc_url, name, props, mode="overwrite")


def main(argv=None) -> None:
    logging.basicConfig(level=logging.INFO)
    args = _parser().parse_args(argv)
    from eventide.session import build_session
    cfg = EngineConfig.from_env()
    spark = build_session(app_name=f"eventide-{args.cmd}")
    if args.cmd == "train":
        from eventide.plans import training
        if args.jdbc_url:
            from eventide.functions.decode import event_time_from_string
            history = _scan_jdbc(spark, args.jdbc_url, args.jdbc_table, args)
            if "event_time" not in history.columns:
                history = history.withColumn(
                    "event_time", event_time_from_string(history["timestamp"].cast("string")))
        else:
            history = spark.read.parquet(args.history)
        frame = training.training_frame(history, args.window)
        model, threshold = training.fit(frame, cfg)
        training.save(spark, model, threshold, f"{args.out}/anomaly_kmeans",
                      f"{args.out}/anomaly_kmeans_threshold")
        return
    from eventide.streaming.sinks import SinkPaths
    if args.cmd == "views":
        write_views(spark, SinkPaths(args.sinks), args.out, args.jdbc_url,
                    {"user": args.jdbc_user or "", "password": args.jdbc_password or ""})
        return
    if args.cmd == "compact":
        from eventide.operators.archive_compaction import Archive
        Archive(spark, SinkPaths(args.sinks).archive).compact(args.before)
        return
    if args.cmd == "fold":
        fold_tables(spark, SinkPaths(args.sinks))
        return
    if args.cmd == "alerts":
        from eventide.sources.stream import kafka_source
        from eventide.streaming.alerts import AlertJob, alert_source
        src = kafka_source(spark, args.kafka, cfg.alert_topic, cfg) if args.kafka \
            else alert_source(spark, args.source)
        trigger = "availableNow" if args.available_now else "1 second"
        AlertJob(spark, SinkPaths(args.sinks)).start(src, trigger).awaitTermination()
        return
    from eventide.operators.detect import detectors_from_config
    from eventide.sources.artifacts import load_pipeline_model, load_threshold
    from eventide.sources.stream import file_source, kafka_source
    from eventide.streaming.application import EventStreamApp, RefreshingDimension
    if args.max_offsets is not None:
        cfg = cfg.with_(max_offsets_per_trigger=args.max_offsets)
    if args.count_input:
        cfg = cfg.with_(count_input=args.count_input)
    raw = kafka_source(spark, args.kafka, cfg.events_topic, cfg) if args.kafka \
        else file_source(spark, args.source)

    def load_users():
        if args.users.startswith("jdbc:"):
            return _scan_jdbc(spark, args.users, "users", args)
        return spark.read.parquet(args.users)

    users = RefreshingDimension(load_users, args.users_refresh_seconds) if args.users else None
    model = load_pipeline_model(spark, args.model) if args.model else None
    threshold = load_threshold(spark, args.threshold) if args.threshold else None
    dets = detectors_from_config(cfg, model, threshold, args.detectors.split(","))
    # a model reading `action` scores (window, user, action) counts, its training grain
    action_dets = [d for d in dets if "action" in getattr(d, "input_columns", set())]
    dets = [d for d in dets if d not in action_dets]
    schema = open(args.avro_schema).read() if args.avro_schema else None
    pipe = EventStreamApp(spark, SinkPaths(args.sinks), cfg, users=users, detectors=dets,
                         fmt=args.format, avro_schema=schema, framed=args.framed,
                         kafka_brokers=args.kafka, copy_text=args.copy_text,
                         dedup_raw=args.dedup, action_detectors=action_dets,
                         state_partitions=args.state_partitions, summary_source=args.summary_source,
                         sink_files=args.sink_files, fold_every=args.fold_every,
                         final_windows=args.final_windows, unique_raw=args.unique)
    pipe.start(raw, trigger="availableNow" if args.available_now else None)
    if args.available_now:
        pipe.await_all()
    else:
        pipe.run_forever()


if __name__ == "__main__":
    main()
