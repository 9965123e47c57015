import datetime as dt
import json
import os
import time

from pyspark.sql import functions as F

from eventide.config import EngineConfig
from eventide.operators import changelog, windows
from eventide.sources.stream import file_source, write_json_lines
from eventide.sources.tables import events_from_tables, json_envelope
from eventide.streaming.application import EventStreamApp
from eventide.streaming.sinks import SinkPaths

from conftest import SF_SMALL

BASE = dt.datetime(2025, 9, 20, 10, 0, 0)


def _event(sec, user=1):
    return json.dumps({"user_id": user, "product_id": 1001, "action": "click",
                       "timestamp": (BASE + dt.timedelta(seconds=sec)).strftime("%Y-%m-%d %H:%M:%S")})


def _drop_file(src, i, lines):
    os.makedirs(src, exist_ok=True)
    tmp = os.path.join(src, f".part-{i}.tmp")
    with open(tmp, "w") as f:
        f.write("\n".join(lines) + "\n")
    os.rename(tmp, os.path.join(src, f"batch-{i:03d}.json"))


def _summary_only(spark, root, src):
    pipe = EventStreamApp(spark, SinkPaths(f"{root}/sinks"), EngineConfig())
    q = pipe.start(file_source(spark, src, max_files_per_trigger=1), trigger="availableNow",
                   which=("summary_5s",))
    pipe.await_all()
    return pipe


def test_late_rows_follow_watermark(spark, tmp_dir):
    """Watermark 30 s, 5 s windows, update mode, one file per batch (FIXTURES.md):
    batch 0 emits (:00, 2); batch 1 (1:40, 1); batch 2 still counts second 3
    (the late filter uses the previous batch's watermark) -> (:00, 3);
    batch 3 emits nothing and drops one row."""
    src = f"{tmp_dir}/src"
    for i, secs in enumerate([[1, 2], [100], [3], [4]]):
        _drop_file(src, i, [_event(s) for s in secs])
        time.sleep(0.05)
    pipe = _summary_only(spark, tmp_dir, src)
    log = spark.read.parquet(f"{tmp_dir}/sinks/summary_5s")
    got = sorted((r["batch_id"], int((r["window_start"] - BASE).total_seconds()), r["event_count"])
                 for r in log.collect())
    assert got == [(0, 0, 2), (1, 100, 1), (2, 0, 3)]
    dropped = {p["batchId"]: p["stateOperators"][0]["numRowsDroppedByWatermark"]
               for p in pipe.queries["summary_5s"].recentProgress}
    assert dropped[3] == 1 and sum(dropped.values()) == 1


def test_restart_from_checkpoint_continues(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    _drop_file(src, 0, [_event(1), _event(2)])
    _summary_only(spark, tmp_dir, src)
    _drop_file(src, 1, [_event(3)])
    _summary_only(spark, tmp_dir, src)            # same checkpoint: only the new file
    log = spark.read.parquet(f"{tmp_dir}/sinks/summary_5s")
    latest = changelog.latest_by_key(log, ["user_id", "window_start", "window_end"]).collect()
    assert [r["event_count"] for r in latest] == [3]
    ids = sorted(r["batch_id"] for r in log.collect())
    # two data batches; a no-data batch that only advances the watermark may sit between
    assert len(ids) == 2 and ids[0] == 0 and ids[1] >= 1


def test_replayed_summary_batch_is_idempotent(spark, tmp_dir):
    pipe = EventStreamApp(spark, SinkPaths(tmp_dir), EngineConfig())
    batch = spark.createDataFrame(
        [((BASE, BASE + dt.timedelta(seconds=5)), 1, 4)],
        "window struct<start: timestamp, end: timestamp>, user_id int, event_count long")
    pipe.summary_batch(batch, 0, "5s")
    pipe.summary_batch(batch, 0, "5s")
    assert spark.read.parquet(f"{tmp_dir}/summary_5s").count() == 1


def test_app_route_total_and_stream_equals_batch(spark, tmp_dir):
    cfg = EngineConfig()
    events = events_from_tables(spark, SF_SMALL, cfg)
    src = f"{tmp_dir}/topic"
    write_json_lines(json_envelope(events), src)
    sinks = SinkPaths(f"{tmp_dir}/sinks")
    pipe = EventStreamApp(spark, sinks, cfg)
    # one micro-batch: nothing can be late, so the stream must equal the batch query
    pipe.start(file_source(spark, src), trigger="availableNow",
               which=("raw_route", "archive", "summary_5s"))
    pipe.await_all()
    n = events.count()
    raw = spark.read.parquet(sinks.raw).count()
    dead = spark.read.text(sinks.dlq).count()
    assert raw + dead == n
    assert spark.read.parquet(sinks.archive).count() == n
    metrics = spark.read.parquet(sinks.path("metrics_raw")).agg(F.sum("records"), F.sum("rejected")).first()
    assert (metrics[0], metrics[1]) == (raw, dead)
    log = spark.read.parquet(sinks.summary("5s"))
    streamed = changelog.latest_by_key(log, ["user_id", "window_start", "window_end"]) \
        .select("window_start", "window_end", "user_id", "event_count")
    batch = windows.summary(events, cfg.window_short, cfg.window_slide) \
        .select("window_start", "window_end", "user_id", "event_count")
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_stream_dedup_settles_in_the_view(spark, tmp_dir):
    from eventide.app import keyed_views
    src = f"{tmp_dir}/src"
    line = json.dumps({"user_id": 1, "product_id": 1001, "action": "click", "device_id": "d",
                       "timestamp": "2025-09-20 10:00:00"})
    nulldev = json.dumps({"user_id": 2, "product_id": 1001, "action": "click",
                          "timestamp": "2025-09-20 10:00:00"})
    _drop_file(src, 0, [line, line, nulldev, nulldev])
    _drop_file(src, 1, [line])
    sinks = SinkPaths(f"{tmp_dir}/sinks")
    pipe = EventStreamApp(spark, sinks, EngineConfig(), dedup_raw=True)
    pipe.start(file_source(spark, src, max_files_per_trigger=1), trigger="availableNow",
               which=("raw_route",))
    pipe.await_all()
    assert sorted(r["user_id"] for r in spark.read.parquet(sinks.raw).collect()) == [1, 1, 2, 2]
    assert sorted(r["user_id"] for r in keyed_views(spark, sinks)["user_events"].collect()) == [1, 2, 2]


def test_dedup_loses_no_late_event(spark, tmp_dir):
    """Distinct events, two of them far behind the others: all are in the raw
    table or the dead letter, with and without dedup."""
    src = f"{tmp_dir}/src"
    _drop_file(src, 0, [_event(4000), _event(4001), _event(4002)])
    _drop_file(src, 1, [_event(1), _event(2), json.dumps({"user_id": -1, "product_id": 1, "action": "click", "timestamp": "2025-09-20 10:00:09"})])
    for dedup in (False, True):
        sinks = SinkPaths(f"{tmp_dir}/sinks_{dedup}")
        pipe = EventStreamApp(spark, sinks, EngineConfig(), dedup_raw=dedup)
        pipe.start(file_source(spark, src, max_files_per_trigger=1), trigger="availableNow", which=("raw_route",))
        pipe.await_all()
        assert spark.read.parquet(sinks.raw).count() == 5
        assert spark.read.text(sinks.dlq).count() == 1


def test_one_future_event_stops_no_window(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    future = json.dumps({"user_id": 9, "product_id": 1, "action": "click", "timestamp": "2099-01-01 00:00:00"})
    _drop_file(src, 0, [_event(0), _event(1), future])
    _drop_file(src, 1, [_event(6), _event(7), _event(8)])
    for mode in ("parsed", "valid"):
        sinks = SinkPaths(f"{tmp_dir}/sinks_{mode}")
        pipe = EventStreamApp(spark, sinks, EngineConfig(count_input=mode))
        pipe.start(file_source(spark, src, max_files_per_trigger=1), trigger="availableNow", which=("summary_5s", "raw_route"))
        pipe.await_all()
        log = changelog.latest_by_key(spark.read.parquet(sinks.summary("5s")), ["user_id", "window_start", "window_end"])
        assert log.agg(F.sum("event_count")).first()[0] == 5
        assert spark.read.text(sinks.dlq).count() == 1


def test_missing_field_is_named_and_garbage_is_malformed(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    _drop_file(src, 0, [json.dumps({"user_id": 1, "action": "click", "timestamp": "2025-09-20 10:00:00"}), "not json", _event(1)])
    sinks = SinkPaths(f"{tmp_dir}/sinks")
    pipe = EventStreamApp(spark, sinks, EngineConfig())
    pipe.start(file_source(spark, src), trigger="availableNow", which=("raw_route",))
    pipe.await_all()
    reasons = sorted(json.loads(r["value"])["reason"] for r in spark.read.text(sinks.dlq).collect())
    assert reasons == ["invalid_product_id", "malformed_record"]


def test_multibatch_upserts_equal_batch_with_long_watermark(spark, tmp_dir):
    """Several micro-batches over time-mixed files: with a watermark longer than
    the data span nothing is dropped, and the last-wins view of the update-mode
    change log equals the batch counts."""
    cfg = EngineConfig(watermark_long="3650 days")
    events = events_from_tables(spark, SF_SMALL, cfg)
    src = f"{tmp_dir}/topic"
    write_json_lines(json_envelope(events), src, partitions=4)
    sinks = SinkPaths(f"{tmp_dir}/sinks")
    pipe = EventStreamApp(spark, sinks, cfg)
    pipe.start(file_source(spark, src, max_files_per_trigger=1), trigger="availableNow",
               which=("summary_1min",))
    pipe.await_all()
    log = spark.read.parquet(sinks.summary("1min"))
    assert log.select("batch_id").distinct().count() >= 4
    streamed = changelog.latest_by_key(log, ["user_id", "window_start", "window_end"]) \
        .select("window_start", "window_end", "user_id", "event_count")
    batch = windows.summary(events, cfg.window_long, cfg.window_slide) \
        .select("window_start", "window_end", "user_id", "event_count")
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_count_valid_only_and_state_partitions(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    good = _event(1)
    bad = json.dumps({"user_id": 1, "product_id": 1001, "action": "signup",
                      "timestamp": "2025-09-20 10:00:02"})
    _drop_file(src, 0, [good, bad])
    for mode, expect in (("parsed", 2), ("valid", 1)):
        sinks = SinkPaths(f"{tmp_dir}/sinks_{mode}")
        pipe = EventStreamApp(spark, sinks, EngineConfig(count_input=mode), state_partitions=3)
        q = pipe.start(file_source(spark, src), trigger="availableNow", which=("summary_5s",))
        pipe.await_all()
        assert spark.read.parquet(sinks.summary("5s")).first()["event_count"] == expect
        state = q["summary_5s"].recentProgress[0]["stateOperators"][0]
        assert state["numShufflePartitions"] == 3


def test_windows_from_archive_equal_windows_from_topic(spark, tmp_dir):
    cfg = EngineConfig()
    events = events_from_tables(spark, SF_SMALL, cfg)
    src = f"{tmp_dir}/topic"
    write_json_lines(json_envelope(events), src, partitions=3)
    out = {}
    for mode in ("raw", "archive"):
        sinks = SinkPaths(f"{tmp_dir}/sinks_{mode}")
        pipe = EventStreamApp(spark, sinks, cfg, summary_source=mode)
        pipe.start(file_source(spark, src), trigger="availableNow", which=("summary_1min",))
        pipe.await_all()
        log = spark.read.parquet(sinks.summary("1min"))
        out[mode] = changelog.latest_by_key(log, ["user_id", "window_start", "window_end"]) \
            .select("window_start", "window_end", "user_id", "event_count")
    assert out["raw"].count() > 0
    assert out["raw"].exceptAll(out["archive"]).count() == 0
    assert out["archive"].exceptAll(out["raw"]).count() == 0


def test_user_repartition_keeps_results(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    _drop_file(src, 0, [_event(s, user=u) for s in range(3) for u in (1, 2, 3)])
    sinks = SinkPaths(f"{tmp_dir}/sinks")
    pipe = EventStreamApp(spark, sinks, EngineConfig(), repartition_by_user=4)
    pipe.start(file_source(spark, src), trigger="availableNow", which=("summary_5s", "raw_route"))
    pipe.await_all()
    got = sorted((r["user_id"], r["event_count"]) for r in spark.read.parquet(sinks.summary("5s")).collect())
    assert got == [(1, 3), (2, 3), (3, 3)]
    assert spark.read.parquet(sinks.raw).count() == 9


def test_hot_user_stream_equals_batch(spark, tmp_dir):
    """One user sends a third of all events; stream counts equal batch counts."""
    src = f"{tmp_dir}/src"
    lines = [_event(s % 50, user=1 if s % 3 == 0 else 2 + s % 40) for s in range(600)]
    for i in range(3):
        _drop_file(src, i, lines[i::3])
    sinks = SinkPaths(f"{tmp_dir}/sinks")
    pipe = EventStreamApp(spark, sinks, EngineConfig())
    pipe.start(file_source(spark, src), trigger="availableNow", which=("summary_1min",))
    pipe.await_all()
    log = spark.read.parquet(sinks.summary("1min"))
    streamed = changelog.latest_by_key(log, ["user_id", "window_start", "window_end"]) \
        .select("window_start", "window_end", "user_id", "event_count")
    ev = spark.read.json(src).select(
        "user_id", F.to_timestamp("timestamp").alias("event_time"))
    batch = windows.summary(ev, "1 minute", "5 seconds").withColumn("user_id", F.col("user_id").cast("int"))
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    hot = streamed.filter("user_id = 1").agg(F.sum("event_count")).first()[0]
    assert hot == 12 * 200


def test_sink_files_caps_files_per_batch(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    _drop_file(src, 0, [_event(s, user=u) for s in range(20) for u in range(1, 30)])
    sinks = SinkPaths(f"{tmp_dir}/sinks")
    pipe = EventStreamApp(spark, sinks, EngineConfig(), sink_files=1, state_partitions=4)
    pipe.start(file_source(spark, src), trigger="availableNow", which=("summary_5s",))
    pipe.await_all()
    files = [f for f in os.listdir(f"{sinks.summary('5s')}/batch_id=0") if f.endswith(".parquet")]
    assert len(files) == 1
    assert spark.read.parquet(sinks.summary("5s")).agg(F.sum("event_count")).first()[0] == 20 * 29
