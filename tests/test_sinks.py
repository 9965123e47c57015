from pyspark.sql import functions as F

from eventide.functions.text import to_copy_text
from eventide.operators import changelog
from eventide.operators.alerts import notifications, parse_alerts, split_alerts
from eventide.operators.deadletter import dlq_json, dlq_records
from eventide.streaming.sinks import write_batch_json


def test_upsert_and_insert_ignore_views_with_replay(spark, tmp_dir):
    path = f"{tmp_dir}/log"
    b0 = spark.createDataFrame([(1, 1), (2, 5)], "user_id int, event_count long")
    b1 = spark.createDataFrame([(1, 3)], "user_id int, event_count long")
    changelog.append_batch(b0, path, 0)
    changelog.append_batch(b1, path, 1)
    changelog.append_batch(b1, path, 1)   # replays are idempotent
    changelog.append_batch(b0, path, 0)
    log = spark.read.parquet(path)
    assert log.count() == 3
    latest = {r["user_id"]: r["event_count"] for r in changelog.latest_by_key(log, ["user_id"]).collect()}
    first = {r["user_id"]: r["event_count"] for r in changelog.first_by_key(log, ["user_id"]).collect()}
    assert latest == {1: 3, 2: 5} and first == {1: 1, 2: 5}


def test_dedup_null_device_never_conflicts(spark):
    rows = [(1, "t", "click", "d"), (1, "t", "click", "d"), (1, "t", "click", None), (1, "t", "click", None)]
    df = spark.createDataFrame(rows, "user_id int, timestamp string, action string, device_id string")
    assert changelog.dedup_rows(df).count() == 3
    assert changelog.dedup_rows(df, nulls_distinct=False).count() == 2


def test_text_export_line(spark):
    df = spark.createDataFrame([(1, "a\tb\nc", None, "")], "a int, b string, c string, d string")
    assert to_copy_text(df, ["a", "b", "c", "d"]).first()["line"] == "1\ta b c\t\\N\t"


def test_dlq_roundtrip(spark):
    bad = spark.createDataFrame([(None, 2, "click", "invalid_user_id")],
                                "user_id int, product_id int, action string, dq_reason string")
    js = dlq_json(dlq_records(bad, 7, row_cols=["user_id", "product_id", "action"]))
    back = js.select(F.from_json("value", "batch_id long, row struct<user_id int, product_id int>, "
                                          "reason string").alias("d")).first()["d"]
    assert back["batch_id"] == 7 and back["row"]["product_id"] == 2 and back["reason"] == "invalid_user_id"


def test_alert_stream_rules(spark):
    msgs = [
        '{"user_id": 1, "user_name": null, "region": "HN", "window_start": "a", "window_end": "b",'
        ' "event_count": 9, "score": 3.0, "severity": "high", "detector_type": "zscore"}',
        '{"user_id": 2, "window_start": "a", "window_end": "b", "event_count": 9, "score": 1.0,'
        ' "severity": "low"}',
        '{"user_id": 3, "window_start": "a", "window_end": "b", "score": 1.0, "severity": "high"}',
    ]
    parsed = parse_alerts(spark.createDataFrame([(m,) for m in msgs], "value string"))
    valid, invalid = split_alerts(parsed)
    assert sorted(r["user_id"] for r in valid.collect()) == [1, 2]
    assert [r["user_id"] for r in invalid.collect()] == [3]
    notes = notifications(valid).collect()
    assert [r["user_id"] for r in notes] == [1]
    assert "User: 1 (Unknown)" in notes[0]["message"] and "Region: HN" in notes[0]["message"]


def test_compact_folds_log_into_view(spark, tmp_dir):
    log_path, out = f"{tmp_dir}/log", f"{tmp_dir}/view"
    changelog.append_batch(spark.createDataFrame([(1, 1), (2, 5)], "user_id int, n long"), log_path, 0)
    changelog.append_batch(spark.createDataFrame([(1, 3)], "user_id int, n long"), log_path, 1)
    changelog.compact(spark, log_path, out, ["user_id"], keep="latest")
    got = {r["user_id"]: (r["n"], r["batch_id"]) for r in spark.read.parquet(out).collect()}
    assert got == {1: (3, 1), 2: (5, 0)}
    changelog.compact(spark, log_path, f"{out}_first", ["user_id"], keep="first")
    first = {r["user_id"]: r["n"] for r in spark.read.parquet(f"{out}_first").collect()}
    assert first == {1: 1, 2: 5}


def test_sink_constraints_route_rows_not_chunks(spark):
    import datetime as dt
    from eventide.config import EngineConfig
    from eventide.functions import quality
    from eventide.operators.deadletter import raw_sink_rows, sink_violations
    t = dt.datetime(2025, 9, 20)
    df = spark.createDataFrame(
        [(1, 2, "click", "2025-09-20 00:00:00", t, "x" * 150), (1, 2, "click", "2025-09-20 00:00:00", t, "HN")],
        "user_id int, product_id int, action string, timestamp string, event_time timestamp, location string")
    for c in ("device_id", "device_type", "user_segment", "ip_address"):
        df = df.withColumn(c, F.lit(None).cast("string"))
    cfg = EngineConfig()
    tagged = quality.with_dq_reason(df, cfg, t).withColumn(
        "sink", sink_violations(raw_sink_rows(df), cfg.sink_max_lengths))
    got = sorted((len(r["location"]), r["dq_reason"], r["sink"]) for r in tagged.collect())
    assert got == [(2, None, None), (150, None, "sink_location_too_long")]


def test_write_copy_text(spark, tmp_dir):
    from eventide.functions.text import write_copy_text
    df = spark.createDataFrame([(1, "a\tb", None)], "a int, b string, c string")
    write_copy_text(df, ["a", "b", "c"], f"{tmp_dir}/copy")
    assert [r["value"] for r in spark.read.text(f"{tmp_dir}/copy").collect()] == ["1\ta b\t\\N"]


def _one_anomaly(spark):
    import datetime as dt
    from eventide.operators.detect import FixedCountDetector
    w0 = dt.datetime(2025, 9, 20, 10, 0, 0)
    df = spark.createDataFrame([(w0, w0.replace(second=5), 7, 9, "Alice", "HN")],
                               "window_start timestamp_ntz, window_end timestamp_ntz, user_id int, "
                               "event_count long, user_name string, region string")
    return FixedCountDetector(5).anomalies(df)


def test_alert_record_fields_and_iso_times(spark):
    import json
    from eventide.operators.alerts import alert_records, to_kafka_rows
    recs = alert_records(_one_anomaly(spark), batch_id=3,
                         detected_at=F.lit("2025-09-21 12:00:00").cast("timestamp_ntz"))
    row = to_kafka_rows(recs).first()
    msg = json.loads(row["value"])
    assert row["key"] == "7"
    assert msg["window_start"] == "2025-09-20T10:00:00" and msg["window_end"] == "2025-09-20T10:00:05"
    assert msg["detected_at"] == "2025-09-21T12:00:00"
    assert (msg["event_count"], msg["severity"], msg["detector_type"], msg["batch_id"]) == \
        (9, "high", "fixed_count", 3)
    assert (msg["user_name"], msg["region"], msg["threshold"]) == ("Alice", "HN", 5.0)


def test_anomaly_document_fields(spark):
    import json
    from eventide.operators.alerts import alert_records, anomaly_documents
    doc = json.loads(anomaly_documents(alert_records(_one_anomaly(spark), batch_id=0)).first()["value"])
    assert doc["type"] == "anomaly"
    assert {"user_id", "event_count", "window_start", "window_end", "distance", "severity",
            "user_name", "region", "detected_at"} <= set(doc)
    assert doc["distance"] == 9.0


def test_empty_replay_empties_its_batch(spark, tmp_dir):
    df = spark.createDataFrame([(1, "x")], "user_id int, value string")
    changelog.append_batch(df, f"{tmp_dir}/log", 0)
    changelog.append_batch(df, f"{tmp_dir}/log", 1)
    changelog.append_batch(df.filter("false"), f"{tmp_dir}/log", 0)
    assert [r["batch_id"] for r in spark.read.parquet(f"{tmp_dir}/log").collect()] == [1]
    write_batch_json(df, f"{tmp_dir}/json", 0)
    write_batch_json(df.filter("false"), f"{tmp_dir}/json", 0)
    assert spark.read.text(f"{tmp_dir}/json").count() == 0


def test_base_and_tail_fold_to_the_whole_view(spark, tmp_dir):
    log = f"{tmp_dir}/log"
    for b in range(5):
        rows = [(u, b * 10 + u) for u in range(b, b + 3)]
        changelog.append_batch(spark.createDataFrame(rows, "user_id int, event_count long"), log, b)
        if b == 2:
            after = changelog.compact(spark, log, f"{tmp_dir}/base", ["user_id"])
    assert after == 2
    changelog.compact(spark, log, f"{tmp_dir}/next", ["user_id"], base_path=f"{tmp_dir}/base", after=after)
    changelog.compact(spark, log, f"{tmp_dir}/whole", ["user_id"])
    cols = ["user_id", "event_count", "batch_id"]
    a, b = (sorted(map(tuple, spark.read.parquet(f"{tmp_dir}/{x}").select(*cols).collect())) for x in ("next", "whole"))
    assert a == b and len(a) == 7


def test_views_of_one_plain_value_need_no_sort(spark):
    df = spark.range(10).selectExpr("id % 3 as user_id", "id as event_count", "id as batch_id")
    plan = changelog.latest_by_key(df, ["user_id"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
