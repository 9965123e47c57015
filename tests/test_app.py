import json

from eventide import app
from eventide.sources.stream import write_json_lines
from eventide.sources.tables import events_from_tables, json_envelope, users_from_tables

from conftest import SF_SMALL

BURST_USER, BURST_N = 7, 30


def _burst_lines():
    return [json.dumps({"user_id": BURST_USER, "product_id": 1001, "action": "click",
                        "timestamp": f"2024-01-15 12:00:{s:02d}"}) for s in range(BURST_N)]


def test_cli_train_then_stream(spark, tmp_dir):
    events = events_from_tables(spark, SF_SMALL)
    events.write.parquet(f"{tmp_dir}/history")
    app.main(["train", "--history", f"{tmp_dir}/history", "--out", f"{tmp_dir}/models",
              "--window", "1 minute"])
    write_json_lines(json_envelope(events), f"{tmp_dir}/topic", partitions=2)
    with open(f"{tmp_dir}/topic/part-burst.txt", "w") as f:
        f.write("\n".join(_burst_lines()) + "\n")
    users_from_tables(spark, SF_SMALL).write.parquet(f"{tmp_dir}/users")
    app.main(["stream", "--source", f"{tmp_dir}/topic", "--sinks", f"{tmp_dir}/sinks",
              "--users", f"{tmp_dir}/users", "--model", f"{tmp_dir}/models/anomaly_kmeans",
              "--threshold", f"{tmp_dir}/models/anomaly_kmeans_threshold",
              "--detectors", "zscore,kmeans", "--available-now", "--copy-text"])
    n = events.count() + BURST_N
    raw = spark.read.parquet(f"{tmp_dir}/sinks/raw_events").count()
    dead = spark.read.text(f"{tmp_dir}/sinks/dead_letter").count()
    assert raw + dead == n
    assert spark.read.text(f"{tmp_dir}/sinks/raw_copy").count() == raw
    acts = spark.read.parquet(f"{tmp_dir}/sinks/summary_1min_action")
    assert "action" in acts.columns
    assert acts.agg({"event_count": "sum"}).first()[0] == 12 * n   # 12 sliding windows per event
    kmeans = spark.read.parquet(f"{tmp_dir}/sinks/anomalies_1min_action").collect()
    assert kmeans and {r["detector_type"] for r in kmeans} == {"kmeans"}
    assert {r["user_id"] for r in kmeans} == {BURST_USER}
    assert all(r["score"] > r["threshold"] for r in kmeans)
    alerts = spark.read.text(f"{tmp_dir}/sinks/alerts_1min_action").collect()
    assert len(alerts) == len(kmeans)

    app.main(["views", "--sinks", f"{tmp_dir}/sinks", "--out", f"{tmp_dir}/tables"])
    summary = spark.read.parquet(f"{tmp_dir}/tables/user_activity_summary")
    key = ["user_id", "window_start", "window_end"]
    assert summary.count() == summary.select(*key).distinct().count()
    table = spark.read.parquet(f"{tmp_dir}/tables/anomalous_events")
    assert table.count() == table.select(*key).distinct().count() > 0

    # folded bases hold the same tables, the compacted archive the same rows
    app.main(["fold", "--sinks", f"{tmp_dir}/sinks"])
    app.main(["views", "--sinks", f"{tmp_dir}/sinks", "--out", f"{tmp_dir}/folded"])
    for name in ("user_activity_summary", "anomalous_events"):
        again = spark.read.parquet(f"{tmp_dir}/folded/{name}")
        old = spark.read.parquet(f"{tmp_dir}/tables/{name}")
        assert again.exceptAll(old.select(*again.columns)).count() == 0 and again.count() == old.count()
    from eventide.operators.archive_compaction import Archive
    app.main(["compact", "--sinks", f"{tmp_dir}/sinks"])
    archive = Archive(spark, f"{tmp_dir}/sinks/archive")
    assert archive.read().count() == spark.read.parquet(f"{tmp_dir}/sinks/archive").count()

    app.main(["alerts", "--source", f"{tmp_dir}/sinks/alerts_1min_action", "--sinks",
              f"{tmp_dir}/alert_job", "--available-now"])
    archived = spark.read.text(f"{tmp_dir}/alert_job/alert_archive").count()
    assert archived == len(alerts)
