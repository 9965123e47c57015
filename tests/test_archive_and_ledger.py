"""The archive's small files merged, and notices told once."""
import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from eventide.operators import changelog
from eventide.operators.archive_compaction import Archive
from eventide.plans.batch import CFG
from eventide.sources.stream import file_source
from eventide.streaming.alerts import AlertJob, alert_source
from eventide.streaming.application import EventStreamApp
from eventide.streaming.sinks import SinkPaths, write_batch_json

EVENT = '{"user_id":%d,"product_id":1,"action":"click","timestamp":"2025-01-0%d 00:00:00","location":"HN"}'


def feed(spark, folder, rows):
    spark.createDataFrame([(EVENT % r,) for r in rows], "value string").coalesce(1).write.mode("append").text(f"{folder}/in")


def drain(spark, folder):
    sinks = SinkPaths(f"{folder}/sinks")
    pipe = EventStreamApp(spark, sinks, CFG)
    pipe.start(file_source(spark, f"{folder}/in", max_files_per_trigger=1), trigger="availableNow", which=("archive",))
    pipe.await_all()
    return sinks


def test_merged_archive_holds_the_same_rows_in_few_files(spark, tmp_dir):
    rows = [(u, d) for u in range(12) for d in (1, 2)]
    for k in range(4):
        feed(spark, tmp_dir, rows[k * 6:(k + 1) * 6])
    sinks = drain(spark, tmp_dir)
    archive = Archive(spark, sinks.archive)
    key = lambda df: Counter((r.user_id, str(r.event_date)) for r in df.collect())
    whole = key(spark.read.parquet(sinks.archive))
    assert len(archive.committed()) == 8 and key(archive.read()) == whole
    # an uncommitted file of a failed batch is no part of the archive
    spark.createDataFrame([(99,)], "user_id int").coalesce(1).write.parquet(f"{tmp_dir}/stray")
    fs = archive.manifests._fs
    path = archive.manifests._path
    [stray] = archive.manifests.glob(f"{tmp_dir}/stray/*.parquet")
    jvm_util = spark._jvm.org.apache.hadoop.fs.FileUtil
    jvm_util.copy(fs, path(stray), fs, path(f"{sinks.archive}/event_date=2025-01-01/part-stray.parquet"), False,
                  spark.sparkContext._jsc.hadoopConfiguration())
    doc = archive.compact(before="2025-01-02")
    assert list(doc["dates"]) == ["2025-01-01"] and len(doc["replaced"]) == 4
    merged = archive.manifests.glob(f"{archive.merged_path}/version=1/event_date=2025-01-01/*.parquet")
    assert len(merged) == 1 and key(archive.read()) == whole
    users = [r.user_id for r in spark.read.parquet(merged[0]).collect()]
    assert users == sorted(users) and 99 not in users
    # the stream goes on, late rows of a merged date join it at the next run
    feed(spark, tmp_dir, [(50, 1), (51, 3)])
    feed(spark, tmp_dir, [(52, 1)])
    drain(spark, tmp_dir)
    want = whole + Counter({(50, "2025-01-01"): 1, (51, "2025-01-03"): 1, (52, "2025-01-01"): 1})
    assert key(archive.read()) == want
    doc = archive.compact()
    assert doc["dates"]["2025-01-01"] == doc["dates"]["2025-01-02"] == 2 and key(archive.read()) == want
    assert archive.compact() is None and len(archive.open_files()) == 1


def alert(batch, user, n=9, detector="zscore"):
    w = dt.datetime(2025, 1, 1, 0, user)
    return (f'{{"user_id":{user},"event_count":{n},"window_start":"{w.isoformat()}","window_end":"{w.isoformat()}",'
            f'"score":3.0,"severity":"high","detector_type":"{detector}","batch_id":{batch}}}')


def notified(spark, out):
    rows = spark.read.option("recursiveFileLookup", "true").text(out.path("notifications"))
    return Counter(r.user_id for r in rows.select(F.get_json_object("value", "$.user_id").cast("int").alias("user_id")).collect())


def test_a_replayed_batch_of_alerts_notifies_nothing(spark, tmp_dir):
    out, job = SinkPaths(f"{tmp_dir}/alerts"), None

    def write(batch, lines):
        write_batch_json(spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1), f"{tmp_dir}/in", batch)

    def run():
        job = AlertJob(spark, out)
        q = job.start(alert_source(spark, f"{tmp_dir}/in"), trigger="availableNow")
        q.awaitTermination()
        assert q.exception() is None

    write(0, [alert(0, 1), alert(0, 2), alert(0, 2)])
    run()
    assert notified(spark, out) == {1: 1, 2: 1}
    write(0, [alert(0, 1), alert(0, 2)])                    # the upstream batch, replayed under new file names
    write(1, [alert(1, 1), alert(1, 3), alert(1, 3, detector="kmeans")])
    run()
    # the first two stay told; user 1 has a new alert in batch 1, user 3 one of each detector
    assert notified(spark, out) == {1: 2, 2: 1, 3: 2}
    assert spark.read.text(out.path("alert_archive")).count() == 8


def test_a_replay_of_the_alert_job_itself_writes_the_same_notes(spark, tmp_dir):
    out = SinkPaths(f"{tmp_dir}/alerts")
    job = AlertJob(spark, out)
    first = spark.createDataFrame([(alert(0, 1),), (alert(0, 2),)], "value string")
    job.handle(first, 0)
    job.handle(spark.createDataFrame([(alert(1, 3),)], "value string"), 1)
    job.handle(first, 0)
    assert notified(spark, out) == {1: 1, 2: 1, 3: 1}
    assert sorted(changelog.complete_batches(spark, out.path("alert_ledger"))) == [0, 1]


def test_alerts_without_a_batch_id_are_known_by_their_payload(spark, tmp_dir):
    out = SinkPaths(f"{tmp_dir}/alerts")
    job = AlertJob(spark, out)
    plain = [alert(0, 1, n).replace(',"batch_id":0', "") for n in (9, 10, 9)]
    job.handle(spark.createDataFrame([(x,) for x in plain], "value string"), 0)
    job.handle(spark.createDataFrame([(plain[0],), (alert(0, 1, 11).replace(',"batch_id":0', ""),)], "value string"), 1)
    assert notified(spark, out) == {1: 3}
