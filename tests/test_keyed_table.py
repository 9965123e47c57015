"""The lasting keyed table: no batch lost or counted twice, whatever lands when."""
import datetime as dt
import random

import pytest

from eventide.app import fold_tables, keyed_views
from eventide.operators import changelog
from eventide.operators.keyed_table import KeyedTable
from eventide.operators.manifest import ManifestLog, ranges, within
from eventide.streaming.sinks import SinkPaths

SCHEMA = "user_id int, day date, n long"
D = [dt.date(2025, 1, d) for d in range(1, 6)]


def land(spark, table, batch, rows):
    changelog.append_batch(spark.createDataFrame(rows, SCHEMA), table.log_path, batch)


def make(spark, folder, **kw):
    return KeyedTable(spark, f"{folder}/log", f"{folder}/base", ["user_id", "day"], part="day", **kw)


def rows_of(df):
    return sorted((r.user_id, r.day, r.n, r.batch_id) for r in df.collect())


def plain(batches, keep="latest"):
    out = {}
    for b in sorted(batches, reverse=keep == "first"):
        for user, day, n in batches[b]:
            out[user, day] = (n, b)
    return sorted((u, d, n, b) for (u, d), (n, b) in out.items())


def test_batch_that_lands_during_a_fold_is_read_and_folded_later(spark, tmp_dir, monkeypatch):
    t = make(spark, tmp_dir)
    land(spark, t, 0, [(1, D[0], 1)])
    land(spark, t, 1, [(2, D[0], 1)])
    real = t._merged

    def late(new, old):
        if not t.manifests.versions() and t.tail() == [0, 1]:
            land(spark, t, 2, [(3, D[0], 1), (1, D[0], 9)])
        return real(new, old)

    monkeypatch.setattr(t, "_merged", late)
    assert t.fold()["folded"] == [0, 1]
    want = [(1, D[0], 9, 2), (2, D[0], 1, 1), (3, D[0], 1, 2)]
    assert t.tail() == [2] and rows_of(t.read()) == want
    assert t.fold()["folded"] == [2] and t.tail() == [] and rows_of(t.read()) == want


def test_compact_answers_what_it_read(spark, tmp_dir, monkeypatch):
    t = make(spark, tmp_dir)
    land(spark, t, 0, [(1, D[0], 1)])
    land(spark, t, 1, [(2, D[0], 1)])
    real = changelog.latest_by_key

    def late(log, keys):
        land(spark, t, 2, [(3, D[0], 1)])
        return real(log, keys)

    monkeypatch.setattr(changelog, "latest_by_key", late)
    after = changelog.compact(spark, t.log_path, f"{tmp_dir}/a", ["user_id", "day"])
    monkeypatch.setattr(changelog, "latest_by_key", real)
    assert after == 1
    assert changelog.compact(spark, t.log_path, f"{tmp_dir}/b", ["user_id", "day"], base_path=f"{tmp_dir}/a", after=after) == 2
    assert [r[0] for r in rows_of(spark.read.parquet(f"{tmp_dir}/b"))] == [1, 2, 3]


@pytest.mark.parametrize("keep", ["latest", "first"])
def test_random_order_of_batches_folds_and_replays(spark, tmp_dir, keep):
    r = random.Random(keep)
    t, batches = make(spark, tmp_dir, keep=keep), {}
    order = list(range(8))
    r.shuffle(order)
    for k, b in enumerate(order):  # ids arrive out of order, also below folded ones
        batches[b] = [(u, r.choice(D), r.randint(1, 99)) for u in r.sample(range(6), 4)]
        land(spark, t, b, batches[b])
        if k % 3 == 1:
            t.fold()
            land(spark, t, b, batches[b])  # a replay of what is folded
        if k % 3 == 2:
            assert rows_of(t.read()) == plain(batches, keep)
    assert rows_of(t.read()) == plain(batches, keep)
    t.fold()
    assert t.fold() is None and rows_of(t.read()) == plain(batches, keep)
    assert t.manifest()["batches"] == [[0, 7]]


def test_fold_rewrites_touched_dates_only(spark, tmp_dir):
    t = make(spark, tmp_dir)
    land(spark, t, 0, [(1, D[0], 1), (1, D[1], 1)])
    t.fold()
    land(spark, t, 1, [(1, D[1], 5), (2, D[2], 1)])
    doc = t.fold()
    assert doc["rewritten"] == ["p2025-01-02", "p2025-01-03"]
    assert doc["parts"] == {"p2025-01-01": 1, "p2025-01-02": 2, "p2025-01-03": 2}
    assert rows_of(t.read()) == [(1, D[0], 1, 0), (1, D[1], 5, 1), (2, D[2], 1, 1)]
    assert rows_of(t.read_version(1)) == [(1, D[0], 1, 0), (1, D[1], 1, 0)]


def test_read_merges_only_dates_of_the_tail(spark, tmp_dir):
    t = make(spark, tmp_dir)
    land(spark, t, 0, [(u, D[0], 1) for u in range(50)] + [(1, D[1], 1)])
    t.fold()
    land(spark, t, 1, [(1, D[1], 2)])
    plan = t.read()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "Union" in plan
    assert (1, D[1], 2, 1) in rows_of(t.read()) and len(rows_of(t.read())) == 51


def test_many_versions_are_rewritten_whole(spark, tmp_dir, monkeypatch):
    from eventide.operators import keyed_table
    monkeypatch.setattr(keyed_table, "MAX_VERSIONS", 2)
    t = make(spark, tmp_dir)
    for b in range(4):
        land(spark, t, b, [(b, D[b], b)])
        doc = t.fold()
    assert len(set(doc["parts"].values())) <= 2 and len(rows_of(t.read())) == 4


def test_unfinished_batches_and_broken_folds_are_not_read(spark, tmp_dir):
    t = make(spark, tmp_dir)
    assert t.read() is None and t.fold() is None and not t.exists()
    land(spark, t, 0, [(1, D[0], 1)])
    spark.createDataFrame([(9, D[0], 9)], SCHEMA).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false") \
        .parquet(f"{t.log_path}/batch_id=1")
    spark.createDataFrame([(9, D[0], 9)], SCHEMA).write.parquet(f"{t.base_path}/version=1")  # a fold that broke off
    assert rows_of(t.read()) == [(1, D[0], 1, 0)]
    assert t.fold()["version"] == 2 and rows_of(t.read()) == [(1, D[0], 1, 0)]


def test_two_writers_of_one_version(spark, tmp_dir):
    log = ManifestLog(spark, f"{tmp_dir}/m")
    log.commit(1, {"batches": []})
    with pytest.raises(Exception):
        log.commit(1, {"batches": [[0, 3]]})
    assert log.latest()["batches"] == []


def test_ranges():
    assert ranges([5, 1, 2, 3, 3, 9]) == [[1, 3], [5, 5], [9, 9]]
    assert within([[1, 3], [5, 5]], 5) and not within([[1, 3]], 4)


def test_null_keys_and_null_parts(spark, tmp_dir):
    t = make(spark, tmp_dir)
    land(spark, t, 0, [(None, None, 1), (1, None, 2)])
    t.fold()
    land(spark, t, 1, [(None, None, 3)])
    got = sorted((r.user_id is None, r.n, r.batch_id) for r in t.read().collect())
    assert got == [(False, 2, 0), (True, 3, 1)]


def test_views_read_base_and_tail(spark, tmp_dir):
    sinks = SinkPaths(tmp_dir)
    w0 = dt.datetime(2025, 1, 1)
    schema = "window_start timestamp_ntz, window_end timestamp_ntz, user_id int, event_count long"
    for b in range(3):
        rows = [(w0, w0 + dt.timedelta(seconds=5), u, b + 1) for u in range(b + 1)]
        changelog.append_batch(spark.createDataFrame(rows, schema), sinks.summary("5s"), b)
        if b == 1:
            assert [m["folded"] for m in fold_tables(spark, sinks)["user_activity_summary"]] == [[0, 1]]
    got = {r.user_id: r.event_count for r in keyed_views(spark, sinks)["user_activity_summary"].collect()}
    assert got == {0: 3, 1: 3, 2: 3}
