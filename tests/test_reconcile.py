"""Late rows: only the windows that miss some are counted again."""
import datetime as dt

import pytest

from eventide.operators import changelog, reconcile, windows

BASE = dt.datetime(2025, 1, 1)


def events(spark, rows):
    return spark.createDataFrame([(u, BASE + dt.timedelta(seconds=s)) for u, s in rows], "user_id int, event_time timestamp_ntz")


def counts(df, duration, slide=None):
    return {(r.window_start, r.user_id): r.event_count for r in windows.summary(df, duration, slide).collect()}


def as_dict(df):
    return {(r.window_start, r.user_id): r.event_count for r in df.collect()}


@pytest.mark.parametrize("duration,slide", [("5 seconds", None), ("1 minute", "5 seconds")])
def test_only_touched_windows_are_written(spark, tmp_dir, duration, slide):
    on_time = [(1, 0), (1, 1), (2, 3), (1, 300), (3, 301)]
    late = [(1, 2), (4, 4)]
    summary = windows.summary(events(spark, on_time), duration, slide)
    archive = events(spark, on_time + late)
    touched = {r.window_start for r in reconcile.touched_windows(archive, summary, duration, slide).collect()}
    assert touched == {w for w, _ in counts(events(spark, late), duration, slide)}
    fixes = as_dict(reconcile.corrections(archive, summary, duration, slide))
    whole = counts(archive, duration, slide)
    assert set(u for _, u in fixes) == {1, 4} and all(whole[k] == n for k, n in fixes.items())
    log = f"{tmp_dir}/log"
    assert reconcile.reconcile(spark, archive, summary, log, duration, slide) == 0
    settled = reconcile.settled(summary, spark.read.parquet(log))
    assert as_dict(settled) == whole
    assert reconcile.reconcile(spark, archive, settled, log, duration, slide) == 1  # nothing left to correct
    assert spark.read.parquet(log).filter("batch_id = 1").count() == 0 and changelog.complete_batches(spark, log) == [0, 1]


def test_open_windows_are_left_to_the_stream(spark):
    summary = windows.summary(events(spark, [(1, 0)]), "5 seconds")
    archive = events(spark, [(1, 0), (1, 1), (1, 11)])
    found = reconcile.touched_windows(archive, summary, "5 seconds", closed_before=BASE + dt.timedelta(seconds=10))
    assert [r.window_start for r in found.collect()] == [BASE]


def test_null_users_and_nothing_to_do(spark):
    archive = spark.createDataFrame([(None, BASE), (None, BASE), (1, None)], "user_id int, event_time timestamp_ntz")
    summary = windows.summary(archive.limit(1), "5 seconds")
    assert as_dict(reconcile.settled(summary, reconcile.corrections(archive, summary, "5 seconds"))) == {(BASE, None): 2}
    assert reconcile.corrections(archive.limit(0), summary, "5 seconds").count() == 0
    assert reconcile.corrections(archive, windows.summary(archive, "5 seconds"), "5 seconds").count() == 0
