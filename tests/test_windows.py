import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventide.config import EngineConfig, check_window
from eventide.operators import windows
from eventide.plans.batch import CFG
from eventide.sources.tables import events_from_tables

from conftest import SF_SMALL


def _events(spark, times):
    return spark.createDataFrame([(1, t) for t in times], "user_id int, event_time timestamp")


def test_tumbling_boundary(spark):
    t = dt.datetime(2025, 1, 1, 0, 0, 5)
    r = windows.summary(_events(spark, [t]), "5 seconds", "5 seconds").first()
    assert (r["window_start"], r["window_end"]) == (t, dt.datetime(2025, 1, 1, 0, 0, 10))


def test_sliding_membership(spark):
    t = dt.datetime(2025, 1, 1, 0, 0, 5)
    rows = windows.summary(_events(spark, [t]), "1 minute", "5 seconds").collect()
    assert len(rows) == 12
    assert all(r["window_start"] <= t < r["window_end"] for r in rows)


def test_sliding_counts_sum_to_twelve_per_event(spark):
    base = dt.datetime(2025, 1, 1)
    times = [base + dt.timedelta(seconds=7 * i) for i in range(50)]
    s = windows.summary(_events(spark, times), "1 minute", "5 seconds")
    assert s.agg(F.sum("event_count")).first()[0] == 12 * 50


def test_slide_longer_than_window_rejected():
    with pytest.raises(ValueError):
        check_window("5 seconds", "10 seconds")
    with pytest.raises(ValueError):
        EngineConfig(window_slide="10 seconds")


def test_null_event_time_has_no_window(spark):
    df = spark.createDataFrame([(1, None)], "user_id int, event_time timestamp")
    assert windows.summary(df, "5 seconds").count() == 0


def test_action_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a")], "user_id int, action string")
    got = {(r["user_id"], r["action"]): r["event_count"] for r in windows.action_counts(df).collect()}
    assert got == {(1, "a"): 2, (1, "b"): 1, (2, "a"): 1}


def test_configured_short_and_long_summaries(spark):
    base = dt.datetime(2025, 1, 1)
    df = _events(spark, [base + dt.timedelta(seconds=s) for s in (0, 1, 7, 61)])
    short = {r["window_start"]: r["event_count"] for r in windows.summary(df, CFG.window_short, CFG.window_slide).collect()}
    assert short == {base: 2, base + dt.timedelta(seconds=5): 1, base + dt.timedelta(seconds=60): 1}
    long = windows.summary(df, CFG.window_long, CFG.window_slide)
    assert long.agg(F.sum("event_count")).first()[0] == 12 * 4


def test_bucket_counts_add_up_to_sliding_counts(spark):
    ev = events_from_tables(spark, SF_SMALL, with_geo=False)
    for dur, slide in (("1 hour", "5 minutes"), ("1 minute", "5 seconds"), ("50 minutes", "15 minutes")):
        a, b = (windows.flatten_window(windows.window_counts(ev, dur, slide, keys=("action",), buckets=x)) for x in (True, False))
        assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0 and a.count() > 100
