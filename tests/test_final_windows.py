"""Windows emitted once from panes, and scores over the stream's history."""
import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from eventide.config import EngineConfig
from eventide.operators import moments as M, windows
from eventide.plans import streamed
from eventide.streaming.application import EventStreamApp
from eventide.streaming.sinks import SinkPaths, moments_so_far

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    """Sparse events of 150 users in five files, in time order but for one late event."""
    folder, r, base = str(tmp_path_factory.mktemp("feed")), random.Random(1), dt.datetime(2025, 1, 1)
    events = sorted(((r.randrange(150), base + dt.timedelta(seconds=r.randrange(9000))) for _ in range(1000)), key=lambda e: e[1])
    for k in range(5):
        part = events[k * 200:(k + 1) * 200] + ([(7, base)] if k == 4 else [])
        spark.createDataFrame(part, "user_id int, event_time timestamp").coalesce(1).write.mode("append").parquet(f"{folder}/in/{k}")
    return folder, events


def drain(spark, folder, name, build):
    out = []
    src = (spark.readStream.schema("user_id int, event_time timestamp").option("recursiveFileLookup", "true")
           .option("maxFilesPerTrigger", 1).parquet(f"{folder}/in"))
    q = (build(src).writeStream.outputMode("append").option("checkpointLocation", f"{folder}/{name}")
         .foreachBatch(lambda b, i: out.extend((r.window.start, r.user_id, r.event_count) for r in b.collect()))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None
    return out, [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in q.recentProgress]


def test_panes_equal_sliding_counts_with_a_tenth_of_the_state(spark, feed):
    folder, events = feed
    slow, slow_state = drain(spark, folder, "sliding", lambda s: windows.window_counts(s, "1 minute", "5 seconds", watermark="30 minutes"))
    fast, fast_state = drain(spark, folder, "panes", lambda s: windows.pane_counts(s, "1 minute", "5 seconds", "30 minutes"))
    assert sorted(fast) == sorted(slow) and len(set((w, u) for w, u, _ in fast)) == len(fast) > 1000
    mark = max(t for _, t in events) - dt.timedelta(minutes=30)
    want = {}
    for user, t in events:
        start = t.replace(microsecond=0) - dt.timedelta(seconds=t.second % 5)
        for k in range(12):
            w = start - dt.timedelta(seconds=5 * k)
            if w + dt.timedelta(minutes=1) <= mark:
                want[w, user] = want.get((w, user), 0) + 1
    assert {(w, u): n for w, u, n in fast} == want
    # an open pane is one row where each event had twelve windows
    assert slow_state[0] > 10 * fast_state[0] and max(slow_state) > 8 * max(fast_state)


@pytest.mark.parametrize("duration,slide", [("1 minute", "5 seconds"), ("2 minutes", "5 seconds"), ("90 seconds", "30 seconds")])
def test_blocks_emit_the_changed_windows_of_update_mode(spark, tmp_path, duration, slide):
    """The same rows batch by batch as one state row a window, nulls and late events included."""
    r, base = random.Random(3), dt.datetime(2025, 1, 1)
    times = sorted(base + dt.timedelta(microseconds=r.randrange(900_000_000)) for _ in range(600))
    for k in range(3):
        part = [(r.randrange(15), t) for t in times[k * 200:(k + 1) * 200]]
        part += [(7, base), (None, times[-1]), (3, None)] if k == 2 else []
        spark.createDataFrame(part, "user_id int, event_time timestamp").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/{k}")
    src = (spark.readStream.schema("user_id int, event_time timestamp").option("recursiveFileLookup", "true")
           .option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in"))
    app, found, state = EventStreamApp(spark, SinkPaths(str(tmp_path)), EngineConfig(window_short=slide, window_slide=slide)), {}, {}
    app.counted_input = lambda raw: raw
    for name, counts in (("each", windows.window_counts(src, duration, slide, watermark="1 minute")),
                         ("blocks", app._windows(src, duration, "1 minute"))):
        out = []
        q = (counts.writeStream.outputMode("update").option("checkpointLocation", f"{tmp_path}/{name}")
             .foreachBatch(lambda b, i, out=out: out.extend((i, *x.window, x.user_id or -1, x.event_count) for x in b.collect()))
             .trigger(availableNow=True).start())
        q.awaitTermination()
        assert q.exception() is None
        found[name], state[name] = sorted(out), max(sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in q.recentProgress)
    assert found["each"] == found["blocks"] and len(found["each"]) > 300
    assert state["each"] > state["blocks"] * (5 if slide == "5 seconds" else 1)


def test_history_does_not_depend_on_the_number_of_micro_batches(spark):
    one, seven = (sorted(map(tuple, streamed.stream_anomalies_history(spark, SF_SMALL, k).collect())) for k in (1, 7))
    assert one == seven and one
    a, b = (moments_so_far(spark, streamed.run_final_windows(spark, SF_SMALL, k), "1min") for k in (1, 7))
    assert a.n == b.n and a.mean == pytest.approx(b.mean) and a.m2 == pytest.approx(b.m2)


def test_moments_merge_like_their_rows(spark):
    r = random.Random(2)
    rows = [(g, p, 1e9 + r.random() if g == "far" else float(r.randint(0, 9))) for g in ("far", "near", None) for p in range(4)
            for _ in range(p * 3)]
    df = spark.createDataFrame(rows, "g string, p int, v double")
    parts = M.moments(df, "v", ["g", "p"])
    got = {row.g: row for row in M.merge(parts, ["g"]).collect()}
    total = M.merge(parts).first()
    for g in ("far", "near", None):
        v = [x for a, _, x in rows if a == g]
        assert got[g].n == len(v) and got[g].mean == pytest.approx(statistics.fmean(v))
        assert got[g].m2 == pytest.approx(statistics.pvariance(v) * len(v), rel=1e-6)
    assert total.n == len(rows)
    one = M.Moments()
    for p in range(4):
        v = [x for a, q, x in rows if q == p and a == "near"]
        one += M.Moments.of(len(v), statistics.fmean(v) if v else None, statistics.stdev(v) if len(v) > 1 else None)
    near = [x for a, _, x in rows if a == "near"]
    assert one.stats == (pytest.approx(statistics.fmean(near)), pytest.approx(statistics.stdev(near)))


def test_moments_of_nothing(spark):
    empty = spark.createDataFrame([], "v double")
    assert tuple(M.moments(empty, "v").first()) == (0, 0.0, 0.0)
    assert M.Moments().stats == (None, None) and (M.Moments() + M.Moments()).n == 0
    assert M.Moments.of(1, 5.0, None).stats == (5.0, None) and not math.isnan(M.Moments.of(1, 5.0, None).m2)
    assert M.merge(M.moments(empty, "v")).first().n == 0
    assert M.merge(empty.select(F.lit(1).cast("long").alias("n"), F.col("v").alias("mean"), F.col("v").alias("m2"))).count() == 0
