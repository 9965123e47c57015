"""What a drain opens for its state, and what it sends to the driver."""
import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from eventide.functions.decode import MALFORMED, parse_events
from eventide.plans import streamed
from eventide.schemas import REQUIRED_COLS
from eventide.streaming.application import LEAST_STATE_PARTITIONS, drain_state_partitions


@pytest.fixture
def wide(spark):
    """A session with more shuffle partitions than a drain needs for its state."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    most = max(LEAST_STATE_PARTITIONS, 2 * spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.shuffle.partitions", str(most + 9))
    yield most
    spark.conf.set("spark.sql.shuffle.partitions", before)


def tables(spark, folder):
    r, base = random.Random(11), dt.datetime(2024, 1, 1)
    events = [(k, base + dt.timedelta(seconds=r.randrange(7200)), r.randrange(20), "view", 1.0, '{"k": 3}') for k in range(200)]
    for name, rows, schema in (
            ("events", events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"),
            ("customer", [(k, f"c{k}", 0, 0.0, "AUTOMOBILE") for k in range(20)],
             "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
            ("nation", [(0, "ALGERIA", 0)], "n_nationkey int, n_name string, n_regionkey int"),
            ("region", [(0, "AFRICA")], "r_regionkey int, r_name string")):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return events


def test_panes_keep_to_the_partitions_of_the_cluster(spark, wide, tmp_dir):
    """A task reports every partition's metric, so their number must not follow the session's."""
    events = tables(spark, tmp_dir)
    rows = streamed.stream_panes(spark, tmp_dir).collect()
    sinks = streamed.run_final_windows(spark, tmp_dir)
    state = f"{sinks.checkpoint('summary_1min').removeprefix('file:')}/state"
    opened = {op: sum(p.isdigit() for p in os.listdir(f"{state}/{op}")) for op in os.listdir(state) if op.isdigit()}
    assert len(opened) == 2 and set(opened.values()) == {wide}
    mark, want = max(e[1] for e in events) - dt.timedelta(minutes=2), {}
    for _, t, user, *_ in events:
        start = t - dt.timedelta(seconds=t.second % 5)
        for k in range(12):
            w = start - dt.timedelta(seconds=5 * k)
            if w + dt.timedelta(minutes=1) <= mark:
                want[w, user] = want.get((w, user), 0) + 1
    assert {(x.window_start, x.user_id): x.event_count for x in rows} == want and len(rows) == len(want)


def test_fewer_partitions_of_the_session_hold(spark):
    assert drain_state_partitions(spark) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_a_value_is_decoded_once(spark):
    """The conditions on the decoded fields stand above the decoding and do not repeat it."""
    raw = spark.createDataFrame(
        [('{"user_id": 1, "product_id": 2, "action": "view", "timestamp": "2024-01-01 00:00:05"}',), ('{"user_id": 1}',), ("x",), (None,)],
        "value string")
    for fields in (None, (*REQUIRED_COLS, "timestamp")):
        events = parse_events(raw, fields=fields).filter(F.col("event_time") <= F.current_timestamp())
        assert [(e.user_id, e.event_time) for e in events.collect()] == [(1, dt.datetime(2024, 1, 1, 0, 0, 5))]
        plan = events._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1
    kept = parse_events(raw, keep_rejects=True)
    assert sorted((e._raw or "", e.parse_reason or "") for e in kept.collect()) == [
        ("", MALFORMED), ("x", MALFORMED), ('{"user_id": 1, "product_id": 2, "action": "view", "timestamp": "2024-01-01 00:00:05"}', ""),
        ('{"user_id": 1}', "")]
