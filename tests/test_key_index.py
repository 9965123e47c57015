"""Unique keys across batches: every row accounted for, duplicates found however late."""
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventide.operators.key_index import KeyIndex
from eventide.plans import lasting
from eventide.plans.batch import CFG
from eventide.schemas import JSON_OPTIONS
from eventide.sources.stream import file_source
from eventide.streaming.application import EventStreamApp
from eventide.streaming.sinks import SinkPaths

from conftest import SF_SMALL

SCHEMA = "user_id int, action string, device_id string, product_id int"
KEY = ["user_id", "action", "device_id"]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def plain(seen, rows):
    """Flags as SQL UNIQUE would give them, the smallest row of a key first."""
    out = Counter()
    order = lambda r: tuple((v is not None, v) for v in r[3:])
    for row in sorted(rows, key=order):
        key = row[:3]
        if None in key:
            out[(*row, False)] += 1
        else:
            out[(*row, key in seen)] += 1
            seen.add(key)
    return out


def marked(index, df, batch):
    return Counter(map(tuple, index.mark(df, batch).collect()))


@pytest.mark.parametrize("buckets", [1, 64])
def test_random_batches_folds_and_replays(spark, tmp_dir, buckets):
    r, seen = random.Random(buckets), set()
    index = KeyIndex(spark, f"{tmp_dir}/i", KEY, buckets=buckets)
    for batch in range(5):
        rows = [(r.randrange(20), r.choice("ab"), r.choice(["x", "y", None]), r.choice([1, 2, None])) for _ in range(60)]
        df = frame(spark, rows + rows[:7])
        got = marked(index, df, batch)
        assert got == plain(seen, rows + rows[:7]) and sum(got.values()) == 67
        index.add(index.mark(df, batch).filter("not key_clash"), batch)
        if batch in (1, 3):
            assert index.fold()["folded"] == ([0, 1] if batch == 1 else [2, 3])
        assert marked(index, df, batch) == got  # a replay finds what the first run found
    assert index.fold()["folded"] == [4] and index.fold() is None


def test_a_duplicate_is_found_after_many_batches(spark, tmp_dir):
    index = KeyIndex(spark, f"{tmp_dir}/i", KEY)
    for batch in range(4):
        index.add(frame(spark, [(batch, "a", "x", 1)]), batch)
    index.fold()
    got = {r.user_id: r.key_clash for r in index.mark(frame(spark, [(0, "a", "x", 9), (7, "a", "x", 9)]), 4).collect()}
    assert got == {0: True, 7: False}
    # a batch never clashes with itself or with a later one
    assert [r.key_clash for r in index.mark(frame(spark, [(2, "a", "x", 1)]), 2).collect()] == [False]


def test_filter_lets_few_keys_through_and_loses_none(spark, tmp_dir):
    index = KeyIndex(spark, f"{tmp_dir}/i", ["id"], buckets=4)
    index.add(spark.range(8000).filter("id % 2 = 0"), 0)
    bits = spark.read.parquet(f"{tmp_dir}/i/filters")
    asked = spark.range(8000).withColumn("bucket", index._bucket()).join(bits, "bucket")
    for b in index._bits():
        asked = asked.filter(index._is_set(F.col("bits"), b))
    through = {r.id for r in asked.select("id").collect()}
    assert through >= set(range(0, 8000, 2)) and len(through) < 4000 * 1.05
    assert index.known(spark.range(8000), 1).count() == 4000


def test_copies_of_one_row_are_counted_before_they_are_joined(spark, tmp_dir, monkeypatch):
    index = KeyIndex(spark, f"{tmp_dir}/i", ["id"])
    monkeypatch.setattr("eventide.operators.key_index.COPIES", 700)
    rows = spark.range(3000).select(F.lit(1).cast("long").alias("id"), F.lit("x").alias("v"))
    assert Counter(r.key_clash for r in index.mark(rows, 0).collect()) == {False: 1, True: 2999}
    nulls = spark.range(50).select(F.lit(None).cast("long").alias("id"), F.lit("x").alias("v"))
    assert Counter(r.key_clash for r in index.mark(nulls, 0).collect()) == {False: 50}
    assert index.mark(rows.limit(0), 0).collect() == []


def test_route_sends_clashes_to_the_dead_letter(spark, tmp_dir):
    sinks = SinkPaths(f"{tmp_dir}/sinks")
    event = '{"user_id":%d,"product_id":1,"action":"click","timestamp":"2025-01-01 00:00:0%d","device_id":%s,"location":"HN"}'
    for k, lines in enumerate([[(1, 1, '"d"'), (2, 1, '"d"'), (2, 1, '"d"'), (3, 1, "null")],
                               [(1, 1, '"d"'), (1, 2, '"d"'), (3, 1, "null"), (0, 1, '"d"')]]):
        spark.createDataFrame([(event % x,) for x in lines], "value string").coalesce(1).write.mode("append").text(f"{tmp_dir}/in")
    pipe = EventStreamApp(spark, sinks, CFG, unique_raw=True, fold_every=1)
    pipe.start(file_source(spark, f"{tmp_dir}/in", max_files_per_trigger=1), trigger="availableNow", which=("raw_route",))
    pipe.await_all()
    kept = Counter((r.user_id, r.event_time.second) for r in spark.read.parquet(sinks.raw).collect())
    assert kept == {(1, 1): 1, (2, 1): 1, (3, 1): 2, (1, 2): 1}
    dead = spark.read.text(sinks.dlq).select(F.from_json("value", "row struct<user_id int>, reason string", JSON_OPTIONS).alias("d"))
    assert Counter((r.d.row.user_id, r.d.reason) for r in dead.collect()) == {
        (1, "sink_key_clash"): 1, (2, "sink_key_clash"): 1, (0, "invalid_user_id"): 1}


def test_route_unique_decodes_a_delivery_once(spark):
    """The index works on the deliveries as they landed, not on the events each time."""
    found = lasting.route_unique(spark, SF_SMALL)
    assert found.inputFiles() and not any("events.parquet" in f for f in found.inputFiles())
