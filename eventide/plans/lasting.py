"""Queries over tables that outlive a run: bases and batches since, key indexes,
sketches. Each writes what Spark derives from the driver tables under the shared
checkpoint folder, through the library's writers, and reads the result back."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from eventide.functions.vectors import matrix_literal, nearest_center
from eventide.operators import changelog, quantiles, windows
from eventide.operators.deadletter import REASON_KEY_CLASH
from eventide.operators.key_index import KeyIndex
from eventide.operators.keyed_table import KeyedTable
from eventide.plans.batch import CENTROID_CENTERS, CFG, DISTANCE_QUANTILE, action_window_features, wall_clock_micros
from eventide.schemas import RAW_KEY, SUMMARY_KEY
from eventide.session import shared_dir
from eventide.sources.tables import events_from_tables
from eventide.streaming.sinks import WINDOW_DATE

#: Synthetic micro-batches of some days that begin at noon, so that a day's
#: windows get rows from two of them.
COARSE_DAYS, COARSE_OFFSET_HOURS = 5, 12


def coarse_batch(ts_col: str = "event_time"):
    shifted = wall_clock_micros(ts_col) + COARSE_OFFSET_HOURS * 3_600_000_000
    return F.floor(shifted / (COARSE_DAYS * 86_400_000_000)).cast("long")


def _coarse_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts per (user, day) and coarse batch, as update mode writes them."""
    ev = events_from_tables(spark, sf_dir, CFG, with_geo=False).filter("event_time is not null").withColumn("batch_id", coarse_batch())
    counts = windows.flatten_window(windows.window_counts(ev, "1 day", keys=("user_id", "batch_id"), count_col="n"))
    w = Window.partitionBy(*SUMMARY_KEY).orderBy("batch_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.select(*SUMMARY_KEY, "batch_id", F.sum("n").over(w).alias("event_count"))


def summary_merge_on_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed summary from a base folded twice and the batches since: a third of
    the batches are folded, then another third with one of the first replayed,
    the rest is read from the log."""
    root = shared_dir(spark, "keyed")
    _coarse_log(spark, sf_dir).write.partitionBy("batch_id").parquet(f"{root}/rows")
    staged = spark.read.parquet(f"{root}/rows")
    ids = sorted(r[0] for r in staged.select("batch_id").distinct().collect())
    table = KeyedTable(spark, f"{root}/log", f"{root}/base", SUMMARY_KEY, part=WINDOW_DATE)

    def land(some):
        for b in some:
            changelog.append_batch(staged.filter(F.col("batch_id") == b).drop("batch_id"), f"{root}/log", b)

    third = max(1, len(ids) // 3)
    land(ids[:third])
    table.fold()
    land([*ids[third:2 * third], ids[0]])
    table.fold()
    land(ids[2 * third:])
    return table.read().select(*SUMMARY_KEY, "batch_id", "event_count")


#: Deliveries of ``route_unique``: days of the month that each batch brings, so that
#: part of the second and all of the first two come again.
DELIVERIES = ((1, 12), (8, 22), (1, 31))
UNIQUE_COLS = ["user_id", "timestamp", "action", "device_id", "product_id"]


def route_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with devices delivered in three overlapping batches: every row of every
    batch, with the dead letter's reason where its key was there before."""
    device = F.when(F.col("action") != "signup", F.concat(F.lit("d"), F.col("user_id") % 7))
    events = events_from_tables(spark, sf_dir, CFG, with_geo=False).withColumn("device_id", device)
    index = KeyIndex(spark, shared_dir(spark, "keys"))
    parts, landed = [], shared_dir(spark, "deliveries")
    for batch_id, (first, last) in enumerate(DELIVERIES):
        # a delivery is decoded once; the index reads it many times
        (events.filter(F.dayofmonth("event_time").between(first, last)).select(*UNIQUE_COLS)
         .write.parquet(f"{landed}/delivery={batch_id}"))
        rows = spark.read.parquet(f"{landed}/delivery={batch_id}")
        marked = index.mark(rows, batch_id)
        index.add(marked.filter("not key_clash"), batch_id)
        if batch_id == 1:
            index.fold()
        parts.append(index.mark(rows, batch_id).withColumn("batch_id", F.lit(batch_id)))
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.select("batch_id", *UNIQUE_COLS, F.when(F.col("key_clash"), F.lit(REASON_KEY_CLASH)).alias("reason"))


def distance_p95_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distance threshold as it stands after each day: the sketches of the days so
    far, merged. Each is within ``quantiles.ALPHA`` of the exact 95th percentile."""
    feats = action_window_features(events_from_tables(spark, sf_dir, CFG, with_geo=False))
    near = nearest_center(F.col("features"), matrix_literal(CENTROID_CENTERS))
    scored = feats.select(F.to_date("window_start").alias("day"), F.round(near["distance"], 9).alias("distance"))
    daily = quantiles.sketch(scored, "distance", ["day"])
    # a day's sketch counts towards that day and all later ones; days and buckets are few
    days = daily.select(F.collect_set("day").alias("days")).scalar()
    listed = daily.withColumn("days", days)  # a subquery may not stand inside the filter below
    upto = listed.select(F.explode(F.filter("days", lambda d: d >= F.col("day"))).alias("as_of"), "sign", "bucket", "n")
    return quantiles.quantile(upto, DISTANCE_QUANTILE, ["as_of"]).select(
        F.col("as_of").alias("day"), F.col("n").alias("n_rows"), F.round("value", 6).alias("threshold"))


def registered() -> dict:
    return {"distance_p95_sketch": distance_p95_sketch, "route_unique": route_unique, "summary_merge_on_read": summary_merge_on_read}


def oracles() -> dict[str, str]:
    from eventide.plans import oracle as O
    day = 86400
    coarse = f"CAST(floor((epoch_us(event_time) + {COARSE_OFFSET_HOURS * 3_600_000_000}) / {COARSE_DAYS * day * 1_000_000}) AS BIGINT)"
    deliveries = " UNION ALL ".join(f"SELECT {k} AS batch_id, * FROM e WHERE day(event_time) BETWEEN {a} AND {b}"
                                    for k, (a, b) in enumerate(DELIVERIES))
    whole_key = " AND ".join(f'"{c}" IS NOT NULL' for c in RAW_KEY)
    key = ", ".join(f'"{c}"' for c in RAW_KEY)
    g = quantiles.growth(quantiles.ALPHA)
    return {
        "distance_p95_sketch": f"""WITH {O.EVENTS_CTE.strip()},
c AS (SELECT {O._bucket('event_time', day)} AS window_start, user_id, action, count(*) AS event_count
      FROM ev WHERE event_time IS NOT NULL GROUP BY ALL),
f AS (SELECT *, [CAST(event_count AS DOUBLE), {O.CENTROID_FEATS}] AS feats FROM c),
d AS (SELECT CAST(window_start AS DATE) AS day, round(list_min(list_transform({O.CENTERS_SQL}, lambda ctr: sqrt(list_sum(
        list_transform(list_zip(feats, ctr), lambda p: (p[1] - p[2]) * (p[1] - p[2])))))), 9) AS distance FROM f),
k AS (SELECT day, CASE WHEN distance = 0 THEN -1000000 ELSE ceil(ln(distance) / {math.log(g)!r}) END AS bucket, count(*) AS n
      FROM d GROUP BY ALL),
u AS (SELECT x.day AS as_of, bucket, sum(n) AS n FROM k JOIN (SELECT DISTINCT day FROM k) x ON k.day <= x.day GROUP BY ALL),
r AS (SELECT *, sum(n) OVER (PARTITION BY as_of) AS total, sum(n) OVER (PARTITION BY as_of ORDER BY bucket) AS upto FROM u),
h AS (SELECT as_of, total, min(bucket) AS bucket FROM r WHERE upto >= greatest(1, ceil({DISTANCE_QUANTILE} * total)) GROUP BY ALL)
SELECT as_of AS day, CAST(total AS BIGINT) AS n_rows,
       round(CASE WHEN bucket = -1000000 THEN 0 ELSE 2.0 * pow({g!r}, bucket) / {g + 1!r} END, 6) AS threshold FROM h""",
        "route_unique": f"""WITH {O.EVENTS_CTE.strip()},
e AS (SELECT user_id, "timestamp", action, CASE WHEN action <> 'signup' THEN 'd' || CAST(user_id % 7 AS VARCHAR) END AS device_id,
             product_id, event_time FROM ev),
d AS ({deliveries}),
r AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY batch_id, product_id NULLS FIRST) AS rn FROM d)
SELECT batch_id, user_id, "timestamp", action, device_id, product_id,
       CASE WHEN {whole_key} AND rn > 1 THEN '{REASON_KEY_CLASH}' END AS reason FROM r""",
        "summary_merge_on_read": f"""WITH {O.EVENTS_CTE.strip()},
s AS ({O._tumbling(day)}),
b AS (SELECT user_id, {O._bucket('event_time', day)} AS window_start, max({coarse}) AS batch_id
      FROM ev WHERE event_time IS NOT NULL GROUP BY ALL)
SELECT s.user_id, s.window_start, s.window_end, b.batch_id, s.event_count
FROM s JOIN b ON s.window_start = b.window_start AND s.user_id IS NOT DISTINCT FROM b.user_id""",
    }
