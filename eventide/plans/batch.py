"""Batch plans over the driver tables. Each takes ``(spark, sf_dir)`` and
returns a lazy DataFrame; column names match the SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventide.config import EngineConfig
from eventide.functions import quality
from eventide.functions.decode import avro_branch_filter, parse_events
from eventide.functions.text import to_copy_text
from eventide.functions.vectors import matrix_literal, nearest_center, one_hot
from eventide.operators import changelog, windows
from eventide.operators.alerts import alert_records, notifications, parse_alerts, split_alerts, to_kafka_rows
from eventide.operators.deadletter import dlq_json, dlq_records, raw_sink_rows
from eventide.operators.detect import CentroidDistanceDetector, FixedCountDetector, ZScoreDetector
from eventide.operators.enrich import enrich
from eventide.schemas import JSON_OPTIONS, RAW_COLS, RAW_KEY, SUMMARY_KEY
from eventide.sources.tables import events_from_tables, json_envelope, read_table, users_from_tables

CFG = EngineConfig()

# Synthetic micro-batching of the driver tables: one batch per event hour.
BATCH_SECONDS = 3600


def _events(spark, sf_dir, geo=True):
    return events_from_tables(spark, sf_dir, CFG, with_geo=geo)


def wall_clock_micros(ts_col: str = "event_time"):
    """Microseconds from 1970-01-01 00:00:00 to a TIMESTAMP_NTZ value; no time
    zone is involved, whatever the session zone is."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, F.col(ts_col).cast("timestamp_ntz"))


def batch_id_of(ts_col: str = "event_time"):
    return F.floor(wall_clock_micros(ts_col) / (BATCH_SECONDS * 1_000_000)).cast("long")


# --- data quality ------------------------------------------------------------

def dq_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = quality.split_valid_invalid(_events(spark, sf_dir), CFG)
    return valid.select(*RAW_COLS, "event_time")


def dq_invalid_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, invalid = quality.split_valid_invalid(_events(spark, sf_dir), CFG)
    return invalid.select("user_id", "product_id", "action", "event_time", "location", "dq_reason")


def dq_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dq_profile(quality.with_dq_reason(_events(spark, sf_dir), CFG))


def decode_json_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events → JSON envelope → decode with the fixed schema → flatten →
    event time from text → required fields."""
    raw = json_envelope(_events(spark, sf_dir)).select("value")
    parsed = parse_events(raw, CFG, fmt="json")
    return parsed.withColumn("event_time", F.col("event_time").cast("timestamp_ntz")) \
        .select(*RAW_COLS, "event_time")


# The middle of the events' month: with this clock half of them are of the future.
STRICT_AS_OF = "2024-01-16 00:00:00"
STRICT_MAX_LOCATION = 8


def dq_reasons_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five rules, each with rows that break it: a fixed clock within the
    data and a location limit that some nation names pass."""
    tagged = quality.with_dq_reason(_events(spark, sf_dir), CFG.with_(max_location_len=STRICT_MAX_LOCATION), STRICT_AS_OF)
    return tagged.select("user_id", "product_id", "action", "event_time", "location", "dq_reason")


def _broken_envelopes(events: DataFrame) -> DataFrame:
    """The JSON envelopes, some of them spoilt: by product id a tenth each is cut in
    half, empty, missing, without its action, with a time that is none, and
    with a product id that is no number."""
    k = F.coalesce(F.col("product_id") % 10, F.lit(9))
    whole = F.struct(*[F.col(c) for c in RAW_COLS])
    value = F.to_json(whole, JSON_OPTIONS)
    spoilt = (F.when(k == 0, F.substring(value, 1, 30)).when(k == 1, F.lit("")).when(k == 2, F.lit(None).cast("string"))
              .when(k == 3, F.regexp_replace(value, '"action":"[a-z_]*",', ""))
              .when(k == 4, F.regexp_replace(value, '"timestamp":"[^"]*"', '"timestamp":"yesterday"'))
              .when(k == 5, F.regexp_replace(value, '"product_id":[0-9]+', '"product_id":"none"')).otherwise(value))
    return events.select(spoilt.alias("value"))


def decode_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spoilt envelopes: what the decoder keeps, per action."""
    parsed = parse_events(_broken_envelopes(_events(spark, sf_dir)), CFG)
    return parsed.groupBy("action", F.to_date("event_time").alias("day")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("product_id").alias("n_products"))


def avro_filter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The allowed-value and location filters of the Avro branch over the events."""
    kept = _events(spark, sf_dir).filter(avro_branch_filter(CFG.with_(max_location_len=STRICT_MAX_LOCATION)))
    return kept.select(*RAW_COLS, "event_time")


# --- windows -----------------------------------------------------------------

def _summary(spark, sf_dir, duration, slide=None):
    return windows.summary(_events(spark, sf_dir, geo=False), duration, slide)


def tumbling_5s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(spark, sf_dir, CFG.window_short, CFG.window_slide)


def sliding_1min_5s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(spark, sf_dir, CFG.window_long, CFG.window_slide)


def tumbling_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(spark, sf_dir, "1 hour")


def sliding_1d_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(spark, sf_dir, "1 day", "1 hour")


def sliding_by_action_1h_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding counts of few, busy keys: bucket counts are added up per window."""
    counts = windows.window_counts(_events(spark, sf_dir, geo=False), "1 hour", "5 minutes", keys=("action",), buckets=True)
    return windows.flatten_window(counts)


def user_action_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.action_counts(_events(spark, sf_dir, geo=False))


def summary_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(_summary(spark, sf_dir, "1 day"), users_from_tables(spark, sf_dir, CFG))


def summary_enriched_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts joined with the users that have an urgent order: others stay, without a name."""
    urgent = read_table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select(
        F.col("o_custkey").cast("int").alias("user_id"))
    users = users_from_tables(spark, sf_dir, CFG).join(urgent, "user_id", "left_semi")
    return enrich(_summary(spark, sf_dir, "1 day"), users)


# --- detection ---------------------------------------------------------------

DETECT_COLS = ["window_start", "window_end", "user_id", "event_count", "score", "severity"]


def _scored(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in DETECT_COLS if c != "score"],
                     F.round("score", 6).alias("score"))


def anomaly_zscore(spark: SparkSession, sf_dir: str, duration: str = "1 day") -> DataFrame:
    det = ZScoreDetector(CFG.z_threshold, high_factor=CFG.severity_high_factor)
    return _scored(det.anomalies(_summary(spark, sf_dir, duration)))


def anomaly_zscore_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly_zscore(spark, sf_dir, "1 day")


def anomaly_zscore_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly_zscore(spark, sf_dir, "1 hour")


def anomaly_zscore_by_window_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Z-score scoped per day: statistics of the hourly counts within each day."""
    s = _summary(spark, sf_dir, "1 hour").withColumn("day", F.to_date("window_start"))
    det = ZScoreDetector(CFG.z_threshold, group_cols=["day"], high_factor=CFG.severity_high_factor)
    return _scored(det.anomalies(s))


def anomaly_fixed_count_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    det = FixedCountDetector(CFG.count_threshold, high_factor=CFG.severity_high_factor)
    return _scored(det.anomalies(_summary(spark, sf_dir, "1 day")))


# Literal centres in (event_count, one-hot action) space for the distance
# detector: one centre per known action at a count of 1, plus one for actions
# outside the list (all-zero indicator). Categories follow alphabetical order.
CENTROID_CATEGORIES = tuple(sorted(CFG.valid_actions))
CENTROID_CENTERS = [[1.0] + [1.0 if j == i else 0.0 for j in range(len(CENTROID_CATEGORIES))]
                    for i in range(len(CENTROID_CATEGORIES))] + \
                   [[1.0] + [0.0] * len(CENTROID_CATEGORIES)]
CENTROID_THRESHOLD = 1.5


def action_window_features(df: DataFrame, duration: str = "1 day") -> DataFrame:
    """(window, user, action) counts with ``features = [event_count, one-hot(action)]``."""
    counts = windows.flatten_window(windows.window_counts(df, duration, keys=("user_id", "action")))
    feats = F.array(F.col("event_count").cast("double"),
                    *one_hot(F.col("action"), CENTROID_CATEGORIES, drop_last=False))
    return counts.withColumn("features", feats)


def anomaly_centroid_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    det = CentroidDistanceDetector(CENTROID_CENTERS, CENTROID_THRESHOLD,
                                   high_factor=CFG.severity_high_factor)
    out = det.anomalies(action_window_features(_events(spark, sf_dir, geo=False)))
    return out.select("window_start", "window_end", "user_id", "action", "event_count", "cluster",
                      F.round("score", 6).alias("score"), "severity")


DISTANCE_QUANTILE = 0.95


def distance_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per cluster the rows, the mean distance and how many lie strictly beyond the
    exact 95th percentile of all distances to the nearest centre."""
    feats = action_window_features(_events(spark, sf_dir, geo=False))
    near = nearest_center(F.col("features"), matrix_literal(CENTROID_CENTERS))
    scored = feats.select(near.alias("near")).select(F.round("near.distance", 9).alias("distance"), "near.cluster")
    limit = scored.select(F.percentile("distance", F.lit(DISTANCE_QUANTILE))).scalar()
    return scored.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.avg("distance"), 6).alias("mean_distance"),
        F.count_if(F.col("distance") > limit).alias("n_beyond"))


# --- keyed tables: change log and its views -------------------------------------

def summary_change_log(spark: SparkSession, sf_dir: str, duration: str = "1 day") -> DataFrame:
    """What update-mode output of a window count writes, batch by batch: for
    each batch in which a (window, user) key received events, its running count.

    The per-key ordering is over at most (window / batch) rows, so the window
    function never holds a large group."""
    ev = _events(spark, sf_dir, geo=False).withColumn("batch_id", batch_id_of())
    per_batch = windows.flatten_window(
        windows.window_counts(ev, duration, keys=("user_id", "batch_id"), count_col="n"))
    from pyspark.sql import Window
    w = Window.partitionBy(*SUMMARY_KEY).orderBy("batch_id") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_batch.select(*SUMMARY_KEY, "batch_id", F.sum("n").over(w).alias("event_count"))


def summary_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.latest_by_key(summary_change_log(spark, sf_dir), SUMMARY_KEY)


def anomaly_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert-ignore of fixed-count anomalies: the first batch at which each
    key crossed the threshold, with the count it had then."""
    log = summary_change_log(spark, sf_dir)
    det = FixedCountDetector(CFG.count_threshold, high_factor=CFG.severity_high_factor)
    anomalies = det.anomalies(log).select(*SUMMARY_KEY, "batch_id", "event_count", "severity")
    return changelog.first_by_key(anomalies, SUMMARY_KEY)


def _replayed(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return ev.unionByName(ev)  # every event delivered twice (at-least-once replay)


def raw_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.dedup_rows(_replayed(spark, sf_dir), RAW_KEY, nulls_distinct=True) \
        .select(*RAW_COLS)


def raw_dedup_nulls_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.dedup_rows(_replayed(spark, sf_dir), RAW_KEY, nulls_distinct=False) \
        .select(*RAW_COLS)


def raw_dedup_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replayed events with a device for all but sign-ups: a device's events are
    kept once, those without one are never duplicates of each other."""
    device = F.when(F.col("action") != "signup", F.concat(F.lit("d"), F.col("user_id") % 7))
    replayed = _replayed(spark, sf_dir).withColumn("device_id", device)
    return changelog.dedup_rows(replayed, RAW_KEY, nulls_distinct=True).select(*RAW_COLS)


# --- sinks and transport -----------------------------------------------------------

def text_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = quality.split_valid_invalid(_events(spark, sf_dir), CFG)
    return to_copy_text(raw_sink_rows(valid), RAW_COLS)


def dlq_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows → dead-letter JSON → parsed back (fields, not text, compared)."""
    _, invalid = quality.split_valid_invalid(_events(spark, sf_dir), CFG)
    recs = dlq_records(invalid, batch_id_of(), row_cols=RAW_COLS + ["event_time"])
    js = dlq_json(recs)
    schema = "batch_id long, row struct<user_id int, product_id int, action string, " \
             "event_time timestamp_ntz>, reason string"
    back = js.select(F.from_json("value", schema, JSON_OPTIONS).alias("d"))
    return back.select(F.col("d.batch_id").alias("batch_id"), F.col("d.row.user_id").alias("user_id"),
                       F.col("d.row.product_id").alias("product_id"),
                       F.col("d.row.action").alias("action"),
                       F.col("d.row.event_time").alias("event_time"),
                       F.col("d.reason").alias("dq_reason"))


def _alerts_1d(spark, sf_dir):
    det = ZScoreDetector(CFG.z_threshold, high_factor=CFG.severity_high_factor)
    found = det.anomalies(_summary(spark, sf_dir, "1 day"))
    # names are looked up for the anomalies only, not for every window count
    recs = alert_records(enrich(found, users_from_tables(spark, sf_dir, CFG)), batch_id=0)
    return parse_alerts(to_kafka_rows(recs))


def alert_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anomalies → alert JSON → parsed back into the alert columns."""
    valid, _ = split_alerts(_alerts_1d(spark, sf_dir))
    return valid.select("user_id", "user_name", "region", "window_start", "window_end",
                        "event_count", "detector_type", F.round("score", 6).alias("score"),
                        "threshold", "severity")


def alert_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = split_alerts(_alerts_1d(spark, sf_dir))
    return notifications(valid)


# --- flagship ------------------------------------------------------------------------

def flagship(spark: SparkSession, sf_dir: str, duration: str = "1 day") -> DataFrame:
    """events → validate → window count → z-score → users left join → anomalies."""
    valid, _ = quality.split_valid_invalid(_events(spark, sf_dir), CFG)
    counts = windows.summary(valid, duration)
    det = ZScoreDetector(CFG.z_threshold, high_factor=CFG.severity_high_factor)
    # enrichment after detection: the left join on a unique key keeps every
    # row, so only the (few) anomalies need the users lookup
    out = enrich(det.anomalies(counts), users_from_tables(spark, sf_dir, CFG))
    return out.select("window_start", "window_end", "user_id", "user_name", "region", "event_count",
                      F.round("score", 6).alias("score"), "severity")


def flagship_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagship(spark, sf_dir, "1 day")
