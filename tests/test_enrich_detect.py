import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from eventide.operators.detect import (CentroidDistanceDetector, FixedCountDetector,
                                       PredictionDetector, ZScoreDetector, detect)
from eventide.operators.enrich import enrich

W0, W1 = dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 1, 0, 0, 5)


def _counts(spark, counts):
    return spark.createDataFrame([(W0, W1, i + 1, c) for i, c in enumerate(counts)],
                                 "window_start timestamp, window_end timestamp, user_id int, event_count long")


def test_enrich_left_outer(spark):
    users = spark.createDataFrame([(1, "Alice", "HN")], "user_id int, name string, region string")
    out = {r["user_id"]: r for r in enrich(_counts(spark, [3, 4]), users).collect()}
    assert out[1]["user_name"] == "Alice" and out[1]["region"] == "HN"
    assert out[2]["user_name"] is None and out[2]["region"] is None


def _jobs(spark, build):
    """Spark jobs that ``build`` starts, by its job group."""
    group = f"build-{id(build)}"
    spark.sparkContext.setJobGroup(group, "plan building")
    try:
        build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_building_a_plan_runs_no_job(spark):
    users = spark.createDataFrame([(1, "Alice", "HN")], "user_id int, name string, region string")
    counts = _counts(spark, [1, 2, 3])
    assert _jobs(spark, lambda: enrich(counts, users)) == 0
    assert _jobs(spark, lambda: ZScoreDetector(2.0, group_cols=["window_start"]).anomalies(counts)) == 0


def test_zscore_flags_outlier(spark):
    s = _counts(spark, [2] * 9 + [100])
    out = ZScoreDetector(2.0).anomalies(s).collect()
    assert len(out) == 1 and out[0]["event_count"] == 100
    assert math.isclose(out[0]["score"], 2.846, abs_tol=1e-3)
    assert out[0]["severity"] == "medium" and out[0]["detector_type"] == "zscore"


def test_zscore_zero_stddev_and_small_batches(spark):
    assert ZScoreDetector(2.0).anomalies(_counts(spark, [1] * 10)).count() == 0
    assert ZScoreDetector(2.0).anomalies(_counts(spark, [1, 1, 1, 1, 1000])).count() == 0
    assert ZScoreDetector(2.0).anomalies(_counts(spark, [1] * 5 + [1000])).count() == 1


def test_zscore_grouped(spark):
    a = _counts(spark, [2] * 9 + [100]).withColumn("g", F.lit("a"))
    b = _counts(spark, [5] * 10).withColumn("g", F.lit("b"))
    out = ZScoreDetector(2.0, group_cols=["g"]).anomalies(a.unionByName(b)).collect()
    assert [(r["g"], r["event_count"]) for r in out] == [("a", 100)]


def test_fixed_count(spark):
    out = FixedCountDetector(5).anomalies(_counts(spark, [5, 6, 20])).collect()
    assert sorted((r["event_count"], r["severity"]) for r in out) == [(6, "medium"), (20, "high")]


def test_distance_strictly_greater(spark):
    df = spark.createDataFrame([([100.0, 1.0, 0.0],)], "features array<double>")
    det = CentroidDistanceDetector([[20.0, 1.0, 0.0]], threshold=80.0)
    r = det.score(df).first()
    assert r["score"] == 80.0 and r["cluster"] == 0 and r["is_anomaly"] is False
    assert CentroidDistanceDetector([[20.0, 1.0, 0.0]], 79.9).anomalies(df).count() == 1


def test_prediction_contract(spark):
    class DoubleFlag:
        def transform(self, df):
            return df.withColumn("prediction", F.when(df.event_count > 50, -1).otherwise(1))
    out = PredictionDetector(DoubleFlag()).anomalies(_counts(spark, [100, 2])).collect()
    assert [r["event_count"] for r in out] == [100]
    assert out[0]["reason"] == "model_detected"


def test_detect_unions_detectors(spark):
    s = _counts(spark, [2] * 9 + [100])
    out = detect(s, [ZScoreDetector(2.0), FixedCountDetector(5)])
    assert sorted(r["detector_type"] for r in out.collect()) == ["fixed_count", "zscore"]
    assert detect(s, []) is None


def test_zscore_grouped_null_group_is_its_own_group(spark):
    a = _counts(spark, [2] * 9 + [100]).withColumn("g", F.lit(None).cast("string"))
    b = _counts(spark, [5] * 10).withColumn("g", F.lit("b"))
    scored = ZScoreDetector(2.0, group_cols=["g"]).score(a.unionByName(b))
    assert scored.count() == 20
    out = [(r["g"], r["event_count"]) for r in scored.filter("is_anomaly").collect()]
    assert out == [(None, 100)]
