"""The quantile sketch within its bound, and clustering that no partitioning changes."""
import math
import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from eventide.config import EngineConfig
from eventide.operators import lloyd, quantiles
from eventide.plans import batch, training
from eventide.sources.tables import events_from_tables

from conftest import SF_SMALL


def exact(values, q):
    return sorted(values)[max(1, math.ceil(q * len(values))) - 1]


@pytest.mark.parametrize("alpha", [0.005, 0.05])
def test_sketch_is_within_its_bound_and_merges(spark, alpha):
    r = random.Random(3)
    rows = [(d, r.choice([0.0, -1.0, 1.0, 1.0, 1.0]) * math.exp(r.gauss(0, 4))) for d in range(5) for _ in range(300)]
    df = spark.createDataFrame([*rows, (0, None), (0, float("nan"))], "d int, v double").repartition(7)
    daily = quantiles.sketch(df, "v", ["d"], alpha)
    for q in (0.0, 0.05, 0.5, 0.95, 1.0):
        by_day = {x.d: x for x in quantiles.quantile(daily, q, ["d"], alpha).collect()}
        for d in range(5):
            want = exact([v for e, v in rows if e == d], q)
            assert by_day[d].n == 300 and abs(by_day[d].value - want) <= alpha * abs(want) * 1.000001
        whole = quantiles.quantile(daily.drop("d"), q, alpha=alpha).first()
        want = exact([v for _, v in rows], q)
        assert whole.n == 1500 and abs(whole.value - want) <= alpha * abs(want) * 1.000001
    direct = quantiles.sketch(df, "v", alpha=alpha)
    assert quantiles.merge(daily.drop("d")).exceptAll(direct).count() == 0


def test_threshold_of_days_equals_that_of_all(spark, tmp_dir):
    """Sketches kept a day at a time give the threshold within the bound of ``distance_p95``'s."""
    feats = batch.action_window_features(events_from_tables(spark, SF_SMALL, with_geo=False))
    near = batch.nearest_center(F.col("features"), batch.matrix_literal(batch.CENTROID_CENTERS))
    scored = feats.select(F.dayofmonth("window_start").alias("day"), near["distance"].alias("score")).persist()
    assert training.threshold_from(spark, f"{tmp_dir}/log") is None
    for day in range(1, 32):
        training.add_distances(scored.filter(F.col("day") == day), f"{tmp_dir}/log", day)
    training.add_distances(scored.filter("day = 7"), f"{tmp_dir}/log", 7)
    got = training.threshold_from(spark, f"{tmp_dir}/log")
    want = exact([r.score for r in scored.select("score").collect()], EngineConfig().threshold_quantile)
    assert abs(got - want) <= quantiles.ALPHA * want * 1.000001
    scored.unpersist()


def test_empty_sketch(spark):
    none = spark.createDataFrame([], "v double")
    assert quantiles.quantile(quantiles.sketch(none, "v"), 0.5).collect() == []


def test_centres_are_the_same_under_any_partitioning(spark):
    frame = training.training_frame(events_from_tables(spark, SF_SMALL, with_geo=False))
    vectors = training.native_features(frame, batch.CENTROID_CATEGORIES)
    found = [lloyd.fit(df, 5) for df in (vectors, vectors.repartition(1), vectors.repartition(13, "user_id").orderBy(F.rand(5)))]
    assert found[0] == found[1] == found[2] and len(found[0]) == 5


def test_centres_of_plain_points(spark):
    points = [(float(x), float(y)) for x, y in [(0, 0), (0, 1), (1, 0), (10, 10), (10, 11), (-3.25, 0.5)]]
    df = spark.createDataFrame([([x, y],) for x, y in points * 3] + [(None,)], "features array<double>")
    centers = lloyd.fit(df, 2)
    by = [[] for _ in centers]
    for p in points:
        d = [sum((a - b) ** 2 for a, b in zip(p, c)) for c in centers]
        by[d.index(min(d))].append(p)
    for c, own in zip(centers, by):  # a fixed point of Lloyd's step
        assert c == pytest.approx([sum(v) / len(own) for v in zip(*own)])
    assert lloyd.fit(df.limit(0), 3) == [] and len(lloyd.fit(df, 50)) == len(points)


def test_native_features_equal_the_pipeline_stages(spark):
    frame = training.training_frame(events_from_tables(spark, SF_SMALL, with_geo=False))
    model, _ = training.fit(frame)
    labels = sorted(model.stages[0].labels)
    assert labels == list(model.stages[0].labels)
    by_stages = model.transform(frame).withColumn("by_stages", vector_to_array("features")).drop("features")
    both = training.native_features(by_stages, labels)
    assert both.filter("by_stages != features").count() == 0 and both.count() > 100
