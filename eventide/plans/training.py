"""Training job for the distance detector: (window, user, action) counts →
index/one-hot/assemble → KMeans → distance of every training row to its
centre → threshold = chosen quantile of those distances.

Training and scoring use the same grain and features, so the saved pipeline
can score window counts directly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F

from eventide.config import EngineConfig
from eventide.functions.vectors import distance_to_assigned, matrix_literal, one_hot
from eventide.operators import changelog, lloyd, quantiles, windows
from eventide.operators.detect import KMeansModelDetector
from eventide.plans.batch import CENTROID_CATEGORIES, CFG
from eventide.session import ensure_checkpoint_dir, shared_dir
from eventide.sources.tables import events_from_tables


def training_frame(events: DataFrame, duration: str = "1 day") -> DataFrame:
    counts = windows.window_counts(events, duration, keys=("user_id", "action"))
    return windows.flatten_window(counts)


def build_pipeline(cfg: EngineConfig | None = None) -> Pipeline:
    cfg = cfg or EngineConfig()
    indexer = StringIndexer(inputCol="action", outputCol="action_index", handleInvalid="keep",
                            stringOrderType="alphabetAsc")
    encoder = OneHotEncoder(inputCols=["action_index"], outputCols=["action_encoded"])
    assembler = VectorAssembler(inputCols=["event_count", "action_encoded"], outputCol="features")
    kmeans = KMeans(k=cfg.kmeans_k, seed=cfg.kmeans_seed, featuresCol="features",
                    predictionCol="cluster")
    return Pipeline(stages=[indexer, encoder, assembler, kmeans])


def fit(frame: DataFrame, cfg: EngineConfig | None = None, checkpointed: bool = False
        ) -> tuple[PipelineModel, float]:
    """Fit the pipeline and derive the distance threshold.

    The training frame is checkpointed to the shared folder first: KMeans runs
    many passes, and a lost executor then recomputes from the checkpoint, not
    from the raw scan.
    """
    cfg = cfg or EngineConfig()
    if not checkpointed:
        frame = checkpoint_frame(frame)
    model = build_pipeline(cfg).fit(frame)
    scored = KMeansModelDetector(model, threshold=float("inf")).score(frame)
    threshold = scored.select(F.percentile_approx("score", cfg.threshold_quantile,
                                                  cfg.threshold_accuracy)).first()[0]
    return model, float(threshold)


def add_distances(scored: DataFrame, log_path: str, batch_id: int) -> None:
    """Keep the sketch of a day's (or batch's) distances; a replay replaces it."""
    changelog.append_batch(quantiles.sketch(scored, "score"), log_path, batch_id)


def threshold_from(spark: SparkSession, log_path: str, cfg: EngineConfig | None = None) -> float | None:
    """The distance threshold from the sketches kept so far, within ``quantiles.ALPHA`` of
    the exact quantile of all their rows; None before the first. No distance is read again."""
    cfg = cfg or EngineConfig()
    ids = changelog.complete_batches(spark, log_path)
    if not ids:
        return None
    kept = spark.read.parquet(*[changelog.batch_path(log_path, b) for b in ids])
    row = quantiles.quantile(kept, cfg.threshold_quantile).first()
    return None if row is None else float(row["value"])


def checkpoint_frame(frame: DataFrame) -> DataFrame:
    """Materialise the training frame in the shared checkpoint folder."""
    ensure_checkpoint_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)


def save(spark: SparkSession, model: PipelineModel, threshold: float, model_path: str,
         threshold_path: str) -> None:
    model.write().overwrite().save(model_path)
    spark.createDataFrame([(float(threshold),)], "threshold double") \
        .write.mode("overwrite").parquet(threshold_path)


def train_from_tables(spark: SparkSession, sf_dir: str, cfg: EngineConfig | None = None
                      ) -> tuple[PipelineModel, float, str, str, DataFrame]:
    """Fit on the tables' (1-day window, user, action) counts and save; also
    returns the checkpointed training frame."""
    cfg = cfg or CFG
    frame = checkpoint_frame(training_frame(events_from_tables(spark, sf_dir, cfg, with_geo=False)))
    model, threshold = fit(frame, cfg, checkpointed=True)
    root = shared_dir(spark, "models")
    model_path, threshold_path = f"{root}/anomaly_kmeans", f"{root}/anomaly_kmeans_threshold"
    save(spark, model, threshold, model_path, threshold_path)
    return model, threshold, model_path, threshold_path, frame


def kmeans_train_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train, save, reload the artefacts, and score the same grain: rows whose
    distance to their centre is strictly above the saved threshold."""
    from eventide.sources.artifacts import load_pipeline_model, load_threshold
    _, _, model_path, threshold_path, frame = train_from_tables(spark, sf_dir)
    model = load_pipeline_model(spark, model_path)
    threshold = load_threshold(spark, threshold_path)
    det = KMeansModelDetector(model, threshold, CFG.severity_high_factor)
    return det.anomalies(frame).select("window_start", "window_end", "user_id", "action",
                                       "event_count", "cluster",
                                       F.round("score", 6).alias("score"), "threshold",
                                       "severity")


def native_features(counts: DataFrame, categories: Sequence[str]) -> DataFrame:
    """``features`` as the pipeline's index, one-hot and assemble stages make them, from the
    sorted categories: the count, then an indicator for each; others are all zero."""
    feats = F.array(F.col("event_count").cast("double"), *one_hot(F.col("action"), categories, drop_last=False))
    return counts.withColumn("features", feats)


def feature_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training features of the (1-day window, user, action) counts, one column an entry."""
    frame = training_frame(events_from_tables(spark, sf_dir, CFG, with_geo=False))
    vectors = native_features(frame, CENTROID_CATEGORIES)
    return vectors.select("window_start", "user_id", "action",
                          *[F.col("features")[k].alias(f"f{k}") for k in range(len(CENTROID_CATEGORIES) + 1)])


#: Rounds of the repeatable clustering that the queries run.
LLOYD_ROUNDS = 6


def kmeans_repeatable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training counts beyond the 95th percentile of their distance to the nearest of the
    centres that fixed rounds of repeatable clustering give."""
    frame = training_frame(events_from_tables(spark, sf_dir, CFG, with_geo=False))
    vectors = native_features(frame, CENTROID_CATEGORIES)
    centers = lloyd.fit(vectors, CFG.kmeans_k, rounds=LLOYD_ROUNDS)
    near = lloyd.nearest(F.col("features"), centers)
    scored = vectors.withColumn("cluster", near).withColumn(
        "distance", F.round(distance_to_assigned(F.col("features"), matrix_literal(centers), F.col("cluster")), 6))
    limit = scored.select(F.percentile("distance", F.lit(CFG.threshold_quantile))).scalar()
    return scored.filter(F.col("distance") > limit).select("window_start", "window_end", "user_id", "action", "event_count",
                                                           "cluster", "distance")


def kmeans_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The centres of the repeatable clustering, a row for each, with the rows nearest to it."""
    frame = training_frame(events_from_tables(spark, sf_dir, CFG, with_geo=False))
    vectors = native_features(frame, CENTROID_CATEGORIES)
    centers = lloyd.fit(vectors, CFG.kmeans_k, rounds=LLOYD_ROUNDS)
    sizes = vectors.groupBy(lloyd.nearest(F.col("features"), centers).alias("cluster")).agg(F.count(F.lit(1)).alias("n_rows"))
    entries = [F.round(F.element_at(matrix_literal(centers)[F.col("cluster")], k + 1), 6).alias(f"c{k}")
               for k in range(len(CENTROID_CATEGORIES) + 1)]
    return sizes.select("cluster", "n_rows", *entries)


def registered() -> dict:
    return {"kmeans_train_score": kmeans_train_score, "feature_vectors": feature_vectors,
            "kmeans_centers": kmeans_centers, "kmeans_repeatable": kmeans_repeatable}


def oracles() -> dict[str, str]:
    """Lloyd's rounds unrolled: each round assigns the distinct vectors and averages them."""
    from eventide.plans import oracle as O
    day, dims = 86400, len(CENTROID_CATEGORIES) + 1
    feats = ", ".join(["CAST(event_count AS DOUBLE)", *(f"CASE WHEN action = '{c}' THEN 1.0 ELSE 0.0 END" for c in CENTROID_CATEGORIES)])
    counts = f"""WITH {O.EVENTS_CTE.strip()},
w AS (SELECT {O._bucket('event_time', day)} AS window_start,
             {O._bucket('event_time', day)} + to_microseconds({day * 1_000_000}) AS window_end, user_id, action, count(*) AS event_count
      FROM ev WHERE event_time IS NOT NULL GROUP BY ALL),
f AS MATERIALIZED (SELECT *, CAST([{feats}] AS DOUBLE[]) AS x FROM w),
v AS MATERIALIZED (SELECT x, count(*) AS n FROM f GROUP BY x),
g AS (SELECT x, md5(array_to_string([CAST(CAST(round(e * {lloyd.UNIT}) AS BIGINT) AS VARCHAR) FOR e IN x], ',')) AS h FROM v),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS c, x AS ctr FROM g ORDER BY h LIMIT {CFG.kmeans_k})"""
    dist = "round(list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip({0}.x, ctr)]), %d)" % lloyd.TIE_DECIMALS
    steps = ""
    for r in range(LLOYD_ROUNDS):
        mean = ", ".join(f"sum(x[{d + 1}] * n) / sum(n)" for d in range(dims))
        steps += f""",
a{r} AS MATERIALIZED (SELECT x, n, arg_min(c, ({dist.format('v')}, c)) AS c FROM v CROSS JOIN c{r} GROUP BY x, n),
m{r} AS (SELECT c, [{mean}] AS ctr FROM a{r} GROUP BY c),
c{r + 1} AS MATERIALIZED (SELECT o.c, coalesce(m{r}.ctr, o.ctr) AS ctr FROM c{r} o LEFT JOIN m{r} ON o.c = m{r}.c)"""
    last = f"c{LLOYD_ROUNDS}"
    placed = f""",
p AS MATERIALIZED (SELECT x, arg_min(c, ({dist.format('v')}, c)) AS c FROM v CROSS JOIN {last} GROUP BY x),
s AS (SELECT f.*, CAST(p.c AS INTEGER) AS cluster,
             round(sqrt(list_sum([(q[1] - q[2]) * (q[1] - q[2]) FOR q IN list_zip(f.x, k.ctr)])), 6) AS distance
      FROM f JOIN p ON f.x = p.x JOIN {last} k ON k.c = p.c)"""
    entries = ", ".join(f"x[{k + 1}] AS f{k}" for k in range(dims))
    rounded = ", ".join(f"round(any_value(k.ctr[{d + 1}]), 6) AS c{d}" for d in range(dims))
    return {
        "feature_vectors": f"{counts}\nSELECT window_start, user_id, action, {entries} FROM f",
        "kmeans_centers": f"{counts}{steps}{placed}\nSELECT s.cluster, count(*) AS n_rows, {rounded} FROM s JOIN {last} k ON k.c = s.cluster GROUP BY s.cluster",
        "kmeans_repeatable": f"{counts}{steps}{placed}\nSELECT window_start, window_end, user_id, action, event_count, cluster, distance FROM s "
                             f"WHERE distance > (SELECT quantile_cont(distance, {CFG.threshold_quantile}) FROM s)",
    }
