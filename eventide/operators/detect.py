"""Interchangeable anomaly detectors over window counts.

Every detector adds the same columns, so their outputs union by name:
``score`` (double), ``threshold`` (double), ``is_anomaly`` (boolean, never
NULL), ``detector_type``, ``reason`` and ``severity`` (``high`` when the score
reaches ``severity_high_factor`` × threshold, else ``medium``; NULL when not
anomalous).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from eventide.config import (DETECTOR_KMEANS, DETECTOR_ZSCORE, REASON_DISTANCE, REASON_MODEL,
                             EngineConfig)
from eventide.functions.vectors import distance_to_assigned, matrix_literal, nearest_center

SCORE_COLS = ["score", "threshold", "is_anomaly", "detector_type", "reason", "severity"]


def _finish(df: DataFrame, score: Column, threshold: Column, flag: Column, detector: str,
            reason: str, high_factor: float) -> DataFrame:
    flag = F.coalesce(flag, F.lit(False))
    tier = F.when(flag & (F.col("score") >= F.col("threshold") * F.lit(high_factor)), F.lit("high")) \
        .when(flag, F.lit("medium"))
    return (df.withColumn("score", score.cast("double"))
            .withColumn("threshold", threshold.cast("double"))
            .withColumn("is_anomaly", flag)
            .withColumn("detector_type", F.lit(detector))
            .withColumn("reason", F.lit(reason))
            .withColumn("severity", tier))


class Detector:
    name = "detector"

    def score(self, df: DataFrame, eager: bool = False, stats: dict | None = None
              ) -> DataFrame:  # pragma: no cover
        raise NotImplementedError

    def anomalies(self, df: DataFrame, eager: bool = False, stats: dict | None = None
                  ) -> DataFrame:
        """Rows flagged by the detector. ``stats`` maps a value column to an
        already known ``(mean, stddev)`` of ``df`` (e.g. observed while the
        batch was written), which detectors that need them may use."""
        return self.score(df, eager, stats).filter(F.col("is_anomaly"))


class ZScoreDetector(Detector):
    """``(value - mean) / stddev_samp > threshold`` (upper tail).

    Without ``group_cols`` the statistics cover the whole input and enter the
    plan as one scalar subquery (no join, no cross product); with ``eager``
    they are computed first as one two-value row, which is what a
    ``foreachBatch`` handler wants: there a subquery would not reuse the
    persisted micro-batch and would re-run the stateful aggregation. With ``group_cols``
    they are aggregated per group (map-side partial aggregation) and joined
    back on the group key. A zero stddev gives NULL score, never an error.
    """

    name = "zscore"

    def __init__(self, threshold: float = 2.0, value_col: str = "event_count",
                 group_cols: Sequence[str] = (), high_factor: float = 1.5):
        self.threshold, self.value_col = float(threshold), value_col
        self.group_cols, self.high_factor = list(group_cols), high_factor

    def score(self, df: DataFrame, eager: bool = False, stats: dict | None = None) -> DataFrame:
        v = F.col(self.value_col).cast("double")
        known = (stats or {}).get(self.value_col)
        if not self.group_cols:
            agg = df.select(F.struct(F.avg(v).alias("m"), F.stddev_samp(v).alias("s")))
            if known is not None:
                mean, std = F.lit(known[0]).cast("double"), F.lit(known[1]).cast("double")
            elif eager:
                row = agg.first()[0]
                mean, std = F.lit(row["m"]).cast("double"), F.lit(row["s"]).cast("double")
            else:
                sub = agg.scalar()
                mean, std = sub.getField("m"), sub.getField("s")
            scored = df.withColumn("_mean", mean).withColumn("_std", std)
        else:
            # Every group (NULL included) has a stats row, so an inner join on
            # null-safe equality keeps exactly the rows of a left join, and it
            # infers no one-sided IS NOT NULL filter: both branches then share
            # one count shuffle (exchange reuse) instead of computing it twice.
            keyed = {c: f"_g_{c}" for c in self.group_cols}
            stats = df.groupBy(*[F.col(c).alias(k) for c, k in keyed.items()]) \
                .agg(F.avg(v).alias("_mean"), F.stddev_samp(v).alias("_std"))
            cond = [F.col(c).eqNullSafe(F.col(k)) for c, k in keyed.items()]
            scored = df.join(stats, cond, "inner").drop(*keyed.values())
        z = (v - F.col("_mean")) / F.nullif(F.col("_std"), F.lit(0.0))
        out = _finish(scored, z, F.lit(self.threshold), F.col("score") > F.col("threshold"),
                      DETECTOR_ZSCORE, "zscore_threshold", self.high_factor)
        return out.drop("_mean", "_std")


class FixedCountDetector(Detector):
    """``value > threshold``."""

    name = "fixed_count"

    def __init__(self, threshold: int = 5, value_col: str = "event_count", high_factor: float = 1.5):
        self.threshold, self.value_col, self.high_factor = threshold, value_col, high_factor

    def score(self, df: DataFrame, eager: bool = False, stats: dict | None = None
              ) -> DataFrame:
        return _finish(df, F.col(self.value_col), F.lit(self.threshold),
                       F.col("score") > F.col("threshold"), "fixed_count", "count_threshold",
                       self.high_factor)


class CentroidDistanceDetector(Detector):
    """Euclidean distance to the nearest (or assigned) centre, flagged when
    strictly greater than ``threshold``. ``features`` is an array<double> column."""

    name = "kmeans"

    def __init__(self, centers: Sequence[Sequence[float]], threshold: float,
                 features: str = "features", cluster_col: str | None = None,
                 high_factor: float = 1.5):
        self.centers = [list(map(float, c)) for c in centers]
        self.threshold, self.features = float(threshold), features
        self.cluster_col, self.high_factor = cluster_col, high_factor

    def score(self, df: DataFrame, eager: bool = False, stats: dict | None = None
              ) -> DataFrame:
        centers = matrix_literal(self.centers)
        feats = F.col(self.features)
        if self.cluster_col:
            dist = distance_to_assigned(feats, centers, F.col(self.cluster_col))
            out = df
        else:
            out = df.withColumn("_near", nearest_center(feats, centers)) \
                    .withColumn("cluster", F.col("_near.cluster"))
            dist = F.col("_near.distance")
        out = _finish(out, dist, F.lit(self.threshold), F.col("score") > F.col("threshold"),
                      DETECTOR_KMEANS, REASON_DISTANCE, self.high_factor)
        return out.drop("_near")


class KMeansModelDetector(Detector):
    """A fitted pipeline ending in KMeans: transform, then distance to the
    assigned centre against the saved threshold."""

    name = "kmeans"

    @property
    def input_columns(self) -> set[str]:
        """Columns the model's stages read (e.g. ``action`` for the indexer)."""
        cols: set[str] = set()
        for st in self.model.stages:
            for getter in ("getInputCol", "getInputCols"):
                if hasattr(st, getter):
                    try:
                        v = getattr(st, getter)()
                    except Exception:  # noqa: BLE001
                        continue
                    cols.update([v] if isinstance(v, str) else v)
        return cols

    def __init__(self, model, threshold: float, high_factor: float = 1.5,
                 features_col: str = "features", cluster_col: str = "cluster"):
        self.model, self.threshold, self.high_factor = model, float(threshold), high_factor
        self.features_col, self.cluster_col = features_col, cluster_col

    def score(self, df: DataFrame, eager: bool = False, stats: dict | None = None
              ) -> DataFrame:
        from pyspark.ml.functions import vector_to_array
        centers = [list(map(float, c)) for c in self.model.stages[-1].clusterCenters()]
        pred = self.model.transform(df).withColumn("_f", vector_to_array(F.col(self.features_col)))
        inner = CentroidDistanceDetector(centers, self.threshold, "_f", self.cluster_col,
                                         self.high_factor)
        drop = [c for c in pred.columns if c not in df.columns and c != self.cluster_col]
        return inner.score(pred).drop(*drop)


class PredictionDetector(Detector):
    """Adapter for any transformer that emits ``prediction``: ``-1`` means
    anomaly (the isolation-forest convention)."""

    name = "model"

    def __init__(self, model, prediction_col: str = "prediction", high_factor: float = 1.5):
        self.model, self.prediction_col, self.high_factor = model, prediction_col, high_factor

    def score(self, df: DataFrame, eager: bool = False, stats: dict | None = None
              ) -> DataFrame:
        out = self.model.transform(df)
        flag = F.col(self.prediction_col) == F.lit(-1)
        return _finish(out, F.when(flag, F.lit(1.0)).otherwise(F.lit(0.0)), F.lit(0.5), flag,
                       "model", REASON_MODEL, self.high_factor)


def detectors_from_config(cfg: EngineConfig, model=None, threshold: float | None = None,
                          kinds: Sequence[str] = ("zscore",)) -> list[Detector]:
    out: list[Detector] = []
    for k in kinds:
        if k == "zscore":
            out.append(ZScoreDetector(cfg.z_threshold, high_factor=cfg.severity_high_factor))
        elif k == "fixed_count":
            out.append(FixedCountDetector(cfg.count_threshold, high_factor=cfg.severity_high_factor))
        elif k == "kmeans":
            if model is not None and threshold is not None:
                out.append(KMeansModelDetector(model, threshold, cfg.severity_high_factor))
        else:
            raise ValueError(f"unknown detector {k!r}")
    return out


def detect(df: DataFrame, detectors: Sequence[Detector], eager: bool = False,
           stats: dict | None = None) -> DataFrame | None:
    """Anomalies of every detector, unioned by name; None when there is no detector."""
    parts = [d.anomalies(df, eager, stats) for d in detectors]
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
