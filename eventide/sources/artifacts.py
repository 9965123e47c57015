"""Model artefacts: the fitted pipeline and its one-row threshold table."""

from __future__ import annotations

import logging

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)


def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def load_threshold(spark: SparkSession, path: str) -> float | None:
    """The saved threshold (first row), or None when nothing was saved."""
    if not _path_exists(spark, path):
        return None
    row = spark.read.parquet(path).select("threshold").first()
    return None if row is None else float(row["threshold"])


def load_pipeline_model(spark: SparkSession, path: str):
    """The fitted ``PipelineModel``; a missing path means "no model" (detection
    is skipped), any other failure is raised."""
    from pyspark.ml import PipelineModel
    if not _path_exists(spark, path):
        log.warning("no anomaly model at %s; detection by model is off", path)
        return None
    return PipelineModel.load(path)
