"""A mergeable quantile sketch with a stated error, as plain rows.

A positive value falls into the bucket ``ceil(log(v) / log(g))`` with
``g = (1 + a) / (1 - a)``; every value of a bucket lies within the relative error
``a`` of ``2 g^bucket / (g + 1)``. A sketch is the count of each bucket, so sketches
of days or batches merge by adding counts, in any order and with the same result,
and a quantile is the bucket at which the running count reaches its rank. Zero has
a bucket of its own, negative values mirror the positive ones; nulls and NaN are
left out. The number of rows follows the logarithm of the values' range.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

#: Relative error of a quantile.
ALPHA = 0.005


def growth(alpha: float) -> float:
    return (1 + alpha) / (1 - alpha)


def sketch(df: DataFrame, value_col: str, group_cols: Sequence[str] = (), alpha: float = ALPHA) -> DataFrame:
    """``(*groups, sign, bucket, n)``: one partial aggregate over the values."""
    v = F.col(value_col).cast("double")
    sign = F.signum(v).cast("int")
    bucket = F.when(v == 0, F.lit(0)).otherwise(F.ceil(F.log(F.abs(v)) / F.lit(math.log(growth(alpha))))).cast("int")
    rows = df.filter(v.isNotNull() & ~F.isnan(v)).select(*group_cols, sign.alias("sign"), bucket.alias("bucket"))
    return rows.groupBy(*group_cols, "sign", "bucket").agg(F.count(F.lit(1)).alias("n"))


def merge(sketches: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    return sketches.groupBy(*group_cols, "sign", "bucket").agg(F.sum("n").alias("n"))


def quantile(sketches: DataFrame, q: float, group_cols: Sequence[str] = (), alpha: float = ALPHA) -> DataFrame:
    """``(*groups, n, value)``: within ``alpha`` of the value of rank ``ceil(q n)`` (the first at least)."""
    merged = merge(sketches, group_cols)
    # buckets in the order of their values; a group has as many rows as buckets
    place = F.col("sign") * F.col("bucket")
    w = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(0))
    upto = w.orderBy("sign", place).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rank = F.greatest(F.lit(1), F.ceil(F.lit(q) * F.sum("n").over(w)))
    g = growth(alpha)
    value = F.col("sign") * F.lit(2.0) * F.pow(F.lit(g), F.col("bucket")) / F.lit(g + 1)
    ranked = merged.select(*group_cols, F.sum("n").over(w).alias("_all"), rank.alias("_rank"), F.sum("n").over(upto).alias("_upto"),
                           F.col("n").alias("_own"), value.alias("value"))
    hit = (F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_own") < F.col("_rank"))
    return ranked.filter(hit).select(*group_cols, F.col("_all").alias("n"), "value")
