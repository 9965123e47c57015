"""Mergeable moments ``(n, mean, m2)`` of a column: count, mean and sum of squared
distances from the mean, the sufficient statistics of a z-score.

Parts merge without the rows: ``m2 = sum(m2_i + n_i (mean_i - mean)^2)``, which
subtracts means only and stays exact where sums of squares would cancel.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

SCHEMA = "n long, mean double, m2 double"


@dataclass(frozen=True)
class Moments:
    n: int = 0
    mean: float = 0.0
    m2: float = 0.0

    @classmethod
    def of(cls, n: int, mean: float | None, std: float | None) -> Moments:
        """From a count, mean and sample standard deviation (null below two rows)."""
        return cls(n, mean or 0.0, (std or 0.0) ** 2 * max(n - 1, 0)) if n else cls()

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not n:
            return Moments()
        gap = other.mean - self.mean
        return Moments(n, self.mean + gap * other.n / n, self.m2 + other.m2 + gap * gap * self.n * other.n / n)

    @property
    def stats(self) -> tuple[float | None, float | None]:
        """Mean and sample standard deviation; None where they are undefined."""
        return (self.mean if self.n else None, math.sqrt(self.m2 / (self.n - 1)) if self.n > 1 else None)


def moments(df: DataFrame, value_col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """``(*groups, n, mean, m2)`` of the non-null values, one partial aggregate."""
    v = F.col(value_col).cast("double")
    n = F.count(v)
    return df.groupBy(*group_cols).agg(n.alias("n"), F.coalesce(F.avg(v), F.lit(0.0)).alias("mean"),
                                       F.coalesce(F.var_pop(v) * n, F.lit(0.0)).alias("m2"))


def merge(parts: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Moments of the union of the rows behind ``parts`` (``n, mean, m2`` and groups)."""
    keys = [F.col(c).alias(f"_g{i}") for i, c in enumerate(group_cols)] or [F.lit(0).alias("_g0")]
    mine = parts.select(*keys, "n", "mean", "m2")
    names = [f"_g{i}" for i in range(len(keys))]
    whole = mine.groupBy(*names).agg(F.sum("n").alias("_n"), F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("_mean"))
    whole = whole.select(*[F.col(c).alias(f"{c}w") for c in names], "_n", "_mean")
    both = mine.join(whole, [F.col(c).eqNullSafe(F.col(f"{c}w")) for c in names], "inner")
    gap = F.col("mean") - F.col("_mean")
    out = both.groupBy(*names).agg(F.first("_n").alias("n"), F.first("_mean").alias("mean"),
                                   F.sum(F.col("m2") + F.col("n") * gap * gap).alias("m2"))
    return out.select(*[F.col(f"_g{i}").alias(c) for i, c in enumerate(group_cols)], "n",
                      F.coalesce("mean", F.lit(0.0)).alias("mean"), F.coalesce("m2", F.lit(0.0)).alias("m2"))
