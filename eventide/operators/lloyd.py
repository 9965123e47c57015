"""Repeatable clustering: the same centres under any partitioning.

Features are held as whole numbers of 1/``UNIT``, so the sums of a round are exact
in whatever order Spark adds them. Equal feature vectors are counted once and
weighted: a round moves one row per distinct vector at most, and one per cluster
and dimension after partial aggregation. Starting centres are the ``k`` distinct
vectors of the smallest digests, which no order of rows can change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventide.functions.vectors import matrix_literal
from eventide.session import ensure_checkpoint_dir

#: Parts of one in which features are held.
UNIT = 1_000_000
#: Decimals to which squared distances are compared, so that ties are ties.
TIE_DECIMALS = 6


def nearest(features: Column, centers: list[list[float]]) -> Column:
    """Index of the nearest centre; of equally near ones the first."""
    def squared(c):
        return F.round(F.aggregate(F.zip_with(features, c, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda a, v: a + v), TIE_DECIMALS)

    dists = F.transform(matrix_literal(centers), squared)
    return (F.array_position(dists, F.array_min(dists)) - 1).cast("int")


def weighted_vectors(df: DataFrame, features: str = "features") -> DataFrame:
    """``(features, n)``: the distinct vectors on the grid, and how many rows have each."""
    grid = F.transform(features, lambda v: F.round(v.cast("double") * UNIT).cast("long"))
    return (df.filter(F.col(features).isNotNull()).groupBy(grid.alias("grid")).agg(F.count(F.lit(1)).alias("n"))
            .select(F.transform("grid", lambda v: v / F.lit(float(UNIT))).alias("features"), "grid", "n"))


def seeds(vectors: DataFrame, k: int) -> list[list[float]]:
    """The ``k`` distinct vectors whose digests are smallest."""
    digest = F.md5(F.array_join(F.transform("grid", lambda v: v.cast("string")), ",").cast("binary"))
    return [list(r.features) for r in vectors.orderBy(digest, "grid").limit(k).collect()]


def fit(df: DataFrame, k: int, rounds: int = 20, features: str = "features") -> list[list[float]]:
    """Centres after Lloyd's rounds, or as many as it takes until they stand still. A cluster
    that loses all rows keeps its centre. The driver sees k rows a round."""
    ensure_checkpoint_dir(df.sparkSession)
    vectors = weighted_vectors(df, features).checkpoint()
    centers = seeds(vectors, k)
    for _ in range(rounds if centers else 0):
        placed = vectors.select(nearest(F.col("features"), centers).alias("c"), "n", F.posexplode("grid").alias("d", "v"))
        sums = (placed.groupBy("c", "d").agg(F.sum((F.col("v") * F.col("n")).cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
                .collect())
        moved = [list(c) for c in centers]
        for r in sums:
            moved[r.c][r.d] = int(r.s) / r.n / UNIT
        if moved == centers:
            break
        centers = moved
    return centers
