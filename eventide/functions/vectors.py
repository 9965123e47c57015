"""Vector arithmetic as native array expressions (no Python UDF)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def array_literal(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def matrix_literal(rows: Sequence[Sequence[float]]) -> Column:
    return F.array(*[array_literal(r) for r in rows])


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)),
                       F.lit(0.0), lambda acc, v: acc + v)


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(squared_distance(a, b))


def nearest_center(features: Column, centers: Column) -> Column:
    """``struct(cluster int, distance double)`` of the closest centre (first on ties)."""
    dists = F.transform(centers, lambda c: euclidean(features, c))
    best = F.array_min(dists)
    return F.struct((F.array_position(dists, best) - 1).cast("int").alias("cluster"),
                    best.alias("distance"))


def distance_to_assigned(features: Column, centers: Column, cluster: Column) -> Column:
    """Distance to the centre with index ``cluster`` (0-based)."""
    return euclidean(features, F.element_at(centers, cluster + 1))


def one_hot(value: Column, categories: Sequence[str], drop_last: bool = True) -> list[Column]:
    """Indicator columns for ``categories`` in order; an unknown value is all
    zeros. ``drop_last`` omits the last category, as ``OneHotEncoder`` does."""
    cats = list(categories)[:-1] if drop_last else list(categories)
    return [F.when(value == F.lit(c), F.lit(1.0)).otherwise(F.lit(0.0)) for c in cats]
