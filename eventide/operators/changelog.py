"""Keyed result tables as an append-only change log plus views.

Each micro-batch writes its rows to a folder of its own, ``batch_id=N``; a
replay of batch N overwrites that folder, also with no rows at all, so replays
are idempotent. The upsert table is the last-wins view (latest ``batch_id``
per key), the insert-ignore table the first-wins view (earliest). Both views
are one aggregate with map-side partial aggregation: a hot key is folded
before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventide.operators.manifest import ManifestLog
from eventide.schemas import RAW_KEY


def _pick(log: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str], fn) -> DataFrame:
    keys = list(key_cols)
    values = [c for c in log.columns if c not in keys]
    if len(order_cols) == 1 and len(values) == 2 and order_cols[0] in values:
        # one value beside the order: plain types, which hash aggregation can hold
        [order] = order_cols
        value = next(c for c in values if c != order)
        of_order = F.max if fn is F.max_by else F.min
        return log.groupBy(*keys).agg(
            *[(of_order(order) if c == order else fn(value, order)).alias(c) for c in values])
    order = F.struct(*[F.col(c) for c in order_cols])
    payload = F.struct(*[F.col(c) for c in values])
    return (log.groupBy(*keys).agg(fn(payload, order).alias("_row"))
            .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in values]))


def latest_by_key(log: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str] = ("batch_id",)
                  ) -> DataFrame:
    """Upsert semantics (``ON CONFLICT DO UPDATE``): the row of the greatest order."""
    return _pick(log, key_cols, order_cols, F.max_by)


def first_by_key(log: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str] = ("batch_id",)
                 ) -> DataFrame:
    """Insert-ignore semantics (``ON CONFLICT DO NOTHING``): the row of the least order."""
    return _pick(log, key_cols, order_cols, F.min_by)


def dedup_rows(df: DataFrame, key_cols: Sequence[str] = RAW_KEY,
               nullable_cols: Sequence[str] = ("device_id",), nulls_distinct: bool = True
               ) -> DataFrame:
    """One row per unique key.

    With ``nulls_distinct`` (SQL UNIQUE semantics) a row with NULL in any key
    column never conflicts and is always kept; Spark's own dedup would treat
    NULLs as equal, which is the ``nulls_distinct=False`` behaviour.
    """
    keys = list(key_cols)
    if not nulls_distinct:
        return df.dropDuplicates(keys)
    has_null = F.lit(False)
    for c in nullable_cols:
        has_null = has_null | F.col(c).isNull()
    for c in keys:
        if c not in nullable_cols:
            has_null = has_null | F.col(c).isNull()
    keyed = df.filter(~has_null).dropDuplicates(keys)
    return keyed.unionByName(df.filter(has_null))


def append_batch(df: DataFrame, path: str, batch_id: int, partition_cols: Sequence[str] = ()) -> None:
    """Write one micro-batch into the change log under ``batch_id=<id>``;
    writing the same batch again replaces it, whatever rows it has now."""
    df.write.mode("overwrite").partitionBy(*partition_cols).parquet(batch_path(path, batch_id))


def batch_path(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch_id={int(batch_id)}"


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def complete_batches(spark: SparkSession, path: str) -> list[int]:
    """Ids of the batch folders whose write has finished, from one listing."""
    log = ManifestLog(spark, path)
    done = log.glob(f"{path.rstrip('/')}/batch_id=*/_SUCCESS")
    return sorted(int(p.split("/")[-2].split("=", 1)[1]) for p in done)


def compact(spark: SparkSession, log_path: str, out_path: str, key_cols: Sequence[str],
            keep: str = "latest", base_path: str | None = None, after: int | None = None) -> int | None:
    """Fold the change log into its view and write it to a new location (never
    read-and-overwrite the same path); returns the last batch folded in.

    With ``base_path``, an earlier result that holds all batches up to ``after``,
    only the newer batches are read and folded onto it. The batches are listed
    once, before anything is read, so one that lands meanwhile is neither folded
    nor answered. ``KeyedTable`` keeps the exact ids instead of a last one."""
    ids = [b for b in complete_batches(spark, log_path) if after is None or b > after]
    parts = [spark.read.option("basePath", log_path).parquet(*[batch_path(log_path, b) for b in ids])] if ids else []
    if base_path is not None and after is not None:
        parts.append(spark.read.parquet(base_path))
    if not parts:
        return after
    log = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    view = latest_by_key(log, key_cols) if keep == "latest" else first_by_key(log, key_cols)
    view.write.mode("overwrite").parquet(out_path)
    return max(ids, default=after)
