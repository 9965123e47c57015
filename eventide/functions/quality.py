"""Data-quality rules compiled to one native expression.

Each rule yields a reason code; ``dq_reason`` is the comma-joined list in rule
order (no spaces), NULL when the row is valid. The split is total: every input
row is either valid (reason NULL) or invalid (reason set), so
``valid + invalid = input`` holds even with NULL columns. A NULL or empty
location is valid: it has no reason code.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, functions as F

from eventide.config import EngineConfig

def as_of_column(as_of=None) -> Column:
    """The validation clock: ``current_timestamp()`` (fixed per query/batch) or
    an injected instant for deterministic runs."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(as_of)).cast("timestamp")


def failure_conditions(cfg: EngineConfig | None = None, as_of=None) -> list[tuple[str, Column]]:
    """(reason, fails) pairs; each ``fails`` is TRUE or FALSE, never NULL."""
    cfg = cfg or EngineConfig()
    uid, pid, action = F.col("user_id"), F.col("product_id"), F.col("action")
    et, loc = F.col("event_time"), F.col("location")
    if cfg.valid_actions:
        action_bad = ~F.coalesce(action.isin(*cfg.valid_actions), F.lit(False))
    else:
        action_bad = action.isNull()
    return [
        ("invalid_user_id", uid.isNull() | (uid <= 0)),
        ("invalid_product_id", pid.isNull() | (pid <= 0)),
        ("invalid_action", action_bad),
        ("invalid_event_time", et.isNull() | (et > as_of_column(as_of))),
        ("location_too_long", loc.isNotNull() & (F.length(loc) > cfg.max_location_len)),
    ]


def dq_reason(cfg: EngineConfig | None = None, as_of=None) -> Column:
    parts = [F.when(bad, F.lit(reason)) for reason, bad in failure_conditions(cfg, as_of)]
    return F.nullif(F.concat_ws(",", *parts), F.lit(""))


def with_dq_reason(df: DataFrame, cfg: EngineConfig | None = None, as_of=None) -> DataFrame:
    return df.withColumn("dq_reason", dq_reason(cfg, as_of))


def split_valid_invalid(df: DataFrame, cfg: EngineConfig | None = None, as_of=None
                        ) -> tuple[DataFrame, DataFrame]:
    """(valid without ``dq_reason``, invalid with ``dq_reason``).

    Both sides read the same reason column; persist ``df`` first when both are
    consumed, so the input is scanned once.
    """
    tagged = with_dq_reason(df, cfg, as_of)
    valid = tagged.filter(F.col("dq_reason").isNull()).drop("dq_reason")
    invalid = tagged.filter(F.col("dq_reason").isNotNull())
    return valid, invalid


def dq_profile(tagged: DataFrame) -> DataFrame:
    """Invalid-row count per reason combination."""
    return (tagged.filter(F.col("dq_reason").isNotNull())
            .groupBy("dq_reason").agg(F.count(F.lit(1)).alias("n_rows")))
