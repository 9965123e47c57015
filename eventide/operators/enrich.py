"""Enrichment of window counts with the users dimension (left outer)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


ENRICHED_COLS = ["window_start", "window_end", "user_id", "event_count", "user_name", "region"]


def enrich(summary: DataFrame, users: DataFrame) -> DataFrame:
    """Left join on ``user_id``; users missing from the dimension keep NULL
    name/region. How the sides meet is Spark's choice, by their sizes in bytes."""
    dim = users.select("user_id", F.col("name").alias("user_name"), "region")
    extra = [c for c in summary.columns if c not in ENRICHED_COLS]
    return summary.join(dim, "user_id", "left").select(*ENRICHED_COLS, *extra)
