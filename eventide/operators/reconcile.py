"""Late rows recounted: the archive, which holds every parsed event, against the
streamed summary, which drops what comes behind its watermark.

Totals per window are compared first, over all users, so finding the windows that
miss rows moves one row per window. Only those windows are counted again from
the archive, and only counts that differ are written, to a log of corrections.
Counts of a window only grow, so the greater one is the right one, in
whatever order stream and corrections are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventide.operators import windows
from eventide.operators.changelog import append_batch, complete_batches
from eventide.schemas import SUMMARY_KEY

WINDOW = ["window_start", "window_end"]


def _totals(events: DataFrame, duration: str, slide: str | None) -> DataFrame:
    return windows.to_wall_clock(windows.flatten_window(
        windows.window_counts(events, duration, slide, keys=(), buckets=True, count_col="archived")))


def touched_windows(archive: DataFrame, summary: DataFrame, duration: str, slide: str | None = None,
                    closed_before=None) -> DataFrame:
    """``(window_start, window_end)`` of the windows whose archive holds more events than
    the summary counts. ``closed_before``: only windows that end by then (the stream
    still counts the others)."""
    streamed = windows.to_wall_clock(summary).groupBy(*WINDOW).agg(F.sum("event_count").alias("streamed"))
    both = _totals(archive, duration, slide).join(streamed, WINDOW, "left")
    if closed_before is not None:
        both = both.filter(F.col("window_end") <= F.lit(closed_before).cast("timestamp_ntz"))
    return both.filter(F.col("archived") > F.coalesce("streamed", F.lit(0))).select(*WINDOW)


def recount(archive: DataFrame, touched: DataFrame, duration: str, slide: str | None = None) -> DataFrame:
    """Counts per user of the touched windows, from the archive's events of their span."""
    span = touched.agg(F.min("window_start"), F.max("window_end")).first()
    none = F.lit(False)
    inside = none if span[0] is None else (F.col("event_time") >= F.lit(span[0])) & (F.col("event_time") < F.lit(span[1]))
    if span[0] is not None and "event_date" in archive.columns:  # whole folders are skipped
        inside = inside & F.col("event_date").between(F.lit(span[0].date()), F.lit(span[1].date()))
    # the windows are few beside the events: joined before the users are counted
    placed = archive.filter(inside).select("user_id", F.window("event_time", duration, slide or duration).alias("window"))
    placed = windows.to_wall_clock(windows.flatten_window(placed))
    return placed.join(touched, WINDOW, "left_semi").groupBy(*SUMMARY_KEY).agg(F.count(F.lit(1)).alias("event_count"))


def corrections(archive: DataFrame, summary: DataFrame, duration: str, slide: str | None = None, closed_before=None) -> DataFrame:
    """The counts that the summary lacks or has too low."""
    touched = touched_windows(archive, summary, duration, slide, closed_before)
    again = recount(archive, touched, duration, slide)
    old = windows.to_wall_clock(summary).select(*SUMMARY_KEY, F.col("event_count").alias("_old"))
    keys = [again[c].eqNullSafe(old[c]) if c == "user_id" else again[c] == old[c] for c in SUMMARY_KEY]
    return (again.join(old, keys, "left").filter(F.coalesce("_old", F.lit(0)) < F.col("event_count"))
            .select(*[again[c] for c in SUMMARY_KEY], "event_count"))


def reconcile(spark: SparkSession, archive: DataFrame, summary: DataFrame, log_path: str, duration: str,
              slide: str | None = None, closed_before=None) -> int:
    """Write the corrections as the next batch of their log; its id."""
    batch_id = max(complete_batches(spark, log_path), default=-1) + 1
    append_batch(corrections(archive, summary, duration, slide, closed_before), log_path, batch_id)
    return batch_id


def settled(summary: DataFrame, corrected: DataFrame | None) -> DataFrame:
    """The summary with its corrections: the greatest count of each user and window."""
    rows = windows.to_wall_clock(summary).select(*SUMMARY_KEY, "event_count")
    if corrected is not None:
        rows = rows.unionByName(corrected.select(*SUMMARY_KEY, "event_count"))
    return rows.groupBy(*SUMMARY_KEY).agg(F.max("event_count").alias("event_count"))
