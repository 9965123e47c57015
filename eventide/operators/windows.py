"""Event-time window counts (tumbling and sliding), batch or streaming.

Catalyst plans a tumbling window as a Project and a sliding one as an Expand
(duration/slide copies per row) feeding a partial aggregate, so only partial
counts cross the shuffle and a hot user is combined map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventide.config import check_window, interval_seconds


def window_counts(df: DataFrame, duration: str, slide: str | None = None,
                  time_col: str = "event_time", keys=("user_id",),
                  watermark: str | None = None, count_col: str = "event_count",
                  buckets: bool = False) -> DataFrame:
    """``(window struct<start,end>, *keys, event_count)`` per event-time window.

    With ``buckets`` a batch sliding count first counts each slide's bucket and
    then adds the bucket counts up per window, so not the events but their
    counts are copied duration/slide times: right where keys have many events
    per slide. Sparse keys (an event or so per slide) pay one more shuffle for
    nothing, so the caller says. A stream keeps the one stateful aggregation
    that update mode allows."""
    check_window(duration, slide)
    if slide is not None and interval_seconds(slide) == interval_seconds(duration):
        slide = None
    if watermark:
        df = df.withWatermark(time_col, watermark)
    if buckets and slide and not df.isStreaming and interval_seconds(duration) % interval_seconds(slide) == 0:
        return _from_buckets(df, duration, slide, time_col, keys, count_col)
    w = F.window(time_col, duration, slide) if slide else F.window(time_col, duration)
    return df.groupBy(w.alias("window"), *keys).agg(F.count(F.lit(1)).alias(count_col))


def _from_buckets(df: DataFrame, duration: str, slide: str, time_col: str, keys, count_col: str) -> DataFrame:
    """Sums of slide buckets; a bucket lies in the windows that start up to
    duration/slide - 1 slides before it."""
    step, copies = F.expr(f"INTERVAL '{interval_seconds(slide)}' SECOND"), int(interval_seconds(duration) // interval_seconds(slide))
    counts = (df.groupBy(F.window(time_col, slide).alias("_bucket"), *keys)
              .agg(F.count(F.lit(1)).alias(count_col)))
    start = F.explode(F.array(*[F.col("_bucket.start") - step * F.lit(k) for k in range(copies)]))
    return (counts.select(start.alias("_start"), *keys, count_col)
            .groupBy("_start", *keys).agg(F.sum(count_col).alias(count_col))
            .select(F.struct(F.col("_start").alias("start"), (F.col("_start") + step * F.lit(copies)).alias("end")).alias("window"),
                    *keys, count_col))


def pane_counts(df: DataFrame, duration: str, slide: str, watermark: str | None = None,
                time_col: str = "event_time", keys=("user_id",), count_col: str = "event_count") -> DataFrame:
    """Sliding counts from panes, for a stream in append mode: one aggregation counts
    each slide's pane, a second adds the panes that the watermark has closed into
    the windows that hold them (``window_time`` carries the event time on). The
    state has a row for each open pane and key, not one for each of the
    duration/slide windows of every event; every window is emitted once, when
    it is final. Equal to ``window_counts`` on the windows that have closed."""
    check_window(duration, slide)
    if watermark:
        df = df.withWatermark(time_col, watermark)
    panes = df.groupBy(F.window(time_col, slide).alias("window"), *keys).agg(F.count(F.lit(1)).alias(count_col))
    if interval_seconds(slide) == interval_seconds(duration):
        return panes
    return (panes.groupBy(F.window(F.window_time("window"), duration, slide).alias("window"), *keys)
            .agg(F.sum(count_col).alias(count_col)))


#: Windows that one state row of ``block_counts`` may count.
BLOCK_WINDOWS = 12


def block_counts(df: DataFrame, duration: str, slide: str, watermark: str | None = None,
                 time_col: str = "event_time", keys=("user_id",), count_col: str = "event_count") -> DataFrame:
    """Sliding counts for a stream in update mode, counted in blocks: a state row holds the
    counts of up to ``BLOCK_WINDOWS`` windows that start one slide after the other, so an
    event of a 1-minute window by 5 seconds meets two rows instead of twelve. Beside
    each count stands the time of the micro-batch that changed it last; a batch emits
    the windows that it changed, as ``window_counts`` does. A block is closed when its
    last window is, so a late event may still count in a window that the watermark has
    passed by less than a block. Tumbling windows, and those whose slide
    does not divide them, are left to ``window_counts``."""
    check_window(duration, slide)
    length, step = (round(interval_seconds(x) * 1_000_000) for x in (duration, slide))
    if step == length or length % step:
        return window_counts(df, duration, slide, time_col, keys, watermark, count_col)
    if watermark:
        df = df.withWatermark(time_col, watermark)
    places = range(min(length // step, BLOCK_WINDOWS))
    span, every = length + places[-1] * step, len(places) * step
    block = F.window(time_col, f"{span} microseconds", f"{every} microseconds")
    rows = df.withColumn("_now", F.current_timestamp()).select(block.alias("_block"), F.col(time_col).alias("_at"), "_now", *keys)
    off = F.unix_micros("_at") - F.unix_micros(F.col("_block.start"))
    inside = [(off >= k * step) & (off < k * step + length) for k in places]
    counts = rows.groupBy("_block", *keys).agg(
        *[F.sum(i.cast("long")).alias(f"_n{k}") for k, i in zip(places, inside)],
        *[F.max(F.when(i, F.unix_micros("_now"))).alias(f"_t{k}") for k, i in zip(places, inside)])
    # the counts of the windows that this batch changed, by their place in the block
    now = F.unix_micros(F.current_timestamp())
    changed = F.array(*[F.when(F.col(f"_t{k}") == now, F.col(f"_n{k}")) for k in places])
    start = F.unix_micros(F.col("_block.start")) + F.col("_k") * step
    window = F.struct(F.timestamp_micros(start).alias("start"), F.timestamp_micros(start + length).alias("end"))
    return (counts.select("_block", *keys, F.posexplode(changed).alias("_k", count_col)).filter(F.col(count_col).isNotNull())
            .select(window.alias("window"), *keys, count_col))


def flatten_window(df: DataFrame) -> DataFrame:
    """Replace the ``window`` struct by ``window_start`` / ``window_end``."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").alias("window_start"),
                     F.col("window.end").alias("window_end"), *rest)


def summary(df: DataFrame, duration: str, slide: str | None = None, **kw) -> DataFrame:
    """Flattened window counts ``(window_start, window_end, user_id, event_count)``."""
    return flatten_window(window_counts(df, duration, slide, **kw))


def action_counts(df: DataFrame) -> DataFrame:
    """Events per (user_id, action), the training aggregate."""
    return df.groupBy("user_id", "action").agg(F.count(F.lit(1)).alias("event_count"))


def to_event_timestamp(df: DataFrame, col: str = "event_time") -> DataFrame:
    """TIMESTAMP_NTZ → TIMESTAMP (session zone), as ``withWatermark`` requires."""
    if dict(df.dtypes).get(col) == "timestamp_ntz":
        return df.withColumn(col, F.col(col).cast("timestamp"))
    return df


def to_wall_clock(df: DataFrame, cols=("window_start", "window_end")) -> DataFrame:
    """TIMESTAMP → TIMESTAMP_NTZ, undoing :func:`to_event_timestamp` on output."""
    for c in cols:
        if dict(df.dtypes).get(c) == "timestamp":
            df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df
