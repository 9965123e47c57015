"""Engine configuration: one frozen dataclass instead of import-time env reads."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field, replace

# --- Fixed values that must match the reference for identical results -------
# Allowed actions, location length limit, window sizes and slide, watermarks,
# z-score threshold, fixed count threshold, trigger, per-trigger offset cap,
# sink chunk sizes, topic names and the KMeans parameters.
DEFAULT_VALID_ACTIONS = ("click", "view", "purchase", "add_to_cart")
DEFAULT_MAX_LOCATION_LEN = 200
DEFAULT_WINDOW_SHORT = "5 seconds"
DEFAULT_WINDOW_LONG = "1 minute"
DEFAULT_WINDOW_SLIDE = "5 seconds"
DEFAULT_WATERMARK_SHORT = "30 seconds"
DEFAULT_WATERMARK_LONG = "2 minutes"
DEFAULT_Z_THRESHOLD = 2.0
DEFAULT_COUNT_THRESHOLD = 5
DEFAULT_TRIGGER = "1 seconds"
DEFAULT_COPY_CHUNK = 5000
DEFAULT_EVENTS_TOPIC = "user_events"
DEFAULT_ALERT_TOPIC = "anomaly_alerts"
DEFAULT_DLQ_TOPIC = "dead_letter_topic"
DEFAULT_KMEANS_K = 5
DEFAULT_KMEANS_SEED = 42
DEFAULT_THRESHOLD_QUANTILE = 0.95
# Bulk-load text: NULL token and timestamp layout.
COPY_NULL_TOKEN = "\\N"
COPY_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Alert timestamps: ISO-8601 to the second.
ALERT_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
# Severities that are delivered as notifications; the rest are only archived.
NOTIFY_SEVERITIES = ("high", "medium")
# Detector type and reason literals of the anomaly table and alerts.
DETECTOR_ZSCORE, DETECTOR_KMEANS = "zscore", "kmeans"
REASON_DISTANCE, REASON_MODEL = "distance_threshold", "model_detected"
# Notification text (placeholders: user id, name, region, count, window start,
# window end, detector, score, severity); missing name/region read "Unknown".
ALERT_MESSAGE_FORMAT = ("⚠️ Anomaly detected:\nUser: %d (%s)\nRegion: %s\nCount: %d\n"
                        "Window: %s - %s\nScore (%s): %.4f\nSeverity: %s")
UNKNOWN = "Unknown"
# -----------------------------------------------------------------------------

_UNIT_SECONDS = {
    "microsecond": 1e-6, "millisecond": 1e-3, "second": 1, "minute": 60,
    "hour": 3600, "day": 86400, "week": 604800,
}


def interval_seconds(text: str) -> float:
    """Seconds in a Spark interval string such as ``"5 seconds"`` or ``"1 minute"``."""
    total = 0.0
    parts = re.findall(r"(\d+(?:\.\d+)?)\s*([a-zA-Z]+)", text)
    if not parts:
        raise ValueError(f"not an interval: {text!r}")
    for num, unit in parts:
        u = unit.lower().rstrip("s")
        if u not in _UNIT_SECONDS:
            raise ValueError(f"unknown interval unit {unit!r} in {text!r}")
        total += float(num) * _UNIT_SECONDS[u]
    return total


def check_window(duration: str, slide: str | None) -> None:
    """Fail early on a slide longer than the window (Spark raises at analysis)."""
    d = interval_seconds(duration)
    if d <= 0:
        raise ValueError(f"window duration must be positive: {duration!r}")
    if slide is not None:
        s = interval_seconds(slide)
        if s <= 0 or s > d:
            raise ValueError(f"slide {slide!r} must be in (0, {duration!r}]")


@dataclass(frozen=True)
class EngineConfig:
    valid_actions: tuple[str, ...] | None = DEFAULT_VALID_ACTIONS
    max_location_len: int = DEFAULT_MAX_LOCATION_LEN
    window_short: str = DEFAULT_WINDOW_SHORT
    window_long: str = DEFAULT_WINDOW_LONG
    window_slide: str = DEFAULT_WINDOW_SLIDE
    watermark_short: str = DEFAULT_WATERMARK_SHORT
    watermark_long: str = DEFAULT_WATERMARK_LONG
    z_threshold: float = DEFAULT_Z_THRESHOLD
    count_threshold: int = DEFAULT_COUNT_THRESHOLD
    trigger: str = DEFAULT_TRIGGER
    # None: no cap. A cap also bounds what one batch's z-score looks at.
    max_offsets_per_trigger: int | None = None
    copy_chunk: int = DEFAULT_COPY_CHUNK
    events_topic: str = DEFAULT_EVENTS_TOPIC
    alert_topic: str = DEFAULT_ALERT_TOPIC
    dlq_topic: str = DEFAULT_DLQ_TOPIC
    kmeans_k: int = DEFAULT_KMEANS_K
    kmeans_seed: int = DEFAULT_KMEANS_SEED
    threshold_quantile: float = DEFAULT_THRESHOLD_QUANTILE
    # percentile_approx accuracy (Spark's default); relative error is 1/accuracy
    threshold_accuracy: int = 10000
    # Ours: the reference has no severity tiers; an anomaly is "high" when its
    # score reaches this multiple of the threshold, else "medium".
    severity_high_factor: float = 1.5
    # Windows count the parsed stream ("parsed", as the reference) or only rows
    # that passed validation ("valid").
    count_input: str = "parsed"
    # Sink-side length limits of the raw table (checked per row, not per chunk).
    sink_max_lengths: dict = field(default_factory=lambda: {
        "action": 50, "device_id": 50, "device_type": 50, "location": 100,
        "user_segment": 50, "ip_address": 50,
    })

    def __post_init__(self):
        check_window(self.window_short, self.window_slide)
        check_window(self.window_long, self.window_slide)
        if self.count_input not in ("parsed", "valid"):
            raise ValueError("count_input must be 'parsed' or 'valid'")

    def with_(self, **kw) -> "EngineConfig":
        return replace(self, **kw)

    @classmethod
    def from_env(cls, env=None) -> "EngineConfig":
        """Build from environment variables; an empty action list means "no list"."""
        env = os.environ if env is None else env
        kw = {}
        if "VALID_ACTIONS" in env:
            acts = tuple(a.strip() for a in env["VALID_ACTIONS"].split(",") if a.strip())
            kw["valid_actions"] = acts or None
        for name, key, conv in (
            ("max_location_len", "MAX_LOCATION_LEN", int),
            ("window_slide", "WINDOW_SLIDE", str),
            ("z_threshold", "Z_THRESHOLD", float),
            ("count_threshold", "ANOMALY_THRESHOLD", int),
            ("trigger", "PROCESSING_TRIGGER", str),
            ("copy_chunk", "COPY_CHUNK", int),
            ("max_offsets_per_trigger", "MAX_OFFSETS_PER_TRIGGER", int),
            ("count_input", "COUNT_INPUT", str),
            ("events_topic", "KAFKA_TOPIC", str),
            ("alert_topic", "KAFKA_ALERT_TOPIC", str),
            ("dlq_topic", "KAFKA_DLQ_TOPIC", str),
        ):
            if key in env:
                kw[name] = conv(env[key])
        return cls(**kw)
