"""Registry of named queries and their SQL oracles."""

from __future__ import annotations

from eventide.plans import batch as B, lasting as L, streamed as S, training as T
from eventide.plans.oracle import queries_sql


def registered_queries() -> dict:
    q = {
        "flagship_1d": B.flagship_1d,
        "dq_valid": B.dq_valid,
        "dq_invalid_reasons": B.dq_invalid_reasons,
        "dq_profile": B.dq_profile,
        "dq_reasons_strict": B.dq_reasons_strict,
        "decode_json_required": B.decode_json_required,
        "decode_mixed": B.decode_mixed,
        "avro_filter_rows": B.avro_filter_rows,
        "tumbling_5s": B.tumbling_5s,
        "sliding_1min_5s": B.sliding_1min_5s,
        "tumbling_1h": B.tumbling_1h,
        "sliding_1d_1h": B.sliding_1d_1h,
        "sliding_by_action_1h_5min": B.sliding_by_action_1h_5min,
        "user_action_counts": B.user_action_counts,
        "summary_enriched": B.summary_enriched,
        "summary_enriched_partial": B.summary_enriched_partial,
        "distance_p95": B.distance_p95,
        "anomaly_zscore_1d": B.anomaly_zscore_1d,
        "anomaly_zscore_1h": B.anomaly_zscore_1h,
        "anomaly_zscore_by_window_1h": B.anomaly_zscore_by_window_1h,
        "anomaly_fixed_count_1d": B.anomaly_fixed_count_1d,
        "anomaly_centroid_distance": B.anomaly_centroid_distance,
        "summary_upsert_latest": B.summary_upsert_latest,
        "anomaly_first_wins": B.anomaly_first_wins,
        "raw_dedup": B.raw_dedup,
        "raw_dedup_nulls_equal": B.raw_dedup_nulls_equal,
        "raw_dedup_devices": B.raw_dedup_devices,
        "text_export": B.text_export,
        "dlq_json": B.dlq_json_roundtrip,
        "alert_json": B.alert_json,
        "alert_message": B.alert_message,
    }
    q.update(S.registered())
    q.update(T.registered())
    q.update(L.registered())
    return q


def registered_oracles() -> dict:
    sql = queries_sql()
    sql.update(S.oracles(sql))
    sql.update(L.oracles())
    sql.update(T.oracles())
    return {k: v for k, v in sql.items() if k in registered_queries()}
