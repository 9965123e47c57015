"""Plain-SQL statements (DuckDB dialect) computing the same results as the
batch plans, over the driver tables registered as views."""

from __future__ import annotations

from eventide.config import ALERT_MESSAGE_FORMAT as MSG, NOTIFY_SEVERITIES, UNKNOWN
from eventide.plans import batch as B

VALID_ACTIONS_SQL = ", ".join(f"'{a}'" for a in B.CFG.valid_actions)
MAX_LOC = B.CFG.max_location_len
NOTIFY_SQL = ", ".join(f"'{v}'" for v in NOTIFY_SEVERITIES)
Z = B.CFG.z_threshold
HIGH = B.CFG.severity_high_factor
N_FIXED = B.CFG.count_threshold

EVENTS_CTE = """
ev AS (
  SELECT TRY_CAST(e.user_id AS INTEGER) AS user_id,
         TRY_CAST(CASE WHEN json_valid(e.props) THEN json_extract_string(e.props, '$.k') END AS INTEGER)
           AS product_id,
         e.event_type AS action,
         strftime(e.ts, '%Y-%m-%d %H:%M:%S.%f') AS "timestamp",
         CAST(NULL AS VARCHAR) AS device_id,
         CAST(NULL AS VARCHAR) AS device_type,
         n.n_name AS location,
         c.c_mktsegment AS user_segment,
         CAST(NULL AS VARCHAR) AS ip_address,
         e.ts AS event_time
  FROM events e
  LEFT JOIN customer c ON c.c_custkey = e.user_id
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
)"""

REASON_SQL = f"""NULLIF(concat_ws(',',
    CASE WHEN user_id IS NULL OR user_id <= 0 THEN 'invalid_user_id' END,
    CASE WHEN product_id IS NULL OR product_id <= 0 THEN 'invalid_product_id' END,
    CASE WHEN action IS NULL OR action NOT IN ({VALID_ACTIONS_SQL}) THEN 'invalid_action' END,
    CASE WHEN event_time IS NULL OR event_time > CAST(current_timestamp AS TIMESTAMP)
         THEN 'invalid_event_time' END,
    CASE WHEN location IS NOT NULL AND length(location) > {MAX_LOC} THEN 'location_too_long' END
  ), '')"""

TAGGED_CTE = EVENTS_CTE + f""",
tagged AS (SELECT *, {REASON_SQL} AS dq_reason FROM ev)"""

RAW_COLS_SQL = 'user_id, product_id, action, "timestamp", device_id, device_type, location, ' \
               'user_segment, ip_address'

USERS_CTE = """
users AS (
  SELECT TRY_CAST(c.c_custkey AS INTEGER) AS user_id, c.c_name AS name, r.r_name AS region
  FROM customer c
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
)"""


def _bucket(ts: str, seconds: int) -> str:
    us = seconds * 1_000_000
    return f"make_timestamp(CAST(floor(epoch_us({ts}) / {us}) AS BIGINT) * {us})"


def _tumbling(seconds: int, src: str = "ev") -> str:
    b = _bucket("event_time", seconds)
    return f"""SELECT {b} AS window_start, {b} + to_microseconds({seconds * 1_000_000}) AS window_end,
       user_id, count(*) AS event_count
FROM {src} WHERE event_time IS NOT NULL GROUP BY ALL"""


def _sliding(duration: int, slide: int, src: str = "ev") -> str:
    k = duration // slide
    b = _bucket("event_time", slide)
    return f"""SELECT window_start, window_start + to_microseconds({duration * 1_000_000}) AS window_end,
       user_id, count(*) AS event_count
FROM (SELECT {b} - to_microseconds(CAST(j AS BIGINT) * {slide * 1_000_000}) AS window_start, user_id
      FROM (SELECT event_time, user_id, unnest(range({k})) AS j FROM {src}
            WHERE event_time IS NOT NULL))
GROUP BY ALL"""


def _strict_reason() -> str:
    return (REASON_SQL.replace("CAST(current_timestamp AS TIMESTAMP)", f"TIMESTAMP '{B.STRICT_AS_OF}'")
            .replace(f"length(location) > {MAX_LOC}", f"length(location) > {B.STRICT_MAX_LOCATION}"))


def _severity(score: str, thr: str) -> str:
    return f"CASE WHEN {score} >= {thr} * {HIGH} THEN 'high' ELSE 'medium' END"


def _zscore(summary_sql: str, group: str | None = None) -> str:
    if group is None:
        stats = "SELECT avg(event_count) AS m, stddev_samp(event_count) AS s FROM s"
        join = "s CROSS JOIN st"
    else:
        stats = f"SELECT {group}, avg(event_count) AS m, stddev_samp(event_count) AS s FROM s GROUP BY {group}"
        join = f"s JOIN st USING ({group})"
    return f"""WITH {EVENTS_CTE.strip()},
s AS ({summary_sql}),
st AS ({stats}),
z AS (SELECT s.*, (event_count - m) / NULLIF(st.s, 0) AS score FROM {join})
SELECT window_start, window_end, user_id, event_count, round(score, 6) AS score,
       {_severity('score', str(Z))} AS severity
FROM z WHERE score > {Z}"""


CENTROID_FEATS = ", ".join(
    [f"CASE WHEN action = '{c}' THEN 1.0 ELSE 0.0 END" for c in B.CENTROID_CATEGORIES])
CENTERS_SQL = "[" + ", ".join("[" + ", ".join(repr(float(v)) for v in c) + "]"
                              for c in B.CENTROID_CENTERS) + "]"


def queries_sql() -> dict[str, str]:
    day, hour = 86400, 3600
    flag = f"""WITH {TAGGED_CTE.strip()},
valid AS (SELECT * FROM tagged WHERE dq_reason IS NULL),
{USERS_CTE.strip()},
s AS (SELECT t.*, u.name AS user_name, u.region FROM ({_tumbling(day, 'valid')}) t
      LEFT JOIN users u USING (user_id)),
st AS (SELECT avg(event_count) AS m, stddev_samp(event_count) AS s FROM s),
z AS (SELECT s.*, (event_count - m) / NULLIF(st.s, 0) AS score FROM s CROSS JOIN st)
SELECT window_start, window_end, user_id, user_name, region, event_count,
       round(score, 6) AS score, {_severity('score', str(Z))} AS severity
FROM z WHERE score > {Z}"""

    changelog_cte = f"""WITH {EVENTS_CTE.strip()},
pb AS (SELECT {_bucket('event_time', day)} AS window_start,
              {_bucket('event_time', day)} + to_microseconds({day * 1_000_000}) AS window_end,
              user_id, CAST(floor(epoch_us(event_time) / {hour * 1_000_000}) AS BIGINT) AS batch_id,
              count(*) AS n
       FROM ev WHERE event_time IS NOT NULL GROUP BY ALL),
log AS (SELECT user_id, window_start, window_end, batch_id,
               sum(n) OVER (PARTITION BY user_id, window_start, window_end ORDER BY batch_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS event_count
        FROM pb)"""

    alerts_base = f"""WITH {EVENTS_CTE.strip()},
{USERS_CTE.strip()},
s AS (SELECT t.*, u.name AS user_name, u.region FROM ({_tumbling(day)}) t
      LEFT JOIN users u USING (user_id)),
st AS (SELECT avg(event_count) AS m, stddev_samp(event_count) AS s FROM s),
z AS (SELECT s.*, (event_count - m) / NULLIF(st.s, 0) AS score FROM s CROSS JOIN st),
a AS (SELECT *, {_severity('score', str(Z))} AS severity,
             strftime(window_start, '%Y-%m-%dT%H:%M:%S') AS ws,
             strftime(window_end, '%Y-%m-%dT%H:%M:%S') AS we
      FROM z WHERE score > {Z})"""

    return {
        "dq_reasons_strict": f"""WITH {EVENTS_CTE.strip()}
SELECT user_id, product_id, action, event_time, location, {_strict_reason()} AS dq_reason FROM ev""",
        "decode_mixed": f"""WITH {EVENTS_CTE.strip()}
SELECT action, CAST(event_time AS DATE) AS day, count(*) AS n_rows, count(DISTINCT product_id) AS n_products
FROM ev WHERE product_id % 10 >= 6 AND user_id IS NOT NULL AND action IS NOT NULL AND event_time IS NOT NULL GROUP BY ALL""",
        "avro_filter_rows": f"""WITH {EVENTS_CTE.strip()}
SELECT {RAW_COLS_SQL}, event_time FROM ev
WHERE action IN ({VALID_ACTIONS_SQL}) AND length(location) BETWEEN 1 AND {B.STRICT_MAX_LOCATION}""",
        "summary_enriched_partial": f"""WITH {EVENTS_CTE.strip()},
{USERS_CTE.strip()},
urgent AS (SELECT * FROM users WHERE user_id IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'))
SELECT t.window_start, t.window_end, t.user_id, t.event_count, u.name AS user_name, u.region
FROM ({_tumbling(day)}) t LEFT JOIN urgent u USING (user_id)""",
        "distance_p95": f"""WITH {EVENTS_CTE.strip()},
c AS (SELECT {_bucket('event_time', day)} AS window_start, user_id, action, count(*) AS event_count
      FROM ev WHERE event_time IS NOT NULL GROUP BY ALL),
f AS (SELECT *, [CAST(event_count AS DOUBLE), {CENTROID_FEATS}] AS feats FROM c),
d AS (SELECT list_transform({CENTERS_SQL}, lambda ctr: sqrt(list_sum(
            list_transform(list_zip(feats, ctr), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))) AS dists
      FROM f),
m AS (SELECT round(list_min(dists), 9) AS distance,
             CAST(list_position(dists, list_min(dists)) - 1 AS INTEGER) AS cluster FROM d),
q AS (SELECT quantile_cont(distance, {B.DISTANCE_QUANTILE}) AS lim FROM m)
SELECT cluster, count(*) AS n_rows, round(avg(distance), 6) AS mean_distance,
       count(*) FILTER (WHERE distance > lim) AS n_beyond
FROM m, q GROUP BY cluster""",
        "raw_dedup_devices": f"""WITH {EVENTS_CTE.strip()},
e AS (SELECT * REPLACE (CASE WHEN action <> 'signup' THEN 'd' || CAST(user_id % 7 AS VARCHAR) END AS device_id) FROM ev),
r AS (SELECT * FROM e UNION ALL SELECT * FROM e)
SELECT {RAW_COLS_SQL} FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, "timestamp", action, device_id) AS rn
  FROM r WHERE user_id IS NOT NULL AND "timestamp" IS NOT NULL AND action IS NOT NULL
    AND device_id IS NOT NULL) WHERE rn = 1
UNION ALL
SELECT {RAW_COLS_SQL} FROM r WHERE user_id IS NULL OR "timestamp" IS NULL OR action IS NULL
  OR device_id IS NULL""",
        "flagship_1d": flag,
        "dq_valid": f"""WITH {TAGGED_CTE.strip()}
SELECT {RAW_COLS_SQL}, event_time FROM tagged WHERE dq_reason IS NULL""",
        "dq_invalid_reasons": f"""WITH {TAGGED_CTE.strip()}
SELECT user_id, product_id, action, event_time, location, dq_reason
FROM tagged WHERE dq_reason IS NOT NULL""",
        "dq_profile": f"""WITH {TAGGED_CTE.strip()}
SELECT dq_reason, count(*) AS n_rows FROM tagged WHERE dq_reason IS NOT NULL GROUP BY dq_reason""",
        "decode_json_required": f"""WITH {EVENTS_CTE.strip()}
SELECT {RAW_COLS_SQL}, event_time FROM ev
WHERE user_id IS NOT NULL AND product_id IS NOT NULL AND action IS NOT NULL
  AND event_time IS NOT NULL""",
        "tumbling_5s": f"WITH {EVENTS_CTE.strip()}\n{_tumbling(5)}",
        "sliding_1min_5s": f"WITH {EVENTS_CTE.strip()}\n{_sliding(60, 5)}",
        "tumbling_1h": f"WITH {EVENTS_CTE.strip()}\n{_tumbling(hour)}",
        "sliding_1d_1h": f"WITH {EVENTS_CTE.strip()}\n{_sliding(day, hour)}",
        "sliding_by_action_1h_5min": f"WITH {EVENTS_CTE.strip()}\n"
                                     + _sliding(hour, 300).replace("user_id", "action"),
        "user_action_counts": f"""WITH {EVENTS_CTE.strip()}
SELECT user_id, action, count(*) AS event_count FROM ev GROUP BY ALL""",
        "summary_enriched": f"""WITH {EVENTS_CTE.strip()},
{USERS_CTE.strip()}
SELECT t.window_start, t.window_end, t.user_id, t.event_count, u.name AS user_name, u.region
FROM ({_tumbling(day)}) t LEFT JOIN users u USING (user_id)""",
        "anomaly_zscore_1d": _zscore(_tumbling(day)),
        "anomaly_zscore_1h": _zscore(_tumbling(hour)),
        "anomaly_zscore_by_window_1h": _zscore(
            f"SELECT *, CAST(window_start AS DATE) AS day FROM ({_tumbling(hour)})", group="day"),
        "anomaly_fixed_count_1d": f"""WITH {EVENTS_CTE.strip()},
s AS ({_tumbling(day)})
SELECT window_start, window_end, user_id, event_count, CAST(event_count AS DOUBLE) AS score,
       {_severity('event_count', str(N_FIXED))} AS severity
FROM s WHERE event_count > {N_FIXED}""",
        "anomaly_centroid_distance": f"""WITH {EVENTS_CTE.strip()},
c AS (SELECT {_bucket('event_time', day)} AS window_start,
             {_bucket('event_time', day)} + to_microseconds({day * 1_000_000}) AS window_end,
             user_id, action, count(*) AS event_count
      FROM ev WHERE event_time IS NOT NULL GROUP BY ALL),
f AS (SELECT *, [CAST(event_count AS DOUBLE), {CENTROID_FEATS}] AS feats FROM c),
d AS (SELECT *, list_transform({CENTERS_SQL}, lambda ctr: sqrt(list_sum(
            list_transform(list_zip(feats, ctr), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))) AS dists
      FROM f),
m AS (SELECT *, list_min(dists) AS score,
             CAST(list_position(dists, list_min(dists)) - 1 AS INTEGER) AS cluster FROM d)
SELECT window_start, window_end, user_id, action, event_count, cluster, round(score, 6) AS score,
       {_severity('score', str(B.CENTROID_THRESHOLD))} AS severity
FROM m WHERE score > {B.CENTROID_THRESHOLD}""",
        "summary_upsert_latest": changelog_cte + """
SELECT user_id, window_start, window_end, arg_max(batch_id, batch_id) AS batch_id,
       arg_max(event_count, batch_id) AS event_count
FROM log GROUP BY ALL""",
        "anomaly_first_wins": changelog_cte + f"""
SELECT user_id, window_start, window_end, arg_min(batch_id, batch_id) AS batch_id,
       arg_min(event_count, batch_id) AS event_count,
       arg_min({_severity('event_count', str(N_FIXED))}, batch_id) AS severity
FROM log WHERE event_count > {N_FIXED} GROUP BY ALL""",
        "raw_dedup": f"""WITH {EVENTS_CTE.strip()},
r AS (SELECT * FROM ev UNION ALL SELECT * FROM ev)
SELECT {RAW_COLS_SQL} FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, "timestamp", action, device_id) AS rn
  FROM r WHERE user_id IS NOT NULL AND "timestamp" IS NOT NULL AND action IS NOT NULL
    AND device_id IS NOT NULL) WHERE rn = 1
UNION ALL
SELECT {RAW_COLS_SQL} FROM r WHERE user_id IS NULL OR "timestamp" IS NULL OR action IS NULL
  OR device_id IS NULL""",
        "raw_dedup_nulls_equal": f"""WITH {EVENTS_CTE.strip()},
r AS (SELECT * FROM ev UNION ALL SELECT * FROM ev)
SELECT DISTINCT ON (user_id, "timestamp", action, device_id) {RAW_COLS_SQL} FROM r""",
        "text_export": f"""WITH {TAGGED_CTE.strip()}
SELECT concat_ws(chr(9),
  coalesce(translate(CAST(user_id AS VARCHAR), chr(9) || chr(10), '  '), '\\N'),
  coalesce(translate(CAST(product_id AS VARCHAR), chr(9) || chr(10), '  '), '\\N'),
  coalesce(translate(action, chr(9) || chr(10), '  '), '\\N'),
  coalesce(strftime(event_time, '%Y-%m-%d %H:%M:%S'), '\\N'),
  coalesce(translate(device_id, chr(9) || chr(10), '  '), '\\N'),
  coalesce(translate(device_type, chr(9) || chr(10), '  '), '\\N'),
  coalesce(translate(location, chr(9) || chr(10), '  '), '\\N'),
  coalesce(translate(user_segment, chr(9) || chr(10), '  '), '\\N'),
  coalesce(translate(ip_address, chr(9) || chr(10), '  '), '\\N')) AS line
FROM tagged WHERE dq_reason IS NULL""",
        "dlq_json": f"""WITH {TAGGED_CTE.strip()}
SELECT CAST(floor(epoch_us(event_time) / {hour * 1_000_000}) AS BIGINT) AS batch_id,
       user_id, product_id, action, event_time, dq_reason
FROM tagged WHERE dq_reason IS NOT NULL""",
        "alert_json": alerts_base + f"""
SELECT user_id, user_name, region, ws AS window_start, we AS window_end, event_count,
       'zscore' AS detector_type, round(score, 6) AS score, CAST({Z} AS DOUBLE) AS threshold, severity
FROM a""",
        "alert_message": alerts_base + f"""
SELECT user_id, severity,
       printf('{MSG}',
              user_id, coalesce(user_name, '{UNKNOWN}'), coalesce(region, '{UNKNOWN}'), event_count,
              ws, we, 'zscore', round(score, 4), severity) AS message
FROM a WHERE severity IN ({NOTIFY_SQL})""",
    }
