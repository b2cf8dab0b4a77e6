"""The same results in plain SQL, for DuckDB on the given tables.

Rates and means are rounded with whole numbers, halves up, as explained in
``eventmere/functions/exact.py``.
"""

from __future__ import annotations

# The event-log tables as views over ``events``; ``n`` is the numeric event id.
BASE = """
WITH raw AS (
  SELECT event_id AS n,
         CAST(event_id AS VARCHAR) AS event_id,
         1000 + event_id - event_id % 5 AS user_id,
         1 + event_id % 4 AS creator_id,
         CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'cart_add'
              WHEN 'error' THEN 'video_buffering' WHEN 'purchase' THEN 'payment'
              ELSE event_type END AS event_type,
         ts AS created_at,
         1 + event_id % 9 AS lecture_id,
         CASE (CAST(floor(value) AS BIGINT) + event_id) % 4
              WHEN 0 THEN 'instagram' WHEN 1 THEN 'naver_ad' WHEN 2 THEN 'google' ELSE 'direct' END AS referrer,
         CAST(3 + CAST(floor(value) AS BIGINT) % 28 AS INTEGER) AS buffering_duration,
         CASE event_id % 3 WHEN 0 THEN 'Mozilla/5.0 (Macintosh)' WHEN 1 THEN 'Mobile_Safari'
              ELSE 'Mozilla/5.0 (Windows NT 10.0)' END AS user_agent,
         'ORD-' || CAST(event_id AS VARCHAR) AS order_id,
         CAST(CASE event_id % 3 WHEN 0 THEN 50000 WHEN 1 THEN 99000 ELSE 150000 END AS INTEGER) AS amount,
         CASE WHEN CAST(floor(value) AS BIGINT) % 5 = 0 THEN 'FAIL' ELSE 'SUCCESS' END AS status,
         CASE WHEN CAST(floor(value) AS BIGINT) % 5 <> 0 THEN NULL
              WHEN event_id % 2 = 0 THEN 'PG_TIMEOUT' ELSE 'CARD_DENIED' END AS error_code
  FROM events
),
master_event_logs AS (SELECT n, event_id, user_id, creator_id, event_type, created_at FROM raw),
page_view_details AS (SELECT n, event_id, lecture_id, referrer FROM raw WHERE event_type = 'page_view'),
cart_add_details AS (SELECT n, event_id, lecture_id FROM raw WHERE event_type = 'cart_add'),
video_buffering_details AS (
  SELECT n, event_id, lecture_id, buffering_duration, user_agent FROM raw WHERE event_type = 'video_buffering'),
payment_details AS (
  SELECT n, event_id, order_id, amount, status, error_code FROM raw WHERE event_type = 'payment'),
payment_tasks AS (
  SELECT n AS task_id, order_id, CASE WHEN n % 3 = 0 THEN 'PENDING' ELSE 'DONE' END AS status,
         CAST(n % 4 AS INTEGER) AS retry_count, created_at AS updated_at
  FROM raw WHERE event_type = 'payment' AND status = 'SUCCESS'),
users AS (
  SELECT user_id, 'student_' || user_id || '@example.com' AS email, 'Student_' || user_id AS name,
         'STUDENT' AS role, min(created_at) AS joined_at FROM raw GROUP BY user_id
  UNION ALL
  SELECT creator_id, 'creator_' || creator_id || '@example.com', 'Creator_' || creator_id,
         'CREATOR', min(created_at) FROM raw GROUP BY creator_id),
wide AS (
  SELECT m.event_id, m.user_id, m.creator_id, m.event_type, m.created_at,
         coalesce(v.lecture_id, c.lecture_id, b.lecture_id) AS lecture_id, v.referrer,
         b.buffering_duration, b.user_agent, p.order_id, p.amount, p.status AS payment_status,
         p.error_code, t.status AS task_status, t.retry_count, m.n
  FROM master_event_logs m
  LEFT JOIN page_view_details v USING (event_id)
  LEFT JOIN cart_add_details c USING (event_id)
  LEFT JOIN video_buffering_details b USING (event_id)
  LEFT JOIN payment_details p USING (event_id)
  LEFT JOIN payment_tasks t ON t.order_id = p.order_id)
"""

CUTOFF = "TIMESTAMP '2024-01-15 12:00:00'"

# What a purge up to the cutoff leaves when only even ids are archived.
_LATE_EVENTS = f"FROM events WHERE event_id % 2 = 1 OR ts > {CUTOFF}\n"

_WIDE_OUT = """event_id, user_id, creator_id, event_type, epoch_us(created_at) AS created_us, lecture_id, referrer,
  buffering_duration, user_agent, order_id, amount, payment_status, error_code, task_status, retry_count"""
_COMMON_OUT = "event_id, user_id, creator_id, event_type, epoch_us(created_at) AS created_us"
_LISTED = "('page_view', 'cart_add', 'video_buffering', 'payment')"
_PARTITIONS = """
SELECT lower(event_type) AS kind, CAST(created_at AS DATE) AS dt, count(*) AS row_count
FROM wide {where} GROUP BY 1, 2"""

_EVENT_TABLES = [
    "master_event_logs", "page_view_details", "cart_add_details", "video_buffering_details", "payment_details", "payment_tasks",
]


def _counts(names: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in names)


# -- reports: many-to-many joins as they are defined, unreduced ---------------

CART_DROPOUT = """
SELECT lecture_id, carts AS cart_user_count, orders AS actual_payment_count,
       ((20000 * (carts - payers) + carts) // (2 * carts)) / 100.0 AS dropout_rate
FROM (
  SELECT c.lecture_id, count(DISTINCT m.user_id) AS carts,
         count(DISTINCT p.order_id) FILTER (WHERE p.status = 'SUCCESS') AS orders,
         count(DISTINCT m.user_id) FILTER (WHERE p.status = 'SUCCESS') AS payers
  FROM cart_add_details c
  JOIN master_event_logs m USING (event_id)
  LEFT JOIN (SELECT pm.user_id, d.order_id, d.status
             FROM payment_details d JOIN master_event_logs pm USING (event_id)) p ON p.user_id = m.user_id
  GROUP BY c.lecture_id)
"""

CHANNEL_QUALITY = """
SELECT marketing_channel, views AS total_page_views, stalls AS buffering_incident_count,
       CASE WHEN k = 0 THEN 0.0 ELSE ((200 * s + k) // (2 * k)) / 100.0 END AS avg_buffering_seconds
FROM (
  SELECT v.referrer AS marketing_channel, count(DISTINCT v.event_id) AS views,
         count(DISTINCT b.event_id) AS stalls, count(b.buffering_duration) AS k,
         coalesce(sum(b.buffering_duration), 0) AS s
  FROM (SELECT d.event_id, d.referrer, m.user_id
        FROM page_view_details d JOIN master_event_logs m USING (event_id)) v
  LEFT JOIN (SELECT d.event_id, d.buffering_duration, m.user_id
             FROM video_buffering_details d JOIN master_event_logs m USING (event_id)) b
    ON b.user_id = v.user_id
  GROUP BY v.referrer)
"""

STUCK_RATE = """
SELECT paid AS total_success_payments, waiting AS pending_outbox_tasks,
       CASE WHEN paid > 0 THEN ((20000 * waiting + paid) // (2 * paid)) / 100.0 END AS outbox_stuck_rate
FROM (
  SELECT count(*) FILTER (WHERE p.status = 'SUCCESS') AS paid,
         count(*) FILTER (WHERE t.status = 'PENDING') AS waiting
  FROM payment_details p LEFT JOIN payment_tasks t ON t.order_id = p.order_id)
"""

CREATOR_RISK = """
SELECT creator_id, events AS total_creator_events, stalls AS total_buffering_incidents,
       ((200 * s + k) // (2 * k)) / 100.0 AS avg_buffering_duration_secs
FROM (
  SELECT m.creator_id, count(DISTINCT m.event_id) AS events, count(DISTINCT b.event_id) AS stalls,
         count(b.buffering_duration) AS k, sum(b.buffering_duration) AS s
  FROM master_event_logs m JOIN video_buffering_details b USING (event_id)
  GROUP BY m.creator_id)
"""

# -- panels ------------------------------------------------------------------

_FIRST_REFERRER = """
, first_view AS (
  SELECT user_id, referrer FROM (
    SELECT user_id, referrer, row_number() OVER (PARTITION BY user_id ORDER BY created_at, event_id) AS place
    FROM wide WHERE event_type = 'page_view' AND referrer IS NOT NULL)
  WHERE place = 1)
, stalls AS (
  SELECT w.creator_id, w.buffering_duration, f.referrer
  FROM wide w JOIN first_view f USING (user_id)
  WHERE regexp_matches(w.event_type, 'buffering|video', 'i'))
"""

# -- dirty input -------------------------------------------------------------

_SPOILED_RAW = """
, spoiled AS (
  SELECT n, CASE WHEN n % 10 = 7 THEN 'E-same' ELSE event_id END AS event_id,
         CASE WHEN n % 50 <> 0 THEN user_id END AS user_id, creator_id, event_type, created_at,
         CASE WHEN n % 40 <> 1 THEN lecture_id END AS lecture_id,
         CASE WHEN n % 30 = 11 THEN repeat(user_agent, 20) ELSE user_agent END AS user_agent,
         CASE WHEN event_type <> 'payment' THEN NULL WHEN n % 3 = 0 THEN 'ORD-same' ELSE order_id END AS order_id
  FROM raw)
, judged AS (
  SELECT *, CASE
    WHEN user_id IS NULL THEN 'missing user_id'
    WHEN event_type IN ('page_view', 'cart_add', 'video_buffering') AND lecture_id IS NULL THEN 'missing lecture_id'
    WHEN event_type = 'video_buffering' AND length(user_agent) > 255 THEN 'too long user_agent'
    WHEN user_id % 20 = 5 THEN 'unknown user' END AS reject_reason
  FROM spoiled)
, per_event AS (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY created_at) AS copy
  FROM judged WHERE reject_reason IS NULL)
, per_order AS (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY created_at, event_id) AS order_copy
  FROM per_event WHERE copy = 1 AND event_type = 'payment')
"""

_SPOILED_TABLES = """
, s_master AS (
  SELECT event_id, CASE WHEN n % 70 = 2 THEN -1 ELSE user_id END AS user_id,
         CASE WHEN n % 90 <> 1 THEN creator_id END AS creator_id, event_type, created_at
  FROM (SELECT * FROM master_event_logs UNION ALL SELECT * FROM master_event_logs WHERE n % 50 = 3))
, s_view AS (
  SELECT event_id, lecture_id, CASE WHEN n % 30 = 4 THEN repeat(referrer, 20) ELSE referrer END AS referrer
  FROM page_view_details)
, s_cart AS (SELECT event_id, CASE WHEN n % 20 <> 6 THEN lecture_id END AS lecture_id FROM cart_add_details)
, s_stall AS (
  SELECT CASE WHEN n % 25 = 0 THEN 'x' || event_id ELSE event_id END AS event_id, lecture_id,
         buffering_duration, user_agent FROM video_buffering_details)
, s_payment AS (
  SELECT event_id, CASE WHEN n % 3 = 0 THEN 'ORD-same' ELSE order_id END AS order_id, amount, status, error_code
  FROM payment_details)
"""
_SPOILED_NAMES = {
    "master_event_logs": "s_master",
    "page_view_details": "s_view",
    "cart_add_details": "s_cart",
    "video_buffering_details": "s_stall",
    "payment_details": "s_payment",
}


# Every declared rule, written out: table, required columns, longest texts, keys, references.
_RULES = [
    ("users", "user_id email name role joined_at", {"email": 100, "name": 50, "role": 20}, "user_id", ["email"], []),
    ("master_event_logs", "event_id user_id creator_id event_type created_at", {"event_type": 50}, "event_id", [],
     [("user_id", "users", "user_id"), ("creator_id", "users", "user_id")]),
    ("page_view_details", "event_id lecture_id referrer", {"referrer": 100}, "event_id", [], [("event_id", "master_event_logs", "event_id")]),
    ("cart_add_details", "event_id lecture_id", {}, "event_id", [], [("event_id", "master_event_logs", "event_id")]),
    ("video_buffering_details", "event_id lecture_id buffering_duration user_agent", {"user_agent": 255}, "event_id", [],
     [("event_id", "master_event_logs", "event_id")]),
    ("payment_details", "event_id order_id amount status", {"order_id": 100, "status": 20, "error_code": 50}, "event_id", ["order_id"],
     [("event_id", "master_event_logs", "event_id")]),
    ("payment_tasks", "task_id order_id status retry_count updated_at", {"order_id": 100, "status": 20}, "task_id", [],
     [("order_id", "payment_details", "order_id")]),
]


def _rule_counts(renamed: dict[str, str]) -> str:
    """One count per declared rule."""
    parts = []
    for table, required, lengths, key, unique, references in _RULES:
        at = renamed.get(table, table)
        own = [("not_null", c, f"SELECT count(*) FROM {at} WHERE {c} IS NULL") for c in required.split()]
        own += [("max_length", c, f"SELECT count(*) FROM {at} WHERE length({c}) > {n}") for c, n in lengths.items()]
        own += [
            (rule, c, f"SELECT count({c}) - count(DISTINCT {c}) FROM {at}")
            for rule, c in [("primary_key", key), *[("unique", c) for c in unique]]
        ]
        own += [
            ("foreign_key", c, f"SELECT count(*) FROM {at} x WHERE x.{c} IS NOT NULL "
             f"AND NOT EXISTS (SELECT 1 FROM {renamed.get(other, other)} y WHERE y.{referred} = x.{c})")
            for c, other, referred in references
        ]
        parts += [f"SELECT '{table}' AS table_name, '{r}' AS rule, '{c}' AS column_name, ({q}) AS violations" for r, c, q in own]
    return " UNION ALL ".join(parts)


_KIND_OUT = {
    "page_view": f"{_COMMON_OUT}, lecture_id, referrer",
    "cart_add": f"{_COMMON_OUT}, lecture_id",
    "video_buffering": f"{_COMMON_OUT}, lecture_id, buffering_duration, user_agent",
    "payment": f"{_COMMON_OUT}, order_id, amount, payment_status, error_code, task_status, retry_count",
}


def oracle_sql() -> dict[str, str]:
    partitions = BASE + _PARTITIONS.format(where="")
    task_counts = "SELECT 'payment_tasks' AS table_name, count(*) AS row_count FROM payment_tasks t WHERE t.order_id IN (SELECT order_id FROM payment_details WHERE event_id IN (SELECT event_id FROM gone))"
    sql = {
        "table_row_counts": BASE + _counts(["users", *_EVENT_TABLES]),
        "lake_rebuilt_tables": BASE + _counts(["users", *_EVENT_TABLES]),
        "stream_ingest_counts": BASE + _counts(_EVENT_TABLES),
        "archive_partition_counts": partitions,
        "stream_archive_counts": partitions,
        "archive_run_metrics": BASE
        + f""", parts AS ({_PARTITIONS.format(where="")})
SELECT 'partition' AS line, kind, CAST(dt AS VARCHAR) AS dt, row_count, CAST(NULL AS VARCHAR) AS status FROM parts
UNION ALL
SELECT 'total', NULL, NULL, CAST(coalesce(sum(row_count), 0) AS BIGINT),
       CASE WHEN count(*) > 0 THEN 'SUCCESS' ELSE 'IDLE' END FROM parts""",
        "lake_scan_all": BASE
        + f"SELECT {_WIDE_OUT}, lower(event_type) AS kind, CAST(created_at AS DATE) AS dt FROM wide",
        "lake_range_counts": BASE
        + _PARTITIONS.format(
            where="WHERE created_at >= TIMESTAMP '2024-01-10' AND created_at < TIMESTAMP '2024-01-16'"
        ),
        "lake_normalize": BASE
        + """SELECT event_id, creator_id,
  CASE WHEN n % 4 <> 1 THEN lecture_id END AS lecture_id,
  CASE WHEN n % 5 = 0 THEN NULL WHEN n % 5 = 1 THEN buffering_duration + CAST(0.5 AS DOUBLE)
       ELSE CAST(buffering_duration AS DOUBLE) END AS buffering_duration,
  CASE WHEN n % 11 <> 0 THEN epoch_us(created_at) END AS created_us
FROM wide WHERE n % 7 <> 1""",
        "archive_wide": BASE + f"SELECT {_WIDE_OUT} FROM wide",
        "archive_other": BASE + f"SELECT {_COMMON_OUT} FROM wide WHERE event_type NOT IN {_LISTED}",
        "archive_cutoff_counts": BASE
        + f"SELECT event_type, count(*) AS row_count FROM master_event_logs WHERE created_at <= {CUTOFF} GROUP BY 1",
        "cart_dropout_by_lecture": BASE + CART_DROPOUT,
        "channel_buffering_quality": BASE + CHANNEL_QUALITY,
        "outbox_stuck_rate": BASE + STUCK_RATE,
        "creator_buffering_risk": BASE + CREATOR_RISK,
        "dash_cart_dropout_by_creator": BASE
        + """SELECT creator_id, carts AS cart_count, paid AS payment_count,
  CAST(greatest(carts - paid, 0) AS DOUBLE) / CAST(carts AS DOUBLE) * CAST(100.0 AS DOUBLE) AS dropout_rate
FROM (SELECT creator_id, count(*) FILTER (WHERE event_type = 'cart_add') AS carts,
             count(*) FILTER (WHERE event_type = 'payment' AND coalesce(payment_status, 'SUCCESS') = 'SUCCESS') AS paid
      FROM wide GROUP BY creator_id)
WHERE carts > 0""",
        "dash_buffering_by_first_referrer": BASE
        + _FIRST_REFERRER
        + """SELECT referrer, count(*) AS buffering_count FROM stalls GROUP BY referrer
UNION ALL SELECT 'no_matched_referrer', 0 WHERE NOT EXISTS (SELECT 1 FROM stalls)""",
        "dash_outbox_volumes": BASE
        + """SELECT 'Success Payments' AS metric, count(*) AS volume FROM wide
WHERE event_type = 'payment' AND payment_status = 'SUCCESS'
UNION ALL SELECT 'Pending Outbox Tasks', count(*) FROM wide
WHERE event_type = 'payment' AND payment_status = 'SUCCESS' AND task_status = 'PENDING'""",
        "dash_top_creators_by_buffering": BASE
        + _FIRST_REFERRER
        + """SELECT creator_id, CAST(sum(buffering_duration) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avg_buffering_duration,
  'Creator ' || creator_id AS creator
FROM stalls WHERE buffering_duration IS NOT NULL
GROUP BY creator_id ORDER BY avg_buffering_duration DESC, creator_id LIMIT 5""",
        "first_referrer_per_user": BASE + _FIRST_REFERRER + "SELECT user_id, referrer FROM first_view",
        "ingest_master": BASE + f"SELECT {_COMMON_OUT} FROM raw",
        "ingest_page_view": BASE + "SELECT event_id, lecture_id, referrer FROM page_view_details",
        "ingest_cart_add": BASE + "SELECT event_id, lecture_id FROM cart_add_details",
        "ingest_video_buffering": BASE
        + "SELECT event_id, lecture_id, buffering_duration, user_agent FROM video_buffering_details",
        "ingest_payment": BASE + "SELECT event_id, order_id, amount, status, error_code FROM payment_details",
        "ingest_outbox_tasks": BASE
        + """SELECT order_id, 'PENDING' AS status, CAST(0 AS INTEGER) AS retry_count, epoch_us(created_at) AS updated_us
FROM raw WHERE event_type = 'payment' AND status = 'SUCCESS'""",
        "ingest_accepted": BASE
        + _SPOILED_RAW
        + """SELECT event_id, user_id, event_type, epoch_us(created_at) AS created_us, order_id FROM (
  SELECT event_id, user_id, event_type, created_at, order_id FROM per_event WHERE copy = 1 AND event_type <> 'payment'
  UNION ALL
  SELECT event_id, user_id, event_type, created_at, order_id FROM per_order WHERE order_copy = 1)""",
        "ingest_rejected_counts": BASE
        + _SPOILED_RAW
        + """SELECT reject_reason, count(*) AS event_count FROM judged WHERE reject_reason IS NOT NULL GROUP BY 1
UNION ALL SELECT 'repeated event_id', count(*) FROM per_event WHERE copy > 1 HAVING count(*) > 0
UNION ALL SELECT 'repeated order_id', count(*) FROM per_order WHERE order_copy > 1 HAVING count(*) > 0""",
        "users_insert_if_absent": BASE
        + """SELECT user_id, email, CASE WHEN user_id % 2 = 0 THEN name ELSE 'again_' || user_id END AS name, role,
  epoch_us(joined_at) AS joined_us FROM users""",
        "purge_deleted_counts": BASE
        + f", gone AS (SELECT event_id FROM master_event_logs WHERE created_at <= {CUTOFF})"
        + task_counts
        + "".join(
            f" UNION ALL SELECT '{t}', count(*) FROM {t} WHERE event_id IN (SELECT event_id FROM gone)"
            for t in _EVENT_TABLES
            if t != "payment_tasks"
        ),
        "purge_retained_master": BASE
        + f"SELECT {_COMMON_OUT} FROM master_event_logs WHERE NOT created_at <= {CUTOFF}",
        "purge_retained_tasks": BASE
        + f"""SELECT task_id, order_id, status, retry_count, epoch_us(updated_at) AS updated_us
FROM payment_tasks WHERE order_id NOT IN (
  SELECT p.order_id FROM payment_details p JOIN master_event_logs m USING (event_id) WHERE m.created_at <= {CUTOFF})""",
        "constraint_report": BASE + _rule_counts({}),
        "constraint_report_spoiled": BASE + _SPOILED_TABLES + _rule_counts(_SPOILED_NAMES),
        "scalar_functions": BASE
        + """SELECT event_id,
  'ORD-' || strftime(created_at, '%Y%m%d') || '-' || (100000 + n % 900000) AS order_label,
  'student_' || user_id || '@example.com' AS email, 'Student_' || user_id AS name,
  'Creator ' || creator_id AS creator,
  CASE WHEN event_type = 'video_buffering' THEN substring(user_agent, 1, 15) END AS agent_start,
  strftime(created_at, '%Y%m%d_%H%M') AS minute_stamp, strftime(created_at, '%Y-%m-%d') AS day_text,
  CAST(created_at AS DATE) AS day, CAST(created_at AS DATE) + 1 AS next_day, event_type AS kind,
  substring(h, 1, 8) || '-' || substring(h, 9, 4) || '-' || substring(h, 13, 4) || '-' || substring(h, 17, 4)
    || '-' || substring(h, 21, 12) AS made_id,
  CASE WHEN event_type IN ('page_view', 'cart_add', 'video_buffering') THEN lecture_id ELSE 0 END AS lecture_or_zero,
  CASE WHEN event_type IN ('page_view', 'cart_add', 'video_buffering') AND lecture_id <> 9 THEN lecture_id END
    AS lecture_not_nine,
  CAST(CASE WHEN event_type = 'video_buffering' THEN greatest(buffering_duration - 10, 0) ELSE 0 END AS INTEGER) AS over_ten,
  CASE WHEN event_type = 'video_buffering'
       THEN ((200 * n + buffering_duration) // (2 * buffering_duration)) / 100.0 END AS rounded_ratio
FROM (SELECT *, sha256(length(CAST(user_id AS VARCHAR)) || ':' || user_id || length(event_type) || ':' || event_type
        || CASE WHEN event_type = 'page_view' THEN length(referrer) || ':' || referrer ELSE '~' END) AS h
      FROM raw)""",
    }
    day_range = "created_at >= TIMESTAMP '2024-01-10' AND created_at < TIMESTAMP '2024-01-16'"
    for name in [n for n in sql if n.startswith("dash_")]:
        for suffix, days in (("range", day_range), ("empty_range", "created_at < TIMESTAMP '1999-01-02'")):
            within = BASE.replace("FROM events\n", f"FROM events WHERE {days.replace('created_at', 'ts')}\n")
            sql[f"{name}_{suffix}"] = within + sql[name].removeprefix(BASE)
    sql["dash_top_creators_by_buffering_empty_range"] = """SELECT CAST(0 AS BIGINT) AS creator_id,
  CAST(0.0 AS DOUBLE) AS avg_buffering_duration, 'Creator 0' AS creator"""
    sql |= {
        "stream_ingest_scan": BASE + f"SELECT {_WIDE_OUT.replace(', task_status, retry_count', '')} FROM wide",
        "stream_archive_scan": BASE
        + f"""SELECT {_WIDE_OUT.replace(", task_status, retry_count", "")},
  CASE WHEN event_type = 'payment' AND payment_status = 'SUCCESS' THEN 'PENDING' END AS task_status,
  CASE WHEN event_type = 'payment' AND payment_status = 'SUCCESS' THEN CAST(0 AS INTEGER) END AS retry_count,
  lower(event_type) AS kind, CAST(created_at AS DATE) AS dt FROM wide""",
        "archive_idle_metrics": """SELECT count(*) AS row_count, 'SUCCESS' AS status FROM events
UNION ALL SELECT 0, 'IDLE' UNION ALL SELECT 0, 'IDLE'""",
        "archive_wide_many_tasks": BASE.split("wide AS (")[0]
        + """more_tasks AS (
  SELECT * FROM payment_tasks UNION ALL
  SELECT task_id, 'ORD-hot', status, retry_count, updated_at FROM payment_tasks WHERE task_id % 3 = 0),
hot_payments AS (
  SELECT n, event_id, CASE WHEN n % 1000 = 1 THEN 'ORD-hot' ELSE order_id END AS order_id, amount, status, error_code
  FROM payment_details),
wide AS ("""
        + BASE.split("wide AS (")[1].replace("payment_details p", "hot_payments p").replace("payment_tasks t", "more_tasks t")
        + f"SELECT {_WIDE_OUT} FROM wide",
        "store_purged_master": BASE + f"SELECT {_COMMON_OUT} FROM master_event_logs WHERE n % 2 = 1",
        "store_purged_tasks": BASE
        + """SELECT order_id, 'PENDING' AS status, CAST(0 AS INTEGER) AS retry_count, epoch_us(created_at) AS updated_us
FROM raw WHERE event_type = 'payment' AND status = 'SUCCESS' AND n % 2 = 1""",
        "stream_rejected": BASE
        + _SPOILED_RAW
        + """SELECT event_id, user_id, event_type, epoch_us(created_at) AS created_us, reject_reason FROM judged WHERE reject_reason IS NOT NULL
UNION ALL SELECT event_id, user_id, event_type, epoch_us(created_at), 'repeated event_id' FROM per_event WHERE copy > 1
UNION ALL SELECT event_id, user_id, event_type, epoch_us(created_at), 'repeated order_id' FROM per_order WHERE order_copy > 1""",
        "stream_message_scan": BASE.replace("FROM events\n", "FROM events WHERE event_id % 10 <> 3\n")
        + f"SELECT {_WIDE_OUT.replace(', task_status, retry_count', '')} FROM wide",
        "stream_unreadable": """SELECT 'events' AS topic, CAST(event_id % 4 AS INTEGER) AS partition, event_id AS "offset",
  '{"event_id": "' || event_id AS content FROM events WHERE event_id % 10 = 3""",
        "store_users": sql["users_insert_if_absent"],
        "store_cutoff_counts": BASE.replace("FROM events\n", _LATE_EVENTS) + _counts(_EVENT_TABLES),
        "store_cutoff_tasks": BASE
        + f"""SELECT order_id, 'PENDING' AS status, CAST(0 AS INTEGER) AS retry_count, epoch_us(created_at) AS updated_us
FROM raw WHERE event_type = 'payment' AND status = 'SUCCESS' AND (n % 2 = 1 OR created_at > {CUTOFF})""",
        "store_merged_scan": BASE.replace("FROM events\n", _LATE_EVENTS)
        + f"SELECT {_WIDE_OUT.replace(', task_status, retry_count', '')} FROM wide",
        "lake_compacted_scan": sql["lake_scan_all"],
        "lake_compacted_range_counts": sql["lake_range_counts"],
        "text_lake_scan": sql["lake_scan_all"],
        "text_lake_range_counts": sql["lake_range_counts"],
        "text_lake_mixed_headers": BASE
        + """SELECT event_id, user_id, epoch_us(created_at) AS created_us,
  CASE WHEN event_type <> 'cart_add' OR n % 3 <> 2 THEN lecture_id END AS lecture_id,
  CASE WHEN n % 3 <> 2 THEN user_agent END AS user_agent, order_id,
  CASE WHEN n % 3 <> 2 THEN retry_count END AS retry_count, lower(event_type) AS kind, CAST(created_at AS DATE) AS dt
FROM wide WHERE lower(event_type) IN ('page_view', 'cart_add', 'video_buffering', 'payment')""",
    }
    for kind, columns in _KIND_OUT.items():
        sql[f"archive_{kind}"] = BASE + f"SELECT {columns} FROM wide WHERE lower(event_type) = '{kind}'"
    for report in (
        "cart_dropout_by_lecture",
        "channel_buffering_quality",
        "outbox_stuck_rate",
        "creator_buffering_risk",
    ):
        sql[f"lake_{report}"] = sql[report]
    return sql
