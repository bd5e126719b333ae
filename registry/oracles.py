"""DuckDB SQL for the registered queries, written over the given tables alone."""

from __future__ import annotations

# Media events as a flat projection of ``events``.
EV = """
ev AS (
  SELECT event_id, ts, user_id, event_type, k,
    '10.0.' || (user_id % 7) || '.' || k AS client_ip,
    CASE user_id % 4 WHEN 0 THEN 'GB' WHEN 1 THEN 'US' WHEN 2 THEN 'FR' END AS country,
    CAST(user_id AS VARCHAR) AS customer_id,
    CAST(CASE event_type WHEN 'view' THEN 2 WHEN 'click' THEN 3 WHEN 'error' THEN 6 WHEN 'signup' THEN 7 ELSE -1 END AS TINYINT) AS action,
    CASE WHEN k = 1 THEN '' WHEN k > 1 THEN 's' || user_id || '-' || strftime(ts, '%Y%m%d') END AS cid,
    CASE event_type
      WHEN 'signup' THEN 'REGISTER_USER'
      WHEN 'purchase' THEN 'SUCCESSFUL_PURCHASE'
      WHEN 'error' THEN CASE WHEN k % 4 = 0 THEN 'FAILED_LOGIN' WHEN k % 4 > 1 THEN 'SUCCESSFUL_LOGIN' END
      WHEN 'click' THEN CASE k % 10 WHEN 0 THEN 'EVENT_WENT_LIVE' WHEN 1 THEN 'EVENT_WENT_NOTLIVE' ELSE 'OK' END
      ELSE 'OK' END AS ta,
    CASE k % 3 WHEN 0 THEN 'BROWSER' WHEN 1 THEN 'IOS' ELSE 'ANDROID' END AS device,
    CASE WHEN k % 20 = 2 THEN 'n/a' ELSE CAST(epoch_ms(date_trunc('day', ts)) AS VARCHAR) END AS started_millis,
    CASE WHEN k % 20 <> 2 THEN date_trunc('day', ts) END AS started_at,
    CAST(floor(value * 10) AS BIGINT) AS progress,
    CAST(k % 5 AS BIGINT) AS video,
    'NATION_' || (user_id % 30) AS realm,
    'T' || (user_id % 13) AS town,
    CASE k % 3 WHEN 0 THEN 'STRIPE' WHEN 1 THEN 'GOOGLE_IAP' ELSE 'APPLE_IAP' END AS payment_provider,
    CAST(CASE WHEN k % 10 = 0 THEN 0 WHEN k % 10 < 9 THEN round(value * 100) END AS FLOAT) AS amount,
    CASE k % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'GBP' WHEN 2 THEN 'AUD' END AS currency,
    k % 2 = 0 AS is_trial, k % 8 AS trial_days, k % 7 = 0 AS revoked, k % 6 = 0 AS cancelled,
    'sku-' || (k % 5) AS sku
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
)"""

RESOLVED = EV + """,
res AS (SELECT ev.*, n.n_nationkey AS realm_id, n.n_name AS name FROM ev LEFT JOIN nation n ON ev.realm = n.n_name)"""

FLAT = """client_ip, country, customer_id, action, cid, ta AS event_type, event_type AS source_type, device,
  started_millis, progress, video, realm, town, ts"""

PAY = RESOLVED + """,
bought AS (
  SELECT DISTINCT customer_id, realm_id, town, country, ts, payment_provider, amount, currency,
    is_trial, trial_days, sku, revoked, cancelled
  FROM res WHERE ta = 'SUCCESSFUL_PURCHASE'
),
pay AS (
  SELECT *, CAST(amount AS INTEGER) AS amount_with_tax, md5(concat(
    {parts})) AS payment_id
  FROM bought
)""".format(parts=",\n    ".join(
    f"CASE WHEN {c} IS NULL THEN 'n' ELSE length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"
    for c in (
        "customer_id", "realm_id", "town", "country", "ts", "payment_provider", "amount", "currency",
        "is_trial", "trial_days", "sku", "revoked", "cancelled",
    )
))

DAYS = """
days AS (
  SELECT CAST(unnest(generate_series(
    (SELECT CAST(min(ts) AS DATE) - 7 FROM events), (SELECT CAST(max(ts) AS DATE) FROM events), INTERVAL 1 DAY)) AS DATE) AS d
),
rates AS (
  SELECT d, currency, CAST(1 + (day(d) % 10) / 100.0 + idx / 10 AS DECIMAL(12,4)) AS rate
  FROM days, (VALUES ('GBP', 1), ('USD', 2), ('AUD', 3), ('ISK', 4)) c(currency, idx)
  WHERE NOT (currency = 'ISK' AND day(d) % 3 = 0)
)"""

RATES_OUT = "CAST(d AS VARCHAR) AS date, currency, CAST(rate AS VARCHAR) AS rate"

WEEKDAY = """CAST(CAST({ts} AS DATE) - CASE isodow({ts}) WHEN 6 THEN 1 WHEN 7 THEN 2 ELSE 0 END AS DATE)"""


def _converted(source: str, amount: str, target: str) -> str:
    day = WEEKDAY.format(ts="p.ts")
    return f"""
SELECT p.*, CASE WHEN p.currency = '{target}' THEN CAST(p.{amount} AS BIGINT)
  ELSE CAST(round(CAST(p.{amount} AS DOUBLE) / CAST(r.rate AS DOUBLE) * CAST(u.rate AS DOUBLE)) AS BIGINT) END AS converted
FROM {source} p
LEFT JOIN rates r ON r.currency = p.currency AND r.d = {day}
LEFT JOIN rates u ON u.currency = '{target}' AND u.d = {day}
WHERE p.currency IS NOT NULL"""


def _revenue(bucket: str, label: str = "ts") -> str:
    return f"""
WITH {PAY}, {DAYS},
sums AS (
  SELECT realm_id, payment_provider, currency, {bucket} AS ts, sum(amount_with_tax) AS amount
  FROM pay
  WHERE coalesce(amount_with_tax, 0) <> 0 AND realm_id IS NOT NULL AND payment_provider IS NOT NULL
    AND currency IS NOT NULL AND ts IS NOT NULL
  GROUP BY ALL
),
conv AS ({_converted("sums", "amount", "USD")})
SELECT realm_id, payment_provider, currency, CAST({label} AS TIMESTAMP) AS ts, CAST(amount AS BIGINT) AS amount, converted AS amount_usd FROM conv"""


EPOCH_WEEK = "make_timestamp(epoch_us(ts) - (epoch_us(ts) % 604800000000))"

SECONDS = "CAST(epoch_us({b}) // 1000000 - epoch_us({a}) // 1000000 AS BIGINT)"
SPAN = SECONDS.format(a="min(ts)", b="max(ts)")
VALID = "cid IS NOT NULL AND cid <> ''"

VOD_KEYS = "realm_id, session_id, customer_id, video_id, started_at, country, town"
LIVE_KEYS = VOD_KEYS + ", device"
BEATS = "realm_id, cid AS session_id, customer_id, video AS video_id, started_at, country, town"


def _vod(where: str) -> str:
    return f"""SELECT {BEATS}, max(progress) AS duration, min(ts) AS start_at, max(ts) AS end_at
  FROM res WHERE action = 2 AND {VALID} AND realm_id IS NOT NULL AND {where} GROUP BY ALL"""


def _live(where: str) -> str:
    return f"""SELECT {BEATS}, device, {SPAN} AS duration, min(ts) AS start_at, max(ts) AS end_at
  FROM res WHERE action = 3 AND {VALID} AND realm_id IS NOT NULL AND {where} GROUP BY ALL"""


def _touched(action: int) -> str:
    return f"session_id IN (SELECT cid FROM ev WHERE action = {action} AND {VALID} AND hour(ts) >= 12)"


def _merged(parts: str, action: int, keys: str, where: str = "") -> str:
    return f"""
WITH {RESOLVED},
earlier AS ({parts.format("hour(ts) < 12")}),
later AS ({parts.format("hour(ts) >= 12")}),
both_parts AS (SELECT * FROM later UNION ALL SELECT * FROM earlier {where or "WHERE " + _touched(action)})
SELECT {keys}, max(duration) AS duration, min(start_at) AS start_at, max(end_at) AS end_at
FROM both_parts GROUP BY {keys}"""


VOD_PARTS = _vod("{}")
LIVE_PARTS = _live("{}")

MSG = """
names AS (
  SELECT 'e' || r_regionkey AS id, r_name AS name FROM region
  UNION ALL SELECT 'v' || n_nationkey, n_name FROM nation
),
raw AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
msg AS (
  SELECT raw.*,
    CASE event_type WHEN 'signup' THEN 'REGISTER_SUCCESS' WHEN 'purchase' THEN 'PURCHASE_CONFIRMATION'
      WHEN 'click' THEN 'STREAM_RATING' END AS event_name,
    CASE event_type WHEN 'view' THEN 'VIDEO_HB' END AS message_type,
    CASE event_type WHEN 'error' THEN 'email-delivery' END AS role,
    CASE WHEN event_type <> 'error' THEN 'u' || user_id END AS muser,
    CASE WHEN event_type IN ('view', 'click') THEN 'p' || (k % 10) END AS product_id,
    CASE WHEN event_type = 'view' THEN CASE WHEN k % 9 > 0 THEN k ELSE 0 END END AS seconds,
    CASE WHEN k % 2 = 1 THEN k / 2 ELSE 181 END AS geo_latitude,
    CASE WHEN k % 4 = 1 THEN k / 4 ELSE 361 END AS geo_longitude,
    CASE WHEN k % 3 = 0 THEN '' ELSE coalesce(e.name, '') END AS experiment_id,
    CASE WHEN k % 3 = 0 THEN '' ELSE coalesce(v.name, '') END AS variant_id
  FROM raw LEFT JOIN names e ON e.id = 'e' || (k % 7) LEFT JOIN names v ON v.id = 'v' || (k % 40)
)"""

GEO = "CAST(geo_latitude AS DOUBLE) AS geo_latitude, CAST(geo_longitude AS DOUBLE) AS geo_longitude"
WATCH = f"""SELECT muser AS user_id, product_id AS content_id, experiment_id, variant_id, {GEO},
  CAST(sum(seconds) AS BIGINT) AS duration, max(ts) AS event_datetime
FROM msg WHERE message_type = 'VIDEO_HB' GROUP BY ALL"""

VIEWING = """
viewing AS (
  SELECT muser AS user_id, CASE WHEN event_name = 'REGISTER_SUCCESS' THEN 'register' ELSE product_id END AS content_id,
    experiment_id, variant_id, coalesce(seconds, 0) AS duration, ts, hour(ts) >= 12 AS late
  FROM msg
)"""

ROUTED = """
routed AS (
  SELECT CASE event_type WHEN 'view' THEN 'table_one' WHEN 'click' THEN 'table_two' ELSE 'table_other' END AS route,
    CASE WHEN k > 0 THEN event_id || ' ' || k END AS payload
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
)"""

LINES = "lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)"

WORDS = f"""
WITH {LINES}
SELECT word, count(*) AS count FROM (SELECT unnest(string_split(line, ' ')) AS word FROM lines) GROUP BY word"""

PART = "'NATION_' || (p_size % 30) = n.n_name"
PART_TS = "(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(p_partkey))"

EMAIL = """
SELECT CASE WHEN k % 4 > 0 THEN 'm' || event_id ELSE '' END AS message_id,
  'pm' || k AS provider_message_id,
  CASE WHEN k % 5 > 0 THEN 'r' || user_id ELSE '' END AS recipient_id,
  CASE k % 2 WHEN 0 THEN 'delivered' ELSE 'bounced' END AS email_status,
  CAST(k + 200 AS VARCHAR) AS status_code,
  CASE WHEN k % 6 > 0 THEN 'note ' || k ELSE '' END AS status_message,
  ts AS event_timestamp
FROM msg WHERE role = 'email-delivery'"""

ORACLES: dict[str, str] = {
    "packed_json_scan": f"WITH {EV} SELECT {FLAT} FROM ev",
    "packed_json_lines_scan": f"WITH {EV} SELECT {FLAT} FROM ev",
    "packed_json_measured": f"WITH {EV} SELECT {FLAT} FROM ev",
    "packed_json_corrupt": f"""
WITH {LINES}
SELECT CAST(NULL AS VARCHAR) AS customer_id, count(*) AS records, CAST(sum(length(line)) AS BIGINT) AS characters
FROM lines WHERE regexp_matches(line, '[^ \\t\\n\\f\\r\\v]')""",
    "typed_csv_load": "SELECT n_nationkey AS realm_id, n_name AS name FROM nation",
    "vod_catalogue_backfill": """
SELECT p_partkey AS video_id, p_partkey + 1000 AS video_dve_id, CAST(p_size % 30 AS SMALLINT) AS realm_id,
  p_name || ', "' || p_brand || '"' AS title, p_type AS description, CAST(p_size * 60 AS BIGINT) AS duration,
  'http://thumbs.example/' || p_partkey AS thumbnail_url, p_size % 2 <> 0 AS deleted, p_size % 3 <> 0 AS draft,
  CAST(NULL AS VARCHAR) AS tags, TIMESTAMP '1970-01-01 00:00:00' AS imported_at, TIMESTAMP '1970-01-01 00:00:00' AS updated_at
FROM part""",
    "zipped_csv_rates": f"WITH {DAYS} SELECT {RATES_OUT} FROM rates",
    "wide_csv_rates": f"WITH {DAYS} SELECT {RATES_OUT} FROM rates",
    "sport_property_load": """
SELECT r_name AS sport, CAST(n_nationkey AS INTEGER) AS property_id, CAST(c_custkey AS INTEGER) AS tournament_id, c_name AS tournament
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "key_value_lookup": """
SELECT CAST(o_custkey AS VARCHAR) AS id, CAST(max(o_orderkey) AS VARCHAR) AS name FROM orders GROUP BY o_custkey""",
    "rates_unpivot": f"WITH {DAYS} SELECT {RATES_OUT} FROM rates",
    "rates_of_last_day": f"WITH {DAYS} SELECT {RATES_OUT} FROM rates WHERE d = (SELECT max(d) FROM days)",
    "type_filter": f"WITH {EV} SELECT {FLAT} FROM ev WHERE ta IN ('REGISTER_USER', 'FAILED_LOGIN')",
    "action_filter": f"WITH {EV} SELECT {FLAT} FROM ev WHERE action = 6",
    "valid_sessions": f"WITH {EV} SELECT {FLAT} FROM ev WHERE {VALID}",
    "invalid_sessions": f"WITH {EV} SELECT {FLAT} FROM ev WHERE action IN (2, 3) AND (cid IS NULL OR cid = '')",
    "realm_resolve": f"WITH {RESOLVED} SELECT customer_id, ts, realm, realm_id, name FROM res",
    "realm_resolve_split": f"WITH {RESOLVED} SELECT customer_id, ts, realm, realm_id, name FROM res",
    "missed_realms": f"WITH {EV} SELECT {FLAT} FROM ev WHERE NOT EXISTS (SELECT 1 FROM nation WHERE n_name = realm)",
    "event_metrics": f"""
WITH {RESOLVED}
SELECT count(*) AS total, count(realm_id) AS matched, count(*) FILTER (WHERE realm_id IS NULL) AS missed,
  count(*) FILTER (WHERE cid IS NULL OR cid = '') AS invalid FROM res""",
    "drop_nested_field": """
SELECT event_id, CASE WHEN k % 3 = 0 THEN '[]' ELSE '[{"experiment_id":"e' || (k % 7) || '"}]' END AS experiments,
  'event_name,message_type,role,user_id,product_id,update_interval,event_value,event_cat_sku,longitude,experiments,'
  || 'message_id,provider_message_id,recipient,cmd,status_code,data' AS fields
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
    "tournament_lookup": """
SELECT n_regionkey AS sport_id, n_nationkey AS property_id, c_custkey AS tournament_id, c_name AS name
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "experiment_lookup_default": f"""
WITH {MSG} SELECT event_name, message_type, role, experiment_id, variant_id, count(*) AS n FROM msg GROUP BY ALL""",
    "record_dispatch": f"""
WITH {MSG}
SELECT CASE event_type WHEN 'view' THEN 'video' WHEN 'purchase' THEN 'purchase' WHEN 'signup' THEN 'register'
  ELSE 'other' END AS kind, count(*) AS n FROM msg GROUP BY ALL""",
    "date_bucket_roundtrip": f"""
WITH {RESOLVED}
SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour,
  strftime(ts, '%Y-%m-%d') AS date, realm_id, name, count(*) AS events, CAST(sum(progress) AS BIGINT) AS progress,
  count(ta) AS typed, min(ts) AS first_at, max(ts) AS last_at
FROM res WHERE realm_id IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6, 7""",
    "events_per_date": f"""
WITH {RESOLVED} SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS count FROM res WHERE realm_id IS NOT NULL GROUP BY 1""",
    "high_water_mark": f"""
WITH {RESOLVED}
SELECT coalesce(strftime(max(ts), '%Y/%m/%d'), strftime(current_date - 1, '%Y/%m/%d')) AS day
FROM res WHERE realm_id IS NOT NULL AND ta = 'EVENT_WENT_LIVE'""",
    "event_start": f"""
WITH {RESOLVED} SELECT k AS event_id, realm_id, ts AS start_at FROM res WHERE realm_id IS NOT NULL AND ta = 'EVENT_WENT_LIVE'""",
    "event_finish": f"""
WITH {RESOLVED} SELECT k AS event_id, realm_id, ts AS finish_at FROM res WHERE realm_id IS NOT NULL AND ta = 'EVENT_WENT_NOTLIVE'""",
    "logins": f"""
WITH {RESOLVED}
SELECT realm_id, town, country, client_ip, device, ts, coalesce(ta = 'SUCCESSFUL_LOGIN', false) AS is_success, customer_id
FROM res WHERE realm_id IS NOT NULL AND action = 6""",
    "signups": f"""
WITH {RESOLVED} SELECT realm_id, town, country, ts, device, customer_id
FROM res WHERE realm_id IS NOT NULL AND ta = 'REGISTER_USER'""",
    "live_catalogue": f"""
SELECT n.n_nationkey AS realm_id, p_name AS title, p_partkey AS event_id, CAST(p_size % 5 AS BIGINT) AS sport_id,
  CAST(p_size AS BIGINT) AS tournament_id, CAST(p_size % 10 AS BIGINT) AS property_id, CAST(p_size * 61 AS BIGINT) AS duration, 'thumb-' || p_partkey AS thumbnail_url, p_size % 2 = 0 AS deleted,
  CASE p_size % 2 WHEN 0 THEN 'WHITELIST' ELSE 'BLACKLIST' END AS geo_restriction_type,
  array_to_string(list_sort(['US', p_brand, 'GB']), ',') AS geo_restriction_countries,
  {PART_TS} AS start_at, {PART_TS} + to_seconds(p_size * 61) AS finish_at, {PART_TS} + INTERVAL 1 DAY AS updated_at
FROM part JOIN nation n ON {PART} WHERE p_type IN ('LARGE', 'PROMO')""",
    "vod_catalogue": f"""
SELECT CAST(p_partkey AS INTEGER) AS video_id, CAST(p_partkey AS INTEGER) AS video_dve_id, n.n_nationkey AS realm_id, p_name AS title, p_brand AS description,
  CAST(p_size * 60 AS BIGINT) AS duration, 'http://thumbs.example/' || p_partkey AS thumbnail_url, p_size % 2 = 0 AS deleted,
  p_size % 4 = 0 AS draft, array_to_string(list_sort(list_append(string_split(p_name, ' '), p_type)), ',') AS tags,
  CASE WHEN p_type = 'ECONOMY' THEN {PART_TS} END AS imported_at, {PART_TS} AS updated_at
FROM part JOIN nation n ON {PART} WHERE p_type IN ('ECONOMY', 'SMALL', 'MEDIUM')""",
    "vod_plays": f"WITH {RESOLVED} {_vod('true')}",
    "live_plays": f"WITH {RESOLVED} {_live('true')}",
    "vod_plays_merged": _merged(VOD_PARTS, 2, VOD_KEYS),
    "live_plays_merged": _merged(LIVE_PARTS, 3, LIVE_KEYS),
    "live_plays_recomputed": f"""
SELECT * REPLACE ({SECONDS.format(a="start_at", b="end_at")} AS duration) FROM ({_merged(LIVE_PARTS, 3, LIVE_KEYS)})""",
    "vod_plays_latest": _merged(VOD_PARTS, 2, VOD_KEYS, "WHERE true"),
    "semi_join_sessions": f"""
WITH {RESOLVED}, earlier AS ({VOD_PARTS.format("hour(ts) < 12")}) SELECT * FROM earlier WHERE {_touched(2)}""",
    "semi_join_split": f"""
WITH {RESOLVED}, earlier AS ({VOD_PARTS.format("hour(ts) < 12")}) SELECT * FROM earlier WHERE {_touched(2)}""",
    "aggregate_join_split": """
SELECT event_id, user_id, event_type, count(*) OVER (PARTITION BY user_id) AS events, min(event_id) OVER (PARTITION BY user_id) AS first_event
FROM events""",
    "vod_plays_rejected": f"""
WITH {RESOLVED}
SELECT CASE WHEN {VALID} THEN 'missed' ELSE 'invalid' END AS reason, realm, cid AS session_id, customer_id, ts, progress
FROM res WHERE action = 2 AND (realm_id IS NULL OR NOT ({VALID}))""",
    "job_run_counts": f"""
WITH {RESOLVED}, runs AS (
  SELECT 'logins' AS job, realm_id, true AS valid FROM res WHERE action = 6
  UNION ALL SELECT 'vod_plays', realm_id, {VALID} FROM res WHERE action = 2
  UNION ALL SELECT 'event_times', realm_id, true FROM res WHERE ta IN ('EVENT_WENT_LIVE', 'EVENT_WENT_NOTLIVE')
)
SELECT job, count(*) AS wanted, count(*) FILTER (WHERE valid AND realm_id IS NOT NULL) AS known,
  count(*) FILTER (WHERE valid AND realm_id IS NULL) AS missed, count(*) FILTER (WHERE NOT valid) AS invalid
FROM runs GROUP BY job""",
    "vod_plays_rerun": f"WITH {RESOLVED} {_vod('true')}",
    "vod_plays_by_date": _merged(VOD_PARTS, 2, VOD_KEYS, "WHERE true"),
    "plays_append_after_latest": f"""
{_merged(VOD_PARTS, 2, VOD_KEYS)}
UNION ALL SELECT {VOD_KEYS}, duration, start_at, end_at FROM earlier""",
    "revenue_of_range": _revenue("date_trunc('day', ts)").replace(
        "AND ts IS NOT NULL", "AND ts >= '2024-01-05 00:00:00' AND ts < '2024-01-20 00:00:00'"),
    "session_durations": f"""
WITH {RESOLVED}
SELECT realm_id, cid AS session_id, customer_id, max(progress) AS duration, started_at, min(ts) AS start_at, max(ts) AS end_at, country, town
FROM res WHERE action = 2 AND {VALID} AND realm_id IS NOT NULL GROUP BY realm_id, cid, customer_id, started_at, country, town
UNION ALL
SELECT realm_id, cid, customer_id, {SPAN}, started_at, min(ts), max(ts), country, town
FROM res WHERE action = 3 AND {VALID} AND realm_id IS NOT NULL GROUP BY realm_id, cid, customer_id, started_at, country, town""",
    "payments": f"""
WITH {PAY} SELECT customer_id, realm_id, town, country, ts, payment_provider, amount_with_tax, currency, sku, payment_id FROM pay""",
    "payments_from_buckets": f"""
WITH {PAY} SELECT customer_id, realm_id, town, country, ts, payment_provider, amount_with_tax, currency, sku, payment_id
FROM pay WHERE realm_id IS NOT NULL""",
    "subscriptions": f"""
WITH {PAY} SELECT customer_id, realm_id, town, country, ts, payment_id, is_trial, trial_days, sku, revoked, cancelled FROM pay""",
    "stable_row_id": """
SELECT o_orderkey, o_custkey, o_orderpriority, md5(length(CAST(o_orderkey AS VARCHAR)) || ':' || o_orderkey
  || length(CAST(o_custkey AS VARCHAR)) || ':' || o_custkey || length(o_orderpriority) || ':' || o_orderpriority) AS row_id
FROM orders""",
    "time_range_payments": f"""
WITH {PAY} SELECT realm_id, payment_provider, currency, amount_with_tax, ts FROM pay
WHERE ts >= '2024-01-05 06:00:00' AND ts < '2024-01-20 18:00:00' AND coalesce(amount_with_tax, 0) <> 0""",
    "weekday_asof_rates": f"""
WITH {PAY}, {DAYS}
SELECT payment_id, p.currency, ts, CAST({WEEKDAY.format(ts="ts")} AS VARCHAR) AS rate_date,
  CAST(r.rate * 10000 AS INTEGER) AS rate_e4, CAST(u.rate * 10000 AS INTEGER) AS target_rate_e4
FROM pay p
LEFT JOIN rates r ON r.currency = p.currency AND r.d = {WEEKDAY.format(ts="ts")}
LEFT JOIN rates u ON r.d = u.d AND u.currency = 'USD'""",
    "convert_currency": f"""
WITH {PAY}, {DAYS}, conv AS ({_converted("pay", "amount_with_tax", "USD")})
SELECT payment_id, currency, ts, amount_with_tax, converted AS amount_with_tax_usd FROM conv""",
    "convert_currency_gbp": f"""
WITH {PAY}, {DAYS}, conv AS ({_converted("pay", "amount_with_tax", "GBP")})
SELECT payment_id, currency, ts, amount_with_tax, converted AS amount_with_tax_gbp FROM conv""",
    "revenue_hourly": _revenue("date_trunc('hour', ts)"),
    "revenue_daily": _revenue("date_trunc('day', ts)"),
    "revenue_weekly": _revenue("date_trunc('week', ts)"),
    "revenue_weekly_epoch": _revenue(EPOCH_WEEK, "date_trunc('week', ts)"),
    "revenue_monthly": _revenue("date_trunc('month', ts)"),
    "revenue_cube": f"""
WITH {PAY}, b AS (
  SELECT realm_id, payment_provider, currency, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, amount_with_tax
  FROM pay WHERE coalesce(amount_with_tax, 0) <> 0
)
SELECT realm_id, payment_provider, currency, day AS ts, CAST(sum(amount_with_tax) AS BIGINT) AS amount_with_tax,
  grouping(realm_id, payment_provider, currency, day) AS grouping_id
FROM b GROUP BY CUBE (realm_id, payment_provider, currency, day)""",
    "array_mkstring": """
SELECT p_partkey, array_to_string(list_sort(list_append(string_split(p_name, ' '), p_type)), ',') AS words FROM part""",
    "action_name": f"""
WITH {EV}
SELECT CASE action WHEN 2 THEN 'VOD_PROGRESS' WHEN 3 THEN 'LIVE_WATCHING' WHEN 6 THEN 'USER_SIGN_IN'
  WHEN 7 THEN 'USER_SIGN_UP' WHEN -1 THEN 'OTHER' END AS action, count(*) AS n FROM ev GROUP BY 1""",
    "millis_to_ts": f"WITH {EV} SELECT event_id, CASE WHEN k % 20 <> 2 THEN date_trunc('millisecond', ts) END AS at FROM ev",
    "str_to_map": f"""
WITH {EV} SELECT event_id, CAST(user_id AS VARCHAR) AS id, event_type AS type, CAST(k AS VARCHAR) AS k, 3 AS pairs FROM ev""",
    "word_count": WORDS,
    "pair_count": f"""
WITH {EV} SELECT word, count(*) AS count
FROM (SELECT unnest(['type=' || event_type, 'k=' || k]) AS word FROM ev) GROUP BY word""",
    "first_word_route": f"WITH {ROUTED} SELECT route, payload FROM routed",
    "stream_routes": f"WITH {ROUTED} SELECT route, payload FROM routed",
    "stream_word_count": WORDS,
    "stream_register": f"""
WITH {MSG} SELECT muser AS user_id, ts AS event_datetime, {GEO}, experiment_id, variant_id
FROM msg WHERE event_name = 'REGISTER_SUCCESS'""",
    "stream_purchases": f"""
WITH {MSG} SELECT CAST(round(value) AS INTEGER) AS price, muser AS user_id, 'sku' || (k % 3) AS package_id, ts AS eventtime,
  {GEO}, experiment_id, variant_id
FROM msg WHERE event_name = 'PURCHASE_CONFIRMATION' AND k <> 50""",
    "stream_ratings": f"""
WITH {MSG} SELECT k % 5 + 1 AS rating, muser AS user_id, product_id AS content_id, ts AS event_datetime, {GEO},
  experiment_id, variant_id
FROM msg WHERE event_name = 'STREAM_RATING'""",
    "stream_email_status": f"WITH {MSG} {EMAIL}",
    "stream_video_play": f"WITH {MSG} {WATCH}",
    "stream_fan_out": f"""
WITH {MSG}
SELECT CASE event_type WHEN 'signup' THEN 'register_user' WHEN 'click' THEN 'ratings' WHEN 'error' THEN 'email_status'
  ELSE CASE WHEN k = 50 THEN 'dead purchases' ELSE 'purchases' END END AS target, count(*) AS n
FROM msg WHERE event_type <> 'view' GROUP BY 1
UNION ALL SELECT 'video_play', count(*) FROM ({WATCH})""",
    "stream_batch_counts": "SELECT count(*) AS records FROM events",
    "stream_batch_counts_each": "SELECT CAST((event_id // 20) % 2 AS INTEGER) AS batch_id, count(*) AS n FROM events GROUP BY 1",
    "cumulative_watch_time_folded": f"""
WITH {MSG}, {VIEWING},
parts AS (
  SELECT user_id, content_id, experiment_id, variant_id, CAST(hour(ts) // 4 AS INTEGER) AS batch_id, sum(duration) AS duration, max(ts) AS ts
  FROM viewing GROUP BY ALL
)
SELECT user_id, content_id, experiment_id, variant_id, CAST(sum(duration) OVER earlier AS BIGINT) AS duration,
  max(ts) OVER earlier AS event_datetime, batch_id
FROM parts WINDOW earlier AS (PARTITION BY user_id, content_id, experiment_id, variant_id ORDER BY batch_id)""",
    "cumulative_watch_time": f"""
WITH {MSG}, {VIEWING},
halves AS (
  SELECT user_id, content_id, experiment_id, variant_id, late, sum(duration) AS duration, max(ts) AS ts
  FROM viewing GROUP BY ALL
),
earlier AS (SELECT * FROM halves WHERE NOT late),
later AS (SELECT * FROM halves WHERE late)
SELECT user_id, content_id, experiment_id, variant_id, CAST(duration AS BIGINT) AS duration, ts AS event_datetime, 0 AS batch_id
FROM earlier
UNION ALL
SELECT l.user_id, l.content_id, l.experiment_id, l.variant_id, CAST(l.duration + coalesce(e.duration, 0) AS BIGINT),
  greatest(l.ts, coalesce(e.ts, l.ts)), 1
FROM later l LEFT JOIN earlier e ON l.user_id IS NOT DISTINCT FROM e.user_id AND l.content_id IS NOT DISTINCT FROM e.content_id
  AND l.experiment_id = e.experiment_id AND l.variant_id = e.variant_id""",
    "cumulative_overwrite": f"""
WITH {MSG}, {VIEWING}
SELECT user_id, content_id, experiment_id, variant_id, CAST(sum(duration) AS BIGINT) AS duration FROM viewing GROUP BY ALL""",
    "stream_rewrite": f"""
WITH {MSG}
SELECT muser AS user_id, product_id AS content_id, experiment_id, variant_id, CAST(sum(seconds) AS BIGINT) AS duration
FROM msg WHERE message_type = 'VIDEO_HB' GROUP BY ALL""",
}
