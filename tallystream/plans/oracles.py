"""The same results as SQL over the same tables."""

from __future__ import annotations

_USERS = """
WITH users AS (
  SELECT e.event_id, e.ts, e.event_type,
    concat('user', CAST(e.user_id AS VARCHAR), '@example.com') AS email,
    CASE WHEN e.user_id % 10 = 9 THEN NULL
         WHEN e.user_id % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
    n.n_name AS country,
    concat(CAST(10 + e.user_id % 100 AS VARCHAR), '.', CAST(e.event_id % 256 AS VARCHAR), '.',
           CAST(e.user_id % 256 AS VARCHAR), '.', CAST(e.event_id % 7 AS VARCHAR)) AS ip_address,
    (10 + e.user_id % 100) * 16777216 + (e.event_id % 256) * 65536
      + (e.user_id % 256) * 256 + e.event_id % 7 AS ip,
    time_bucket(INTERVAL 1 DAY, e.ts, TIMESTAMP '1970-01-01') AS window_start
  FROM events e
  LEFT JOIN customer c ON e.user_id = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
texts AS (
  SELECT *, CAST(to_json(struct_pack(email := email, gender := gender,
    country := country, ip_address := ip_address)) AS VARCHAR) AS value
  FROM users
),
flawed AS (
  SELECT * REPLACE (CASE event_type
    WHEN 'error' THEN split_part(value, '"country"', 1)
    WHEN 'signup' THEN replace(value, '"country"', '"nation"')
    ELSE value END AS value),
    CASE event_type WHEN 'error' THEN 'malformed' WHEN 'signup' THEN 'missing:country' END AS reason
  FROM texts
),
ranges AS (
  SELECT (10 + 4 * n_nationkey) * CAST(16777216 AS BIGINT) AS lo,
    (10 + 4 * n_nationkey + 4) * CAST(16777216 AS BIGINT) - 1 AS hi,
    concat('gw', CAST(n_nationkey AS VARCHAR), '.example.net') AS hostname,
    concat('City ', CAST(n_nationkey AS VARCHAR)) AS city,
    r_name AS region, n_name AS country,
    concat(CAST(n_nationkey AS VARCHAR), '.5,-', CAST(n_nationkey AS VARCHAR), '.25') AS loc,
    CAST(10000 + n_nationkey AS VARCHAR) AS postal, concat('Zone/', r_name) AS timezone
  FROM nation JOIN region ON n_regionkey = r_regionkey
  WHERE r_regionkey <> 4
)
"""

_FIELDS = "email, gender, country, ip_address"
_PAIRS = "SELECT CAST(event_id AS VARCHAR) AS key, value FROM texts"

_LOCATED = """
SELECT event_id, email, ip_address, hostname AS geo_hostname, city AS geo_city,
  region AS geo_region, r.country AS geo_country, loc AS geo_loc, postal AS geo_postal,
  timezone AS geo_timezone
FROM users u LEFT JOIN ranges r ON u.ip BETWEEN r.lo AND r.hi
"""

# An IPv4 address (also one inside IPv6) by its first two numbers, an IPv6 one by its third group.
_NETWORKS = """
, located AS (
  SELECT u.event_id, u.email, CASE
      WHEN event_id % 2 = 0 THEN ip_address
      WHEN event_id % 6 = 1 THEN lower(concat('2001:db8:', to_hex(grp), '::', to_hex(event_id % 65536)))
      WHEN event_id % 6 = 3 THEN concat('2001:0DB8:', lpad(to_hex(grp), 4, '0'), ':0000:0000:0000:0000:',
        lpad(to_hex(event_id % 65536), 4, '0'))
      ELSE concat('::ffff:', ip_address) END AS ip_address,
    CASE WHEN six THEN user_id % 40 ELSE user_id % 100 // 4 END AS nation,
    CASE WHEN six THEN event_id % 16 = user_id % 40 % 16
      ELSE user_id % 100 % 4 = 0 AND event_id % 256 = user_id % 100 // 4 END AS near
  FROM (SELECT *, CAST(regexp_extract(email, '[0-9]+') AS BIGINT) AS user_id, event_id % 6 IN (1, 3) AS six,
    CAST(regexp_extract(email, '[0-9]+') AS BIGINT) % 40 * 256 + event_id % 16 AS grp FROM users) u
)
SELECT event_id, email, ip_address,
  CASE WHEN r_regionkey IS NOT NULL THEN concat(CASE WHEN near THEN 'Near ' ELSE 'City ' END, nation) END AS geo_city,
  CASE WHEN r_regionkey IS NOT NULL THEN n_name END AS geo_country
FROM located LEFT JOIN nation ON n_nationkey = nation
  LEFT JOIN region ON n_regionkey = r_regionkey AND r_regionkey <> 4
"""

_SCHEDULE = """
SELECT event_id, TIMESTAMP '2024-01-01' + to_seconds(event_id * 2) AS arrival_ts FROM events
"""


def _of_users(body: str) -> str:
    return f"{_USERS} {body}"


def _count_by(column: str) -> str:
    return _of_users(f"SELECT window_start, {column}, count(*) AS n FROM users GROUP BY ALL")


ORACLES: dict[str, str] = {
    "raw_messages": _of_users(_PAIRS),
    "cast_key_value": _of_users(
        'SELECT CAST(event_id AS VARCHAR) AS key, value, ts AS "timestamp" FROM texts'
    ),
    "decoded_records": _of_users(f"SELECT event_id, ts, {_FIELDS} FROM users"),
    "json_roundtrip": _of_users(_PAIRS),
    "json_file_scan": _of_users(f"SELECT event_id, {_FIELDS} FROM users"),
    "json_array_scan": _of_users(f"""
        SELECT event_id // 1000 AS block,
          row_number() OVER (PARTITION BY event_id // 1000 ORDER BY event_id) - 1 AS position,
          {_FIELDS}
        FROM users"""),
    "json_array_file_scan": _of_users(f"""
        SELECT event_id, row_number() OVER (PARTITION BY event_id // 100000 ORDER BY event_id) - 1 AS position, {_FIELDS}
        FROM users"""),
    "country_kinds": """
        SELECT kind, country, count(*) AS n FROM (
          SELECT ['number', 'string', 'boolean', 'null', 'array', NULL][event_id % 6 + 1] AS kind,
            CASE event_id % 6 WHEN 0 THEN CAST(event_id % 7 AS VARCHAR) WHEN 1 THEN CAST(event_id % 7 AS VARCHAR)
              WHEN 2 THEN 'true' WHEN 4 THEN concat('[', event_id % 7, ']') END AS country
          FROM events)
        GROUP BY ALL""",
    "strict_texts": """
        SELECT CASE WHEN event_id % 6 IN (1, 3) THEN NULL WHEN event_id % 6 = 5 THEN 'missing:country'
          ELSE 'type:country' END AS reason, count(*) AS n
        FROM events GROUP BY ALL""",
    "country_count": _count_by("country"),
    "country_rank": _of_users("""
        SELECT *, row_number() OVER (PARTITION BY window_start
          ORDER BY n DESC, country ASC NULLS LAST) AS rk
        FROM (SELECT window_start, country, count(*) AS n FROM users GROUP BY ALL)"""),
    "email_count": _count_by("email"),
    "email_rank": _of_users("""
        SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY n DESC, email ASC NULLS LAST) AS rk
        FROM (SELECT window_start, email, count(*) AS n FROM users GROUP BY ALL)"""),
    "email_rank_overall": _of_users("""
        SELECT *, row_number() OVER (ORDER BY n DESC, email ASC NULLS LAST) AS rk
        FROM (SELECT email, count(*) AS n FROM users GROUP BY email)"""),
    "gender_count": _count_by("gender"),
    "message_total": _of_users("""
        SELECT window_start, 'message_total' AS label, CAST(sum(n) AS BIGINT) AS n
        FROM (SELECT window_start, email, count(*) AS n FROM users GROUP BY ALL) GROUP BY ALL"""),
    "unique_users": _of_users("""
        SELECT window_start, 'unique_users' AS label, count(DISTINCT email) AS n
        FROM users GROUP BY ALL"""),
    "all_metrics": _of_users("""
        SELECT window_start, 'country' AS metric, country AS group_value, count(*) AS n
        FROM users GROUP BY ALL
        UNION ALL
        SELECT window_start, 'gender', gender, count(*) FROM users GROUP BY ALL
        UNION ALL
        SELECT window_start, 'message_total', NULL, count(*) FROM users GROUP BY window_start"""),
    "quarantine": _of_users(
        "SELECT event_id, value, reason FROM flawed WHERE reason IS NOT NULL"
    ),
    "ip_enrich": _of_users(_LOCATED),
    "ip_enrich_sorted": _of_users(_LOCATED),
    "ip_networks": _of_users(_NETWORKS),
    "ip_networks_shuffled": _of_users(_NETWORKS),
    "lookup_batches": _of_users("""
        SELECT ip_address, concat('net-', split_part(ip_address, '.', 1)) AS hostname, count(*) AS n,
          CAST(1 AS BIGINT) AS asked
        FROM flawed WHERE reason IS NULL GROUP BY ip_address"""),
    "lookup_enrich": _of_users("""
        SELECT event_id, email, ip_address,
          concat('net-', split_part(ip_address, '.', 1)) AS geo_hostname,
          concat('host-', split_part(ip_address, '.', 4)) AS geo_city
        FROM users"""),
    "replay_schedule": _SCHEDULE,
    "replay_ordinal": """
        SELECT event_id, ts, ordinal, TIMESTAMP '2024-01-01' + to_seconds(ordinal * 2) AS arrival_ts
        FROM (SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) - 1 AS ordinal FROM events)""",
    "replay_windows": f"""
        SELECT time_bucket(INTERVAL 10 SECONDS, arrival_ts, TIMESTAMP '1970-01-01') AS window_start,
          count(*) AS n
        FROM ({_SCHEDULE}) GROUP BY ALL""",
    "microbatch_metrics": _of_users("""
        SELECT 'raw_data' AS metric, CAST(NULL AS VARCHAR) AS group_value, count(*) AS n FROM flawed
        UNION ALL
        SELECT 'count_of_country', country, count(*) FROM flawed WHERE reason IS NULL GROUP BY country
        UNION ALL
        SELECT 'gender_count', gender, count(*) FROM flawed WHERE reason IS NULL GROUP BY gender
        UNION ALL
        SELECT 'ip_data', r.country, count(*)
        FROM flawed f LEFT JOIN ranges r ON f.ip BETWEEN r.lo AND r.hi
        WHERE reason IS NULL GROUP BY r.country
        UNION ALL
        SELECT 'quarantine', reason, count(*) FROM flawed WHERE reason IS NOT NULL GROUP BY reason
        UNION ALL
        SELECT 'unique_user', 'message_total', count(*) FROM flawed WHERE reason IS NULL"""),
    "batch_commits": _of_users("""
        SELECT part, metric, rows AS listed, rows AS found FROM (
          SELECT event_id % 4 AS part, count(*) AS raw_data, count(*) FILTER (reason IS NULL) AS ip_data,
            count(reason) AS quarantine, CAST(2 AS BIGINT) AS unique_user,
            count(DISTINCT coalesce(country, '-')) FILTER (reason IS NULL) AS count_of_country,
            count(DISTINCT coalesce(gender, '-')) FILTER (reason IS NULL) AS gender_count
          FROM flawed GROUP BY part)
        UNPIVOT (rows FOR metric IN (raw_data, ip_data, quarantine, unique_user, count_of_country, gender_count))"""),
    "batch_progress": """
        SELECT job, count(*) AS input_rows, CAST(0 AS BIGINT) AS repeated, CAST(0 AS BIGINT) AS missing
        FROM events, (VALUES ('landing'), ('metrics')) AS jobs(job) GROUP BY job""",
    "window_users": _of_users("""
        SELECT window_start, count(DISTINCT email) AS unique_users, count(*) AS message_total
        FROM flawed WHERE reason IS NULL GROUP BY window_start"""),
    "raw_landing": _of_users(_PAIRS),
    "raw_landing_csv": _of_users(_PAIRS),
    "raw_landing_json": _of_users(_PAIRS),
    "raw_landing_orc": _of_users(_PAIRS),
    "raw_landing_text": _of_users("SELECT value FROM texts"),
    "raw_landing_lines": _of_users("SELECT replace(value, ',', concat(',', chr(10))) AS value FROM texts"),
    "chained_unique_users": _of_users("""
        SELECT window_start, count(DISTINCT email) AS unique_users, count(*) AS message_total
        FROM users GROUP BY window_start"""),
}
