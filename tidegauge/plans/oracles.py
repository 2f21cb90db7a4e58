"""SQL that each query must agree with, over the same tables.

The common table expressions restate the adapters; each query then says in plain
SQL what its operator must return.
"""

from __future__ import annotations

# --- the adapters in SQL ---------------------------------------------------------

HITS = """
hits AS (
  SELECT *,
    CASE event_type WHEN 'view' THEN 'esn' WHEN 'click' THEN 'api' WHEN 'purchase' THEN 'h5-api'
                    WHEN 'signup' THEN 'm' WHEN 'error' THEN 'openapi' END AS site,
    '10.' || (custkey // 256) || '.' || (custkey % 256) || '.' || (k % 8) AS ip,
    CASE WHEN k % 10 <> 0 THEN CAST(custkey AS VARCHAR) END AS member_id,
    CAST(custkey % 20 AS VARCHAR) AS qz_id,
    CAST(custkey AS VARCHAR) AS user_id,
    k % 25 <> 1 AS has_org,
    k = 99 AS is_lan,
    CASE WHEN k % 17 = 0 THEN '-' ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) END
      AS bytes_sent,
    CASE custkey % 3 WHEN 0 THEN 'android' WHEN 1 THEN 'ios' ELSE '' END AS client,
    CASE custkey % 3 WHEN 0 THEN 'Mozilla/5.0 (Linux; Android 7.0) Mobile'
                     WHEN 1 THEN 'Mozilla/5.0 (iPhone; CPU iPhone OS 10_2) Mobile'
                     ELSE 'Mozilla/5.0 (X11; Linux x86_64)' END AS user_agent,
    CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS second,
    CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS hour,
    CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS day,
    epoch_us(ts) // 1000 AS ms
  FROM (SELECT event_id, ts, event_type, value, user_id AS custkey,
          CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
),
users AS (
  SELECT c_custkey AS custkey, CAST(c_nationkey AS VARCHAR) AS org, n_name AS country,
    r_name AS region, c_mktsegment AS segment, c_acctbal AS balance
  FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN region ON r_regionkey = n_regionkey
),
log AS (
  SELECT h.*, CASE WHEN has_org THEN org END AS instance_id, region
  FROM hits h LEFT JOIN users u USING (custkey)
)"""

AREA = """CASE region WHEN 'AFRICA' THEN 'africa' WHEN 'AMERICA' THEN 'america'
  WHEN 'ASIA' THEN 'asia' WHEN 'EUROPE' THEN 'europe' ELSE 'haiwai' END"""

IDENTIFIED = """identified AS (
  SELECT * FROM log WHERE site <> 'openapi' AND member_id IS NOT NULL AND instance_id IS NOT NULL
)"""

FACTS = """facts AS (
  SELECT DISTINCT CAST(ts AS DATE) AS d, day AS created, member_id, instance_id FROM log
  WHERE site <> 'openapi' AND member_id IS NOT NULL AND instance_id IS NOT NULL
)"""

PAYMENTS = """payments AS (
  SELECT instance_id, day AS start, day + 7 * 86400 AS stop,
    max(CASE WHEN k % 5 = 0 THEN 0.0 ELSE value END) AS total_fee
  FROM log WHERE event_type = 'signup' AND instance_id IS NOT NULL GROUP BY instance_id, day
)"""

AS_OF_EPOCH = 1706572800
PAYING = f"""paying AS (
  SELECT DISTINCT instance_id FROM payments
  WHERE start <= {AS_OF_EPOCH} AND stop >= {AS_OF_EPOCH} AND total_fee > 0
)"""

SCRAMBLE = """xor(((({id}) & 65280) << 8) | ((({id}) & 16711680) >> 8) | (({id}) & 4278190080)
  | ((({id}) & 15) << 4) | ((({id}) & 240) >> 4), 82920181)"""


def _scramble(id_: str) -> str:
    return SCRAMBLE.format(id=f"CAST({id_} AS BIGINT)")


def _descramble(id_: str) -> str:
    x = f"xor(CAST({id_} AS BIGINT), 82920181)"
    return (
        f"((({x} & 65280) << 8) | (({x} & 16711680) >> 8) | ({x} & 4278190080)"
        f" | (({x} & 15) << 4) | (({x} & 240) >> 4))"
    )


# Fields of the raw lines, by the same rules; `variant` marks the broken copies of k = 98.
LINES = f"""
lines AS (
  SELECT *,
    md5(user_id) || left(md5(user_id), 8) AS token,
    left(md5(user_id), 26) AS sess,
    CASE variant WHEN 1 THEN 19 WHEN 2 THEN 18 ELSE 20 END AS n_fields,
    CASE WHEN variant <> 3 THEN second END AS created,
    CASE k % 20
      WHEN 0 THEN '85' WHEN 1 THEN '55' WHEN 2 THEN '25' WHEN 3 THEN '50' WHEN 4 THEN '185'
      WHEN 5 THEN '165' WHEN 6 THEN '900' WHEN 7 THEN CAST(k AS VARCHAR) END AS app_id,
    CASE k % 20 WHEN 9 THEN 'c' || k WHEN 11 THEN 'p' || k END AS r,
    k % 20 IN (9, 10, 11) AS is_page,
    k % 20 IN (12, 13, 14) AS is_static,
    'GET ' || CASE k % 20
      WHEN 0 THEN '/rest/announce/getAnnounceList' WHEN 1 THEN '/rest/message/folderNum'
      WHEN 2 THEN '/rest/schedule/getUnreadList' WHEN 3 THEN '/rest/doc/index'
      WHEN 4 THEN '/rest/talk/getRecentTalkRecord' WHEN 5 THEN '/rest/toutiao/getSubClasses'
      WHEN 6 THEN '/rest/Yyfax/getYyfax.json'
      WHEN 7 THEN '/rest/app/appOauth?app_id=' || k || '&v=1'
      WHEN 8 THEN '/rest/app/appOauth?v=1'
      WHEN 9 THEN '/p/index.htm?r=c' || k WHEN 10 THEN '/p/index.htm?r='
      WHEN 11 THEN '/p/index.htm?x=1&r=p' || k || '&y=2'
      WHEN 12 THEN '/s/app.js' WHEN 13 THEN '/s/site.css?v=2' WHEN 14 THEN '/i/logo.png'
      WHEN 15 THEN '/rest/feed/list?access_token=' || md5(user_id) || left(md5(user_id), 8)
      WHEN 16 THEN '/rest/feed/list?token=' || md5(user_id) || left(md5(user_id), 8)
      WHEN 17 THEN '/rest/feed/list?v=1&token=' || md5(user_id) || left(md5(user_id), 8) || '&w=2'
      WHEN 18 THEN '/rest/feed/list' ELSE '/rest/feed/list?token=a/b' END
      || ' HTTP/1.1' AS request,
    CASE k % 3
      WHEN 0 THEN '{{\\x22v\\x22:\\x221\\x22,\\x22access_token\\x22:\\x22' || md5(user_id)
                  || left(md5(user_id), 8) || '\\x22}}'
      WHEN 1 THEN '-' ELSE '{{\\x22token\\x22:}}' END AS request_args,
    CASE WHEN variant IN (1, 2) THEN NULL
      WHEN site = 'esn' AND k % 7 <> 6
        THEN 'PHPSESSID=' || left(md5(user_id), 26) || '; path=/'
      WHEN site = 'openapi' THEN '"qz_id=' || {_scramble("custkey % 20")}
        || '&instance_id=' || {_scramble("k")}
        || CASE WHEN k % 9 = 4 THEN '' WHEN k % 9 = 5 THEN '&member_id=12a'
             ELSE '&member_id=' || {_scramble("custkey")} END || '"'
      ELSE '-' END AS cookie
  FROM (SELECT *, unnest(CASE WHEN k = 98 THEN [0, 1, 2, 3] ELSE [0] END) AS variant FROM log)
),
tokens AS (
  SELECT *,
    CASE WHEN k % 3 = 0 THEN token END AS by_args,
    CASE WHEN k % 20 = 15 THEN token END AS by_access,
    CASE WHEN k % 20 IN (16, 17) THEN token WHEN k % 20 = 19 THEN 'a/b' END AS by_token
  FROM lines
),
used AS (
  SELECT *, CASE WHEN any_token NOT LIKE '%/%' THEN any_token END AS used_token
  FROM (SELECT *, coalesce(by_args, CASE WHEN site = 'api' THEN by_access ELSE by_token END)
          AS any_token FROM tokens)
)"""

# The reference filter restated on the known fields of a line.
WANTED = """is_page OR (n_fields = 20 AND NOT is_static AND CASE
  WHEN site = 'esn' THEN k % 7 <> 6
  WHEN site = 'openapi' THEN TRUE
  ELSE k % 3 <> 1 OR k % 20 IN (15, 16, 17, 19) END)"""

KNOWN = """
known AS (
  SELECT u.event_id, u.custkey, u.k, u.variant, u.n_fields, u.created, u.ts, u.site, u.ip, u.app_id,
    u.client, u.is_page, u.is_static,
    CASE WHEN open THEN CASE WHEN whole AND k % 9 <> 5 THEN CAST(u.custkey AS VARCHAR) END
         ELSE coalesce(c.c_custkey, t.c_custkey) END AS member_id,
    CASE WHEN open THEN CASE WHEN whole THEN CAST(u.custkey % 20 AS VARCHAR) END
         ELSE CAST(CAST(coalesce(c.c_custkey, t.c_custkey) AS BIGINT) % 20 AS VARCHAR) END AS qz_id,
    CASE WHEN NOT open THEN coalesce(c.c_custkey, t.c_custkey) END AS user_id,
    CASE WHEN open THEN CASE WHEN whole THEN CAST(k AS VARCHAR) END
         ELSE coalesce(c.org, t.org) END AS instance_id
  FROM (SELECT *, site = 'openapi' AND NOT is_page AS open,
          variant NOT IN (1, 2) AND k % 9 <> 4 AS whole FROM used) u
  LEFT JOIN (SELECT CAST(custkey AS VARCHAR) AS c_custkey, org, left(md5(CAST(custkey AS VARCHAR)), 26)
               AS sess FROM users WHERE balance >= 0) c
    ON c.sess = u.sess AND u.site = 'esn' AND NOT u.is_page AND u.cookie LIKE 'PHPSESSID=%'
  LEFT JOIN (SELECT CAST(custkey AS VARCHAR) AS c_custkey, org, md5(CAST(custkey AS VARCHAR))
               || left(md5(CAST(custkey AS VARCHAR)), 8) AS token
             FROM users WHERE segment <> 'BUILDING') t
    ON t.token = u.used_token AND u.site NOT IN ('esn', 'openapi') AND NOT u.is_page
)"""

GEO = """
geo AS (
  SELECT '10.' || (custkey // 256) || '.' || (custkey % 256) || '.' || x AS ip,
    CASE WHEN x = 6 THEN '局域网' ELSE country END AS country, region, segment AS city
  FROM (SELECT *, unnest([0, 1, 2, 3, 4, 5, 6]) AS x FROM users)
)"""

APP_EVENTS = """
vevents AS (
  SELECT *, CASE WHEN k % 10 = 3 THEN '-' || k ELSE CAST(k AS VARCHAR) END AS raw_app,
    CASE WHEN has_org THEN CAST(custkey % 25 AS VARCHAR) END AS v_org,
    CAST(k % 7 AS VARCHAR) AS object_id
  FROM hits
),
apps AS (
  SELECT CAST(p_partkey AS VARCHAR) AS app, p_name AS name, p_type,
    CASE WHEN p_partkey % 4 = 0 THEN '0' ELSE CAST(p_size AS VARCHAR) END AS open_appid
  FROM part WHERE p_partkey % 9 <> 5
),
normal AS (
  SELECT v.*,
    CASE WHEN raw_app LIKE '-%' THEN raw_app ELSE a.open_appid END AS open_appid,
    CASE WHEN raw_app LIKE '-%' THEN 'empty' ELSE a.name END AS name,
    CASE WHEN raw_app LIKE '-%' OR a.open_appid <> '0' THEN '0' ELSE raw_app END AS app_id
  FROM vevents v LEFT JOIN apps a ON a.app = v.raw_app
  WHERE raw_app LIKE '-%' OR a.app IS NOT NULL
),
given AS (
  SELECT CAST(app AS BIGINT) + 1 AS rpid, app AS app_id, open_appid, name FROM apps
  WHERE open_appid = '0' AND p_type = 'ECONOMY'
),
fresh AS (
  SELECT app_id, open_appid, min(name) AS name FROM normal n
  WHERE NOT EXISTS (SELECT 1 FROM given g WHERE g.app_id = n.app_id AND g.open_appid = n.open_appid)
  GROUP BY app_id, open_appid
),
registry AS (
  SELECT * FROM given UNION ALL
  SELECT (SELECT coalesce(max(rpid), 0) FROM given) + row_number() OVER (
      ORDER BY left(md5(app_id || '|' || open_appid), 3), app_id, open_appid),
    app_id, open_appid, name FROM fresh
),
reg AS (
  SELECT n.*, r.rpid FROM normal n JOIN registry r
    ON r.app_id = n.app_id AND r.open_appid = n.open_appid
)"""

ORACLES: dict[str, str] = {}


def _add(name: str, select: str, *tables: str) -> None:
    ORACLES[name] = "WITH " + ",".join((HITS, *tables)) + select


# --- scans and filters ---------------------------------------------------------------

_add(
    "scan_day_range",
    """ SELECT event_id, site, ip, second AS created FROM hits
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-07'""",
)
_add(
    "scan_last_hour",
    """ SELECT event_id, site, ip FROM hits WHERE date_trunc('hour', ts) =
    (SELECT date_trunc('hour', max(ts)) - INTERVAL 1 HOUR FROM events)""",
)
_add(
    "valid_identity",
    " SELECT event_id, member_id, qz_id, user_id, instance_id FROM identified",
    IDENTIFIED,
)
_add("drop_internal", " SELECT event_id, ip, 'public' AS net FROM hits WHERE NOT is_lan")
_add(
    "request_filter",
    f" SELECT event_id AS connection, site, request, n_fields FROM lines WHERE {WANTED}",
    LINES,
)
_add(
    "promo_clicks",
    """ SELECT strftime(ts, '%Y%m%d') AS day, site, r, event_id FROM lines
    WHERE r IS NOT NULL AND n_fields = 20 AND created IS NOT NULL""",
    LINES,
)
PROMO = """ SELECT strftime(ts, '%Y%m%d') AS day, site, r, count(*) AS num FROM lines
  WHERE r IS NOT NULL AND n_fields = 20 AND created IS NOT NULL GROUP BY ALL"""
_add("promo_counts", PROMO, LINES)

# --- parsing and scalars ---------------------------------------------------------------

_add(
    "parse_access_log",
    """ SELECT event_id AS connection, ip AS remote_addr, '192.168.1.' || (custkey % 4) AS server_addr,
      site, k AS connection_requests, k + 100 AS request_length, created, ms AS msec_ms, request,
      request_args, CASE WHEN k % 20 = 0 THEN 404 ELSE 200 END AS status,
      CAST(floor(value * 100) AS BIGINT) AS body_bytes_sent, bytes_sent,
      user_agent AS http_user_agent,
      CASE WHEN variant <> 2 THEN CAST(k AS BIGINT) END AS request_ms_or_null,
      n_fields, cookie, variant FROM lines""",
    LINES,
)
ORACLES["parse_access_log"] = (
    "SELECT * EXCLUDE (request_ms_or_null, cookie, variant),"
    " CAST(connection_requests AS BIGINT) AS request_ms,"
    " CASE WHEN variant <> 2 AND connection_requests % 13 <> 0 THEN CAST(1 AS BIGINT) END"
    " AS upstream_ms,"
    " CASE WHEN variant = 2 THEN '' ELSE cookie END AS sent_http_set_cookie"
    f" FROM ({ORACLES['parse_access_log']})"
)
_add(
    "parse_enriched_log",
    """ SELECT event_id, 27 AS n_fields, site, CASE WHEN is_lan THEN '局域网' ELSE 'public' END
      AS country, CAST(NULL AS VARCHAR) AS region, site AS city, member_id, qz_id, user_id,
      CASE WHEN has_org THEN CAST(k AS VARCHAR) END AS instance_id FROM hits""",
)
_add(
    "extract_token",
    """ SELECT *, session NOT LIKE '%/%' AS usable FROM (
      SELECT event_id, by_args AS args_token, by_access AS access_token, by_token AS token,
        CASE WHEN is_page OR site = 'openapi' THEN NULL
          WHEN site = 'esn' THEN CASE WHEN cookie LIKE 'PHPSESSID=%' THEN 'esn:' || sess END
          ELSE 'api:' || any_token END AS session FROM used)""",
    LINES,
)
_add(
    "extract_session",
    """ SELECT event_id, CASE WHEN cookie LIKE 'PHPSESSID=%' THEN sess END AS session FROM lines""",
    LINES,
)
ORACLES["url_param"] = """SELECT page_id,
  nullif(regexp_extract(url, '^[^?#]*[?](?:[^#]*&)?page=([^&#=]+)', 1), '') AS page,
  nullif(regexp_extract(url, '^[^?#]*[?](?:[^#]*&)?ref=([^&#=]+)', 1), '') AS ref FROM pages"""
_add(
    "openapi_ids",
    """ SELECT event_id, n_fields,
      CASE WHEN whole AND k % 9 <> 5 THEN user_id END AS member_id,
      CASE WHEN whole THEN qz_id END AS qz_id,
      CASE WHEN whole THEN CAST(k AS VARCHAR) END AS instance_id
    FROM (SELECT *, variant NOT IN (1, 2) AND k % 9 <> 4 AS whole FROM lines
          WHERE site = 'openapi')""",
    LINES,
)
ORACLES["id_descramble"] = f"""SELECT event_id,
  CAST({_scramble("event_id")} AS VARCHAR) AS scrambled,
  CAST({_descramble("event_id")} AS VARCHAR) AS descrambled,
  CAST(event_id AS VARCHAR) AS back FROM events"""
_add(
    "regex_extract",
    """ SELECT
      regexp_extract(ip || ' 192.168.1.' || (custkey % 4), '\\b(([01]?\\d?\\d|2[0-4]\\d|25[0-5])\\.)'
        || '{3}([01]?\\d?\\d|2[0-4]\\d|25[0-5])\\b') AS ip,
      CASE WHEN cookie LIKE 'PHPSESSID=%' THEN 'PHPSESSID=' || sess END AS session,
      CASE WHEN k % 20 IN (15, 16, 17) THEN 'token=' || token END AS token FROM lines""",
    LINES,
)
_add("classify_request", " SELECT event_id, request, app_id FROM lines", LINES)
_add("region_code", f" SELECT custkey, region, {AREA} AS code FROM users")
_add("client_class", " SELECT event_id, client FROM hits")
_add(
    "int_or_zero",
    """ SELECT event_id, bytes_sent,
      CASE WHEN bytes_sent = '-' THEN 0 ELSE CAST(bytes_sent AS INTEGER) END AS n FROM hits""",
)
_add(
    "time_buckets",
    """ SELECT event_id, second, hour, day,
      CAST(epoch(date_trunc('week', ts)) AS BIGINT) AS week,
      CAST(epoch(date_trunc('month', ts)) AS BIGINT) AS month,
      CAST(epoch(date_trunc('day', ts + INTERVAL 8 HOUR) - INTERVAL 8 HOUR) AS BIGINT) AS day_shanghai,
      CAST(epoch(date_trunc('month', ts + INTERVAL 8 HOUR) - INTERVAL 8 HOUR) AS BIGINT)
        AS month_shanghai,
      ms, day AS day_of_ms FROM hits""",
)
for _unit in ("week", "month"):
    _add(
        f"{_unit}_start",
        f""" SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day,
          strftime(date_trunc('{_unit}', ts), '%Y-%m-%d') AS start,
          CAST(epoch(date_trunc('{_unit}', ts)) AS BIGINT) AS created FROM hits""",
    )
_add(
    "time_compare",
    """ SELECT event_id, CAST(second < day + 43200 AS INTEGER) AS before_noon,
      CAST(second > day + 43200 AS INTEGER) AS after_noon,
      second - (day + 43200) AS seconds_from_noon,
      strftime(ts, '%Y-%m-%d_%H') AS date_hour FROM hits""",
)
_add(
    "time_format",
    """ SELECT event_id, strftime(ts, '%Y:%m:%d') AS day,
      strftime(ts, '%Y:%m:%d:%H:%M:%S') AS day_time, strftime(ts, '%Y%m%d') AS day_key,
      strftime(ts, '%Y%m%d%H%M') AS minute_key, day AS day_epoch,
      strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS parsed FROM hits""",
)

# --- enrichment ------------------------------------------------------------------------

_add(
    "geo_enrich",
    """ SELECT event_id, ip, country, region, city FROM (SELECT event_id, ip FROM hits)
    LEFT JOIN geo USING (ip) WHERE country IS NULL OR country <> '局域网'""",
    GEO,
)
_add(
    "identity_enrich",
    " SELECT event_id, n_fields, member_id, qz_id, user_id, instance_id FROM known",
    LINES,
    KNOWN,
)
ENRICHED = f"""enriched AS (
  SELECT * FROM (SELECT k1.*, l.wanted FROM known k1 JOIN
            (SELECT event_id, variant, ({WANTED}) AS wanted FROM lines) l
            USING (event_id, variant))
    LEFT JOIN geo USING (ip)
    WHERE wanted AND created IS NOT NULL AND (country IS NULL OR country <> '局域网')
)"""
_add(
    "enriched_log",
    """ SELECT event_id, ip, country, member_id, qz_id, user_id, instance_id, created
    FROM enriched""",
    LINES,
    KNOWN,
    GEO,
    ENRICHED,
)
_add(
    "stream_access_log",
    f""" SELECT dt, region, num, archived, identified FROM
      (SELECT strftime(ts, '%Y-%m-%d') AS dt, {AREA} AS region, count(*) AS num FROM enriched
       WHERE site <> 'openapi' GROUP BY 1, 2)
    JOIN (SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS archived,
            count(*) FILTER (member_id IS NOT NULL AND qz_id IS NOT NULL AND user_id IS NOT NULL
                             AND instance_id IS NOT NULL) AS identified
          FROM enriched WHERE site <> 'openapi' GROUP BY 1) USING (dt)""",
    LINES,
    KNOWN,
    GEO,
    ENRICHED,
)
_add(
    "stream_app_events",
    """ SELECT strftime(ts, '%Y-%m-%d') AS dt, event_type AS action, count(*) AS num
    FROM hits GROUP BY ALL""",
)
_add(
    "stream_behaviour",
    """ SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS num, max(ms) AS last_ms
    FROM hits GROUP BY ALL""",
)
_add(
    "derive_clicks",
    """ SELECT '_click' AS action, app_id, client, ip AS client_ip, '' AS device_model,
      '' AS device_name, instance_id, member_id, CAST(created * 1000 AS VARCHAR) AS mtime, qz_id,
      user_id, '' AS ver_code
    FROM known WHERE site <> 'openapi' AND member_id IS NOT NULL AND instance_id IS NOT NULL
      AND app_id IS NOT NULL AND created IS NOT NULL""",
    LINES,
    KNOWN,
)
_add(
    "lookup_json",
    """ SELECT event_id, CASE WHEN ok THEN member_id END AS member_id,
      CASE WHEN ok THEN qz_id END AS qz_id, CASE WHEN ok THEN user_id END AS user_id,
      CASE WHEN ok THEN site END AS instance_id, CASE WHEN ok THEN ip END AS geo_ip,
      CASE WHEN ok THEN CASE WHEN is_lan THEN '局域网' ELSE 'public' END END AS country,
      CASE WHEN ok THEN site END AS region, CAST(NULL AS VARCHAR) AS city,
      CASE WHEN ok THEN CAST(k AS VARCHAR) END AS open_appid,
      CASE WHEN ok THEN event_type END AS name
    FROM (SELECT *, k % 6 <> 0 AS ok FROM hits)""",
)

# --- page views, visitors, addresses ------------------------------------------------------

PV = f""" SELECT second AS created, {AREA} AS region, count(*) AS num FROM log
  WHERE site <> 'openapi' AND NOT is_lan GROUP BY 1, 2"""
_add("pv_second_region", PV)


def _wide(created: str) -> str:
    counters = ", ".join(
        f"count(*) FILTER (code = '{c}') AS {c}"
        for c in ("haiwai", "africa", "america", "asia", "europe")
    )
    return f""" SELECT 'all' AS client_type, {created} AS created, {counters}
      FROM (SELECT *, {AREA} AS code FROM log WHERE site <> 'openapi' AND NOT is_lan) GROUP BY 2"""


_add("pv_region_pivot", _wide("second"))
_add("upsert_additive", _wide("hour"))

for _unit, _type in (("day", "1day"), ("hour", "1hour")):
    _add(
        f"uv_{_unit}",
        f""" SELECT '{_type}' AS type, 'all' AS client_type, {_unit} AS created,
          count(DISTINCT member_id) AS num FROM identified GROUP BY {_unit}""",
        IDENTIFIED,
    )
    _add(
        f"ev_{_unit}",
        f""" SELECT '{_type}' AS type, {_unit} AS created, count(DISTINCT instance_id) AS num
          FROM identified GROUP BY {_unit}""",
        IDENTIFIED,
    )
    _add(
        f"enterprise_{_unit}",
        f""" SELECT '{_type}' AS type, {_unit} AS created, instance_id,
          count(DISTINCT member_id) AS uv, count(*) AS pv
          FROM identified GROUP BY {_unit}, instance_id""",
        IDENTIFIED,
    )
_add(
    "ipv_day",
    """ SELECT '1day' AS type, 'all' AS client_type, day AS created, count(DISTINCT ip) AS num
    FROM identified GROUP BY day""",
    IDENTIFIED,
)
_add(
    "ipv_hour",
    """ SELECT '1hour' AS type, 'all' AS client_type, hour AS created, count(DISTINCT ip) AS num
    FROM hits WHERE site <> 'openapi' GROUP BY hour""",
)
for _name, _value in (("uv", "member_id"), ("ipv", "ip")):
    _add(
        f"{_name}_day_hour_union",
        f""" SELECT '1day' AS type, day AS created, count(DISTINCT {_value}) AS num FROM hits
          WHERE site <> 'openapi' AND {_value} IS NOT NULL GROUP BY day
        UNION ALL SELECT '1hour', hour, count(DISTINCT {_value}) FROM hits
          WHERE site <> 'openapi' AND {_value} IS NOT NULL GROUP BY hour""",
    )

# --- sites, members -------------------------------------------------------------------------

SITE = """SELECT '1day' AS type, site, day AS created, count(DISTINCT member_id) AS uv,
  count(*) AS pv, count(DISTINCT ip) AS ipv,
  CAST(sum(CASE WHEN bytes_sent = '-' THEN 0 ELSE CAST(bytes_sent AS BIGINT) END) AS BIGINT)
    AS traffic FROM hits"""
_add("site_day", f" {SITE} GROUP BY site, day")
_add("upsert_replace", f" {SITE} GROUP BY site, day")
_add(
    "member_visits",
    """ SELECT day AS created, qz_id, member_id, count(*) AS times FROM hits
    WHERE member_id IS NOT NULL GROUP BY ALL""",
)

# --- key sets, weeks and months ------------------------------------------------------------

_add(
    "daily_distinct_fact",
    " SELECT strftime(d, '%Y-%m-%d') AS day, member_id, instance_id FROM facts",
    FACTS,
)
for _unit, _type in (("week", "thisweek"), ("month", "thismonth")):
    _start = f"strftime(date_trunc('{_unit}', d), '%Y-%m-%d') AS period_start"
    for _kind, _ids in (
        ("uv", "member_id"),
        ("ev", "instance_id"),
        ("eu", "instance_id, member_id"),
    ):
        _add(f"{_unit}_keys_{_kind}", f" SELECT DISTINCT {_start}, {_ids} FROM facts", FACTS)
        _add(
            f"{_unit}_{_kind}_so_far",
            f""" SELECT strftime(date_trunc('{_unit}', a.d), '%Y-%m-%d') AS period_start,
              strftime(a.d, '%Y-%m-%d') AS day, count(DISTINCT ({_ids})) AS num
            FROM (SELECT DISTINCT d FROM facts) a JOIN facts f
              ON f.d <= a.d AND date_trunc('{_unit}', f.d) = date_trunc('{_unit}', a.d) GROUP BY a.d""",
            FACTS,
        )
    for _metric, _value, _clients in (
        ("uv", "member_id", "'all' AS client_type, "),
        ("ev", "instance_id", ""),
    ):
        _counted = f"""{_start}, CAST({AS_OF_EPOCH} AS BIGINT) AS created,
          count(DISTINCT {_value}) AS num FROM facts"""
        _add(
            f"{_metric}_{_unit}",
            f" SELECT '{_type}' AS type, {_clients}{_counted} GROUP BY ALL",
            FACTS,
        )
        _add(
            f"paid_{_metric}_{_unit}",
            f""" SELECT '{_type}' AS type, {_counted}
            WHERE instance_id IN (SELECT instance_id FROM paying) GROUP BY ALL""",
            FACTS,
            PAYMENTS,
            PAYING,
        )
_add(
    "incremental_distinct",
    """ SELECT DISTINCT strftime(date_trunc('month', d), '%Y-%m-%d') AS period_start,
    instance_id, member_id FROM facts""",
    FACTS,
)
ORACLES["incremental_append"] = ORACLES["incremental_distinct"]

# --- paying enterprises -----------------------------------------------------------------------

_add("paid_enterprises_asof", " SELECT instance_id FROM paying", PAYMENTS, PAYING)
_add(
    "paid_semi_join",
    """ SELECT strftime(d, '%Y-%m-%d') AS day, member_id, instance_id FROM facts
    WHERE instance_id IN (SELECT instance_id FROM paying)""",
    FACTS,
    PAYMENTS,
    PAYING,
)
PAID_ROWS = """paid_rows AS (
  SELECT * FROM facts f WHERE EXISTS (SELECT 1 FROM payments p
    WHERE p.instance_id = f.instance_id AND p.start <= f.created AND p.stop >= f.created
      AND p.total_fee > 0)
)"""
_add(
    "paid_semi_join_range",
    " SELECT created, instance_id, member_id FROM paid_rows",
    FACTS,
    PAYMENTS,
    PAID_ROWS,
)
for _metric, _value in (("ev", "instance_id"), ("uv", "member_id")):
    _add(
        f"paid_{_metric}_day",
        f""" SELECT '1day' AS type, created, count(DISTINCT {_value}) AS num FROM paid_rows
        GROUP BY created""",
        FACTS,
        PAYMENTS,
        PAID_ROWS,
    )

# --- app events ---------------------------------------------------------------------------------

_add(
    "json_events",
    """ SELECT CAST(event_id AS VARCHAR) AS event_id, event_type AS action, raw_app AS app_id,
      CAST(NULL AS VARCHAR) AS client, ip AS client_ip, member_id, qz_id, user_id,
      v_org AS instance_id, CAST(ms AS VARCHAR) AS mtime, object_id, day AS created FROM vevents""",
    APP_EVENTS,
)
_add(
    "behaviour_events",
    " SELECT ms AS mtime, day AS created, event_type AS action FROM hits",
)
_add(
    "app_normalize",
    """ SELECT CAST(event_id AS VARCHAR) AS event_id, event_type AS action, app_id, open_appid, name
    FROM normal""",
    APP_EVENTS,
)
_add("app_surrogate_key", " SELECT rpid, app_id, open_appid, name FROM registry", APP_EVENTS)
_add(
    "app_action_day",
    """ SELECT day AS created, rpid, event_type AS action, count(DISTINCT v_org) AS enterprise_num,
      count(DISTINCT qz_id) AS space_num, count(DISTINCT member_id) AS member_num, count(*) AS num
    FROM reg GROUP BY day, rpid, event_type""",
    APP_EVENTS,
)
_add(
    "app_enterprise_day",
    """ SELECT day AS created, rpid, event_type AS action, v_org AS instance_id,
      count(DISTINCT member_id) AS member_num, count(*) AS num
    FROM reg WHERE v_org IS NOT NULL GROUP BY day, rpid, event_type, v_org""",
    APP_EVENTS,
)
_add(
    "app_space_day",
    """ SELECT day AS created, rpid, event_type AS action, qz_id,
      count(DISTINCT member_id) AS member_num, count(*) AS num
    FROM reg GROUP BY day, rpid, event_type, qz_id""",
    APP_EVENTS,
)
_add(
    "cohort_app_pv_uv",
    """ SELECT day AS created, open_appid, name, count(DISTINCT member_id) AS uv, count(*) AS pv
    FROM normal WHERE event_type = 'click' AND member_id IN (SELECT member_id FROM hits
      WHERE event_type = 'signup' AND member_id IS NOT NULL AND ts < TIMESTAMP '2024-01-11')
    GROUP BY day, open_appid, name""",
    APP_EVENTS,
)
_add(
    "event_range_counts",
    """ SELECT open_appid, member_id, object_id, count(*) AS num FROM normal
    WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-17'
    GROUP BY open_appid, member_id, object_id""",
    APP_EVENTS,
)
COUNTS = """counts AS (
  SELECT object_id, user_id, event_type AS action, count(*) AS num FROM vevents GROUP BY ALL
)"""
_add(
    "top_keys",
    " SELECT * FROM counts ORDER BY num DESC, object_id, user_id, action LIMIT 50",
    APP_EVENTS,
    COUNTS,
)
_add("repeat_keys", " SELECT * FROM counts WHERE num > 1", APP_EVENTS, COUNTS)
_add("repeat_key_count", " SELECT count(*) AS num FROM counts WHERE num > 1", APP_EVENTS, COUNTS)

# --- streams: the same as their batch twins ----------------------------------------------------

ORACLES["stream_pv"] = ORACLES["pv_second_region"]
ORACLES["stream_promo"] = ORACLES["promo_counts"]
_add(
    "stream_uv",
    """ SELECT hour AS created, count(DISTINCT member_id) AS num FROM hits
    WHERE site <> 'openapi' AND member_id IS NOT NULL GROUP BY hour""",
)
_add(
    "stream_archive",
    """ SELECT strftime(ts, '%Y-%m-%d') AS dt, site, count(*) AS archived, count(*) AS num
    FROM hits GROUP BY ALL""",
)
ORACLES["word_count"] = """SELECT word, count(*) AS num FROM
  (SELECT unnest(string_split_regex(text, '[ \\n]+')) AS word FROM documents)
  WHERE word <> '' GROUP BY word"""
ORACLES["word_count_stream"] = ORACLES["word_count"]
