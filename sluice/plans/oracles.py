"""Plain SQL for the registered queries, written for DuckDB and independent of the engine."""

from __future__ import annotations

from sluice.plans.cases import duckdb_mixed_sql, duckdb_raw_sql
from sluice.plans.sample_config import EXPECTED_SCHEMA

_TEMPORAL = "'date','time','datetime','timestamp'"


def _b64_json(x: str) -> str:
    return (
        f"CASE WHEN json_valid({x}) THEN {x} "
        f"WHEN regexp_full_match({x}, '[A-Za-z0-9+/]+={{0,2}}') AND length({x}) % 4 = 0 "
        f"THEN decode(from_base64({x})) END"
    )


def _string_kind(x: str) -> str:
    s = f"trim({x})"
    date_ok = f"TRY_CAST(substr({s}, 1, 10) AS DATE) IS NOT NULL"
    clock = r"([01]\d|2[0-3])(:[0-5]\d(:[0-5]\d(\.\d{3}|\.\d{6})?)?)?"
    zone = r"([+-]\d{2}:\d{2}|Z)"
    date = r"\d{4}-\d{2}-\d{2}"
    return (
        f"CASE WHEN regexp_full_match({s}, '{date}T{clock}{zone}') AND {date_ok} THEN 'timestamp' "
        f"WHEN regexp_full_match({s}, '{date}T{clock}') AND {date_ok} THEN 'datetime' "
        f"WHEN regexp_full_match({s}, '{date}') AND {date_ok} THEN 'date' "
        rf"WHEN regexp_full_match({s}, '{clock}([+-]\d{{2}}:\d{{2}})?') THEN 'time' ELSE 'string' END"
    )


def _kind(j: str) -> str:
    return (
        f"CASE json_type({j}) WHEN 'NULL' THEN 'null' WHEN 'VARCHAR' THEN {_string_kind(f'({j})->>$$$$$')} "
        f"WHEN 'BOOLEAN' THEN 'boolean' WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer' "
        f"WHEN 'DOUBLE' THEN 'float' WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' END"
    ).replace("$$$$$", "'$'")


def _micros(s: str, numeric: str) -> str:
    """Event time in microseconds from a trimmed text; ``numeric`` tells if text may be a number."""
    num = f"CAST({s} AS DOUBLE)"
    base = f"epoch_us(TRY_CAST(replace(replace(substr({s}, 1, 19), 'T', ' '), '/', '-') AS TIMESTAMP))"
    minutes = (
        f"CASE WHEN regexp_matches({s}, '[+-]\\d{{2}}:\\d{{2}}$') THEN "
        f"(CASE WHEN substr({s}, -6, 1) = '-' THEN -1 ELSE 1 END) * "
        f"(CAST(substr({s}, -5, 2) AS BIGINT) * 60 + CAST(substr({s}, -2, 2) AS BIGINT)) ELSE 0 END"
    )
    return (
        f"CASE WHEN {numeric} AND regexp_full_match({s}, '[+-]?[0-9]+(\\.[0-9]*)?([eE][+-]?[0-9]+)?') THEN "
        f"CAST(round(CASE WHEN abs({num}) >= 1e14 THEN {num} WHEN abs({num}) >= 1e11 THEN {num} * 1e3 "
        f"ELSE {num} * 1e6 END) AS BIGINT) "
        f"WHEN regexp_full_match({s}, '\\d{{4}}-\\d{{2}}-\\d{{2}}([T ]\\d{{2}}:\\d{{2}}:\\d{{2}}(Z|[+-]\\d{{2}}:\\d{{2}})?)?') "
        f"OR regexp_full_match({s}, '\\d{{4}}/\\d{{2}}/\\d{{2}}( \\d{{2}}:\\d{{2}}:\\d{{2}})?') "
        f"THEN {base} - ({minutes}) * 60000000 END"
    )


def _float_sql(x: str) -> str:
    """Seconds as text with at least one decimal."""
    return f"CAST(CAST({x} AS DOUBLE) AS VARCHAR)"


def _expected_values() -> str:
    rows = []
    for path, kind in EXPECTED_SCHEMA.items():
        kinds = set(kind.split("|"))
        if "string" in kinds:
            kinds |= {"date", "time", "datetime", "timestamp"}
        rows += [f"('{path}', '{kind}', '{k}')" for k in sorted(kinds)]
    return ", ".join(rows)


# The chain of stages; each oracle takes what it needs.
_CHAIN = f"""WITH raw AS ({duckdb_raw_sql()}),
dec AS (SELECT *, {_b64_json('value')} AS j0 FROM raw),
jsn AS (SELECT *, CASE WHEN json_valid(j0) THEN CAST(j0 AS JSON) END AS j FROM dec),
env AS (SELECT *,
  CASE WHEN j IS NULL THEN 'PreProcess failed: message is not JSON or base64 of JSON'
       WHEN json_type(j) <> 'OBJECT' THEN 'PreProcess failed: message is not a JSON object'
       WHEN (j->'$.event_id') IS NULL THEN 'PreProcess failed: Missing required field: event_id'
       WHEN (j->'$.event_type') IS NULL THEN 'PreProcess failed: Missing required field: event_type'
       WHEN (j->'$.event_source') IS NULL THEN 'PreProcess failed: Missing required field: event_source'
       WHEN (j->'$.event_ts') IS NULL THEN 'PreProcess failed: Missing required field: event_ts'
       WHEN (j->'$.payload') IS NULL THEN 'PreProcess failed: Missing required field: payload' END AS pre_error,
  j->>'$.event_id' AS event_id, j->>'$.event_type' AS event_type, j->>'$.event_source' AS event_source,
  j->>'$.event_ts' AS event_ts, json_type(j->'$.event_ts') AS ts_type,
  CASE json_type(j->'$.payload') WHEN 'VARCHAR' THEN j->>'$.payload' WHEN 'OBJECT' THEN CAST(j->'$.payload' AS VARCHAR) END AS payload_text
  FROM jsn),
pay0 AS (SELECT *, {_b64_json('payload_text')} AS p0 FROM env),
pay AS (SELECT *, CASE WHEN json_valid(p0) THEN CAST(p0 AS JSON) END AS p,
  CASE WHEN pre_error IS NOT NULL THEN NULL
       WHEN payload_text IS NULL THEN 'Payload parsing failed: payload is not a string'
       WHEN p0 IS NULL OR NOT json_valid(p0) THEN 'Payload parsing failed: payload is not JSON or base64 of JSON' END AS parse_error
  FROM pay0),
tim0 AS (SELECT *, trim(event_ts) AS s FROM pay),
tim AS (SELECT *, {_micros('s', "ts_type IN ('VARCHAR','UBIGINT','BIGINT','DOUBLE')")} AS us FROM tim0),
stg1 AS (SELECT *, CASE WHEN pre_error IS NOT NULL THEN 'preprocess' WHEN parse_error IS NOT NULL THEN 'parse'
  WHEN us IS NULL THEN 'event_time' END AS stage1, proc_s - us / 1e6 AS lateness FROM tim),
okt AS (SELECT * FROM stg1 WHERE stage1 IS NULL),
obs AS (
  SELECT message_id, 'event_id' AS path, {_kind("j->'$.event_id'")} AS kind FROM okt
  UNION ALL SELECT message_id, 'event_type', {_kind("j->'$.event_type'")} FROM okt
  UNION ALL SELECT message_id, 'event_source', {_kind("j->'$.event_source'")} FROM okt
  UNION ALL SELECT message_id, 'event_ts', {_kind("j->'$.event_ts'")} FROM okt
  UNION ALL SELECT message_id, 'payload.' || k, {_kind("json_extract(p, '$.' || k)")}
    FROM (SELECT message_id, p, unnest(json_keys(p)) AS k FROM okt WHERE json_type(p) = 'OBJECT')),
expd(path, expected, kind) AS (VALUES {_expected_values()}),
exps AS (SELECT DISTINCT path, expected FROM expd),
new_f AS (SELECT message_id, path FROM obs WHERE path NOT IN (SELECT path FROM exps)),
mis_f AS (SELECT o.message_id, e.path FROM okt o CROSS JOIN exps e
  WHERE NOT EXISTS (SELECT 1 FROM obs b WHERE b.message_id = o.message_id AND b.path = e.path)),
chg_f AS (SELECT o.message_id, o.path, e.expected, o.kind FROM obs o JOIN exps e USING (path)
  WHERE NOT EXISTS (SELECT 1 FROM expd x WHERE x.path = o.path AND x.kind = o.kind)),
grd AS (SELECT o.*,
  o.message_id IN (SELECT message_id FROM chg_f) AS changed_type,
  o.message_id IN (SELECT message_id FROM new_f) OR o.message_id IN (SELECT message_id FROM mis_f) AS drifted
  FROM okt o)"""


def _visit(p: str) -> str:
    """Mapped, defaulted and cast fields of a payload."""
    return f"""{p}->>'$.visit_id' AS visit_id, {p}->>'$.page' AS page,
  CASE WHEN coalesce({p}->>'$.referrer', '') = '' THEN 'direct' ELSE {p}->>'$.referrer' END AS came_from,
  {p}->>'$.region' AS region, CAST({p}->>'$.signed_in' AS BOOLEAN) AS signed_in,
  coalesce(CAST({p}->>'$.millis' AS BIGINT), -1) AS millis, {p}->>'$.day' AS visit_day,
  CAST({p}->>'$.scroll' AS DOUBLE) AS scroll_share"""


# Columns made from mapped ones.
_DERIVED = """CAST(TRY_CAST(visit_day AS DATE) AS VARCHAR) AS day_checked,
  concat_ws(' > ', nullif(came_from, ''), nullif(page, '')) AS step,
  coalesce(millis < 1000 AND NOT signed_in, FALSE) AS bounced,
  CAST(CASE region WHEN ' North' THEN 1 WHEN 'south' THEN 2 ELSE 0 END AS BIGINT) AS zone,
  millis / 1000.0 AS seconds,
  coalesce(CAST(CAST(date_trunc('week', TRY_CAST(visit_day AS DATE)) AS DATE) AS VARCHAR), 'none') AS week,
  CASE WHEN regexp_matches(page, '[0-9]+') THEN regexp_extract(page, '[0-9]+') END AS page_number"""


def _tail(lateness: bool) -> str:
    """Dedup, transform and validation, with or without the lateness filter before the guard."""
    late = "(lateness > 120 OR lateness < 0)" if lateness else "FALSE"
    return f""",
g2 AS (SELECT *, CASE WHEN {late} THEN 'late_data' WHEN changed_type THEN 'schema' END AS stage2,
  NOT {late} AND NOT changed_type AND drifted AS traced FROM grd),
ded AS (SELECT *, row_number() OVER w AS rn, first_value(event_ts) OVER w AS kept_ts FROM g2 WHERE stage2 IS NULL
  WINDOW w AS (PARTITION BY event_id ORDER BY us DESC, event_ts DESC, message_id DESC)),
trn AS (SELECT *, {_visit('p')} FROM ded),
fin AS (SELECT *, {_DERIVED},
  CASE WHEN rn > 1 THEN 'dedup'
       WHEN coalesce(visit_id, '') = '' OR length(visit_id) > 64 THEN 'validation' END AS stage3,
  CASE WHEN coalesce(visit_id, '') = '' THEN
         'Missing required payload field: visit_id' || CASE WHEN visit_id = '' THEN '; visit_id below min length' ELSE '' END
       WHEN length(visit_id) > 64 THEN 'visit_id exceeds max length' END AS val_error
  FROM trn)"""


_ROW_ID = "md5('{\"event_id\": \"' || event_id || '\", \"event_ts\": ' || CASE ts_type WHEN 'VARCHAR' THEN '\"' || event_ts || '\"' ELSE event_ts END || '}')"


def _m(body: str) -> str:
    """A query over the mixed values: ``j`` JSON, ``jt`` its type, ``x`` its text."""
    return (
        f"WITH mv AS ({duckdb_mixed_sql()}), m AS (SELECT event_id, event_type, CAST(v AS JSON) AS j, "
        f"json_type(CAST(v AS JSON)) AS jt, CAST(v AS JSON)->>'$' AS x0, trim(CAST(v AS JSON)->>'$') AS x FROM mv) {body}"
    )


_INT = "jt IN ('UBIGINT','BIGINT')"
_CAST_STRING = "CASE jt WHEN 'NULL' THEN NULL WHEN 'BOOLEAN' THEN CASE x0 WHEN 'true' THEN 'True' ELSE 'False' END ELSE x0 END"
_CAST_INTEGER = (
    f"CASE WHEN {_INT} THEN CAST(x AS BIGINT) WHEN jt = 'DOUBLE' THEN CAST(trunc(CAST(x AS DOUBLE)) AS BIGINT) "
    "WHEN jt = 'VARCHAR' AND regexp_full_match(x, '[+-]?[0-9]+') THEN CAST(x AS BIGINT) END"
)
_CAST_FLOAT = (
    f"CASE WHEN {_INT} OR jt = 'DOUBLE' THEN CAST(x AS DOUBLE) "
    "WHEN jt = 'VARCHAR' AND regexp_full_match(x, '[+-]?[0-9]+(\\.[0-9]*)?([eE][+-]?[0-9]+)?') THEN CAST(x AS DOUBLE) END"
)
_CAST_BOOLEAN = (
    f"CASE WHEN {_INT} OR jt = 'DOUBLE' THEN CAST(x AS DOUBLE) <> 0 WHEN jt = 'BOOLEAN' THEN x = 'true' "
    "WHEN jt = 'VARCHAR' AND lower(x) IN ('true','1','yes','y','t') THEN TRUE "
    "WHEN jt = 'VARCHAR' AND lower(x) IN ('false','0','no','n','f') THEN FALSE END"
)
_D = r"\d{4}-\d{2}-\d{2}"
_CAST_DATE = f"CASE WHEN jt = 'VARCHAR' AND regexp_full_match(x, '{_D}') AND TRY_CAST(x AS DATE) IS NOT NULL THEN x END"
_CAST_TIME = (
    r"CASE WHEN jt = 'VARCHAR' AND regexp_full_match(x, '([01]\d|2[0-3])(:[0-5]\d(:[0-5]\d)?)?') "
    "THEN x || substr('00:00:00', length(x) + 1) END"
)
_CAST_DATETIME = (
    f"CASE WHEN jt = 'VARCHAR' AND regexp_matches(x, '^{_D}') AND TRY_CAST(substr(x, 1, 10) AS DATE) IS NOT NULL "
    "THEN CASE WHEN length(x) = 10 THEN x || 'T00:00:00' WHEN x LIKE '%Z' THEN replace(x, 'Z', '+00:00') ELSE x END END"
)
_EMPTY = "(jt = 'NULL' OR (jt = 'VARCHAR' AND x0 = ''))"

_RANGE_US = (1704412800000000, 1705062600000000)


def oracle_sql() -> dict[str, str]:
    batch = _CHAIN + _tail(False)
    live = _CHAIN + _tail(True)
    counters = f"""{live},
all_rows AS (SELECT m.message_id, m.proc_s, coalesce(s.stage1, g.stage2, f.stage3) AS stage, coalesce(g.traced, FALSE) AS traced
  FROM raw m JOIN stg1 s USING (message_id) LEFT JOIN g2 g USING (message_id) LEFT JOIN fin f USING (message_id))"""
    o: dict[str, str] = {}

    o["raw_archive_rows"] = f"""{_CHAIN} SELECT us AS event_us, event_ts AS event_ts_raw, event_id, event_type, event_source,
      'json_event' AS schema_name, 'v2' AS schema_version, payload_text AS raw_payload,
      '{{"message_id":"' || message_id || '"}}' AS pubsub_metadata FROM tim WHERE pre_error IS NULL"""
    o["raw_range_read"] = f"""{_CHAIN} SELECT event_id, event_type, event_source, event_ts, payload_text AS payload
      FROM tim WHERE pre_error IS NULL AND us >= {_RANGE_US[0]} AND us < {_RANGE_US[1]}"""
    o["final_rows"] = f"""{batch} SELECT event_id, event_type, event_source, event_ts, us / 1e6 AS event_timestamp,
      {_ROW_ID} AS row_id, us AS beam_event_time, proc_s * 1000000 AS beam_processing_time, visit_id, page, came_from, region, signed_in,
      millis, visit_day, scroll_share, CAST(day_checked AS DATE) AS day_checked, bounced, zone, seconds, week, step, page_number
      FROM fin WHERE stage3 IS NULL"""
    names = [
        ("event_id", "STRING"), ("event_type", "STRING"), ("event_source", "STRING"), ("event_ts", "STRING"),
        ("event_timestamp", "FLOAT64"), ("row_id", "STRING"), ("beam_event_time", "TIMESTAMP"),
        ("beam_processing_time", "TIMESTAMP"), ("visit_id", "STRING"), ("page", "STRING"), ("came_from", "STRING"),
        ("region", "STRING"), ("signed_in", "BOOL"), ("visit_day", "STRING"), ("millis", "INT64"), ("scroll_share", "FLOAT64"),
        ("day_checked", "DATE"), ("bounced", "BOOLEAN"), ("zone", "INT64"), ("seconds", "FLOAT64"), ("week", "STRING"),
        ("step", "STRING"), ("page_number", "STRING"),
    ]
    o["derived_schema"] = f"""{batch} SELECT v.name, v.position, v.type, 'NULLABLE' AS mode,
      (SELECT count(*) FROM fin WHERE stage3 IS NULL AND (v.name <> 'scroll_share' OR scroll_share IS NOT NULL)) AS filled
      FROM (VALUES {', '.join(f"('{n}', {i}, '{t}')" for i, (n, t) in enumerate(names))}) v(name, position, type)"""
    o["row_id"] = f"{_CHAIN} SELECT n, copy, {_ROW_ID} AS row_id FROM env WHERE pre_error IS NULL"
    letters = f"""{batch},
letters AS (
  SELECT 'preprocess' AS stage, event_id, pre_error AS error, NULL AS reason, substr(value, 1, 500) AS raw, value AS message,
    NULL AS kept_event_ts, NULL AS validation_errors, FALSE AS has_diff, NULL AS event_source FROM env WHERE pre_error IS NOT NULL
  UNION ALL SELECT 'parse', event_id, parse_error, NULL, NULL, NULL, NULL, NULL, FALSE, event_source FROM pay WHERE parse_error IS NOT NULL
  UNION ALL SELECT 'event_time', event_id, 'Unsupported event_ts format', 'event_time_parse_failed', NULL, NULL, NULL, NULL, FALSE, event_source
    FROM stg1 WHERE stage1 = 'event_time'
  UNION ALL SELECT 'schema', event_id, 'Schema policy violation: type_changes', NULL, NULL, NULL, NULL, NULL, TRUE, event_source FROM g2 WHERE stage2 = 'schema'
  UNION ALL SELECT 'schema', event_id, NULL, NULL, NULL, NULL, NULL, NULL, TRUE, NULL FROM g2 WHERE traced
  UNION ALL SELECT 'dedup', event_id, NULL, 'batch_duplicate', NULL, NULL, kept_ts, NULL, FALSE, event_source FROM fin WHERE stage3 = 'dedup'
  UNION ALL SELECT 'validation', event_id, val_error, NULL, NULL, NULL, NULL, '["' || replace(val_error, '; ', '","') || '"]', FALSE, event_source
    FROM fin WHERE stage3 = 'validation')"""
    o["dlq_union"] = f"{letters} SELECT * FROM letters"
    o["topic_write"] = f"{letters} SELECT stage, event_id, error, raw FROM letters WHERE NOT (stage = 'schema' AND error IS NULL)"
    o["dlq_replay"] = f"""{batch}
      SELECT 'preprocess' AS stage, event_id, value AS message, NULL AS event_ts, NULL AS visit_id FROM env WHERE pre_error IS NOT NULL
      UNION ALL SELECT 'parse', event_id, NULL, event_ts, NULL FROM pay WHERE parse_error IS NOT NULL
      UNION ALL SELECT 'event_time', event_id, NULL, event_ts, p->>'$.visit_id' FROM stg1 WHERE stage1 = 'event_time'
      UNION ALL SELECT 'schema', event_id, NULL, event_ts, p->>'$.visit_id' FROM g2 WHERE stage2 = 'schema'
      UNION ALL SELECT stage3, event_id, NULL, event_ts, p->>'$.visit_id' FROM fin WHERE stage3 IS NOT NULL"""
    o["transform_rejects"] = _m(
        "SELECT 'transform' AS stage, CAST(event_id AS VARCHAR) AS event_id, concat('Transformation failed: unhashable type: ', chr(39), "
        "CASE jt WHEN 'ARRAY' THEN 'list' ELSE 'dict' END, chr(39)) AS error, CAST(j AS VARCHAR) AS body FROM m WHERE jt IN ('ARRAY', 'OBJECT')"
    )
    o["merge_into_table"] = """WITH e AS (SELECT CAST(event_id AS VARCHAR) AS id, event_id AS n, event_type, value, ts FROM events)
      SELECT id AS event_id, event_type, CASE WHEN n % 3 = 0 THEN value + 1 ELSE value END AS value,
        CAST(CAST(CASE WHEN n % 3 = 0 THEN ts + INTERVAL 2 DAY ELSE ts END AS DATE) AS VARCHAR) AS event_day FROM e
      UNION ALL SELECT 'n' || id, event_type, value, CAST(CAST(ts AS DATE) AS VARCHAR) FROM e WHERE n % 5 = 0
      UNION ALL SELECT NULL, event_type, value, CAST(CAST(ts AS DATE) AS VARCHAR) FROM e WHERE n % 7 = 0"""
    o["merge_days_searched"] = """WITH e AS (SELECT CAST(ts AS DATE) AS d, day(CAST(ts AS DATE)) % 9 = 4 AND event_id % 50 = 0 AS moved FROM events)
      SELECT CAST(d AS VARCHAR) AS event_day, count(*) FILTER (NOT moved) AS events, bool_or(moved) AS searched
      FROM e GROUP BY d HAVING count(*) FILTER (NOT moved) > 0
      UNION ALL SELECT '2031-01-01', count(*), FALSE FROM e WHERE moved HAVING count(*) > 0"""
    o["compacted_table"] = """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS event_day, event_type, count(*) AS events, max(value) AS largest,
      count(DISTINCT CASE WHEN event_id % 50 >= 48 THEN event_id % 50 ELSE -1 END) AS folders FROM events GROUP BY ALL"""
    o["route_by_type"] = f"{_CHAIN} SELECT event_type, event_id FROM env WHERE pre_error IS NULL"
    o["merge_upsert"] = """SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 3 = 0 THEN 'U' ELSE o_orderstatus END AS o_orderstatus,
      CASE WHEN o_custkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders
      UNION ALL SELECT -c_custkey - 1, c_custkey, 'N', c_acctbal FROM customer"""

    o["decode_messages"] = f"""{_CHAIN} SELECT n, copy, event_id, event_type, event_source, event_ts, payload_text, message_id,
      pre_error AS error FROM env"""
    o["required_fields"] = f"{_CHAIN} SELECT coalesce(pre_error, 'ok') AS outcome, count(*) AS messages FROM env GROUP BY 1"
    o["parse_payload"] = f"""{_CHAIN} SELECT n, copy, p->>'$.visit_id' AS visit_id, TRY_CAST(p->>'$.millis' AS BIGINT) AS millis,
      coalesce(json_type(p) = 'OBJECT', FALSE) AS is_object,
      CASE WHEN pre_error IS NOT NULL THEN 'preprocess' WHEN parse_error IS NOT NULL THEN 'parse' END AS stage,
      coalesce(pre_error, parse_error) AS error FROM pay"""
    o["parse_event_time"] = _m(
        f"""SELECT event_id, {_micros('x', "TRUE")} AS event_us FROM
        (SELECT event_id, CASE WHEN jt IN ('VARCHAR','UBIGINT','BIGINT','DOUBLE') THEN x END AS x FROM m)"""
    )
    o["assign_event_time"] = f"""{_CHAIN} SELECT n, copy, us AS event_us, us / 1e6 AS event_timestamp, stage1 AS stage,
      CASE stage1 WHEN 'event_time' THEN 'Unsupported event_ts format' ELSE coalesce(pre_error, parse_error) END AS error,
      CASE stage1 WHEN 'event_time' THEN 'event_time_parse_failed' END AS reason FROM stg1"""
    late, early = _float_sql("lateness"), _float_sql("-lateness")
    o["late_filter"] = f"""{_CHAIN} SELECT n, copy,
      CASE WHEN lateness > 120 THEN 'Late event dropped (lateness=' || {late} || 's)'
           WHEN lateness < 0 THEN 'Early event (early by ' || {early} || 's)' END AS error,
      CASE WHEN lateness > 120 THEN {late} END AS lateness_seconds,
      CASE WHEN lateness < 0 THEN {early} END AS early_seconds FROM okt"""
    o["event_lag"] = f"""{_CHAIN} SELECT n, copy, CASE WHEN us > 999 THEN proc_s * 1000 - CAST(floor(us / 1000) AS BIGINT) END AS lag_ms
      FROM okt WHERE lateness <= 120 AND lateness >= 0"""

    o["infer_string_type"] = _m(
        f"SELECT event_id, CASE WHEN jt = 'VARCHAR' THEN {_string_kind('x0')} END AS kind FROM m"
    )
    o["infer_value_type"] = _m(f"SELECT event_id, {_kind('j')} AS kind FROM m")
    o["observed_schema"] = f"{_CHAIN} SELECT n, copy, path, kind FROM obs JOIN okt USING (message_id)"
    o["schema_diff"] = f"""{_CHAIN} SELECT n, copy,
      coalesce((SELECT string_agg(path, ',' ORDER BY path) FROM new_f x WHERE x.message_id = okt.message_id), '') AS new_fields,
      coalesce((SELECT string_agg(path, ',' ORDER BY path) FROM mis_f x WHERE x.message_id = okt.message_id), '') AS missing_fields,
      coalesce((SELECT string_agg(path || ':' || expected || '>' || kind, ',' ORDER BY path) FROM chg_f x
                WHERE x.message_id = okt.message_id), '') AS type_changes,
      message_id IN (SELECT message_id FROM new_f UNION SELECT message_id FROM mis_f UNION SELECT message_id FROM chg_f) AS changed
      FROM okt"""
    o["schema_policy"] = f"""{_CHAIN} SELECT n, copy, CASE WHEN changed_type THEN 'Schema policy violation: type_changes' END AS error,
      drifted AND NOT changed_type AS traced, NOT changed_type AS continues FROM grd"""
    o["schema_drift_report"] = f"""{_CHAIN} SELECT kind, path, count(*) AS events FROM (
      SELECT 'new' AS kind, path FROM new_f UNION ALL SELECT 'missing', path FROM mis_f
      UNION ALL SELECT 'type_change', path FROM chg_f) GROUP BY 1, 2"""

    o["batch_dedup"] = f"{batch} SELECT event_id, message_id, event_ts, us AS event_us FROM ded WHERE rn = 1"
    o["batch_dedup_dropped"] = f"""{batch} SELECT event_id, message_id, 'batch_duplicate' AS reason, kept_ts AS kept_event_ts
      FROM ded WHERE rn > 1"""
    window = """SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) * 3600 AS window_start,
      CAST(floor(epoch(ts) / 3600) AS BIGINT) * 3600 + 3600 AS window_end, event_type, count(*) AS events,
      CAST(sum(user_id) AS BIGINT) AS users FROM events GROUP BY ALL"""
    o["tumbling_counts"] = window
    o["stream_windows"] = window

    o["field_mapping"] = f"""{_CHAIN} SELECT n, copy, p->>'$.visit_id' AS visit_id, p->>'$.page' AS page,
      p->>'$.referrer' AS came_from, p->>'$.region' AS region, CAST(p->>'$.signed_in' AS BOOLEAN) AS signed_in,
      CAST(p->>'$.millis' AS BIGINT) AS millis, p->>'$.day' AS visit_day,
      CAST(p->>'$.scroll' AS BIGINT) AS scroll_share, CAST(NULL AS VARCHAR) AS deep, event_source AS source FROM okt"""
    o["null_defaults"] = _m(
        f"SELECT event_id, CASE WHEN {_EMPTY} THEN 'UNKNOWN' ELSE {_CAST_STRING} END AS v, CAST(7 AS BIGINT) AS absent FROM m"
    )
    for name, sql in (
        ("string", _CAST_STRING), ("integer", _CAST_INTEGER), ("float", _CAST_FLOAT), ("boolean", _CAST_BOOLEAN),
        ("date", _CAST_DATE), ("time", _CAST_TIME), ("datetime", _CAST_DATETIME),
    ):
        o[f"cast_{name}"] = _m(f"SELECT event_id, {sql} AS cast_value FROM m")
    o["cast_rules"] = _m(
        f"""SELECT event_id, coalesce({_CAST_INTEGER}, -1) AS as_int, {_CAST_FLOAT} AS as_float,
        coalesce({_CAST_BOOLEAN}, FALSE) AS as_bool, coalesce({_CAST_DATE}, '1970-01-01') AS as_date,
        {_CAST_STRING} AS kept FROM m"""
    )
    o["concatenation"] = """SELECT p_partkey, p_brand || ' / ' || p_type AS label,
      CAST(p_size AS VARCHAR) || '--' || p_brand AS code, 'NA' AS filled FROM part"""
    o["business_rules"] = """SELECT o_orderkey, o_orderpriority = '1-URGENT' AS is_critical,
      o_orderstatus = 'O' AND o_totalprice > 200000 AS is_open_large FROM orders"""
    o["static_lookup"] = """SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' ELSE 'other' END
      AS status_name FROM orders"""
    o["lookup_table"] = """SELECT c_custkey, coalesce(n_name, 'NONE') AS nation_name FROM customer
      LEFT JOIN nation ON c_nationkey = n_nationkey"""
    o["lookup_table_large"] = """SELECT l_orderkey, l_linenumber, coalesce(p_brand, 'NONE') AS brand FROM lineitem
      LEFT JOIN part ON l_partkey = p_partkey"""
    o["range_lookup"] = """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal BETWEEN 0 AND 1000 THEN 'low'
      WHEN c_acctbal BETWEEN 1001 AND 5000 THEN 'mid' WHEN c_acctbal > 5000 THEN 'high' ELSE 'gap' END AS balance_class FROM customer"""
    o["multi_key_lookup"] = """SELECT o_orderkey, CASE lower(o_orderstatus || '|' || o_orderpriority) WHEN 'o|1-urgent' THEN 'rush'
      WHEN 'f|1-urgent' THEN 'done_rush' WHEN 'o|2-high' THEN 'fast' ELSE 'general' END AS queue FROM orders"""
    o["regex_lookup"] = """SELECT p_partkey,
      CASE WHEN regexp_matches(lower(p_type), 'promo|economy') THEN 'cheap' WHEN regexp_matches(p_type, 'BRASS|STEEL') THEN 'metal'
           WHEN lower(p_type) LIKE 's%' THEN 's-type' ELSE 'none' END AS finish_first,
      CASE WHEN lower(p_type) LIKE 's%' THEN 's-type' WHEN regexp_matches(p_type, 'BRASS|STEEL') THEN 'metal'
           WHEN regexp_matches(lower(p_type), 'promo|economy') THEN 'cheap' ELSE 'none' END AS finish_last FROM part"""
    o["conditional_set"] = """SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN 'TIER_1'
      WHEN o_orderpriority = '1-URGENT' THEN 'TIER_2' ELSE 'TIER_3' END AS tier FROM orders"""
    o["derived_fields"] = """SELECT c_custkey, abs(c_acctbal) AS balance, length(c_name) AS name_len,
      CAST(CASE c_mktsegment WHEN 'BUILDING' THEN 3 WHEN 'MACHINERY' THEN 2 ELSE 1 END AS BIGINT) AS segment_rank,
      '1970-01-01' AS never FROM customer"""
    clean = r"trim(regexp_replace(lower(text), '[\s\x0b\x{0085}\x{00a0}\x{2028}\x{2029}\x{2000}-\x{200a}\x{3000}]+', ' ', 'g'))"
    o["normalize_text"] = f"""SELECT doc_id, md5({clean}) AS clean_md5, CAST(length({clean}) AS INTEGER) AS clean_len,
      CASE lang WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' ELSE upper(substr(lang, 1, 1)) || lower(substr(lang, 2)) END AS language
      FROM documents"""

    def entity(pattern: str) -> str:
        return f"CASE WHEN regexp_matches(text, '(?i){pattern}') THEN regexp_extract(text, '(?i){pattern}') END"

    o["entity_extraction"] = (
        f"SELECT doc_id, {entity('[a-z0-9._]+@[a-z0-9]+[.][a-z]+')} AS email, {entity('(?:19|20)[0-9][0-9]')} AS year, "
        f"{entity('(?:license|copyright|password)')} AS keyword FROM documents"
    )
    o["transform_all"] = f"""{_CHAIN}, t AS (SELECT n, copy, {_visit('p')} FROM okt)
      SELECT n, copy, visit_id, came_from, signed_in, millis, scroll_share, {_DERIVED} FROM t"""

    o["validate_required"] = _m(
        f"""SELECT event_id, CASE WHEN {_EMPTY} THEN 'Missing required field: v; Missing required payload field: v; ' ELSE '' END
        || 'Missing required payload field: absent' AS messages FROM m"""
    )
    length = f"length({_CAST_STRING})"
    o["validate_length"] = _m(
        f"""SELECT event_id, concat_ws('; ', CASE WHEN {length} > 5 THEN 'v exceeds max length' END,
        CASE WHEN {length} < 3 THEN 'v below min length' END,
        CASE WHEN {length} <> 4 THEN 'v must be exactly 4 characters' END) AS messages FROM m"""
    )
    o["validate_types"] = _m(
        f"""SELECT event_id, concat_ws('; ', CASE WHEN jt NOT IN ('NULL','VARCHAR') THEN 'v not STRING' END,
        CASE WHEN jt <> 'NULL' AND NOT ({_INT}) AND jt <> 'BOOLEAN' THEN 'v not INTEGER' END,
        CASE WHEN jt NOT IN ('NULL','BOOLEAN') THEN 'v not BOOLEAN' END) AS messages FROM m"""
    )
    o["validate_all"] = f"""{batch} SELECT n, copy, CASE WHEN stage3 = 'validation' THEN val_error END AS error
      FROM fin WHERE stage3 IS NULL OR stage3 = 'validation'"""

    def count(cond: str) -> str:
        return f"count(*) FILTER (WHERE {cond})"

    seen = "stage IS NULL OR stage IN ('dedup','transform','validation')"
    lines = {
        "events_in": "count(*)", "events_out": count("stage IS NULL"),
        "parse_errors": count("stage IN ('preprocess','parse')"), "validation_errors": count("stage = 'validation'"),
        "transform_errors": count("stage = 'transform'"),
        "dlq_events": count("stage IS NOT NULL") + " + " + count("traced"),
        "dedup_seen": count(seen), "dedup_emitted": count("stage IS NULL OR stage IN ('transform','validation')"),
        "dedup_dropped": count("stage = 'dedup'"),
        "evolution_detected": count("stage = 'schema'") + " + " + count("traced"),
        "stage_errors.preprocess": count("stage = 'preprocess'"), "stage_errors.parse": count("stage = 'parse'"),
        "stage_errors.schema": count("stage = 'schema'") + " + " + count("traced"),
        "stage_errors.transform": count("stage = 'transform'"), "stage_errors.validation": count("stage = 'validation'"),
    }
    o["event_counters"] = counters + " " + " UNION ALL ".join(
        f"SELECT '{n}' AS counter, CAST({e} AS BIGINT) AS value FROM all_rows" for n, e in lines.items()
    )
    # Transform and validation come in the second query.
    checks = {
        n: e.replace("stage", "early") for n, e in lines.items()
    }
    o["stream_counters"] = f"""{counters}, early_rows AS (SELECT *, CASE WHEN stage IN ('validation', 'transform') THEN NULL ELSE stage END AS early
      FROM all_rows) """ + " UNION ALL ".join(f"SELECT '{n}' AS counter, CAST({e} AS BIGINT) AS value FROM early_rows" for n, e in checks.items())
    lag = f"""{_CHAIN}, lg AS (SELECT CAST(floor(proc_s / 3600.0) AS BIGINT) * 3600 AS window_start,
      proc_s * 1000 - CAST(floor(us / 1000) AS BIGINT) AS lag FROM okt WHERE lateness <= 120 AND lateness >= 0 AND us > 999)"""
    o["lag_distribution"] = f"""{lag} SELECT window_start, count(*) AS lag_count, CAST(sum(lag) AS BIGINT) AS lag_sum,
      min(lag) AS lag_min, max(lag) AS lag_max FROM lg GROUP BY 1"""
    o["lag_series"] = f"{lag} SELECT window_start, max(lag) AS lag_max, quantile_cont(lag, 0.95) AS lag_p95 FROM lg GROUP BY 1"
    # The exact percentile's place in order, then the middle of the numbers that share its first seven bits.
    at = lambda p: f"max(CASE WHEN rn = (n * {p} + 999) // 1000 THEN mid END)"
    o["stream_lag_percentiles"] = f"""{lag}, srt AS (SELECT window_start, lag, greatest(length(bin(abs(lag))) - 7, 0) AS cut,
        row_number() OVER (PARTITION BY window_start ORDER BY lag) AS rn, count(*) OVER (PARTITION BY window_start) AS n FROM lg),
      mids AS (SELECT window_start, rn, n, sign(lag) * ((abs(lag) // (1::BIGINT << cut)) * (1::BIGINT << cut) + ((1::BIGINT << cut) - 1) / 2.0) AS mid FROM srt)
      SELECT window_start, count(*) AS lag_count, CAST({at(500)} AS DOUBLE) AS lag_p50, CAST({at(950)} AS DOUBLE) AS lag_p95,
        CAST({at(990)} AS DOUBLE) AS lag_p99 FROM mids GROUP BY 1"""
    o["dashboard_series"] = f"""{counters} SELECT CAST(floor(proc_s / 60.0) AS BIGINT) * 60 AS window_start,
      coalesce(stage, 'accepted') AS stage, count(*) AS events FROM all_rows GROUP BY 1, 2"""
    o["alert_breaches"] = f"""{counters},
      ser AS (SELECT CAST(floor(proc_s / 3600.0) AS BIGINT) * 3600 AS ws, count(*) AS events FROM all_rows WHERE stage IS NOT NULL GROUP BY 1),
      ovr AS (SELECT ws, events, ws - 3600 * row_number() OVER (ORDER BY ws) AS grp FROM ser WHERE events > 2)
      SELECT min(ws) AS breach_start, max(ws) + 3600 AS breach_end, count(*) AS windows, max(events) AS peak FROM ovr
      GROUP BY grp HAVING count(*) * 3600 >= 7200"""

    o["configured_alerts"] = f"""{counters},
      pts AS (SELECT 'refused_events' AS alert, 2.0 AS threshold, 7200 AS least, CAST(floor(proc_s / 3600.0) AS BIGINT) * 3600 AS ws,
          CAST(count(*) AS DOUBLE) AS v FROM all_rows WHERE stage IS NOT NULL GROUP BY ALL
        UNION ALL SELECT 'slow_events', 5050.0, 3600, CAST(floor(a.proc_s / 3600.0) AS BIGINT) * 3600,
          avg(CAST(a.proc_s * 1000 - CAST(floor(s.us / 1000) AS BIGINT) AS DOUBLE))
          FROM all_rows a JOIN stg1 s USING (message_id) WHERE a.stage IS NULL AND s.us > 999 GROUP BY ALL),
      ovr AS (SELECT *, ws - 3600 * row_number() OVER (PARTITION BY alert ORDER BY ws) AS grp FROM pts WHERE v > threshold)
      SELECT alert, min(ws) AS breach_start, max(ws) + 3600 AS breach_end, count(*) AS windows, max(v) AS peak FROM ovr
      GROUP BY alert, grp, least HAVING count(*) * 3600 >= least"""
    o["nested_default"] = """SELECT c_custkey, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN 'UNKNOWN' ELSE 'Ulm' END AS city,
      '3' AS geo_zone FROM customer"""
    o["large_key_lookup"] = """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'even' WHEN 1 THEN 'odd' WHEN 3 THEN 'last' ELSE 'none' END
      AS found FROM orders"""
    o["configured_table_lookup"] = """SELECT c_custkey, coalesce(n_name, 'NONE') AS nation FROM customer
      LEFT JOIN nation ON c_nationkey = n_nationkey"""
    o["event_time_check"] = f"""{_CHAIN} SELECT n, copy, CASE WHEN n % 2 = 0 OR json_type(p) <> 'OBJECT'
      THEN 'event_ts is not in a supported timestamp format' END AS message FROM okt"""
    o["source_by_mode"] = f"""{_CHAIN} SELECT event_type, count(*) AS events FROM tim
      WHERE pre_error IS NULL AND us >= {_RANGE_US[0]} AND us < {_RANGE_US[1]} GROUP BY 1"""
    o["letters_target"] = f"""{_CHAIN} SELECT target, 'preprocess' AS stage, pre_error AS error, value AS message
      FROM env, (VALUES ('refused/live'), ('refused/reruns')) t(target) WHERE pre_error IS NOT NULL"""

    # The archive keeps its rows under another position, so ties on equal times are excluded
    # by construction: the time texts of the copies differ.
    o["backfill_run"] = f"""{_CHAIN}, g3 AS (SELECT *, ts_type = 'UBIGINT' AS number_ts FROM grd),
      d3 AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY us DESC, event_ts DESC) AS rn FROM g3
             WHERE NOT changed_type OR (number_ts AND message_id NOT IN (SELECT message_id FROM chg_f WHERE path <> 'event_ts'))),
      t3 AS (SELECT *, {_visit('p')} FROM d3 WHERE rn = 1)
      SELECT event_id, md5('{{"event_id": "' || event_id || '", "event_ts": "' || event_ts || '"}}') AS row_id, visit_id, millis,
      scroll_share, step, week FROM (SELECT *, {_DERIVED} FROM t3)
      WHERE coalesce(visit_id, '') <> '' AND length(visit_id) <= 64"""
    o["stream_letters"] = f"{_CHAIN} SELECT 'preprocess' AS stage, pre_error AS error, value AS message FROM env WHERE pre_error IS NOT NULL"
    # Pending after the first step: the newest event of even number.
    o["stream_state_age"] = """WITH e AS (SELECT user_id, event_id, epoch_us(ts) AS us FROM events),
      u AS (SELECT user_id, max(us) FILTER (event_id % 2 = 0) AS a, max(us) FILTER (event_id % 2 = 1) AS b, count(*) AS n FROM e GROUP BY 1),
      k AS (SELECT *, coalesce(b > a, FALSE) AS newer, coalesce(b > a, FALSE) AND b - a > 86400000000 AS aged FROM u)
      SELECT user_id, greatest(a, b) AS main_us, 1 AS main, (newer AND NOT aged)::INT AS superseded, aged::INT AS expired,
        n - 1 - newer::INT AS dropped FROM k"""
    o["stream_source"] = o["decode_messages"]
    o["stream_dedup"] = f"""{batch} SELECT event_id, us AS event_us, CASE WHEN rn = 1 THEN 'main' ELSE 'not_main' END AS route FROM ded"""
    o["streaming_run"] = f"""{live} SELECT event_id, event_ts, visit_id, millis, step, week, scroll_share,
      {_ROW_ID} AS row_id FROM fin WHERE stage3 IS NULL"""
    return o
