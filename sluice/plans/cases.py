"""Raw messages derived from the ``events`` table, one case of good or bad input per id.

The whole table is used: ``c = event_id % 40`` chooses what the message of an event looks
like (broken JSON, base64, time formats, schema drift, duplicates and so on); it filters
nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.operators.skew import spread

# One text for both engines; {epoch}, {b64} and {events} differ by dialect.
RAW_MESSAGES_SQL = """
WITH b AS (
  SELECT event_id AS n, event_id % 40 AS c, event_type, user_id, value,
         substr(CAST(ts AS STRING), 1, 19) AS t, {epoch} AS es
  FROM {events}),
p AS (
  SELECT n, c, t, es, event_type,
    '{{"visit_id": "' || CASE WHEN c = 19 THEN repeat('X', 101) WHEN c = 20 THEN ''
                             ELSE 'VIS-' || CAST(n AS STRING) END
    || '", "page": ' || CASE WHEN c = 18 THEN 'null'
                             ELSE '"Page ' || CAST(user_id AS STRING) || '"' END
    || ', "referrer": ' || CASE WHEN n % 3 = 0 THEN 'null'
                                ELSE '"Site ' || CAST(n % 7 AS STRING) || '"' END
    || ', "region": "' || CASE user_id % 4 WHEN 0 THEN ' North' WHEN 1 THEN 'south'
                               WHEN 2 THEN 'Mid  West' ELSE 'East' END
    || '", "signed_in": ' || CASE WHEN n % 2 = 0 THEN 'true' ELSE 'false' END
    || ', "millis": ' || CASE WHEN c = 16 THEN '"12"' WHEN c = 17 THEN 'null'
              ELSE CAST(CAST(floor(value * 100) AS BIGINT) * CASE WHEN n % 5 = 0 THEN -1 ELSE 1 END AS STRING) END
    || ', "day": "' || substr(t, 1, 10) || '"'
    || CASE WHEN c = 15 THEN '' ELSE ', "scroll": ' || CAST(n % 60 - 10 AS STRING) END
    || CASE WHEN c = 14 THEN ', "note": "extra"' ELSE '' END || '}}' AS pl
  FROM b),
e AS (
  SELECT n, c, 0 AS copy, t, es, event_type, pl,
    CASE c WHEN 6 THEN '"yesterday"'
           WHEN 7 THEN CAST(es * 1000 AS STRING)
           WHEN 8 THEN '"' || CAST(es * 1000000 AS STRING) || '"'
           WHEN 9 THEN '"' || replace(t, '-', '/') || '"'
           WHEN 10 THEN '"' || t || '"'
           WHEN 11 THEN '"' || replace(t, ' ', 'T') || '+05:30"'
           ELSE '"' || replace(t, ' ', 'T') || 'Z"' END AS ets
  FROM p
  UNION ALL
  SELECT n, c, 1, t, es, event_type, pl,
    '"' || CAST(es + CASE c WHEN 21 THEN -60 WHEN 22 THEN 60 ELSE 0 END AS STRING) || '"'
  FROM p WHERE c IN (21, 22, 23)),
m AS (
  SELECT n, c, copy, es,
    '{{"event_id": "E' || CAST(n AS STRING) || '", "event_type": "' || event_type || '"'
    || CASE WHEN c = 2 THEN '' ELSE ', "event_source": "src' || CAST(n % 3 AS STRING) || '"' END
    || ', "event_ts": ' || ets || ', "payload": '
    || CASE c WHEN 3 THEN '"' || {b64_pl} || '"' WHEN 4 THEN '"oops{{"' WHEN 5 THEN '"[1,2]"'
              WHEN 24 THEN pl ELSE '"' || replace(pl, '"', chr(92) || '"') || '"' END || '}}' AS j
  FROM e)
SELECT n, c, copy,
  CASE c WHEN 0 THEN 'not-json' WHEN 1 THEN {b64_j} ELSE j END AS value,
  es + CASE WHEN c = 12 THEN 300 WHEN c = 13 THEN -5 WHEN c = 11 THEN -19795
            WHEN c = 22 AND copy = 1 THEN 65 ELSE 5 + copy END AS proc_s,
  CAST(n AS STRING) || '-' || CAST(copy AS STRING) AS message_id
FROM m
"""


def spark_raw_sql(view: str) -> str:
    b64 = "regexp_replace(base64(CAST({} AS BINARY)), '[^A-Za-z0-9+/=]', '')"
    return RAW_MESSAGES_SQL.format(
        epoch="unix_seconds(CAST(ts AS TIMESTAMP))", events=view,
        b64_pl=b64.format("pl"), b64_j=b64.format("j"),
    )


def duckdb_raw_sql() -> str:
    return RAW_MESSAGES_SQL.format(
        epoch="CAST(floor(epoch(ts)) AS BIGINT)", events="events",
        b64_pl="to_base64(encode(pl))", b64_j="to_base64(encode(j))",
    )


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    columns = ["event_id", "event_type", "user_id", "value", "ts"]
    spread(events.select(*columns)).createOrReplaceTempView("sluice_events")
    return spark.sql(spark_raw_sql("sluice_events"))


# One JSON value of another type per event id, for the type rules.
MIXED_VALUES_SQL = """
SELECT event_id, event_type, user_id, t, CASE m
    WHEN 0 THEN CAST(event_id AS STRING)
    WHEN 1 THEN '-' || CAST(user_id AS STRING)
    WHEN 2 THEN CAST(user_id AS STRING) || '.5'
    WHEN 3 THEN '"' || CAST(event_id AS STRING) || '"'
    WHEN 4 THEN '" ' || CAST(user_id AS STRING) || ' "'
    WHEN 5 THEN '"' || CAST(user_id AS STRING) || '.5"'
    WHEN 6 THEN '"' || event_type || '"'
    WHEN 7 THEN '"Yes"'
    WHEN 8 THEN '"f"'
    WHEN 9 THEN 'true'
    WHEN 10 THEN 'false'
    WHEN 11 THEN 'null'
    WHEN 12 THEN '""'
    WHEN 13 THEN '"' || substr(t, 1, 10) || '"'
    WHEN 14 THEN '"2024-02-30"'
    WHEN 15 THEN '"' || substr(t, 12, 5) || '"'
    WHEN 16 THEN '"' || replace(t, ' ', 'T') || 'Z"'
    WHEN 17 THEN '"' || replace(t, ' ', 'T') || '+05:30"'
    WHEN 18 THEN '[1,' || CAST(user_id AS STRING) || ']'
    WHEN 19 THEN '{{"a":' || CAST(user_id AS STRING) || '}}'
    WHEN 20 THEN '"1e3"'
    WHEN 21 THEN '0'
    WHEN 22 THEN '"' || substr(t, 12, 2) || '"'
    ELSE CAST(user_id AS STRING) || '.0' END AS v
FROM (SELECT event_id, event_type, user_id, event_id % 24 AS m, substr(CAST(ts AS STRING), 1, 19) AS t
      FROM {events}) x
"""


def mixed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(MIXED_VALUES_SQL.format(events=f"parquet.`{sf_dir}/events.parquet`"))


def duckdb_mixed_sql() -> str:
    return MIXED_VALUES_SQL.format(events="events")
