"""Registered queries against their SQL on the smallest scale.

``check.py`` does the same for every query at any scale; the slow whole-job queries are left
to it and to test_jobs.
"""

import sys

import duckdb
import pytest

import check
from sluice.plans import catalog, oracles

SLOW = {
    "final_rows", "derived_schema", "dlq_union", "topic_write", "event_counters", "dashboard_series", "alert_breaches",
    "backfill_run", "stream_dedup", "streaming_run", "stream_source", "stream_windows", "batch_dedup",
    "batch_dedup_dropped", "validate_all", "dlq_replay", "configured_alerts", "stream_counters",
}
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in check.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(catalog.all_queries()) == set(oracles.oracle_sql())


@pytest.mark.parametrize("name", sorted(set(catalog.all_queries()) - SLOW))
def test_query_equals_sql(spark, con, name):
    df = catalog.all_queries()[name](spark, SF)
    got = [r.asDict() for r in df.collect()]
    cur = con.execute(oracles.oracle_sql()[name])
    cols = sorted(d[0] for d in cur.description)
    index = [[d[0] for d in cur.description].index(c) for c in cols]
    want = sorted(tuple(check.norm(r[i]) for i in index) for r in cur.fetchall())
    assert sorted(df.columns) == cols
    assert sorted(tuple(check.norm(r[c]) for c in cols) for r in got) == want and want
