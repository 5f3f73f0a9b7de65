"""Key filters, merges that go by them, compaction, and the zone map of the archive."""

import datetime

import pytest
from pyspark.sql import functions as F

from sluice.session import work_dir
from sluice.sources import archive, key_filters, tables

DAY = datetime.timedelta(days=1)
START = datetime.datetime(2024, 3, 1, 12)


def events(spark, n, day=lambda i: i % 10):
    rows = [(f"e{i}" if i % 97 else None, i, START + DAY * day(i) if i % 89 else None) for i in range(n)]
    return spark.createDataFrame(rows, "event_id string, value long, beam_event_time timestamp")


def content(spark, path):
    return sorted(((r.event_id or "", r.value, str(r.event_date)) for r in spark.read.parquet(path).collect()))


def written(spark, name, n=1000):
    path = work_dir(spark, name)
    tables.write_table(events(spark, n), path)
    return path, tables.Folders(spark, path)


def test_a_merge_searches_only_folders_that_may_hold_a_key(spark):
    path, folders = written(spark, "filters")
    names = tables.data_folders(folders, path)
    tables.write_filters(spark, path, names, ["event_id"])
    before = content(spark, path)
    change = spark.createDataFrame([("e13", -1, START + DAY * 20), ("new", -2, START + DAY * 21)], "event_id string, value long, beam_event_time timestamp")
    tables.write_table(change, f"{path}-changes")
    report = tables.merge_into(spark, path, f"{path}-changes")
    assert report.folders == names and report.searched == ["event_date=2024-03-04/batch_id=-1"]
    assert report.days == ["event_date=2024-03-04", "event_date=2024-03-21", "event_date=2024-03-22"]
    want = sorted([r for r in before if r[0] != "e13"] + [("e13", -1, "2024-03-21"), ("new", -2, "2024-03-22")])
    assert content(spark, path) == want
    # The rewritten folders have filters of their own: the same merge looks into its own days only.
    again = tables.merge_into(spark, path, f"{path}-changes")
    assert again.searched == ["event_date=2024-03-21/batch_id=-1", "event_date=2024-03-22/batch_id=-1"]
    assert content(spark, path) == want


def test_a_stale_or_missing_filter_falls_back_to_reading(spark):
    path, folders = written(spark, "stale")
    change = spark.createDataFrame([("e13", -1, START)], "event_id string, value long, beam_event_time timestamp")
    tables.write_table(change, f"{path}-changes")
    names = tables.data_folders(folders, path)
    assert tables.folders_to_search(spark, path, change, ["event_id"])[1] == names
    tables.write_filters(spark, path, names, ["event_id"])
    # A day that is written again has other files, so its filter says nothing any more.
    moved = events(spark, 400, lambda i: 7).filter("value % 97 <> 0")
    tables.write_table(moved, path, batch_id=-1)
    searched = tables.folders_to_search(spark, path, change, ["event_id"])[1]
    assert searched == ["event_date=2024-03-04/batch_id=-1", "event_date=2024-03-08/batch_id=-1", f"event_date={tables.NULL_DAY}/batch_id=-1"]
    report = tables.merge_into(spark, path, f"{path}-changes")
    assert "event_date=2024-03-08" in report.days and [r for r in content(spark, path) if r[0] == "e13"] == [("e13", -1, "2024-03-01")]


def test_null_keys_and_false_positives(spark):
    rows = spark.createDataFrame([(f"k{i}", "a") for i in range(5000)] + [(None, "b")], "k string, folder string")
    stamps = key_filters.stamps_frame(spark, {"a": "1", "b": "2"})
    filters = key_filters.folder_filters(rows, ["k"], F.col("folder"), stamps).cache()
    assert filters.filter("folder = 'a'").first().words == 8192
    absent = spark.range(200_000).select(F.concat(F.lit("x"), "id").alias("k"))
    held = lambda df: sorted(r.folder for r in key_filters.folders_with(filters, df, ["k"]).collect())
    assert held(absent) == [] and held(absent.limit(1).select(F.lit(None).cast("string").alias("k"))) == ["b"]
    for i in range(0, 5000, 500):
        assert held(absent.limit(1).select(F.lit(f"k{i}").alias("k"))) == ["a"]


def batches(spark, name):
    path = work_dir(spark, name)
    for b in range(6):
        tables.write_table(events(spark, 300).filter(F.col("value") % 6 == b), path, batch_id=b)
    return path, tables.Folders(spark, path)


def test_compaction_keeps_rows_and_newest_batches(spark):
    path, folders = batches(spark, "packed")
    before = content(spark, path)
    new = tables.compact(spark, path, ["event_id"])
    assert content(spark, path) == before
    names = tables.data_folders(folders, path)
    assert {n.split("/")[1] for n in names} == {"batch_id=-1", "batch_id=4", "batch_id=5"} and set(new) <= set(names)
    assert tables.compact(spark, path) == [] and folders.names(f"{path}/{tables.MERGES}") == []
    # A replay of the last batch repeats nothing; later batches join what is packed under a free number.
    tables.write_table(events(spark, 300).filter("value % 6 = 5"), path, batch_id=5)
    assert content(spark, path) == before
    tables.compact(spark, path, keep=0)
    assert content(spark, path) == before
    assert {n.split("/")[1] for n in tables.data_folders(folders, path)} == {"batch_id=-2"}


@pytest.mark.parametrize("moves", [0, 1, 5, 30])
def test_a_broken_off_compaction_is_finished(spark, monkeypatch, moves):
    path, folders = batches(spark, "broken")
    before, left = content(spark, path), [moves]
    move = tables.Folders.move

    def breaking(self, source, target):
        if not left[0]:
            raise OSError("lost")
        left[0] -= 1
        move(self, source, target)

    monkeypatch.setattr(tables.Folders, "move", breaking)
    with pytest.raises(OSError, match="lost"):
        tables.compact(spark, path, keep=0)
    monkeypatch.setattr(tables.Folders, "move", move)
    tables.finish_merges(folders, path)
    assert content(spark, path) == before
    assert {n.split("/")[1] for n in tables.data_folders(folders, path)} == {"batch_id=-1"}


def test_bins():
    assert tables.bins({"a": 5, "b": 4, "c": 3, "d": 2, "e": 9}, 7) == [["e"], ["a", "d"], ["b", "c"]]
    assert tables.bins({}, 7) == []


def test_a_range_opens_only_its_files(spark):
    path = work_dir(spark, "zones")

    def rows(days):
        columns = [F.lit(None).cast(t.split()[1]).alias(t.split()[0]) for t in archive.ARCHIVE_SCHEMA.split(", ")]
        df = spark.createDataFrame([(f"d{d}", START + DAY * d if d is not None else None) for d in days], "i string, t timestamp")
        return df.select(*columns, "i", "t").withColumns({"event_id": F.col("i"), "event_ts": F.col("t")}).drop("i", "t")

    read = lambda a, b: archive.read_archive(spark, path, (START + DAY * a).isoformat(), (START + DAY * b).isoformat())
    archive.write_archive(rows([0, 1, 2, None]), path)
    archive.write_archive_batch(rows([2, 3]), path, 0)
    archive.write_archive_batch(rows([9]), path, 0)  # a replay
    archive.write_archive_batch(rows([]), path, 1)
    got = read(2, 3)
    assert sorted(r.event_id for r in got.collect()) == ["d2", "d2"]
    assert len(got.inputFiles()) == 2 and all("event_date=2024-03-03" in f for f in got.inputFiles())
    assert [r.event_id for r in read(3, 30).collect()] == ["d3"] and read(20, 30).collect() == []
    assert read(20, 30).schema.simpleString() == got.schema.simpleString()
    low, high = archive.archive_bounds(spark, path)
    assert (low.replace(tzinfo=None), high.replace(tzinfo=None)) == (START, START + DAY * 3 + datetime.timedelta(microseconds=1))
    # Without a map the archive is listed and pruned by day.
    tables.Folders(spark, path).delete(f"{path}/{archive.ZONES}")
    assert sorted(r.event_id for r in read(2, 3).collect()) == ["d2", "d2"]
    archive.write_archive(rows([5]), path, "overwrite")
    assert [r.event_id for r in read(0, 30).collect()] == ["d5"]


@pytest.mark.parametrize("most", [200_000, 1])
def test_a_lookup_table_with_repeated_keys_multiplies_no_rows(spark, most):
    from sluice.operators.enrich import lookup_table

    table = spark.createDataFrame([("a", "z"), ("a", "b"), ("a", None), ("n", None), (None, "x")], "k string, v string")
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(["a", "a", "n", "c", None])], "i long, k string")
    out = lookup_table(rows, table, "k", "k", "v", "found", ["i"], default="none", max_broadcast=most)
    assert sorted((r.i, r.found) for r in out.select("i", "found").collect() if r.found) == [(0, "b"), (1, "b"), (3, "none"), (4, "none")]
    assert out.count() == 5


def test_lag_percentiles_merge(spark):
    """Any cutting gives the same percentiles, within 1/128 of the exact ones; lags of both signs."""
    import random

    from sluice.operators import metrics

    rng = random.Random(5)
    lags = [rng.choice([-1, 1]) * int(rng.lognormvariate(8, 3)) for _ in range(1500)] + [0, 1, -1, 127, 128, -129, 2**40]
    rows = [(6 * 3600 + n % 2 * 3600, lag) for n, lag in enumerate(lags)]
    df = spark.createDataFrame(rows, "s long, lag long").selectExpr(
        "timestamp_seconds(s) AS beam_processing_time", "timestamp_millis(s * 1000 - lag) AS _event_time",
        "CAST(NULL AS STRUCT<stage: STRING, error: STRING>) AS _reject", "lag",
    ).filter("unix_millis(_event_time) > 0")
    permille = {"p0": 1, "p50": 500, "p95": 950, "p100": 1000}
    whole = metrics.lag_percentiles(metrics.lag_buckets(df, 3600), permille)
    parts = [metrics.lag_buckets(df.filter(f"pmod(lag, 3) = {i}"), 3600) for i in range(3)]
    merged = metrics.lag_percentiles(parts[0].unionByName(parts[1]).unionByName(parts[2]), permille)
    got = sorted(map(tuple, whole.collect()))
    assert got == sorted(map(tuple, merged.collect())) and len(got) == 2
    kept = [(r.s, r.lag) for r in df.selectExpr("unix_seconds(beam_processing_time) AS s", "lag").collect()]
    for start, n, *values in got:
        exact = sorted(lag for s, lag in kept if s == start)
        assert n == len(exact)
        for p, value in zip(permille.values(), values):
            want = exact[-(-n * p // 1000) - 1]
            assert abs(value - want) <= abs(want) / 128
    assert metrics.lag_percentiles(metrics.lag_buckets(df.limit(0), 3600), permille).count() == 0


def test_messages_are_spread_over_tasks(spark, tmp_path):
    """A file of one row group fills every core, and no task gets more than its share."""
    import duckdb

    from sluice.operators.skew import TASK_ROWS, spread
    from sluice.plans.cases import raw_messages

    duckdb.sql(
        "SELECT i AS event_id, TIMESTAMP '2024-01-05 00:00:00' + to_seconds(i % 1000) AS ts, i % 7 AS user_id, 'view' AS event_type, "
        "1.5::DOUBLE AS value, NULL::VARCHAR AS props FROM range(4000) t(i)"
    ).write_parquet(f"{tmp_path}/events.parquet", row_group_size=1_000_000)
    events = spark.read.parquet(f"{tmp_path}/events.parquet")
    cores = spark.sparkContext.defaultParallelism
    per_task = lambda df: sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
    raw = per_task(raw_messages(spark, str(tmp_path)).filter("copy = 0"))
    assert sum(raw) == 4000 and len(raw) == cores and raw[-1] <= 2 * 4000 / cores
    assert spread(events, 300).rdd.getNumPartitions() == max(cores, 14)
    assert spread(events.limit(0)).rdd.getNumPartitions() == cores and TASK_ROWS > 0
