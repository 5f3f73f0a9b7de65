"""Configuration, sinks, merge and the jobs."""

import contextlib
import copy
import datetime
import json
import os
import time
import warnings

import pytest
from pyspark.sql import functions as F

from sluice import config as C
from sluice.operators import decode, route
from sluice.plans.backfill import check_range, run_backfill
from sluice.plans.sample_config import EXPECTED_SCHEMA, sample_config
from sluice.session import WorkFolder, work_dir
from sluice.sources import archive, messages, sink_schema, tables, targets
from sluice.streaming import demo
from sluice.streaming.jobs import StreamingJob

SMALL = "/root/testdata/sf0.001"


def test_example_config_loads():
    folder = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "examples/config")
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        cfg = C.load_config(folder)
    assert cfg.expected_schema == EXPECTED_SCHEMA
    assert any("type check millis" in str(w.message) for w in caught)
    place = lambda mode: targets.letters_target(cfg.destination, cfg.backfill_settings, mode)
    assert place(targets.BACKFILL) == "refused/reruns" and place(targets.STREAMING) == "refused/live"
    assert targets.letters_target(cfg.destination, {}, targets.BACKFILL) == "refused/live"
    with pytest.raises(targets.MissingTarget, match="dlq_topic"):
        targets.letters_target({}, {}, targets.STREAMING)


def test_all_config_problems_are_reported_together(tmp_path):
    (tmp_path / "pipeline.json").write_text(json.dumps(
        {"streaming_tuning": {"dedup": {}, "windowing": {}}, "schema_management": {"enabled": True, "schema_name": "x"}}))
    with pytest.raises(C.ConfigError) as e:
        C.load_config(str(tmp_path))
    for text in ("transformation", "validation", "destination_mapping", "raw_events", "sharding", "batching",
                 "buffer_seconds", "window_size_sec", "schemas/x.json"):
        assert text in str(e.value)


def test_bad_patterns_are_config_errors():
    cfg = copy.deepcopy(sample_config())
    cfg.transformations["entity_extraction"] = [{"field": "f", "entities": [{"name": "n", "pattern": "("}]}]
    with pytest.raises(C.ConfigError, match="bad pattern"):
        C.check_config(cfg)
    cfg.transformations["entity_extraction"] = []
    cfg.transformations["enrichment"].append({"type": "odd"})
    assert any("odd" in w for w in C.config_warnings(cfg))


def test_targets_and_ranges():
    dest = sample_config().destination
    assert targets.live_table(dest) == "web/visits"
    name = targets.rerun_name("2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z")
    assert targets.rerun_table(dest, name) == "web_reruns/visits_20240101T000000Z_20240102T000000Z"
    assert targets.rerun_name("a", "b", "r1") == "r1"
    with pytest.raises(targets.MissingTarget, match="temp_table"):
        targets.rerun_table({"target": {}}, "x")
    cfg = sample_config()
    for start, end in ((None, "2024-01-01"), ("2024-01-02", "2024-01-01"), ("2024-01-01", "2024-03-01")):
        with pytest.raises(ValueError):
            check_range(cfg, start, end)


def test_source_selection(spark):
    with pytest.raises(ValueError, match="subscription"):
        messages.read_source(spark, "streaming")
    with pytest.raises(ValueError, match="start and end"):
        messages.read_source(spark, "backfill")
    with pytest.raises(ValueError, match="Unsupported job_mode"):
        messages.read_source(spark, "other")


def test_derived_schema_precedence():
    got = sink_schema.derive_schema(
        {"envelope_fields": {"stamp": "TIMESTAMP"}},
        {
            "field_mapping": {"a": "payload.a", "b": "payload.b", "c": {"source": "payload.c", "type": "integer"}},
            "type_casts": [{"field": "b", "to": "date"}, {"field": "b", "to": "float", "output_field": "b2"}],
            "business_rules": [{"output_field": "flag"}],
            "enrichment": [{"type": "derived_fields", "output_field": "one"}, {"type": "static_lookup", "output_field": "a"}],
            "concatenations": [{"output_field": "flag", "type": "FLOAT"}],
            "entity_extraction": [{"entities": [{"name": "b2"}]}],
        },
        {"event_ts": "timestamp|null", "payload.a": "null|integer", "payload.zzz": "float"},
    )
    assert got == {
        "event_id": "STRING", "event_type": "STRING", "event_source": "STRING", "event_ts": "TIMESTAMP",
        "event_timestamp": "FLOAT64", "row_id": "STRING", "stamp": "TIMESTAMP", "a": "STRING", "b": "DATE",
        "c": "INT64", "b2": "STRING", "flag": "FLOAT64", "one": "STRING",
    }


def rows_of(spark, items):
    return spark.createDataFrame(
        [(k, v, datetime.datetime(2024, 1, d)) for k, v, d in items], "event_id string, v int, beam_event_time timestamp")


def test_merge_rewrites_only_touched_days(spark):
    root = work_dir(spark, "merge-test")
    target, temp = f"{root}/t", f"{root}/n"
    tables.write_table(rows_of(spark, [("a", 1, 1), ("b", 1, 2), ("c", 1, 3)]), target, batch_id=0)
    tables.write_table(rows_of(spark, [("d", 1, 3)]), target, batch_id=1)
    tables.write_table(rows_of(spark, [("d", 1, 3)]), target, batch_id=1)  # a replay changes nothing
    untouched = {f for f in spark.read.parquet(target).filter("event_id = 'c'").inputFiles() if "01-03" in f}
    # b moves from day 2 to day 4, e is new on day 1.
    tables.write_table(rows_of(spark, [("b", 2, 4), ("e", 2, 1)]), temp)
    tables.merge_into(spark, target, temp)
    got = sorted((r.event_id, r.v, r.event_date.day) for r in spark.read.parquet(target).collect())
    assert got == [("a", 1, 1), ("b", 2, 4), ("c", 1, 3), ("d", 1, 3), ("e", 2, 1)]
    assert untouched <= set(spark.read.parquet(target).inputFiles())
    with pytest.raises(ValueError, match="does not exist"):
        tables.merge_into(spark, f"{root}/gone", temp, fail_if_missing=True)


@pytest.mark.parametrize("fail_at", range(1, 6))
def test_broken_merge_loses_nothing_and_is_finished_later(spark, fail_at, monkeypatch):
    root = work_dir(spark, "merge-crash")
    target, temp = f"{root}/t", f"{root}/n"
    before = [("a", 1, 1), ("b", 1, 2), ("c", 1, 3), (None, 5, 1)]
    tables.write_table(rows_of(spark, before), target, batch_id=0)
    tables.write_table(rows_of(spark, [("b", 2, 4), ("a", 2, 1), (None, 5, 1)]), temp)
    moves, real = [], tables.Folders.move

    def move(self, source, to):
        moves.append(source)
        if len(moves) == fail_at:
            raise OSError("no luck")
        real(self, source, to)

    monkeypatch.setattr(tables.Folders, "move", move)
    with pytest.raises(OSError) if fail_at <= 4 else contextlib.nullcontext():
        tables.merge_into(spark, target, temp)
    monkeypatch.undo()
    assert all(m.startswith(target) for m in moves)
    # A batch that a stream adds meanwhile stays.
    tables.write_table(rows_of(spark, [("z", 9, 2)]), target, batch_id=7)
    tables.merge_into(spark, target, temp)
    got = sorted((str(r.event_id), r.v, r.event_date.day) for r in spark.read.parquet(target).collect())
    assert got == [("None", 5, 1), ("a", 2, 1), ("b", 2, 4), ("c", 1, 3), ("z", 9, 2)]


def test_rename_that_fails_is_an_error(spark, tmp_path):
    folders = tables.Folders(spark, str(tmp_path))
    (tmp_path / "x").mkdir()
    (tmp_path / "y").mkdir()
    with pytest.raises(OSError, match="exists"):
        folders.move(f"{tmp_path}/x", f"{tmp_path}/y")
    with pytest.raises(Exception):
        folders.move(f"{tmp_path}/none", f"{tmp_path}/z")


def test_dead_letters_hold_the_whole_message(spark):
    good = json.dumps({"event_id": "1", "event_type": "t", "event_source": "s", "event_ts": "x" * 2000, "payload": "{}"})
    sent = [b"\xff\xfe" + b"z" * 900, ("no json " * 200).encode(), good.encode()]
    df = spark.createDataFrame([(v, str(i)) for i, v in enumerate(sent)], "value binary, message_id string")
    letters = route.dead_letters(decode.decode_messages(df))
    back = route.replayed_messages(route.read_dead_letters(route.dead_letter_json(letters)))
    assert sorted(bytes(r.value) for r in back.collect()) == sorted(sent[:2])
    assert all(r.raw is None or len(r.raw) == 500 for r in letters.collect())


def test_work_folder_needs_no_setting(spark, tmp_path):
    folder = WorkFolder(spark, "t", below=str(tmp_path))
    assert folder.write(spark.range(3), "x").count() == 3
    folder.close()
    assert not tables.Folders(spark, folder.path).exists(folder.path)


def test_archive_range_prunes_days(spark):
    path = work_dir(spark, "archive-test")
    rows = spark.createDataFrame(
        [(str(i), datetime.datetime(2024, 1, 1 + i, 12)) for i in range(5)] + [("none", None)], "event_id string, event_ts timestamp")
    for c in archive.ARCHIVE_COLUMNS:
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit("x"))
    archive.write_archive(rows, path)
    got = archive.read_archive(spark, path, "2024-01-02T12:00:00Z", "2024-01-04T12:00:00Z")
    assert sorted(r.event_id for r in got.collect()) == ["1", "2"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "GreaterThanOrEqual(event_ts" in plan
    assert got.select("_pos_file", "_pos_row").distinct().count() == 2


def test_backfill_conserves_rows_and_merges(spark):
    from sluice.plans.catalog import _written_archive

    warehouse = work_dir(spark, "wh")
    args = (spark, sample_config(), warehouse, _written_archive(spark, SMALL), "2024-01-01T00:00:00Z", "2024-01-31T00:00:00Z")
    result = run_backfill(*args, run_id="x", merge=True, hot_rows=1)
    c = result.counters
    final, letters = spark.read.parquet(result.table), route.read_dead_letters(spark.read.text(result.dead_letters))
    assert c["events_out"] == final.count() == 775
    assert letters.count() == c["dlq_events"]
    assert c["events_in"] == final.count() + letters.filter("not (stage = 'schema' and error is null)").count()
    target = f"{warehouse}/{targets.live_table(sample_config().destination)}"
    assert spark.read.parquet(target).count() == 775


def test_stream_holds_the_latest_until_quiet(spark):
    from sluice.streaming.jobs import drain
    from sluice.streaming.latest import PACKED, dedup_stream

    path, out = work_dir(spark, "k2-in"), work_dir(spark, "k2-out")

    def send(*events):
        spark.createDataFrame(
            [(k, None, None, str(us), None, None, tag, us, 0) for k, us, tag in events], PACKED
        ).coalesce(1).write.mode("append").parquet(path)

    send(("a", 5_000_000, "a5"), ("b", 1_000_000, "b1"), ("c", 0, "c0"))
    query = (
        dedup_stream(spark.readStream.schema(PACKED).parquet(path), 8, 100, emit_superseded=True)
        .writeStream.format("parquet").option("path", out).option("checkpointLocation", work_dir(spark, "k2-cp"))
        .trigger(processingTime="500 milliseconds").start()
    )
    deadline = time.time() + 60
    while time.time() < deadline and not (query.lastProgress and query.lastProgress["stateOperators"] and query.lastProgress["stateOperators"][0]["numRowsTotal"] == 3):
        time.sleep(0.2)
    # Older and equal copies of a; a newer b; c beyond the age limit.
    send(("a", 4_000_000, "a4"), ("a", 5_000_000, "a5 again"), ("b", 2_000_000, "b2"), ("c", 200_000_000, "c200"))
    time.sleep(1)
    drain(query, 90)
    got = sorted((r.payload_text, r.route, r.existing_us) for r in spark.read.parquet(out).collect())
    assert got == [
        ("a4", "dropped", 5_000_000), ("a5", "main", None), ("a5 again", "dropped", 5_000_000), ("b1", "superseded", 2_000_000),
        ("b2", "main", None), ("c0", "superseded", 200_000_000), ("c200", "main", None)]


def test_patterns_are_compiled_as_executors_do(spark):
    assert C.bad_patterns(["(?<year>[0-9]+)", "[a-z&&[^b]]"], spark) == []
    assert len(C.bad_patterns(["(?P<year>[0-9]+)", "("], spark)) == 2


def test_micro_batches_hold_no_rows_in_executors(spark, monkeypatch):
    """Archive, letters, events and counters of a batch come from tables; cached rows of a large one end an executor."""
    event = lambda i, at, payload: json.dumps({"event_id": i, "event_type": "view", "event_source": "s", "event_ts": at, "payload": payload})
    good = json.dumps({"visit_id": "VIS-1", "page": "p", "referrer": None, "region": "East", "signed_in": True, "millis": 5, "day": "2024-01-05", "scroll": 1})
    texts = [
        event("a", "2024-01-05T00:00:00Z", good), event("a", "2024-01-05T00:00:01Z", good), event("a", "2024-01-05T00:00:01Z", good),
        event("b", "2024-01-05T00:00:00Z", good), event("c", "2024-01-05T00:00:00Z", "no json"), event("d", "2023-01-05T00:00:00Z", good), "broken", None,
    ]
    batch = spark.createDataFrame([(None if x is None else x.encode(), f"m{n}") for n, x in enumerate(texts)] + [(b"\xff", "m8")], "value binary, message_id string")
    cfg, now = copy.deepcopy(sample_config()), F.lit("2024-01-05T00:00:05Z").cast("timestamp")
    root = work_dir(spark, "no-cache")
    job = StreamingJob(spark, cfg, root, processing_time=now)
    place = WorkFolder(spark, "x", below=root).path.rsplit("/", 1)[0].removeprefix("file:")
    work = lambda: {n for n in os.listdir(place) if n.startswith("checks-")} if os.path.exists(place) else set()
    before = work()

    def refuse(*_, **__):
        raise AssertionError("rows are cached")

    for name in ("persist", "cache"):
        monkeypatch.setattr(type(batch), name, refuse)
    job.check_batch(batch, 0)
    job.final_batch(job.calendar.step(spark.read.parquet(job.checked), 0, now_ms=0), 0)
    job.final_batch(job.calendar.flush(1, 10**9), 1)
    assert {r["event_id"] for r in spark.read.parquet(job.table).collect()} == {"a", "b"}
    read = archive.ARCHIVE_SCHEMA
    kept = spark.read.schema(read).parquet(f"{job.archive}/batch_id=0").collect()
    assert sorted(r["event_id"] for r in kept) == ["a", "a", "a", "b", "c", "d"]
    assert {r["ingest_ts"] for r in kept} == {datetime.datetime(2024, 1, 5, 0, 0, 5)} and all(r["pubsub_metadata"] != "null" for r in kept)
    letters = route.read_dead_letters(spark.read.text(f"{job.letters}/batch_id=checks-0")).collect()
    assert sorted((r["stage"], r["reason"] or "", r["message"] or "", r["raw"] or "", r["message_base64"] or "") for r in letters) == [
        ("dedup", "duplicate_or_older_event", "", "", "")] * 2 + [
        ("late_data", "", "", "", ""), ("parse", "", "", "", ""), ("preprocess", "", "", "", ""), ("preprocess", "", "", "", "/w=="), ("preprocess", "", "broken", "broken", "")]
    counters = {r["counter"]: r["value"] for r in spark.read.parquet(job.counters).collect()}
    assert counters["events_in"] == 9 and counters["events_out"] == 2 and counters["dedup_dropped"] == 2
    # The work tables are gone.
    assert work() <= before


def test_stream_letters_cache_nothing(spark, monkeypatch):
    event = json.dumps({"event_id": "E", "event_type": "view", "event_source": "s", "event_ts": "2024-01-05T00:00:00Z", "payload": "x"})
    texts = ["broken", event, "[1]", None, event.replace('"event_type"', '"other"')]
    raw = spark.createDataFrame([(i, 0, 0, x, 1704412803, f"m{i}") for i, x in enumerate(texts)], "n long, c long, copy int, value string, proc_s long, message_id string")

    def refuse(*_, **__):
        raise AssertionError("rows are cached")

    for name in ("persist", "cache"):
        monkeypatch.setattr(type(raw), name, refuse)
    rows = demo.stream_letters(spark, raw).collect()
    assert {(r["stage"], r["message"]) for r in rows} == {("preprocess", x) for x in texts if x != event} and len(rows) == 4


def test_full_stream_caches_nothing_and_waits_for_its_rows(spark, monkeypatch):
    payload = json.dumps({"visit_id": "VIS-1", "page": "p", "referrer": None, "region": "East", "signed_in": True, "millis": 5, "day": "2024-01-05", "scroll": 1})
    text = [json.dumps({"event_id": f"E{i // 2}", "event_type": "view", "event_source": "s", "event_ts": f"2024-01-05T00:00:0{i % 2}Z", "payload": payload}) for i in range(8)]
    raw = spark.createDataFrame([(i, 0, 0, x, 1704412803, f"m{i}") for i, x in enumerate(text)], "n long, c long, copy int, value string, proc_s long, message_id string")
    waits, drain = [], StreamingJob.drain_final

    def refuse(*_, **__):
        raise AssertionError("rows are cached")

    def noted(job, query, timeout_sec=900):
        waits.append(timeout_sec)
        drain(job, query, 300)

    for name in ("persist", "cache"):
        monkeypatch.setattr(type(raw), name, refuse)
    monkeypatch.setattr(StreamingJob, "drain_final", noted)
    rows = demo.full_stream(spark, raw).collect()
    assert sorted((r["event_id"], r["event_ts"]) for r in rows) == [(f"E{i}", "2024-01-05T00:00:01Z") for i in range(4)]
    # Four events are left of eight messages; a table of any size may take its time.
    assert waits == [900 + 4 / demo.BURST_ROWS_PER_SEC]
