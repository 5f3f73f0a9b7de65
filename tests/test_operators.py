"""Each operator on small hand-made rows, and the skew-safe joins against brute force."""

import json

import pytest
from pyspark.sql import functions as F

from sluice.operators import casts, decode, dedup, enrich, event_time, route, schema_guard, validate, windows
from sluice.operators import metrics
from sluice.operators.fields import EventFrame, dynamic_field, typed
from sluice.operators.skew import hot_key_counts, split_join
from sluice.operators.transform import field_mapping, start_event
from sluice.plans.sample_config import EXPECTED_SCHEMA


def decoded(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    return decode.decode_messages(df)


def test_decode_and_gate(spark):
    base = {"event_id": "a", "event_type": "t", "event_source": "s", "event_ts": "2024-01-01", "payload": "{}"}
    values = [
        json.dumps(base),
        json.dumps({**base, "event_id": None}),
        json.dumps({k: v for k, v in base.items() if k not in ("event_source", "payload")}),
        "[1]",
        "12345678",
        json.dumps({**base, "event_id": 7, "event_type": True, "event_ts": 1.5}),
        '{"event_id":"x",' + json.dumps(base)[1:],
        json.dumps({**base, "payload": {"b": 1.0, "a": 2}}),
    ]
    rows = decoded(spark, values).orderBy("i").collect()
    errors = [r._reject.error if r._reject else None for r in rows]
    assert errors == [
        None, None, "PreProcess failed: Missing required field: event_source",
        "PreProcess failed: message is not a JSON object", "PreProcess failed: message is not a JSON object",
        None, None, None,
    ]
    assert rows[1].event_id is None and rows[1]._kinds.event_id == "null"
    assert (rows[5].event_id, rows[5].event_type, rows[5].event_ts) == ("7", "True", "1.5")
    assert (rows[5]._kinds.event_id, rows[5]._kinds.event_type, rows[5]._kinds.event_ts) == ("integer", "boolean", "float")
    assert rows[6].event_id == "a"
    assert json.loads(rows[7]._payload_text) == {"b": 1.0, "a": 2} and "1.0" in rows[7]._payload_text


def test_binary_that_is_not_utf8_is_refused(spark):
    df = spark.createDataFrame([(bytearray(b"\xff\xfe"),)], "value binary")
    assert decode.decode_messages(df).first()._reject.stage == "preprocess"


def test_payload_must_be_a_string_of_json(spark):
    base = {"event_id": "a", "event_type": "t", "event_source": "s", "event_ts": "2024-01-01"}
    values = [json.dumps({**base, "payload": p}) for p in (None, 5, [1], "[1,2]", "oops", '"text"', "e30=")]
    rows = decode.parse_payload(decoded(spark, values)).orderBy("i").collect()
    assert [r._reject.error if r._reject else None for r in rows] == [
        *["Payload parsing failed: payload is not a string"] * 3, None,
        "Payload parsing failed: payload is not JSON or base64 of JSON", None, None,
    ]
    assert [r._payload_is_object for r in rows[3:]] == [False, False, False, True]


def test_late_and_early(spark):
    base = {"event_id": "a", "event_type": "t", "event_source": "s", "payload": "{}"}
    d = decoded(spark, [json.dumps({**base, "event_ts": t}) for t in (0, 120, 121, 130.5)])
    d = event_time.assign_event_time(decode.parse_payload(d))
    d = event_time.filter_late(event_time.stamp_envelope(d, F.timestamp_seconds(F.lit(130))), 9)
    rows = d.orderBy("i").collect()
    assert [r._reject.error if r._reject else None for r in rows] == [
        "Late event dropped (lateness=130.0s)", "Late event dropped (lateness=10.0s)", None, "Early event (early by 0.5s)"]
    assert rows[3]._reject.detail == {"early_seconds": "0.5"}


def guarded(spark, policy, **cfg):
    base = {"event_id": "a", "event_type": "t", "event_source": "s", "event_ts": "2024-01-01"}
    payloads = ['{"x":1}', '{"x":null}', '{"x":1,"y":2}', "{}", '{"x":"2024-01-01"}', "[]"]
    d = decoded(spark, [json.dumps({**base, "payload": p}) for p in payloads])
    d = event_time.assign_event_time(decode.parse_payload(d))
    expected = {"event_id": "string", "event_type": "string", "event_source": "string", "event_ts": "date", "payload.x": "integer"}
    return schema_guard.guard_schema(
        d, {"enabled": True, "evolution_policy": policy, "schema_version": "v9", **cfg}, expected
    ).orderBy("i").collect()


def test_schema_policy(spark):
    rows = guarded(spark, {"on_new_field": "FAIL", "on_missing_field": "WARN", "on_type_change": "fail"})
    assert [r._reject.error if r._reject else None for r in rows] == [
        None, "Schema policy violation: type_changes", "Schema policy violation: new_fields", None,
        "Schema policy violation: type_changes", None]
    assert [r._schema_trace is not None for r in rows] == [False, False, False, True, False, True]
    diff = json.loads(rows[4]._reject.detail["diff"])
    assert diff["type_changes"] == {"payload.x": {"expected": "integer", "observed": "date"}}
    assert rows[3]._schema_trace["schema_version"] == "v9"


def test_schema_policy_without_dead_letters(spark):
    rows = guarded(spark, {"on_type_change": "FAIL"}, dlq_on_violation=False)
    assert rows[1]._reject.reason == route.SILENT


def versions(spark):
    rows = []
    for i in range(3000):  # a third of all rows share one id; many copies are equal
        key = "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{i % 700}")
        rows.append((key, f"2024-01-01T00:00:{i * 7 % 60:02d}Z", "{}", i))
    df = spark.createDataFrame(rows, "event_id string, event_ts string, _payload_text string, pos int")
    return rows, df.withColumns(
        {"_event_time": F.to_timestamp("event_ts"), "_reject": F.lit(None).cast(route.REJECT_TYPE)}
    ).repartition(5)


@pytest.mark.parametrize("hot_rows", [20, 10**6])
def test_batch_dedup_keeps_one_latest_row_per_id(spark, hot_rows):
    rows, df = versions(spark)
    out = dedup.batch_dedup(df, ["pos"], hot_rows=hot_rows).collect()
    assert len(out) == len(rows)
    best = {}
    for key, ts, _, pos in rows:
        best[key] = max(best.get(key, ("", -1)), (ts, pos))
    kept = {r.event_id: (r.event_ts, r.pos) for r in out if r._reject is None}
    assert kept == best and sum(r._reject is None for r in out) == len(best)
    for r in out:
        if r._reject is not None:
            assert r._reject.reason == "batch_duplicate"
            assert r._reject.detail["kept_event_ts"] == best[r.event_id][0]


def test_rejected_rows_take_no_part_in_dedup(spark):
    _, df = versions(spark)
    bad = route.reject_struct("schema", F.lit("x"))
    df = route.reject_where(df, F.col("pos") % 2 == 0, bad)
    out = dedup.batch_dedup(df, ["pos"], hot_rows=50)
    assert out.filter("_reject.stage = 'schema'").count() == 1500
    assert out.filter("_reject is null").count() == df.filter("_reject is null").select("event_id").distinct().count()


def test_split_join_equals_plain_join(spark):
    _, df = versions(spark)
    keys = df.select("event_id").distinct().withColumn("val", F.length("event_id"))
    hot = hot_key_counts(df, "event_id", 100)
    out = split_join(
        df, keys.join(hot, "event_id", "left_anti"), keys.join(hot, "event_id", "left_semi"), "event_id", "val", ["pos"]
    )
    assert out.filter("event_id is not null and val <> length(event_id)").count() == 0
    assert out.count() == 3000 and out.filter("event_id is not null and val is null").count() == 0


def mixed(spark, values):
    df = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "i int, j string")
    event = EventFrame(df.withColumns({"_reject": F.lit(None).cast(route.REJECT_TYPE), "x": F.parse_json("j")}), {})
    event.set("v", dynamic_field(F.col("x")))
    event.flush()
    return event


def result(event, name="out"):
    event.flush()
    f = event.get(name)
    return [r[0] for r in event.df.orderBy("i").select(f.text()).collect()]


def test_casts_without_default_leave_the_value(spark):
    values = ["12", "x", None, "", 3.9, -3.9, True, " 7 ", "1_0", "12.5"]
    event = mixed(spark, values)
    casts.type_casts(event, [{"field": "v", "to": "integer"}])
    assert result(event, "v") == ["12", "x", None, "", "3", "-3", "True", "7", "10", "12.5"]
    kinds = [r[0] for r in event.df.orderBy("i").select(event.get("v").kinds()).collect()]
    assert kinds == ["integer", "string", "null", "string", "integer", "integer", "boolean", "integer", "integer", "string"]


def test_casts_with_defaults_and_outputs(spark):
    event = mixed(spark, ["yes", "N", 0, 2.5, "maybe", None, True])
    casts.type_casts(event, [{"field": "v", "to": "boolean", "default": None, "output_field": "out"},
                             {"field": "v", "to": "nothing", "default": 1, "output_field": "odd"}])
    assert result(event) == ["True", "False", "False", "True", None, None, "True"]
    assert set(result(event, "odd")) == {"1"}


def test_null_defaults_and_nested_reads(spark):
    event = mixed(spark, [{"city": "Pune"}, {"city": ""}, None, "text"])
    casts.null_defaults(event, {"v.city": "none"})
    assert result(event, "v.city") == ["Pune", "none", "none", "none"]


def test_concatenation(spark):
    event = mixed(spark, ["a", "", None, 1.0, True])
    casts.concatenations(event, [
        {"output_field": "out", "inputs": ["v", "none"], "separator": "-", "default_value": "D"},
        {"output_field": "all", "inputs": ["v", "none", "out"], "separator": "-", "skip_nulls": False}])
    assert result(event) == ["a", "D", "D", "1.0", "True"]
    assert result(event, "all") == ["a--a", "--D", "--D", "1.0--1.0", "True--True"]


def test_static_lookup_kinds_and_refusal(spark):
    event = mixed(spark, ["1", 1, 1.0, True, 2, None, [1], {"a": 1}])
    enrich.enrichment(event, [{"type": "static_lookup", "input_field": "v", "output_field": "out",
                               "lookup": {"1": "text", 1: "number"}, "default": "D"}])
    event.flush()
    rows = event.df.orderBy("i").collect()
    assert [r.out for r in rows[:6]] == ["text", "number", "number", "number", "D", "D"]
    assert [r._reject.error if r._reject else None for r in rows] == [None] * 6 + [
        "Transformation failed: unhashable type: 'list'", "Transformation failed: unhashable type: 'dict'"]


def test_range_lookup_bounds(spark):
    event = mixed(spark, [0, 0.5, 1, "15", 16, 99, "x", None, True, "nan"])
    enrich.enrichment(event, [{"type": "range_lookup", "input_field": "v", "output_field": "out", "default": "gap", "ranges": [
        {"min": -50, "max": 0, "value": "cold"}, {"min": 1, "max": 15, "include_max": False, "value": "mild"},
        {"min": 15, "include_min": True, "max": 16, "include_max": False, "value": "edge"}, {"min": 31, "value": "hot"}]}])
    assert result(event) == ["cold", "gap", "mild", "edge", "gap", "hot", "gap", "gap", "mild", "gap"]


def test_regex_conditions_entities_and_normalization(spark):
    event = mixed(spark, ["Wire broken", "CABLE and wire", 5, None, "  n  DELHI "])
    enrich.enrichment(event, [
        {"type": "regex_lookup", "input_field": "v", "output_field": "first", "default": "none",
         "patterns": [{"pattern": "wire", "value": "w"}, {"pattern": "cable", "value": "c"}]},
        {"type": "regex_lookup", "input_field": "v", "output_field": "last", "default": "none", "first_match": False,
         "patterns": [{"pattern": "wire", "value": "w"}, {"pattern": "cable", "value": "c"}]},
        {"type": "conditional_set", "output_field": "tier", "default": "T3", "conditions": [
            {"when": "first = 'w' AND last = 'c'", "value": "T1"}, {"when": "first = 'w'", "value": 2}]},
        {"type": "normalization_enrichment", "input_field": "v", "output_field": "norm", "default": "unknown",
         "operations": ["trim", "lower", "collapse_spaces"], "synonyms": {"n delhi": "delhi"}}])
    enrich.entity_extraction(event, [{"field": "v", "entities": [{"name": "item", "pattern": "(cable|wire)"}]}])
    assert result(event, "first") == ["w", "w", "none", "none", "none"]
    assert result(event, "last") == ["w", "c", "none", "none", "none"]
    assert result(event, "tier") == ["2", "T1", "T3", "T3", "T3"]
    assert result(event, "norm") == ["wire broken", "cable and wire", "5", "unknown", "delhi"]
    assert result(event, "item") == ["Wire", "CABLE", None, None, None]


def test_rules_never_fail_a_row(spark):
    event = mixed(spark, [1, 0, None, "x"])
    event.set("n", typed("integer", F.try_variant_get("x", "$", "bigint")))
    event.flush()
    enrich.business_rules(event, [{"condition": "10 / n > 5", "output_field": "big", "value": True}])
    enrich.enrichment(event, [{"type": "derived_fields", "fields": [
        {"output_field": "plus", "expression": "n + 1", "default": -1}, {"output_field": "twice", "expression": "plus * 2"}]}])
    assert result(event, "big") == ["True", "False", "False", "False"]
    assert result(event, "plus") == ["2", "1", "-1", "-1"]
    assert result(event, "twice") == ["4", "2", "-2", "-2"]
    with pytest.raises(ValueError, match="cannot be resolved"):
        enrich.business_rules(event, [{"condition": "absent = 1", "output_field": "o"}])


@pytest.mark.parametrize("max_broadcast", [1000, 1])
def test_lookup_table_both_ways(spark, max_broadcast):
    _, df = versions(spark)
    table = spark.createDataFrame([("hot", "H"), ("k1", "one"), ("k2", None)], "k string, val string")
    out = enrich.lookup_table(df, table, "event_id", "k", "val", "out", ["pos"], "D", max_broadcast, hot_rows=100)
    want = {"hot": "H", "k1": "one", "k2": None}
    rows = out.select("event_id", "out").collect()
    assert len(rows) == 3000 and all(r.out == want.get(r.event_id, "D") for r in rows)


def test_mapping_is_sequential_and_reads_envelope(spark):
    base = {"event_id": "a", "event_type": "t", "event_source": "s", "event_ts": "2024-01-01", "trace": {"id": 9}}
    d = decoded(spark, [json.dumps({**base, "payload": json.dumps({"a b": {"c": 1}, "n": 2})})])
    event = start_event(decode.parse_payload(d))
    field_mapping(event, {"x": "payload.a b.c", "y": "x", "t": "trace.id", "none": "payload.q.r", "m": {"source": "payload.n", "type": "INT64"}})
    row = event.df.select(*[event.get(n).text().alias(n) for n in ("x", "y", "t", "none", "m")]).first()
    assert tuple(row) == ("1", "1", "9", None, "2")


def test_windows_reject_other_types(spark):
    with pytest.raises(ValueError, match="Unsupported window type: sliding"):
        windows.tumbling_counts(spark.range(1).withColumn("ts", F.current_timestamp()), {"type": "sliding", "window_size_sec": 1}, "ts", [])
    assert windows.output_mode({}) == "append" and windows.output_mode({"early_trigger_sec": 5}) == "update"


def test_alert_runs(spark):
    series = spark.createDataFrame([(60 * i, v) for i, v in [(0, 9), (1, 9), (2, 1), (3, 9), (5, 9), (6, 9), (7, 9)]], "window_start long, v int")
    rows = metrics.alert_breaches(series, "v", 5, 120, 60).orderBy("breach_start").collect()
    assert [(r.breach_start, r.breach_end, r.windows) for r in rows] == [(0, 120, 2), (300, 480, 3)]


def test_repeated_header_keys_keep_the_last_value(spark):
    from sluice.sources.messages import header_map

    df = spark.createDataFrame(
        [([("a", b"1"), ("b", b"2"), ("a", b"3")],), ([],), (None,)], "headers array<struct<key:string,value:binary>>"
    )
    assert [r[0] for r in df.select(header_map(F.col("headers"))).collect()] == [{"b": "2", "a": "3"}, {}, {}]


def test_default_below_an_object_changes_the_object(spark):
    df = spark.createDataFrame([('{"city":"","zip":"1"}',), ("5",), ("null",)], "j string").withColumn("x", F.parse_json("j"))
    event = EventFrame(df, {})
    event.set("v", dynamic_field(F.col("x")))
    event.flush()
    casts.null_defaults(event, {"v.city": "Ulm"})
    event.flush()
    got = [json.loads(r[0]) for r in event.df.select(F.to_json(event.get("v").variant)).collect()]
    assert got == [{"city": "Ulm", "zip": "1"}, {"city": "Ulm"}, {"city": "Ulm"}]


def test_neighbouring_whole_numbers_are_told_apart(spark):
    big = 2**53
    df = spark.createDataFrame([(big,), (big + 1,), (7,), (None,)], "n long")
    event = EventFrame(df, {"n": typed("integer", F.col("n"))})
    enrich.enrichment(event, [{"type": "static_lookup", "input_field": "n", "output_field": "o", "lookup": {big: "x", 7.0: "y"}}])
    assert [r[0] for r in event.df.select(event.get("o").text()).collect()] == ["x", None, "y", None]


def test_alert_runs_across_stretches(spark):
    start = metrics.CHUNK_WINDOWS * 60 * 5
    hot = [start + 60 * i for i in range(-3, 4)] + [start + 60 * i for i in (10, 20, 21)]
    df = spark.createDataFrame([(w, 9) for w in hot], "window_start long, n long")
    got = sorted(map(tuple, metrics.alert_breaches(df, "n", 5, 120, 60).select("breach_start", "windows").collect()))
    assert got == [(start - 180, 7), (start + 1200, 2)]
