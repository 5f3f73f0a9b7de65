"""The registered queries: every operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators import casts, decode, dedup, enrich, event_time, metrics, route
from sluice.operators import schema_guard as guard
from sluice.operators import validate as val
from sluice.operators import windows
from sluice.operators.fields import EventFrame, dynamic_field, typed
from sluice.operators.transform import field_mapping as map_fields
from sluice.operators.transform import start_event, transform, view_kinds
from sluice.plans import rules as R
from sluice.plans.cases import mixed_values, raw_messages
from sluice.plans.sample_config import EXPECTED_SCHEMA, SCHEMA_MANAGEMENT, sample_config
from sluice.plans.stages import check_events, transform_and_validate
from sluice.session import WorkFolder, prepare, work_dir
from sluice.sources import archive, tables, targets
from sluice.sources.sink_schema import derive_schema, row_id, schema_rows, to_sink

POSITION = ["message_id"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _proc():
    return F.timestamp_seconds("proc_s")


def _raw(spark, sf_dir):
    return raw_messages(prepare(spark), sf_dir)


def _decoded(spark, sf_dir):
    return decode.decode_messages(_raw(spark, sf_dir))


def _parsed(spark, sf_dir):
    return decode.parse_payload(_decoded(spark, sf_dir))


def _timed(spark, sf_dir):
    out = event_time.assign_event_time(_parsed(spark, sf_dir))
    return event_time.stamp_envelope(out, _proc())


def _checked(spark, sf_dir, streaming=False):
    return check_events(_decoded(spark, sf_dir), sample_config(), streaming, _proc())


def _deduped(spark, sf_dir, streaming=False):
    """Dedup reads its input twice; a table keeps decode, parse and guard to one run."""
    checked = WorkFolder(spark, "checked").write(_checked(spark, sf_dir, streaming), "rows")
    return dedup.batch_dedup(checked, POSITION)


def _routed(spark, sf_dir):
    return transform_and_validate(_deduped(spark, sf_dir), sample_config())


# -- sources, sinks, routing ------------------------------------------------------------


def raw_archive_rows(spark, sf_dir):
    rows = archive.archive_rows(_decoded(spark, sf_dir), F.timestamp_seconds(F.lit(0)))
    return rows.select(
        F.unix_micros("event_ts").alias("event_us"), "event_ts_raw", "event_id", "event_type",
        "event_source", "schema_name", "schema_version", "raw_payload", "pubsub_metadata",
    )


def _written_archive(spark, sf_dir):
    path = work_dir(spark, "archive")
    archive.write_archive(archive.archive_rows(_decoded(spark, sf_dir)), path)
    return path


RANGE = ("2024-01-05T00:00:00Z", "2024-01-12T12:30:00Z")


def raw_range_read(spark, sf_dir):
    rows = archive.read_archive(prepare(spark), _written_archive(spark, sf_dir), *RANGE)
    return rows.select("event_id", "event_type", "event_source", "event_ts", "payload")


def final_rows(spark, sf_dir):
    rows = _routed(spark, sf_dir).final_rows()
    return rows.withColumns(
        {c: F.unix_micros(c) for c in ("beam_event_time", "beam_processing_time")}
    )


def derived_schema(spark, sf_dir):
    """Derived columns, with how many events of the table fill each one."""
    rows = _routed(spark, sf_dir).final_rows()
    cfg = sample_config()
    columns = derive_schema(cfg.destination, cfg.transformations, cfg.expected_schema)
    counts = rows.agg(*[F.count(c).alias(c) for c in columns])
    filled = counts.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("filled")) for c in columns]))
    )
    return schema_rows(spark, columns).join(F.broadcast(filled), "name")


def row_ids(spark, sf_dir):
    d = route.accepted(_decoded(spark, sf_dir))
    return d.select(
        "n", "copy", row_id(F.col("event_id"), F.col("event_ts"), F.col("_kinds.event_ts")).alias("row_id")
    )


def dlq_union(spark, sf_dir):
    out = _routed(spark, sf_dir).dead_letters()
    return out.select(
        "stage", "event_id", "error", "reason", "raw", "message",
        F.col("detail")["kept_event_ts"].alias("kept_event_ts"),
        F.col("detail")["validation_errors"].alias("validation_errors"),
        F.col("detail")["diff"].isNotNull().alias("has_diff"),
        F.get_json_object("event_json", "$.event_source").alias("event_source"),
    )


def topic_write(spark, sf_dir):
    """Dead letters as JSON text, written and read back."""
    path = work_dir(spark, "topic")
    route.write_dead_letters(_routed(spark, sf_dir).dead_letters(with_traces=False), path)
    return route.read_dead_letters(spark.read.text(path)).select("stage", "event_id", "error", "raw")


def dlq_replay(spark, sf_dir):
    """Every refused message, rebuilt from its dead letter."""
    letters = _routed(spark, sf_dir).dead_letters(with_traces=False)
    sent = route.replayed_messages(route.read_dead_letters(route.dead_letter_json(letters))).withColumn("text", F.col("value").cast("string"))
    early = F.col("stage") == "preprocess"
    return sent.select(
        "stage", "event_id", F.when(early, F.col("text")).alias("message"),
        F.when(~early, F.get_json_object("text", "$.event_ts")).alias("event_ts"),
        F.when(~early, F.coalesce(F.get_json_object("text", "$.payload.visit_id"), F.get_json_object("text", "$.visit_id"))).alias("visit_id"),
    )


def transform_rejects(spark, sf_dir):
    """A list or an object as a lookup key: the event is refused and its letter holds it."""
    event = _mixed_event(spark, sf_dir)
    event.df = event.df.withColumns({"_reject": route.no_reject(), "_payload": F.col("x")})
    enrich.enrichment(event, [{"type": "static_lookup", "input_field": "v", "output_field": "w", "lookup": {"a": "b"}}])
    letters = route.dead_letters(event.df.withColumn("event_id", F.col("event_id").cast("string")))
    return letters.select("stage", "event_id", "error", F.get_json_object("event_json", "$.payload").alias("body"))


def route_by_type(spark, sf_dir):
    path = work_dir(spark, "by_type")
    route.route_by_type(route.accepted(_decoded(spark, sf_dir)).select("event_id", "event_type"), path)
    return spark.read.parquet(path).select(F.col("event_type").cast("string"), "event_id")


def merge_upsert(spark, sf_dir):
    """Orders merged with a correction of a third of them and one new order per customer."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    updates = orders.filter(F.col("o_custkey") % 3 == 0).withColumns(
        {"o_orderstatus": F.lit("U"), "o_totalprice": F.col("o_totalprice") + 1}
    )
    new = _table(spark, sf_dir, "customer").select(
        (-F.col("c_custkey") - 1).alias("o_orderkey"), F.col("c_custkey").alias("o_custkey"),
        F.lit("N").alias("o_orderstatus"), F.col("c_acctbal").alias("o_totalprice"),
    )
    return tables.merge_rows(orders, updates.unionByName(new), ["o_orderkey"])


def merge_into_table(spark, sf_dir):
    """Events merged into a table: a third is replaced and moves two days on, and some are new."""
    events = _table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string"), "event_type", "value", F.col("ts").cast("timestamp").alias("beam_event_time")
    )
    later = F.col("beam_event_time") + F.expr("INTERVAL 2 DAYS")
    moved = events.filter(F.col("event_id").cast("long") % 3 == 0).withColumns({"value": F.col("value") + 1, "beam_event_time": later})
    new = events.filter(F.col("event_id").cast("long") % 5 == 0).withColumn("event_id", F.concat(F.lit("n"), "event_id"))
    # Rows without a key are told apart by their content, so merging twice adds none.
    keyless = events.filter(F.col("event_id").cast("long") % 7 == 0).withColumn("event_id", F.lit(None).cast("string"))
    root = work_dir(spark, "merge")
    tables.write_table(events, f"{root}/target")
    tables.write_table(moved.unionByName(new).unionByName(keyless), f"{root}/changes")
    for _ in range(2):
        tables.merge_into(spark, f"{root}/target", f"{root}/changes")
    out = spark.read.parquet(f"{root}/target")
    return out.select("event_id", "event_type", "value", F.col("event_date").cast("string").alias("event_day"))


def _dated_events(spark, sf_dir):
    return _table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string"), "event_type", "value", F.col("ts").cast("timestamp").alias("beam_event_time")
    )


def merge_days_searched(spark, sf_dir):
    """Which days a merge searches for replaced rows: corrections of single days, and one new day."""
    events = _dated_events(spark, sf_dir)
    root = work_dir(spark, "filtered")
    tables.write_table(events, f"{root}/target")
    names = tables.data_folders(tables.Folders(spark, f"{root}/target"), f"{root}/target")
    tables.write_filters(spark, f"{root}/target", names, ["event_id"])
    some = events.filter((F.dayofmonth("beam_event_time") % 9 == 4) & (F.col("event_id").cast("long") % 50 == 0))
    moved = some.withColumn("beam_event_time", F.lit("2031-01-01").cast("timestamp"))
    tables.write_table(moved, f"{root}/changes")
    report = tables.merge_into(spark, f"{root}/target", f"{root}/changes")
    day = lambda names: F.array(*[F.lit(n.split("/")[0].split("=")[1]) for n in names]).cast("array<string>")
    counted = spark.read.parquet(f"{root}/target").groupBy(F.col("event_date").cast("string").alias("event_day")).agg(F.count("*").alias("events"))
    return counted.withColumn("searched", F.array_contains(day(report.searched), F.col("event_day")))


def compacted_table(spark, sf_dir):
    """Events written in fifty micro-batches, and packed into few folders."""
    path = work_dir(spark, "compacted")
    events = _dated_events(spark, sf_dir).withColumn("_batch", F.col("event_id").cast("long") % 50)
    # One write lays out all batches as fifty micro-batches would.
    tables.with_partition(events).withColumn(tables.BATCH, F.col("_batch").cast("int")).drop("_batch").write.partitionBy(tables.PARTITION, tables.BATCH).parquet(path)
    tables.compact(spark, path, ["event_id"])
    rows = spark.read.parquet(path)
    return rows.groupBy(F.col("event_date").cast("string").alias("event_day"), "event_type").agg(
        F.count("*").alias("events"), F.max("value").alias("largest"), F.count_distinct(tables.BATCH).alias("folders")
    )


# -- decode, time, lateness -------------------------------------------------------------


def decode_messages(spark, sf_dir):
    return _decoded(spark, sf_dir).select(
        "n", "copy", "event_id", "event_type", "event_source", "event_ts",
        F.col("_payload_text").alias("payload_text"),
        F.get_json_object("_pubsub", "$.message_id").alias("message_id"),
        F.col("_reject.error").alias("error"),
    )


def required_fields(spark, sf_dir):
    d = _decoded(spark, sf_dir)
    return d.groupBy(F.coalesce(F.col("_reject.error"), F.lit("ok")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("messages")
    )


def parse_payload(spark, sf_dir):
    d = _parsed(spark, sf_dir)
    return d.select(
        "n", "copy",
        F.try_variant_get("_payload", "$.visit_id", "string").alias("visit_id"),
        F.try_variant_get("_payload", "$.millis", "bigint").alias("millis"),
        F.col("_payload_is_object").alias("is_object"),
        F.col("_reject.stage").alias("stage"), F.col("_reject.error").alias("error"),
    )


def parse_event_time(spark, sf_dir):
    from sluice.functions.jsonvalue import base_kind, plain_text
    from sluice.functions.timetext import add_event_time

    d = mixed_values(prepare(spark), sf_dir).withColumn("x", F.parse_json("v"))
    d = d.withColumns({"k": base_kind(F.col("x"))}).withColumn("s", plain_text(F.col("x"), F.col("k")))
    d = add_event_time(d, F.col("s"), F.col("k"), "at")
    return d.select("event_id", F.unix_micros("at").alias("event_us"))


def assign_event_time(spark, sf_dir):
    d = _timed(spark, sf_dir)
    return d.select(
        "n", "copy", F.unix_micros("_event_time").alias("event_us"), "event_timestamp",
        F.col("_reject.stage").alias("stage"), F.col("_reject.error").alias("error"),
        F.col("_reject.reason").alias("reason"),
    )


def late_filter(spark, sf_dir):
    d = event_time.filter_late(_timed(spark, sf_dir), 120)
    d = d.filter(route.ok() | (F.col("_reject.stage") == "late_data"))
    return d.select(
        "n", "copy", F.col("_reject.error").alias("error"),
        F.col("_reject.detail")["lateness_seconds"].alias("lateness_seconds"),
        F.col("_reject.detail")["early_seconds"].alias("early_seconds"),
    )


def event_lag(spark, sf_dir):
    d = event_time.filter_late(_timed(spark, sf_dir), 120)
    return d.filter(route.ok()).select("n", "copy", event_time.event_lag_ms().alias("lag_ms"))


# -- schema guard -----------------------------------------------------------------------


def infer_string_type(spark, sf_dir):
    from sluice.functions.jsonvalue import base_kind
    from sluice.functions.timetext import string_kind

    d = mixed_values(prepare(spark), sf_dir).withColumn("x", F.parse_json("v"))
    d = d.withColumn("s", F.when(base_kind(F.col("x")) == "string", F.try_variant_get("x", "$", "string")))
    return d.select("event_id", F.when(F.col("s").isNotNull(), string_kind(F.col("s"))).alias("kind"))


def infer_value_type(spark, sf_dir):
    d = mixed_values(prepare(spark), sf_dir).withColumn("x", F.parse_json("v"))
    return d.select("event_id", guard.value_kind(F.col("x")).alias("kind"))


def observed_schema(spark, sf_dir):
    d = route.accepted(_timed(spark, sf_dir)).withColumn("o", guard.observed_schema())
    return d.select("n", "copy", F.explode("o").alias("path", "kind"))


def schema_diff(spark, sf_dir):
    d = route.accepted(_timed(spark, sf_dir)).withColumn("o", guard.observed_schema())
    d = d.withColumn("d", guard.schema_diff(F.col("o"), EXPECTED_SCHEMA))
    changes = F.array_sort(
        F.transform(
            F.map_entries("d.type_changes"),
            lambda e: F.concat(e["key"], F.lit(":"), e["value"]["expected"], F.lit(">"), e["value"]["observed"]),
        )
    )
    return d.select(
        "n", "copy",
        F.array_join("d.new_fields", ",").alias("new_fields"),
        F.array_join("d.missing_fields", ",").alias("missing_fields"),
        F.array_join(changes, ",").alias("type_changes"),
        guard.schema_changed(F.col("d")).alias("changed"),
    )


def schema_policy(spark, sf_dir):
    d = guard.guard_schema(_timed(spark, sf_dir), SCHEMA_MANAGEMENT, EXPECTED_SCHEMA)
    d = d.filter(route.ok() | (F.col("_reject.stage") == "schema"))
    return d.select(
        "n", "copy", F.col("_reject.error").alias("error"), F.col("_schema_trace").isNotNull().alias("traced"),
        route.ok().alias("continues"),
    )


def schema_drift_report(spark, sf_dir):
    return guard.drift_report(_timed(spark, sf_dir), EXPECTED_SCHEMA)


# -- dedup and windows ------------------------------------------------------------------


def batch_dedup(spark, sf_dir):
    d = route.accepted(_deduped(spark, sf_dir))
    return d.select("event_id", "message_id", "event_ts", F.unix_micros("_event_time").alias("event_us"))


def batch_dedup_dropped(spark, sf_dir):
    d = _deduped(spark, sf_dir).filter(F.col("_reject.stage") == "dedup")
    return d.select(
        "event_id", "message_id", F.col("_reject.reason").alias("reason"),
        F.col("_reject.detail")["kept_event_ts"].alias("kept_event_ts"),
    )


def tumbling_counts(spark, sf_dir):
    events = _table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return windows.tumbling_counts(
        events, {"window_size_sec": 3600}, "ts", ["event_type"], {"users": "user_id"}
    )


# -- transform --------------------------------------------------------------------------


def _mixed_event(spark, sf_dir) -> EventFrame:
    d = mixed_values(prepare(spark), sf_dir).withColumn("x", F.parse_json("v")).drop("v")
    event = EventFrame(d, {"event_type": typed("string", F.col("event_type"))})
    event.set("v", dynamic_field(F.col("x")))
    event.flush()
    return event


def _cast_query(to: str) -> Callable:
    def query(spark, sf_dir):
        event = _mixed_event(spark, sf_dir)
        return event.df.select("event_id", casts.cast_value(event.get("v"), to).alias("cast_value"))

    query.__name__ = f"cast_{to}"
    return query


def _columns(event: EventFrame, keys: list[str], outputs: dict[str, str]) -> DataFrame:
    event.flush()
    out = [to_sink(event.get(n), t).alias(n) for n, t in outputs.items()]
    return event.df.select(*keys, *out)


def cast_rules(spark, sf_dir):
    event = _mixed_event(spark, sf_dir)
    casts.type_casts(event, R.CAST_RULES)
    return _columns(
        event, ["event_id"],
        {"as_int": "INT64", "as_float": "FLOAT64", "as_bool": "BOOL", "as_date": "STRING", "kept": "STRING"},
    )


def field_mapping(spark, sf_dir):
    cfg = sample_config()
    d = route.accepted(_timed(spark, sf_dir))
    event = start_event(d)
    mapping = {**cfg.transformations["field_mapping"], "deep": "payload.region.code", "source": "event_source"}
    map_fields(event, mapping, view_kinds(cfg.transformations, cfg.expected_schema))
    return _columns(
        event, ["n", "copy"],
        {"visit_id": "STRING", "page": "STRING", "came_from": "STRING", "region": "STRING", "signed_in": "BOOL",
         "millis": "INT64", "visit_day": "STRING", "scroll_share": "INT64", "deep": "STRING", "source": "STRING"},
    )


def null_defaults(spark, sf_dir):
    event = _mixed_event(spark, sf_dir)
    casts.null_defaults(event, [{"field": "v", "default": "UNKNOWN"}])
    casts.null_defaults(event, {"absent": 7})
    return _columns(event, ["event_id"], {"v": "STRING", "absent": "INT64"})


def _typed_event(df: DataFrame, **kinds: str) -> EventFrame:
    return EventFrame(df, {n: typed(k, F.col(n)) for n, k in kinds.items()})


def concatenation(spark, sf_dir):
    event = _typed_event(
        _table(spark, sf_dir, "part"), p_brand="string", p_type="string", p_size="integer", p_name="string"
    )
    casts.concatenations(event, R.CONCATENATIONS)
    return _columns(event, ["p_partkey"], {"label": "STRING", "code": "STRING", "filled": "STRING"})


def _order_event(spark, sf_dir) -> EventFrame:
    return _typed_event(
        _table(spark, sf_dir, "orders"), o_orderstatus="string", o_orderpriority="string", o_totalprice="float"
    )


def business_rules(spark, sf_dir):
    event = _order_event(spark, sf_dir)
    enrich.business_rules(event, R.BUSINESS_RULES)
    return _columns(event, ["o_orderkey"], {"is_critical": "BOOLEAN", "is_open_large": "BOOLEAN"})


def static_lookup(spark, sf_dir):
    event = _order_event(spark, sf_dir)
    enrich.enrichment(event, [R.STATIC_LOOKUP])
    return _columns(event, ["o_orderkey"], {"status_name": "STRING"})


def lookup_table(spark, sf_dir):
    """The same lookup with the map held in a table: nation names by key."""
    customer = _table(spark, sf_dir, "customer")
    nation = _table(spark, sf_dir, "nation")
    out = enrich.lookup_table(
        customer, nation, "c_nationkey", "n_nationkey", "n_name", "nation_name", ["c_custkey"], default="NONE"
    )
    return out.select("c_custkey", "nation_name")


def lookup_table_large(spark, sf_dir):
    """A lookup table beyond the broadcast bound: part names for every line."""
    line = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    part = _table(spark, sf_dir, "part")
    out = enrich.lookup_table(
        line, part, "l_partkey", "p_partkey", "p_brand", "brand", ["l_orderkey", "l_linenumber"],
        default="NONE", max_broadcast=10,
    )
    return out.select("l_orderkey", "l_linenumber", "brand")


def range_lookup(spark, sf_dir):
    event = _typed_event(_table(spark, sf_dir, "customer"), c_acctbal="float")
    enrich.enrichment(event, [R.RANGE_LOOKUP])
    return _columns(event, ["c_custkey"], {"balance_class": "STRING"})


def multi_key_lookup(spark, sf_dir):
    event = _order_event(spark, sf_dir)
    enrich.enrichment(event, [R.MULTI_KEY_LOOKUP])
    return _columns(event, ["o_orderkey"], {"queue": "STRING"})


def regex_lookup(spark, sf_dir):
    event = _typed_event(_table(spark, sf_dir, "part"), p_type="string", p_name="string")
    enrich.enrichment(event, R.REGEX_LOOKUPS)
    return _columns(event, ["p_partkey"], {"finish_first": "STRING", "finish_last": "STRING"})


def conditional_set(spark, sf_dir):
    event = _order_event(spark, sf_dir)
    enrich.enrichment(event, [R.CONDITIONAL_SET])
    return _columns(event, ["o_orderkey"], {"tier": "STRING"})


def derived_fields(spark, sf_dir):
    d = _table(spark, sf_dir, "customer")
    event = _typed_event(d, c_acctbal="float", c_name="string", c_mktsegment="string")
    enrich.enrichment(event, R.DERIVED_FIELDS)
    return _columns(
        event, ["c_custkey"],
        {"balance": "FLOAT64", "name_len": "INT64", "segment_rank": "INT64", "never": "STRING"},
    )


def normalize_text(spark, sf_dir):
    event = _typed_event(_table(spark, sf_dir, "documents"), text="string", lang="string")
    enrich.enrichment(event, R.NORMALIZATIONS)
    event.flush()
    return event.df.select(
        "doc_id", F.md5(event.get("clean").text()).alias("clean_md5"),
        F.length(event.get("clean").text()).alias("clean_len"), event.get("language").text().alias("language"),
    )


def entity_extraction(spark, sf_dir):
    event = _typed_event(_table(spark, sf_dir, "documents"), text="string")
    enrich.entity_extraction(event, R.ENTITIES)
    return _columns(event, ["doc_id"], {"email": "STRING", "year": "STRING", "keyword": "STRING"})


def transform_all(spark, sf_dir):
    cfg = sample_config()
    event = transform(route.accepted(_timed(spark, sf_dir)), cfg.transformations, cfg.expected_schema)
    return _columns(
        event, ["n", "copy"],
        {"visit_id": "STRING", "came_from": "STRING", "signed_in": "BOOL", "millis": "INT64", "scroll_share": "FLOAT64",
         "day_checked": "STRING", "step": "STRING", "bounced": "BOOLEAN", "zone": "INT64", "seconds": "FLOAT64",
         "week": "STRING", "page_number": "STRING"},
    )


def nested_default(spark, sf_dir):
    """Defaults below an object change the object itself."""
    d = _table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.parse_json(F.concat(
            F.lit('{"name": "'), F.col("c_name"), F.lit('", "city": '),
            F.when(F.col("c_custkey") % 2 == 0, F.lit('""')).otherwise(F.lit('"Ulm"')), F.lit("}"),
        )).alias("x"),
    )
    event = EventFrame(d, {})
    event.set("v", dynamic_field(F.col("x")))
    event.flush()
    casts.null_defaults(event, {"v.city": "UNKNOWN", "v.geo.zone": 3})
    event.flush()
    v = F.to_json(event.get("v").variant)
    return event.df.select(
        "c_custkey", *[F.get_json_object(v, f"$.{p}").alias(p.replace(".", "_")) for p in ("name", "city", "geo.zone")]
    )


def large_key_lookup(spark, sf_dir):
    """Neighbouring keys beyond the exact range of doubles."""
    d = _table(spark, sf_dir, "orders").select("o_orderkey", (F.lit(R.LARGE_KEY) + F.col("o_orderkey") % 4).alias("big"))
    event = _typed_event(d, big="integer")
    enrich.enrichment(event, [R.LARGE_LOOKUP])
    return _columns(event, ["o_orderkey"], {"found": "STRING"})


def configured_table_lookup(spark, sf_dir):
    """A lookup table that a rule names."""
    event = _typed_event(_table(spark, sf_dir, "customer"), c_nationkey="integer", c_name="string")
    rule = {
        "type": "table_lookup", "input_field": "c_nationkey", "output_field": "nation", "default": "NONE",
        "table": f"{sf_dir}/nation.parquet", "key": "n_nationkey", "value": "n_name",
    }
    enrich.enrichment(event, [rule])
    return _columns(event, ["c_custkey"], {"nation": "STRING"})


# -- validation -------------------------------------------------------------------------


def _messages(event: EventFrame, key: str, checks) -> DataFrame:
    return event.df.select(key, F.array_join(val.messages(checks), "; ").alias("messages"))


def validate_required(spark, sf_dir):
    event = _mixed_event(spark, sf_dir)
    cfg = {"required_fields": ["v", "event_type"], "payload_required_fields": ["v", "absent"]}
    return _messages(event, "event_id", val.required_messages(event, cfg))


def validate_length(spark, sf_dir):
    event = _mixed_event(spark, sf_dir)
    cfg = {"length_checks": {"v": {"max": 5, "min": 3, "equal": 4}, "absent": {"min": 1}}}
    return _messages(event, "event_id", val.length_messages(event, cfg))


def validate_types(spark, sf_dir):
    out = []
    event = _mixed_event(spark, sf_dir)
    for kind in ("STRING", "INTEGER", "BOOLEAN", "integer"):
        out += val.type_messages(event, {"type_checks": {"v": kind}})
    return _messages(event, "event_id", out)


def validate_all(spark, sf_dir):
    d = _routed(spark, sf_dir).df
    d = d.filter(route.ok() | (F.col("_reject.stage") == "validation"))
    return d.select("n", "copy", F.col("_reject.error").alias("error"))


def event_time_check(spark, sf_dir):
    """A field mapped onto the event time is checked again."""
    event = start_event(route.accepted(_timed(spark, sf_dir)))
    map_fields(event, {"event_ts": "payload.day", "visit_id": "payload.visit_id"})
    casts.null_defaults(event, {"event_ts": "never"})
    event.flush()
    event.set("event_ts", typed("string", F.when(F.col("n") % 2 == 0, F.concat(event.get("event_ts").text(), F.lit("?"))).otherwise(event.get("event_ts").text())))
    event.flush()
    return event.df.select("n", "copy", val.event_time_message(event).alias("message"))


def source_by_mode(spark, sf_dir):
    """The source that each mode reads, counted by type."""
    from sluice.sources.messages import read_source

    rows = read_source(prepare(spark), "backfill", archive=(_written_archive(spark, sf_dir), *RANGE))
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


def letters_target(spark, sf_dir):
    """Dead letters written at the place of each mode, and read back from there."""
    cfg, root = sample_config(), work_dir(spark, "letters")
    letters = route.dead_letters(_decoded(spark, sf_dir))
    out = []
    for mode in (targets.STREAMING, targets.BACKFILL):
        place = targets.letters_target(cfg.destination, cfg.backfill_settings, mode)
        route.write_dead_letters(letters, f"{root}/{place}")
        back = route.read_dead_letters(spark.read.text(f"{root}/{place}"))
        out.append(back.select(F.lit(place).alias("target"), "stage", "error", "message"))
    return out[0].unionByName(out[1])


# -- metrics and alerts -----------------------------------------------------------------


def _stream_like(spark, sf_dir):
    """All stages with lateness, and dedup over the whole table."""
    return transform_and_validate(_deduped(spark, sf_dir, streaming=True), sample_config()).df


def event_counters(spark, sf_dir):
    return metrics.event_counters(_stream_like(spark, sf_dir))


def lag_distribution(spark, sf_dir):
    return metrics.lag_distribution(event_time.filter_late(_timed(spark, sf_dir), 120), 3600)


def lag_series(spark, sf_dir):
    return metrics.lag_series(event_time.filter_late(_timed(spark, sf_dir), 120), 3600)


def dashboard_series(spark, sf_dir):
    d = _stream_like(spark, sf_dir).withColumn("at", _proc())
    return metrics.stage_series(d, "at", 60)


def alert_breaches(spark, sf_dir):
    """Dead letters per hour above a threshold for two hours or more."""
    d = _stream_like(spark, sf_dir).withColumn("at", _proc())
    series = metrics.stage_series(d, "at", 3600).filter(F.col("stage") != "accepted")
    total = series.groupBy("window_start").agg(F.sum("events").alias("events"))
    return metrics.alert_breaches(total, "events", 2, 7200, 3600)


def configured_alerts(spark, sf_dir):
    """Alerts of the configuration: refused events summed, lag averaged."""
    d = _stream_like(spark, sf_dir)
    points = metrics.alert_points(d, _proc())
    return metrics.configured_alerts(points, sample_config().observability)


# -- whole jobs -------------------------------------------------------------------------


def backfill_run(spark, sf_dir):
    """The backfill job end to end over the whole archive; its table is read back."""
    from sluice.plans.backfill import run_backfill

    warehouse = work_dir(prepare(spark), "warehouse")
    path = _written_archive(spark, sf_dir)
    low, high = archive.archive_bounds(spark, path)
    result = run_backfill(spark, sample_config(), warehouse, path, low.isoformat(), high.isoformat())
    return spark.read.parquet(result.table).select(
        "event_id", "row_id", "visit_id", "millis", "scroll_share", "step", "week"
    )


def stream_source(spark, sf_dir):
    from sluice.streaming import demo

    return demo.decode_stream(prepare(spark), _raw(spark, sf_dir))


def stream_windows(spark, sf_dir):
    from sluice.streaming import demo

    return demo.window_stream(prepare(spark), _table(spark, sf_dir, "events"))


def stream_dedup(spark, sf_dir):
    from sluice.streaming import demo

    return demo.dedup_stream(prepare(spark), _checked(spark, sf_dir))


def stream_state_age(spark, sf_dir):
    from sluice.streaming import demo

    return demo.state_age(prepare(spark), _table(spark, sf_dir, "events"), 86_400)


def stream_letters(spark, sf_dir):
    """Dead letters of the checking query, read as JSON lines from the target of the streaming mode."""
    from sluice.streaming import demo

    return demo.stream_letters(prepare(spark), _raw(spark, sf_dir))


def stream_lag_percentiles(spark, sf_dir):
    """Lag percentiles of each hour, from the sketches of all micro-batches."""
    from sluice.streaming import demo

    events = event_time.filter_late(_timed(prepare(spark), sf_dir), 120)
    return demo.lag_percentile_stream(spark, events, 3600, {"lag_p50": 500, "lag_p95": 950, "lag_p99": 990})


def stream_counters(spark, sf_dir):
    from sluice.streaming import demo

    return demo.stream_counters(prepare(spark), _raw(spark, sf_dir))


def streaming_run(spark, sf_dir):
    from sluice.streaming import demo

    return demo.full_stream(prepare(spark), _raw(spark, sf_dir))


@lru_cache(maxsize=1)
def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    functions = [
        raw_archive_rows, raw_range_read, final_rows, derived_schema, dlq_union, dlq_replay, topic_write, transform_rejects,
        route_by_type, merge_upsert, merge_into_table, merge_days_searched, compacted_table, decode_messages, required_fields, parse_payload,
        parse_event_time, assign_event_time, late_filter, event_lag, infer_string_type,
        infer_value_type, observed_schema, schema_diff, schema_policy, schema_drift_report,
        batch_dedup, batch_dedup_dropped, tumbling_counts, field_mapping, null_defaults,
        cast_rules, concatenation, business_rules, static_lookup, lookup_table,
        lookup_table_large, range_lookup, multi_key_lookup, regex_lookup, conditional_set,
        derived_fields, normalize_text, entity_extraction, transform_all, validate_required,
        validate_length, validate_types, validate_all, event_counters, lag_distribution,
        lag_series, dashboard_series, alert_breaches, configured_alerts, nested_default,
        large_key_lookup, configured_table_lookup, event_time_check, source_by_mode, letters_target, backfill_run, stream_source,
        stream_windows, stream_dedup, stream_state_age, stream_letters, stream_counters, stream_lag_percentiles, streaming_run,
    ]
    out = {f.__name__: f for f in functions}
    out["row_id"] = row_ids
    for to in ("string", "integer", "float", "boolean", "date", "time", "datetime"):
        out[f"cast_{to}"] = _cast_query(to)
    return out
