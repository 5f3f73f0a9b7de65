"""Observed schema per event, the difference to the expected one, and the policy on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.jsonvalue import base_kind
from sluice.functions.timetext import string_kind
from sluice.operators.decode import ENVELOPE_FIELDS
from sluice.operators.route import SILENT, ok, pinned, reject_struct, reject_where

TEMPORAL = ("date", "time", "datetime", "timestamp")
_DIFF_TYPE = (
    "struct<new_fields:array<string>,missing_fields:array<string>,"
    "type_changes:map<string,struct<expected:string,observed:string>>>"
)


def value_kind(v: Column) -> Column:
    """Logical type of a VARIANT, with temporal kinds for strings."""
    kind = base_kind(v)
    return F.when(kind == "string", string_kind(F.try_variant_get(v, "$", "string"))).otherwise(kind)


def observed_schema() -> Column:
    """MAP of path to type: the envelope keys and ``payload.<key>`` of the top level."""
    envelope = F.create_map(
        *[
            c
            for k in ENVELOPE_FIELDS
            for c in (
                F.lit(k),
                F.when(
                    F.col(f"_kinds.{k}") == "string", string_kind(F.col(k))
                ).otherwise(F.col(f"_kinds.{k}")),
            )
        ]
    )
    values = F.when(
        F.col("_payload_is_object"),
        F.try_variant_get(F.col("_payload"), "$", "map<string,variant>"),
    )
    payload = F.transform_values(
        F.transform_keys(values, lambda k, _: F.concat(F.lit("payload."), k)),
        lambda _, v: value_kind(v),
    )
    empty = F.create_map().cast("map<string,string>")
    return F.map_concat(envelope, F.coalesce(payload, empty))


def allowed_kinds(expected: str) -> set[str]:
    """Members of a ``a|b`` type; a string allows its temporal kinds."""
    parts = {p.strip() for p in str(expected or "").strip().lower().split("|")} - {""}
    parts = parts or {"unknown"}
    return parts | set(TEMPORAL) if "string" in parts else parts


def schema_diff(observed: Column, expected: dict[str, str]) -> Column:
    """Sorted new and missing paths, and the paths of another type."""
    paths = sorted(expected)
    known = F.array(*[F.lit(p) for p in paths]).cast("array<string>")
    changes = F.array(
        *[
            F.when(
                observed[F.lit(p)].isNotNull()
                & ~observed[F.lit(p)].isin(*sorted(allowed_kinds(expected[p]))),
                F.struct(
                    F.lit(p).alias("key"),
                    F.struct(
                        F.lit(str(expected[p])).alias("expected"),
                        observed[F.lit(p)].alias("observed"),
                    ).alias("value"),
                ),
            )
            for p in paths
        ]
    )
    return F.struct(
        F.array_sort(F.array_except(F.map_keys(observed), known)).alias("new_fields"),
        F.filter(known, lambda p: ~F.map_contains_key(observed, p)).alias("missing_fields"),
        F.map_from_entries(F.filter(changes, lambda c: c.isNotNull())).alias("type_changes"),
    ).cast(_DIFF_TYPE)


def schema_changed(diff: Column) -> Column:
    return (
        (F.size(diff["new_fields"]) > 0)
        | (F.size(diff["missing_fields"]) > 0)
        | (F.size(diff["type_changes"]) > 0)
    )


def fast_match(expected: dict[str, str]) -> Column:
    """True only where the event surely equals the expected schema.

    Looks at the kind of each expected path and at the number of payload keys, without
    building maps and without temporal inference. Rows it does not clear are compared in
    full, so it never changes a result.
    """
    checks = [F.col("_payload_is_object")]
    payload_paths = [p for p in expected if p.startswith("payload.")]
    for p in sorted(expected):
        kinds = sorted(allowed_kinds(expected[p]) - set(TEMPORAL))
        if p.startswith("payload."):
            v = F.col(f"_values")[F.lit(p[len("payload."):])]
            checks.append(v.isNotNull() & base_kind(v).isin(*kinds))
        elif p in ENVELOPE_FIELDS:
            checks.append(F.col(f"_kinds.{p}").isin(*kinds))
        else:
            return F.lit(False)
    if set(ENVELOPE_FIELDS) - set(expected):
        return F.lit(False)
    checks.append(F.size(F.col("_values")) == len(payload_paths))
    result = checks[0]
    for c in checks[1:]:
        result = result & c
    return F.coalesce(result, F.lit(False))


def guard_schema(df: DataFrame, cfg: dict, expected: dict[str, str]) -> DataFrame:
    """Apply the evolution policy.

    Adds ``_schema_trace``: the difference of rows that go on although they differ. Rows
    refused carry the difference in their reject mark.
    """
    if not cfg.get("enabled", False):
        return df
    policy = cfg.get("evolution_policy") or {}
    fails = {
        "new_fields": str(policy.get("on_new_field", "ALLOW")).upper() == "FAIL",
        "missing_fields": str(policy.get("on_missing_field", "WARN")).upper() == "FAIL",
        "type_changes": str(policy.get("on_type_change", "WARN")).upper() == "FAIL",
    }
    out = df.withColumn(
        "_values",
        F.when(
            ok() & F.col("_payload_is_object"),
            F.try_variant_get(F.col("_payload"), "$", "map<string,variant>"),
        ),
    )
    out = out.withColumn("_observed", F.when(ok() & ~fast_match(expected), observed_schema()))
    out = out.withColumn(
        "_diff", F.when(F.col("_observed").isNotNull(), schema_diff(F.col("_observed"), expected))
    )
    out = out.withColumn(
        "_diff", F.when(F.coalesce(schema_changed(F.col("_diff")), F.lit(False)), F.col("_diff"))
    )
    reasons = F.filter(
        F.array(
            *[
                F.when(F.size(F.col(f"_diff.{kind}")) > 0, F.lit(kind))
                if failing
                else F.lit(None).cast("string")
                for kind, failing in fails.items()
            ]
        ),
        lambda r: r.isNotNull(),
    )
    out = out.withColumn("_fail_reasons", F.when(F.col("_diff").isNotNull(), F.array_join(reasons, ",")))
    version = F.lit(cfg.get("schema_version")).cast("string")
    record = F.struct(
        version.alias("schema_version"),
        F.to_json(F.col("_diff")).alias("diff"),
        F.to_json(_sorted_map(F.col("_observed"))).alias("observed_schema"),
    )
    violation = F.coalesce(F.col("_fail_reasons") != "", F.lit(False))
    out = out.withColumn(
        "_schema_record", F.when(F.col("_diff").isNotNull(), record)
    )
    silent = not cfg.get("dlq_on_violation", True)
    detail = F.create_map(
        F.lit("schema_version"), F.col("_schema_record.schema_version"),
        F.lit("diff"), F.col("_schema_record.diff"),
        F.lit("observed_schema"), F.col("_schema_record.observed_schema"),
    )
    out = out.withColumn(
        "_schema_trace", F.when(ok() & ~violation & F.col("_diff").isNotNull(), detail)
    )
    out = reject_where(
        out,
        violation,
        reject_struct(
            "schema",
            F.concat(F.lit("Schema policy violation: "), F.col("_fail_reasons")),
            F.lit(SILENT) if silent else None,
            detail,
        ),
    )
    return out.drop("_values", "_observed", "_diff", "_fail_reasons", "_schema_record")


def _sorted_map(m: Column) -> Column:
    return F.map_from_entries(F.array_sort(F.map_entries(m)))


def schema_traces(df: DataFrame) -> DataFrame:
    """Trace records of rows that differ but go on (their error is NULL)."""
    text = lambda: F.lit(None).cast("string")
    return df.filter(F.col("_schema_trace").isNotNull()).select(
        F.lit("schema").alias("stage"),
        F.col("event_id"),
        text().alias("error"),
        text().alias("reason"),
        F.col("_schema_trace").alias("detail"),
        text().alias("raw"),
        text().alias("message"),
        text().alias("message_base64"),
        text().alias("event_json"),
    )


def drift_report(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """How often each path is new, missing or of another type."""
    rows = df.filter(ok()).select(pinned(observed_schema()).alias("o"))
    rows = rows.select(pinned(schema_diff(F.col("o"), expected)).alias("d"))
    items = rows.select(
        F.explode(
            F.concat(
                F.transform(F.col("d.new_fields"), lambda p: _item("new", p)),
                F.transform(F.col("d.missing_fields"), lambda p: _item("missing", p)),
                F.transform(F.map_keys(F.col("d.type_changes")), lambda p: _item("type_change", p)),
            )
        ).alias("i")
    )
    return items.groupBy(F.col("i.kind").alias("kind"), F.col("i.path").alias("path")).agg(
        F.count(F.lit(1)).alias("events")
    )


def _item(kind: str, path: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), path.alias("path"))
