"""Soft validation: every message of a row is collected."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.timetext import parse_event_time
from sluice.operators.fields import EventFrame
from sluice.operators.route import reject_struct, reject_where


def required_messages(event: EventFrame, cfg: dict) -> list[Column]:
    out = []
    for key, label in (("required_fields", "field"), ("payload_required_fields", "payload field")):
        for name in cfg.get(key) or []:
            f = event.get(name, nested=False)
            out.append(F.when(f.is_empty(), F.lit(f"Missing required {label}: {name}")))
    return out


def event_time_message(event: EventFrame) -> Column:
    f = event.get("event_ts", nested=False)
    if "event_ts" not in event.assigned and "_event_time" in event.df.columns:
        # Unchanged since the event time was read from it.
        return F.lit(None).cast("string")
    kind = f.kinds()
    bad = ~f.is_null() & parse_event_time(f.text(), kind).isNull()
    return F.when(bad, F.lit("event_ts is not in a supported timestamp format"))


def length_messages(event: EventFrame, cfg: dict) -> list[Column]:
    out = []
    for name, rules in (cfg.get("length_checks") or {}).items():
        n = F.length(event.get(name, nested=False).text())
        if "max" in rules:
            out.append(F.when(n > rules["max"], F.lit(f"{name} exceeds max length")))
        if "min" in rules:
            out.append(F.when(n < rules["min"], F.lit(f"{name} below min length")))
        if "equal" in rules:
            out.append(F.when(n != rules["equal"], F.lit(f"{name} must be exactly {rules['equal']} characters")))
    return out


# Names of type checks (exact case) and the kinds each accepts.
TYPE_CHECKS = {
    "STRING": ("string",),
    "INTEGER": ("integer", "boolean"),
    "BOOLEAN": ("boolean",),
}


def type_messages(event: EventFrame, cfg: dict) -> list[Column]:
    out = []
    for name, expected in (cfg.get("type_checks") or {}).items():
        if expected in TYPE_CHECKS:
            kind = event.get(name, nested=False).kinds()
            bad = (kind != "null") & ~kind.isin(*TYPE_CHECKS[expected])
            out.append(F.when(bad, F.lit(f"{name} not {expected}")))
    return out


def messages(checks: list[Column]) -> Column:
    if not checks:
        return F.array().cast("array<string>")
    return F.filter(F.array(*checks), lambda m: m.isNotNull())


def validate(event: EventFrame, cfg: dict) -> None:
    """Refuse rows with any message; the messages are kept in order."""
    event.flush()
    checks = required_messages(event, cfg) + [event_time_message(event)]
    checks += length_messages(event, cfg) + type_messages(event, cfg)
    event.df = event.df.withColumn("_messages", messages(checks))
    event.df = reject_where(
        event.df,
        F.size("_messages") > 0,
        reject_struct(
            "validation",
            F.array_join("_messages", "; "),
            detail=F.create_map(F.lit("validation_errors"), F.to_json("_messages")),
        ),
    )
