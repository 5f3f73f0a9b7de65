"""Field mapping and the whole transform engine."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions import jsonvalue as J
from sluice.operators import casts, enrich
from sluice.operators.fields import EventFrame, Field, dynamic_field, null_field, typed
from sluice.operators.decode import ENVELOPE_FIELDS
from sluice.sources.sink_schema import KIND_OF_SINK, derive_schema


def start_event(df: DataFrame) -> EventFrame:
    """The fields every event has before mapping."""
    fields: dict[str, Field] = {c: typed("string", F.col(c)) for c in ENVELOPE_FIELDS}
    if "event_timestamp" in df.columns:
        fields["event_timestamp"] = typed("float", F.col("event_timestamp"))
    for c in ("beam_event_time", "beam_processing_time"):
        if c in df.columns:
            fields[c] = Field("timestamp", F.col(c))
    return EventFrame(df, fields)


def mapping_source(mapping: Any) -> str | None:
    return mapping.get("source") if isinstance(mapping, dict) else mapping


def field_mapping(event: EventFrame, mapping: dict, view_kinds: dict[str, str] | None = None) -> None:
    """``target: dotted.source``; an absent path gives NULL. The payload goes afterwards."""
    view_kinds = view_kinds or {}
    for target, spec in (mapping or {}).items():
        source = mapping_source(spec)
        if not source:
            event.set(target, null_field())
            continue
        keys = source.split(".")
        kind = view_kinds.get(target, "string")
        if keys[0] == "payload":
            payload = F.when(F.col("_payload_is_object"), F.col("_payload"))
            v = J.child(payload, *keys[1:]) if len(keys) > 1 else F.col("_payload")
            event.set(target, dynamic_field(v, kind))
        elif keys[0] in event.fields or keys[0] in event._pending:
            event.set(target, event.get(source))
        else:
            event.set(target, dynamic_field(J.child(F.col("_event"), *keys), kind))
    event.flush()


def view_kinds(transforms: dict, expected_schema: dict | None) -> dict[str, str]:
    """Type of the typed view of every mapped field: what the sink would derive for it."""
    columns = derive_schema({}, {"field_mapping": transforms.get("field_mapping") or {}}, expected_schema)
    return {name: KIND_OF_SINK.get(kind, "string") for name, kind in columns.items()}


def transform(df: DataFrame, transforms: dict, expected_schema: dict | None = None) -> EventFrame:
    """Map, default, cast, concatenate, apply rules, enrich, extract: in this order."""
    event = start_event(df)
    field_mapping(event, transforms.get("field_mapping") or {}, view_kinds(transforms, expected_schema))
    casts.null_defaults(event, transforms.get("null_defaults"))
    casts.type_casts(event, transforms.get("type_casts"))
    casts.concatenations(event, transforms.get("concatenations"))
    enrich.business_rules(event, transforms.get("business_rules"))
    enrich.enrichment(event, transforms.get("enrichment"))
    enrich.entity_extraction(event, transforms.get("entity_extraction"))
    return event
