"""The stages in order, shared by backfill and streaming."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.config import JobConfig
from sluice.operators import decode, dedup, event_time, route, schema_guard
from sluice.operators.skew import HOT_ROWS
from sluice.operators.transform import transform
from sluice.operators.validate import validate
from sluice.sources.sink_schema import derive_schema, final_columns


def check_events(
    decoded: DataFrame, cfg: JobConfig, streaming: bool, processing_time: Column | None = None
) -> DataFrame:
    """Payload, event time, stamps, lateness (streaming only) and schema guard. No shuffle."""
    out = decode.parse_payload(decoded)
    out = event_time.assign_event_time(out)
    out = event_time.stamp_envelope(out, processing_time)
    if streaming:
        windowing = cfg.streaming_tuning["windowing"]
        out = event_time.filter_late(
            out, windowing["allowed_lateness_sec"], windowing.get("allowed_skew_sec", 0.0)
        )
    if cfg.schema_management.get("enabled", False):
        out = schema_guard.guard_schema(out, cfg.schema_management, cfg.expected_schema)
    if "_schema_trace" not in out.columns:
        out = out.withColumn("_schema_trace", F.lit(None).cast("map<string,string>"))
    return out


@dataclass
class Routed:
    """All rows after the last stage: accepted, refused and traced."""

    df: DataFrame
    final: dict[str, Column]

    def final_rows(self) -> DataFrame:
        rows = route.accepted(self.df)
        return rows.select(*[c.alias(n) for n, c in self.final.items()])

    def dead_letters(self, with_traces: bool = True) -> DataFrame:
        body = F.to_json(F.struct(*[c.alias(n) for n, c in self.final.items() if n != "row_id"]))
        out = route.dead_letters(self.df, body)
        return route.union_dead_letters(out, schema_guard.schema_traces(self.df)) if with_traces else out


def transform_and_validate(df: DataFrame, cfg: JobConfig) -> Routed:
    event = transform(df, cfg.transformations, cfg.expected_schema)
    validate(event, cfg.validation)
    columns = derive_schema(cfg.destination, cfg.transformations, cfg.expected_schema)
    return Routed(event.df, final_columns(event, columns))


def backfill_stages(
    decoded: DataFrame,
    cfg: JobConfig,
    position: Sequence[str],
    processing_time: Column | None = None,
    hot_rows: int = HOT_ROWS,
) -> Routed:
    """Every stage of a backfill as one lazy plan."""
    checked = check_events(decoded, cfg, streaming=False, processing_time=processing_time)
    return transform_and_validate(dedup.batch_dedup(checked, position, hot_rows), cfg)
