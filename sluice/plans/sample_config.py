"""A website's page visits: the configuration used by the registered queries, tests and examples."""

from __future__ import annotations

from sluice.config import JobConfig

EXPECTED_SCHEMA = {
    "event_id": "string",
    "event_type": "string",
    "event_source": "string",
    "event_ts": "string",
    "payload.visit_id": "string",
    "payload.page": "string",
    "payload.referrer": "null|string",
    "payload.region": "string",
    "payload.signed_in": "boolean",
    "payload.millis": "null|integer",
    "payload.day": "string",
    "payload.scroll": "integer",
}

TRANSFORMATIONS = {
    "field_mapping": {
        "visit_id": "payload.visit_id",
        "page": "payload.page",
        "came_from": "payload.referrer",
        "region": "payload.region",
        "signed_in": "payload.signed_in",
        "millis": {"source": "payload.millis", "type": "INT64"},
        "visit_day": "payload.day",
        "scroll_share": {"source": "payload.scroll", "type": "FLOAT64"},
    },
    # Visits without a referrer were typed in.
    "null_defaults": {"came_from": "direct"},
    "type_casts": [
        {"field": "millis", "to": "integer", "default": -1},
        {"field": "visit_day", "to": "date", "output_field": "day_checked", "default": None},
    ],
    "concatenations": [
        {"output_field": "step", "inputs": ["came_from", "page"], "separator": " > ", "default_value": "?"},
    ],
    "business_rules": [{"output_field": "bounced", "condition": "millis < 1000 AND NOT signed_in"}],
    "enrichment": [
        {
            "type": "static_lookup",
            "input_field": "region",
            "output_field": "zone",
            "lookup": {" North": 1, "south": 2},
            "default": 0,
            "output_type": "INT64",
        },
        {
            "type": "derived_fields",
            "fields": [
                {"output_field": "seconds", "expression": "millis / 1000", "type": "FLOAT64", "default": 0.0},
                {
                    "output_field": "week",
                    "expression": "date_format(date_trunc('WEEK', try_to_date(visit_day)), 'yyyy-MM-dd')",
                    "type": "STRING",
                    "default": "none",
                },
            ],
        },
    ],
    "entity_extraction": [{"field": "page", "entities": [{"name": "page_number", "pattern": "[0-9]+"}]}],
}

VALIDATION = {
    "required_fields": ["event_id", "event_ts"],
    "payload_required_fields": ["visit_id"],
    "length_checks": {"visit_id": {"min": 3, "max": 64}},
    "type_checks": {"signed_in": "BOOLEAN", "millis": "whole"},
}

DESTINATION = {
    "target": {"dataset": "web", "table": "visits"},
    "temp_table": {"dataset": "web_reruns", "table_prefix": "visits"},
    "envelope_fields": {"beam_event_time": "TIMESTAMP", "beam_processing_time": "TIMESTAMP"},
    "dlq_topic": "refused/live",
}

SCHEMA_MANAGEMENT = {
    "enabled": True,
    "schema_name": "visit",
    "evolution_policy": {"on_new_field": "WARN", "on_missing_field": "ALLOW", "on_type_change": "FAIL"},
    "dlq_on_violation": True,
}

STREAMING_TUNING = {
    "dedup": {"mode": "single", "buffer_seconds": 20, "max_state_age_sec": 3600},
    "sharding": {},
    "windowing": {"window_size_sec": 300, "allowed_lateness_sec": 120},
    "batching": {},
}

BACKFILL = {
    "sink": {"merge": {"merge_keys": ["event_id"]}},
    "safety": {"max_backfill_days": 31},
    "dlq": {"topic": "refused/reruns"},
}

OBSERVABILITY = {
    "alerts": {
        "refused_events": {"metric": "refused", "align": "SUM", "alignment_sec": 3600, "threshold": 2, "duration_sec": 7200},
        "slow_events": {"metric": "lag_ms", "align": "MEAN", "alignment_sec": 3600, "threshold": 5050, "duration_sec": 3600},
    }
}


def sample_config() -> JobConfig:
    return JobConfig(
        destination=DESTINATION,
        transformations=TRANSFORMATIONS,
        validation=VALIDATION,
        streaming_tuning=STREAMING_TUNING,
        raw_events={"table": "archive"},
        schema_management=SCHEMA_MANAGEMENT,
        expected_schema=EXPECTED_SCHEMA,
        backfill_settings=BACKFILL,
        observability=OBSERVABILITY,
    )
