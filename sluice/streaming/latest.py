"""Streaming dedup: hold the latest version of an id until it has been quiet for a while."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

# The processor travels with the query, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Columns of an event on its way through the keyed state.
PACKED = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_source", T.StringType()),
        T.StructField("event_ts", T.StringType()),
        T.StructField("kinds", T.StringType()),
        T.StructField("envelope", T.StringType()),
        T.StructField("payload_text", T.StringType()),
        T.StructField("event_us", T.LongType()),
        T.StructField("proc_us", T.LongType()),
    ]
)
NAMES = PACKED.names
# What the state of a key holds: its newest event, and when it has been quiet long enough.
HELD = T.StructType([*PACKED.fields, T.StructField("deadline_ms", T.LongType())])
ROUTED = T.StructType(
    [*PACKED.fields, T.StructField("route", T.StringType()), T.StructField("existing_us", T.LongType())]
)


class LatestEvent(StatefulProcessor):
    """Value state with the newest event of the key and its deadline, and one processing-time timer.

    A strictly newer event replaces the buffered one and moves the deadline. An older or equal
    one leaves with route ``dropped``. A timer that fires before the deadline is set again for
    it, so that an update costs no look at the timers; at the deadline the buffered event leaves
    with route ``main`` and the state is cleared, so a later event starts anew. Rows are taken
    one by one; a key's rows are never held together.
    """

    def __init__(self, buffer_seconds: float, max_state_age_sec: float, emit_superseded: bool):
        self.buffer_ms = int(buffer_seconds * 1000)
        self.max_age_us = int(max_state_age_sec * 1_000_000)
        self.emit_superseded = emit_superseded

    def init(self, handle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", HELD)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # get() gives None where the key has no state.
        held = self.latest.get()
        had_timer = held is not None
        held = tuple(held)[: len(NAMES)] if had_timer else None
        held_us = held[NAMES.index("event_us")] if had_timer else None
        changed = False
        for row in rows:
            us = row["event_us"]
            if held is not None and us - held_us > self.max_age_us:
                if self.emit_superseded:
                    yield self._out(held, "superseded", us)
                held = None
            if held is None or us > held_us:
                if held is not None and self.emit_superseded:
                    yield self._out(held, "superseded", us)
                held, held_us, changed = tuple(row[n] for n in NAMES), us, True
            else:
                yield self._out(tuple(row[n] for n in NAMES), "dropped", held_us)
        if changed:
            deadline = timerValues.getCurrentProcessingTimeInMs() + self.buffer_ms
            self.latest.update((*held, deadline))
            if not had_timer:
                self.handle.registerTimer(deadline)

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self.latest.get()
        if held is not None:
            *event, deadline = held
            if deadline > timerValues.getCurrentProcessingTimeInMs():
                self.handle.registerTimer(deadline)
                return
            yield self._out(event, "main", None)
        self.latest.clear()

    def close(self) -> None:
        pass

    @staticmethod
    def _out(values, route: str, existing_us: int | None) -> Row:
        return Row(*ROUTED.names)(*tuple(values), route, existing_us)


def pack(df: DataFrame, with_envelope: bool = False) -> DataFrame:
    """Checked events as the columns the state holds. The payload stays the received text."""
    envelope = F.to_json("_event") if with_envelope else F.lit(None).cast("string")
    return df.select(
        "event_id", "event_type", "event_source", "event_ts",
        F.to_json("_kinds").alias("kinds"),
        envelope.alias("envelope"),
        F.col("_payload_text").alias("payload_text"),
        F.unix_micros("beam_event_time").alias("event_us"),
        F.unix_micros("beam_processing_time").alias("proc_us"),
    )


def unpack(df: DataFrame) -> DataFrame:
    """Back to the layout of checked events."""
    from sluice.operators.decode import ENVELOPE_FIELDS, parse_payload
    from sluice.operators.route import REJECT_TYPE

    kinds = "struct<" + ",".join(f"{c}:string" for c in ENVELOPE_FIELDS) + ">"
    at = F.timestamp_micros("event_us")
    out = df.withColumns(
        {
            "_kinds": F.from_json("kinds", kinds),
            "_event": F.try_parse_json("envelope"),
            "_payload_text": F.col("payload_text"),
            "_payload_obj": F.lit(None).cast("variant"),
            "_text": F.lit(None).cast("string"),
            "_event_time": at,
            "event_timestamp": F.col("event_us") / F.lit(1e6),
            "beam_event_time": at,
            "beam_processing_time": F.timestamp_micros("proc_us"),
            "_reject": F.lit(None).cast(REJECT_TYPE),
            "_schema_trace": F.lit(None).cast("map<string,string>"),
        }
    )
    return parse_payload(out).drop("kinds", "envelope", "payload_text", "event_us", "proc_us")


def dedup_stream(
    packed: DataFrame,
    buffer_seconds: float,
    max_state_age_sec: float = 1800,
    emit_superseded: bool = False,
) -> DataFrame:
    """Packed events with ``route`` main, dropped or (on request) superseded."""
    return packed.groupBy("event_id").transformWithState(
        statefulProcessor=LatestEvent(buffer_seconds, max_state_age_sec, emit_superseded),
        outputStructType=ROUTED,
        outputMode="Append",
        timeMode="ProcessingTime",
    )
