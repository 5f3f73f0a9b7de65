"""Event time, envelope stamps, the late/early filter and event lag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import float_text
from sluice.functions.timetext import add_event_time
from sluice.operators.route import ok, reject_struct, reject_where, text_map


def assign_event_time(df: DataFrame) -> DataFrame:
    """``_event_time`` (TIMESTAMP) and ``event_timestamp`` (epoch seconds)."""
    out = add_event_time(df, F.col("event_ts"), F.col("_kinds.event_ts"), "_event_time")
    out = out.withColumn("event_timestamp", F.unix_micros("_event_time") / F.lit(1e6))
    return reject_where(
        out,
        F.col("_event_time").isNull(),
        reject_struct(
            "event_time", F.lit("Unsupported event_ts format"), F.lit("event_time_parse_failed")
        ),
    )


def stamp_envelope(df: DataFrame, processing_time: Column | None = None) -> DataFrame:
    """Event and processing time columns. The processing time is the clock by default."""
    now = F.current_timestamp() if processing_time is None else processing_time
    return df.withColumns({"beam_event_time": F.col("_event_time"), "beam_processing_time": now})


def lateness_seconds() -> Column:
    micros = F.unix_micros("beam_processing_time") - F.unix_micros("beam_event_time")
    return micros / F.lit(1e6)


def filter_late(
    df: DataFrame, allowed_lateness_sec: float, allowed_skew_sec: float = 0.0
) -> DataFrame:
    """Refuse events later than allowed, and events from the future.

    A comparison per row, not a watermark: the verdict never depends on other rows.
    """
    late = lateness_seconds()
    early = F.lit(0.0) - late
    out = reject_where(
        df,
        late > F.lit(float(allowed_lateness_sec)),
        reject_struct(
            "late_data",
            F.concat(F.lit("Late event dropped (lateness="), float_text(late), F.lit("s)")),
            detail=text_map(lateness_seconds=float_text(late)),
        ),
    )
    return reject_where(
        out,
        early > F.lit(float(allowed_skew_sec)),
        reject_struct(
            "late_data",
            F.concat(F.lit("Early event (early by "), float_text(early), F.lit("s)")),
            detail=text_map(early_seconds=float_text(early)),
        ),
    )


def event_lag_ms(now: Column | None = None) -> Column:
    """Milliseconds between the event and now; NULL for events at or before the epoch."""
    now = F.col("beam_processing_time") if now is None else now
    event_ms = F.unix_millis("_event_time")
    return F.when(ok() & (event_ms > 0), F.unix_millis(now) - event_ms)
