"""Counters, lag, time series and threshold alerts as queries over routed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from sluice.operators.event_time import event_lag_ms

STAGES = ("preprocess", "parse", "event_time", "late_data", "schema", "dedup", "transform", "validation")


def stage_is(stage: str) -> Column:
    return F.col("_reject.stage").eqNullSafe(stage)


def counter_columns(has_trace: bool = True) -> list[Column]:
    """All counters of a run as conditional counts: one pass, one row."""
    ok = F.col("_reject").isNull()
    trace = F.col("_schema_trace").isNotNull() if has_trace else F.lit(False)
    in_dedup = ok | F.col("_reject.stage").isin("dedup", "transform", "validation")
    return [
        F.count(F.lit(1)).alias("events_in"),
        F.count_if(ok).alias("events_out"),
        # A decode failure counts as a parse error too.
        F.count_if(stage_is("preprocess") | stage_is("parse")).alias("parse_errors"),
        F.count_if(stage_is("validation")).alias("validation_errors"),
        F.count_if(stage_is("transform")).alias("transform_errors"),
        (F.count_if(~ok) + F.count_if(trace)).alias("dlq_events"),
        F.count_if(in_dedup).alias("dedup_seen"),
        F.count_if(in_dedup & ~stage_is("dedup")).alias("dedup_emitted"),
        F.count_if(stage_is("dedup")).alias("dedup_dropped"),
        (F.count_if(stage_is("schema")) + F.count_if(trace)).alias("evolution_detected"),
    ]


def event_counters(routed: DataFrame) -> DataFrame:
    """Counters by name. Errors per stage are named ``stage_errors.<stage>``."""
    names = [
        "events_in", "events_out", "parse_errors", "validation_errors", "transform_errors",
        "dlq_events", "dedup_seen", "dedup_emitted", "dedup_dropped", "evolution_detected",
    ]
    has_trace = "_schema_trace" in routed.columns
    trace = F.col("_schema_trace").isNotNull() if has_trace else F.lit(False)
    stage_counts = [
        (F.count_if(stage_is(s)) + (F.count_if(trace) if s == "schema" else F.lit(0))).alias(f"stage_errors.{s}")
        for s in ("preprocess", "parse", "schema", "transform", "validation")
    ]
    names += [f"stage_errors.{s}" for s in ("preprocess", "parse", "schema", "transform", "validation")]
    one = routed.agg(*counter_columns(has_trace), *stage_counts)
    pairs = F.array(
        *[F.struct(F.lit(n).alias("counter"), F.col(f"`{n}`").cast("bigint").alias("value")) for n in names]
    )
    return one.select(F.inline(pairs))


def lag_distribution(df: DataFrame, window_sec: int, now: Column | None = None) -> DataFrame:
    """Count, sum, min and max of event lag per tumbling window of processing time."""
    lag = df.withColumn("_lag", event_lag_ms(now)).filter(F.col("_lag").isNotNull())
    return lag.groupBy(tumbling("beam_processing_time", window_sec).alias("window_start")).agg(
        F.count("_lag").alias("lag_count"),
        F.sum("_lag").alias("lag_sum"),
        F.min("_lag").alias("lag_min"),
        F.max("_lag").alias("lag_max"),
    )


def lag_series(df: DataFrame, window_sec: int, now: Column | None = None) -> DataFrame:
    """Largest lag and its true 95th percentile per window.

    The percentile keeps one count per distinct lag. Lags are whole milliseconds within the
    allowed lateness, so a window holds a bounded number of them however many events it has.
    """
    lag = df.withColumn("_lag", event_lag_ms(now)).filter(F.col("_lag").isNotNull())
    return lag.groupBy(tumbling("beam_processing_time", window_sec).alias("window_start")).agg(
        F.max("_lag").alias("lag_max"), F.percentile("_lag", 0.95).alias("lag_p95")
    )


# Leading bits of a lag that its bucket keeps: the middle of a bucket is at most 1/128 away from any lag in it.
LAG_BITS = 7


def _dropped_bits(size: Column) -> Column:
    return F.greatest(F.length(F.bin(size)) - LAG_BITS, F.lit(0))


def lag_buckets(df: DataFrame, window_sec: int, now: Column | None = None) -> DataFrame:
    """Events per window and bucket of lag: a sketch of the distribution that merges by adding counts.

    A bucket holds the lags whose first LAG_BITS bits agree and is named by the one nearest to 0. Below 2^LAG_BITS
    milliseconds each lag is its own bucket, so a window has at most some thousand of them.
    """
    lag = df.withColumn("_lag", event_lag_ms(now)).filter(F.col("_lag").isNotNull())
    size = F.abs("_lag")
    dropped = _dropped_bits(size)
    low = F.call_function("shiftleft", F.call_function("shiftright", size, dropped), dropped)
    return lag.groupBy(
        tumbling("beam_processing_time", window_sec).alias("window_start"), (F.signum("_lag").cast("long") * low).alias("lag_low")
    ).agg(F.count(F.lit(1)).alias("events"))


def lag_percentiles(buckets: DataFrame, permille: dict[str, int]) -> DataFrame:
    """Percentiles per window from any number of tables of ``lag_buckets``, laid one below the other.

    ``permille`` names the columns. Of n lags in order, the one at place ceil(n * permille / 1000) is looked for; the
    result is the middle of its bucket, whatever the cutting into batches.
    """
    merged = buckets.groupBy("window_start", "lag_low").agg(F.sum("events").alias("events"))
    order = Window.partitionBy("window_start").orderBy("lag_low")
    placed = merged.withColumns({
        "_upto": F.sum("events").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_all": F.sum("events").over(Window.partitionBy("window_start")),
    })
    size = F.abs("lag_low")
    width = F.call_function("shiftleft", F.lit(1).cast("long"), _dropped_bits(size))
    middle = F.signum("lag_low") * (size + (width - 1) / 2)
    # The first bucket that reaches the place.
    return placed.groupBy("window_start").agg(
        F.sum("events").alias("lag_count"),
        *[
            F.min_by(middle, F.when(F.col("_upto") * 1000 >= F.col("_all") * p, F.col("lag_low"))).alias(name)
            for name, p in permille.items()
        ],
    )


def tumbling(column: str, window_sec: int) -> Column:
    """Start of the epoch-aligned window as epoch seconds."""
    seconds = F.unix_seconds(F.col(column))
    return seconds - F.pmod(seconds, F.lit(window_sec))


def stage_series(routed: DataFrame, time_column: str, window_sec: int) -> DataFrame:
    """Events in and out, dedup drops, dead letters and errors by stage per window."""
    at = tumbling(time_column, window_sec)
    stage = F.coalesce(F.col("_reject.stage"), F.lit("accepted"))
    return routed.groupBy(at.alias("window_start"), stage.alias("stage")).agg(
        F.count(F.lit(1)).alias("events")
    )


# Windows that one task looks at together when runs are found.
CHUNK_WINDOWS = 4096


def _runs(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows (start, end, windows, peak) that follow each other without a gap, as one row."""
    order = Window.partitionBy(*keys).orderBy("breach_start")
    new = F.when(F.col("breach_start") == F.lag("breach_end").over(order), 0).otherwise(1)
    marked = rows.withColumn("_new", new).withColumn("_run", F.sum("_new").over(order))
    return marked.groupBy(*keys, "_run").agg(
        F.min("breach_start").alias("breach_start"), F.max("breach_end").alias("breach_end"),
        F.sum("windows").alias("windows"), F.max("peak").alias("peak"),
    ).drop("_run")


def alert_breaches(
    series: DataFrame,
    value: str,
    threshold: float | Column,
    duration_sec: int | Column,
    alignment_sec: int | Column,
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """Runs of consecutive windows above the threshold that last at least the duration.

    ``series`` has ``window_start`` (epoch seconds) and one aligned value per window. Runs are
    found in stretches of ``CHUNK_WINDOWS`` windows first; only the runs of a series, not its
    windows, then meet in one task. A window without data ends a run.
    """
    width = F.lit(alignment_sec) if not isinstance(alignment_sec, Column) else alignment_sec
    limit = F.lit(threshold) if not isinstance(threshold, Column) else threshold
    least = F.lit(duration_sec) if not isinstance(duration_sec, Column) else duration_sec
    over = series.filter(F.col(value) > limit).select(
        *keys, F.floor(F.col("window_start") / (width * CHUNK_WINDOWS)).alias("_chunk"),
        F.col("window_start").alias("breach_start"), (F.col("window_start") + width).alias("breach_end"),
        F.lit(1).cast("long").alias("windows"), F.col(value).alias("peak"), least.alias("_least"),
    )
    wide = (*keys, "_least")
    runs = _runs(_runs(over, (*wide, "_chunk")).drop("_chunk"), wide)
    return runs.filter(F.col("breach_end") - F.col("breach_start") >= F.col("_least")).drop("_least")


def alert_points(routed: DataFrame, at: Column, now: Column | None = None) -> DataFrame:
    """(metric, at, value) that configured alerts watch: a row per refused event and stage, and
    the lag of each accepted one."""
    refused = routed.filter(F.col("_reject").isNotNull()).select(
        F.explode(F.array(F.lit("refused"), F.concat(F.lit("refused."), F.col("_reject.stage")))).alias("metric"),
        at.alias("at"), F.lit(1.0).alias("value"),
    )
    lag = routed.filter(F.col("_reject").isNull()).select(
        F.lit("lag_ms").alias("metric"), at.alias("at"), event_lag_ms(now).cast("double").alias("value")
    )
    return refused.unionByName(lag.filter(F.col("value").isNotNull()))


def configured_alerts(points: DataFrame, observability: dict) -> DataFrame:
    """Breaches of the alerts that the configuration lists, by alert name.

    Each alert names its metric, how values of a window are aligned (SUM or MEAN), the window,
    the threshold and how long it must be exceeded. All alerts are one aggregate: the list is
    a literal of the configuration's size.
    """
    alerts = [
        F.struct(
            F.lit(name).alias("alert"), F.lit(str(a["metric"])).alias("watched"),
            F.lit(str(a.get("align", "SUM")).upper()).alias("align"), F.lit(int(a.get("alignment_sec", 60))).cast("long").alias("width"),
            F.lit(float(a["threshold"])).alias("threshold"), F.lit(int(a.get("duration_sec", 0))).cast("long").alias("least"),
        )
        for name, a in (observability.get("alerts") or {}).items()
    ]
    if not alerts:
        raise ValueError("observability.alerts lists no alert")
    matching = F.filter(F.array(*alerts), lambda a: a["watched"] == F.col("metric"))
    rows = points.select(F.explode(matching).alias("a"), F.unix_seconds("at").alias("s"), "value").select("a.*", "s", "value")
    aligned = rows.groupBy(
        "alert", "align", "width", "threshold", "least", (F.col("s") - F.pmod("s", "width")).alias("window_start")
    ).agg(F.sum("value").alias("total"), F.avg("value").alias("mean"))
    series = aligned.withColumn("aligned", F.when(F.col("align") == "MEAN", F.col("mean")).otherwise(F.col("total")))
    return alert_breaches(series, "aligned", F.col("threshold"), F.col("least"), F.col("width"), ("alert",))
