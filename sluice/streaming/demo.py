"""Streams over files written from the given tables, run to their end and read back."""

from __future__ import annotations

import copy

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators import decode, metrics, route, windows
from sluice.plans.sample_config import sample_config
from sluice.session import work_dir
from sluice.sources import tables
from sluice.sources.messages import file_messages
from sluice.streaming.jobs import StreamingJob
from sluice.streaming.calendar import DeadlineCalendar
from sluice.streaming.latest import PACKED, pack

# Rows of a burst that leave the dedup per second at least, else the stream counts as stuck.
BURST_ROWS_PER_SEC = 1000

_RAW_COLUMNS = ["n", "c", "copy", "value", "proc_s", "message_id"]


def _to_files(df: DataFrame, name: str) -> tuple[str, str]:
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    return path, schema


def _run_to_table(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    spark = stream.sparkSession
    out = work_dir(spark, name)
    query = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", work_dir(spark, f"{name}-checkpoint"))
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def decode_stream(spark: SparkSession, raw: DataFrame) -> DataFrame:
    """Messages read as a stream and decoded; binary values, as a topic gives them."""
    binary = raw.select(*[F.col(c).cast("binary") if c == "value" else F.col(c) for c in _RAW_COLUMNS])
    path, schema = _to_files(binary, "messages")
    decoded = decode.decode_messages(file_messages(spark, path, schema))
    return _run_to_table(
        decoded.select(
            "n", "copy", "event_id", "event_type", "event_source", "event_ts",
            F.col("_payload_text").alias("payload_text"), "message_id", F.col("_reject.error").alias("error"),
        ),
        "decoded",
    )


def window_stream(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Tumbling counts of a stream. Update mode shows every window, also the open ones."""
    path, schema = _to_files(events.withColumn("ts", F.col("ts").cast("timestamp")), "events")
    stream = file_messages(spark, path, schema)
    counts = windows.tumbling_counts(
        stream, {"window_size_sec": 3600, "allowed_lateness_sec": 120}, "ts", ["event_type"], {"users": "user_id"}
    )
    out = work_dir(spark, "windows")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch", F.lit(batch_id)).write.mode("append").parquet(out)

    query = (
        counts.writeStream.foreachBatch(write)
        .option("checkpointLocation", work_dir(spark, "windows-checkpoint"))
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # The last update of a window is its total.
    panes = spark.read.parquet(out)
    last = panes.groupBy("window_start", "window_end", "event_type").agg(
        F.max(F.struct("batch", "events", "users")).alias("p")
    )
    return last.select("window_start", "window_end", "event_type", "p.events", "p.users")


def _calendar_run(spark: SparkSession, packed: DataFrame, calendar: DeadlineCalendar, out: str, name: str) -> DataFrame:
    """All events as a stream through the calendar, then a step behind the last deadline."""
    path, _ = _to_files(packed, name)
    last = [-1]

    def step(batch: DataFrame, batch_id: int) -> None:
        tables.write_batch_once(calendar.step(batch, batch_id, now_ms=batch_id), out, batch_id)
        last[0] = batch_id

    stream = spark.readStream.schema(PACKED).parquet(path)
    query = (
        stream.writeStream.foreachBatch(step).option("checkpointLocation", work_dir(spark, f"{name}-checkpoint")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    final = last[0] + 1
    tables.write_batch_once(calendar.flush(final, final + calendar.buffer_ms), out, final)
    return spark.read.schema(", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PACKED.fields) + ", route string, existing_us bigint").parquet(out)


def dedup_stream(spark: SparkSession, checked: DataFrame, buffer_seconds: float = 1.0) -> DataFrame:
    """Dedup of one burst: every id leaves once as main, its other versions do not."""
    calendar = DeadlineCalendar(spark, work_dir(spark, "pending"), buffer_seconds, 10**9, emit_superseded=True)
    rows = _calendar_run(spark, pack(route.accepted(checked)), calendar, work_dir(spark, "deduped"), "packed")
    return rows.select(
        "event_id", "event_us",
        F.when(F.col("route") == "main", "main").otherwise("not_main").alias("route"),
    )


def state_age(spark: SparkSession, events: DataFrame, max_age_sec: float) -> DataFrame:
    """Events by user in two steps, the second of which meets pending ones beyond the state age."""
    packed = events.select(
        F.col("user_id").cast("string").alias("event_id"), "event_type", F.lit("t").alias("event_source"), F.col("ts").cast("string").alias("event_ts"),
        *[F.lit(None).cast("string").alias(c) for c in ("kinds", "envelope")], F.col("event_id").cast("string").alias("payload_text"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("event_us"), F.lit(0).cast("bigint").alias("proc_us"),
    )
    calendar = DeadlineCalendar(spark, work_dir(spark, "aged-pending"), 100, max_age_sec, emit_superseded=True)
    out, number = work_dir(spark, "aged"), F.col("payload_text").cast("long") % 2
    tables.write_batch_once(calendar.step(packed.filter(number == 0), 0, 0), out, 0)
    tables.write_batch_once(calendar.step(packed.filter(number == 1), 1, 1), out, 1)
    # A replay gives the same rows.
    tables.write_batch_once(calendar.step(packed, 1, 2), f"{out}-replay", 1)
    tables.write_batch_once(calendar.flush(2, 10**6), out, 2)
    rows = spark.read.parquet(out)
    n = lambda what: F.count(F.when(F.col("route") == what, 1)).alias(what)
    main = F.max(F.when(F.col("route") == "main", F.col("event_us"))).alias("main_us")
    return rows.groupBy(F.col("event_id").cast("long").alias("user_id")).agg(main, n("main"), n("superseded"), n("expired"), n("dropped"))


def stream_counters(spark: SparkSession, raw: DataFrame) -> DataFrame:
    """Counters that the checking query wrote, over all its micro-batches."""
    path, schema = _to_files(raw.select(*_RAW_COLUMNS), "messages")
    job = StreamingJob(spark, sample_config(), work_dir(spark, "stream"), processing_time=F.timestamp_seconds("proc_s"))
    job.start_checks(file_messages(spark, path, schema), {"availableNow": True}).awaitTermination()
    return spark.read.parquet(job.counters).groupBy("counter").agg(F.sum("value").alias("value"))


def lag_percentile_stream(spark: SparkSession, events: DataFrame, window_sec: int, permille: dict[str, int]) -> DataFrame:
    """Percentiles of the lag from one sketch per micro-batch."""
    columns = ["beam_processing_time", "_event_time", "_reject"]
    path, schema = _to_files(events.select(*columns).repartition(4), "timed")
    out = work_dir(spark, "lag")

    def add(batch: DataFrame, batch_id: int) -> None:
        tables.write_batch_once(metrics.lag_buckets(batch, window_sec), out, batch_id)

    query = file_messages(spark, path, schema, max_files=1).writeStream.foreachBatch(add)
    query.option("checkpointLocation", work_dir(spark, "lag-checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return metrics.lag_percentiles(spark.read.parquet(out), permille)


def stream_letters(spark: SparkSession, raw: DataFrame) -> DataFrame:
    """Letters of messages that never became events, as the checking query wrote them."""
    path, schema = _to_files(raw.select(*_RAW_COLUMNS), "messages")
    job = StreamingJob(spark, sample_config(), work_dir(spark, "stream"), processing_time=F.timestamp_seconds("proc_s"))
    job.start_checks(file_messages(spark, path, schema), {"availableNow": True}).awaitTermination()
    letters = route.read_dead_letters(spark.read.text(job.letters))
    return letters.filter("stage = 'preprocess'").select("stage", "error", "message")


def full_stream(spark: SparkSession, raw: DataFrame) -> DataFrame:
    """Both streaming queries over all messages; the final table is read back."""
    path, schema = _to_files(raw.select(*_RAW_COLUMNS), "messages")
    cfg = copy.deepcopy(sample_config())
    cfg.streaming_tuning["dedup"].update(buffer_seconds=1, max_state_age_sec=10**9)
    job = StreamingJob(spark, cfg, work_dir(spark, "stream"), processing_time=F.timestamp_seconds("proc_s"))
    job.start_checks(file_messages(spark, path, schema), {"availableNow": True}).awaitTermination()
    # A whole table is one burst: the wait grows with it.
    rows = spark.read.parquet(job.checked).count()
    job.drain_final(job.start_final({"processingTime": "1 second"}), 900 + rows / BURST_ROWS_PER_SEC)
    return spark.read.parquet(job.table).select(
        "event_id", "event_ts", "visit_id", "millis", "step", "week", "scroll_share", "row_id"
    )
