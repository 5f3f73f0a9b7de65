"""The streaming job: two queries around the dedup of ids.

1. source -> decode -> archive; payload, time, lateness, schema guard -> dead letters and a
   table of checked events.
2. checked events -> dedup by a calendar of deadlines -> transform -> validate -> final table and dead letters.

Each micro-batch writes folders named by its number, so a replay repeats nothing.
"""

from __future__ import annotations

import datetime
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.config import JobConfig
from sluice.operators import decode, dedup, metrics, route, schema_guard
from sluice.operators.transform import mapping_source
from sluice.plans.stages import check_events, transform_and_validate
from sluice.session import WorkFolder
from sluice.sources import archive, tables, targets
from sluice.streaming.calendar import DeadlineCalendar, with_clock
from sluice.streaming.latest import PACKED, pack, unpack


# Window of the lag table that each micro-batch adds to.
LAG_WINDOW_SEC = 60


def needs_envelope(cfg: JobConfig) -> bool:
    """Whether a mapping reads envelope keys beyond the payload and the four standard ones."""
    sources = [mapping_source(s) or "" for s in (cfg.transformations.get("field_mapping") or {}).values()]
    known = {"payload", *decode.ENVELOPE_FIELDS}
    return any(s.split(".")[0] not in known for s in sources)


class StreamingJob:
    """Paths and queries of one streaming job below a warehouse folder."""

    def __init__(
        self,
        spark: SparkSession,
        cfg: JobConfig,
        warehouse: str,
        position: tuple[str, ...] = ("message_id",),
        processing_time: Column | None = None,
        pre_reduce: bool = True,
        emit_superseded: bool = False,
    ):
        self.spark, self.cfg, self.position = spark, cfg, position
        self.processing_time = processing_time
        self.pre_reduce, self.emit_superseded = pre_reduce, emit_superseded
        self.warehouse = root = warehouse.rstrip("/")
        self.archive = f"{root}/raw_archive"
        self.checked = f"{root}/checked_events"
        letters = f"{root}/{targets.letters_target(cfg.destination, cfg.backfill_settings, targets.STREAMING)}"
        # JSON lines of both queries lie at the target itself.
        self.letters = letters
        self.table = f"{root}/{targets.live_table(cfg.destination)}"
        self.counters, self.lag = f"{root}/metrics/counters", f"{root}/metrics/lag"
        # Sketches of the lag, for metrics.lag_percentiles.
        self.lag_buckets = f"{root}/metrics/lag_buckets"
        self.checkpoints = f"{root}/checkpoints"
        dedup_cfg = cfg.streaming_tuning.get("dedup") or {}
        self.calendar = None
        if dedup_cfg.get("mode", "single") != "none":
            self.calendar = DeadlineCalendar(
                spark, f"{root}/pending_events", dedup_cfg["buffer_seconds"], dedup_cfg.get("max_state_age_sec", 1800), emit_superseded
            )

    # -- query 1 ----------------------------------------------------------------------

    def check_batch(self, batch: DataFrame, batch_id: int) -> None:
        # One clock value per batch: actions on the batch must agree.
        now = self.processing_time
        if now is None:
            now = F.lit(datetime.datetime.now(datetime.timezone.utc))
        folder = WorkFolder(self.spark, "checks", below=self.warehouse)
        try:
            checked = self._checked(batch, now, folder)
            # What the archive takes: every message that could be decoded.
            decoded = checked.withColumn("_reject", F.when(metrics.stage_is("preprocess"), F.col("_reject")))
            archive.write_archive_batch(archive.archive_rows(decoded, F.col("_ingest_ts")), self.archive, batch_id)
            checked = self._reduced(checked, folder)
            letters = route.union_dead_letters(
                route.dead_letters(checked), schema_guard.schema_traces(checked)
            )
            tables.write_batch_once(route.dead_letter_json(letters), self.letters, f"checks-{batch_id}", text=True)
            packed = pack(route.accepted(checked), needs_envelope(self.cfg))
            tables.write_batch_once(packed, self.checked, batch_id)
            tables.write_batch_once(metrics.event_counters(checked).coalesce(1), self.counters, batch_id)
            lag = metrics.lag_distribution(checked.filter(route.ok()), LAG_WINDOW_SEC)
            tables.write_batch_once(lag.coalesce(1), self.lag, batch_id)
            sketch = metrics.lag_buckets(checked.filter(route.ok()), LAG_WINDOW_SEC)
            tables.write_batch_once(sketch.coalesce(1), self.lag_buckets, batch_id)
        finally:
            folder.close()

    def _checked(self, batch: DataFrame, now: Column, folder: WorkFolder) -> DataFrame:
        """Checked rows as a table, which archive and dedup read: each JSON text is parsed once.

        Tables and no cached rows, as a large batch does not fit executors: when cached batches of columns go
        to disk, Java's serializer holds up to a hundred of them of each task outside Spark's memory.
        """
        checked = check_events(decode.decode_messages(batch), self.cfg, streaming=True, processing_time=now)
        # The message is kept only where a letter shows it.
        text = F.when(metrics.stage_is("preprocess"), F.col("_text"))
        raw = [c for c in ("value",) if c not in self.position]
        return folder.write(checked.withColumns({"_text": text, "_ingest_ts": now}).drop(*raw), "checked")

    def _reduced(self, checked: DataFrame, folder: WorkFolder) -> DataFrame:
        """At most one accepted row per id, as a table, if the job reduces a batch before the dedup."""
        narrow = checked.drop("_pubsub", "_ingest_ts", *([] if needs_envelope(self.cfg) else ["_event"]))
        dedup_cfg = self.cfg.streaming_tuning.get("dedup") or {}
        if not self.pre_reduce or dedup_cfg.get("mode", "single") == "none":
            return narrow
        # At most one row per id and batch reaches the state, however hot the id is.
        # The batch counts as arriving newest first.
        reduced = dedup.batch_dedup(narrow, self.position, stage_reason="duplicate_or_older_event")
        reduced = folder.write(reduced, "reduced")
        folder.drop("checked")
        return reduced

    def start_checks(self, messages: DataFrame, trigger: dict) -> StreamingQuery:
        return (
            messages.writeStream.foreachBatch(self.check_batch)
            .option("checkpointLocation", f"{self.checkpoints}/checks")
            .trigger(**trigger)
            .start()
        )

    # -- query 2 ----------------------------------------------------------------------

    def final_batch(self, batch: DataFrame, batch_id: int) -> None:
        main = batch.filter(F.col("route") == "main").drop("route", "existing_us")
        routed = transform_and_validate(unpack(main), self.cfg)
        tables.write_table(routed.final_rows(), self.table, batch_id)
        others = batch.filter(F.col("route") != "main")
        reason = F.when(F.col("route") == "dropped", F.lit("duplicate_or_older_event")).otherwise(F.col("route"))
        dropped = others.select(
            F.lit("dedup").alias("stage"), "event_id", F.lit(None).cast("string").alias("error"),
            reason.alias("reason"),
            route.text_map(
                existing_ts=F.col("existing_us") / F.lit(1e6), incoming_ts=F.col("event_us") / F.lit(1e6)
            ).alias("detail"),
            *[F.lit(None).cast("string").alias(c) for c in ("raw", "message", "message_base64")],
            F.to_json(F.struct("event_id", "event_type", "event_source", "event_ts", "payload_text")).alias("event_json"),
        )
        letters = route.union_dead_letters(routed.dead_letters(with_traces=False), dropped)
        tables.write_batch_once(route.dead_letter_json(letters), self.letters, f"final-{batch_id}", text=True)

    def dedup_batch(self, batch: DataFrame, batch_id: int) -> None:
        if self.calendar is None:
            routed = batch.withColumns({"route": F.lit("main"), "existing_us": F.lit(None).cast("bigint")})
        else:
            routed = self.calendar.step(batch.filter(F.col("event_id").isNotNull()), batch_id)
        self.final_batch(routed, batch_id)

    def start_final(self, trigger: dict) -> StreamingQuery:
        checked = self.spark.readStream.schema(PACKED).parquet(f"{self.checked}/batch_id=*")
        return (
            (checked if self.calendar is None else with_clock(checked))
            .writeStream.foreachBatch(self.dedup_batch)
            .option("checkpointLocation", f"{self.checkpoints}/final")
            .trigger(**trigger)
            .start()
        )

    def drain_final(self, query: StreamingQuery, timeout_sec: float = 900) -> None:
        """Wait until the checked events are read and none is pending, then stop. For complete input."""
        deadline = time.time() + timeout_sec
        try:
            while time.time() < deadline:
                progress = query.lastProgress
                files = [s["numInputRows"] for s in progress["sources"] if "File" in s["description"]] if progress else [1]
                if not any(files) and self.calendar.pending == 0:
                    return
                if not query.isActive:
                    raise RuntimeError(f"stream stopped: {query.exception()}")
                time.sleep(0.1)
            raise TimeoutError("the stream did not drain")
        finally:
            query.stop()


def run_streaming(
    spark: SparkSession,
    cfg: JobConfig,
    messages: DataFrame,
    warehouse: str,
    trigger_seconds: int = 60,
    **options,
) -> tuple[StreamingJob, list[StreamingQuery]]:
    """Start both queries; the caller awaits or stops them."""
    job = StreamingJob(spark, cfg, warehouse, **options)
    trigger = {"processingTime": f"{trigger_seconds} seconds"}
    return job, [job.start_checks(messages, trigger), job.start_final(trigger)]


def drain(query: StreamingQuery, timeout_sec: float = 900) -> None:
    """Wait until all input is read and no key waits for its timer, then stop.

    For input that is complete before the query starts. (``processAllAvailable`` does not
    return while processing-time timers keep batches running.)
    """
    deadline = time.time() + timeout_sec
    try:
        while time.time() < deadline:
            progress = query.lastProgress
            if progress:
                states = progress["stateOperators"]
                if progress["numInputRows"] == 0 and all(s["numRowsTotal"] == 0 for s in states):
                    return
            if not query.isActive:
                raise RuntimeError(f"stream stopped: {query.exception()}")
            time.sleep(0.2)
        raise TimeoutError("the stream did not drain")
    finally:
        query.stop()
