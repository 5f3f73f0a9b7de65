"""Streaming dedup without Python per key: a table of pending events with their deadlines.

Every micro-batch is one step: pending events and new ones meet by id in one shuffle, the newest event of an id stays, and
pending events whose deadline has come leave as ``main``. A step is written as one folder that appears as a
whole, split by route; its ``held`` part is the pending table that the next step reads. A replayed batch finds its
folder and gives the same rows again, with the clock of its first run. Only the two newest steps are kept.

Pending are the ids of one buffer period, so a step's work follows the rate of events, as that of the micro-batch does.
Events of a step count as arriving newest first; of equal times the pending one stays, then the larger
time text and content. A newer event replaces the pending one and starts its deadline anew; older and equal
ones are dropped. A pending event that is older than the newcomer by more than the state age is ``expired``, else ``superseded``.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.sources import tables
from sluice.streaming.latest import NAMES, PACKED

HELD = "held"
STEP = T.StructType(
    [*PACKED.fields, T.StructField("existing_us", T.LongType()), T.StructField("deadline_ms", T.LongType()), T.StructField("route", T.StringType())]
)
OUT = [*NAMES, "route", "existing_us"]


class DeadlineCalendar:
    """The pending events of a stream below a folder."""

    def __init__(self, spark: SparkSession, path: str, buffer_seconds: float, max_state_age_sec: float = 1800, emit_superseded: bool = False):
        self.spark, self.path = spark, path.rstrip("/")
        self.buffer_ms, self.max_age_us = int(buffer_seconds * 1000), int(max_state_age_sec * 1_000_000)
        self.emit_superseded = emit_superseded
        # Events that wait after the last step; None before the first.
        self.pending: int | None = None

    def _read(self, step: int) -> DataFrame:
        folder = f"{self.path}/batch_id={step}"
        return self.spark.read.schema(STEP).option("basePath", folder).parquet(folder)

    def step(self, batch: DataFrame, batch_id: int, now_ms: int | None = None) -> DataFrame:
        """Take in a micro-batch of packed events; the rows that leave, with ``route`` and ``existing_us``."""
        folders = tables.Folders(self.spark, self.path)
        done = sorted(int(n.split("=")[1]) for n in folders.names(self.path) if n.startswith("batch_id="))
        before = [n for n in done if n < batch_id]
        if batch_id not in done:
            now = int(time.time() * 1000) if now_ms is None else now_ms
            rows = batch.select(*NAMES, F.lit(None).cast("bigint").alias("deadline_ms"))
            if before:
                held = self._read(before[-1]).filter(F.col("route") == HELD)
                rows = rows.unionByName(held.select(*NAMES, "deadline_ms"))
            tables.write_batch_once(self._routed(rows, now), self.path, batch_id, "route")
        for n in before[:-1]:
            folders.delete(f"{self.path}/batch_id={n}")
        step = self._read(batch_id)
        self.pending = step.filter(F.col("route") == HELD).count()
        return step.filter(F.col("route") != HELD).select(*OUT)

    def _routed(self, rows: DataFrame, now: int) -> DataFrame:
        was_held = F.col("deadline_ms").isNotNull()
        newest = Window.partitionBy("event_id").orderBy(
            F.desc("event_us"), F.desc(was_held), F.desc("event_ts"), F.xxhash64(*NAMES)
        )
        ranked = rows.withColumns({"_rank": F.row_number().over(newest), "_newest_us": F.first("event_us").over(newest)})
        deadline = F.coalesce("deadline_ms", F.lit(now + self.buffer_ms).cast("bigint"))
        aged = F.col("_newest_us") - F.col("event_us") > self.max_age_us
        route = (
            F.when((F.col("_rank") == 1) & (deadline <= now), "main").when(F.col("_rank") == 1, HELD)
            .when(was_held & aged, "expired").when(was_held, "superseded").otherwise("dropped")
        )
        existing = F.when(F.col("_rank") > 1, F.col("_newest_us"))
        out = ranked.select(*NAMES, existing.alias("existing_us"), deadline.alias("deadline_ms"), route.alias("route"))
        return out if self.emit_superseded else out.filter(~F.col("route").isin("expired", "superseded"))

    def flush(self, batch_id: int, now_ms: int) -> DataFrame:
        """A step without new events."""
        return self.step(self.spark.createDataFrame([], PACKED), batch_id, now_ms)


def with_clock(packed: DataFrame) -> DataFrame:
    """The stream with one row without an id per second, so that deadlines come without new events."""
    clock = packed.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load()
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in PACKED.fields]
    return packed.select(*NAMES).unionByName(clock.select(*empty))
