"""Batch dedup: keep the latest version of every event id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.route import ok, reject_struct, reject_where, text_map
from sluice.operators.skew import HOT_ROWS, split_join


def batch_dedup(
    df: DataFrame,
    position: Sequence[str],
    hot_rows: int = HOT_ROWS,
    stage_reason: str = "batch_duplicate",
) -> DataFrame:
    """Refuse every row of an id but the one with the latest event time.

    ``position`` names columns that together identify an input row (message id, topic
    offset, or file and row number). They make the order total, so exactly one row per id
    stays even among byte-equal copies, and reruns choose the same one.

    Plan: a narrow aggregate per id finds the winner (partial results are merged before the
    shuffle, so an id with a third of all rows costs one row per task). Only ids with more
    than one row are joined back. No group of rows is ever collected or sorted in one task.
    """
    order = F.struct(
        F.col("_event_time").alias("t"),
        F.col("event_ts").alias("ts"),
        F.xxhash64("_payload_text").alias("h"),
        *[F.col(c) for c in position],
    )
    summary = (
        df.filter(ok())
        .groupBy("event_id")
        .agg(F.count(F.lit(1)).alias("_n"), F.max(order).alias("_best"))
        .filter(F.col("_n") > 1)
    )
    rejected = ~ok()
    out = split_join(
        df,
        summary.filter(F.col("_n") <= hot_rows),
        summary.filter(F.col("_n") > hot_rows),
        "event_id",
        "_best",
        list(position),
        no_match=rejected,
    )
    beaten = F.col("_best").isNotNull() & (order != F.col("_best"))
    out = reject_where(
        out,
        beaten,
        reject_struct(
            "dedup",
            None,
            F.lit(stage_reason),
            text_map(kept_event_ts=F.col("_best.ts")),
        ),
    )
    return out.drop("_best")
