"""Left join against a table with unique keys that holds up under hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is hot. Hot keys number at most (all rows / HOT_ROWS), so
# the table of hot keys is small at any scale: 1e11 rows give at most 1e5 keys.
HOT_ROWS = 1_000_000
# Rows of a task where a row costs much (JSON, times, rules) but few bytes.
TASK_ROWS = 50_000


def spread(df: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """The rows dealt evenly over tasks of at most about ``task_rows`` rows, at least one per core.

    Tasks of a scan follow from bytes and row groups: narrow rows come a million to a task, and files with few
    row groups leave cores idle. For narrow columns of files, whose rows are counted from their footers.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-df.count() // task_rows)))


def hot_key_counts(df: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows; partial counts are merged before the shuffle."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows).drop("_n")


def split_join(
    left: DataFrame,
    cold: DataFrame,
    hot: DataFrame,
    key: str,
    value: str,
    spread_by: Sequence[str],
    no_match: Column | None = None,
) -> DataFrame:
    """Left join of ``left`` with ``cold`` and ``hot``, both ``(key, value)``, keys unique.

    ``hot`` must be bounded (see HOT_ROWS); it is broadcast. Rows it answers, and rows where
    ``no_match`` holds, take a random-looking second key in the shuffled join, so that no
    task gets all rows of one key. NULL keys match NULL keys.
    """
    hot_side = hot.select(
        F.col(key).alias("_hot_key"), F.col(value).alias("_hot_value"), F.lit(True).alias("_is_hot")
    )
    cold_side = cold.select(
        F.col(key).alias("_cold_key"), F.col(value).alias("_cold_value"),
        F.lit(0).cast("bigint").alias("_cold_spread"),
    )
    answered = F.col("_is_hot").isNotNull()
    if no_match is not None:
        answered = answered | no_match
    out = left.join(F.broadcast(hot_side), F.col(key).eqNullSafe(F.col("_hot_key")), "left")
    out = out.withColumn(
        "_spread",
        F.when(answered, F.xxhash64(*[F.col(c) for c in spread_by])).otherwise(
            F.lit(0).cast("bigint")
        ),
    )
    out = out.join(
        cold_side,
        F.col(key).eqNullSafe(F.col("_cold_key")) & (F.col("_spread") == F.col("_cold_spread")),
        "left",
    )
    matched = F.coalesce(F.col("_hot_value"), F.col("_cold_value"))
    if no_match is not None:
        matched = F.when(~no_match, matched)
    return out.withColumn(value, matched).drop(
        "_hot_key", "_hot_value", "_is_hot", "_spread", "_cold_key", "_cold_value", "_cold_spread"
    )
