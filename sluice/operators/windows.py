"""Tumbling windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_windowing(cfg: dict) -> None:
    kind = cfg.get("type", "fixed")
    if kind != "fixed":
        raise ValueError(f"Unsupported window type: {kind}")
    if "window_size_sec" not in cfg:
        raise KeyError("window_size_sec")


def output_mode(cfg: dict) -> str:
    """``update`` shows early and late panes as running totals, ``append`` one final row."""
    accumulating = cfg.get("accumulation_mode", "DISCARDING") == "ACCUMULATING"
    early = cfg.get("early_trigger_sec") is not None or cfg.get("late_trigger_count") is not None
    return "update" if accumulating or early else "append"


def tumbling_counts(
    df: DataFrame, cfg: dict, time_column: str, keys: list[str], sums: dict[str, str] | None = None
) -> DataFrame:
    """Counts and sums per window and key; the same plan serves batch and stream.

    On a stream the allowed lateness becomes the watermark delay.
    """
    check_windowing(cfg)
    if df.isStreaming:
        df = df.withWatermark(time_column, f"{cfg.get('allowed_lateness_sec', 0)} seconds")
    window = F.window(F.col(time_column), f"{cfg['window_size_sec']} seconds")
    aggregates: list[Column] = [F.count(F.lit(1)).alias("events")]
    aggregates += [F.sum(F.expr(e)).alias(name) for name, e in (sums or {}).items()]
    out = df.groupBy(window.alias("w"), *[F.col(k) for k in keys]).agg(*aggregates)
    names = [*keys, "events", *(sums or {})]
    return out.select(
        F.unix_seconds("w.start").alias("window_start"), F.unix_seconds("w.end").alias("window_end"), *names
    )
