"""Connected components by alternating star contractions; links never leave the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import SMALL_ROWS, WorkFolder, join_side

MAX_ROUNDS = 60


def lowest(edges: DataFrame) -> DataFrame:
    """(id, low, star) of every id in ``edges`` (a, b), a > b: its smallest neighbour or itself, and whether it stands in a star.

    It does with one smaller neighbour, or only larger ones. Edges may repeat.
    """
    ends = edges.select(F.col("a").alias("id"), F.col("b").alias("less"), F.lit(False).alias("over")).unionByName(
        edges.select(F.col("b").alias("id"), F.lit(None).cast("long").alias("less"), F.lit(True).alias("over"))
    )
    found = ends.groupBy("id").agg(F.min("less").alias("low"), F.max("less").alias("high"), F.max("over").alias("over"))
    star = F.col("low").isNull() | ((F.col("low") == F.col("high")) & ~F.col("over"))
    return found.select("id", F.coalesce("low", "id").alias("low"), star.alias("star"))


def components(links: DataFrame, folder: WorkFolder, name: str) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b); a component is named by its smallest id.

    Each round hangs larger neighbours on the smallest one, then smaller ones likewise, until all are
    stars; then the smallest neighbours are the components. A round shuffles three times while its ids are few, and once
    where links are stars already. Minima are aggregated before the shuffle, so a hub costs a row per
    task. Every round is a table of its own, so a lost executor repeats one round at most.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = folder.write(edges, f"{name}-0")
    for i in range(1, MAX_ROUNDS):
        low = folder.write(lowest(edges), f"{name}-low-{i}")
        n, apart = low.agg(F.count("*"), F.count_if(~F.col("star"))).first()
        if not apart:
            break
        large = edges.join(join_side(low.select(F.col("id").alias("b"), "low"), n), "b").select("a", F.col("low").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        # Dealt anew, so that the join may split a hub's rows (they would stay with the aggregate).
        dealt = join_side(least.repartition("a", "low") if n > SMALL_ROWS else least, n)
        small = large.join(dealt, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        stars = small.unionByName(least.withColumnRenamed("low", "b")).distinct()
        edges = folder.write(stars, f"{name}-{i}")
        folder.drop(f"{name}-{i - 1}", f"{name}-low-{i}")
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    folder.drop(f"{name}-{i - 1}")
    return low.select("id", F.col("low").alias("component"))
