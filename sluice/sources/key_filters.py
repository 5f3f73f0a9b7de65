"""Bloom filters of the keys of a table's folders, kept as a small table beside them.

A folder (``event_date=.../batch_id=...``) has as many 64-bit words as keys, rounded up to a power of two. A key sets
``BITS`` bits in each of two words; ``bit_or`` gathers them, so a hot key costs one row per task. A key that may be
in a folder finds all its bits there; about one absent key in ten million does too. Keys with a
NULL set no bits; a folder that holds such rows says so.

Every filter carries a stamp of its folder's files. A folder without a filter of its own stamp, because it is new or
was changed, may hold any key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FILTERS = "_filters"
BITS = 5
SCHEMA = "folder string, stamp string, words long, word long, bits long"
# Word number of the mark of a folder with NULL keys.
HAS_NULLS = -1


def stamp_of(names: Sequence[str]) -> str:
    """Digest of a folder's file names, which Spark never uses twice."""
    return hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest()[:32]


def _texts(keys: Sequence[str]) -> list[Column]:
    return [F.col(k).cast("string") for k in keys]


def _has_null(keys: Sequence[str]) -> Column:
    out = F.lit(False)
    for k in keys:
        out = out | F.col(k).isNull()
    return out


def _probes(keys: Sequence[str]) -> Column:
    """For each of a key's two words: its number, from column ``words``, and its bits."""
    probes = []
    for seed in (1, 2):
        h = F.xxhash64(F.lit(seed), *_texts(keys))
        mask = F.lit(0).cast("long")
        for i in range(BITS):
            at = F.shiftright(h, 64 - 6 * (i + 1)).bitwiseAND(63).cast("int")
            mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
        # Low bits choose the word, high ones the bits.
        probes.append(F.struct(h.bitwiseAND(F.col("words") - 1).alias("word"), mask.alias("bits")))
    return F.array(*probes)


def folder_filters(rows: DataFrame, keys: Sequence[str], folder: Column, stamps: DataFrame) -> DataFrame:
    """Filters of ``rows``, each row of the folder that ``folder`` names; ``stamps`` has (folder, stamp)."""
    named = rows.withColumn("folder", folder).select("folder", *keys)
    sizes = named.groupBy("folder").agg(F.count(F.lit(1)).alias("n"))
    words = F.pow(F.lit(2.0), F.greatest(F.ceil(F.log2(F.col("n").cast("double"))), F.lit(0))).cast("long")
    # One row per folder, as many as the caller has listed.
    sizes = F.broadcast(sizes.join(F.broadcast(stamps), "folder").select("folder", "stamp", words.alias("words")))
    sized = named.join(sizes, "folder")
    bits = sized.filter(~_has_null(keys)).select("folder", "stamp", "words", F.inline(_probes(keys)))
    nulls = sized.filter(_has_null(keys)).select("folder", "stamp", "words", F.lit(HAS_NULLS).cast("long").alias("word"), F.lit(0).cast("long").alias("bits"))
    return bits.unionByName(nulls).groupBy("folder", "stamp", "words", "word").agg(F.bit_or("bits").alias("bits"))


def folders_with(filters: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Folders of ``filters`` that may hold a key of ``changes``."""
    # Powers of two, so at most 63.
    sizes = [r.words for r in filters.select("words").distinct().collect()]
    wanted = changes.select(*keys).distinct()
    every = F.explode(F.array(*map(F.lit, sizes)).cast("array<long>")).alias("words")
    asked = wanted.filter(~_has_null(keys)).select("*", every).withColumn("key", F.xxhash64(F.lit(3), *_texts(keys)))
    probes = asked.select("words", "key", F.posexplode(_probes(keys)).alias("place", "probe")).select("words", "key", "place", "probe.word", F.col("probe.bits").alias("wanted"))
    hits = filters.join(probes, ["words", "word"]).filter(F.col("bits").bitwiseAND(F.col("wanted")) == F.col("wanted"))
    held = hits.groupBy("folder", "words", "key").agg(F.count_distinct("place").alias("n")).filter("n = 2").select("folder")
    null_asked = wanted.filter(_has_null(keys)).limit(1).select(F.lit(HAS_NULLS).cast("long").alias("word"))
    with_nulls = filters.join(F.broadcast(null_asked), "word", "left_semi").select("folder")
    return held.unionByName(with_nulls).distinct()


def read_filters(spark: SparkSession, target_path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(f"{target_path}/{FILTERS}")


def stamps_frame(spark: SparkSession, stamps: dict[str, str]) -> DataFrame:
    return spark.createDataFrame(list(stamps.items()), "folder string, stamp string")
