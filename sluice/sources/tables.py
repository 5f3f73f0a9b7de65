"""Final tables, the temporary backfill table and the keyed merge."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.sources import key_filters

PARTITION = "event_date"
BATCH = "batch_id"
# Batch number of rows that no micro-batch wrote.
NO_BATCH = -1
# Folder below a table that holds merges under way; readers skip names with an underscore.
MERGES = "_merges"
NULL_DAY = "__HIVE_DEFAULT_PARTITION__"
# Compaction: folders below the first size are packed into folders of about the second one.
SMALL_BYTES, PACKED_BYTES = 128 << 20, 1 << 30
# The newest batches are left alone, as a stream may write them again.
KEEP_BATCHES = 2


def with_partition(rows: DataFrame, batch_id: int = NO_BATCH) -> DataFrame:
    return rows.withColumns({PARTITION: F.to_date("beam_event_time"), BATCH: F.lit(batch_id)})


def write_table(rows: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Overwrite the table, or add a micro-batch to it.

    The layout is one folder per event day and batch. A micro-batch replaces only its own
    folders, so a replay repeats nothing. A day is split over as many files as there are
    write tasks with rows of it, so a day with most of the rows is not one task's work.
    """
    if batch_id is None:
        writer = with_partition(rows).write.mode("overwrite").option("partitionOverwriteMode", "static")
    else:
        writer = with_partition(rows, batch_id).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        )
    writer.partitionBy(PARTITION, BATCH).parquet(path)


def _keyed(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows with ``_content``: empty, or for a NULL in the key a digest of the given columns."""
    nulls = F.lit(False)
    for k in keys:
        nulls = nulls | F.col(k).isNull()
    content = F.md5(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns])).cast("binary"))
    return rows.withColumn("_content", F.when(nulls, content).otherwise(F.lit("")))


def _matching(rows: DataFrame, changes: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    common = sorted((set(rows.columns) & set(changes.columns)) - {BATCH})
    left, right = _keyed(rows, keys, common), _keyed(changes, keys, common)
    right = right.select(*[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_content").alias("_key_content"))
    same = F.col("_content") == F.col("_key_content")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    return left.join(right, same, how).drop("_content")


def merge_rows(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the target after the merge: matched keys updated, new keys inserted.

    A row with a NULL in its key is matched by its whole content: a rerun does not insert it
    again, and such rows are spread over all tasks.
    """
    return _matching(target, changes, keys, "left_anti").unionByName(changes, allowMissingColumns=True)


class Folders:
    """The few file system calls that a merge needs; every result is checked."""

    def __init__(self, spark: SparkSession, path: str):
        self.new_path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.new_path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.new_path(path))

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.new_path(path)) if s.isDirectory())

    def files(self, path: str) -> dict[str, int]:
        """Sizes of the data files right below a folder."""
        found = self.fs.listStatus(self.new_path(path)) if self.exists(path) else []
        sizes = {s.getPath().getName(): s.getLen() for s in found if s.isFile()}
        return {name: size for name, size in sizes.items() if name[:1] not in "_."}

    def move(self, source: str, target: str) -> None:
        if self.exists(target):
            raise OSError(f"cannot move {source}: {target} exists")
        self.fs.mkdirs(self.new_path(target).getParent())
        if not self.fs.rename(self.new_path(source), self.new_path(target)):
            raise OSError(f"could not move {source} to {target}")

    def delete(self, path: str) -> None:
        self.fs.delete(self.new_path(path), True)

    def write_text(self, path: str, text: str) -> None:
        out = self.fs.create(self.new_path(path), True)
        out.write(bytearray(text.encode()))
        out.close()

    def read_text(self, path: str) -> str:
        stream = self.fs.open(self.new_path(path))
        data = bytes(stream.readAllBytes())
        stream.close()
        return data.decode()


def data_folders(folders: Folders, path: str) -> list[str]:
    """``event_date=.../batch_id=...`` folders of a table."""
    days = [d for d in folders.names(path) if d.startswith(f"{PARTITION}=")]
    return [f"{day}/{batch}" for day in days for batch in folders.names(f"{path}/{day}")]


def read_folders(spark: SparkSession, path: str, names: Sequence[str], schema=None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("basePath", path).parquet(*[f"{path}/{n}" for n in names])


@dataclass
class MergeReport:
    """What a merge looked into: folders of the target, those searched for keys, and days rewritten."""

    folders: list[str]
    searched: list[str]
    days: list[str]


def _folder_name():
    day = F.coalesce(F.col(PARTITION).cast("string"), F.lit(NULL_DAY))
    return F.concat(F.lit(f"{PARTITION}="), day, F.lit(f"/{BATCH}="), F.col(BATCH).cast("string"))


def _stamps(folders: Folders, path: str, names: Sequence[str]) -> dict[str, str]:
    return {n: key_filters.stamp_of(list(folders.files(f"{path}/{n}"))) for n in names}


def write_filters(spark: SparkSession, path: str, names: Sequence[str], keys: Sequence[str]) -> None:
    """Add the key filters of some folders; only their key columns are read."""
    if not names:
        return
    stamps = _stamps(Folders(spark, path), path, names)
    rows = read_folders(spark, path, names).select(*keys, PARTITION, BATCH)
    made = key_filters.folder_filters(rows, keys, _folder_name(), key_filters.stamps_frame(spark, stamps))
    made.hint("coalesce", 8).write.mode("append").parquet(f"{path}/{key_filters.FILTERS}")


def folders_to_search(spark: SparkSession, path: str, changes: DataFrame, keys: Sequence[str]) -> tuple[list[str], list[str], list[str]]:
    """(all folders, folders that may hold a key of ``changes``, folders without a filter of their files)."""
    folders = Folders(spark, path)
    names = data_folders(folders, path)
    if not folders.exists(f"{path}/{key_filters.FILTERS}") or not names:
        return names, names, names
    current = key_filters.stamps_frame(spark, _stamps(folders, path, names))
    filters = key_filters.read_filters(spark, path).join(F.broadcast(current), ["folder", "stamp"], "left_semi")
    known = {r.folder for r in filters.select("folder").distinct().collect()}
    held = {r.folder for r in key_filters.folders_with(filters, changes, keys).collect()}
    return names, [n for n in names if n in held or n not in known], [n for n in names if n not in known]


def merge_into(
    spark: SparkSession,
    target_path: str,
    temp_path: str,
    keys: Sequence[str] = ("event_id",),
    fail_if_missing: bool = False,
) -> MergeReport:
    """Merge the temporary table into the target, rewriting only the touched days.

    A touched day holds a new row or a row that is replaced (an id can move between days). Replaced rows
    are looked for only in folders whose key filter may hold a changed key, and in folders
    without a filter, which get one. Merged days are written below the target itself, so they are moved within
    one file system. A list of all moves is stored before the first one; the old folders are moved
    aside, the new ones in, and only then the old ones are deleted; between the two moves a reader that lists the
    table anew does not see these days. A merge that was broken
    off is finished first by the next one. Only folders that the merge has read are replaced:
    batches that a running stream adds meanwhile stay.
    """
    target_path = target_path.rstrip("/")
    folders = Folders(spark, target_path)
    finish_merges(folders, target_path)
    changes = spark.read.parquet(temp_path)
    if not folders.exists(target_path):
        if fail_if_missing:
            raise ValueError(f"target table {target_path} does not exist")
        changes.hint("rebalance", PARTITION).write.partitionBy(PARTITION, BATCH).parquet(target_path)
        write_filters(spark, target_path, data_folders(folders, target_path), keys)
        return MergeReport([], [], [])
    names, searched, unfiltered = folders_to_search(spark, target_path, changes, keys)
    touched, schema = changes.select(PARTITION), None
    if names:
        schema = spark.read.parquet(target_path).schema
    if searched:
        replaced = _matching(read_folders(spark, target_path, searched, schema), changes, keys, "left_semi")
        touched = touched.union(replaced.select(PARTITION))
    # At most one row per calendar day.
    days = sorted(f"{PARTITION}={NULL_DAY if r[0] is None else r[0].isoformat()}" for r in touched.distinct().collect())
    read = [n for n in names if n.split("/")[0] in set(days)]
    merged = changes.withColumn(BATCH, F.lit(NO_BATCH))
    if read:
        merged = merge_rows(read_folders(spark, target_path, read, schema), changes, keys).withColumn(BATCH, F.lit(NO_BATCH))
    work = f"{target_path}/{MERGES}/{uuid.uuid4().hex}"
    # Files of about one size, however the days differ.
    merged.hint("rebalance", PARTITION).write.partitionBy(PARTITION, BATCH).parquet(f"{work}/new")
    new = data_folders(folders, f"{work}/new")
    _store_moves(folders, work, read, new)
    finish_merges(folders, target_path)
    write_filters(spark, target_path, sorted({*new, *(n for n in unfiltered if n not in set(read))}), keys)
    return MergeReport(names, searched, days)


def _store_moves(folders: Folders, work: str, old: Sequence[str], new: Sequence[str]) -> None:
    folders.write_text(f"{work}/moves.tmp", json.dumps({"old": list(old), "new": list(new)}))
    if not folders.fs.rename(folders.new_path(f"{work}/moves.tmp"), folders.new_path(f"{work}/moves.json")):
        raise OSError(f"could not store the moves of {work}")


def bins(sizes: dict[str, int], most: int) -> list[list[str]]:
    """First-fit decreasing: names in bins of at most ``most`` bytes (a larger one alone)."""
    out: list[tuple[int, list[str]]] = []
    for name, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        at = next((i for i, (held, _) in enumerate(out) if held + size <= most), None)
        if at is None:
            out.append((size, [name]))
        else:
            out[at] = (out[at][0] + size, [*out[at][1], name])
    return [names for _, names in out]


def compact(
    spark: SparkSession, path: str, keys: Sequence[str] | None = None, small_bytes: int = SMALL_BYTES, packed_bytes: int = PACKED_BYTES, keep: int = KEEP_BATCHES
) -> list[str]:
    """Pack small batch folders of each day into few large ones; the new folders.

    Only names and sizes come to the driver. One job writes all new folders, whose batch numbers are
    negative ones that their day does not have yet; folders are exchanged by a stored list
    of moves, as in a merge, and a broken-off run is finished by the next one. The ``keep`` newest batches stay as they are.
    With ``keys``, the new folders get key filters.
    """
    path = path.rstrip("/")
    folders = Folders(spark, path)
    finish_merges(folders, path)
    names = data_folders(folders, path)
    batch_of = {n: int(n.rsplit("=", 1)[1]) for n in names}
    newest = set(sorted({b for b in batch_of.values() if b >= 0})[-keep:] if keep else [])
    by_day: dict[str, dict[str, int]] = {}
    for n in names:
        size = sum(folders.files(f"{path}/{n}").values())
        if size < small_bytes and batch_of[n] not in newest:
            by_day.setdefault(n.split("/")[0], {})[n] = size
    plan = []
    for day, sizes in by_day.items():
        free = min([0, *(b for n, b in batch_of.items() if n.split("/")[0] == day)]) - 1
        for packed in bins(sizes, packed_bytes):
            if len(packed) > 1:
                plan += [(n, free) for n in packed]
                free -= 1
    if not plan:
        return []
    old = [n for n, _ in plan]
    # A row per folder that is packed, as many as were listed.
    to = F.broadcast(spark.createDataFrame(plan, "_folder string, _to int"))
    rows = read_folders(spark, path, old, spark.read.parquet(path).schema)
    rows = rows.withColumn("_folder", _folder_name()).join(to, "_folder").withColumn(BATCH, F.col("_to")).drop("_folder", "_to")
    work = f"{path}/{MERGES}/{uuid.uuid4().hex}"
    rows.hint("rebalance", PARTITION, BATCH).write.partitionBy(PARTITION, BATCH).parquet(f"{work}/new")
    new = data_folders(folders, f"{work}/new")
    _store_moves(folders, work, old, new)
    finish_merges(folders, path)
    if keys:
        write_filters(spark, path, new, keys)
    return new


def finish_merges(folders: Folders, target_path: str) -> None:
    """Carry out the moves of merges that are written in full; drop those that are not."""
    for name in folders.names(f"{target_path}/{MERGES}"):
        work = f"{target_path}/{MERGES}/{name}"
        if folders.exists(f"{work}/moves.json"):
            moves = json.loads(folders.read_text(f"{work}/moves.json"))
            for f in moves["old"]:
                # Done already if the old folder is aside.
                if not folders.exists(f"{work}/old/{f}"):
                    folders.move(f"{target_path}/{f}", f"{work}/old/{f}")
            for f in moves["new"]:
                if folders.exists(f"{work}/new/{f}"):
                    folders.move(f"{work}/new/{f}", f"{target_path}/{f}")
        folders.delete(work)


def write_batch_once(rows: DataFrame, path: str, batch_id: int | str, partition: str | None = None, text: bool = False) -> bool:
    """Write a micro-batch to its own folder, as Parquet or lines of text; a batch already there is left alone.

    The folder is written under a name that readers skip and then moved as a whole, so a reader
    sees all of a batch or nothing, and a replay neither repeats nor changes rows.
    """
    folders, folder = Folders(rows.sparkSession, path), f"{path}/batch_id={batch_id}"
    if folders.exists(folder):
        return False
    staged = f"{path}/_staged/{batch_id}-{uuid.uuid4().hex}"
    writer = rows.write.partitionBy(partition) if partition else rows.write
    if text:
        writer.text(staged)
    else:
        writer.parquet(staged)
    folders.move(staged, folder)
    return True
