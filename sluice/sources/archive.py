"""The raw archive: every decoded event as received, partitioned by event day."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.timetext import parse_event_time
from sluice.operators.route import accepted
from sluice.sources import tables

# Fixed values of the archive's schema columns.
SCHEMA_NAME = "json_event"
SCHEMA_VERSION = "v2"
ARCHIVE_COLUMNS = (
    "ingest_ts", "event_ts", "event_ts_raw", "event_id", "event_type", "event_source",
    "schema_name", "schema_version", "raw_payload", "pubsub_metadata",
)


ARCHIVE_SCHEMA = (
    "ingest_ts timestamp, event_ts timestamp, event_ts_raw string, event_id string, event_type string, event_source string, "
    "schema_name string, schema_version string, raw_payload string, pubsub_metadata string"
)
RANGE_SCHEMA = (
    "event_id string, event_type string, event_source string, event_ts string, payload string, _pubsub string, "
    "_pos_file string, _pos_row bigint"
)
# The zone map: file, smallest and largest event time, rows. Readers skip names with an underscore.
ZONES = "_zones"
ZONE_SCHEMA = "file string, low timestamp, high timestamp, rows bigint"


def archive_rows(decoded: DataFrame, ingest_time: Column | None = None) -> DataFrame:
    """Decoded messages as archive rows; a time that cannot be read stays as raw text only."""
    other_payload = F.to_json(F.struct(F.variant_get(F.col("_event"), "$.payload", "variant").alias("p")))
    rows = accepted(decoded)
    return rows.select(
        (F.current_timestamp() if ingest_time is None else ingest_time).alias("ingest_ts"),
        parse_event_time(F.col("event_ts"), F.col("_kinds.event_ts")).alias("event_ts_parsed"),
        F.col("event_ts").alias("event_ts_raw"),
        "event_id",
        "event_type",
        "event_source",
        F.lit(SCHEMA_NAME).alias("schema_name"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.coalesce(
            F.col("_payload_text"), F.regexp_extract(other_payload, r'(?s)^\{"p":(.*)\}$', 1)
        ).alias("raw_payload"),
        F.coalesce(F.col("_pubsub"), F.lit("null")).alias("pubsub_metadata"),
    ).withColumnRenamed("event_ts_parsed", "event_ts").select(*ARCHIVE_COLUMNS)


def write_archive(rows: DataFrame, path: str, mode: str = "append") -> None:
    """One folder per load, with daily partitions on the event time and a zone map.

    Rows without a time go to the NULL partition. ``overwrite`` deletes the archive first.
    """
    if mode == "overwrite":
        tables.Folders(rows.sparkSession, path).delete(path)
    write_archive_batch(rows, path, f"load-{uuid.uuid4().hex}")


def write_archive_batch(rows: DataFrame, path: str, batch_id: int | str) -> None:
    """A micro-batch or load in a folder of its own; a replay changes nothing."""
    dated = rows.withColumn("event_date", F.to_date("event_ts"))
    tables.write_batch_once(dated, path, batch_id, "event_date")
    write_zones(rows.sparkSession, path, batch_id)


def write_zones(spark: SparkSession, path: str, batch_id: int | str) -> None:
    """Add the smallest and largest event time of each file of a folder to the zone map.

    Only the time column of the new folder is read. A folder has its zones before a reader that goes
    by the map can see it, so a job that stops in between shows nothing until its replay adds them.
    """
    rows = spark.read.schema(ARCHIVE_SCHEMA).parquet(f"{path}/{tables.BATCH}={batch_id}")
    file = F.concat(F.lit(f"{tables.BATCH}="), F.substring_index(F.col("_metadata.file_path"), f"/{tables.BATCH}=", -1))
    zones = rows.groupBy(file.alias("file")).agg(
        F.min("event_ts").alias("low"), F.max("event_ts").alias("high"), F.count(F.lit(1)).alias("rows")
    )
    tables.write_batch_once(zones.coalesce(1), f"{path}/{ZONES}", batch_id)


def files_of_range(spark: SparkSession, path: str, start, end) -> list[str] | None:
    """Files that hold times of the half-open range, by the zone map; None where there is none."""
    if not tables.Folders(spark, path).exists(f"{path}/{ZONES}"):
        return None
    zones = spark.read.schema(ZONE_SCHEMA).parquet(f"{path}/{ZONES}")
    zones = zones.filter((F.col("high") >= F.lit(parse_bound(start))) & (F.col("low") < F.lit(parse_bound(end))))
    return sorted(f"{path}/{r.file}" for r in zones.select("file").collect())


def archive_bounds(spark: SparkSession, path: str) -> tuple[datetime.datetime, datetime.datetime] | None:
    """Smallest event time, and a time behind the largest one; None for an archive without times."""
    if not tables.Folders(spark, path).exists(f"{path}/{ZONES}"):
        zones = spark.read.parquet(path).select(F.col("event_ts").alias("low"), F.col("event_ts").alias("high"))
    else:
        zones = spark.read.schema(ZONE_SCHEMA).parquet(f"{path}/{ZONES}")
    low, high = zones.agg(F.unix_micros(F.min("low")), F.unix_micros(F.max("high"))).first()
    if low is None:
        return None
    epoch = datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc)
    return epoch + datetime.timedelta(microseconds=low), epoch + datetime.timedelta(microseconds=high + 1)


def parse_bound(text: str | datetime.datetime) -> datetime.datetime:
    """A range bound as UTC."""
    at = text
    if isinstance(text, str):
        at = datetime.datetime.fromisoformat(text.strip().replace("Z", "+00:00"))
    if at.tzinfo is None:
        at = at.replace(tzinfo=datetime.timezone.utc)
    return at.astimezone(datetime.timezone.utc)


def time_range(df: DataFrame, start, end, column: str = "event_ts") -> DataFrame:
    """Half-open range on a time column. The bounds are literals, so Parquet skips by them."""
    low, high = parse_bound(start), parse_bound(end)
    return df.filter((F.col(column) >= F.lit(low)) & (F.col(column) < F.lit(high)))


def read_archive(spark: SparkSession, path: str, start, end) -> DataFrame:
    """Archived events of a time range in the event layout, with the position of each row.

    The zone map names the files of the range, so no folder is listed, whether loads or micro-batches wrote
    them; an archive without a map is listed and pruned by day. Only the needed columns are read.
    ``_pos_file`` and ``_pos_row`` identify the stored row.
    """
    low, high = parse_bound(start), parse_bound(end)
    files = files_of_range(spark, path, low, high)
    if files is None:
        rows = spark.read.parquet(path)
    elif files:
        rows = spark.read.schema(f"{ARCHIVE_SCHEMA}, event_date date").option("basePath", path).parquet(*files)
    else:
        return spark.createDataFrame([], RANGE_SCHEMA)
    rows = rows.filter(F.col("event_date").between(F.lit(low.date()), F.lit(high.date())))
    return time_range(rows, low, high).select(
        "event_id",
        "event_type",
        "event_source",
        F.col("event_ts_raw").alias("event_ts"),
        F.col("raw_payload").alias("payload"),
        F.col("pubsub_metadata").alias("_pubsub"),
        F.col("_metadata.file_path").alias("_pos_file"),
        F.col("_metadata.row_index").alias("_pos_row"),
    )
