"""Message sources and sinks for streams: Kafka on a cluster, files anywhere.

Every source gives ``value, message_id, attributes, publish_time``; the message id is
unique per message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE_SCHEMA = "value binary, message_id string, attributes map<string,string>, publish_time timestamp"


def header_map(headers: Column) -> Column:
    """Headers of a message as a map. A key may stand there more than once; the last one wins."""
    entries = F.coalesce(headers, F.array().cast("array<struct<key:string,value:binary>>"))
    last = F.filter(
        entries, lambda h, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == h["key"])
    )
    return F.map_from_entries(F.transform(last, lambda h: F.struct(h["key"].alias("key"), h["value"].cast("string").alias("value"))))


def kafka_messages(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """A Kafka topic (needs Spark's Kafka package on the class path)."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("includeHeaders", "true")
        .options(**options)
        .load()
    )
    return raw.select(
        "value",
        F.concat_ws("-", "topic", "partition", "offset").alias("message_id"),
        header_map(F.col("headers")).alias("attributes"),
        F.col("timestamp").alias("publish_time"),
    )


def file_messages(
    spark: SparkSession, path: str, schema: str = MESSAGE_SCHEMA, max_files: int | None = None
) -> DataFrame:
    """Parquet files of messages appearing below a path."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def read_source(
    spark: SparkSession, mode: str, subscription: str | None = None, archive=None, **options: str
) -> DataFrame:
    """Source by job mode: a subscription (``kafka:servers/topic`` or a path), or an archive range."""
    if mode == "streaming":
        if not subscription:
            raise ValueError("subscription is required for streaming")
        if subscription.startswith("kafka:"):
            servers, topic = subscription.removeprefix("kafka:").rsplit("/", 1)
            return kafka_messages(spark, servers, topic, **options)
        return file_messages(spark, subscription)
    if mode == "backfill":
        if not archive:
            raise ValueError("Backfill requires start and end timestamps")
        from sluice.sources.archive import read_archive

        return read_archive(spark, *archive)
    raise ValueError(f"Unsupported job_mode: {mode}")


def write_topic(values: DataFrame, topic: str) -> None:
    """Write the ``value`` column of a batch to a topic (``kafka:servers/topic``), else as text
    files below a path. For use in ``foreachBatch`` as well."""
    if topic.startswith("kafka:"):
        servers, name = topic.removeprefix("kafka:").rsplit("/", 1)
        values.select("value").write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", name).save()
    else:
        values.select(F.col("value").cast("string")).write.mode("append").text(topic)
