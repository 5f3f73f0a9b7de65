"""Row routing: every row carries a reject mark instead of leaving the plan.

A stage is a function from DataFrame to DataFrame. It marks the rows it refuses in
``_reject`` and leaves rows marked earlier alone, so one pass gives accepted rows, dead
letters and traces.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REJECT_TYPE = (
    "struct<stage:string,error:string,reason:string,detail:map<string,string>>"
)
DEAD_LETTER_COLUMNS = [
    "stage", "event_id", "error", "reason", "detail", "raw", "message", "message_base64", "event_json",
]
# Fixed value: characters of the input that ``raw`` shows. The whole input is in ``message``.
RAW_CHARS = 500
# Marks rows a policy drops without a dead letter.
SILENT = "dropped_without_record"


def text_map(**items: Column) -> Column:
    pairs = [c for k, v in items.items() for c in (F.lit(k), v.cast("string"))]
    return F.create_map(*pairs).cast("map<string,string>")


def no_reject() -> Column:
    return F.lit(None).cast(REJECT_TYPE)


def ok() -> Column:
    return F.col("_reject").isNull()


def reject_struct(
    stage: str, error: Column | None, reason: Column | None = None, detail: Column | None = None
) -> Column:
    def default(c: Column | None, kind: str) -> Column:
        return F.lit(None).cast(kind) if c is None else c.cast(kind)

    return F.struct(
        F.lit(stage).alias("stage"),
        default(error, "string").alias("error"),
        default(reason, "string").alias("reason"),
        default(detail, "map<string,string>").alias("detail"),
    ).cast(REJECT_TYPE)


def pinned(c: Column) -> Column:
    """The same value, evaluated where it is written.

    Catalyst moves filters below projections by copying the column's expression. Through a
    chain of stages each copy doubles the next one, and JSON would be parsed many times per
    row. A projection with a non-deterministic column is not crossed by filters, and the
    partition id is a free one.
    """
    return F.when(F.spark_partition_id() >= 0, c)


def reject_where(df: DataFrame, condition: Column, rejection: Column) -> DataFrame:
    """Mark the rows where the condition holds, unless a stage before refused them."""
    return df.withColumn(
        "_reject", pinned(F.when(ok() & condition, rejection).otherwise(F.col("_reject")))
    )


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(ok())


def _optional(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def event_json(df: DataFrame) -> Column:
    """The event as JSON: envelope, payload and the stamps set so far."""
    parts = [F.col(c) for c in ("event_id", "event_type", "event_source", "event_ts") if c in df.columns]
    if "_payload" in df.columns:
        parts.append(F.coalesce(F.col("_payload"), _payload_text_variant(df)).alias("payload"))
    elif "_payload_text" in df.columns:
        parts.append(F.col("_payload_text").alias("payload"))
    for name in ("event_timestamp", "beam_event_time", "beam_processing_time"):
        if name in df.columns:
            parts.append(F.col(name))
    return F.to_json(F.struct(*parts))


def _payload_text_variant(df: DataFrame) -> Column:
    return F.col("_payload_text").cast("variant") if "_payload_text" in df.columns else F.lit(None)


def dead_letters(df: DataFrame, final_json: Column | None = None) -> DataFrame:
    """The refused rows in the common dead-letter layout, complete enough to be sent again.

    A message that never became an event is kept whole: as text, or as base64 where its bytes
    are not UTF-8. All others carry their event as JSON. ``final_json`` is the transformed
    event, used for rows refused by validation.
    """
    stage = F.col("_reject.stage")
    no_event = stage == "preprocess"
    text = _optional(df, "_text", "string")
    body = event_json(df)
    if final_json is not None:
        body = F.when(stage == "validation", final_json).otherwise(body)
    out = df.filter(F.col("_reject").isNotNull() & ~F.col("_reject.reason").eqNullSafe(SILENT))
    return out.select(
        stage.alias("stage"),
        _optional(df, "event_id", "string").alias("event_id"),
        F.col("_reject.error").alias("error"),
        F.col("_reject.reason").alias("reason"),
        F.col("_reject.detail").alias("detail"),
        F.when(stage.isin("preprocess", "transform"), F.substring(text, 1, RAW_CHARS)).alias("raw"),
        F.when(no_event, text).alias("message"),
        F.when(no_event, _optional(df, "_not_utf8", "string")).alias("message_base64"),
        F.when(~no_event, body).alias("event_json"),
    )


def union_dead_letters(*frames: DataFrame) -> DataFrame:
    """All reject sets as one."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def dead_letter_json(df: DataFrame) -> DataFrame:
    """One JSON text per dead letter, as written to a topic."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def write_dead_letters(letters: DataFrame, path: str) -> None:
    """Dead letters as JSON lines."""
    dead_letter_json(letters).write.mode("overwrite").text(path)


def read_dead_letters(letters_json: DataFrame) -> DataFrame:
    """Dead letters from their JSON texts in ``value``."""
    kinds = ", ".join(f"{c} {'map<string,string>' if c == 'detail' else 'string'}" for c in DEAD_LETTER_COLUMNS)
    return letters_json.select(F.from_json("value", kinds).alias("letter")).select("letter.*")


def replayed_messages(letters: DataFrame) -> DataFrame:
    """``value`` (bytes) of the message behind each dead letter that has one to send again.

    Letters from before decoding give the bytes as received; those of events give the event.
    """
    value = F.coalesce(F.unbase64("message_base64"), F.col("message").cast("binary"), F.col("event_json").cast("binary"))
    return letters.select("stage", "event_id", value.alias("value"))


def route_by_type(df: DataFrame, path: str, column: str = "event_type") -> None:
    """Write each event below the folder of its type."""
    df.write.mode("overwrite").partitionBy(column).parquet(path)
