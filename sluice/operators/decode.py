"""Message decoding, the required-field gate and payload parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from sluice.functions import jsonvalue as J
from sluice.operators.route import REJECT_TYPE, no_reject, pinned, reject_struct, reject_where

# Fixed value: keys every message must hold, in the order they are checked.
REQUIRED_FIELDS = ("event_id", "event_type", "event_source", "event_ts", "payload")
ENVELOPE_FIELDS = REQUIRED_FIELDS[:4]


def message_text(df: DataFrame, value: str) -> Column:
    """Text of a message; NULL where bytes are not UTF-8."""
    if isinstance(df.schema[value].dataType, BinaryType):
        return F.when(F.is_valid_utf8(F.col(value)), F.col(value).cast("string"))
    return F.col(value)


def _parse_with_fallback(df: DataFrame, text: str, out: str) -> DataFrame:
    """Parse JSON text, else base64 of JSON text.

    Adds ``out`` (VARIANT) and ``out_json`` (the JSON text that parsed). Each parse is its
    own projection, so Catalyst evaluates it once although later columns use it often.
    """
    first, second = f"{out}_1", f"{out}_2"
    return (
        df.withColumn(first, J.parse_wrapped(F.col(text)))
        .withColumn(first, F.when(J.whole(F.col(first)), F.col(first)))
        .withColumn(f"{out}_b64", F.when(F.col(first).isNull(), J.base64_text(F.col(text))))
        .withColumn(second, F.when(F.col(f"{out}_b64").isNotNull(), J.parse_wrapped(F.col(f"{out}_b64"))))
        .withColumns(
            {
                out: F.when(F.col(first).isNotNull(), J.first_value(F.col(first))).when(
                    J.whole(F.col(second)), J.first_value(F.col(second))
                ),
                f"{out}_json": F.when(F.col(first).isNotNull(), F.col(text)).otherwise(
                    F.col(f"{out}_b64")
                ),
            }
        )
        .drop(first, second, f"{out}_b64")
    )


def decode_messages(df: DataFrame, value: str = "value") -> DataFrame:
    """Message bytes or text to envelope columns.

    Adds ``event_id, event_type, event_source, event_ts`` (text forms), ``_kinds`` (their
    JSON kinds), ``_payload_text``, ``_payload_obj`` (payloads sent as objects), ``_event``
    (the whole envelope), ``_pubsub`` and ``_reject``.
    """
    out = df.withColumn("_text", message_text(df, value))
    if isinstance(df.schema[value].dataType, BinaryType):
        # Kept for the dead letter, which must not lose the bytes.
        out = out.withColumn("_not_utf8", F.when(~F.is_valid_utf8(F.col(value)), F.base64(F.col(value))))
    out = _parse_with_fallback(out, "_text", "_event")
    out = out.withColumn(
        "_is_object",
        F.col("_event").isNotNull() & (J.json_first_char(F.col("_event_json")) == "{"),
    )
    out = out.withColumns(
        {f"_in_{k}": F.when(F.col("_is_object"), J.child(F.col("_event"), k)) for k in REQUIRED_FIELDS}
    )
    out = out.withColumns({f"_kind_{k}": J.base_kind(F.col(f"_in_{k}")) for k in REQUIRED_FIELDS})
    missing = F.coalesce(*[F.when(F.col(f"_in_{k}").isNull(), F.lit(k)) for k in REQUIRED_FIELDS])
    fails = lambda text: reject_struct("preprocess", F.concat(F.lit("PreProcess failed: "), text))
    payload, payload_kind = F.col("_in_payload"), F.col("_kind_payload")
    out = out.withColumns(
        {
            **{k: J.plain_text(F.col(f"_in_{k}"), F.col(f"_kind_{k}")) for k in ENVELOPE_FIELDS},
            "_kinds": F.struct(*[F.col(f"_kind_{k}").alias(k) for k in ENVELOPE_FIELDS]),
            # An object payload keeps its number texts: VARIANT would print 1.0 as 1.
            "_payload_text": F.when(
                payload_kind == "string", F.try_variant_get(payload, "$", "string")
            ).when(
                payload_kind == "object",
                F.from_json(F.col("_event_json"), "map<string,string>")["payload"],
            ),
            "_payload_obj": F.when(payload_kind == "object", payload),
            "_reject": pinned(
                F.when(
                    F.col("_event").isNull(), fails(F.lit("message is not JSON or base64 of JSON"))
                )
                .when(~F.col("_is_object"), fails(F.lit("message is not a JSON object")))
                .when(missing.isNotNull(), fails(F.concat(F.lit("Missing required field: "), missing)))
                .otherwise(no_reject())
            ),
        }
    )
    if "message_id" in df.columns:
        out = out.withColumn(
            "_pubsub",
            F.to_json(
                F.struct(*[F.col(c) for c in ("message_id", "attributes", "publish_time") if c in df.columns])
            ),
        )
    else:
        out = out.withColumn("_pubsub", F.lit(None).cast("string"))
    dropped = ["_is_object", "_event_json"]
    dropped += [f"_in_{k}" for k in REQUIRED_FIELDS] + [f"_kind_{k}" for k in REQUIRED_FIELDS]
    return out.drop(*dropped)


def from_archive(df: DataFrame) -> DataFrame:
    """Rows read back from the raw archive, in the layout ``decode_messages`` gives.

    Archived rows passed the gate before. Their values are text or NULL.
    """
    kind = lambda c: F.when(F.col(c).isNull(), F.lit("null")).otherwise(F.lit("string"))
    return df.withColumns(
        {
            "_kinds": F.struct(*[kind(k).alias(k) for k in ENVELOPE_FIELDS]),
            "_payload_text": F.col("payload"),
            "_payload_obj": F.lit(None).cast("variant"),
            "_event": F.lit(None).cast("variant"),
            "_text": F.lit(None).cast("string"),
            "_reject": F.lit(None).cast(REJECT_TYPE),
        }
    ).drop("payload")


def parse_payload(df: DataFrame) -> DataFrame:
    """Payload text to VARIANT in ``_payload``; refuses payloads that are not a string."""
    out = _parse_with_fallback(df, "_payload_text", "_payload")
    out = out.withColumn("_payload", F.coalesce(F.col("_payload_obj"), F.col("_payload")))
    fails = lambda text: reject_struct("parse", F.lit(f"Payload parsing failed: {text}"))
    out = out.withColumn(
        "_payload_is_object",
        F.col("_payload").isNotNull()
        & (
            F.col("_payload_obj").isNotNull()
            | F.coalesce(J.json_first_char(F.col("_payload_json")) == "{", F.lit(False))
        ),
    )
    out = reject_where(out, F.col("_payload_text").isNull(), fails("payload is not a string"))
    out = reject_where(
        out, F.col("_payload").isNull(), fails("payload is not JSON or base64 of JSON")
    )
    return out.drop("_payload_json", "_payload_obj")
