"""JSON text to VARIANT, and the logical kind and text of a VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.text import float_text

_END = "\\u0001end"
# How every JSON value begins. Other texts are not given to the parser, whose failures cost as much as many parses.
_BEGINS = r"^[ \t\r\n]*(?:[{\[\"0-9-]|true|false|null)"


def parse_wrapped(text: Column) -> Column:
    """``[<text>, <end mark>]`` as VARIANT; NULL where the text is not one JSON value.

    The JSON reader ignores anything after the first value. The end mark shows whether the
    whole text was read: see ``whole``.
    """
    return F.when(text.rlike(_BEGINS), F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_END}"]'))))


def whole(wrapped: Column) -> Column:
    """True where the wrapped text held exactly one JSON value."""
    return F.coalesce(
        (F.try_variant_get(wrapped, "$[1]", "string") == "\u0001end")
        & F.variant_get(wrapped, "$[2]", "variant").isNull(),
        F.lit(False),
    )


def first_value(wrapped: Column) -> Column:
    return F.variant_get(wrapped, "$[0]", "variant")


def base64_text(text: Column) -> Column:
    """Decode base64 to UTF-8 text, else NULL.

    Characters outside the alphabet are ignored, padding must be complete and ends the
    data, and non-ASCII text is refused.
    """
    kept = F.regexp_replace(text, "[^A-Za-z0-9+/=]", "")
    data = F.regexp_extract(
        kept, r"^((?:[A-Za-z0-9+/]{4})*+(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?)", 1
    )
    complete = (data == kept) | data.endswith("=")
    raw = F.try_to_binary(data, F.lit("base64"))
    ascii_only = ~text.rlike(r"[^\x00-\x7F]")
    return F.when(ascii_only & complete & F.is_valid_utf8(raw), raw.cast("string"))


def json_first_char(text: Column) -> Column:
    return F.substring(F.ltrim(text, F.lit(" \t\r\n")), 1, 1)


def path(*keys: str) -> str:
    """A VARIANT path for literal keys."""
    if any("'" in k and '"' in k for k in keys):
        raise ValueError(f"unsupported key in path: {keys}")
    return "$" + "".join(f'["{k}"]' if '"' not in k else f"['{k}']" for k in keys)


def child(v: Column, *keys: str) -> Column:
    """The value below the keys: NULL when absent, a VARIANT null when it is JSON null."""
    return F.variant_get(v, path(*keys), "variant")


# Kind by VARIANT type name. Whole numbers beyond 64 bit are decimals there.
KIND_OF_TYPE = {
    "STRING": "string", "BIGINT": "integer", "DECIMAL": "float", "BOOLEAN": "boolean",
    "VOID": "null", "DOUBLE": "float", "OBJECT": "object", "ARRAY": "array",
    **{f"DECIMAL({digits},0)": "integer" for digits in range(19, 39)},
}


def base_kind(v: Column) -> Column:
    """null, boolean, integer, float, string, object or array. Absent counts as null."""
    def names(keys) -> Column:
        return F.expr("map(" + ",".join(f"'{k}','{KIND_OF_TYPE[k]}'" for k in keys) + ")")

    full = F.schema_of_variant(v)
    # Types without arguments are found as they are; the others by their leading name.
    plain = ("STRING", "BIGINT", "BOOLEAN", "VOID", "DOUBLE")
    short = F.regexp_extract(full, r"^(?:DECIMAL\((?:19|[23][0-9]),0\)|[A-Z]+)", 0)
    return F.coalesce(
        names(plain)[full], names(k for k in KIND_OF_TYPE if k not in plain)[short], F.lit("null")
    )


def plain_text(v: Column, kind: Column | None = None) -> Column:
    """Text form of a value: ``True``, ``12``, ``1.0``, the string itself, JSON for the rest."""
    kind = base_kind(v) if kind is None else kind
    text = F.try_variant_get(v, "$", "string")
    return (
        F.when(kind == "null", F.lit(None).cast("string"))
        .when(kind == "boolean", F.initcap(text))
        .when(kind == "float", float_text(F.try_variant_get(v, "$", "double")))
        .otherwise(text)
    )
