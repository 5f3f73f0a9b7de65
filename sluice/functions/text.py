"""Text rules that differ between Spark's defaults and the event contract."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.let import let

# Fixed value: the characters that count as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Remove all leading and trailing white space, not only blanks."""
    return F.trim(c, F.lit(WHITE_SPACE))


def collapse_spaces(c: Column) -> Column:
    """Strip, then turn every run of white space into one blank."""
    return F.regexp_replace(strip(c), f"[{WHITE_SPACE}]+", " ")


def title(c: Column) -> Column:
    """Upper-case every letter that follows a non-letter: ``o'neil`` -> ``O'Neil``."""
    runs = F.regexp_extract_all(
        c, F.lit(r"[\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+"), F.lit(0)
    )
    return F.array_join(F.transform(runs, F.initcap), "")


def float_text(d: Column) -> Column:
    """Shortest text of a double: ``300.0``, ``0.1``, ``1e+20``.

    Plain notation from 1e-4 up to 1e16, exponent notation outside.
    """
    return let(d.cast("string"), _float_text)


def _float_text(raw: Column) -> Column:
    plain = F.regexp_replace(
        F.regexp_replace(raw.cast("decimal(38,21)").cast("string"), "0+$", ""), r"\.$", ".0"
    )
    mantissa = F.regexp_replace(F.regexp_extract(raw, r"^(-?[0-9.]+)E", 1), r"\.0$", "")
    exponent = F.regexp_extract(raw, r"E(-?[0-9]+)$", 1)
    scientific = F.concat(
        mantissa,
        F.when(exponent.startswith("-"), F.lit("e-")).otherwise(F.lit("e+")),
        F.lpad(F.regexp_replace(exponent, "^-", ""), 2, "0"),
    )
    # The usual case first: between 1e-3 and 1e7 both notations agree.
    return (
        F.when(raw.rlike("^-?[0-9]+[.][0-9]+$"), raw)
        .when(raw == "NaN", F.lit("nan"))
        .when(raw.endswith("Infinity"), F.regexp_replace(F.lower(raw), "inity$", ""))
        .when(raw.rlike("E(-4|[0-9]|1[0-5])$"), plain)
        .otherwise(scientific)
    )


def json_quote(c: Column) -> Column:
    """A JSON string literal in pure ASCII (other characters as ``\\uXXXX``)."""

    def unit(n: Column) -> Column:
        return F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(n)), 4, "0"))

    def escape(ch: Column) -> Column:
        code = F.ascii(ch)
        above = code - 0x10000
        pair = F.concat(
            unit(F.shiftright(above, 10) + 0xD800), unit(above.bitwiseAND(0x3FF) + 0xDC00)
        )
        return (
            F.when(ch == '"', F.lit('\\"'))
            .when(ch == "\\", F.lit("\\\\"))
            .when(ch == "\n", F.lit("\\n"))
            .when(ch == "\r", F.lit("\\r"))
            .when(ch == "\t", F.lit("\\t"))
            .when(ch == "\b", F.lit("\\b"))
            .when(ch == "\f", F.lit("\\f"))
            .when(code > 0xFFFF, pair)
            .when((code < 32) | (code > 126), unit(code))
            .otherwise(ch)
        )

    slow = F.array_join(F.transform(F.split(c, ""), escape), "")
    body = F.when(c.rlike(r"^[ !#-\[\]-~]*$"), c).otherwise(slow)
    return F.concat(F.lit('"'), body, F.lit('"'))
