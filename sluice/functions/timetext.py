"""Event-time grammar and temporal kinds of strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.let import let
from sluice.functions.text import strip

# Accepted shapes of a time text.
_DATE = r"(?!0000)\d{4}-\d{2}-\d{2}"
_CLOCK = r"(?:[01]\d|2[0-3])(?::[0-5]\d(?::[0-5]\d(?:\.\d{3}|\.\d{6})?)?)?"
_ZONE = r"[+-](?:[01]\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d{6})?)?"
ISO_DATE = f"^{_DATE}$"
ISO_TIME = f"^{_CLOCK}(?:{_ZONE})?$"
ISO_DATETIME = rf"^{_DATE}(?:(?s:.){_CLOCK}(?:{_ZONE}|Z)?|Z)?$"
ISO_ZONED = rf"^{_DATE}(?s:.){_CLOCK}(?:{_ZONE}|Z)$"
# The usual shape: no part needs filling in.
FULL_UTC = r"^(?!0000)\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d{3}|\.\d{6})?Z?$"
LOOSE = (
    r"^(?!0000)(\d{4})([-/])(\d{1,2})\2(\d{1,2})(?:\s+(\d{1,2}):(\d{1,2}):(\d{1,2}))?$"
)
NUMBER = (
    r"^[+-]?(?:\d+(?:_\d+)*\.?|\d+(?:_\d+)*\.\d+(?:_\d+)*|\.\d+(?:_\d+)*)"
    r"(?:[eE][+-]?\d+(?:_\d+)*)?$"
)
# Magnitude from which an epoch number is in micro- or milliseconds, and the
# range of years 1 to 9999 in seconds.
_MICROS_FROM = 1e14
_MILLIS_FROM = 1e11
_MIN_SECOND = -62135596800
_MAX_SECOND = 253402300799


def _in_range(micros: Column) -> Column:
    low, high = _MIN_SECOND * 1_000_000, (_MAX_SECOND + 1) * 1_000_000
    return let(micros, lambda m: F.when((m >= F.lit(low)) & (m < F.lit(high)), F.timestamp_micros(m)))


def epoch_to_time(value: Column) -> Column:
    """Epoch number to timestamp; the unit follows from the magnitude."""

    def seconds(v: Column) -> Column:
        return v / F.when(F.abs(v) >= _MICROS_FROM, F.lit(1e6)).when(
            F.abs(v) >= _MILLIS_FROM, F.lit(1e3)
        ).otherwise(F.lit(1.0))

    def time(s: Column) -> Column:
        whole = F.when(s < 0, F.ceil(s)).otherwise(F.floor(s)).cast("bigint")
        part = F.rint((s - whole.cast("double")) * F.lit(1e6)).cast("bigint")
        ok = (s >= float(_MIN_SECOND)) & (s < float(_MAX_SECOND + 1))
        return F.when(ok, F.timestamp_micros(whole * F.lit(1_000_000) + part))

    return let(value, lambda v: let(seconds(v), time))


def number_of_text(text: Column) -> Column:
    return F.when(text.rlike(NUMBER), F.regexp_replace(text, "_", "").try_cast("double"))


def full_utc_to_time(text: Column) -> Column:
    """The usual shapes only; NULL for any other."""
    zoned = F.concat(F.regexp_replace(text, "Z$", ""), F.lit("Z"))
    return F.when(text.rlike(FULL_UTC), zoned.try_cast("timestamp"))


def iso_to_time(text: Column) -> Column:
    """Stripped ISO text (trailing Z allowed) to timestamp; no zone means UTC."""

    def general(s: Column) -> Column:
        zoned = F.regexp_replace(s, "Z$", "+00:00")
        zone = F.when(s.rlike(ISO_ZONED), F.regexp_extract(zoned, f"({_ZONE})$", 1)).otherwise(F.lit(""))
        return let(zone, lambda z: let(zoned, lambda t: placed(t, z)))

    def placed(t: Column, z: Column) -> Column:
        clock = F.substring(t, F.lit(12), F.length(t) - F.length(z) - 11)
        naive = F.concat(F.substring(t, 1, 10), F.lit("T"), _full_clock(clock), F.lit("Z"))
        shift = (
            F.substring(z, 2, 2).try_cast("bigint") * F.lit(3_600_000_000)
            + F.substring(z, 5, 2).try_cast("bigint") * F.lit(60_000_000)
            + F.rint(F.coalesce(F.substring(z, 8, 9).try_cast("double"), F.lit(0.0)) * 1e6).cast("bigint")
        )
        signed = F.when(z.startswith("-"), -shift).otherwise(shift)
        return _in_range(F.unix_micros(naive.try_cast("timestamp")) - F.coalesce(signed, F.lit(0)))

    return F.coalesce(
        full_utc_to_time(text), F.when(text.rlike(ISO_DATETIME), let(text, general))
    )


def loose_to_time(text: Column) -> Column:
    """Dates with ``-`` or ``/`` and one- or two-digit parts, time optional."""

    def placed(s: Column) -> Column:
        def two(n: int) -> Column:
            return F.lpad(F.regexp_extract(s, LOOSE, n), 2, "0")

        iso = F.concat(
            F.regexp_extract(s, LOOSE, 1), F.lit("-"), two(3), F.lit("-"), two(4), F.lit("T"),
            two(5), F.lit(":"), two(6), F.lit(":"), two(7), F.lit("Z"),
        )
        return iso.try_cast("timestamp")

    return F.when(text.rlike(LOOSE), let(text, placed))


def event_time_of(stripped: Column, kind: Column, text: Column) -> Column:
    """Event time of any accepted form, NULL where it is not accepted.

    ``stripped`` should be a column, as it is used often. An epoch beyond the calendar is
    tried as ISO text next, and fails there.
    """
    return F.when(
        kind == "string",
        F.coalesce(
            full_utc_to_time(stripped),
            F.when(stripped.rlike(NUMBER), epoch_to_time(number_of_text(stripped))),
            iso_to_time(stripped),
            loose_to_time(stripped),
        ),
    ).when(kind.isin("integer", "float"), epoch_to_time(text.try_cast("double")))


def add_event_time(df: DataFrame, text: Column, kind: Column, out: str) -> DataFrame:
    """Add the event time as column ``out``."""
    return (
        df.withColumn("_stripped", strip(text))
        .withColumn(out, event_time_of(F.col("_stripped"), kind, text))
        .drop("_stripped")
    )


def parse_event_time(text: Column, kind: Column) -> Column:
    """The same as one expression."""
    return let(text, lambda t: let(strip(t), lambda s: event_time_of(s, kind, t)))


def _is_date(s: Column) -> Column:
    return F.substring(s, 1, 10).try_cast("date").isNotNull()


def string_kind(text: Column) -> Column:
    """timestamp, datetime, date, time or string."""

    def kind(s: Column) -> Column:
        return (
            F.when(
                s.contains("T") & s.rlike(ISO_DATETIME) & _is_date(s),
                F.when(s.rlike(ISO_ZONED), F.lit("timestamp")).otherwise(F.lit("datetime")),
            )
            .when(s.rlike(ISO_DATE) & _is_date(s), F.lit("date"))
            .when(s.rlike(ISO_TIME), F.lit("time"))
            .otherwise(F.lit("string"))
        )

    return let(strip(text), kind)


def iso_date(text: Column) -> Column:
    """ISO date text, NULL where it is not a calendar date."""
    return let(strip(text), lambda s: F.when(s.rlike(ISO_DATE) & _is_date(s), s))


def iso_time(text: Column) -> Column:
    """ISO time text with seconds, NULL where it is not a time of day."""

    def canonical(s: Column) -> Column:
        zone = F.regexp_extract(s, f"^{_CLOCK}({_ZONE})$", 1)
        clock = F.substring(s, F.lit(1), F.length(s) - F.length(zone))
        return F.when(s.rlike(ISO_TIME), F.concat(_short_fraction(_full_clock(clock)), _full_zone(zone)))

    return let(strip(text), canonical)


def iso_datetime(text: Column) -> Column:
    """ISO date-time text with seconds and the zone kept, NULL where it is not valid."""

    def canonical(s: Column) -> Column:
        t = F.regexp_replace(s, "Z$", "+00:00")
        zone = F.when(s.rlike(ISO_ZONED), F.regexp_extract(t, f"({_ZONE})$", 1)).otherwise(F.lit(""))
        clock = F.substring(t, F.lit(12), F.length(t) - F.length(zone) - 11)
        return F.when(
            s.rlike(ISO_DATETIME) & _is_date(s),
            F.concat(
                F.substring(s, 1, 10), F.lit("T"), _short_fraction(_full_clock(clock)), _full_zone(zone)
            ),
        )

    return let(strip(text), canonical)


def _full_clock(clock: Column) -> Column:
    """Hours, minutes and seconds always present; a fraction of 3 digits becomes 6."""
    return let(
        clock,
        lambda c: F.concat(
            c,
            F.substring(F.lit("00:00:00"), F.length(c) + 1, F.greatest(F.lit(8) - F.length(c), F.lit(0))),
            F.when(F.length(c) == 12, F.lit("000")).otherwise(F.lit("")),
        ),
    )


def _short_fraction(clock: Column) -> Column:
    return F.regexp_replace(clock, r"\.000000$", "")


def _full_zone(zone: Column) -> Column:
    """A zero zone has one spelling, and zero seconds of a zone go."""
    short = F.regexp_replace(zone, r"^([+-]\d{2}:\d{2}):00(?:\.000000)?$", "$1")
    return F.regexp_replace(short, r"^-00:00$", "+00:00")
