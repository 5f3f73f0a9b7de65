"""Null defaults, type casts and concatenation."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions import timetext
from sluice.functions.text import strip
from sluice.operators.fields import EventFrame, Field, choose, literal, null_field, typed
from sluice.operators.rules import UNSET, Cast, Concatenation, NullDefault, rules

# Words read as booleans.
TRUE_WORDS = ("true", "1", "yes", "y", "t")
FALSE_WORDS = ("false", "0", "no", "n", "f")
CAST_KINDS = {
    "string": "string", "integer": "integer", "float": "float", "boolean": "boolean",
    "date": "string", "time": "string", "datetime": "string", "timestamp": "string",
}


def null_defaults(event: EventFrame, entries: Any) -> None:
    """Replace NULL and empty values."""
    for rule in rules(entries, NullDefault):
        f = event.get(rule.field)
        event.set(rule.field, choose(f.is_empty(), literal(rule.default), f, f.view_kind if f.dynamic else None))
    event.flush()


def to_integer(f: Field) -> Column:
    """Whole number; a float is truncated, a string must be an integer literal."""
    s = strip(f.text())
    from_string = F.when(
        s.rlike(r"^[+-]?\d+(?:_\d+)*$"), F.regexp_replace(s, r"[_+]", "").try_cast("bigint")
    )
    n = f.number()
    from_float = F.when(F.abs(n) < 9.2e18, n.cast("bigint"))
    if not f.dynamic:
        return {"integer": f.view, "float": from_float, "string": from_string}.get(
            f.kind, F.lit(None)
        ).cast("bigint")
    k = f.kinds()
    return (
        F.when(k == "integer", F.try_variant_get(f.variant, "$", "bigint"))
        .when(k == "float", from_float)
        .when(k == "string", from_string)
    )


def float_of_text(text: Column) -> Column:
    s = strip(text)
    word = F.lower(F.regexp_replace(s, r"^[+-]", ""))
    sign = F.when(s.startswith("-"), F.lit(-1.0)).otherwise(F.lit(1.0))
    return (
        F.when(s.rlike(timetext.NUMBER), F.regexp_replace(s, "_", "").try_cast("double"))
        .when(word.isin("inf", "infinity"), sign * F.lit(float("inf")))
        .when(word == "nan", F.lit(float("nan")))
    )


def to_float(f: Field) -> Column:
    k = f.kinds()
    return F.when(k.isin("integer", "float"), f.number()).when(k == "string", float_of_text(f.text()))


def to_boolean(f: Field) -> Column:
    k = f.kinds()
    word = F.lower(strip(f.text()))
    from_string = F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))
    return F.when(k.isin("integer", "float", "boolean"), f.number() != 0).when(k == "string", from_string)


def cast_value(f: Field, to: str) -> Column | None:
    """The cast value, NULL where the cast fails; None for an unknown target type."""
    if to == "string":
        return f.text()
    if to == "integer":
        return to_integer(f)
    if to == "float":
        return to_float(f)
    if to == "boolean":
        return to_boolean(f)
    parse = {
        "date": timetext.iso_date,
        "time": timetext.iso_time,
        "datetime": timetext.iso_datetime,
        "timestamp": timetext.iso_datetime,
    }.get(to)
    return None if parse is None else F.when(f.is_string(), parse(f.text()))


def type_casts(event: EventFrame, entries: Any) -> None:
    """Cast fields. With a default, missing and failing values take it; without, they keep the
    output as it was."""
    for rule in rules(entries, Cast):
        f = event.get(rule.field)
        missing = f.is_empty() if rule.treat_empty_as_null else f.is_null()
        value, kind = cast_value(f, rule.kind), CAST_KINDS.get(rule.kind, "string")
        usable = F.lit(False) if value is None else ~missing & value.isNotNull()
        cast = null_field() if value is None else typed(kind, value)
        if rule.default is not UNSET:
            event.set(rule.target, choose(~usable, literal(rule.default), cast, kind))
        elif value is not None and rule.kind == "string" and rule.target == rule.field:
            event.set(rule.target, cast)
        elif value is not None:
            event.set(rule.target, choose(usable, cast, event.get(rule.target), kind))
    event.flush()


def concatenations(event: EventFrame, entries: Any) -> None:
    """Join the texts of several fields."""
    for rule in rules(entries, Concatenation):
        if not isinstance(rule.inputs, list):
            continue
        otherwise = literal(rule.default_value)
        fields = {name: event.get(name) for name in rule.inputs}
        texts = [
            F.when(fields[name].is_empty(), literal((rule.defaults or {}).get(name)).text()).otherwise(fields[name].text())
            for name in rule.inputs
        ]
        separator = str(rule.separator)
        if not texts:
            event.set(rule.output_field, otherwise)
        elif rule.skip_nulls:
            kept = F.filter(F.array(*texts), lambda p: p.isNotNull() & (p != ""))
            joined = typed("string", F.array_join(kept, separator))
            event.set(rule.output_field, choose(F.size(kept) == 0, otherwise, joined))
        else:
            event.set(rule.output_field, typed("string", F.concat_ws(separator, *[F.coalesce(t, F.lit("")) for t in texts])))
    event.flush()
