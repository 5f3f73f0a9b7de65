"""Event fields while a plan is built.

A payload field may hold another type in every row. Such a *dynamic* field has three
columns: its VARIANT value, its kind, and a typed view under the field's own name, which
rule expressions use. A field whose type is settled has its own column only. Unused columns
are pruned by Catalyst, so a field costs only what is asked of it.
"""

from __future__ import annotations

import datetime
import json
import re
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import jsonvalue as J
from sluice.functions.text import float_text

SQL_TYPES = {"string": "string", "integer": "bigint", "float": "double", "boolean": "boolean"}
KIND_OF_SPARK = {
    "string": "string", "varchar": "string", "char": "string",
    "tinyint": "integer", "smallint": "integer", "int": "integer", "bigint": "integer",
    "float": "float", "double": "float", "boolean": "boolean",
}


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class Field:
    """Expressions for one field. ``kind`` is a settled kind or ``dynamic``."""

    kind: str
    given_view: Column | None
    variant: Column | None = None
    kind_col: Column | None = None
    view_kind: str = "string"

    @property
    def view(self) -> Column:
        """The typed view; built only where it is asked for."""
        if self.given_view is None:
            return view_of(self.variant, self.kind_col, self.view_kind)
        return self.given_view

    @property
    def dynamic(self) -> bool:
        return self.kind == "dynamic"

    def kinds(self) -> Column:
        """Kind per row; null for absent and NULL."""
        if self.dynamic:
            return self.kind_col
        return F.when(self.view.isNull(), F.lit("null")).otherwise(F.lit(self.kind))

    def is_null(self) -> Column:
        return self.kinds() == "null" if self.dynamic else self.view.isNull()

    def is_empty(self) -> Column:
        """NULL or the empty string."""
        if self.dynamic:
            text = F.try_variant_get(self.variant, "$", "string")
            return (self.kind_col == "null") | ((self.kind_col == "string") & (text == ""))
        if self.kind == "string":
            return F.coalesce(self.view == "", F.lit(True))
        return self.view.isNull()

    def is_string(self) -> Column:
        return self.kinds() == "string"

    def text(self) -> Column:
        if self.dynamic:
            return J.plain_text(self.variant, self.kind_col)
        if self.kind == "float":
            return float_text(self.view)
        if self.kind == "boolean":
            return F.initcap(self.view.cast("string"))
        return self.view.cast("string")

    def as_variant(self) -> Column:
        if self.dynamic:
            return self.variant
        if self.kind in ("null", "timestamp"):
            return self.view.cast("string").cast("variant")
        return self.view.cast("variant")

    def number(self) -> Column:
        """Value as double for integer, float and boolean rows, else NULL."""
        if self.dynamic:
            n = F.try_variant_get(self.variant, "$", "double")
            return F.when(self.kind_col.isin("integer", "float"), n).when(
                self.kind_col == "boolean", F.try_variant_get(self.variant, "$", "boolean").cast("double")
            )
        if self.kind in ("integer", "float", "boolean"):
            return self.view.cast("double")
        return F.lit(None).cast("double")

    def whole(self) -> Column:
        """Value as bigint for integer and boolean rows, else NULL."""
        if self.dynamic:
            n = F.try_variant_get(self.variant, "$", "bigint")
            return F.when(self.kind_col == "integer", n).when(
                self.kind_col == "boolean", F.try_variant_get(self.variant, "$", "boolean").cast("bigint")
            )
        if self.kind in ("integer", "boolean"):
            return self.view.cast("bigint")
        return F.lit(None).cast("bigint")

    def child(self, keys: list[str]) -> "Field":
        if not self.dynamic:
            return null_field()
        return dynamic_field(J.child(self.variant, *keys))


def typed(kind: str, view: Column) -> Field:
    return Field(kind, view)


def null_field() -> Field:
    return Field("null", F.lit(None).cast("string"))


def dynamic_field(variant: Column, view_kind: str = "string") -> Field:
    kind = J.base_kind(variant)
    return Field("dynamic", None, variant, kind, view_kind)


def view_of(variant: Column, kind: Column, view_kind: str) -> Column:
    if view_kind == "string":
        return J.plain_text(variant, kind)
    return F.try_variant_get(variant, "$", SQL_TYPES[view_kind])


def literal(value: Any) -> Field:
    """A value from a config file."""
    if value is None:
        return null_field()
    if isinstance(value, bool):
        return typed("boolean", F.lit(value))
    if isinstance(value, int):
        return typed("integer", F.lit(value).cast("bigint"))
    if isinstance(value, float):
        return typed("float", F.lit(value).cast("double"))
    if isinstance(value, (datetime.date, datetime.datetime, datetime.time)):
        return typed("string", F.lit(value.isoformat()))
    if isinstance(value, str):
        return typed("string", F.lit(value))
    return dynamic_field(F.parse_json(F.lit(json.dumps(value))))


def choose(condition: Column, yes: Field, no: Field, view_kind: str | None = None) -> Field:
    """``yes`` where the condition holds, else ``no``; settled only if both kinds agree."""
    kinds = {f.kind for f in (yes, no)} - {"null"}
    if len(kinds) <= 1 and "dynamic" not in kinds:
        kind = kinds.pop() if kinds else "null"
        cast = SQL_TYPES.get(kind, "string")
        return typed(kind, F.when(condition, yes.view.cast(cast)).otherwise(no.view.cast(cast)))
    variant = F.when(condition, yes.as_variant()).otherwise(no.as_variant())
    kind_col = F.when(condition, yes.kinds()).otherwise(no.kinds())
    if view_kind is None:
        view_kind = next(
            (f.view_kind if f.dynamic else f.kind for f in (no, yes) if f.kind not in ("null", "timestamp")),
            "string",
        )
    return Field("dynamic", None, variant, kind_col, view_kind)


def put(parent: Column, keys: list[str], value: Column) -> Column:
    """An object VARIANT with another value below the keys; what is no object becomes one."""
    members = F.try_variant_get(parent, "$", "map<string,variant>")
    if len(keys) > 1:
        value = put(F.try_variant_get(parent, J.path(keys[0]), "variant"), keys[1:], value)
    rest = F.map_filter(F.coalesce(members, F.create_map().cast("map<string,variant>")), lambda k, _: k != keys[0])
    absent = F.parse_json(F.lit("null"))
    return F.to_variant_object(F.map_concat(rest, F.create_map(F.lit(keys[0]), F.coalesce(value, absent))))


class EventFrame:
    """A DataFrame whose columns include the fields of an event.

    New values are collected and added in one projection per dependency level.
    """

    def __init__(self, df: DataFrame, fields: Mapping[str, Field]):
        self.df = df
        self.fields = dict(fields)
        self.assigned: set[str] = set()
        self._pending: dict[str, Field] = {}

    def get(self, path: str | None, *, nested: bool = True) -> Field:
        """Field at a dotted path; a constant NULL where the event cannot hold it."""
        if not path:
            return null_field()
        keys = path.split(".")
        if path in self._pending or (nested and keys[0] in self._pending):
            self.flush()
        if path in self.fields:
            return self.fields[path]
        if nested and len(keys) > 1 and keys[0] in self.fields:
            return self.fields[keys[0]].child(keys[1:])
        return null_field()

    def set(self, path: str, field: Field) -> None:
        """Give the field at a path a value. Below an object that the event holds, the object
        itself changes, so that it is written with the new value."""
        root, *below = path.split(".")
        if below and path not in self.fields and (root in self.fields or root in self._pending):
            parent = self.get(root)
            if parent.dynamic:
                path, field = root, dynamic_field(put(parent.variant, below, field.as_variant()), parent.view_kind)
        if path in self._pending:
            self.flush()
        self.assigned.add(path)
        self._pending[path] = field

    def flush(self) -> None:
        if not self._pending:
            return
        columns: dict[str, Column] = {}
        for name, f in self._pending.items():
            if f.dynamic:
                columns[f"_v_{name}"], columns[f"_k_{name}"] = f.variant, f.kind_col
        self.df = self.df.withColumns(columns) if columns else self.df
        views: dict[str, Column] = {}
        for name, f in self._pending.items():
            if f.dynamic:
                v, k = F.col(quoted(f"_v_{name}")), F.col(quoted(f"_k_{name}"))
                views[name] = view_of(v, k, f.view_kind)
                self.fields[name] = Field("dynamic", F.col(quoted(name)), v, k, f.view_kind)
            else:
                views[name] = f.view
                self.fields[name] = typed(f.kind, F.col(quoted(name)))
        self._pending = {}
        self.df = self.df.withColumns(views)

    def mentions_pending(self, text: str) -> bool:
        return any(re.search(rf"(?<!\w){re.escape(n)}(?!\w)", text) for n in self._pending)

    def expression(self, text: str) -> Field:
        """A rule expression in Spark SQL over the fields of the event."""
        if self.mentions_pending(text):
            self.flush()
        try:
            kind = self.df.select(F.expr(text).alias("x")).schema["x"].dataType.simpleString()
        except Exception as e:
            raise ValueError(f"rule expression {text!r} cannot be resolved: {e}") from e
        c = F.expr(text)
        if kind in KIND_OF_SPARK:
            name = KIND_OF_SPARK[kind]
            return typed(name, c.cast(SQL_TYPES[name]))
        if kind.startswith("decimal"):
            return typed("float", c.cast("double"))
        if kind == "void":
            return null_field()
        if kind == "variant":
            return dynamic_field(c)
        return typed("string", c.cast("string"))
