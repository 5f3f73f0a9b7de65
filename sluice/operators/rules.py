"""Rules of a configuration as typed records.

A record's fields without a default are required; an entry that lacks one of them, or that is
no mapping, is not a rule and is skipped.
"""

from __future__ import annotations

from dataclasses import MISSING, dataclass, field, fields
from typing import Any, TypeVar

R = TypeVar("R")
# Default of a rule that has none.
UNSET = object()


@dataclass(frozen=True)
class NullDefault:
    field: str
    default: Any = None


@dataclass(frozen=True)
class Cast:
    field: str
    to: str
    output_field: str | None = None
    default: Any = UNSET
    treat_empty_as_null: bool = True

    @property
    def target(self) -> str:
        return self.output_field or self.field

    @property
    def kind(self) -> str:
        return str(self.to).strip().lower()


@dataclass(frozen=True)
class Concatenation:
    output_field: str
    inputs: list = field(default_factory=list)
    separator: Any = ""
    skip_nulls: bool = True
    default_value: Any = ""
    defaults: dict = field(default_factory=dict)
    type: str | None = None


def rules(entries: Any, kind: type[R]) -> list[R]:
    """All rules of a list; a mapping of two-field rules is a list as well."""
    known = [f.name for f in fields(kind)]
    needed = [f.name for f in fields(kind) if f.default is MISSING and f.default_factory is MISSING]
    if isinstance(entries, dict) and kind is NullDefault:
        entries = [dict(zip(known, item)) for item in entries.items()]
    found = []
    for entry in entries if isinstance(entries, list) else []:
        if isinstance(entry, dict) and all(entry.get(name) for name in needed):
            found.append(kind(**{k: v for k, v in entry.items() if k in known}))
    return found
