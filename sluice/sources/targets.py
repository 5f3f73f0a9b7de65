"""Where a job's tables and dead letters lie below its warehouse folder."""

from __future__ import annotations

import re

STREAMING, BACKFILL = "streaming", "backfill"


class MissingTarget(ValueError):
    """The configuration names no place for an output."""


def _setting(cfg: dict, *path: str) -> str:
    value: object = cfg
    for key in path:
        value = value.get(key) if isinstance(value, dict) else None
    if not value:
        raise MissingTarget(f"set {'.'.join(path)} in the destination configuration")
    return str(value)


def rerun_name(start: str, end: str, run_id: str | None = None) -> str:
    """A name for one backfill: its run id, or both bounds without punctuation of times."""
    return run_id or "_".join(re.sub("[-:]", "", str(bound)) for bound in (start, end))


def live_table(destination: dict) -> str:
    return "/".join(_setting(destination, "target", part) for part in ("dataset", "table"))


def rerun_table(destination: dict, name: str) -> str:
    """The temporary table of a backfill."""
    dataset, prefix = (_setting(destination, "temp_table", part) for part in ("dataset", "table_prefix"))
    return f"{dataset}/{prefix}_{name}"


def letters_target(destination: dict, backfill: dict, mode: str) -> str:
    """Place of dead letters; a backfill may name one of its own."""
    own = (backfill.get("dlq") or {}).get("topic") if mode == BACKFILL else None
    return own or _setting(destination, "dlq_topic")
