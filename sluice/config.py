"""Loading and checking of the job configuration."""

from __future__ import annotations

import json
import os
import re
import warnings
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

try:  # YAML is optional: every file may also be JSON.
    import yaml
except ImportError:  # pragma: no cover
    yaml = None

from pyspark.sql import SparkSession

from sluice.operators.casts import CAST_KINDS
from sluice.operators.enrich import ENRICHMENTS
from sluice.operators.validate import TYPE_CHECKS


class ConfigError(ValueError):
    """All problems of a configuration at once."""


@dataclass
class JobConfig:
    destination: dict
    transformations: dict
    validation: dict
    streaming_tuning: dict
    raw_events: dict
    schema_management: dict = field(default_factory=dict)
    expected_schema: dict = field(default_factory=dict)
    backfill_settings: dict = field(default_factory=dict)
    observability: dict = field(default_factory=dict)
    env: str = "dev"


def _read_text(path: str, spark=None) -> str | None:
    if spark is None or re.match(r"^(file:)?/[^/]", path) or "://" not in path:
        local = path.removeprefix("file:")
        if not os.path.exists(local):
            return None
        with open(local, encoding="utf-8") as f:
            return f.read()
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    # Only a file that is not there counts as absent; one that cannot be read is an error.
    if not file.getFileSystem(spark._jsc.hadoopConfiguration()).exists(file):
        return None
    return spark.read.text(path, wholetext=True).first()[0]


def _load(folder: str, name: str, spark=None) -> Any:
    """``name`` as .yaml, .yml or .json; None where no such file exists."""
    for suffix in (".yaml", ".yml", ".json"):
        text = _read_text(f"{folder.rstrip('/')}/{name}{suffix}", spark)
        if text is None:
            continue
        if suffix == ".json":
            return json.loads(text)
        if yaml is None:
            raise ConfigError(f"{name}{suffix} needs PyYAML; use {name}.json")
        return yaml.safe_load(text)
    return None


def load_config(folder: str, spark=None) -> JobConfig:
    """Read the configuration folder and check it; all problems are reported together."""
    problems: list[str] = []
    parts: dict[str, Any] = {}
    for key, name in (
        ("destination", "destination_mapping"),
        ("transformations", "transformation"),
        ("validation", "validation"),
        ("pipeline", "pipeline"),
    ):
        value = _load(folder, name, spark)
        if value is None:
            problems.append(f"required config '{name}' not found or empty")
        elif not value:
            problems.append(f"config '{name}' loaded as empty")
        parts[key] = value or {}
    main = parts.pop("pipeline")
    schema_cfg = main.get("schema_management") or {}
    expected: dict = {}
    if schema_cfg.get("enabled", False):
        name = schema_cfg.get("schema_name")
        expected = _load(folder, f"schemas/{name}", spark) or {}
        if not expected:
            problems.append(f"missing schema file: schemas/{name}.json")
    cfg = JobConfig(
        destination=parts["destination"],
        transformations=parts["transformations"],
        validation=parts["validation"],
        streaming_tuning=main.get("streaming_tuning") or {},
        raw_events=main.get("raw_events") or {},
        schema_management=schema_cfg,
        expected_schema=expected,
        backfill_settings=_load(folder, "backfill", spark) or {},
        observability=main.get("observability") or {},
        env=main.get("env", "dev"),
    )
    check_config(cfg, problems, spark)
    return cfg


@dataclass(frozen=True)
class Needed:
    """A setting (dotted path in the job configuration) and when it must be there."""

    path: str
    when: Callable[[JobConfig], bool] = lambda cfg: True
    # A block may be empty, a value may not.
    block: bool = False


def _tuning(cfg: JobConfig, block: str) -> dict:
    return cfg.streaming_tuning.get(block) or {}


def _buffers(cfg: JobConfig) -> bool:
    return _tuning(cfg, "dedup").get("mode", "two_phase") != "none"


NEEDED = (
    Needed("raw_events"),
    *(Needed(f"streaming_tuning.{name}", block=True) for name in ("dedup", "sharding", "windowing", "batching")),
    Needed("streaming_tuning.dedup.buffer_seconds", _buffers),
    Needed("streaming_tuning.sharding.num_shards", lambda cfg: _tuning(cfg, "dedup").get("mode") == "two_phase"),
    Needed("streaming_tuning.windowing.window_size_sec", lambda cfg: _tuning(cfg, "windowing").get("enabled", True)),
)


def _present(cfg: JobConfig, item: Needed) -> bool:
    first, *rest = item.path.split(".")
    value = getattr(cfg, first)
    for key in rest:
        if not isinstance(value, dict) or key not in value:
            return False
        value = value[key]
    return item.block or value not in (None, "", {}, [])


def check_config(cfg: JobConfig, problems: list[str] | None = None, spark=None) -> None:
    """Raise on what cannot work, warn on what has no effect.

    Patterns are Java regular expressions; with a session they are compiled as such.
    """
    problems = list(problems or [])
    problems += [f"setting {n.path} is needed" for n in NEEDED if n.when(cfg) and not _present(cfg, n)]
    t = cfg.transformations
    problems += [
        f"business rule {rule} names no {key}"
        for rule in t.get("business_rules") or []
        for key in ("condition", "output_field")
        if key not in rule
    ]
    lookups = [i for i in t.get("enrichment") or [] if i.get("type") == "regex_lookup"]
    patterns = [p.get("pattern") for i in lookups for p in i.get("patterns") or []]
    patterns += [e.get("pattern") for i in t.get("entity_extraction") or [] for e in i.get("entities") or []]
    problems += bad_patterns(patterns, spark)
    if problems:
        raise ConfigError("; ".join(problems))
    for message in config_warnings(cfg):
        warnings.warn(message, stacklevel=3)


def bad_patterns(patterns, spark=None) -> list[str]:
    """Patterns that executors could not compile. Without a session there is no JVM to ask: then
    only what both dialects refuse is found, and the job's start finds the rest."""
    spark = spark or SparkSession.getActiveSession()
    out = []
    for p in patterns:
        try:
            if spark is not None:
                spark._jvm.java.util.regex.Pattern.compile(p or "")
            else:
                re.compile(re.sub(r"\(\?<(?=[A-Za-z])", "(?P<", p or ""))
        except Exception as e:
            out.append(f"bad pattern {p!r}: {str(e).splitlines()[0]}")
    return out


def config_warnings(cfg: JobConfig) -> list[str]:
    """Settings that are read but change nothing."""
    out = []
    for item in cfg.transformations.get("enrichment") or []:
        if item.get("type") not in ENRICHMENTS:
            out.append(f"unknown enrichment type {item.get('type')!r} is ignored")
    for rule in cfg.transformations.get("type_casts") or []:
        if isinstance(rule, dict) and str(rule.get("to", "")).strip().lower() not in CAST_KINDS:
            out.append(f"unknown cast type {rule.get('to')!r} never succeeds")
    for name, kind in (cfg.validation.get("type_checks") or {}).items():
        if kind not in TYPE_CHECKS:
            out.append(f"type check {name}: {kind} checks nothing (names are upper case)")
    dedup = cfg.streaming_tuning.get("dedup") or {}
    if "enabled" in dedup:
        out.append("dedup.enabled has no effect; use dedup.mode: none")
    for key in ("payload_policy", "schema_mode"):
        if key in cfg.destination:
            out.append(f"destination {key} has no effect")
    if "scope" in cfg.schema_management:
        out.append("schema_management.scope has no effect")
    return out
