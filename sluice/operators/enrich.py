"""Business rules, the enrichment kinds and entity extraction."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import text as T
from sluice.operators.casts import float_of_text
from sluice.operators.fields import KIND_OF_SPARK, SQL_TYPES, EventFrame, Field, choose, dynamic_field, literal, null_field, quoted, typed
from sluice.operators.route import reject_struct, reject_where
from sluice.operators.skew import HOT_ROWS, hot_key_counts, split_join


def _holds(f: Field) -> Column:
    """Truth of a condition: NULL, which also stands for a failed evaluation, is false."""
    if f.kind == "boolean":
        return F.coalesce(f.view, F.lit(False))
    if f.kind in ("integer", "float"):
        return F.coalesce(f.view != 0, F.lit(False))
    if f.kind == "string":
        return F.coalesce(f.view != "", F.lit(False))
    return F.lit(False)


def business_rules(event: EventFrame, rules: Any) -> None:
    for rule in rules or []:
        condition = event.expression(rule["condition"])
        value = literal(rule.get("value", True))
        event.set(rule["output_field"], choose(_holds(condition), value, literal(False), "boolean"))
    event.flush()


def _look_up(key: Column, entries: dict[Any, Any], default: Field) -> Field:
    """Value of a constant map at the key, else the default. One search of the map per row."""
    if not entries:
        return default
    values = [literal(v) for v in entries.values()]
    kinds = {v.kind for v in values} - {"null"}
    kind = kinds.pop() if len(kinds) == 1 else ("string" if not kinds else "dynamic")
    pairs: list[Column] = []
    for entry, v in zip(entries, values):
        # A struct tells a NULL value from an absent key.
        pairs += [F.lit(entry), F.struct((v.as_variant() if kind == "dynamic" else v.view).alias("v"))]
    hit = F.try_element_at(F.create_map(*pairs), key)
    found = dynamic_field(hit["v"]) if kind == "dynamic" else typed(kind, hit["v"])
    return choose(hit.isNotNull(), found, default)


def static_lookup(event: EventFrame, cfg: dict) -> None:
    """Exact key to value. Text keys match text only; numbers and booleans match by value.

    Whole numbers are compared as such: as doubles, keys beyond 2**53 would meet their neighbours.
    """
    f = event.get(cfg.get("input_field"))
    table = cfg.get("lookup") or {}
    texts = {k: v for k, v in table.items() if isinstance(k, str)}
    numbers = {k: v for k, v in table.items() if isinstance(k, (bool, int, float))}
    whole = {int(k): v for k, v in numbers.items() if k == int(k) and abs(k) < 2**63}
    # Keys of float rows; a whole number that no double equals matches none of them.
    floats = {float(k): v for k, v in numbers.items() if float(k) == k}
    result = literal(cfg.get("default"))
    if None in table:
        result = choose(f.is_null(), literal(table[None]), result)
    if numbers:
        kind = f.kinds()
        result = _look_up(F.when(kind == "float", f.number()), floats, result)
        result = _look_up(F.when(kind.isin("integer", "boolean"), f.whole()), whole, result)
    if texts:
        result = _look_up(F.when(f.is_string(), f.text()), texts, result)
    if f.dynamic:
        # A list or an object cannot be a key: such an event is refused.
        k = f.kinds()
        for kind, name in (("array", "list"), ("object", "dict")):
            event.df = reject_where(
                event.df,
                k == kind,
                reject_struct("transform", F.lit(f"Transformation failed: unhashable type: '{name}'")),
            )
    event.set(cfg["output_field"], result)


def table_lookup(event: EventFrame, cfg: dict) -> None:
    """Static lookup whose map is a table: ``table`` (a Parquet path), ``key`` and ``value`` columns.

    Keys are compared as text, so a small and a large table give the same.
    """
    f = event.get(cfg.get("input_field"))
    event.flush()
    table = event.df.sparkSession.read.parquet(cfg["table"])
    table = table.select(F.col(cfg["key"]).cast("string").alias("_table_id"), F.col(cfg["value"]).alias("_table_v"))
    kind = KIND_OF_SPARK.get(table.schema["_table_v"].dataType.simpleString(), "string")
    out = f"_table_{cfg['output_field']}"
    spread = [quoted(c) for c, t in event.df.dtypes if t in HASHABLE] or [event.df.columns[0]]
    joined = lookup_table(
        event.df.withColumn("_table_key", f.text()), table.withColumn("_table_v", F.col("_table_v").cast(SQL_TYPES[kind])),
        "_table_key", "_table_id", "_table_v", out, spread, default=cfg.get("default"),
    )
    event.df = joined.drop("_table_key")
    event.set(cfg["output_field"], typed(kind, F.col(quoted(out))))


def range_lookup(event: EventFrame, cfg: dict) -> None:
    """First range that holds the number; open ends and exclusive bounds allowed."""
    f = event.get(cfg.get("input_field"))
    n = F.coalesce(f.number(), float_of_text(F.when(f.is_string(), f.text())))
    result = literal(cfg.get("default"))
    for rule in reversed([r for r in cfg.get("ranges") or [] if isinstance(r, dict)]):
        inside = n.isNotNull()
        if rule.get("min") is not None:
            low = F.lit(float(rule["min"]))
            # Spark orders NaN above all numbers; here it is in no bounded range.
            inside = inside & ~F.isnan(n) & (n >= low if rule.get("include_min", True) else n > low)
        if rule.get("max") is not None:
            high = F.lit(float(rule["max"]))
            inside = inside & ~F.isnan(n) & (n <= high if rule.get("include_max", True) else n < high)
        result = choose(F.coalesce(inside, F.lit(False)), literal(rule.get("value")), result)
    event.set(cfg["output_field"], result)


def multi_key_lookup(event: EventFrame, cfg: dict) -> None:
    """Trimmed parts of several fields joined to one key. Config keys are used as written."""
    parts = []
    for name in cfg.get("input_fields") or []:
        part = T.strip(event.get(name).text())
        parts.append(F.coalesce(F.lower(part) if cfg.get("normalize_case", False) else part, F.lit("")))
    key = F.concat_ws(str(cfg.get("separator", "|")), *parts)
    table = {k: v for k, v in (cfg.get("lookup") or {}).items() if isinstance(k, str)}
    event.set(cfg["output_field"], _look_up(key, table, literal(cfg.get("default"))))


def regex_lookup(event: EventFrame, cfg: dict) -> None:
    """Value of the first pattern found, or of the last one when ``first_match`` is off."""
    f = event.get(cfg.get("input_field"))
    text = F.when(f.is_string(), f.text())
    patterns = [p for p in cfg.get("patterns") or [] if isinstance(p, dict) and p.get("pattern")]
    if cfg.get("first_match", True):
        patterns = patterns[::-1]
    result = literal(cfg.get("default"))
    for p in patterns:
        flags = "(?iu)" if p.get("ignore_case", True) else ""
        found = F.coalesce(text.rlike(flags + p["pattern"]), F.lit(False))
        result = choose(found, literal(p.get("value")), result)
    event.set(cfg["output_field"], result)


def conditional_set(event: EventFrame, cfg: dict) -> None:
    result = literal(cfg.get("default"))
    cases = [c for c in cfg.get("conditions") or [] if isinstance(c, dict) and c.get("when")]
    for c in reversed(cases):
        result = choose(_holds(event.expression(c["when"])), literal(c.get("value")), result)
    event.set(cfg["output_field"], result)


def derived_fields(event: EventFrame, cfg: dict) -> None:
    items = cfg.get("fields")
    for item in items if isinstance(items, list) else [cfg]:
        if not isinstance(item, dict) or not item.get("output_field") or not item.get("expression"):
            continue
        value = event.expression(item["expression"])
        default = literal(item.get("default"))
        event.set(item["output_field"], choose(value.is_null(), default, value))


_TEXT_STEPS = {
    "trim": T.strip,
    "lower": F.lower,
    "upper": F.upper,
    "title": T.title,
    "collapse_spaces": T.collapse_spaces,
}


def normalization(event: EventFrame, cfg: dict) -> None:
    """Text steps in the given order, then synonyms."""
    source = cfg.get("input_field")
    f = event.get(source)
    text = f.text()
    for step in cfg.get("operations") or []:
        if step in _TEXT_STEPS:
            text = _TEXT_STEPS[step](text)
    synonyms = {k: v for k, v in (cfg.get("synonyms") or {}).items() if isinstance(k, str)}
    result = _look_up(text, synonyms, typed("string", text))
    event.set(cfg.get("output_field", source), choose(f.is_null(), literal(cfg.get("default")), result))


ENRICHMENTS = {
    "static_lookup": static_lookup,
    "table_lookup": table_lookup,
    "range_lookup": range_lookup,
    "multi_key_lookup": multi_key_lookup,
    "regex_lookup": regex_lookup,
    "conditional_set": conditional_set,
    "derived_fields": derived_fields,
    "normalization_enrichment": normalization,
}


def enrichment(event: EventFrame, items: Any) -> None:
    """All enrichments in order; unknown types are skipped (the config check warns)."""
    for cfg in items or []:
        step = ENRICHMENTS.get(cfg.get("type"))
        if step is not None:
            step(event, cfg)
    event.flush()


def entity_extraction(event: EventFrame, items: Any) -> None:
    """First match of each pattern, whole match, any case. Blank text leaves outputs alone."""
    for cfg in items or []:
        f = event.get(cfg["field"], nested=False)
        text = F.when(f.is_string(), f.text())
        usable = F.coalesce(T.strip(text) != "", F.lit(False))
        for ent in cfg["entities"]:
            pattern = "(?iu)" + ent["pattern"]
            match = F.regexp_substr(text, F.lit(pattern))
            before = event.get(ent["name"], nested=False)
            event.set(ent["name"], choose(usable, typed("string", match), before))
    event.flush()


# Up to this many rows a lookup table is broadcast; the count is checked first.
MAX_BROADCAST_LOOKUP = 200_000
MAX_BROADCAST_BYTES = 64 << 20
# Column types that can be hashed to spread the rows of a hot key.
HASHABLE = ("string", "bigint", "int", "double", "timestamp", "date", "binary", "boolean")


def lookup_table(
    df: DataFrame,
    table: DataFrame,
    key: str,
    table_key: str,
    table_value: str,
    output: str,
    spread_by: list[str],
    default: Any = None,
    max_broadcast: int = MAX_BROADCAST_LOOKUP,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Static lookup against a table. Of a key that repeats, the smallest value that is not NULL counts.

    A table of up to ``max_broadcast`` rows and ``MAX_BROADCAST_BYTES`` (measured first, stopping at the limit) is
    broadcast. A larger one is joined by shuffle, with its share for hot keys broadcast.
    """
    pairs = table.select(F.col(table_key).alias("_lk"), F.col(table_value).alias("_lv")).filter(F.col("_lk").isNotNull())
    pairs = pairs.groupBy("_lk").agg(F.min("_lv").alias("_lv"))
    value = F.struct(F.col("_lv").alias("v"))
    width = F.octet_length(F.col("_lk").cast("string")) + F.coalesce(F.octet_length(F.col("_lv").cast("string")), F.lit(0))
    rows, held = pairs.limit(max_broadcast + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    if rows <= max_broadcast and held <= MAX_BROADCAST_BYTES:
        small = pairs.select("_lk", value.alias("_hit"))
        out = df.join(F.broadcast(small), F.col(key).eqNullSafe(F.col("_lk")), "left").drop("_lk")
    else:
        renamed = pairs.select(F.col("_lk").alias(key), value.alias("_hit"))
        hot_keys = hot_key_counts(df, key, hot_rows).filter(F.col(key).isNotNull())
        hot = renamed.join(F.broadcast(hot_keys), key, "left_semi")
        cold = renamed.join(F.broadcast(hot_keys), key, "left_anti")
        out = split_join(
            df, cold, hot, key, "_hit", spread_by, no_match=F.col(key).isNull()
        )
    found = F.when(F.col("_hit").isNotNull(), F.col("_hit.v")).otherwise(F.lit(default))
    return out.withColumn(output, found).drop("_hit")
