"""Secret scans: single patterns, and weak parts that count only beside complementary parts.

Base patterns (assignments, access keys, long hex) are secrets by themselves. Weak parts are an
identifier (client or account id), a bare high-entropy value and an endpoint (URL or host with
credentials in use). Each part carries an interval: its whole scope, or the part widened by ``reach`` code points
within it where a caller gives one. A scope is a run of lines without an empty line between them. A
weak part is reported if intervals of complementary parts meet in its scope: an identifier
needs a secret, a value needs an identifier (and no assignment around it), an endpoint needs
both. Intervals are joined in one sorted sweep per scope, so a text with many parts costs
n log n, never all pairs.

NULL and empty texts have no spans. Every row is scanned alone: equal rows get equal results,
and other columns are never read.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sluice.llm.common import replaced, table, text_slices

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
# Cheap test for an assignment keyword.
KEYWORD = re.compile(r"password|passwd|secret|token|api_?key", re.ASCII | re.IGNORECASE)
IDENTIFIER = re.compile(
    r"""\b(?:client_?id|account_?id|access_?key_?id|user(?:name)?|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@+/_.-]{3,})""",
    re.ASCII | re.IGNORECASE,
)
ENDPOINT = re.compile(
    r"""\b(?:[a-z][a-z0-9+]{1,9}://[^\s"'<>]{4,}|(?:[a-z0-9-]+\.)+(?:com|net|org|io|dev|cloud|internal)(?::[0-9]{2,5})?\b)""",
    re.ASCII | re.IGNORECASE,
)
VALUE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])", re.ASCII)
MIN_VALUE_ENTROPY = 3.5
SCOPE_END = re.compile(r"\n[\x20\t\r]*\n")
# Listed order of kinds; base ones first.
KINDS = ("assign", "access", "hex", "identifier", "value", "endpoint")
RANK = {k: i for i, k in enumerate(KINDS)}
MASK = "[SECRET]"


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out = []
    if KEYWORD.search(text):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    # Runs of hex digits are maximal, so the long ones are the matches that do not fail.
    out += [(m.start(), m.end(), "hex") for m in LONG_HEX.finditer(text)]
    return out


def entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def looks_random(value: str) -> bool:
    """Letters and digits mixed, many different characters."""
    has = (re.search("[0-9]", value), re.search("[a-z]", value), re.search("[A-Z]", value))
    return sum(x is not None for x in has) >= 2 and has[0] is not None and entropy(value) >= MIN_VALUE_ENTROPY


def covered(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of spans as sorted disjoint intervals."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def meets(intervals: list[tuple[int, int]], starts: list[int], start: int, end: int) -> bool:
    """Does [start, end] meet one of the sorted disjoint intervals?"""
    i = bisect_left(starts, end + 1)
    return i > 0 and intervals[i - 1][1] >= start


def linked_parts(text: str, base: list[tuple[int, int, str]], reach: int | None = None) -> list[tuple[int, int, str]]:
    """Weak parts whose complementary parts stand in the same scope, within reach if one is given."""
    ids = [(m.start(), m.end()) for m in IDENTIFIER.finditer(text)] if ("=" in text or ":" in text) else []
    secrets = [(s, e) for s, e, k in base if k != "access"]
    access = [(s, e) for s, e, k in base if k == "access"]
    if not ids and not access:
        return []
    taken = covered([(s, e) for s, e, _ in base] + ids)
    taken_starts = [s for s, _ in taken]
    values = [
        (m.start(), m.end()) for m in VALUE.finditer(text)
        if looks_random(m[0]) and not meets(taken, taken_starts, m.start() + 1, m.end() - 1)
    ]
    if not secrets and not values:
        return []
    points = [(m.start(), m.end()) for m in ENDPOINT.finditer(text)]
    bounds = [0, *(m.start() for m in SCOPE_END.finditer(text)), len(text)]

    reach = len(text) if reach is None else reach

    def widened(spans: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], list[int]]:
        wide = []
        for s, e in spans:
            i = bisect_left(bounds, s + 1) - 1
            # Scopes are kept apart by one code point, so that they never touch.
            wide.append((max(s - reach, bounds[i] + (i > 0)), min(e + reach, bounds[min(i + 1, len(bounds) - 1)] - 1)))
        merged = covered(wide)
        return merged, [s for s, _ in merged]

    near_ids, near_secrets = widened(ids + access), widened(secrets + values)
    out = [(s, e, "identifier") for s, e in ids if meets(*near_secrets, s, e)]
    out += [(s, e, "value") for s, e in values if meets(*near_ids, s, e)]
    out += [(s, e, "endpoint") for s, e in points if meets(*near_ids, s, e) and meets(*near_secrets, s, e)]
    return out


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], RANK[x[2]])))


def scan(text: str | None, reach: int | None = None) -> tuple[list, list]:
    """Base spans and all spans of a text."""
    if not text:
        return [], []
    base = base_spans(text)
    return base, base + linked_parts(text, base, reach)


def redact(text: str | None, reach: int | None = None) -> str | None:
    """The text with every span masked."""
    spans = scan(text, reach)[1]
    if not spans:
        return text
    out, at = [], 0
    for s, e in covered([x[:2] for x in spans]):
        out += [text[at:s], MASK]
        at = e
    return "".join([*out, text[at:]])


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int | None = None) -> DataFrame:
    """Counts and spans per row of ``docs``: one narrow pass, no shuffle."""
    id_type = docs.schema[id_col].dataType.simpleString()
    counts = ["n_assign", "n_access", "n_hex"]
    schema = f"`{id_col}` {id_type}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, text_col):
            rows = []
            for text in part.column(text_col).to_pylist():
                base, spans = scan(text, reach)
                kinds = Counter(map(itemgetter(2), base))
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                rows.append((kinds["assign"], kinds["access"], kinds["hex"], digest, joined(spans)))
            columns = list(zip(*rows)) or [[]] * 5
            types = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [part.column(id_col), *(pa.array(c, t) for c, t in zip(columns, types))],
                names=[id_col, *counts, "base_sha256", "spans"],
            )

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def redacted_documents(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars", reach: int | None = None) -> DataFrame:
    """All documents with their secrets masked; columns and their order stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, text_col):
            old = part.column(text_col).to_pylist()
            new = [redact(t, reach) for t in old]
            columns = {text_col: new}
            if chars_col in part.schema.names:
                chars = part.column(chars_col).to_pylist()
                columns[chars_col] = [c if a is b else len(b) for a, b, c in zip(old, new, chars)]
            yield replaced(part, **columns)

    return docs.mapInArrow(run, docs.schema)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))
