"""License scans: identifier tags and notice phrases by Aho-Corasick, expressions by shunting-yard.

A text is lower-cased (A-Z), cut into words of digits, letters and non-ASCII characters, and run
once through an automaton of phrases that start and end at word borders. An ``SPDX-License-
Identifier`` hit hands the rest of its line to the expression parser: a shunting-yard over
``and``, ``or``, ``with`` and parentheses gives postfix order, which is evaluated to the
licenses in it and to a class (``or`` takes the freer side, ``and`` the stricter one, an
exception loosens by one class). Names must be known identifiers or ``LicenseRef-``
names; an expression with any other name, like a broken one, gives no label. It ends at the
end of its line, a comment end, the next tag, or the word behind a complete expression.

The score is the chance that the document states a license: 1 - product of (1 - weight) over
its evidence. NULL and empty texts have no words, no labels and score 0. Rows are scanned alone:
equal rows get equal results, other columns are never read, an empty table gives no rows. Time
and memory grow with the length of a text, however many tags or phrases it holds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sluice.llm.common import table, text_slices

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# Word borders: A-Z become a-z, all other ASCII characters outside [0-9a-z] become spaces.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
LOWER = {b: b + 32 for b in range(65, 91)}
# Fixed phrases of the contract and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Further notice phrases.
NOTICES = {
    "affero general public license": "agpl",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons zero": "cc0",
    "dedicated to the public domain": "public-domain",
    "eclipse public license": "epl",
    "gnu general public license": "gpl",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "isc license": "isc",
    "mozilla public license": "mpl",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
TAG = "spdx license identifier"
# Identifier prefix, label, class (0 free, 1 file-level duties, 2 strong duties, 3 no commerce).
# Longer prefixes stand first.
IDENTIFIERS = (
    ("apache-2", "apache-2", 0), ("mit", "mit", 0), ("isc", "isc", 0), ("bsd", "bsd", 0), ("0bsd", "bsd", 0),
    ("zlib", "zlib", 0), ("unlicense", "unlicense", 0), ("cc0", "cc0", 0),
    ("cc-by-nc", "cc-by-nc", 3), ("cc-by-sa", "cc-by-sa", 2), ("cc-by", "cc-by", 0),
    ("artistic", "artistic", 0), ("bsl-1.0", "bsl", 0), ("postgresql", "postgresql", 0), ("python", "python", 0), ("psf", "python", 0),
    ("ofl", "ofl", 0), ("wtfpl", "wtfpl", 0), ("ncsa", "ncsa", 0), ("x11", "x11", 0), ("openssl", "openssl", 0), ("ms-pl", "ms-pl", 0),
    ("lgpl", "lgpl", 1), ("mpl", "mpl", 1), ("epl", "epl", 1), ("cddl", "cddl", 1), ("eupl", "eupl", 2), ("ms-rl", "ms-rl", 1),
    ("agpl", "agpl", 2), ("gpl-2", "gpl-2", 2), ("gpl-3", "gpl-3", 2), ("gpl", "gpl", 2),
)
# Names that a project defines for itself are labels of their own, of the strictest class.
OWN_NAME = re.compile(r"(documentref-[a-z0-9.-]+:)?licenseref-[a-z0-9.-]+")
OWN_CLASS = 3
EXCEPTION = re.compile(r"[a-z0-9.+-]+-exception(-[a-z0-9.-]+)?|linux-syscall-note")
TAG_WEIGHT, BASE_WEIGHT, NOTICE_WEIGHT = 0.95, 0.8, 0.7
TOKEN = re.compile(r"[()]|[A-Za-z0-9.+:-]+")
LEAD = re.compile(r"[ :=]*")
# Comment ends that may follow an identifier on its line.
LINE_END = re.compile(r"\*/|-->|[\r\n;,\"']")
PRECEDENCE = {"or": 1, "and": 2, "with": 3}


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase, kind, label in [
        *((p, "base", v) for p, v in BASE_PHRASES.items()),
        *((p, "notice", v) for p, v in NOTICES.items()),
        (TAG, "tag", ""),
    ]:
        found.add_word(f" {phrase} ", (kind, label, len(phrase)))
    found.make_automaton()
    return found


def identifier(name: str) -> tuple[set[str], int] | None:
    """Labels and class of one identifier: none for NONE and NOASSERTION, None if it is unknown."""
    low = name.lower().rstrip("+")
    if low in ("none", "noassertion"):
        return set(), 0
    for prefix, label, level in IDENTIFIERS:
        if low == prefix or low.startswith(prefix) and low[len(prefix)] in "-.":
            return {label}, level
    return ({low}, OWN_CLASS) if OWN_NAME.fullmatch(low) else None


def parse(text: str, start: int, stop: int) -> tuple[list[str], list[str]] | None:
    """Shunting-yard over a stretch of text: (tokens read, tokens in postfix order), None if broken."""
    read, out, stack, want_operand = [], [], [], True
    for found in TOKEN.finditer(text, start, stop):
        token = found.group()
        low = token.lower()
        if low in PRECEDENCE:
            if want_operand:
                return None
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[low]:
                out.append(stack.pop())
            stack.append(low)
            want_operand = True
        elif token == "(":
            if not want_operand:
                return None
            stack.append(token)
        elif token == ")":
            if want_operand:
                return None
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        elif want_operand:
            out.append(token)
            want_operand = False
        else:
            # Prose after a complete expression ends it.
            break
        read.append(token)
    if want_operand or "(" in stack:
        return None
    return read, out + stack[::-1]


def evaluate(expression: str) -> tuple[set[str], int] | None:
    """Labels and class of an expression, None if it is broken, has an unknown name or no license."""
    parsed = parse(expression, 0, len(expression))
    return value_of(parsed[1]) if parsed else None


def value_of(order: list[str]) -> tuple[set[str], int] | None:
    """Labels and class of tokens in postfix order. An unknown exception grants nothing."""
    stack: list = []
    for token in order:
        if token not in PRECEDENCE:
            stack.append(token)
            continue
        right, left = stack.pop(), _value(stack.pop())
        if token == "with":
            if left is None or not isinstance(right, str):
                return None
            granted = EXCEPTION.fullmatch(right.lower()) is not None
            stack.append((left[0], max(left[1] - granted, 0)))
            continue
        right = _value(right)
        if left is None or right is None:
            return None
        level = min(left[1], right[1]) if token == "or" else max(left[1], right[1])
        stack.append((left[0] | right[0], level))
    value = _value(stack.pop())
    return value if value and value[0] else None


def _value(item: str | tuple[set[str], int]) -> tuple[set[str], int] | None:
    return item if isinstance(item, tuple) else identifier(item)


def tag_expressions(text: str, tag_words: list[int]) -> Iterator[tuple[list[str], set[str], int]]:
    """(tokens, labels, class) behind each tag, given the number of its first word."""
    spans = [m.span() for m in WORDS.finditer(text.translate(LOWER))]
    last = TAG.count(" ")
    stops = [*(spans[w][0] for w in tag_words[1:]), len(text)]
    for word, stop in zip(tag_words, stops):
        start = LEAD.match(text, spans[word + last][1], stop).end()
        line_end = LINE_END.search(text, start, stop)
        parsed = parse(text, start, line_end.start() if line_end else stop)
        if parsed and (value := value_of(parsed[1])):
            yield parsed[0], *value


def scan(text: str | None) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score, expressions, class)."""
    words = (text or "").encode().translate(FOLD).split(b" ") if text else []
    words = [w for w in words if w]
    if not words:
        return 0, 0, None, None, "", "", 0.0, None, None
    flat = f" {b' '.join(words).decode()} "
    places, base_labels, labels, notices, expressions, tags = [], set(), set(), set(), [], []
    # A hit ends at the space after its phrase. Words before it are counted by their spaces, from hit to hit.
    hits = sorted((end - length, kind, label) for end, (kind, label, length) in automaton().iter(flat))
    word, counted = -1, 0
    for start, kind, label in hits:
        word += flat.count(" ", counted, start)
        counted = start
        if kind == "tag":
            tags.append(word)
            continue
        if kind == "base":
            places.append(word)
            base_labels.add(label)
        else:
            notices.add(label)
        labels.add(label)
    level = None
    for tokens, found, strictness in tag_expressions(text, tags) if tags else ():
        labels |= found
        expressions.append(" ".join(tokens))
        level = strictness if level is None else max(level, strictness)
    miss = (1 - BASE_WEIGHT) ** len(base_labels) * (1 - NOTICE_WEIGHT) ** len(notices) * (1 - TAG_WEIGHT) ** len(expressions)
    return (
        len(words), len(places), min(places, default=None), max(places, default=None),
        ",".join(sorted(base_labels)), ",".join(sorted(labels)), 1 - miss, "; ".join(expressions) or None, level,
    )


FIELDS = (
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("expressions", pa.string()), ("license_class", pa.int64()),
)
SQL_TYPES = {pa.int64(): "long", pa.string(): "string", pa.float64(): "double"}


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Labels, places and score per row of ``docs``: one narrow pass, no shuffle."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, " + ", ".join(f"{n} {SQL_TYPES[t]}" for n, t in FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, text_col):
            rows = [scan(t) for t in part.column(text_col).to_pylist()]
            columns = list(zip(*rows)) or [[]] * len(FIELDS)
            yield pa.RecordBatch.from_arrays(
                [part.column(id_col), *(pa.array(c, t) for c, (_, t) in zip(columns, FIELDS))],
                names=[id_col, *(n for n, _ in FIELDS)],
            )

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))
