"""Line-first cleaning: judge every line, remove failing lines, then judge what is left.

Rules per line (a line without words stays and counts for nothing):

* punctuation: a line ends a sentence, or holds a sentence end per ``SENTENCE_WORDS`` words;
  symbols, doubled exclamation marks and capitals must not dominate it;
* navigation: separators stand between few words (menus, breadcrumbs, table rows);
* boilerplate: a short line with a fixed phrase of web page furniture.

A document goes if it fails the base rules (under 10 words, or over 20 % of its words in
repeated 5-word windows) or if failing lines hold more than ``max_lost`` of its words.
NULL and empty texts have no words and are refused. Rows are judged one by one: equal rows get
equal results, other columns are never read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sluice.llm.common import replaced, table, text_slices

MAX_LOST = 0.5
SENTENCE_WORDS = 50
SHORT_LINE_WORDS = 30
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
SENTENCE_END = re.compile(r"""[.!?…]["'”»)\]]*$""")
SENTENCE_ENDS = re.compile(r"""[.!?…]["'”»)\]]*(?=[\x20\x09-\x0D]|$)""")
SEPARATORS = re.compile(r"(?:^|(?<=[\x20\x09-\x0D]))(?:[|•·»>/]|->|::)(?=[\x20\x09-\x0D]|$)")
# Fixed phrases of page furniture.
BOILERPLATE = (
    "accept cookies", "all rights reserved", "back to top", "click here", "cookie policy", "enable javascript",
    "log in", "lorem ipsum", "powered by", "privacy policy", "read more", "share this", "sign up", "skip to content",
    "subscribe to", "terms of service", "terms of use", "uses cookies",
)
BOILERPLATE_RE = re.compile("|".join(re.escape(p) for p in BOILERPLATE))
RULES = ("symbols", "shouting", "navigation", "boilerplate", "punctuation")
# [A-Z] lower-cased, nothing else.
ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
CAPITALS = {c: None for c in range(ord("A"), ord("Z") + 1)}
LETTERS = CAPITALS | {c + 32: None for c in CAPITALS}


def failed_rule(line: str, n_words: int) -> str | None:
    """Name of the first rule that a line with words fails."""
    if 3 * sum(map(line.count, SYMBOLS)) > n_words and "|" not in line:
        return "symbols"
    if n_words >= 3 and 5 * line.count("!!") > n_words:
        return "shouting"
    if "|" in line or n_words <= 2 * SHORT_LINE_WORDS:
        n_separators = len(SEPARATORS.findall(line))
        if n_separators >= 2 and 5 * n_separators >= n_words:
            return "navigation"
    if 3 * sum(map(line.count, SYMBOLS)) > n_words:
        return "symbols"
    if n_words <= SHORT_LINE_WORDS and BOILERPLATE_RE.search(line.translate(ASCII_LOWER)):
        return "boilerplate"
    if SENTENCE_END.search(line.rstrip(SPACES)):
        return None
    if SENTENCE_WORDS * len(SENTENCE_ENDS.findall(line)) >= n_words and n_words > 5:
        return None
    return "punctuation"


def repeated_words(words: list[bytes]) -> int:
    """Words inside 5-word windows that the text has twice or more."""
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
    if len(set(windows)) == len(windows):
        return 0
    counts, mark = Counter(windows), bytearray(len(words))
    for i, w in enumerate(windows):
        if counts[w] > 1:
            mark[i : i + 5] = b"\1\1\1\1\1"
    return sum(mark)


def judge(text: str | None, max_lost: float = MAX_LOST) -> dict:
    """Base counts, the words each rule removes, the verdict and the cleaned text."""
    text = text or ""
    words = text.encode().split()
    n_words = len(words)
    seen, kept_lines, n_dup, kept_words = set(), [], 0, 0
    lost = dict.fromkeys(RULES, 0)
    for line in text.split("\n"):
        n = len(line.encode().split())
        if n:
            n_dup += line in seen
            seen.add(line)
            if rule := failed_rule(line, n):
                lost[rule] += n
                continue
            kept_words += n
        kept_lines.append(line)
    n_repeat = repeated_words(words)
    base_failed = n_words < 10 or 100 * n_repeat > 20 * n_words
    return {
        "n_words": n_words,
        "word_chars": len(text) - sum(map(text.count, SPACES)),
        "n_symbols": sum(map(text.count, SYMBOLS)),
        "n_dup_lines": n_dup,
        "n_repeat_words": n_repeat,
        "base_failed": base_failed,
        "kept": not base_failed and n_words - kept_words <= max_lost * n_words,
        "lost_words": n_words - kept_words,
        **{f"lost_{r}": n for r, n in lost.items()},
        "cleaned": "\n".join(kept_lines),
    }


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_words"] + [
    f"lost_{r}" for r in RULES
]


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """Verdict and counts per row of ``docs``: one narrow pass, no shuffle."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, " + ", ".join(
        f"{c} {'boolean' if c in ('base_failed', 'kept') else 'long'}" for c in COLUMNS
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, text_col):
            rows = [judge(t, max_lost) for t in part.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(id_col)]
                + [pa.array([r[c] for r in rows], pa.bool_() if c in ("base_failed", "kept") else pa.int64()) for c in COLUMNS],
                names=[id_col, *COLUMNS],
            )

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def cleaned_documents(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars", max_lost: float = MAX_LOST) -> DataFrame:
    """The documents that pass, without their failing lines; all columns and their order stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, text_col):
            texts = part.column(text_col).to_pylist()
            rows = [judge(t, max_lost) for t in texts]
            new = {text_col: [r["cleaned"] if r["kept"] else t for r, t in zip(rows, texts)]}
            if chars_col in part.schema.names:
                new[chars_col] = [len(t or "") for t in new[text_col]]
            yield replaced(part, **new).filter(pa.array([r["kept"] for r in rows], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))
