"""Quality classifier: similarity-weighted votes of the nearest labelled documents.

Fit, on at most ``MAX_SAMPLE`` labelled documents (the bound is a parameter, the rows with the
smallest hashes): each text becomes a term vector (hashed byte trigrams, and shape terms such as
the share of symbols, capitals or repeated words), and a truncated SVD of the centred sample
gives a latent space of ``RANK`` dimensions. Apply, to every document: the latent vectors of the
sample are broadcast (their size is fixed by the two bounds), exact cosine products are taken in
blocks of documents, and the ``NEIGHBOURS`` most similar labels vote with weight cosine ** 4.

Labels are learned only where crc32(doc_id as text) mod 3 is not 1; the others are held out. A
NULL doc_id hashes as an empty text. NULL and empty texts have only shape terms and get a score
like any other. Without labels of a kind, votes are one-sided; without any labels, every score
is 0.5. Rows that repeat a doc_id are scored one by one; in the fit the first of them counts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import table, text_slices

MAX_SAMPLE = 2_000
RANK = 48
NEIGHBOURS = 25
TRIGRAM_BINS = 2_048
SHAPE_STEPS = 8
SHAPES = 8
TERMS = TRIGRAM_BINS + SHAPES * (SHAPE_STEPS + 1)
SHAPE_WEIGHT = 0.6
POWER = 4
BLOCK_DOCS = 256
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>@^~=+_{}[]\\"]] = True


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def shapes(data: np.ndarray, words: list[bytes], lines: list[bytes]) -> np.ndarray:
    """Shares in [0, 1] that describe a text's form."""
    n, n_words = max(len(data), 1), max(len(words), 1)
    counts = np.bincount(data, minlength=256)
    upper, lower = counts[65:91].sum(), counts[97:123].sum() + counts[128:].sum() / 2
    repeats = sum(map(bytes.__eq__, words, words[1:])) if len(words) > 1 else 0
    return np.array([
        min(1.0, counts[SYMBOLS].sum() / n_words),
        upper / max(upper + lower, 1),
        min(1.0, counts[ord("!")] / n_words),
        1 - len(set(words)) / n_words,
        repeats / n_words,
        1 - len(set(lines)) / max(len(lines), 1),
        counts[48:58].sum() / n,
        min(1.0, np.log1p(len(words)) / 10),
    ])


def terms(text: str | None) -> np.ndarray:
    """Term vector of a text: trigrams of unit length beside weighted shape terms."""
    raw = (text or "").encode()
    data = np.frombuffer(raw, np.uint8)
    out = np.zeros(TERMS, np.float32)
    if len(data) >= 3:
        wide = data.astype(np.uint32)
        key = (wide[:-2] * np.uint32(0x9E3779B1) + wide[1:-1] * np.uint32(0x85EBCA6B) + wide[2:] * np.uint32(0xC2B2AE35)) >> 21
        grams = np.log1p(np.bincount(key, minlength=TRIGRAM_BINS)).astype(np.float32)
        out[:TRIGRAM_BINS] = grams / np.linalg.norm(grams)
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    # Each share is spread over its two nearest steps, finer near zero.
    at = np.sqrt(shapes(data, words, lines)) * SHAPE_STEPS
    low = np.minimum(at.astype(int), SHAPE_STEPS - 1)
    base = TRIGRAM_BINS + np.arange(SHAPES) * (SHAPE_STEPS + 1) + low
    out[base] += SHAPE_WEIGHT * (1 - (at - low))
    out[base + 1] += SHAPE_WEIGHT * (at - low)
    return out


class NeighbourVote:
    """Latent space and labelled vectors; size bounded by MAX_SAMPLE, RANK and TERMS."""

    def __init__(self, vectors: np.ndarray, labels: np.ndarray, rank: int = RANK, neighbours: int = NEIGHBOURS):
        self.neighbours, self.labels = neighbours, labels.astype(np.float32)
        if not len(labels):
            return
        self.mean = vectors.mean(axis=0)
        centred = vectors - self.mean
        # Randomised range finder with power steps; the seed makes reruns agree.
        probe = np.random.default_rng(0).standard_normal((vectors.shape[1], min(rank + 16, *vectors.shape))).astype(np.float32)
        for _ in range(3):
            basis = np.linalg.qr(centred @ probe)[0]
            probe = np.linalg.qr(centred.T @ basis)[0]
        axes = probe @ np.linalg.svd(centred @ probe, full_matrices=False)[2].T
        self.axes = axes[:, :rank].astype(np.float32)
        self.latent = self.project(vectors)

    def project(self, vectors: np.ndarray) -> np.ndarray:
        latent = (vectors - self.mean) @ self.axes
        return latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(vectors), 0.5)
        cosine = self.project(vectors) @ self.latent.T
        k = min(self.neighbours, len(self.labels))
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 1e-6).astype(np.float64) ** POWER
        return (weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_sample: int = MAX_SAMPLE) -> NeighbourVote:
    """Learn from labels that are not held out; at most ``max_sample`` documents reach the driver."""
    sample = (
        labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~is_held_out(F.col(id_col)))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.min(label_col).cast("int").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(max_sample)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "_text"):
            rows = [terms(t).tobytes() for t in part.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("_label"), pa.array(rows, pa.binary())], names=["label", "terms"])

    # The sample has at most max_sample rows of two numbers, so it may be broadcast.
    found = (
        docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
        .join(F.broadcast(sample), "_id")
        .groupBy("_id").agg(F.min(F.struct(F.coalesce("_text", F.lit("")).alias("t"), F.col("_label").alias("y"))).alias("row"))
        .select(F.col("row.t").alias("_text"), F.col("row.y").alias("_label"))
        .mapInArrow(run, "label int, terms binary")
        .toArrow()
    )
    vectors = np.frombuffer(b"".join(found.column("terms").to_pylist()), np.float32).reshape(-1, TERMS)
    label = found.column("label").to_numpy()
    # Task order must not change sums: rows are put in order of their content.
    order = np.array(sorted(range(len(label)), key=lambda i: (zlib.crc32(vectors[i].tobytes()), label[i])), dtype=int)
    return NeighbourVote(vectors[order], label[order])


def classify(docs: DataFrame, model: NeighbourVote, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row: one narrow pass against the broadcast sample."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, text_col):
            texts, scores = part.column(text_col).to_pylist(), []
            for i in range(0, len(texts), BLOCK_DOCS):
                scores.append(shared.value.scores(np.stack([terms(t) for t in texts[i : i + BLOCK_DOCS]])))
            yield pa.RecordBatch.from_arrays(
                [part.column(id_col), pa.array(np.concatenate(scores) if scores else [], pa.float64())], names=[id_col, "score"]
            )

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, score double")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = classify(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
