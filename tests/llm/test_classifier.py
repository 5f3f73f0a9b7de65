"""Held-out accuracy, and texts and labels at the edges."""

import zlib

from sluice.llm import quality_classifier as qc

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in qc.op5_quality_classifier(spark, SF).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 for i, r in got.items())
    test = [(got[i].predicted, y) for i, y in labels.items() if got[i].held_out]
    assert sum(p == y for p, y in test) / len(test) > 0.95
    assert sum(p == 0 for p, y in test if y == 0) / sum(y == 0 for _, y in test) > 0.9


def test_edges(spark, documents):
    docs = documents([(1, None, "a"), (2, "", "a"), (3, "A plain sentence.", None), (3, "A plain sentence.", None), (None, "x " * 50_000, "b")])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in qc.classify(docs, qc.fit(docs, none)).collect()] == [0.5] * 5
    one_sided = spark.createDataFrame([(i, 1, 0) for i in (1, 2, 3)] + [(None, 0, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    rows = qc.classify(docs, qc.fit(docs, one_sided)).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows) and rows[2] == rows[3]
    assert qc.classify(docs.limit(0), qc.fit(docs, one_sided)).collect() == []


def test_sample_is_bounded(spark, documents):
    docs = documents([f"text number {i} with some words." for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    assert len(qc.fit(docs, labels, max_sample=10).labels) == 10
