"""The pipeline against a plain version of its stages, and on odd input."""

import sys

import sentencepiece

import corpus_pipeline
from sluice.llm import mixing, quality_rules, secret_scan, sentencepiece_codec

sys.path.insert(0, __file__.rpartition("/")[0])
from test_dedup import plain_classes  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_equal_plain_versions(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = [f for _, f in corpus_pipeline.STAGES]
    columns = docs.columns
    frames = [docs]
    for i, stage in enumerate(stages):
        stage(spark, frames[-1], SF).write.parquet(f"{tmp_path}/{i}")
        frames.append(spark.read.parquet(f"{tmp_path}/{i}"))
    assert all(f.columns == columns for f in frames[:-1])
    rows = [{r.doc_id: r for r in f.collect()} for f in frames]
    # Quality.
    want = {i: quality_rules.judge(r.text) for i, r in rows[0].items()}
    assert {i: (r.text, r.n_chars) for i, r in rows[1].items()} == {i: (w["cleaned"], len(w["cleaned"])) for i, w in want.items() if w["kept"]}
    # One of each class.
    classes = plain_classes([(i, r.text) for i, r in rows[1].items()])
    assert rows[2] == {i: r for i, r in rows[1].items() if classes[i] == i}
    # Secrets.
    assert {i: r.text for i, r in rows[3].items()} == {i: secret_scan.redact(r.text) for i, r in rows[2].items()}
    assert not any(secret_scan.scan(r.text)[0] for r in rows[3].values())
    # Mix and ids.
    copies = {r.doc_id: r.copies for r in mixing.mixed(frames[3]).collect() if r.copies}
    mixed = frames[4].groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in mixed} == copies
    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.piece_model())
    assert frames[5].count() == frames[4].count()
    # Rows of the last stage, by their place, are those of the mix in training order.
    order = [r.doc_id for r in mixing.training_order(frames[3]).collect()]
    assert [r.doc_id for r in frames[5].orderBy("training_part", "training_row").collect()] == order
    assert all(r.ids == sp.encode(rows[4][i].text) for i, r in rows[5].items())


def test_odd_documents(spark, documents):
    good = "A river ran past the mill, and people came to see it every day of the long year."
    docs = documents([(1, good, "a"), (1, good, "a"), (2, good, None), (None, good + " More words follow here.", "a"), (3, None, "a"), (4, "", "b")]).withColumnRenamed("lang", "kept")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    rows = docs.collect()
    assert {r.doc_id for r in rows} <= {1, None} and all(r.round_trip for r in rows)


def test_empty_table(spark, documents):
    docs = documents([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.collect() == []
