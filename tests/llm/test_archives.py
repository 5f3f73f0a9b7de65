"""WARC archive, token records and SentencePiece ids: exact round trips."""

import base64
import glob
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sluice.llm import sentencepiece_codec, token_records, warc
from sluice.llm.common import WorkFolder

BPE = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "\n", "a", "  two  spaces ", "tab\there", "a\n\nb", "line\nnext", "it's we'll 'tis", "é", "naïve façade.", "日本語 テキスト",
    "x<|endoftext|>y", "a▁b", "\x00nul\x00", "1a a1 12 ½", "wow!!! ok??", "a\r\nb", "nb\xa0sp", "İ ǅ ʰ", "word " * 3000, "z" * 3000, " " * 70 + "x",
]


# -- WARC -------------------------------------------------------------------------------

def plain_records(pages, min_bytes=0):
    first = {}
    for i, html in pages:
        key = html or ""
        if i is not None:
            first[key] = min(first.get(key, i), i)
    out = []
    for i, html in pages:
        raw = (html or "").encode()
        f = first.get(html or "")
        revisit = f is not None and i != f and len(raw) >= min_bytes
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", f if revisit else None))
    return sorted(out, key=str)


PAGES = [(5, "<a>"), (3, "<a>"), (9, "<b>é"), (4, None), (2, ""), (7, "<a>\r\n\r\nx"), (8, "<a>"), (None, "<a>"), (None, "lone"), (3, "<a>"), (11, "<b>é"), (12, "y" * 200_000)]


@pytest.mark.parametrize("min_bytes", [0, 4])
def test_archive_round_trip(spark, min_bytes):
    df = spark.createDataFrame([(i, f"http://h/{i}\r\nX: y", h, 1, "c") for i, h in PAGES], "page_id long, url string, html string, sha256 int, record_type string")
    headers, payloads = warc.write_archive(df, WorkFolder(spark, "t"), min_bytes)
    assert sorted(map(tuple, warc.read_index(headers, payloads).collect()), key=str) == plain_records(PAGES, min_bytes)
    assert payloads.count() == len({h or "" for _, h in PAGES})
    records = warc.read_records(headers, payloads).collect()
    assert sorted(bytes(r.content) for r in records) == sorted((h or "").encode() for _, h in PAGES)
    for r in records:
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        length = int(head.rpartition(b"Content-Length: ")[2])
        assert rest == bytes(r.content)[:length] + b"\r\n\r\n" and head.startswith(b"WARC/1.1\r\nWARC-Type: ") and b"\r\nX:" not in head


def test_damaged_payload_is_noticed(spark):
    df = spark.createDataFrame([(1, "u", "abc")], "page_id long, url string, html string")
    headers, payloads = warc.write_archive(df, WorkFolder(spark, "t"))
    bad = payloads.selectExpr("sha256", "cast('abd' AS binary) AS payload")
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_index(headers, bad).collect()


def test_warc_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "abc"), (2, "v", "abc"), (3, "w", "é\r\n\r\nx")], "page_id long, url string, html string")
    headers, payloads = warc.write_archive(df, WorkFolder(spark, "t"))
    warc.export_warc(headers.coalesce(1), payloads, str(tmp_path / "out"))
    data, n = b"".join(open(f, "rb").read() for f in glob.glob(f"{tmp_path}/out/part-*")), 0
    while data:
        head, _, data = data.partition(b"\r\n\r\n")
        length = int(head.rpartition(b"Content-Length: ")[2])
        assert head.startswith(b"WARC/1.1") and data[length : length + 4] == b"\r\n\r\n"
        data, n = data[length + 4 :], n + 1
    assert n == 3


def test_no_pages(spark):
    headers, payloads = warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"), WorkFolder(spark, "t"))
    assert warc.read_index(headers, payloads).collect() == []


# -- token records ----------------------------------------------------------------------

def test_token_records_equal_the_library(spark, documents):
    rows = [(i * 7 % 101, t, "s") for i, t in enumerate(ODD)] + [(None, "no id", "s"), (50, "twice", "s"), (50, "twice", "s")]
    folder = WorkFolder(spark, "t")
    token_records.write_records(documents(rows).repartition(4), f"{folder.path}/r", BPE, file_bytes=2000)
    got = token_records.with_starts(token_records.read_index(spark, f"{folder.path}/r")).orderBy("start").collect()
    tokenizer, start = Tokenizer.from_file(BPE), 0
    ids = {}
    for i, t, _ in rows:
        ids.setdefault(i, []).append(np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4"))
    order = [r.doc_id for r in got]
    assert order == sorted((i for i, *_ in rows), key=lambda i: (i is not None, i))
    for r in got:
        assert r.start == start
        assert (r.n_tokens, r.ids_crc32) in [(len(x), zlib.crc32(x.tobytes())) for x in ids[r.doc_id]]
        start += r.n_tokens


def test_records_can_be_read_by_offset_and_damage_is_noticed(spark, documents):
    folder = WorkFolder(spark, "t")
    token_records.write_records(documents(["one two", "three"]).coalesce(1), f"{folder.path}/r", BPE)
    index = token_records.read_index(spark, f"{folder.path}/r").orderBy("doc_id").collect()
    file = glob.glob(f"{folder.path.removeprefix('file:')}/r/part-*")[0]
    data = open(file, "rb").read()
    second = data[index[1].offset : index[1].offset + index[1].length]
    assert next(token_records.read_frames(second))[2] == 1
    broken = bytearray(data)
    broken[-4] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        list(token_records.read_frames(bytes(broken)))


def test_no_records(spark, documents):
    folder = WorkFolder(spark, "t")
    token_records.write_records(documents([]), f"{folder.path}/r", BPE)
    assert token_records.with_starts(token_records.read_index(spark, f"{folder.path}/r")).collect() == []


# -- SentencePiece ----------------------------------------------------------------------

def library():
    return sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.piece_model())


def test_ids_equal_the_library(spark, documents):
    random.seed(2)
    letters = "ab e\n t▁h  \t\0é中𐍈the ing tion_-<s>123      ́ﬁ"
    texts = [*ODD, *("".join(random.choice(letters) for _ in range(random.randint(0, 50))) for _ in range(500)), *(" " * n + "x" for n in range(40))]
    encoded = sentencepiece_codec.encode_documents(documents(texts), sentencepiece_codec.piece_model())
    rows = encoded.collect()
    assert [r.ids for r in rows] == library().encode([t or "" for t in texts])
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)
    decoded = sentencepiece_codec.decode_documents(encoded, sentencepiece_codec.piece_model()).collect()
    assert [r.text for r in decoded] == [(t or "").replace("▁", " ") for t in texts]
    assert sentencepiece_codec.encode_documents(documents([]), sentencepiece_codec.piece_model()).collect() == []


def test_ids_of_the_corpus_equal_the_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    sp = library()
    for r in sentencepiece_codec.op8_sentencepiece(spark, "/root/testdata/sf0.001").collect():
        assert r.ids == sp.encode(texts[r.doc_id]) and r.round_trip
