"""Token ids as length-delimited binary records with masked checksums and an offset index.

File format, little-endian, one frame per document in ascending doc_id order:

    u64 length | u32 masked crc32(length bytes) | payload | u32 masked crc32(payload) | 0x0A

    payload: u8 flags (1: doc_id is NULL) | u8 bytes per id (2 or 4) | i64 doc_id | ids

Spark's text sink writes the frames, its line end being the last byte, so files are committed
like any other Spark output and lie on any file system that Spark can reach. The index (doc_id,
part, offset, length, number of ids) is a table of its own for shuffled reads.

NULL and empty texts hold the end id alone. NULL doc_ids come first. Rows that repeat a doc_id
are records of their own, ordered by a hash of their text. Other columns are never read. An empty table
gives no records.
"""

from __future__ import annotations

import string
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.common import WorkFolder, table, text_slices

END_ID = 0
# Text bytes per file; a file is read whole by one task.
FILE_BYTES = 12 << 20
# Chunks in each of the two generations that a worker remembers.
CACHE_CHUNKS = 400_000
# Text bytes that are encoded at once.
PIECE_BYTES = 1 << 20
PUNCTUATION = string.punctuation
# Byte-level vocabularies spell bytes as letters: printable ones as themselves, the others by
# their order behind 255.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
SPACE_LETTER = chr(BYTE_LETTERS[32])
HEAD = struct.Struct("<QI")
TAIL = struct.Struct("<I")
FIXED = struct.Struct("<BBq")
# White space other than space and line feed, runs and ends of either, and the text of special
# tokens: such texts are encoded whole.
UNEVEN = (
    "  ", "\n\n", " \n", "\n ", "<|", *"\t\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000",
    *map(chr, range(0x2000, 0x200B)),
)


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes, width: int) -> bytes:
    """All bytes of a record but its last, which the sink's line end supplies."""
    payload = FIXED.pack(doc_id is None, width, doc_id or 0) + ids
    length = struct.pack("<Q", len(payload))
    return b"".join((length, TAIL.pack(masked_crc(length)), payload, TAIL.pack(masked_crc(payload))))


def read_frames(data: bytes) -> Iterator[tuple[int, int, int | None, np.ndarray]]:
    """(offset, length, doc_id, ids) of every record; a damaged one raises."""
    at = 0
    while at < len(data):
        n, crc = HEAD.unpack_from(data, at)
        if crc != masked_crc(data[at : at + 8]) or at + n + 17 > len(data):
            raise ValueError(f"damaged length at byte {at}")
        payload = data[at + 12 : at + 12 + n]
        if TAIL.unpack_from(data, at + 12 + n)[0] != masked_crc(payload) or data[at + n + 16] != 10:
            raise ValueError(f"damaged record at byte {at}")
        null, width, doc_id = FIXED.unpack_from(payload)
        ids = np.frombuffer(payload, "<u2" if width == 2 else "<u4", offset=FIXED.size).astype("<u4")
        yield at, n + 17, None if null else doc_id, ids
        at += n + 17


class ChunkIds(dict):
    """Ids (as bytes) of chunks by their text; an unknown chunk is encoded when it is asked for.

    A chunk stands behind a space, which is left off, or begins with a line feed. A chunk with a
    space in front is one that has nothing before it in its text. ``older`` is the generation
    before; its chunks come back when they are asked for, and the others are forgotten with it.
    """

    def __init__(self, tokenizer, id_bytes: list[bytes], older: dict):
        super().__init__()
        self.tokenizer, self.tokenize, self.id_bytes, self.older = tokenizer, tokenizer.model.tokenize, id_bytes, older

    def __missing__(self, chunk: str) -> bytes:
        ids = self[chunk] = self.older.pop(chunk, None) or self.encode(chunk)
        return ids

    def encode(self, chunk: str) -> bytes:
        head = chunk.rstrip(PUNCTUATION)
        if len(head) < len(chunk) and head.isalpha():
            # The splitting rule parts letters from the punctuation behind them.
            return self[head] + self[" " + chunk[len(head) :]]
        if chunk.isalpha():
            # One unit of the splitting rule: straight to the merges.
            word = chunk if chunk.isascii() else chunk.encode().decode("latin-1").translate(BYTE_LETTERS)
            ids = [t.id for t in self.tokenize(SPACE_LETTER + word)]
        else:
            text = chunk[1:] if chunk[:1] == " " else chunk if chunk[:1] == "\n" else " " + chunk
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return b"".join([self.id_bytes[i] for i in ids])


class CachedEncoder:
    """Ids as bytes by the tokenizers library, each space-separated chunk encoded once.

    Byte-level BPE never joins across a single space or line feed that follows other text, so
    ids of chunks (the space belongs to the chunk behind it) are the ids of the text. Texts in
    which that could fail are encoded whole, as are all texts of other kinds of tokenizers.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.width = 2 if size <= 1 << 16 else 4
        self.dtype = "<u2" if self.width == 2 else "<u4"
        self.by_chunk = isinstance(self.tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel) and self.tokenizer.normalizer is None
        self.id_bytes = [i.to_bytes(self.width, "little") for i in range(size)] if self.by_chunk else []
        self.known = ChunkIds(self.tokenizer, self.id_bytes, {})

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def uneven(self, text: str) -> bool:
        return text[-1:] in (" ", "\n") or any(x in text for x in UNEVEN)

    def encode(self, texts: list[str]) -> list[bytes]:
        out, get = [], self.known.__getitem__
        for text in texts:
            if not self.by_chunk or self.uneven(text):
                out.append(self.whole(text))
                continue
            chunks = text.replace("\n", " \n").split(" ")
            chunks[0] = " " + chunks[0]
            out.append(b"".join(map(get, chunks)))
        if len(self.known) > CACHE_CHUNKS:
            self.known.older = {}
            self.known = ChunkIds(self.tokenizer, self.id_bytes, self.known)
        return out


@lru_cache(maxsize=1)
def encoder_of(path: str) -> CachedEncoder:
    """One encoder per worker process, so that later tasks find its chunks."""
    return CachedEncoder(path)


def write_records(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> None:
    """Encode and write all documents in ascending order of their ids.

    Text, the smaller of both, is range-sorted first and encoded behind the shuffle. The last
    range keys spread the rows of an id that many rows share.
    """
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    keys = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ranges = rows.repartitionByRange(max(1, -(-total // file_bytes)), *keys, F.monotonically_increasing_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer_path)
        end = end_id.to_bytes(encoder.width, "little")
        for part in text_slices(batches, most=PIECE_BYTES):
            encoded = encoder.encode(part.column("text").to_pylist())
            frames = [frame(d, ids + end, encoder.width) for d, ids in zip(part.column("id").to_pylist(), encoded)]
            yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], names=["value"])

    ranges.sortWithinPartitions(*keys).mapInArrow(run, "value binary").select(F.col("value").cast("string")).write.option(
        "lineSep", "\n"
    ).text(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the files, from their bytes: place, number and checksum of ids.

    ``local_start`` counts ids from the start of the file.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part, data, rows, at = batch.column("part")[i].as_py(), batch.column("content")[i].as_py(), [], 0
                for offset, length, doc_id, ids in read_frames(data):
                    rows.append((doc_id, part, offset, length, at, len(ids), zlib.crc32(ids.tobytes())))
                    at += len(ids)
                columns = list(zip(*rows)) or [[]] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=INDEX)

    part = F.regexp_extract(F.element_at(F.split("path", "/"), -1), r"^part-(\d+)", 1).cast("long")
    return files.select(part.alias("part"), "content").mapInArrow(run, ", ".join(f"{c} long" for c in INDEX))


INDEX = ["doc_id", "part", "offset", "length", "local_start", "n_tokens", "ids_crc32"]


def with_starts(index: DataFrame) -> DataFrame:
    """Add ``start``: ids of all records before. Only one row per file meets in one task."""
    totals = index.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = totals.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    return index.join(first, "part").withColumn("start", F.col("_first") + F.col("local_start")).drop("_first")


def op10_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = WorkFolder(spark, "token_records")
    write_records(table(spark, sf_dir, "documents"), f"{folder.path}/records", public_tokenizers.path("byte_bpe_50k.json"))
    index = folder.write(read_index(spark, f"{folder.path}/records"), "index")
    return with_starts(index).select("doc_id", "start", "n_tokens", "ids_crc32", "part", "offset", "length")
