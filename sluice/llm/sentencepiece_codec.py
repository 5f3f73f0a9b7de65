"""SentencePiece encoding by suffix-array matching, and decoding.

The distinct chunks of a batch (a run of spaces with what follows, or a line feed) are joined to
one text, whose suffixes are sorted. Every piece of the vocabulary is binary-searched for its
range of suffixes; the ranges are the edges of the segmentation lattice. Edges are sorted by
position and relaxed from left to right.

The model is byte-pair encoding, whose result is no shortest path, so the relaxation keeps, for
each position, the last piece of the encoding of what stands before it. An edge may follow that
piece only if the pair stays apart when both are encoded as one text; exactly one edge into each
position can. This gives the ids of the SentencePiece library (tests compare both). Characters
without a piece become byte pieces.

Chunks are independent because no piece holds a space behind another character; for a model in
which one does, the whole text is one chunk. Decoding joins pieces and bytes and drops the
leading space. Encoding and decoding give the text back, but for U+2581, which stands for a space.

NULL and empty texts have no ids and decode to an empty text. Rows are encoded alone: equal rows
get equal ids, rows that repeat a doc_id are rows of their own, other columns are never read.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sluice.llm.common import table, text_slices

SPACE = "▁"
PUNCTUATION = string.punctuation
CHUNK = re.compile(r"\n|\x20*[^\x20\n]+|\x20+")
# Chunks whose ids a worker remembers, and bytes of chunks that one suffix array indexes.
CACHE_CHUNKS = 600_000
INDEX_BYTES = 160_000
# Neighbouring pieces whose fate a worker remembers, and text bytes that are encoded at once.
CACHE_PAIRS = 600_000
PIECE_BYTES = 2 << 20
# Bytes of a suffix that are sorted; of longer pieces the rest is compared.
DEPTH = 16


class Vocabulary:
    """Pieces as text with plain spaces, their scores, and how each is merged together."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.byte_ids = np.full(256, -1, np.int64)
        self.pieces: dict[str, int] = {}
        self.text = [""] * self.size
        self.out_bytes = [b""] * self.size
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.out_bytes[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i)):
                self.text[i] = piece.replace(SPACE, " ")
                self.pieces[self.text[i]] = i
                self.out_bytes[i] = self.text[i].encode()
        self.unknown_id = model.unk_id()
        self.score = {t: model.get_score(i) for t, i in self.pieces.items()}
        self.chunked = not any(" " in t.lstrip(" ") or "\n" in t for t in self.pieces)
        # Neighbours inside a piece; a text may be cut between any others.
        self.inner = {t[i : i + 2] for t in self.pieces for i in range(len(t) - 1)}
        self.alone: dict[int, bool] = {}
        self.dtype = "<u2" if self.size <= 1 << 16 else "<u4"
        # Search keys of all pieces, in the order of ``order``.
        self.order = np.array(sorted(self.pieces.values()))
        raw = [self.out_bytes[i] for i in self.order]
        self.lengths = np.array([len(r) for r in raw])
        self.lower, self.upper = (
            np.frombuffer(b"".join(r[:DEPTH].ljust(DEPTH, fill) for r in raw), ">u8").reshape(-1, 2).astype(np.uint64)
            for fill in (b"\0", b"\xff")
        )
        self.long = [(k, raw[k][DEPTH:]) for k in np.flatnonzero(self.lengths > DEPTH)]
        self.deep = np.flatnonzero(self.lengths > 8)
        self._merges: dict[int, tuple | None] = {}
        self._apart: dict[int, bool] = {}

    def merges(self, piece: int) -> tuple[list[tuple[float, str, str]], str, str] | None:
        """Merge steps of a piece by itself: (score, last symbol, first symbol after the step).

        None for a piece that its own text does not encode to.
        """
        if piece not in self._merges:
            symbols = list(self.text[piece])
            first, last, steps = symbols[0], symbols[-1], []
            while len(symbols) > 1:
                scores = [self.score.get(a + b) for a, b in zip(symbols, symbols[1:])]
                best = max((s for s in scores if s is not None), default=None)
                if best is None:
                    break
                at = scores.index(best)
                symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
                steps.append((best, symbols[-1], symbols[0]))
            self._merges[piece] = (steps, last, first) if len(symbols) == 1 else None
        return self._merges[piece]

    def stays(self, piece: int) -> bool:
        self.alone[piece] = found = self.merges(piece) is not None
        return found

    def apart(self, left: int, right: int) -> bool:
        """Do two neighbouring pieces stay apart? Their merges run side by side, best score first,
        the left one first among equals, until a merge across the border would be the best."""
        key = left * self.size + right
        known = self._apart.get(key)
        if known is None:
            if len(self._apart) > CACHE_PAIRS:
                self._apart.clear()
            known = self._apart[key] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        a, b = self.merges(left), self.merges(right)
        if a is None or b is None:
            return False
        (a_steps, last, _), (b_steps, _, first) = a, b
        i = j = 0
        while True:
            across = self.score.get(last + first)
            while True:
                x = a_steps[i][0] if i < len(a_steps) else None
                y = b_steps[j][0] if j < len(b_steps) else None
                if across is not None and (x is None or across > x) and (y is None or across >= y):
                    return False
                if x is None and y is None:
                    return True
                if y is None or (x is not None and x >= y):
                    changed, last = a_steps[i][1] != last, a_steps[i][1]
                    i += 1
                else:
                    changed, first = b_steps[j][2] != first, b_steps[j][2]
                    j += 1
                if changed:
                    break


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def lattice(v: Vocabulary, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges (start, end, piece) of a text, sorted by end; ``starts`` are its characters.

    ``data`` has DEPTH and more zero bytes behind the text and one between chunks.
    """
    window = np.lib.stride_tricks.sliding_window_view(data, DEPTH)[starts]
    keys = np.ascontiguousarray(window).view(">u8").astype(np.uint64)
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    suffix, head, tail = starts[order], keys[order, 0], keys[order, 1]
    low = np.searchsorted(head, v.lower[:, 0], "left")
    high = np.searchsorted(head, v.upper[:, 0], "right")
    for k in v.deep[low[v.deep] < high[v.deep]]:
        a, b = low[k], high[k]
        low[k] = a + np.searchsorted(tail[a:b], v.lower[k, 1], "left")
        high[k] = a + np.searchsorted(tail[a:b], v.upper[k, 1], "right")
    counts = np.maximum(high - low, 0)
    first = np.cumsum(counts) - counts
    at = np.arange(counts.sum()) - np.repeat(first, counts) + np.repeat(low, counts)
    begin, which = suffix[at], np.repeat(np.arange(len(counts)), counts)
    keep = np.ones(len(begin), bool)
    for k, rest in v.long:
        for e in range(first[k], first[k] + counts[k]):
            s = begin[e] + DEPTH
            keep[e] = data[s : s + len(rest)].tobytes() == rest
    begin, which = begin[keep], which[keep]
    end = begin + v.lengths[which]
    # Longest first among edges of one end: it is the likeliest one.
    by_end = np.lexsort((begin, end))
    return begin[by_end], end[by_end], v.order[which[by_end]]


def encode_chunks(v: Vocabulary, chunks: list[str]) -> list[bytes]:
    """Ids of each chunk, as bytes of ``v.dtype``."""
    raw = [c.encode() for c in chunks]
    data = np.frombuffer(b"\0".join(raw) + b"\0" * 64, np.uint8)
    sizes = np.array([len(r) for r in raw])
    chunk_start = np.cumsum(sizes + 1) - sizes - 1
    inside = np.ones(len(data), bool)
    inside[chunk_start + sizes] = False
    inside[chunk_start[-1] + sizes[-1] :] = False
    starts = np.flatnonzero(inside & ((data & 0xC0) != 0x80))
    begin, end, piece = lattice(v, data, starts)
    # Characters without a piece: edges with pseudo pieces behind the vocabulary, by length.
    lead = data[starts]
    char_end = starts + 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
    single = np.zeros(len(data) + 5, bool)
    width = np.zeros(len(data) + 5, np.int64)
    width[starts] = char_end - starts
    single[begin[end - begin == width[begin]]] = True
    bare = starts[~single[starts]]
    if len(bare):
        begin, end = np.append(begin, bare), np.append(end, bare + width[bare])
        piece = np.append(piece, v.size + width[bare])
        by_end = np.argsort(end, kind="stable")
        begin, end, piece = begin[by_end], end[by_end], piece[by_end]
    none, start_mark, size = -2, -1, v.size
    last = [none] * (len(data) + 1)
    for s in chunk_start.tolist():
        last[s] = start_mark
    apart, known, alone = v.apart, v._apart.get, v.alone.get
    for s, e, p in zip(begin.tolist(), end.tolist(), piece.tolist()):
        before = last[s]
        if before == none or last[e] != none:
            continue
        if p >= size:
            last[e] = p
        elif before < 0 or before >= size:
            ok = alone(p)
            if ok is None:
                ok = v.stays(p)
            if ok:
                last[e] = p
        else:
            ok = known(before * size + p)
            if ok is None:
                ok = apart(before, p)
            if ok:
                last[e] = p
    out, lengths = [], [len(b) for b in v.out_bytes]
    for s, n, r in zip(chunk_start.tolist(), sizes.tolist(), raw):
        ids, at = [], s + n
        while at > s:
            p = last[at]
            if p < size:
                ids.append(p)
                at -= lengths[p]
            else:
                at -= p - size
                some = v.byte_ids[list(r[at - s : at - s + p - size])].tolist()
                ids += some[::-1] if min(some) >= 0 else [v.unknown_id]
        out.append(np.array(ids[::-1], v.dtype).tobytes())
    return out


@lru_cache(maxsize=2)
def encoder_of(path: str) -> Encoder:
    """One encoder per worker process, so that later tasks find its chunks."""
    return Encoder(path)


class Encoder:
    def __init__(self, path: str):
        self.v = vocabulary(path)
        self.known: dict[str, bytes] = {}

    def learn(self, new: set[str]) -> None:
        """Encode chunks; punctuation behind a word is cut off where no piece holds both."""
        split = {}
        for chunk in new:
            head = chunk.rstrip(PUNCTUATION)
            if head and len(head) < len(chunk) and chunk[len(head) - 1 : len(head) + 1] not in self.v.inner:
                split[chunk] = head, chunk[len(head) :]
        parts = new.difference(split).union(*split.values()).difference(self.known)
        batch: list[str] = []
        held = 0
        for i, chunk in enumerate(parts, 1):
            batch.append(chunk)
            held += len(chunk)
            if held >= INDEX_BYTES or i == len(parts):
                self.known.update(zip(batch, encode_chunks(self.v, batch)))
                batch, held = [], 0
        self.known.update({c: self.known[h] + self.known[t] for c, (h, t) in split.items()})

    def encode(self, texts: list[str | None]) -> list[bytes]:
        cut = CHUNK.findall if self.v.chunked else lambda t: [t]
        # The first word counts as one behind a space.
        parts = [cut(" " + t.replace(SPACE, " ")) if t else [] for t in texts]
        here = set().union(*parts)
        if len(self.known) > CACHE_CHUNKS:
            # Frequent chunks are in this piece as well.
            self.known = {c: self.known[c] for c in here.intersection(self.known)}
        self.learn(here.difference(self.known))
        get = self.known.__getitem__
        return [b"".join(map(get, p)) for p in parts]

    def decode(self, ids: bytes) -> str:
        raw = b"".join(map(self.v.out_bytes.__getitem__, np.frombuffer(ids, self.v.dtype).tolist()))
        return raw.decode("utf-8", "replace")[1:]


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, n_tokens, ids, round_trip, columns to keep) of every row: one narrow pass, no shuffle.

    ``round_trip`` tells whether the decoded ids are the text (U+2581 taken as a space).
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(model_path)
        for part in text_slices(batches, text_col, PIECE_BYTES):
            texts = part.column(text_col).to_pylist()
            encoded = encoder.encode(texts)
            same = [encoder.decode(e) == (t or "").replace(SPACE, " ") for e, t in zip(encoded, texts)]
            counts = np.array([len(e) for e in encoded], np.int64) // np.dtype(encoder.v.dtype).itemsize
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            values = np.frombuffer(b"".join(encoded), encoder.v.dtype).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column(id_col), pa.array(counts), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)), pa.array(same, pa.bool_()), *map(part.column, keep)],
                names=[id_col, "n_tokens", "ids", "round_trip", *keep],
            )

    kept = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(id_col, text_col, *keep).mapInArrow(run, f"`{id_col}` {id_type}, n_tokens long, ids array<int>, round_trip boolean{kept}")


def decode_documents(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of every row of ids; NULL ids give an empty text."""
    id_type = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(model_path)
        for batch in batches:
            texts = [encoder.decode(np.array(i or [], encoder.v.dtype).tobytes()) for i in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(texts, pa.string())], names=[id_col, "text"])

    return encoded.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {id_type}, text string")


def piece_model() -> str:
    """The public 32k piece model; pass another path where an operator takes one."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), piece_model())
