"""Exact top-k inner product search on a bit-sliced index.

Rows are dealt into blocks of at most about ``BLOCK_ROWS``. A block keeps its distinct quantised
vectors as bit slices: one bitmap over the rows per dimension and bit. For a query, every signed
digit of a component adds that dimension's slices, shifted (complemented for a negative digit),
and a tree of bitmap full adders sums all of them into the slices of the scores. Slices below
``LOW_BITS`` are left out at first, which bounds the error; the k-th score is found from the most
significant slice downward, and all rows within the error of it are then scored exactly.

Equal vectors score alike, so a block holds each once, with its k + 1 smallest ids: a larger id
of an equal vector can never be among the k best (ties go to the smaller id, and one may be the
query itself). Of rows that are equal in id and vector, k are kept. No row is left out otherwise.

A block with a share of the queries is one unit of work. Its rows come first, batch by batch, and become the index; then the
queries stream past it in groups, and the k best of each are all that is passed on. So a worker holds one block as
whole numbers of four bytes, its index and one group; queries, of which a block may meet any number, are never gathered. Blocks are
copied only as often as it takes to give every core work, queries once for each block.

Vectors that are NULL or hold NULL or non-finite components (256-fold included) take no part. Scores
are exact: where a pair of block and group could leave 64 bits, it is computed in Python's integers. A score among the k best
that does not fit a long is an error. Of vectors with
different lengths the shorter one counts as padded with zeros. A NULL id takes no part. Rows that
repeat an id are rows of their own; the query's own are not its candidates. Queries that share an
id are one query that scores with each of its vectors. An empty table gives no rows. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.common import table
from sluice.llm.vectors import as_long, largest, matrix

BLOCK_ROWS = 65_536
# Components of a block: wide vectors make blocks of fewer rows.
BLOCK_CELLS = 1 << 22
GROUP_QUERIES = 256
LOW_BITS = 5
SCALE = 256


def quantised(vector: Column) -> Column:
    """floor(256 * x) of every component as a double; NULL for a vector that takes no part."""
    v = F.transform(vector, lambda x: x.cast("double") * SCALE)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # Doubles from 2**53 on are whole numbers; floor() would cut them to a long.
    return F.when(fine, F.transform(v, lambda x: F.when(F.abs(x) < float(1 << 53), F.floor(x).cast("double")).otherwise(x)))


def digits(n: int) -> list[tuple[int, int]]:
    """Non-adjacent form: (exponent, sign) with n = sum of sign * 2**exponent."""
    out, at = [], 0
    while n:
        if n & 1:
            sign = 2 - (n & 3)
            out.append((at, sign))
            n -= sign
        n >>= 1
        at += 1
    return out


class SlicedBlock:
    """Bit slices of distinct vectors; row r is bit r of every bitmap."""

    def __init__(self, vectors: np.ndarray):
        self.rows, self.dims = vectors.shape
        whole = object if vectors.dtype == object else np.int64
        self.low = (vectors.min(axis=0) if self.rows else np.zeros(self.dims)).astype(whole)
        self.bits, self.slices = [], []
        words = -(-self.rows // 64)
        for d in range(self.dims):
            offset = vectors[:, d].astype(whole) - self.low[d]
            self.bits.append(int(offset.max(initial=0)).bit_length())
            planes = []
            for b in range(self.bits[d]):
                packed = np.zeros(words * 8, np.uint8)
                bits = np.packbits((offset >> b) & 1 == 1, bitorder="little")
                packed[: len(bits)] = bits
                planes.append(packed.view(np.uint64))
            self.slices.append(planes)
        self.all = np.zeros(words * 8, np.uint8)
        full = np.packbits(np.ones(self.rows, bool), bitorder="little")
        self.all[: len(full)] = full
        self.all = self.all.view(np.uint64)

    def sum_slices(self, query: np.ndarray) -> tuple[list[np.ndarray], int, int]:
        """Slices of the score without its low columns, the constant to add, the largest error.

        score = constant + sum + error, with 0 <= error <= the bound returned.
        """
        columns: dict[int, list[np.ndarray]] = {}
        constant, bound = int(np.dot(query.astype(object), self.low.astype(object))) if self.dims else 0, 0
        for d in np.flatnonzero(query):
            planes, n_bits = self.slices[d], self.bits[d]
            if not n_bits:
                continue
            flipped = None
            for exponent, sign in digits(int(query[d])):
                if sign < 0:
                    # -2^e * v = 2^e * (all ones - v) - 2^e * all ones
                    constant -= ((1 << n_bits) - 1) << exponent
                    flipped = flipped or [~p for p in planes]
                for b, plane in enumerate(planes if sign > 0 else flipped):
                    if exponent + b < LOW_BITS:
                        bound += 1 << (exponent + b)
                    else:
                        columns.setdefault(exponent + b, []).append(plane)
        out, at = [], LOW_BITS
        while columns:
            stack = columns.pop(at, [])
            while len(stack) > 2:
                # Full adder: three bitmaps of a column become one, and a carry.
                a, b, c = stack.pop(), stack.pop(), stack.pop()
                half = a ^ b
                stack.insert(0, half ^ c)
                columns.setdefault(at + 1, []).append((a & b) | (half & c))
            if len(stack) == 2:
                columns.setdefault(at + 1, []).append(stack[0] & stack[1])
                stack = [stack[0] ^ stack[1]]
            out.append(stack[0] if stack else np.zeros_like(self.all))
            at += 1
        return out, constant, bound

    def candidates(self, query: np.ndarray, k: int) -> np.ndarray:
        """Rows among which the k best are, whatever the left out columns hold."""
        sums, _, bound = self.sum_slices(query)
        equal, above, n_above, threshold = self.all, np.zeros_like(self.all), 0, 0
        need = min(k, self.rows)
        for at in range(len(sums) - 1, -1, -1):
            ones = equal & sums[at]
            n = n_above + int(np.bitwise_count(ones).sum())
            threshold <<= 1
            if n >= need:
                equal = ones
                threshold |= 1
            else:
                above, n_above = above | ones, n
                equal = equal & ~sums[at]
        # Sums at or above the k-th one less the error.
        least = max(threshold - -(-bound >> LOW_BITS) - 1, 0)
        more, same = np.zeros_like(self.all), self.all
        for at in range(len(sums) - 1, -1, -1):
            if least >> at & 1:
                same = same & sums[at]
            else:
                more = more | (same & sums[at])
                same = same & ~sums[at]
        return np.flatnonzero(np.unpackbits((more | same).view(np.uint8), bitorder="little"))


def _equal(vectors: np.ndarray) -> np.ndarray:
    """A number per row that equal rows share."""
    rows = np.ascontiguousarray(vectors)
    return np.unique(rows.view(np.dtype((np.void, rows.itemsize * rows.shape[1]))).ravel(), return_inverse=True)[1].ravel()


def _rank(*keys: np.ndarray) -> np.ndarray:
    """Place of each row among those before it that are equal in all keys, which are sorted."""
    new = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    starts = np.flatnonzero(np.r_[True, new])
    return np.arange(len(keys[0])) - np.repeat(starts, np.diff(np.r_[starts, len(keys[0])]))


class Block:
    """The rows of a block, taken in piece by piece; the first query makes the index of them."""

    def __init__(self, k: int, rows: int = BLOCK_ROWS):
        self.k, self.limit, self.held = k, 2 * rows, 0
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.index: SlicedBlock | None = None

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Rows of whole numbers held as doubles."""
        small = largest(vectors) < 1 << 30
        # A copy, as the memory of a batch would stay while a part of it is held.
        self.parts.append((np.array(ids, np.int64), vectors.astype(np.int32 if small else np.float64)))
        self.held += len(ids)
        if self.held > self.limit:
            self._gather()
            self.limit = max(self.limit, 2 * self.held)

    def _gather(self) -> np.ndarray:
        """The parts as one, sorted by vector and id, with k rows of an equal id and vector; the number of each row's vector."""
        dims = max(v.shape[1] for _, v in self.parts)
        kind = np.result_type(*[v.dtype for _, v in self.parts])
        ids, vectors, at = np.empty(self.held, np.int64), np.zeros((self.held, dims), kind), 0
        while self.parts:
            i, v = self.parts.pop(0)
            ids[at : at + len(i)], vectors[at : at + len(i), : v.shape[1]] = i, v
            at += len(i)
        group = _equal(vectors)
        order = np.lexsort((ids, group))
        order = order[_rank(group[order], ids[order]) < self.k]
        self.parts, self.held = [(ids[order], vectors[order])], len(order)
        return group[order]

    def _make_index(self) -> None:
        group = self._gather()
        (ids, vectors), self.parts = self.parts[0], []
        pairs = _rank(group, ids) == 0
        # Vectors that may hold nothing but rows of the query's own id, and thus drop out.
        own = int(np.unique(ids[pairs], return_counts=True)[1].max())
        # Of the smallest ids of a vector, k may be the query's own.
        few = _rank(group) < 2 * self.k
        group, self.ids = group[few], ids[few]
        self.starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        self.stops = np.r_[self.starts[1:], len(group)]
        vectors = vectors[np.flatnonzero(few)[self.starts]]
        self.largest, self.need = largest(vectors), self.k + own
        if vectors.dtype != np.int32:
            vectors = vectors.astype(np.int64) if self.largest < 1 << 61 else _whole(vectors)
        self.vectors, self.index = vectors, SlicedBlock(vectors)

    def best(self, query_ids: np.ndarray, queries: np.ndarray) -> list[tuple[int, int, int]]:
        """(query, row id, score) of the k best rows for each query."""
        if self.index is None:
            if not self.held:
                return []
            self._make_index()
        dims = self.vectors.shape[1]
        # What one side lacks counts as zeros.
        queries = np.pad(queries[:, :dims], ((0, 0), (0, max(0, dims - queries.shape[1]))))
        fits = dims * max(self.largest, 1) * max(largest(queries), 1) < 1 << 62
        queries = queries.astype(np.int64) if fits else _whole(queries)
        out = []
        for q, query in zip(query_ids, queries):
            found = self.index.candidates(query, self.need)
            scores = self.vectors[found].astype(np.int64 if fits else object) @ query
            members = np.concatenate([np.arange(self.starts[f], self.stops[f]) for f in found])
            ids, scores = self.ids[members], np.repeat(scores, self.stops[found] - self.starts[found])
            ids, scores = ids[ids != q], scores[ids != q]
            order = np.lexsort((ids, -scores))[: self.k] if fits else sorted(range(len(ids)), key=lambda m: (-scores[m], ids[m]))[: self.k]
            out += [(int(q), int(i), as_long(s)) for i, s in zip(ids[order], scores[order])]
        return out


def _whole(m: np.ndarray) -> np.ndarray:
    """Whole numbers held as doubles, as Python's integers."""
    return np.vectorize(int, otypes=[object])(m) if m.size else m.astype(object)


def top_k(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = BLOCK_ROWS, group_queries: int = GROUP_QUERIES) -> DataFrame:
    """The k best rows of ``vectors`` for each row of ``queries``: (query_id, rank, vec_id, score).

    Counting rows first fixes how many blocks and shares there are; both sides are dealt by a
    hash, so a frequent vector is spread over all blocks.
    """
    def valid(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col)).alias("v")).filter(
            "id IS NOT NULL AND v IS NOT NULL"
        )

    rows, asked = valid(vectors), valid(queries).dropDuplicates(["id", "v"])
    n_rows, width = vectors.agg(F.count(F.lit(1)), F.max(F.size(vector_col))).first()
    block_rows = max(1, min(block_rows, BLOCK_CELLS // max(1, width or 0)))
    n_blocks = max(1, -(-n_rows // block_rows))
    # Shares of the queries: more than one only while blocks are too few for the cores.
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    n_shares = max(1, min(-(-queries.count() // group_queries), -(-2 * cores // n_blocks)))
    deal = F.xxhash64("id", "v")
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    side = lambda df, number, b, s: df.select(b.alias("b"), "id", "v").select("b", s.alias("s"), F.lit(number).alias("side"), "id", "v")
    both = side(rows, 0, F.pmod(deal, F.lit(n_blocks)), each(n_shares)).unionByName(side(asked, 1, each(n_blocks), F.pmod(deal, F.lit(n_shares))))
    unit = (F.col("b") * n_shares + F.col("s")).cast("int")
    units = both.select(unit.alias("unit"), "side", "id", "v").repartitionById(n_blocks * n_shares, F.col("unit")).sortWithinPartitions("unit", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, block = None, None
        for batch in batches:
            # Rows of one unit and side at a time, of the queries a group at most.
            place = 2 * batch.column("unit").to_numpy().astype(np.int64) + batch.column("side").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), len(place)]
            for start, stop in zip(cuts, cuts[1:]):
                if start == stop:
                    continue
                number, asks = divmod(int(place[start]), 2)
                if number != at:
                    at, block = number, Block(k, block_rows)
                size = group_queries if asks else stop - start
                for i in range(start, stop, size):
                    part = batch.slice(i, min(size, stop - i))
                    ids, v = part.column("id").to_numpy(), part.column("v")
                    m = matrix(v, int(v.value_lengths().to_numpy(zero_copy_only=False).max(initial=1)))
                    if not asks:
                        block.add(ids, m)
                        continue
                    columns = list(zip(*block.best(ids, m))) or [[]] * 3
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        units.mapInArrow(run, "query_id long, vec_id long, score long")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5)
