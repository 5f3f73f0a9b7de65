"""Embedding near-dedup: inverted lists, product-quantised residuals, exact cosine rerank.

Equal vectors of a label are one node with a weight. Nodes are indexed by the nearest of K coarse
centroids (an inverted list) and by codes of their residual in M subspaces. Two unit vectors of
cosine 0.98 lie within ``reach`` = 0.2 of each other, which makes every filter here lossless:

* Probes. x can lie in list c only if the bisector of c and q's own centroid is within reach of
  q, so q probes exactly the lists for which it is. A pair is compared once: by the
  node of the lower list.
* Asymmetric distance. With the decoded x^ = centroid + codes, q.x = q.x^ + x.(x - x^) + (q - x).(x - x^),
  at most q.x^ (sums of table entries) + s + reach * e, where s and e = |x - x^| are
  stored with x. Pairs whose bound is below the threshold are dropped, all others are scored
  exactly in double precision.

Centroids and codebooks are fitted on at most ``SAMPLE`` nodes (those with the smallest hash); every node is
indexed. Cells (label, list) with more than ``BLOCK`` rows are cut into tiles of stored
rows and queries. A tile passes on a count per node and a spanning forest, never its pairs.
Links join components; nothing but the sample and the codebooks reaches the driver.

Vectors that are NULL, zero or hold NULL or non-finite components, and rows with a NULL label,
link with nothing and are their own component. Shorter vectors count as padded with zeros. A NULL id links others but names no
component; its component is NULL where no other id is in it. Repeated rows are linked rows like others. Equal labels are
equal as text. Other columns are never read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import WorkFolder, table
from sluice.llm.components import components
from sluice.llm.vectors import matrix, usable, widest

COSINE = 0.98
SAMPLE = 20_000
MAX_LISTS = 4096
SUBSPACES, CODES = 16, 64
ROUNDS = 8
BLOCK = 1024
# Pairs that are scored at once.
PAIRS = 1 << 16
# Cells that are cut into tiles are broadcast up to this many, 24 bytes each.
BROADCAST_CELLS = 200_000
SLACK = 1e-9


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmax(x @ centres.T - (centres * centres).sum(axis=1) / 2, axis=1)


def k_means(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centres of ``x``, starting from its first rows; a centre without rows stays where it is."""
    centres = x[:k].copy()
    for _ in range(rounds):
        at = nearest(x, centres)
        n = np.bincount(at, minlength=k)
        sums = np.stack([np.bincount(at, weights=x[:, j], minlength=k) for j in range(x.shape[1])], axis=1)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def unit(raw: list[bytes], dims: int) -> np.ndarray:
    """Vectors of length 1; scaled by their largest component first, so that no square overflows."""
    v = np.zeros((len(raw), dims))
    for i, r in enumerate(raw):
        one = np.frombuffer(r[1:], np.float32 if r[:1] == b"f" else np.float64)
        v[i, : len(one)] = one
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def raw_bytes(v: np.ndarray) -> bytes:
    """A vector without trailing zeros: single precision where that is exact."""
    v = np.trim_zeros(v + 0.0, "b")
    with np.errstate(over="ignore"):
        small = v.astype(np.float32)
    return b"f" + small.tobytes() if (small == v).all() else b"d" + v.tobytes()


class Index:
    """Coarse centroids and residual codebooks."""

    def __init__(self, sample: np.ndarray, lists: int, cosine: float):
        self.dims, self.cosine = sample.shape[1], cosine
        self.reach = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + 1e-6
        self.lists = k_means(sample, min(lists, len(sample)))
        self.parts = [p for p in np.array_split(np.arange(self.dims), SUBSPACES) if len(p)]
        residual = sample - self.lists[nearest(sample, self.lists)]
        self.books = [k_means(residual[:, p], min(CODES, len(sample))) for p in self.parts]
        square = (self.lists * self.lists).sum(axis=1)
        self.apart = np.sqrt(np.maximum(square[:, None] + square[None, :] - 2 * self.lists @ self.lists.T, 0))

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """List, codes, s and e of every vector."""
        at = nearest(x, self.lists)
        residual = x - self.lists[at]
        codes = np.stack([nearest(residual[:, p], b) for p, b in zip(self.parts, self.books)], axis=1).astype(np.uint8)
        left = residual.copy()
        for m, (p, b) in enumerate(zip(self.parts, self.books)):
            left[:, p] -= b[codes[:, m]]
        return at, codes, (x * left).sum(axis=1), np.sqrt((left * left).sum(axis=1))

    def probes(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Which lists above its own each vector must visit."""
        score = x @ self.lists.T - (self.lists * self.lists).sum(axis=1) / 2
        behind = score[np.arange(len(x)), at][:, None] - score
        return (behind <= self.reach * self.apart[at] + SLACK) & (np.arange(len(self.lists)) > at[:, None])

    def bounds(self, queries: np.ndarray, centre: int, codes: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Upper bounds of the cosines of queries with the stored vectors of a list, if they are within reach."""
        out = np.repeat((queries @ self.lists[centre])[:, None], len(codes), axis=1)
        for m, (p, b) in enumerate(zip(self.parts, self.books)):
            out += (queries[:, p] @ b.T)[:, codes[:, m]]
        return out + s + self.reach * e


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable number per vertex of the graph with edges (a, b)."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, low[a])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def tile_links(index: Index, centre: int, stored: dict, queries: dict) -> tuple[dict[int, int], list[tuple[int, int]]]:
    """Weights of the links of each node, and links that span the linked nodes of a tile."""
    s_nodes, q_nodes = stored["node"], queries["node"]
    found_q, found_s = [], []
    step = max(1, PAIRS // max(1, len(s_nodes)))
    for low in range(0, len(q_nodes), step):
        part = slice(low, low + step)
        likely = index.bounds(queries["x"][part], centre, stored["codes"], stored["s"], stored["e"]) >= index.cosine - SLACK
        # In its own list a pair is taken once, and never a node with itself.
        likely &= ~queries["own"][part][:, None] | (q_nodes[part][:, None] < s_nodes[None, :])
        q, s = np.nonzero(likely)
        cosine = (queries["x"][low + q] * stored["x"][s]).sum(axis=1)
        linked = cosine >= index.cosine
        found_q.append(low + q[linked])
        found_s.append(s[linked])
    q, s = np.concatenate(found_q), np.concatenate(found_s)
    if not len(q):
        return {}, []
    nodes, at = np.unique(np.r_[q_nodes[q], s_nodes[s]], return_inverse=True)
    a, b = at[: len(q)], at[len(q) :]
    counts = np.bincount(a, weights=stored["weight"][s], minlength=len(nodes)) + np.bincount(b, weights=queries["weight"][q], minlength=len(nodes))
    low = forest(len(nodes), a, b)
    hung = np.flatnonzero(low != np.arange(len(nodes)))
    return dict(zip(nodes.tolist(), counts.astype(np.int64).tolist())), list(zip(nodes[hung].tolist(), nodes[low[hung]].tolist()))


def nodes_of(rows: DataFrame, dims: int) -> DataFrame:
    """(id, label, digest, vec) of rows (id, label, v); the digest is NULL for a row that links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            taken = batch.column("v").is_valid().to_numpy(zero_copy_only=False)
            x = np.zeros((batch.num_rows, dims))
            x[taken] = matrix(batch.column("v").filter(batch.column("v").is_valid()), dims)
            raw = [raw_bytes(v) if t and v.any() else None for v, t in zip(x, taken)]
            labels = batch.column("label").to_pylist()
            digests = [None if r is None else hashlib.blake2b(label.encode() + b"\0" + r, digest_size=16).digest() for r, label in zip(raw, labels)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(digests, pa.binary()), pa.array(raw, pa.binary())], names=["id", "label", "digest", "vec"]
            )

    return rows.mapInArrow(run, "id long, label string, digest binary, vec binary")


def indexed(nodes: DataFrame, index: Index) -> DataFrame:
    """Every node with its list, codes, bounds and the lists it probes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unit(batch.column("vec").to_pylist(), index.dims)
            at, codes, s, e = index.place(x)
            visits = index.probes(x, at)
            offsets = np.r_[0, np.cumsum(visits.sum(axis=1))].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"), batch.column("weight"), batch.column("label"), batch.column("vec"), pa.array(at.astype(np.int32)),
                    pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(s), pa.array(e),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.nonzero(visits)[1].astype(np.int32))),
                ],
                names=["node", "weight", "label", "vec", "list", "codes", "s", "e", "probes"],
            )

    schema = "node long, weight long, label string, vec binary, list int, codes binary, s double, e double, probes array<int>"
    return nodes.select("node", "weight", "label", "vec").mapInArrow(run, schema)


def tiled(placed: DataFrame, folder: WorkFolder) -> DataFrame:
    """Stored rows and queries of every tile: a cell, cut where it has more than BLOCK rows."""
    cell = ["label", "list"]
    stored = placed.select("label", "list", "node", "weight", "vec", "codes", "s", "e")
    own = placed.select("label", "list", "node", "weight", "vec", F.lit(True).alias("own"))
    visits = placed.select("label", F.explode("probes").alias("list"), "node", "weight", "vec", F.lit(False).alias("own"))
    n_stored = placed.groupBy(*cell).agg(F.count("*").alias("stored"))
    n_asked = placed.select("label", F.explode("probes").alias("list")).groupBy(*cell).agg(F.count("*").alias("asked"))
    cells = n_stored.join(n_asked, cell, "left").select(
        *cell, F.ceil(F.col("stored") / BLOCK).alias("s_blocks"), F.ceil((F.col("stored") + F.coalesce("asked", F.lit(0))) / BLOCK).alias("q_blocks")
    )
    # At most rows / BLOCK cells.
    cut = folder.write(cells.filter("s_blocks > 1 OR q_blocks > 1"), "cut")
    if cut.count() <= BROADCAST_CELLS:
        cut = F.broadcast(cut)
    block = lambda n: F.pmod(F.xxhash64("node"), F.coalesce(n, F.lit(1)))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(n, F.lit(1)) - 1))
    s_side = stored.join(cut, cell, "left").withColumns({"s_block": block(F.col("s_blocks"))}).withColumn("q_block", every(F.col("q_blocks")))
    q_side = own.unionByName(visits).join(cut, cell, "left").withColumns({"q_block": block(F.col("q_blocks"))}).withColumn("s_block", every(F.col("s_blocks")))
    keep = ["label", "list", "s_block", "q_block", "node", "weight", "vec"]
    empty = {"codes": F.lit(None).cast("binary"), "s": F.lit(0.0), "e": F.lit(0.0)}
    return s_side.select(*keep, "codes", "s", "e", F.lit(False).alias("own")).unionByName(q_side.withColumns(empty).select(*keep, "codes", "s", "e", "own"))


def linked(members: DataFrame, index: Index) -> DataFrame:
    """(node, weight, other): weights of a node's links per tile, and links (other) that span them."""
    tile = ["label", "list", "s_block", "q_block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(where: tuple, held: list[pa.RecordBatch]) -> list[tuple]:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            is_stored = rows.column("codes").is_valid().to_numpy(zero_copy_only=False)
            if not is_stored.any() or is_stored.all():
                return []
            x = unit(rows.column("vec").to_pylist(), index.dims)
            sides = []
            for side in (is_stored, ~is_stored):
                sides.append({"x": x[side], **{c: rows.column(c).to_numpy(zero_copy_only=False)[side] for c in ("node", "weight", "s", "e", "own")}})
            codes = [c for c in rows.column("codes").to_pylist() if c is not None]
            sides[0]["codes"] = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1)
            counts, pairs = tile_links(index, where[1], *sides)
            return [(n, w, None) for n, w in counts.items()] + [(a, None, b) for a, b in pairs]

        where, held = None, []
        for batch in batches:
            found = []
            keys = list(zip(*(batch.column(c).to_pylist() for c in tile)))
            cuts = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]]
            for start, stop in zip(cuts, [*cuts[1:], len(keys)]):
                if keys[start] != where:
                    if held:
                        found += links(where, held)
                    where, held = keys[start], []
                held.append(batch.slice(start, stop - start))
            yield as_batch(found)
        if held:
            yield as_batch(links(where, held))

    def as_batch(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found)) or [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["node", "weight", "other"])

    tasks = members.sparkSession.conf.get("spark.sql.shuffle.partitions")
    dealt = members.repartition(int(tasks), *tile).sortWithinPartitions(*tile)
    return dealt.mapInArrow(run, "node long, weight long, other long")


def vector_dedup(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) of every row of ``vectors``."""
    spark = vectors.sparkSession
    folder = WorkFolder(spark, "vector_dedup")
    takes_part = F.col(label_col).isNotNull() & usable(F.col(vector_col))
    source = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
        F.when(takes_part, F.transform(F.col(vector_col), lambda c: c.cast("double"))).alias("v"),
    )
    dims = widest(source.filter("v IS NOT NULL"), "v")
    known = nodes_of(source, dims)
    rows = folder.write(known.select("id", "label", "digest"), "signed")
    distinct = known.filter("digest IS NOT NULL").groupBy("label", "digest").agg(F.min("id").alias("low"), F.count("*").alias("weight"), F.first("vec").alias("vec"))
    nodes = folder.write(distinct.withColumn("node", F.monotonically_increasing_id()), "nodes")
    n_nodes = nodes.count()
    named = nodes.select("label", "digest", "node", "low", "weight")
    if n_nodes:
        sample = nodes.orderBy(F.xxhash64("digest"), "digest").limit(SAMPLE).select("vec").collect()
        index = Index(unit([r.vec for r in sample], dims), min(MAX_LISTS, max(1, round(n_nodes**0.5 / 2))), cosine)
        placed = folder.write(indexed(nodes, index), "index")
        found = folder.write(linked(tiled(placed, folder), index), "found")
        counts = found.filter("weight IS NOT NULL").groupBy("node").agg(F.sum("weight").alias("links"))
        joined = components(found.filter("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")), folder, "linked")
        named = named.join(counts, "node", "left").join(joined.withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))
        named = folder.write(named.select("label", "digest", "low", "weight", "links", "component"), "named")
        lowest = named.groupBy("component").agg(F.min("low").alias("lowest")).repartition("component", "lowest")
        named = folder.write(
            named.join(lowest, "component").select("label", "digest", "lowest", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("links")), "results"
        )
    else:
        named = named.select("label", "digest", F.col("low").alias("lowest"), F.col("weight").alias("links"))
    out = rows.join(named, ["label", "digest"], "left").select(
        "id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("lowest")).alias("component_id")
    )
    result = folder.write(out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id"))), "result")
    folder.drop("signed", "nodes", "index", "found", "named", "results", "cut")
    return result.withColumnRenamed("id", id_col)


def op12_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup(table(spark, sf_dir, "embeddings"))
