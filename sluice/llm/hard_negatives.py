"""Hard-negative mining on an STR-packed R-tree.

Vectors are quantised to whole numbers floor(256 * x). Rows are range-sorted by label and first coordinate
into blocks, the top level of the tree. In a block each label has a tree of its own:
rows are sliced by the coordinates of largest spread in turn (sort-tile-recursive) into leaves,
and runs of neighbouring leaves become nodes. The minimum bounding box of a node gives, per
coordinate, an interval of products with the anchor's component; their sums bound all scores
below it. A best-first queue opens the node of the highest bound, and drops boxes that
lie outside the score window or strictly below the kth score found (a box that can only tie is
opened, as ties go to the smaller id).

First the positives: anchors go to the blocks that hold their label, and the best of all blocks
are ranked. Then each anchor goes to every block once with the windows of its positives. An
anchor set against all rows, in blocks: a task holds one block and a batch of anchors, and
passes on k rows per anchor and window. Blocks are never copied, and equal rows spread over blocks.

Rows with a NULL id, label or vector, or a NULL or non-finite component (256-fold included), take no part.
Shorter vectors count as padded with zeros. Rows that share the anchor's id are not its candidates;
other repeated rows are candidates each, and equal anchor rows are one anchor. An empty table gives no rows. Scores are
exact; one that does not fit a long is an error. Other columns are never read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.common import WorkFolder, table
from sluice.llm.vectors import as_long, largest, matrix, usable, widest

SCALE = 256
BLOCK_ROWS = 4096
LEAF_ROWS = 256
FANOUT = 8
POSITIVES = NEGATIVES = 5
# Window of a negative's score in hundredths of the positive's.
LOW, HIGH = 80, 100


def packed_rows(vectors: np.ndarray) -> pa.Array:
    """Whole rows as binary values: 16-bit numbers where they fit, else doubles."""
    small = np.abs(vectors).max(axis=1, initial=0) < 1 << 15
    return pa.array([v.astype(np.int16).tobytes() if s else v.tobytes() for v, s in zip(vectors, small)], pa.binary())


def unpacked_rows(raw: list[bytes], dims: int) -> np.ndarray:
    out = np.empty((len(raw), dims))
    for i, r in enumerate(raw):
        out[i] = np.frombuffer(r, np.int16 if len(r) == 2 * dims else np.float64)
    return out


def tiled(x: np.ndarray, rows: np.ndarray, coordinates: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Sort-tile-recursive: the rows of every leaf."""
    parts = -(-len(rows) // leaf)
    if parts <= 1:
        return [rows]
    # Slices per coordinate, so that the coordinates left make the rest of the leaves.
    slices = max(2, round(parts ** (1 / max(len(coordinates), 1))))
    size = leaf * -(-parts // slices)
    ordered = rows[np.argsort(x[rows, coordinates[0]], kind="stable")] if len(coordinates) else rows
    out = []
    for low in range(0, len(rows), size):
        out += tiled(x, ordered[low : low + size], coordinates[1:], leaf)
    return out


class Forest:
    """A tree per label over the rows of a block."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, leaf: int = LEAF_ROWS):
        self.leaf_ids, self.leaf_x, self.children, boxes = [], [], [], []
        self.roots: dict[int, int] = {}
        for label in np.unique(labels):
            rows = np.flatnonzero(labels == label)
            levels = max(1, int(np.ceil(np.log2(max(2, len(rows) / leaf)))))
            spread = np.argsort(-x[rows].var(axis=0), kind="stable")[:levels]
            nodes = []
            for part in tiled(x, rows, spread, leaf):
                # Stable sorting by score then leaves ties in the order of ids.
                part = part[np.argsort(ids[part], kind="stable")]
                nodes.append(len(boxes))
                self.children.append(None)
                self.leaf_ids.append(ids[part])
                self.leaf_x.append(x[part])
                boxes.append((x[part].min(axis=0), x[part].max(axis=0)))
            while len(nodes) > 1:
                above = []
                for low in range(0, len(nodes), FANOUT):
                    group = nodes[low : low + FANOUT]
                    above.append(len(boxes))
                    self.children.append(group)
                    self.leaf_ids.append(None)
                    self.leaf_x.append(None)
                    boxes.append((np.min([boxes[c][0] for c in group], axis=0), np.max([boxes[c][1] for c in group], axis=0)))
                nodes = above
            self.roots[int(label)] = nodes[0]
        self.low = np.array([b[0] for b in boxes])
        self.high = np.array([b[1] for b in boxes])
        self.largest = largest(x)

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
        """Least and largest score below every node per anchor; whether doubles hold them exactly."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        exact = 2 * anchors.shape[1] * max(self.largest, 1) * max(largest(anchors), 1) < 1 << 53
        low, high = self.low, self.high
        if not exact:
            up, down, low, high = (whole(m) for m in (up, down, low, high))
        return up @ low.T + down @ high.T, up @ high.T + down @ low.T, exact


def whole(m: np.ndarray) -> np.ndarray:
    """Python integers instead of doubles."""
    return np.array([[int(v) for v in row] for row in m], object).reshape(m.shape)


class Search:
    """Best-first searches of one anchor in a forest; scores of an opened leaf are kept for the next one."""

    def __init__(self, forest: Forest, anchor_id: int, anchor: np.ndarray, lowest: np.ndarray, highest: np.ndarray, exact: bool):
        self.forest, self.anchor_id, self.exact = forest, anchor_id, exact
        self.anchor = anchor if exact else whole(anchor[None])[0]
        self.lowest, self.highest, self.opened = lowest.tolist(), highest.tolist(), {}

    def leaf(self, node: int) -> tuple[np.ndarray, np.ndarray]:
        """(-scores, ids) of a leaf, the best first."""
        if node not in self.opened:
            ids, x = self.forest.leaf_ids[node], self.forest.leaf_x[node]
            scores = x @ self.anchor if self.exact else whole(x) @ self.anchor
            order = np.argsort(-scores, kind="stable")
            order = order[ids[order] != self.anchor_id]
            self.opened[node] = -scores[order], ids[order]
        return self.opened[node]

    def best(self, roots: list[int], k: int, low: int | None = None, high: int | None = None) -> list[tuple[int, int]]:
        """(-score, id) of the k best rows below ``roots`` with low <= score <= high."""
        found: list[tuple[int, int]] = []
        queue: list[tuple[int, int]] = []

        def push(node: int) -> None:
            least, most = self.lowest[node], self.highest[node]
            if (low is None or most >= low) and (high is None or least <= high):
                heapq.heappush(queue, (-(most if high is None else min(most, high)), node))

        for root in roots:
            push(root)
        while queue:
            bound, node = heapq.heappop(queue)
            if len(found) == k and bound > found[-1][0]:
                break
            if self.forest.children[node] is not None:
                for child in self.forest.children[node]:
                    push(child)
                continue
            scores, ids = self.leaf(node)
            start = 0 if high is None else int(np.searchsorted(scores, -high, side="left"))
            stop = min(start + k, len(scores))
            if low is not None:
                stop = min(stop, int(np.searchsorted(scores, -low, side="right")))
            if stop > start and (len(found) < k or scores[start] <= found[-1][0]):
                found = sorted(found + [(int(s), int(i)) for s, i in zip(scores[start:stop], ids[start:stop])])[:k]
        return found


def window(score: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """Whole scores n with low * score <= 100 * n <= high * score."""
    return -(-low * score // 100), high * score // 100


def searched(rows: DataFrame, asked: DataFrame, dims: int, n_blocks: int, leaf: int, ask, schema: str) -> DataFrame:
    """Send ``asked`` (block, anchor, id, label, x, windows) to the blocks of ``rows`` (block, id, label, x).

    ``ask(search, forest, label, windows)`` gives the rows found for one anchor.
    """
    nothing = F.lit(None).cast("array<long>").alias("windows")
    both = rows.select("block", F.lit(-1).cast("long").alias("anchor"), "id", "label", "x", nothing).unionByName(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, forest = None, [], None
        for batch in batches:
            found = []
            blocks = batch.column("block").to_numpy()
            cuts = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]]).tolist() if len(blocks) else []
            for start, stop in zip(cuts, [*cuts[1:], len(blocks)]):
                part = batch.slice(start, stop - start)
                if blocks[start] != block:
                    block, held, forest = blocks[start], [], None
                anchors = part.column("anchor").to_numpy()
                n_rows = int((anchors < 0).sum())
                ids, labels = part.column("id").to_numpy(), part.column("label").to_numpy()
                x = unpacked_rows(part.column("x").to_pylist(), dims)
                if n_rows:
                    held.append((ids[:n_rows], labels[:n_rows], x[:n_rows]))
                if n_rows == len(anchors):
                    continue
                if forest is None:
                    if not held:
                        continue
                    forest, held = Forest(*(np.concatenate(c) for c in zip(*held)), leaf), []
                windows = part.column("windows").slice(n_rows).to_pylist()
                lowest, highest, exact = forest.bounds(x[n_rows:])
                for i, asked_windows in enumerate(windows):
                    at = n_rows + i
                    search = Search(forest, int(ids[at]), x[at], lowest[i], highest[i], exact)
                    found += [(int(anchors[at]), *r) for r in ask(search, forest, int(labels[at]), asked_windows)]
            columns = list(zip(*found)) or [[]] * len(schema.split(","))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[c.split()[0] for c in schema.split(", ")])

    dealt = both.repartition(n_blocks, "block").sortWithinPartitions("block", "anchor")
    return dealt.mapInArrow(run, schema)


def hard_negatives(
    vectors: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
    id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", block_rows: int = BLOCK_ROWS, leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows of ``anchors`` among ``vectors``.

    Labels are whole numbers. ``anchors`` has the columns of ``vectors``.
    """
    spark = vectors.sparkSession
    folder = WorkFolder(spark, "hard_negatives")
    valid = lambda df: df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("v")).filter(
        F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v"))
    )
    dims = widest(valid(vectors), "v")

    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with np.errstate(over="ignore"):
                x = np.floor(matrix(batch.column("v"), dims) * SCALE) + 0.0
            fine = np.isfinite(x).all(axis=1)
            keep = pa.array(np.flatnonzero(fine))
            x = x[fine]
            first = x[:, 0] if dims else np.zeros(len(x))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(keep), batch.column("label").take(keep), packed_rows(x), pa.array(first)], names=["id", "label", "x", "first"]
            )

    quantised = lambda df: valid(df).mapInArrow(quantise, "id long, label long, x binary, first double")
    n_blocks = max(1, -(-vectors.count() // block_rows))
    # The hash spreads equal rows over blocks.
    dealt = quantised(vectors).repartitionByRange(n_blocks, "label", "first", F.xxhash64("id", "x"))
    rows = folder.write(dealt.select(F.spark_partition_id().alias("block"), "id", "label", "x"), "rows")
    asked = folder.write(quantised(anchors).select("id", "label", "x").distinct().withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    blocks = rows.select("block", "label").distinct()
    none = F.lit(None).cast("array<long>")

    same = asked.join(blocks, "label").select("block", "anchor", "id", "label", "x", none.alias("windows"))
    ask = lambda search, forest, label, windows: [(-s, i) for s, i in search.best([forest.roots[label]], positives)]
    best = searched(rows, same, dims, n_blocks, leaf_rows, lambda *a: [(as_long(s), i) for s, i in ask(*a)], "anchor long, score long, other long")
    rank = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "other"))
    best = best.withColumn("rank", rank).filter(F.col("rank") <= positives)
    chosen = folder.write(best.select("anchor", F.col("other").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").alias("place")), "positives")

    every = rows.agg(F.max("block")).first()[0] or 0
    windows = chosen.groupBy("anchor").agg(F.collect_set("positive_score").alias("windows"))
    others = asked.join(windows, "anchor").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(every))))

    def ask_others(search: Search, forest: Forest, label: int, scores: list[int]) -> list[tuple[int, int, int]]:
        roots, out = [r for k, r in forest.roots.items() if k != label], []
        for positive in scores:
            least, most = window(positive, low, high)
            if least <= most:
                out += [(positive, as_long(-s), i) for s, i in search.best(roots, negatives, least, most)]
        return out

    hard = searched(
        rows, others.select("block", "anchor", "id", "label", "x", "windows"), dims, n_blocks, leaf_rows, ask_others,
        "anchor long, positive_score long, negative_score long, negative_id long",
    )
    rank = F.row_number().over(Window.partitionBy("anchor", "positive_score").orderBy(F.desc("negative_score"), "negative_id"))
    hard = folder.write(hard.withColumn("rank", rank).filter(F.col("rank") <= negatives), "hard")
    out = hard.join(chosen, ["anchor", "positive_score"]).join(asked.select("anchor", F.col("id").alias("anchor_id")), "anchor")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    mixed_up = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = vectors.withColumn("label", mixed_up)
    return hard_negatives(vectors, vectors.filter("vec_id % 100 = 0"))
