"""BagMinHash near-dedup: weighted-Jaccard signatures, banding, and a verified multiset overlap.

A text is the multiset of its 5-word shingles (fewer words: one shingle of them). The axis of
weights is cut into [0, 1), [1, 2), [2, 4), [4, 8), ... For each shingle and interval a Poisson
process, seeded by both, throws points of growing time onto the signature's components. An
interval below the shingle's count is taken whole; of the one that holds the count, points above
it are split off. The first point of each component is its signature value, so two texts agree
in a component with the probability of their weighted Jaccard similarity. Points are drawn
until the latest first point of the text is passed, which needs few points per shingle.

``BANDS`` bands of ``ROWS`` values make candidates: texts that share a bucket, whatever its size; a pair of
similarity 0.8 does with probability 0.99995. Texts of similarity 0.8 or more that share a bucket, directly
or by others, are one class, named by its smallest doc_id. In rounds, each text is compared exactly with few
pivots (of a bucket first the text that shares buckets with the most others, then the smallest by a hash of the
round; those that share most buckets first) and classes are contracted; buckets that lie within one class drop out. When few of a round's pairs are links, what is left is
compared in tiles: of a bucket, texts outside its largest class against all texts of other classes. Buckets
beyond a tile (many texts that share a passage and little else) are first cut by a filter that loses nothing: texts of
n and m shingles and similarity s have s / (1 + s) * (n + m) in common, so they share one of their rarest n - that + 1 and
m - that + 1. Buckets of shingles take their place, those of common shingles apart for every two classes of length. So a group of near copies costs a few comparisons per text and round, not per pair, and every
candidate pair is compared, ruled out or already in one class.

Exact copies meet by a digest of their text first, and one of them stands for all. What is compared
and linked are distinct texts, numbered, not ids: rows that share an id stay apart unless their texts
are similar. Narrow tables in the shared work folder cut the lineage; texts are shuffled once.

Rows with equal texts are one class, also texts without words that are equal. A NULL text is in
no class but its own. Rows that repeat a doc_id have a class each, by their texts; two classes whose
smallest doc_id is the same bear the same name. A NULL doc_id links texts like others, but is given no
class name. Other columns are never read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import WorkFolder, fresh, join_side, table, text_slices
from sluice.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5
SIZE = BANDS * ROWS
# A block of a tile: documents, and shingles.
BLOCK_DOCS = 96
BLOCK_SHINGLES = 200_000
CACHE_WORDS = 500_000
# Pivots that a text is compared with in a round, and the share of these pairs that must be links for another round.
PIVOTS = 4
LEAST_FOUND = 0.25
MAX_ROUNDS = 12
# Lengths of texts that form a class differ by at most this factor.
LENGTH_STEP = 1.05
LENGTHS = np.unique(np.ceil(LENGTH_STEP ** np.arange(600)).astype(np.int64))
# Shingles known as common when large buckets are cut; which ones does not change the links.
MAX_COMMON = 200_000
# Odd multipliers of the hash mixes.
STEP, M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
PLACES = np.array([0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


WORD_HASHES = WordHashes()


def shingles(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the shingles of a text, repeats included."""
    words = (text or "").encode().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(WORD_HASHES) > CACHE_WORDS:
        WORD_HASHES.clear()
    w = np.fromiter(map(WORD_HASHES.__getitem__, words), np.uint64, len(words))
    if len(w) < SHINGLE:
        return mix((w * PLACES[: len(w)]).sum(keepdims=True) + np.uint64(len(w)))
    n = len(w) - SHINGLE + 1
    total = w[:n] * PLACES[0]
    for i in range(1, SHINGLE):
        total += w[i : i + n] * PLACES[i]
    return np.sort(mix(total))


def occurrences(sorted_shingles: np.ndarray) -> np.ndarray:
    """The multiset as a set: the k-th repeat of a shingle becomes an element of its own."""
    if not len(sorted_shingles):
        return sorted_shingles
    first = np.r_[True, sorted_shingles[1:] != sorted_shingles[:-1]]
    if first.all():
        return sorted_shingles
    index = np.arange(len(first))
    repeat = (index - np.maximum.accumulate(np.where(first, index, 0))).astype(np.uint64)
    return np.where(repeat > 0, mix(sorted_shingles + repeat * STEP), sorted_shingles)


def signatures(texts: list[np.ndarray]) -> np.ndarray:
    """BagMinHash signatures (one row of SIZE values each) of sorted shingle hashes."""
    doc, key, weight = [], [], []
    for i, s in enumerate(texts):
        if len(s):
            at = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
            doc.append(np.full(len(at), i, np.int64))
            key.append(s[at])
            weight.append(np.diff(np.r_[at, len(s)]))
    best = np.full((len(texts), SIZE), np.inf)
    if not doc:
        return best.astype(np.float32)
    doc, key, weight = np.concatenate(doc), np.concatenate(key), np.concatenate(weight)
    # One process per shingle and interval [start, start + rate) below its weight.
    docs, states, rates, starts, tops = [doc], [mix(key + STEP)], [np.ones(len(doc))], [np.zeros(len(doc), np.int64)], [weight]
    start = 1
    while (more := weight > start).any():
        n = int(more.sum())
        docs.append(doc[more])
        states.append(mix(key[more] + np.uint64(int(STEP) * (start + 1) % 2**64)))
        rates.append(np.full(n, float(start)))
        starts.append(np.full(n, start, np.int64))
        tops.append(weight[more])
        start *= 2
    doc, state, rate = np.concatenate(docs), np.concatenate(states), np.concatenate(rates)
    start, top = np.concatenate(starts), np.concatenate(tops)
    split = start + rate > top
    time = np.zeros(len(doc))
    flat = best.reshape(-1)
    while len(doc):
        state = state + STEP
        h = mix(state)
        time = time - np.log(((h >> np.uint64(24)).astype(np.float64) + 1.0) * 2.0**-40) / rate
        component = ((h & np.uint64(0xFFFFFF)).astype(np.int64) * SIZE) >> 24
        hit = time < flat[doc * SIZE + component]
        if split.any():
            # A point's height in its interval; above the weight it belongs to heavier texts only.
            height = start + (mix(h ^ PLACES[0]) >> np.uint64(11)).astype(np.float64) * 2.0**-53 * rate
            hit &= ~split | (height < top)
        np.minimum.at(flat, doc[hit] * SIZE + component[hit], time[hit])
        alive = time < best.max(axis=1)[doc]
        if not alive.all():
            doc, state, rate, start, top, split, time = (x[alive] for x in (doc, state, rate, start, top, split, time))
    # Rounding hides last-bit differences of log() between machines.
    return best.astype(np.float32)


def band_keys(signature: np.ndarray) -> np.ndarray:
    bits = signature.view(np.uint32).astype(np.uint64).reshape(-1, BANDS, ROWS)
    return mix((bits * PLACES[:ROWS]).sum(axis=2) + STEP * np.arange(1, BANDS + 1, dtype=np.uint64)).view(np.int64)


def digest(text: Column) -> Column:
    """128 bits that stand for a text; NULL for NULL."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def row_key(doc_id: Column) -> Column:
    """An id as a key that is never NULL."""
    return F.coalesce(doc_id.cast("long").cast("string"), F.lit(""))


def sign(docs: DataFrame) -> DataFrame:
    """(id, copy, n, bands) of each row of ``docs`` (id, copy, text): shingles, band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            sets = [shingles(t) for t in part.column("text").to_pylist()]
            keys = band_keys(signatures(sets))
            sizes = np.array([len(s) for s in sets], np.int64)
            offsets = np.concatenate([[0], np.cumsum(np.where(sizes > 0, BANDS, 0))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    part.column("copy"),
                    pa.array(sizes),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[sizes > 0].reshape(-1))),
                ],
                names=["id", "copy", "n", "bands"],
            )

    return docs.mapInArrow(run, "id long, copy binary, n long, bands array<long>")


def similar_pairs(sets: list[np.ndarray], first: np.ndarray, second: np.ndarray, similarity: float) -> np.ndarray:
    """Index pairs (from ``first`` x ``second``, lower index first) of sets with enough overlap."""
    sizes = np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, count = np.unique(values, return_inverse=True, return_counts=True)
    shared = count > 1
    column, owner = (np.cumsum(shared) - 1)[column[shared[column]]], owner[shared[column]]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    # A set of columns at a time bounds the matrix, however long the texts are.
    step, n = 1 << 14, int(column[-1]) + 1 if len(column) else 0
    for low in range(0, n, step):
        a, b = np.searchsorted(column, (low, low + step))
        part = np.zeros((len(sets), min(step, n - low)), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        both += part @ part.T
    together = sizes[:, None] + sizes[None, :] - both
    allowed = np.zeros(both.shape, bool)
    allowed[np.ix_(first, second)] = True
    allowed |= allowed.T
    return np.argwhere(np.triu(allowed & (both >= similarity * together - 1e-6), 1))


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of ``pairs`` (a, b) that share a band and whose sets overlap enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "set_a"):
            keep = []
            for x, y, p, q in zip(*(batch.column(c).to_pylist() for c in ("set_a", "set_b", "bands_a", "bands_b"))):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                # The shorter one holds enough only if it is long enough.
                likely = min(len(x), len(y)) >= similarity * max(len(x), len(y)) - 1e-6 and share_band(p, q)
                both = len(np.intersect1d(x, y, assume_unique=True)) if likely else 0
                keep.append(likely and both >= similarity * (len(x) + len(y) - both) - 1e-6)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda x: sets.select(F.col("id").alias(x), F.col("set").alias(f"set_{x}"), F.col("bands").alias(f"bands_{x}"))
    # The second join may split a common pivot.
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.select("a", "b", "set_a", "set_b", "bands_a", "bands_b").mapInArrow(run, "a long, b long")


def share_band(a: bytes, b: bytes) -> bool:
    return bool((np.frombuffer(a, np.int64) == np.frombuffer(b, np.int64)).any())


def tile_links(ids: np.ndarray, classes: np.ndarray, sets: list[np.ndarray], bands: list[bytes], first: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """A spanning forest of the similar pairs, of different classes, of the rows ``first`` with the others.

    A text may stand on both sides.
    """
    root = {c: c for c in classes.tolist()}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    out = []
    for a, b in similar_pairs(sets, np.flatnonzero(first), np.flatnonzero(~first), similarity).tolist():
        x, y = find(classes[a]), find(classes[b])
        if x != y and share_band(bands[a], bands[b]):
            root[max(x, y)] = min(x, y)
            out.append((int(ids[a]), int(ids[b])))
    return out


def n_blocks(docs: Column, n_shingles: Column) -> Column:
    """Blocks of a side, from its numbers of documents and shingles."""
    return F.greatest(F.ceil(docs / BLOCK_DOCS), F.ceil(n_shingles / BLOCK_SHINGLES), F.lit(1)).cast("long")


def sides(live: DataFrame, sizes: DataFrame) -> DataFrame:
    """Per bucket of ``live`` (band, key, id, component): its largest class, blocks of each side, rows of its tiles, and smallest id.

    The first side holds a bucket's texts outside its largest class, the second one all of them.
    """
    bucket = ["band", "key"]
    by_class = live.join(sizes, "id").groupBy(*bucket, "component").agg(F.count("*").alias("docs"), F.sum("n").alias("n"), F.min("id").alias("low"))
    plan = by_class.groupBy(*bucket).agg(
        F.max(F.struct("docs", "n", "component")).alias("top"), F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.min("low").alias("low")
    )
    strays = F.col("docs") - F.col("top.docs")
    plan = plan.withColumns({"nj": n_blocks(F.col("docs"), F.col("n")), "ni": n_blocks(strays, F.col("n") - F.col("top.n"))})
    return plan.select(*bucket, F.col("top.component").alias("top"), "ni", "nj", (strays * F.col("nj") + F.col("docs") * F.col("ni")).alias("rows"), "low")


def tiles(live: DataFrame, sizes: DataFrame, folder: WorkFolder) -> DataFrame:
    """(band, key, i, j, first, id, component) of ``live`` (band, key, id, component): both sides of each tile.

    Here and elsewhere sums are stored or dealt anew before a join, so that the join may split a hot key.
    """
    bucket = ["band", "key"]
    placed = live.join(join_side(folder.write(sides(live, sizes).drop("rows", "low"), "sides")), bucket)
    block = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    keep = [*bucket, "i", "j", "first", "id", "component"]
    strays = placed.filter("component <> top").withColumns({"i": block("ni"), "first": F.lit(True)}).withColumn("j", every("nj"))
    everyone = placed.withColumns({"j": block("nj"), "first": F.lit(False)}).withColumn("i", every("ni"))
    return strays.select(*keep).unionByName(everyone.select(*keep))


def least_tiles(live: DataFrame, sizes: DataFrame, folder: WorkFolder) -> DataFrame:
    """``live``, with the buckets of a group of texts that meet by them taken as one, where that makes fewer rows.

    Pairs must share a band in either case, so the links are the same.
    """
    plan = folder.write(sides(live, sizes), "plan")
    low = join_side(plan.select("band", "key", "low"))
    met = live.join(low, ["band", "key"]).select(F.col("id").alias("a"), F.col("low").alias("b"))
    groups = join_side(components(met, folder, "group")).withColumnRenamed("component", "group")
    texts = live.select("id", "component").distinct().join(groups, "id")
    whole = texts.select(F.lit(-2).alias("band"), F.col("group").alias("key"), "id", "component")
    by_bucket = plan.join(groups.withColumnRenamed("id", "low"), "low").groupBy("group").agg(F.sum("rows").alias("by_bucket"))
    one = sides(whole, sizes).join(by_bucket, F.col("key") == F.col("group")).filter("rows < by_bucket").select("group")
    one = join_side(folder.write(one, "one"))
    apart = live.join(groups, "id").join(one, "group", "left_anti").select("band", "key", "id", "component")
    return whole.join(one.withColumnRenamed("group", "key"), "key", "left_semi").select("band", "key", "id", "component").unionByName(apart)


def tile_pairs(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) that join all similar texts of each tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held, found = None, [], []

        def close() -> None:
            ids, classes, first, raw, bands = zip(*held)
            if any(first) and not all(first):
                sets = [np.frombuffer(r, np.uint64) for r in raw]
                found.extend(tile_links(np.array(ids), np.array(classes), sets, bands, np.array(first), similarity))

        for batch in text_slices(batches, "set"):
            rows = zip(*(batch.column(c).to_pylist() for c in ("band", "key", "i", "j", "id", "component", "first", "set", "bands")))
            for *where, doc, component, first, raw, bands in rows:
                if where != tile:
                    if held:
                        close()
                    tile, held = where, []
                held.append((doc, component, first, raw, bands))
        if held:
            close()
        a, b = zip(*found) if found else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    keys = ["band", "key", "i", "j"]
    dealt = members.join(sets, "id").select(*keys, "id", "component", "first", "set", "bands").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, "a long, b long")


def sets_of(docs: DataFrame, copies: DataFrame, ids: DataFrame, folder: WorkFolder) -> DataFrame:
    """(id, set, bands) of the texts ``ids``: the multiset of their shingles as a set, and their band keys."""
    needed = copies.join(ids.withColumnRenamed("id", "node"), "node", "left_semi").select("node", "copy", "rep")
    needed = join_side(folder.write(needed, "needed"))
    # Texts of rows without an id are brought together by digest; those are few, or else copies.
    with_id = docs.filter("id IS NOT NULL").join(needed.withColumnRenamed("rep", "id"), ["id", "copy"]).select(F.col("node").alias("id"), "text")
    without = docs.filter("id IS NULL AND text IS NOT NULL").groupBy("copy").agg(F.first("text").alias("text"))
    without = without.join(needed.filter("rep IS NULL"), "copy").select(F.col("node").alias("id"), "text")

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            found = [shingles(t) for t in part.column("text").to_pylist()]
            keys = [k.tobytes() for k in band_keys(signatures(found))]
            sets = [occurrences(f).tobytes() for f in found]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(sets, pa.binary()), pa.array(keys, pa.binary())], names=["id", "set", "bands"])

    # An id and text that repeat give equal rows.
    return with_id.unionByName(without).mapInArrow(to_sets, "id long, set binary, bands binary").distinct()


class Contraction:
    """Classes of texts that grow with the links found."""

    def __init__(self, sets: DataFrame, folder: WorkFolder, similarity: float):
        self.sets, self.folder, self.similarity = sets, folder, similarity
        self.classes = None
        self.step = 0

    def add(self, found: DataFrame) -> int:
        """Take in links (a, b); their number. The classes so far, each a star, stand for all links before."""
        found = self.folder.write(found, f"links-{self.step}")
        n = found.count()
        if n or self.classes is None:
            links = found if self.classes is None else found.unionByName(self.classes.select(F.col("id").alias("a"), F.col("component").alias("b")))
            self.classes = components(links, self.folder, f"round-{self.step}")
        self.step += 1
        return n

    def classed(self, texts: DataFrame) -> DataFrame:
        """``texts``, one row of each id, with their class."""
        if self.classes is None:
            return texts.withColumn("component", F.col("id"))
        return texts.join(join_side(self.classes), "id", "left").withColumn("component", F.coalesce("component", "id"))

    def classed_buckets(self, met: DataFrame) -> DataFrame:
        """``met`` (id and others, a row of each bucket) with the class of each text, which is looked up once per text."""
        if self.classes is None:
            return self.classed(met)
        held = F.collect_list(F.struct(*[c for c in met.columns if c != "id"]))
        return self.classed(met.groupBy("id").agg(held.alias("held"))).select("id", "component", F.inline("held"))

    def mixed(self, rows: DataFrame) -> DataFrame:
        """Those of ``rows`` (id, band, key, component; first also central) whose bucket holds several classes, with the bucket's pivot."""
        # The text in the midst of a group of near copies is similar to most of them.
        order = F.xxhash64("id", F.lit(self.step)) if self.step else -F.col("central")
        pivot = F.min(F.struct(order.alias("order"), "id", "component"))
        several = rows.groupBy("band", "key").agg(F.min("component").alias("low"), F.max("component").alias("high"), pivot.alias("pivot"))
        several = self.folder.write(several.filter("low < high").select("band", "key", "pivot"), f"several-{self.step}")
        return self.folder.write(rows.join(join_side(several), ["band", "key"]), f"live-{self.step}")

    def rounds(self, met: DataFrame) -> DataFrame:
        """Compare with pivots while enough of the pairs are links; what is left (id, band, key, component)."""
        for _ in range(MAX_ROUNDS):
            live = self.mixed(self.classed_buckets(met))
            met = live.select("id", "band", "key", "component")
            # A text and its pivots, at most one of each bucket; those of the most buckets first.
            asked = live.filter("component <> pivot.component").groupBy("id", "pivot").agg(F.count("*").alias("buckets"))
            best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("buckets")).alias("less"), "pivot"))), 1, PIVOTS)
            asked = asked.groupBy("id").agg(best.alias("best")).select(F.col("id").alias("a"), F.explode("best.pivot.id").alias("b"))
            pairs = self.folder.write(asked, f"pairs-{self.step}")
            n = pairs.count()
            if not n or self.add(verified(pairs, self.sets, self.similarity)) < LEAST_FOUND * n:
                break
            met = met.drop("component")
        return met


def centrality(met: DataFrame, folder: WorkFolder) -> DataFrame:
    """``met`` (id, band, key; held: texts of the bucket) with the number of texts, repeats counted, in the buckets of each text."""
    if "held" not in met.columns:
        held = met.groupBy("band", "key").agg(F.count("*").alias("held")).repartition("band", "key", "held")
        met = met.join(held, ["band", "key"])
    central = folder.write(met.groupBy("id").agg(F.sum("held").alias("central")), "central")
    return met.drop("held").join(join_side(central), "id")


def length_class(n: int) -> int:
    return int(np.searchsorted(LENGTHS, n, "right")) - 1


def prefix_lengths(n: int, similarity: float) -> list[tuple[int, int]]:
    """(class, prefix) for every class of lengths that a similar text of one with ``n`` shingles may be of.

    Of any order of shingles, one of the first ``prefix`` is shared with each similar text of that class.
    """
    least = int(np.ceil(similarity * n - 1e-6))
    classes = range(length_class(max(least, 1)), length_class(int(n / similarity + 1e-6)) + 1)
    share = similarity / (1 + similarity)
    return [(k, n - int(np.ceil(share * (n + max(int(LENGTHS[k]), least)) - 1e-6)) + 1) for k in classes]


def prefix_keys(keys: np.ndarray, common: int, similarity: float) -> list[tuple[int, np.ndarray]]:
    """(band, keys) by which a text meets all similar ones; the last ``common`` of its ``keys`` are the common ones.

    Rare shingles meet whatever the lengths. Common ones meet for each two classes of length apart, so that a text whose
    rare shingles, if shared with none, make it too different from all of a class is in no bucket with that class.
    """
    n, rare = len(keys), len(keys) - common
    own, ways = length_class(n), prefix_lengths(n, similarity)
    out = [(-1, keys[: min(rare, max(p for _, p in ways))])]
    for k, prefix in ways:
        if prefix > rare:
            out.append((-3 - (min(own, k) * len(LENGTHS) + max(own, k)), keys[rare:prefix]))
    return out


def rare_shingles(sets: DataFrame, ids: DataFrame, similarity: float) -> DataFrame:
    """(id, band, key, component): for each text of ``ids`` (id, component) its rarest shingles, one of which it shares with any similar text.

    That holds for any common order of shingles. Here those of at most a block of these texts come first, by value; then the
    others by the number of texts that hold them. At most MAX_COMMON, the commonest, count as such.
    """
    mine = sets.join(ids, "id").select("id", "set", "component")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "set"):
            found = [np.frombuffer(s, np.int64) for s in part.column("set").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*found, np.zeros(0, np.int64)]))], names=["key"])

    held = mine.mapInArrow(each, "key long").groupBy("key").agg(F.count("*").alias("held")).filter(F.col("held") > BLOCK_DOCS)
    rows = sorted((r.key, r.held) for r in held.orderBy(F.desc("held"), "key").limit(MAX_COMMON).collect())
    # One key more, beyond all others, so that a search always finds a place.
    known = np.array([k for k, _ in rows] + [np.iinfo(np.int64).max], np.int64)
    times = np.array([n for _, n in rows] + [0], np.int64)
    common = sets.sparkSession.sparkContext.broadcast((known, times))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, times = common.value
        for part in text_slices(batches, "set"):
            rows, classes, bands, keys = [], [], [], [np.zeros(0, np.int64)]
            for doc, component, raw in zip(*(part.column(c).to_pylist() for c in ("id", "component", "set"))):
                key = np.frombuffer(raw, np.int64)
                at = np.searchsorted(known, key)
                weight = np.where(known[at] == key, times[at], 0)
                for band, some in prefix_keys(key[np.lexsort((key, weight))], int((weight > 0).sum()), similarity):
                    rows.append(np.full(len(some), doc, np.int64))
                    classes.append(np.full(len(some), component, np.int64))
                    bands.append(np.full(len(some), band, np.int64))
                    keys.append(some)
            none = np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([none, *x])) for x in (rows, bands, keys, classes)],
                names=["id", "band", "key", "component"],
            )

    return mine.mapInArrow(prefixes, "id long, band long, key long, component long").withColumn("band", F.col("band").cast("int"))


def similar_classes(met: DataFrame, sizes: DataFrame, sets: DataFrame, folder: WorkFolder, similarity: float = SIMILARITY) -> DataFrame:
    """(id, component) of the texts that are similar to another one of their buckets ``met`` (id, band, key; held or not).

    Classes only grow, so no pair is left out by dropping buckets that lie within one class.
    """
    state = Contraction(sets, folder, similarity)
    left = state.rounds(centrality(met, folder))
    if left.count():
        per_bucket = left.join(sizes, "id").groupBy("band", "key").agg(F.count("*").alias("docs"), F.sum("n").alias("n"))
        large = folder.write(per_bucket.filter((F.col("docs") > BLOCK_DOCS) | (F.col("n") > BLOCK_SHINGLES)).select("band", "key"), "large")
        beyond = left.join(join_side(large), ["band", "key"], "left_semi").select("id").distinct()
        beyond = folder.write(state.classed(beyond), "beyond")
        rest = left.join(join_side(large), ["band", "key"], "left_anti")
        if beyond.count():
            rare = folder.write(rare_shingles(sets, join_side(beyond), similarity), "rare")
            rare = state.mixed(rare).select("id", "band", "key", "component")
            rest = rest.select(*rare.columns).unionByName(least_tiles(rare, sizes, folder))
        state.add(tile_pairs(tiles(folder.write(rest, "rest"), sizes, folder), sets, similarity))
    if state.classes is None:
        return met.select("id", F.col("id").alias("component")).limit(0)
    return state.classes


def classified(docs: DataFrame, id_col: str, text_col: str, similarity: float) -> tuple[DataFrame, DataFrame, WorkFolder]:
    """Rows of ``docs`` as (id, copy), and (copy, class_id, stays) of every distinct text.

    The class is NULL where no row of it has an id. ``stays`` marks one text of each class, the
    smallest digest of those under its smallest id.
    """
    spark = docs.sparkSession
    folder = WorkFolder(spark, "near_duplicates")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), digest(F.col(text_col)).alias("copy"))
    signed = folder.write(sign(rows), "signed")
    known = signed.filter("copy IS NOT NULL")
    # Rows of a text have equal bands. Numbers of distinct texts are fixed once they are written.
    copies = known.groupBy("copy").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    copies = folder.write(copies.withColumn("node", F.monotonically_increasing_id()), "copies")
    reps = copies.filter("n > 0").select(F.col("node").alias("id"), "n", "bands")
    buckets = reps.select("id", F.posexplode("bands").alias("band", "key"))
    shared = buckets.groupBy("band", "key").agg(F.count("*").alias("held")).filter("held > 1")
    shared = folder.write(shared.select("band", "key", "held"), "shared")
    met = folder.write(buckets.join(join_side(shared), ["band", "key"]).select("id", "band", "key", "held"), "met")
    sets = folder.write(sets_of(rows, copies, met.select("id").distinct(), folder), "sets")
    classes = similar_classes(met, join_side(reps.select("id", "n")), sets, folder, similarity)
    joined = folder.write(
        copies.join(join_side(classes).withColumnRenamed("id", "node"), "node", "left").select("copy", "rep", F.coalesce("component", "node").alias("component")),
        "joined",
    )
    # The smallest id and a text under it name a class; ids go before rows without one.
    first = joined.groupBy("component").agg(F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "copy")).alias("first"))
    first = first.select("component", F.col("first.rep").alias("class_id"), F.col("first.copy").alias("first")).repartition("component", "first")
    texts = folder.write(
        joined.join(first, "component").select("copy", "class_id", (F.col("copy") == F.col("first")).alias("stays")), "texts"
    )
    folder.drop("copies", "needed", "shared", "central", "sides", "plan", "rare", "met", "sets", "joined", "beyond", "large", "one", "rest")
    return signed.select("id", "copy"), texts, folder


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(id, class_id) of every row of ``docs``."""
    signed, texts, folder = classified(docs, id_col, text_col, similarity)
    result = folder.write(
        signed.join(texts, "copy", "left").select("id", F.when(F.col("id").isNotNull(), F.coalesce("class_id", "id")).alias("class_id")), "result"
    )
    folder.drop("signed", "texts")
    return result.withColumnRenamed("id", id_col)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The documents without near-duplicates: of each class one row stays, with the smallest id.

    Of texts of a class that share this id, the one with the smallest digest stays; of equal rows,
    one. A class without any id keeps one row. NULL texts stay, once per id, and all without an id.
    """
    _, texts, folder = classified(docs, id_col, text_col, similarity)
    key, copy = fresh(docs, "near_key", "near_copy")
    keyed = docs.withColumns({key: row_key(F.col(id_col)), copy: digest(F.col(text_col))})
    keep = texts.filter("stays").select(row_key(F.col("class_id")).alias(key), F.col("copy").alias(copy))
    kept = keyed.filter(F.col(text_col).isNotNull()).join(keep, [key, copy], "left_semi").dropDuplicates([key, copy])
    blank = docs.filter(F.col(text_col).isNull())
    blank_once = blank.filter(F.col(id_col).isNotNull()).dropDuplicates([id_col])
    folder.drop("signed")
    return kept.select(*docs.columns).unionByName(blank_once).unionByName(blank.filter(F.col(id_col).isNull()))


def op7_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_duplicates(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))
