"""Mixing sources to target weights along a time-varying curriculum, in DataFrame operations only.

Targets: sources in code point order (NULL last) weigh 1, 2, 3, repeating, and share all words by
weight; a source stops at ``MAX_REPEATS`` times its size, and what is over is shared again among
the rest. Sorted by size per weight, capped sources come first, so one cumulative sum finds the
level at which nothing is above its cap.

Words of a source are taken in passes over its documents, in the order of a digest of their ids.
In the last pass, documents longer than its share are passed over, and the others are taken while
they fit; then, size by size, the largest documents behind them that still fit what is left, until
none does. A source is short of its target by less than any document that its last pass left out.
A document's place in its source's stream is its cumulative token demand.

Curriculum: over training time t in [0, 1], source weights change from ``early`` to ``late``
(piecewise linear). Integrated and scaled to the target, a schedule gives the words a source has
supplied by time t; inverting it at a document's cumulative demand gives its training position.
Copies are range-sorted by position.

Skew: documents are dealt by (source, 3 hex digits of the digest), so one source with a third of
all rows lies in up to 4096 groups; offsets of groups come from sums that are aggregated before
they are shuffled. Per-source tables have one row per source and group.

NULL and empty texts have size 0 and are taken as 0 words. Rows that repeat a doc_id count each
on their own. A NULL doc_id is ordered like the text "null". Other columns, whatever their
names, are passed on or ignored. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.common import WorkFolder, fresh, table, word_count

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
# (weight at t = 0, weight at t = 1) of a source's schedule, repeating in source order.
SCHEDULES = ((1.0, 1.0), (1.5, 0.5), (0.5, 1.5))
PREFIX = 3


def source_targets(sizes: DataFrame) -> DataFrame:
    """Targets of ``sizes`` (source_key, source_size), one row per source.

    ``source_key`` sorts as the sources do. All sources meet in one task: they are a few
    numbers each.
    """
    order, everything = Window.orderBy("source_key"), Window.partitionBy()
    n = len(WEIGHTS)
    weighed = sizes.withColumn("_n", (F.row_number().over(order) - 1) % n).select(
        "*",
        F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("_n") + 1)).cast("long").alias("weight"),
        F.element_at(F.array(*[F.lit(e) for e, _ in SCHEDULES]), (F.col("_n") % len(SCHEDULES) + 1)).alias("early"),
        F.element_at(F.array(*[F.lit(e) for _, e in SCHEDULES]), (F.col("_n") % len(SCHEDULES) + 1)).alias("late"),
        F.sum("source_size").over(everything).alias("_total"),
    )
    # A source is capped if, with all sources of less size per weight capped, it still is above its cap.
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), "source_key")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("_total") - MAX_REPEATS * F.coalesce(F.sum("source_size").over(before), F.lit(0))).cast("double") / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    capped = F.col("_level") * F.col("weight") >= MAX_REPEATS * F.col("source_size")
    levels = weighed.withColumn("_level", level).withColumn("_capped", capped)
    open_level = F.min(F.when(~F.col("_capped"), F.struct(F.col("source_size") / F.col("weight"), "source_key", "_level"))).over(everything)
    target = F.when(F.col("_capped"), (MAX_REPEATS * F.col("source_size")).cast("double")).otherwise(
        open_level["_level"] * F.col("weight")
    )
    return levels.select("source_key", "source_size", "weight", "early", "late", target.alias("target"))


def position_of(share: Column, early: Column, late: Column) -> Column:
    """Time at which a linear schedule has supplied ``share`` of its words.

    The integral of early + (late - early) t, scaled to end at 1, is inverted; the form without
    a difference in the denominator also holds for constant schedules.
    """
    area = (early + late) / 2
    return 2 * area * share / (early + F.sqrt(F.greatest(early * early + 2 * (late - early) * area * share, F.lit(0.0))))


def last_pass(sizes: DataFrame, folder: WorkFolder) -> DataFrame:
    """What the plan needs to know of a group: one row per (source_key, group) of ``sizes``.

    ``sizes`` (source_key, group, digest, id, size) has a row per document. ``before`` and
    ``open_before`` are the words of the groups before: of all documents, and of those that the
    last pass can hold. ``fill`` maps the offset of a document that fills the rest to its demand.
    """
    keys = ["source_key", "group"]
    in_source = Window.partitionBy("source_key").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    total = lambda name: F.coalesce(F.sum(name).over(in_source), F.lit(0))
    groups = sizes.groupBy(*keys).agg(F.sum("size").alias("_sum")).withColumn("before", total("_sum"))
    targets = source_targets(groups.groupBy("source_key").agg(F.sum("_sum").alias("source_size")))
    # Whole passes, then what is left for the last one.
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    passes = F.least(passes, F.lit(MAX_REPEATS))
    left = F.when(passes < MAX_REPEATS, F.floor(F.col("target") - passes * F.col("source_size"))).otherwise(0)
    starts = groups.drop("_sum").join(targets.withColumns({"passes": passes, "left": left}), "source_key")
    starts = folder.write(starts.drop("weight"), "targets")

    size = F.col("size")
    open_size = F.when((size > 0) & (size <= F.col("left")), size)
    in_group = Window.partitionBy(*keys).orderBy("digest", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.join(starts.select(*keys, "before", "left").hint("shuffle_hash"), keys).select(
        *keys, "size", "left", open_size.alias("open_size"),
        (F.coalesce(F.sum("size").over(in_group), F.lit(0)) + F.col("before")).alias("offset"),
        F.coalesce(F.sum(open_size).over(in_group), F.lit(0)).alias("open_offset"),
    ).filter("open_size IS NOT NULL")
    sums = placed.groupBy(*keys).agg(F.sum("open_size").alias("_open")).withColumn("open_before", total("_open"))
    placed = placed.join(sums.select(*keys, "open_before").hint("shuffle_hash"), keys)
    placed = folder.write(placed.select(*keys, "size", "left", "offset", (F.col("open_before") + F.col("open_offset") + size <= F.col("left")).alias("fits")), "placed")

    # Sums per source are spread over its groups, so documents stay dealt by group.
    taken = placed.groupBy(*keys).agg(F.sum(F.when(F.col("fits"), size).otherwise(0)).alias("_taken"))
    taken = taken.select(*keys, F.sum("_taken").over(Window.partitionBy("source_key")).alias("taken"))
    rest = placed.filter("NOT fits").join(taken.hint("shuffle_hash"), keys).filter("size <= left - taken")
    counts = folder.write(
        rest.groupBy(*keys, "size").agg(F.count("*").alias("docs"), F.first("left").alias("left"), F.first("taken").alias("taken")), "counts"
    )
    # The largest sizes first, as many documents of each as fit.
    entry = "struct<size: bigint, docs: bigint, at: bigint>"
    nothing = F.struct(F.lit(0).cast("long").alias("used"), F.array().cast(f"array<{entry}>").alias("chosen"))

    def take(state: Column, x: Column) -> Column:
        n = F.least(x["docs"], F.floor((F.col("_rest") - state["used"]) / x["size"])).cast("long")
        more = F.array(F.struct(x["size"].alias("size"), n.alias("docs"), state["used"].alias("at")).cast(entry))
        return F.struct((state["used"] + n * x["size"]).alias("used"), F.when(n > 0, F.concat(state["chosen"], more)).otherwise(state["chosen"]).alias("chosen"))

    chosen = (
        counts.groupBy("source_key", "size").agg(F.sum("docs").alias("docs"), F.first("left").alias("left"), F.first("taken").alias("taken"))
        .groupBy("source_key").agg(F.sort_array(F.collect_list(F.struct("size", "docs")), asc=False).alias("_sizes"), F.first(F.col("left") - F.col("taken")).alias("_rest"))
        .select("source_key", F.explode(F.aggregate("_sizes", nothing, take)["chosen"]).alias("_c"))
        .select("source_key", "_c.size", F.col("_c.docs").alias("wanted"), "_c.at")
    )
    # Documents of one size are taken in digest order.
    ranked = Window.partitionBy("source_key", "size").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    wanted = (
        counts.join(chosen.repartition("source_key", "size", "wanted"), ["source_key", "size"])
        .select(*keys, "size", "wanted", "at", "taken", F.coalesce(F.sum("docs").over(ranked), F.lit(0)).alias("rank"))
        .filter("rank < wanted")
    )
    of_size = Window.partitionBy(*keys, "size").orderBy("offset")
    fill = (
        placed.filter("NOT fits").join(wanted, [*keys, "size"])
        .withColumn("rank", F.col("rank") + F.row_number().over(of_size) - 1)
        .filter("rank < wanted")
        .groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("offset", (F.col("taken") + F.col("at") + F.col("rank") * size).alias("at")))).alias("fill"))
    )
    out = starts.join(sums.select(*keys, "open_before"), keys, "left").join(fill, keys, "left")
    out = folder.write(out.withColumn("open_before", F.coalesce("open_before", F.lit(0))), "starts")
    folder.drop("placed", "counts", "targets")
    return out


# Columns that a plan adds to documents.
PLAN = ("mix_source_key", "mix_group", "mix_size", "mix_digest", "mix_offset", "mix_source_size", "mix_target", "mix_copies", "mix_early", "mix_late", "mix_last_at")


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the columns of PLAN, and their names there (changed where they clash)."""
    names = dict(zip(PLAN, fresh(docs, *PLAN)))
    c = {k: F.col(v) for k, v in names.items()}
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).cast("binary"))
    rows = docs.withColumns({
        names["mix_size"]: word_count(F.col(text_col)),
        names["mix_digest"]: digest,
        # Code point order with NULL last.
        names["mix_source_key"]: F.coalesce(F.concat(F.lit("a"), F.col(source_col)), F.lit("b")),
    }).withColumn(names["mix_group"], F.substring(names["mix_digest"], 1, PREFIX))

    keys = [names["mix_source_key"], names["mix_group"]]
    folder = WorkFolder(docs.sparkSession, "mixing")
    sizes = rows.select(
        c["mix_source_key"].alias("source_key"), c["mix_group"].alias("group"), c["mix_digest"].alias("digest"),
        F.col(id_col).alias("id"), c["mix_size"].alias("size"),
    )
    starts = last_pass(folder.write(sizes, "sizes"), folder)
    folder.drop("sizes")
    known = ["passes", "left", "before", "open_before", "fill"]
    k = dict(zip(known, fresh(rows, *(f"mix_{x}" for x in known))))
    starts = starts.select(
        F.col("source_key").alias(keys[0]), F.col("group").alias(keys[1]),
        F.col("source_size").alias(names["mix_source_size"]), F.col("target").alias(names["mix_target"]),
        F.col("early").alias(names["mix_early"]), F.col("late").alias(names["mix_late"]),
        *(F.col(x).alias(k[x]) for x in known),
    )
    passes, left, before, open_before, fill = (F.col(k[x]) for x in known)
    in_group = Window.partitionBy(*keys).orderBy(names["mix_digest"], F.col(id_col), names["mix_size"]).rowsBetween(Window.unboundedPreceding, -1)
    size = c["mix_size"]
    is_open = (size > 0) & (size <= left)
    [open_at] = fresh(rows, "mix_open_at")
    placed = rows.join(starts.hint("shuffle_hash"), keys).withColumns({
        names["mix_offset"]: F.coalesce(F.sum(size).over(in_group), F.lit(0)) + before,
        open_at: F.coalesce(F.sum(F.when(is_open, size)).over(in_group), F.lit(0)) + open_before,
    })
    # A document's place in the last pass, if it has one.
    place = F.when(is_open & (F.col(open_at) + size <= left), F.col(open_at)).when(is_open, F.try_element_at(fill, c["mix_offset"]))
    out = (
        placed.withColumn(names["mix_last_at"], passes * c["mix_source_size"] + place)
        .withColumn(names["mix_copies"], F.when(size > 0, passes + c["mix_last_at"].isNotNull().cast("long")).otherwise(F.lit(0)).cast("long"))
        .drop(open_at, *k.values())
    )
    return out, names


def copy_position(names: dict[str, str], copy: Column) -> Column:
    """Training position of a document's copy, 0 for the first."""
    c = {k: F.col(v) for k, v in names.items()}
    demand = copy * c["mix_source_size"] + c["mix_offset"]
    demand = F.when(c["mix_last_at"].isNotNull() & (copy == c["mix_copies"] - 1), c["mix_last_at"]).otherwise(demand)
    return position_of(F.least(demand / c["mix_target"], F.lit(1.0)), c["mix_early"], c["mix_late"])


def training_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row of ``docs`` per copy that the mix takes, range-sorted by training position."""
    plan, names = mix_plan(docs, id_col, text_col, source_col)
    copy, position = fresh(plan, "mix_copy", "mix_position")
    copies = (
        plan.filter(F.col(names["mix_copies"]) > 0)
        .withColumn(copy, F.explode(F.sequence(F.lit(0).cast("long"), F.col(names["mix_copies"]) - 1)))
        .withColumn(position, copy_position(names, F.col(copy)))
    )
    keys = [F.col(position), F.col(names["mix_digest"]), F.col(copy)]
    return copies.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*docs.columns)


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per document what the mix takes, range-sorted by the position of its first copy.

    Documents that are not taken have no position; they are sorted behind the others.
    """
    plan, names = mix_plan(docs.select(id_col, text_col, source_col), id_col, text_col, source_col)
    c = {k: F.col(v) for k, v in names.items()}
    position = F.when(c["mix_copies"] > 0, copy_position(names, F.lit(0)))
    rows = plan.select(
        F.col(id_col), c["mix_size"].alias("size"), c["mix_source_size"].alias("source_size"), c["mix_target"].alias("target"),
        (c["mix_copies"] * c["mix_size"]).alias("taken"), c["mix_copies"].alias("copies"), position.alias("first_position"),
        c["mix_digest"].alias("_digest"),
    )
    keys = [F.coalesce("first_position", F.lit(2.0)), F.col("_digest")]
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_digest")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"))
