"""Helpers that the training-data operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import WorkFolder  # noqa: F401

# Bytes of text that a Python worker handles at once; one longer text is handled alone.
SLICE_BYTES = 4 << 20
# Rows up to which a table of counts, minima or classes is broadcast to a join.
SMALL_ROWS = 50_000
# Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def join_side(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A narrow, stored table as a side of a join: broadcast while it is small, else a scan, so that the join may split a hot key."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= SMALL_ROWS else df


def text_slices(
    batches: Iterable[pa.RecordBatch], name: str = "text", most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of a piece have about ``most`` bytes."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def replaced(batch: pa.RecordBatch, **columns: list) -> pa.RecordBatch:
    """The batch with the values of some columns exchanged, types and order as they are."""
    return pa.RecordBatch.from_arrays(
        [
            pa.array(columns[f.name], f.type) if f.name in columns else batch.column(i)
            for i, f in enumerate(batch.schema)
        ],
        schema=batch.schema,
    )


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def with_file_order(docs: DataFrame, columns: list[str], part: str, row: str) -> DataFrame:
    """``columns`` of ``docs`` with the number of each row's part file and its place in that file.

    A task reads files in any order; ascending (part, row) is the order in which a range sort
    wrote them. A frame that does not read files directly is numbered by partition and row.
    """
    try:
        meta = docs.metadataColumn("_metadata")
        number = F.regexp_extract(meta["file_name"], r"^part-(\d+)", 1)
        return docs.select(*columns, F.nullif(number, F.lit("")).cast("long").alias(part), meta["row_index"].alias(row))
    except AnalysisException:
        place = F.monotonically_increasing_id()
        return docs.select(*columns, F.shiftright(place, 33).alias(part), place.bitwiseAND((1 << 33) - 1).alias(row))


def word_count(text: Column) -> Column:
    """Words of a text as a long; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
