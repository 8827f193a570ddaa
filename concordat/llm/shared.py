"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordat.session import materialize

#: Separators of words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def saved(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Used where one intermediate result feeds several branches or a loop: the branches share one
    computation, lineage ends at the files, and a lost executor costs nothing but a re-read.  The
    files go when the session's Python exits.
    """
    return materialize(df)


def slot_column(key: Column, text: Column, slots: int) -> Column:
    """The same as ``wordvec.slots_of`` for rows with a key and a text."""
    tie = F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
    return F.pmod(F.pmod(key, F.lit(slots)) + tie, F.lit(slots)).cast("int")


def words_of(text: Column) -> Column:
    """Array of the words of a text; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def rows_of(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[list]]:
    """The named columns of each Arrow batch as Python lists."""
    for batch in batches:
        yield [batch.column(n).to_pylist() for n in names]


def ranked(df: DataFrame, name: str, order: Column) -> DataFrame:
    """Add ``rank`` (from 0) by ``order``, an order of the unique column ``name``, and ``of``, the number of rows.

    Rows are dealt by range and ranked inside each part; only the parts' sizes are added up in one
    task.  Equal rows are not told apart.
    """
    parts = materialize(df.repartitionByRange(order).withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = parts.groupBy("part").agg(F.count("*").alias("rows"))
    sizes = sizes.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"), F.sum("rows").over(Window.partitionBy()).alias("of"))
    inside = parts.withColumn("rank", F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1)
    return inside.join(sizes, "part").withColumn("rank", F.col("rank") + F.col("before")).drop("part", "before")
