"""Top rows, versions, duplicates and comparisons along an order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordat.functions import run_date
from concordat.operators.common import first_row, lookup_join


def latest_version(df: DataFrame, keys: Sequence[str], version: Sequence[Column]) -> DataFrame:
    """Newest version of every key; ``version`` is a total descending order."""
    return first_row(df, keys, version)


def oldest_per_partition(df: DataFrame, keys: Sequence[str], age: str, tie: Sequence[Column]) -> DataFrame:
    """Row with the greatest age per key, unknown ages last."""
    return first_row(df, keys, [F.col(age).desc_nulls_last(), *tie])


def distinct_per_partition(df: DataFrame, key: str, value: Column, name: str) -> DataFrame:
    """Number of distinct non-null values per key, on every row.

    Counted once per key and joined back: a window would have to hold a whole
    key in one task.
    """
    counts = df.where(value.isNotNull()).groupBy(key).agg(F.countDistinct(value).alias(name))
    return lookup_join(df, counts, [key]).withColumn(name, F.coalesce(name, F.lit(0)))


def duplicates_keep_all(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs more than once."""
    several = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__n")).where("__n > 1")
    return lookup_join(df, several.select(key), [key], "left_semi")


def top_n_per_dim(df: DataFrame, dim: str, label: str, count: str, n: int) -> DataFrame:
    """The ``n`` largest labels of every dimension; ties by label."""
    rank = F.row_number().over(Window.partitionBy(dim).orderBy(F.col(count).desc(), F.col(label)))
    return df.withColumn("__rn", rank).where(F.col("__rn") <= n).drop("__rn")


def top_n(df: DataFrame, label: str, count: str, n: int) -> DataFrame:
    """The ``n`` largest labels overall."""
    return df.orderBy(F.col(count).desc(), F.col(label)).limit(n)


def last_n_runs(runs: DataFrame, n: int, up_to: str | None = None, column: str = "flux_id") -> DataFrame:
    """Newest ``n`` runs by their date, optionally not after a day."""
    day = run_date(F.col(column))
    rows = runs.withColumn("__day", day).where("__day is not null")
    if up_to is not None:
        rows = rows.where(F.col("__day") <= F.lit(up_to).cast("date"))
    return rows.orderBy(F.col("__day").desc()).limit(n).drop("__day")


def ordered_by_label(df: DataFrame, column: str, labels: Sequence[str]) -> DataFrame:
    """Order by a fixed label sequence; other labels last, by name."""
    position = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(column))
    return df.withColumn("position", F.when(position > 0, position)).orderBy(F.col("position").asc_nulls_last(), column)


def share_of_total(df: DataFrame, group: str, value: str) -> DataFrame:
    """Share of each row in its group and in everything.

    Totals are aggregates joined back, so no group has to fit one task.
    """
    by_group = df.groupBy(group).agg(F.sum(value).alias("__g"))
    grand = df.agg(F.sum(value).alias("__t"))
    rows = lookup_join(df, by_group, [group]).crossJoin(F.broadcast(grand))  # one row
    num = F.col(value).cast("double")
    return rows.select(
        *df.columns,
        F.try_divide(num, F.col("__g").cast("double")).alias("share_group"),
        F.try_divide(num, F.col("__t").cast("double")).alias("share_total"),
    )
