"""Building blocks shared by the operators.

Skew policy: one key may hold a large share of all rows.  Aggregates combine
on the map side; top-1 windows are pruned on the map side by Spark's group
limit; look-ups go through :func:`lookup_join`, whose exchange adaptive
execution can split.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordat.functions import pct2

_HASH = "__key_hash"


def lookup_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``left`` to a side that holds each key once.

    A side that comes out of an aggregate is already hashed on the key, and
    Spark would reuse that layout; adaptive execution can then not split a
    hot key of ``left``.  Adding a hash of the key to the condition makes both
    sides ordinary exchanges, so hot keys are split and small sides broadcast.
    """
    keys = list(on)
    lhs = left.withColumn(_HASH, F.xxhash64(*keys))
    rhs = right.withColumn(_HASH, F.xxhash64(*keys))
    return lhs.join(rhs, [_HASH, *keys], how).drop(_HASH)


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given total order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rn", rank).where("__rn = 1").drop("__rn")


def count_where(cond: Column) -> Column:
    """Number of rows satisfying a condition."""
    return F.count_if(F.coalesce(cond, F.lit(False)))


def any_where(cond: Column) -> Column:
    """True when a row of the group satisfies the condition."""
    return F.coalesce(F.max(cond), F.lit(False))


def facts(row: DataFrame, measures: Mapping[str, tuple[str, str] | str]) -> DataFrame:
    """Turn a one-row aggregate into ``(indicator, nombre, pct, base)`` rows.

    ``measures`` maps an indicator to a column, or to a column and its base.
    """
    rows = []
    for name, spec in measures.items():
        col, base = (spec, None) if isinstance(spec, str) else spec
        pct = F.lit(None).cast("double") if base is None else pct2(F.col(col), F.col(base))
        den = F.lit(None).cast("bigint") if base is None else F.col(base).cast("bigint")
        rows.append(
            F.struct(
                F.lit(name).alias("indicator"),
                F.col(col).cast("bigint").alias("nombre"),
                pct.alias("pct"),
                den.alias("base"),
            )
        )
    return row.select(F.inline(F.array(*rows)))


def spread(values: Sequence[str], on: Column, measure: Column, lower: bool = False) -> list[Column]:
    """One conditional sum per fixed value: a pivot in a single aggregate."""
    out = []
    for value in values:
        name = value.lower() if lower else value
        out.append(F.sum(F.when(on == value, measure).otherwise(F.lit(0))).cast("bigint").alias(name))
    return out


def views(base: DataFrame, labels: Mapping[str, Column], measures: Sequence[str]) -> DataFrame:
    """Several roll-ups of one small aggregate as ``(view, label, measures)`` rows.

    Each base row is handed to every view whose label it has (NULL leaves it
    out), then summed once, so the input of ``base`` is computed a single time.
    """
    cells = F.array(*[F.struct(F.lit(v).alias("view"), c.cast("string").alias("label")) for v, c in labels.items()])
    rows = base.select(F.inline(cells), *measures).where("label is not null")
    return rows.groupBy("view", "label").agg(*[F.sum(m).cast("bigint").alias(m) for m in measures])
