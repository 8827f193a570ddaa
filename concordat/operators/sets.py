"""Sets of ids, distinct lists and aligned comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def id_set_ops(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Every id of either side with its place: both, left only or right only.

    One full join of two distinct lists answers intersection and both
    differences at once.
    """
    a = left.select(key).where(F.col(key).isNotNull()).distinct().withColumn("__a", F.lit(True))
    b = right.select(key).where(F.col(key).isNotNull()).distinct().withColumn("__b", F.lit(True))
    both = a.join(b, key, "full_outer")
    place = F.when(F.col("__b").isNull(), "GAUCHE").when(F.col("__a").isNull(), "DROITE").otherwise("COMMUN")
    return both.select(key, place.alias("place"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-blank values in order."""
    value = F.btrim(F.col(column))
    return df.select(value.alias(column)).where(F.coalesce(column, F.lit("")) != "").distinct().orderBy(column)
