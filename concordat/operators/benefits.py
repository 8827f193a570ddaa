"""Benefit volumes by offer: pivots and the daily summary.

Rows: date_arrivee (yyyyMMdd), offer, nature, societe, origin, state, nb.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.operators.common import spread

# Natures of the pivots.
CARE_NATURES = ("MSP", "EFS", "MAEE", "CULTURE", "JA", "MEAE", "MEN", "NUANCE", "MSOL")
PROTECTION_NATURES = ("PREV_INDIV", "PREV_MEAE", "PREV_CULTURE", "PREV_MEN")
NO_OFFER = "__SANS_OFFRE__"


def fixed_pivot(df: DataFrame, rows: Sequence[str], on: Column, values: Sequence[str], total: str | None = "Total") -> DataFrame:
    """Sum of ``nb`` by row keys and one column per fixed value, with a row total over them."""
    out = df.groupBy(*rows).agg(*spread(values, on, F.col("nb")))
    if total:
        out = out.withColumn(total, sum((F.col(f"`{v}`") for v in values), F.lit(0).cast("bigint")))
    return out


def offer_by_state(df: DataFrame, states: Sequence[str]) -> DataFrame:
    return fixed_pivot(df, ["offer", "nature"], F.col("state"), states)


def day_by_nature(df: DataFrame) -> DataFrame:
    return fixed_pivot(df.where(~F.col("nature").isin(*PROTECTION_NATURES)), ["date_arrivee"], F.col("nature"), CARE_NATURES)


def day_by_protection(df: DataFrame) -> DataFrame:
    return fixed_pivot(df.where(F.col("nature").isin(*PROTECTION_NATURES)), ["date_arrivee"], F.col("nature"), PROTECTION_NATURES)


def day_by_nature_state(df: DataFrame, societe: str, natures: Sequence[str], states: Sequence[str]) -> DataFrame:
    """One company: days by nature and state."""
    rows = df.where(F.col("societe") == societe)
    return fixed_pivot(rows, ["date_arrivee"], F.concat_ws("-", "nature", "state"), [f"{n}-{s}" for n in natures for s in states])


def day_by_state_of_nature(df: DataFrame, nature: str, states: Sequence[str]) -> DataFrame:
    """All offers of one nature: days by state."""
    return fixed_pivot(df.where(F.col("nature") == nature), ["date_arrivee"], F.col("state"), states, None)


def origin_offer_by_state(df: DataFrame, states: Sequence[str]) -> DataFrame:
    return fixed_pivot(df, ["origin", "offer"], F.col("state"), states)


def day_by_origin(df: DataFrame, nature: str, origins: Sequence[str]) -> DataFrame:
    return fixed_pivot(df.where(F.col("nature") == nature), ["date_arrivee"], F.col("origin"), origins, None)


def benefits_pivots(df: DataFrame, states: Sequence[str], origins: Sequence[str]) -> dict[str, DataFrame]:
    """All pivots by sheet name."""
    return {
        "TCD1": offer_by_state(df, states),
        "Prestations par offre": day_by_nature(df),
        "Prévoyance": day_by_protection(df),
        "Ste 010": day_by_nature_state(df, "010", ("MEN", "MEAE"), states),
        "Ste 044": day_by_nature_state(df, "044", ("PREV_INDIV", "MSP"), states),
        "Ste 052": day_by_state_of_nature(df, "MSOL", states),
        "TCD2": origin_offer_by_state(df, states),
        "MEN_ORIGINE": day_by_origin(df, "MEN", origins),
    }


def as_cells(sheet: str, pivot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Long cells ``(sheet, row_key, col_key, value)`` of a wide pivot."""
    values = [c for c in pivot.columns if c not in keys]
    row = F.concat_ws("|", *keys).alias("row_key")
    cells = F.array(*[F.struct(F.lit(v).alias("col_key"), F.col(f"`{v}`").cast("bigint").alias("value")) for v in values])
    return pivot.select(F.lit(sheet).alias("sheet"), row, F.inline(cells))


def benefits_daily_summary(df: DataFrame) -> DataFrame:
    """Last day: dossiers by nature and by company; and all dossiers without offer.

    The last day comes from the rows of care natures, as a one-row table.
    """
    last = df.where(~F.col("nature").isin(*PROTECTION_NATURES)).agg(F.max("date_arrivee").alias("last_day"))
    today = df.join(F.broadcast(last), F.col("date_arrivee") == F.col("last_day"), "left_semi")  # one row
    care = today.where(F.col("nature").isin(*CARE_NATURES))
    nb = F.sum("nb").cast("bigint").alias("nb")
    out = care.groupBy(F.lit("NATURE").alias("view"), F.col("nature").alias("label")).agg(nb)
    out = out.unionByName(care.groupBy(F.lit("TOTAL").alias("view"), F.lit("").alias("label")).agg(nb))
    out = out.unionByName(today.groupBy(F.lit("SOCIETE").alias("view"), F.col("societe").alias("label")).agg(nb))
    bare = df.where(F.col("offer") == NO_OFFER).groupBy(F.lit("SANS_OFFRE").alias("view"), F.lit("").alias("label")).agg(nb)
    return out.unionByName(bare)
