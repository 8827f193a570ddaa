"""Subtotals, daily ratios and the table of named post-processors."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.functions import lenient_number

PREFIXES = ("DSI", "GES", "VDC")
# Columns whose rejection ratio is followed, and the one taken from the warehouse.
RATIO_ORIGINS = ("NMASS", "LUMAS", "NMCMU", "TPVIA", "TPHOS", "TPCVM", "OXA")
WAREHOUSE_RATIO = "SELFC"


def subtotal_row_all(df: DataFrame, label: str = "TOTAL_GENERAL", id_cols: int = 2) -> DataFrame:
    """Append one row summing every column after the first ``id_cols``."""
    ids, numbers = df.columns[:id_cols], df.columns[id_cols:]
    total = df.agg(*[F.sum(lenient_number(F.col(c))).cast(df.schema[c].dataType).alias(c) for c in numbers])
    heads = [F.lit(label).alias(ids[0])] + [F.lit("").alias(c) for c in ids[1:]]
    return df.unionByName(total.select(*heads, *numbers))


def subtotal_rows_by_prefix(df: DataFrame, total: str = "Total", prefixes: Sequence[str] = PREFIXES) -> DataFrame:
    """Append one subtotal of ``total`` per code prefix of the first column; other columns are NULL."""
    code = F.col(df.columns[0])
    sums = df.agg(*[F.coalesce(F.sum(F.when(code.startswith(p), lenient_number(F.col(total)))), F.lit(0.0)).alias(p) for p in prefixes])
    rows = F.array(*[F.struct(F.lit(f"TOTAL_{p}*").alias("__code"), F.col(p).alias("__n")) for p in prefixes])
    extra = sums.select(F.inline(rows))
    cols = []
    for field in df.schema.fields:
        if field.name == df.columns[0]:
            cols.append(F.col("__code").alias(field.name))
        elif field.name == total:
            cols.append(F.col("__n").cast(field.dataType).alias(field.name))
        else:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.unionByName(extra.select(*cols))


def daily_block_ratios(matrix: DataFrame, warehouse: DataFrame) -> DataFrame:
    """Per day: rejected over (received minus waiting) by origin and overall; 0 when undefined.

    ``matrix`` holds the claim measures per day, ``warehouse`` the same
    measures counted in the warehouse, both as (requete, day, <origin>...).
    """
    overall = (F.col("TOTAL_AUTO") + F.col("TOTAL_MANUEL"))

    def ratios(df: DataFrame, columns: Mapping[str, object], names: tuple[str, str, str]) -> DataFrame:
        got, waits, bad = names
        picks = [
            F.sum(F.when(F.col("requete") == label, col)).alias(f"{name}__{i}")
            for name, col in columns.items()
            for i, label in enumerate((got, waits, bad))
        ]
        wide = df.groupBy("day").agg(*picks)
        out = []
        for name in columns:
            n = [F.coalesce(F.col(f"{name}__{i}"), F.lit(0)) for i in range(3)]
            out.append(F.coalesce(F.try_divide(n[2].cast("double"), (n[0] - n[1]).cast("double")), F.lit(0.0)).alias(name))
        return wide.select("day", *out)

    main = ratios(matrix, {**{o: F.col(o) for o in RATIO_ORIGINS}, "TOTAL": overall}, ("MDG_Intégrés", "MDG_Attente", "MDG_Rejets"))
    side = ratios(warehouse, {WAREHOUSE_RATIO: F.col(WAREHOUSE_RATIO)}, ("DWH-Intégré", "DWH-Attente", "DWH_Rejets"))
    out = main.join(side, "day", "full_outer")
    return out.select("day", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in (*RATIO_ORIGINS, "TOTAL", WAREHOUSE_RATIO)])


#: Named hooks applied with ``DataFrame.transform``.
POST_PROCESSORS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "sum_total_doublons": subtotal_row_all,
    "sum_boite_prefixes_stock": subtotal_rows_by_prefix,
}


def apply_post_processor(df: DataFrame, name: str | None) -> DataFrame:
    """Run a named hook; an unknown or absent name leaves the rows as they are."""
    hook = POST_PROCESSORS.get(name or "")
    return df.transform(hook) if hook else df


def parameterised_query(
    spark: SparkSession, text: str, defaults: Mapping[str, object], values: Mapping[str, object] | None = None, **tables: DataFrame
) -> DataFrame:
    """Run a catalogue query with named, typed parameters (``:name``), never by text substitution."""
    args = {**defaults, **(values or {})}
    unknown = set(args) - set(defaults)
    if unknown:
        raise ValueError(f"unknown parameters: {sorted(unknown)}")
    return spark.sql(text, args=args, **tables)
