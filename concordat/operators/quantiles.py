"""Exact percentiles with buffers of bounded size."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concordat.operators.common import lookup_join
from concordat.session import materialize

#: Size of the sketch, and how far to both sides of a rank its bracket reaches (the sketch errs by about 0.0013).
SKETCH, MARGIN = 4096, 0.004


def brackets(rows: DataFrame, key: str, value: str, probs: Mapping[str, float]) -> DataFrame:
    """Per key and percentile: values that enclose it, as ``(key, p, low, high, i, j)``.

    ``i`` and ``j`` are the places (from 0, in order) of the two values a percentile lies between.  The
    sketch only proposes the enclosing values; they are checked by counting and widened to everything
    where they do not enclose both places.  Sketches and counts combine on the map side.
    """
    seen = rows.groupBy(key).agg(F.count("*").alias("n"), F.kll_sketch_agg_double(value, SKETCH).alias("sketch"))
    # Ranks are literals: a sketch is asked for them all at once.
    ends = F.array(*[F.lit(float(min(max(q + d, 0.0), 1.0))) for q in probs.values() for d in (-MARGIN, MARGIN)])
    each = seen.select(key, "n", F.kll_sketch_get_quantile_double("sketch", ends).alias("ends"))
    asked = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(float(q)).alias("q"), F.get("ends", F.lit(2 * k)).alias("low"), F.get("ends", F.lit(2 * k + 1)).alias("high")) for k, (p, q) in enumerate(probs.items())])
    each = each.select(key, "n", F.inline(asked))
    place = (F.col("n") - 1) * F.col("q")
    # A sketch draws random numbers, so its answers are written once and read by both uses.
    each = materialize(each.select(key, "p", "low", "high", place.alias("place"), F.floor(place).alias("i"), F.ceil(place).alias("j")))
    wide = each.groupBy(key).agg(F.collect_list(F.struct("p", "low", "high")).alias("asked"))
    met = lookup_join(rows.select(key, value), wide, [key], "inner").select(key, value, F.inline("asked"))
    counts = met.groupBy(key, "p").agg(
        F.count_if(F.col(value) < F.col("low")).alias("below"), F.count_if(F.col(value) <= F.col("high")).alias("upto")
    )
    checked = each.join(counts, [key, "p"])
    fits = (F.col("below") <= F.col("i")) & (F.col("j") < F.col("upto"))
    return checked.select(
        key, "p", "place", "i", "j",
        F.when(fits, F.col("low")).otherwise(F.lit(float("-inf"))).alias("low"),
        F.when(fits, F.col("high")).otherwise(F.lit(float("inf"))).alias("high"),
        F.when(fits, F.col("below")).otherwise(F.lit(0)).alias("below"),
    )


def exact_percentiles(rows: DataFrame, key: str, value: str, probs: Mapping[str, float]) -> DataFrame:
    """One row per key with one interpolated percentile per name in ``probs``; exact.

    ``rows`` are read three times: to sketch them, to check the brackets, and to count the values inside
    the brackets, under one in a hundred of them unless values are equal, which count as one.  NULL values do
    not count; a key without values has no row.
    """
    known = rows.where(F.col(value).isNotNull())
    found = brackets(known, key, value, probs)
    wide = found.groupBy(key).agg(F.collect_list(F.struct("p", "low", "high", "below", "place", "i", "j")).alias("asked"))
    inside = lookup_join(known.select(key, value), wide, [key], "inner").select(key, value, F.inline("asked"))
    inside = inside.where(F.col(value).between(F.col("low"), F.col("high")))
    cells = inside.groupBy(key, "p", "below", "place", "i", "j", value).agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(key, "p").orderBy(value)) + F.col("below")
    cells = cells.withColumn("upto", upto)
    holds = {c: (F.col("upto") > F.col(c)) & (F.col("upto") - F.col("n") <= F.col(c)) for c in ("i", "j")}
    ends = cells.groupBy(key, "p", "place", "i", "j").agg(*[F.max(F.when(h, F.col(value))).alias("v_" + c) for c, h in holds.items()])
    between = F.when(F.col("i") == F.col("j"), F.col("v_i")).otherwise(
        (F.col("j") - F.col("place")) * F.col("v_i") + (F.col("place") - F.col("i")) * F.col("v_j")
    )
    return ends.groupBy(key).agg(*[F.max(F.when(F.col("p") == p, between)).alias(p) for p in probs])
