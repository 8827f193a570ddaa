"""Codes, numbers and rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from concordat.functions.text import squeeze


def zero_pad_code(col: Column, width: int = 3) -> Column:
    """Left-pad with zeros without ever cutting a longer code."""
    text = squeeze(col)
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def lenient_number(col: Column, default: float | None = 0.0) -> Column:
    """Number of a text; ``default`` when it is none."""
    value = squeeze(col).try_cast("double")
    return value if default is None else F.coalesce(value, F.lit(default))


def embedded_number(col: Column) -> Column:
    """Integer after the last colon at the end of a label (thin spaces allowed)."""
    raw = F.regexp_extract(col, "(?s):\\s*(\\d[\\d\\s ]*)\\s*$", 1)
    return F.regexp_replace(raw, "[\\s ]", "").try_cast("bigint")


def ratio2(num: Column, den: Column, scale: int = 100) -> Column:
    """``num / den * scale`` rounded half up at two decimals, exactly.

    ``num`` and ``den`` are non-negative whole numbers; integer arithmetic
    keeps the rounding free of floating-point ties.  NULL for an empty base.
    """
    n = num.cast("bigint")
    d = F.nullif(den.cast("bigint"), F.lit(0).cast("bigint"))
    twice = n * F.lit(scale * 200) + d
    whole = (twice - F.try_mod(twice, d * 2)) / (d * 2)
    return whole / F.lit(100.0)


def pct2(num: Column, den: Column) -> Column:
    """Percentage with two decimals; 0 for an empty base."""
    return F.coalesce(ratio2(num, den, 100), F.lit(0.0))


def attrition_rate(current: Column, base: Column) -> Column:
    """Share of the base that is gone; NULL for an empty base."""
    return F.try_divide((base - current).cast("double"), base.cast("double"))
