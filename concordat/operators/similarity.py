"""Name similarity, the one measure built-in expressions cannot give."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")


def _ends(a: Column, b: Column) -> Column:
    """Length of the longer of the common beginning and the common end."""
    n = F.least(F.length(a), F.length(b))

    def run(x: Column, y: Column) -> Column:
        places = F.filter(F.sequence(F.lit(1), n), lambda i: F.substr(x, i, F.lit(1)) != F.substr(y, i, F.lit(1)))
        return F.when(n == 0, F.lit(0)).otherwise(F.coalesce(F.try_element_at(places, F.lit(1)) - 1, n))

    return F.greatest(run(a, b), run(F.reverse(a), F.reverse(b)))


def _shared(a: Column, b: Column) -> Column:
    """Number of characters that two texts share, counted with their repeats."""
    letters = F.array_distinct(F.split(a, ""))
    times = lambda x, c: F.length(x) - F.length(F.replace(x, c, F.lit("")))
    each = F.transform(F.filter(letters, lambda c: c != ""), lambda c: F.least(times(a, c), times(b, c)))
    return F.aggregate(each, F.lit(0), lambda s, x: s + x)


def ratio_bounds(a: Column, b: Column) -> tuple[Column, Column]:
    """Bounds of the matching ratio, from built-in expressions.

    Matched characters are shared characters, and the first block matched is at least as long as a common
    beginning or end.
    """
    a, b = F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))
    both = F.length(a) + F.length(b)
    ratio = lambda n: F.when(both == 0, F.lit(1.0)).otherwise(n * F.lit(2.0) / both)
    return ratio(_ends(a, b)), ratio(_shared(a, b))


def similarity_bounds(last_a: Column, last_b: Column, first_a: Column, first_b: Column) -> tuple[Column, Column]:
    """Bounds of :func:`name_similarity`."""
    known = (F.coalesce(first_a, F.lit("")) != "") & (F.coalesce(first_b, F.lit("")) != "")
    last, first = ratio_bounds(last_a, last_b), ratio_bounds(first_a, first_b)
    low, high = ((x + F.when(known, y).otherwise(F.lit(1.0))) / 2 for x, y in zip(last, first, strict=True))
    return low, high


def name_similarity(last_a: Column, last_b: Column, first_a: Column, first_b: Column) -> Column:
    """Mean of last and first name matching ratios; a missing first name counts as equal."""
    known = (F.coalesce(first_a, F.lit("")) != "") & (F.coalesce(first_b, F.lit("")) != "")
    first = F.when(known, _ratio(F.coalesce(first_a, F.lit("")), F.coalesce(first_b, F.lit("")))).otherwise(1.0)
    return (_ratio(F.coalesce(last_a, F.lit("")), F.coalesce(last_b, F.lit(""))) + first) / 2
