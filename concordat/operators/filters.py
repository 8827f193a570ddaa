"""Row filters with parameters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.functions import zero_pad_code
from concordat.operators.common import lookup_join
from concordat.operators.normalize import is_insured, is_spouse


def scope_filter(member: DataFrame, role: str) -> DataFrame:
    """Contracts of insured persons (``ASSURE``) or of spouses (``CONJOINT``)."""
    kind = F.col("member_type")
    return member.where(is_insured(kind) if role == "ASSURE" else is_spouse(kind))


def in_days(col: Column, first: str | None, last: str | None = None) -> Column:
    """Day window ``[first, last + 1)`` with literal bounds; ``last`` defaults to ``first``.

    Without ``first`` every row passes.
    """
    if first is None:
        return F.lit(True)
    end = dt.date.fromisoformat(last or first) + dt.timedelta(days=1)
    return (col >= F.lit(first).cast("date")) & (col < F.lit(end.isoformat()).cast("date"))


def day_window_filter(df: DataFrame, column: str, day: str) -> DataFrame:
    """Rows of one day."""
    return df.where(in_days(F.col(column), day))


def week_window_filter(df: DataFrame, key: str, column: str, day: str) -> DataFrame:
    """Keys with at least one row in the seven days ending on ``day``."""
    first = (dt.date.fromisoformat(day) - dt.timedelta(days=6)).isoformat()
    inside = F.count_if(in_days(F.col(column), first, day))
    return df.groupBy(key).agg(F.count("*").alias("rows"), inside.alias("rows_in_week")).where("rows_in_week > 0")


def month_floor_window(df: DataFrame, column: str, back: int = 7) -> DataFrame:
    """Inclusive search window of a run day, and the exclusive bounds written to queries.

    The window starts ``back`` days earlier but never before the first of the
    month, and ends on the last of the month.
    """
    day = F.col(column)
    start = F.greatest(F.date_sub(day, back), F.trunc(day, "MM"))
    end = F.last_day(day)
    return df.select(
        "*",
        start.alias("window_start"),
        end.alias("window_end"),
        F.date_format(F.date_sub(start, 1), "yyyyMMdd").alias("bound_low"),
        F.date_format(F.date_add(end, 1), "yyyyMMdd").alias("bound_high"),
    )


def matches_patterns(col: Column, spec: str) -> Column:
    """Comma list of exact or ``%`` patterns; ``TOUTES`` keeps all, ``NULL`` only missing values."""
    patterns = [p.strip() for p in spec.split(",") if p.strip()]
    if spec.strip().upper() == "TOUTES":
        return F.lit(True)
    cond = F.lit(False)
    for pattern in patterns:
        cond = cond | (col.isNull() if pattern == "NULL" else F.coalesce(col.like(pattern), F.lit(False)))
    return cond


def pattern_list_filter(df: DataFrame, column: str, spec: str) -> DataFrame:
    """Rows that match a short comma list of patterns."""
    return df.where(matches_patterns(F.col(column), spec))


#: Longest piece of a pattern that a value is looked up by where it stands inside.
_INNER = 4


def _anchors(patterns: DataFrame) -> DataFrame:
    """Each LIKE pattern with the literal piece a matching value must hold: ``(pattern, kind, width, piece)``.

    ``E`` the whole value, ``P`` its beginning, ``S`` its end, ``I`` somewhere inside, ``N`` nothing.
    """
    # Literal runs between wildcards; a backslash makes the next sign literal.
    masked = F.regexp_replace("pattern", r"\\(.)", "\ufdd0$1")
    runs = F.transform(F.split(F.regexp_replace(masked, r"(?<!\ufdd0)[%_]", "\ufdd1"), "\ufdd1"), lambda r: F.regexp_replace(r, "\ufdd0", ""))
    p = patterns.select("pattern", runs.alias("runs"))
    first, last = F.element_at("runs", 1), F.element_at("runs", -1)
    inner = F.array_max(F.transform("runs", lambda r: F.struct(F.length(r).alias("n"), r.alias("r"))))["r"]
    piece = (
        F.when(F.size("runs") == 1, F.struct(F.lit("E").alias("kind"), first.alias("piece")))
        .when((first != "") & (F.length(first) >= F.length(last)), F.struct(F.lit("P").alias("kind"), first.alias("piece")))
        .when(last != "", F.struct(F.lit("S").alias("kind"), last.alias("piece")))
        .when(inner != "", F.struct(F.lit("I").alias("kind"), F.substr(inner, F.lit(1), F.lit(_INNER)).alias("piece")))
        .otherwise(F.struct(F.lit("N").alias("kind"), F.lit("").alias("piece")))
    )
    return p.select("pattern", piece.alias("a")).select("pattern", "a.kind", F.length("a.piece").alias("width"), "a.piece")


def pattern_table_filter(df: DataFrame, column: str, patterns: DataFrame) -> DataFrame:
    """Rows whose value matches some pattern of a table of any size.

    ``patterns`` has one column of SQL LIKE patterns; ``NULL`` stands for missing values and ``TOUTES`` for all
    rows.  Only distinct values meet the patterns, and only by equality: a value offers itself, its beginnings and
    ends of the lengths that patterns have, and its short inner pieces; what meets a pattern's piece is checked
    by LIKE.  So no pattern is compared with every value.
    """
    given = patterns.select(F.btrim(F.col(patterns.columns[0])).alias("pattern")).where("pattern <> ''").distinct()
    anchors = _anchors(given.where(~F.upper("pattern").isin("NULL", "TOUTES")))
    # One row: the widths that occur for each kind of piece.
    sizes = anchors.groupBy("kind").agg(F.array_sort(F.collect_set("width")).alias("w")).agg(F.map_from_entries(F.collect_list(F.struct("kind", "w"))).alias("w"))
    flags = given.agg(F.coalesce(F.bool_or(F.col("pattern") == "NULL"), F.lit(False)).alias("nulls"), F.coalesce(F.bool_or(F.upper("pattern") == "TOUTES"), F.lit(False)).alias("every"))
    values = df.select(F.col(column).cast("string").alias("v")).where("v IS NOT NULL").distinct().crossJoin(F.broadcast(sizes))  # one row
    n = F.length("v")

    def offers(kind: str, cut) -> Column:
        fitting = F.filter(F.coalesce(F.try_element_at("w", F.lit(kind)), F.array().cast("array<int>")), lambda w: w <= n)
        return F.flatten(F.transform(fitting, lambda w: F.transform(cut(w), lambda x: F.struct(F.lit(kind).alias("kind"), w.alias("width"), x.alias("piece")))))

    v = F.col("v")
    pieces = F.concat(
        F.array(F.struct(F.lit("E").alias("kind"), n.alias("width"), v.alias("piece")), F.struct(F.lit("N").alias("kind"), F.lit(0).alias("width"), F.lit("").alias("piece"))),
        offers("P", lambda w: F.array(F.substr(v, F.lit(1), w))),
        offers("S", lambda w: F.array(F.substr(v, n - w + 1, w))),
        offers("I", lambda w: F.array_distinct(F.transform(F.sequence(F.lit(1), n - w + 1), lambda i: F.substr(v, i, w)))),
    )
    met = values.select("v", F.inline(pieces)).join(anchors, ["kind", "width", "piece"])
    # An exact pattern may hold an escaped sign, so it is checked as well.
    matched = met.where(F.expr("v LIKE pattern")).select("v").distinct()
    rows = lookup_join(df.withColumn("__v", F.col(column).cast("string")), matched.select(F.col("v").alias("__v"), F.lit(True).alias("__hit")), ["__v"])
    rows = rows.crossJoin(F.broadcast(flags))  # one row
    return rows.where(F.col("every") | (F.col("nulls") & F.col("__v").isNull()) | F.col("__hit")).select(*df.columns)


def code_list_filter(df: DataFrame, column: str, codes: Sequence[str], keep: bool = True) -> DataFrame:
    """Rows whose code is (or is not) in a literal list; missing codes never pass."""
    cond = F.col(column).isin(*codes)
    return df.where(cond if keep else ~cond)


def regex_code_filter(df: DataFrame, column: str, pattern: str = r"^0[1-9]\d$") -> DataFrame:
    """Rows whose zero-padded code matches the pattern; the padded code replaces it."""
    return df.withColumn(column, zero_pad_code(F.col(column))).where(F.col(column).rlike(pattern))


def active_version_filter(latest: DataFrame, today: str, state: str = "state", end: str = "end_date") -> DataFrame:
    """Latest versions that are valid or end in the future."""
    return latest.where((F.col(state) == "VA") | (F.col(end) > F.lit(today).cast("date")))
