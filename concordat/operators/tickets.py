"""Support tickets: stock, breakdowns, evolution and history.

Stock rows: ticket_id, opened, closed (dates as text), priority, late_time,
state and dimension columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.functions import squeeze
from concordat.operators.common import count_where, lookup_join
from concordat.operators.quantiles import exact_percentiles
from concordat.operators.windows import top_n_per_dim
from concordat.session import materialize

# Target days per priority and values that mean "not late".
SLA_DAYS = {1: 0.5, 2: 1.0, 3: 3.0, 4: 5.0, 5: 10.0}
NOT_LATE = ("", "None", "00:00:00", "0", "nan")
EXCEL_EPOCH = "1899-12-30"


def _pct1(n: Column, d: Column) -> Column:
    return F.coalesce(F.round(F.try_divide(n.cast("double"), d.cast("double")) * 100, 1), F.lit(0.0))


def timed(stock: DataFrame) -> DataFrame:
    """Adds opening and closing times, the duration in days (never negative), priority and target."""
    opened, closed = F.try_to_timestamp(F.col("opened")), F.try_to_timestamp(F.col("closed"))
    days = (F.unix_timestamp(closed) - F.unix_timestamp(opened)) / F.lit(86400.0)
    targets = F.create_map(*[F.lit(x) for pair in SLA_DAYS.items() for x in pair])
    prio = F.col("priority").try_cast("int")
    return stock.select(
        "*", opened.alias("t_open"), closed.alias("t_close"), F.when(days >= 0, days).alias("days"),
        prio.alias("prio"), F.try_element_at(targets, prio).alias("target"),
    )


def ticket_stock_kpis(stock: DataFrame) -> DataFrame:
    """Stock indicators overall and per priority as ``(scope, indicator, value)``.

    Counts and sums combine on the map side; durations are nearly all unlike, so
    their percentiles come from brackets of a sketch (:func:`exact_percentiles`).
    """
    # Read several times below, so the joins behind the tickets run once.
    rows = materialize(timed(stock).select("prio", "days", "target", "t_close", "late_time"))
    late = F.col("late_time").isNotNull() & ~squeeze(F.col("late_time")).isin(*NOT_LATE)
    known = F.col("days").isNotNull()
    judged = known & F.col("target").isNotNull()
    stats = [
        F.count("*").alias("total"), F.count("t_close").alias("clos"), count_where(late).alias("n_en_retard"), F.count("days").alias("n_mesures"),
        count_where(judged).alias("sla_n"), count_where(judged & (F.col("days") <= F.col("target"))).alias("sla_ok"),
        # Whole seconds add up exactly in any order.
        (F.sum(F.round(F.col("days") * 86400).cast("bigint")) / F.lit(86400.0)).alias("sum_days"), F.min("days").alias("min_jours"), F.max("days").alias("max_jours"),
    ]
    scopes = F.array_compact(F.array(F.lit("STOCK"), F.when(F.col("prio").isNotNull(), F.concat(F.lit("P"), F.col("prio").cast("string")))))
    spans = rows.where(known).select(F.explode(scopes).alias("scope"), "days")
    middle = exact_percentiles(spans, "scope", "days", {"mediane": 0.5, "p90": 0.9})
    one = lookup_join(rows.agg(*stats).withColumn("scope", F.lit("STOCK")), middle, ["scope"])
    mean = F.round(F.try_divide(F.col("sum_days"), F.col("n_mesures").cast("double")), 1)
    measures = {
        "total": F.col("total"), "clos": F.col("clos"), "ouverts": F.col("total") - F.col("clos"),
        "taux_cloture": _pct1(F.col("clos"), F.col("total")), "n_en_retard": F.col("n_en_retard"),
        "taux_sla": _pct1(F.col("sla_ok"), F.col("sla_n")), "moyenne_jours": mean, "mediane_jours": F.round("mediane", 1),
        "p90_jours": F.round("p90", 1), "min_jours": F.round("min_jours", 1), "max_jours": F.round("max_jours", 1), "n_mesures": F.col("n_mesures"),
    }
    per_prio = {
        "count": F.col("n_mesures"), "moyenne_jours": mean, "mediane_jours": F.round("mediane", 1),
        "pct_dans_sla": F.when(F.col("sla_n") > 0, _pct1(F.col("sla_ok"), F.col("sla_n"))),
    }

    def long(df: DataFrame, scope: Column, cols: Mapping[str, Column]) -> DataFrame:
        items = F.array(*[F.struct(F.lit(n).alias("indicator"), c.cast("double").alias("value")) for n, c in cols.items()])
        return df.select(scope.alias("scope"), F.inline(items))

    by_prio = rows.where(known & F.col("prio").isNotNull()).groupBy(F.concat(F.lit("P"), F.col("prio").cast("string")).alias("scope")).agg(*stats)
    by_prio = lookup_join(by_prio, middle, ["scope"])
    return long(one, F.col("scope"), measures).unionByName(long(by_prio, F.col("scope"), per_prio))


def ticket_breakdowns(stock: DataFrame, dimensions: Sequence[str], top: int = 12) -> DataFrame:
    """Counts by state and priority, and the most frequent labels of each dimension."""
    prio = F.coalesce(F.col("priority").try_cast("int"), F.lit(0)).cast("string")
    cells = F.array(
        F.struct(F.lit("state").alias("dim"), F.coalesce("state", F.lit("Inconnu")).alias("label")),
        F.struct(F.lit("priority").alias("dim"), prio.alias("label")),
        *[F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("label")) for d in dimensions],
    )
    counts = stock.select(F.inline(cells)).where("label is not null").groupBy("dim", "label").agg(F.count("*").alias("n"))
    whole = F.col("dim").isin("state", "priority")
    return counts.where(whole).unionByName(top_n_per_dim(counts.where(~whole), "dim", "label", "n", top))


def ticket_monthly_evolution(stock: DataFrame, last: int | None = None) -> DataFrame:
    """Openings and closings per month; optionally only the newest ``last`` months of each."""
    opened, closed = F.try_to_timestamp(F.col("opened")), F.try_to_timestamp(F.col("closed"))
    cells = F.array(F.struct(F.lit("ouvertures").alias("serie"), opened.alias("t")), F.struct(F.lit("clotures").alias("serie"), closed.alias("t")))
    counts = stock.select(F.inline(cells)).where("t is not null").groupBy("serie", F.date_format("t", "yyyy-MM").alias("mois")).agg(F.count("*").alias("n"))
    if last is None:
        return counts
    newest = counts.withColumn("age", -F.regexp_replace("mois", "-", "").cast("int"))
    rank = newest.select("serie", "mois", "n", (-F.col("age")).alias("k"))
    return top_n_per_dim(rank, "serie", "mois", "k", last).drop("k")


def excel_or_text_date(col: Column) -> Column:
    """DATE of a text date or of an Excel serial day number."""
    serial = col.try_cast("double")
    by_number = F.date_add(F.lit(EXCEL_EPOCH).cast("date"), F.floor(serial).cast("int"))
    return F.when(serial.isNotNull(), by_number).otherwise(F.try_to_timestamp(col).cast("date"))


def ticket_legacy_kpis(history: DataFrame, last: int = 24) -> DataFrame:
    """History indicators as ``(scope, label, value)``: totals, durations, breakdowns, recent months."""
    days = F.col("duration").try_cast("double")
    known = F.when(days > 0, days)
    rows = history.select(known.alias("d"), F.lit("HISTORIQUE").alias("scope"))
    # Nine decimal places add up the same in any order.
    total = F.sum(F.col("d").cast("decimal(28,9)")).cast("double").alias("s")
    one = rows.agg(F.count("*").alias("total"), F.count("d").alias("n_mesures"), total).withColumn("scope", F.lit("HISTORIQUE"))
    one = lookup_join(one, exact_percentiles(rows, "scope", "d", {"mediane": 0.5, "p90": 0.9}), ["scope"])
    cols = {
        "total": F.col("total"), "n_mesures": F.coalesce("n_mesures", F.lit(0)),
        "moyenne_jours": F.round(F.try_divide(F.col("s"), F.col("n_mesures").cast("double")), 1),
        "mediane_jours": F.round("mediane", 1), "p90_jours": F.round("p90", 1),
    }
    out = one.select("scope", F.inline(F.array(*[F.struct(F.lit(n).alias("label"), c.cast("double").alias("value")) for n, c in cols.items()])))
    shown = ticket_breakdowns(history, ["theme", "subject"]).select("dim", "label", F.col("n").cast("double").alias("value"))
    out = out.unionByName(shown.select(F.col("dim").alias("scope"), "label", "value"))
    dated = history.select(excel_or_text_date(F.col("opened")).cast("string").alias("opened"), excel_or_text_date(F.col("closed")).cast("string").alias("closed"))
    months = ticket_monthly_evolution(dated, last).select(F.col("serie").alias("scope"), F.col("mois").alias("label"), F.col("n").cast("double").alias("value"))
    return out.unionByName(months)
