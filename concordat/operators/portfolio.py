"""Portfolio tables: terminations, types, ages, offers, multi-contract persons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.functions import attrition_rate, squeeze, zero_pad_code
from concordat.operators.common import count_where, lookup_join
from concordat.operators.filters import regex_code_filter
from concordat.operators.windows import share_of_total

# Termination reasons in their display order; blanks come last.
REASON_ORDER = (
    "AGE", "ANNUL", "CCULT", "CJUAD", "CMEAE", "CMEN", "CMGAS", "COLLO", "CONC", "COT+", "CSS", "DECES", "DEM",
    "DEMUT", "DENT", "DETRA", "DISP", "DOUBL", "DRET", "FMGAR", "FPORT", "IMP", "OFFRE", "PREST", "RADIA", "SUSP", "TRANS",
)
EMPTY_REASON = "(vide)"
ALL = "(Toutes)"

# Offers with their display number and, for groups, their members.
OFFER_GROUPS = (
    ("INMMISPACT", 28, "INMMISPACT + INMMISPAUT + INMMISPRET"),
    ("INMMSPACT1", 32, None),
    ("INMMSPOJI1", 29, None),
    ("INMMSPRET1", 1, None),
    ("INPCULT002", 3, "INPCULT002 + MEPCULT003"),
    ("INPPREVIND", 25, None),
    ("INSC2SG", 30, "INSC2SG + INSC2SP + INSC2SS"),
    ("INSEFFBRED", 2, "INSEFFBRED + INSEFFICIE"),
    ("INSMAEEREF", 4, "INSMAEEPNR+INSMAEEREF + INSMAEERET"),
    ("INSMALT001", 33, None),
    ("INSMAS001", 22, None),
    ("INSMTE0001", 31, "INSMTE0001 + INSMTE1001"),
    ("INSMIOM001", 24, None),
    ("MEPMAS001", 21, None),
    ("MEPMEAE001", 23, "MEPMEAE001+MEPMEAT002"),
    ("MEPMENP002", 27, "MEPMENP002+MEPMENP201"),
    ("MESAPEI002", 5, None),
    ("MESBGTL004", 6, None),
    ("MESBSRT002", 7, None),
    ("MESCULT002", 8, "MESCULT002 +MESCULT101"),
    ("MESERASMUS", 9, None),
    ("MESESEA001", 10, None),
    ("MESFRVL001", 11, None),
    ("MESGMMS004", 12, None),
    ("MESINOV003", 13, None),
    ("MESJUAD002", 14, "MESJUAD002+MESJUAM005"),
    ("MESLAD46", 15, None),
    ("MESMEAE102", 16, "MESMEAE102 + MESMEAE202 + MESMEAE301"),
    ("MESMEN001", 17, "MESMEN001 + MESMEN2003 + MESMEN3001"),
    ("MESMNTSALA", 18, None),
    ("MESMUTFR31", 19, None),
    ("OFFSUP", None, None),
    ("STSNUANCE", 20, None),
)


def terminations_by_reason(block: DataFrame) -> DataFrame:
    """Terminations and their share by company and reason, and over all companies.

    ``block``: company, reason, n.  Unknown reason codes are left out.
    """
    reason = F.coalesce(squeeze(F.col("reason")), F.lit(""))
    reason = F.when(reason == "", EMPTY_REASON).otherwise(reason)
    order = F.array(*[F.lit(r) for r in (*REASON_ORDER, EMPTY_REASON)])
    rows = block.select(F.col("company"), reason.alias("reason"), F.col("n")).withColumn("ordre", F.array_position(order, F.col("reason")))
    rows = rows.where("ordre > 0").groupBy("company", "reason", "ordre").agg(F.sum("n").cast("bigint").alias("nombre"))
    every = rows.groupBy(F.lit(ALL).alias("company"), "reason", "ordre").agg(F.sum("nombre").cast("bigint").alias("nombre"))
    out = share_of_total(rows.unionByName(every), "company", "nombre")
    return out.select("company", "reason", F.col("ordre").cast("bigint").alias("ordre"), "nombre", F.col("share_group").alias("part"))


def portfolio_table(block: DataFrame, label: str) -> DataFrame:
    """Current and base counts with share and attrition: by (company, label), company, label, and overall."""
    base = block.groupBy("company", label).agg(F.sum("current").alias("c"), F.sum("base").alias("b"))
    sets = base.groupingSets([["company", label], ["company"], [label], []], "company", label).agg(
        F.grouping("company").alias("gc"), F.grouping(label).alias("gl"),
        F.sum("c").cast("bigint").alias("current"), F.sum("b").cast("bigint").alias("base"),
    )
    named = sets.select(
        F.when(F.col("gc") == 1, ALL).otherwise(F.col("company")).alias("company"),
        F.when(F.col("gl") == 1, "Total général").otherwise(F.col(label)).alias(label),
        "gl", "current", "base",
    )
    totals = named.where("gl = 1").select("company", F.col("base").alias("company_base"))
    out = lookup_join(named, totals, ["company"])
    return out.select(
        "company", label, "current", "base",
        F.try_divide(F.col("base").cast("double"), F.col("company_base").cast("double")).alias("part"),
        attrition_rate(F.col("current"), F.col("base")).alias("attrition"),
    )


def portfolio_by_company_type(block: DataFrame) -> DataFrame:
    """By company and member type, standard company codes only."""
    return portfolio_table(regex_code_filter(block, "company"), "member_type")


def portfolio_by_age(block: DataFrame) -> DataFrame:
    """By company and age band."""
    return portfolio_table(block.withColumn("company", zero_pad_code(F.col("company"))), "age_band")


def offer_group_table(spark: SparkSession) -> DataFrame:
    """Group dimension: one row per (group key, member) with its precedence.

    The key comes first, then members in label order.
    """
    rows = []
    for key, number, label in OFFER_GROUPS:
        members = [m.strip() for m in label.split("+")] if label else [key]
        rows.append((key, number, label if len(members) > 1 else None, key, -1))
        rows += [(key, number, label if len(members) > 1 else None, m, i) for i, m in enumerate(members) if m != key]
    return spark.createDataFrame(rows, "group_key string, ordre int, label string, offer string, pos int")


def offer_groups(block: DataFrame) -> DataFrame:
    """Offers of insured persons with share, group total and display order.

    A group's total, label and order are carried by its first present member;
    other members show only themselves; a single known offer carries itself.
    """
    offers = block.where(F.upper("member_type") == "ASSURE").groupBy("offer").agg(F.sum("base").cast("bigint").alias("nb"))
    dim = F.broadcast(offer_group_table(block.sparkSession))  # fixed list of about 50 rows
    present = offers.join(dim, "offer")
    groups = present.groupBy("group_key", "ordre", "label").agg(F.min_by("offer", "pos").alias("offer"), F.sum("nb").cast("bigint").alias("total"))
    shown = offers.join(groups.select("offer", "ordre", "label", "total"), "offer", "left")
    grand = offers.agg(F.sum("nb").alias("grand"))
    rows = shown.crossJoin(F.broadcast(grand))  # one row
    return rows.select(
        "offer", "nb", F.try_divide(F.col("nb").cast("double"), F.col("grand").cast("double")).alias("part"),
        F.when(F.col("ordre").isNotNull() | F.col("label").isNotNull(), F.col("total")).alias("total"),
        F.col("label").alias("regroupement"), F.col("ordre").cast("bigint").alias("ordre"),
    )


def portfolio_summary(by_type: DataFrame, terminations: DataFrame, by_age: DataFrame) -> DataFrame:
    """Key figures as ``(section, label, value)``: totals, attrition, top reason, top offers, loyal band."""
    valid = regex_code_filter(by_type, "company")
    fine = valid.groupBy("company", "member_type", "offer").agg(F.sum("current").alias("c"), F.sum("base").alias("b"))

    def row(section: str, label: Column, value: Column) -> list[Column]:
        return [F.lit(section).alias("section"), label.alias("label"), value.cast("double").alias("value")]

    total = fine.agg(F.sum("c").alias("c"), F.sum("b").alias("b"))
    totals = total.select(F.inline(F.array(
        F.struct(*row("PORTEFEUILLE", F.lit("non_radies"), F.col("b"))),
        F.struct(*row("PORTEFEUILLE", F.lit("a_date"), F.col("c"))),
        F.struct(*row("PORTEFEUILLE", F.lit("taux_radiation"), attrition_rate(F.col("c"), F.col("b")))),
    )))
    reasons = terminations_by_reason(terminations).where(F.col("company") == ALL)
    ended = reasons.agg(F.sum("nombre").alias("n")).select(*row("RESILIATIONS", F.lit("total"), F.col("n")))
    top_reason = reasons.where(F.col("reason") != EMPTY_REASON).orderBy(F.col("nombre").desc(), "reason").limit(1)
    top_reason = top_reason.select(*row("MOTIF_DOMINANT", F.col("reason"), F.col("nombre")))
    offers = fine.where(F.upper("member_type") == "ASSURE").groupBy("offer").agg(F.sum("b").alias("b"))
    offers = offers.orderBy(F.col("b").desc(), "offer").limit(3).select(*row("TOP_OFFRES", F.col("offer"), F.col("b")))
    bands = by_age.groupBy("age_band").agg(F.sum("current").alias("c"), F.sum("base").alias("b"))
    rate = F.coalesce(attrition_rate(F.col("c"), F.col("b")), F.lit(1.0))
    band = bands.select("age_band", rate.alias("r")).orderBy("r", "age_band").limit(1).select(*row("TRANCHE_FIDELE", F.col("age_band"), F.col("r")))
    types = fine.groupBy("member_type").agg(F.sum("b").alias("b")).select(*row("TYPE", F.col("member_type"), F.col("b")))
    companies = fine.groupBy("company").agg(F.sum("b").alias("b")).select(*row("SOCIETE", F.col("company"), F.col("b")))
    out = totals
    for part in (ended, top_reason, offers, band, types, companies):
        out = out.unionByName(part)
    return out


def phase_gaps(counters: DataFrame, insured_base: DataFrame) -> DataFrame:
    """Discrepancy counters as a share of the insured base, with the telephone subtotal.

    ``counters``: indicator, nb.  ``insured_base``: one row, column ``base``.
    """
    phone = counters.where(F.col("indicator").startswith("dep_tel")).agg(F.lit("total_telephone").alias("indicator"), F.sum("nb").cast("bigint").alias("nb"))
    rows = counters.unionByName(phone).crossJoin(F.broadcast(insured_base))  # one row
    return rows.select("indicator", "nb", F.try_divide(F.col("nb").cast("double"), F.col("base").cast("double")).alias("part"))


def multi_contract_report(block: DataFrame, top: int = 10) -> DataFrame:
    """Persons on several contracts: all views as ``(section, k1, k2, nb_assures, nb_contrats)``.

    ``block``: person columns last_name, first_name, insee, birth_date, then
    company, kind, n.
    """
    rows = block.select(
        "last_name", "first_name", "insee", "birth_date", zero_pad_code(F.col("company")).alias("company"),
        F.upper(squeeze(F.col("kind"))).alias("kind"), F.coalesce(F.col("n").cast("bigint"), F.lit(0)).alias("n"),
    )
    # One small table by (company, kind, count) feeds the five counting views.
    cube = rows.groupBy("company", "kind", "n").agg(F.count("*").alias("a"), F.sum("n").alias("c"))

    none = F.lit("")
    keys = {
        "TOTAL": (none, none), "TYPE": (F.col("kind"), none), "SOCIETE": (F.col("company"), none),
        "CROISE": (F.col("company"), F.col("kind")), "DISTRIBUTION": (F.col("n").cast("string"), none),
    }
    cells = F.array(*[F.struct(F.lit(v).alias("section"), a.alias("k1"), b.alias("k2")) for v, (a, b) in keys.items()])
    out = cube.select(F.inline(cells), "a", "c").groupBy("section", "k1", "k2").agg(
        F.sum("a").cast("bigint").alias("nb_assures"), F.sum("c").cast("bigint").alias("nb_contrats")
    )
    person = ("last_name", "first_name", "insee", "birth_date")
    best = rows.orderBy(F.col("n").desc(), *person, "company", "kind").limit(top)
    best = best.select(F.lit("TOP").alias("section"), F.concat_ws("|", *person).alias("k1"), F.concat_ws("|", "company", "kind").alias("k2"),
                       F.lit(1).cast("bigint").alias("nb_assures"), F.col("n").alias("nb_contrats"))
    # At least two kinds of benefit: the least differs from the greatest.
    kinds = rows.groupBy(*person).agg(F.min("kind").alias("lo"), F.max("kind").alias("hi"), F.sum("n").alias("n"))
    several = kinds.agg(count_where(F.col("lo") < F.col("hi")).alias("nb_assures"), F.sum(F.when(F.col("lo") < F.col("hi"), F.col("n"))).cast("bigint").alias("nb_contrats"))
    several = several.select(F.lit("MULTI_TYPES").alias("section"), none.alias("k1"), none.alias("k2"), "nb_assures", "nb_contrats")
    return out.unionByName(best).unionByName(several)
