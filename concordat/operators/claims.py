"""Claim operations: volumes, payments, delays, waiting and rejected stock.

``ops`` holds one row per operation: dossier_id, op_no, op_ref (total order
within equal numbers), op_date, created, state, origin, box, reject_code,
amount, offer, person_no.  ``heads`` holds one row per dossier: dossier_id,
received, origin, person_no, state.  Every day-wise job takes an optional day
window; without one it covers all days at once, grouped by day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.operators.common import count_where, first_row, lookup_join, spread
from concordat.operators.filters import in_days, matches_patterns

# Origin codes of the matrices.
AUTO_ORIGINS = ("DRASS", "NMFOU", "NMASS", "LUMAS", "NMCMU", "TPVIA", "TPHOS", "TPCVM", "OXA")
MANUAL_ORIGINS = ("ASSUR", "SELFC", "TIERS", "REGUL")
MANUAL_SUMMARY = ("ASSUR", "TIERS", "REGUL")
SUMMARY_ORIGINS = ("TPVIA", "TPHOS", "TPCVM", "OXA", "NMASS", "ASSUR", "TIERS", "REGUL", "SELFC", "LUMAS")
FOLLOWED_ORIGINS = ("NMASS", "LUMAS", "OXA", "TPCVM", "TPHOS", "TPVIA")
MEASURES = ("MDG_Intégrés", "MDG_Payés", "MDG_Relevés", "MDG_Attente", "MDG_Rejets")
PAID, WAITING, REJECTED = ("PA", "RL"), ("AC", "VA"), "RJ"


def latest_op_both(ops: DataFrame, day: str | None = None) -> DataFrame:
    """Per dossier and day, from one scan: latest paid operation and latest operation of any state."""
    op = F.struct("op_no", "op_ref", "state", "origin")
    rows = ops.where(in_days(F.col("op_date"), day))
    best = rows.groupBy("dossier_id", "op_date").agg(F.max(F.when(F.col("state").isin(*PAID), op)).alias("paid"), F.max(op).alias("last"))
    return best.select(
        "dossier_id", "op_date", F.col("last.origin").alias("origin"),
        F.col("paid.op_no").alias("paid_op"), F.col("paid.state").alias("paid_state"),
        F.col("last.op_no").alias("last_op"), F.col("last.state").alias("last_state"),
    )


def claim_measures(heads: DataFrame, ops: DataFrame, day: str | None = None) -> DataFrame:
    """Labelled measure rows ``(requete, day, origin, n)``."""
    received = heads.where(in_days(F.col("received"), day)).groupBy(
        F.lit(MEASURES[0]).alias("requete"), F.col("received").alias("day"), "origin"
    ).agg(F.count("*").alias("n"))
    labels = F.array_compact(
        F.array(
            F.when(F.col("paid_state").isin(*PAID), F.lit(MEASURES[1])),
            F.when(F.col("paid_state") == "RL", F.lit(MEASURES[2])),
            F.when(F.col("last_state").isin(*WAITING), F.lit(MEASURES[3])),
        )
    )
    moved = latest_op_both(ops, day).select(F.explode(labels).alias("requete"), F.col("op_date").alias("day"), "origin")
    moved = moved.groupBy("requete", "day", "origin").agg(F.count("*").alias("n"))
    rejected = ops.where((F.col("state") == REJECTED) & (F.col("op_no") == 2) & in_days(F.col("op_date"), day))
    rejected = rejected.groupBy(F.lit(MEASURES[4]).alias("requete"), F.col("op_date").alias("day"), "origin").agg(F.count("*").alias("n"))
    return received.unionByName(moved).unionByName(rejected)


def origin_matrix(rows: DataFrame, keys: Sequence[str], measure: Column, auto: Sequence[str] = AUTO_ORIGINS,
                  manual: Sequence[str] = MANUAL_ORIGINS, others: bool = True) -> DataFrame:
    """One column per origin with automatic, manual and other totals."""
    origin = F.col("origin")

    def total(cond: Column, name: str) -> Column:
        return F.sum(F.when(cond, measure).otherwise(F.lit(0))).cast("bigint").alias(name)

    known = (*auto, *manual)
    cols = [
        *spread(auto, origin, measure), total(origin.isin(*auto), "TOTAL_AUTO"),
        *spread(manual, origin, measure), total(origin.isin(*manual), "TOTAL_MANUEL"),
    ]
    if others:
        cols.append(total(~origin.isin(*known), "AUTRES"))
    return rows.groupBy(*keys).agg(*cols)


def claims_daily_matrix(heads: DataFrame, ops: DataFrame, day: str | None = None) -> DataFrame:
    """Five measures per day, one column per origin plus totals."""
    return origin_matrix(claim_measures(heads, ops, day), ["requete", "day"], F.col("n"))


def claims_sources_dwh(heads: DataFrame, ops: DataFrame, recovered: DataFrame, day: str | None = None) -> DataFrame:
    """Integrated, paid, statement, waiting and rejected dossiers per origin (warehouse counts).

    Paid dossiers are the full join of payments and recoveries on the dossier;
    both sides are reduced to one row per dossier first.
    """
    window = in_days(F.col("op_date"), day)

    def counted(df: DataFrame, label: str, n: Column) -> DataFrame:
        return df.groupBy(F.lit(label).alias("requete"), "origin").agg(n.cast("bigint").alias("nb"))

    per_day = heads.where(in_days(F.col("received"), day)).groupBy("received", "origin").agg(F.count("*").alias("n"))
    paid = ops.where(F.col("state").isin(*PAID) & window).select("dossier_id", "origin").distinct()
    back = recovered.where(window).select("dossier_id", F.col("origin").alias("other")).distinct()
    both = paid.join(back, "dossier_id", "full_outer").select("dossier_id", F.coalesce("origin", "other").alias("origin")).distinct()
    statement = ops.where((F.col("state") == "RL") & window).select("dossier_id", "origin").distinct()
    waiting = ops.where(F.col("state").isin(*WAITING) & window)
    rejected = ops.where((F.col("state") == REJECTED) & window)
    return (
        counted(per_day, "DWH-Intégré", F.sum("n"))
        .unionByName(counted(both, "DWH_Payé", F.count("*")))
        .unionByName(counted(statement, "DWH_Relevé", F.count("*")))
        .unionByName(counted(waiting, "DWH-Attente", F.count("*")))
        .unionByName(counted(rejected, "DWH_Rejets", F.count("*")))
    )


def full_outer_counts(heads: DataFrame, ops: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Received, paid, amount and waiting per origin; absent counts are 0."""
    window = in_days(F.col("op_date"), first, last)
    received = heads.where(in_days(F.col("received"), first, last)).groupBy("origin").agg(F.count("*").alias("nb_recu"))
    # One pass per dossier: paid or waiting in the window, amount over all its lines.
    per_dossier = ops.groupBy("dossier_id").agg(
        F.max_by("origin", F.struct("op_no", "op_ref", "origin")).alias("origin"),
        F.coalesce(F.max(F.col("state").isin(*PAID) & window), F.lit(False)).alias("paid"),
        F.coalesce(F.max(F.col("state").isin(*WAITING) & window), F.lit(False)).alias("waits"),
        F.sum("amount").alias("amount"),
    )
    moved = per_dossier.where("paid or waits").groupBy("origin").agg(
        count_where(F.col("paid")).alias("nb_payes"),
        F.sum(F.when(F.col("paid"), F.col("amount")).otherwise(0)).alias("montant_payes"),
        count_where(F.col("waits")).alias("nb_attente"),
    )
    out = received.join(moved, "origin", "full_outer")
    return out.select(
        "origin",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("nb_recu", "nb_payes")],
        F.coalesce(F.col("montant_payes"), F.lit(0)).cast("double").alias("montant_payes"),
        F.coalesce("nb_attente", F.lit(0)).alias("nb_attente"),
    )


def payment_summary(heads: DataFrame, ops: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """One wide row: received, paid and amount per followed origin, with the manual total."""
    rows = full_outer_counts(heads, ops, first, last)
    fields = {"recu": "nb_recu", "paye": "nb_payes", "mnt": "montant_payes"}
    cols = []
    for origin in SUMMARY_ORIGINS:
        for prefix, field in fields.items():
            cols.append(F.coalesce(F.max(F.when(F.col("origin") == origin, F.col(field))), F.lit(0)).alias(f"{prefix}_{origin}"))
    manual = F.col("origin").isin(*MANUAL_SUMMARY)
    for prefix, field in {**fields, "attente": "nb_attente"}.items():
        cols.append(F.coalesce(F.sum(F.when(manual, F.col(field))), F.lit(0)).alias(f"{prefix}_TOTAL_MANUEL"))
    out = rows.agg(*cols)
    return out.select(*[F.round(c, 2).alias(c) if c.startswith("mnt") else F.col(c).cast("bigint").alias(c) for c in out.columns])


def delay_buckets_paid(ops: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Days from creation to payment of the latest operation, by origin."""
    rows = ops.where(in_days(F.col("op_date"), first, last))
    op = F.max(F.struct("op_no", "op_ref", "state", "op_date", "origin")).alias("op")
    latest = rows.groupBy("dossier_id").agg(op, F.min("created").alias("created"))
    paid = latest.where(F.col("op.state").isin(*PAID)).select(F.col("op.origin").alias("origin"), F.datediff("op.op_date", "created").alias("d"))
    d = F.col("d")
    return paid.groupBy("origin").agg(
        F.count("*").alias("paye_total"),
        *[count_where(d == n).alias(f"j{n}") for n in range(5)],
        count_where(d > 4).alias("j5_plus"),
    )


def delay_buckets_rejected(ops: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Days from the first rejection to later ones, by queue family."""
    rejects = ops.where(F.col("state") == REJECTED)
    start = rejects.where(F.col("op_no") == 2).groupBy("dossier_id").agg(F.min("op_date").alias("first_reject"))
    family = F.when(F.col("box").startswith("GES"), "Rejet_GESTION").when(F.col("box").startswith("DSI"), "Rejet_DSI")
    rows = rejects.where(in_days(F.col("op_date"), first, last)).select("dossier_id", "op_date", family.alias("type_rejet"))
    rows = lookup_join(rows.where("type_rejet is not null"), start, ["dossier_id"], "inner")
    d = F.col("d")
    ages = rows.select("dossier_id", "type_rejet", F.datediff("op_date", "first_reject").alias("d")).distinct()
    return ages.groupBy("type_rejet").agg(
        F.count("*").alias("nb"),
        count_where(d <= 4).alias("lt5"),
        count_where((d > 4) & (d <= 9)).alias("d5_9"),
        count_where((d > 9) & (d <= 19)).alias("d10_19"),
        count_where(d > 19).alias("ge20"),
    )


def outer_when_unpriced(ops: DataFrame, contracts: DataFrame) -> DataFrame:
    """Operations with their own offer, else every distinct offer of the person's contracts.

    Contract offers are reduced to distinct (person, offer) pairs before the
    join, so a person with many contracts does not multiply rows.
    """
    pairs = contracts.select("person_no", F.col("contract_offer").alias("__offer")).distinct()
    priced = ops.where("offer is not null").withColumn("offer_used", F.col("offer"))
    bare = ops.where("offer is null").join(pairs, "person_no", "left").withColumn("offer_used", F.col("__offer")).drop("__offer")
    return priced.unionByName(bare)


def claims_count_by_offer(ops: DataFrame, contracts: DataFrame, first: str, last: str,
                          origins: str = "TOUTES", offers: str = "TOUTES") -> DataFrame:
    """Distinct claims by arrival date, offer, origin and state."""
    rows = ops.where(in_days(F.col("created"), first, last) & matches_patterns(F.col("origin"), origins))
    rows = rows.select("created", "dossier_id", "origin", "state", "offer", "person_no").distinct()
    rows = outer_when_unpriced(rows, contracts).where(matches_patterns(F.col("offer_used"), offers))
    distinct = rows.select("created", "offer_used", "origin", "state", "dossier_id").distinct()
    return distinct.groupBy(
        F.date_format("created", "yyyyMMdd").alias("date_arrivee"), F.col("offer_used").alias("offre"), "origin", "state"
    ).agg(F.count("*").alias("nb_demandes"))


def claims_list(ops: DataFrame, contracts: DataFrame, first: str, last: str,
                origins: str = "TOUTES", offers: str = "TOUTES") -> DataFrame:
    """Detailed listing with the same filters, in arrival order."""
    rows = ops.where(in_days(F.col("created"), first, last) & matches_patterns(F.col("origin"), origins))
    rows = outer_when_unpriced(rows, contracts).where(matches_patterns(F.col("offer_used"), offers))
    out = rows.select(
        F.date_format("created", "yyyyMMdd").alias("date_arrivee"), "dossier_id", "op_no", "op_ref",
        F.col("offer_used").alias("offre"), "origin", "state",
    )
    return out.orderBy("date_arrivee", "dossier_id", "op_no", "op_ref", "offre")


def wait_by_signature(waiting: DataFrame, labels: DataFrame) -> DataFrame:
    """Distinct waiting dossiers by signature and origin, with totals."""
    once = waiting.select("signature", "origin", "dossier_id").distinct()
    counts = once.groupBy("signature", "origin").agg(F.count("*").alias("n"))
    named = counts.join(labels.select(F.col("code").alias("signature"), "libelle"), "signature")
    out = origin_matrix(named, ["signature", "libelle"], F.col("n"), others=False)
    return out.withColumn("TOTAL", F.col("TOTAL_AUTO") + F.col("TOTAL_MANUEL"))


def stock_by_box(rejects: DataFrame, labels: DataFrame) -> DataFrame:
    """Distinct rejected dossiers by box, code and origin, with totals."""
    once = rejects.select("box", "reject_code", "origin", "dossier_id").distinct()
    counts = once.groupBy("box", "reject_code", "origin").agg(F.count("*").alias("n"))
    named = counts.join(labels.select(F.col("code").alias("reject_code"), "libelle"), "reject_code")
    out = origin_matrix(named, ["box", "reject_code", "libelle"], F.col("n"), others=False)
    return out.withColumn("Total", F.col("TOTAL_AUTO") + F.col("TOTAL_MANUEL"))


def reject_ages(ops: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Per rejected dossier with activity in the window: age in days and latest code."""
    rejects = ops.where(F.col("state") == REJECTED)
    agg = rejects.groupBy("dossier_id").agg(
        F.min(F.when(F.col("op_no") == 2, F.col("op_date"))).alias("arrived"),
        F.max("op_date").alias("last_op"),
        F.coalesce(F.max(in_days(F.col("op_date"), first, last)), F.lit(False)).alias("active"),
        F.max(F.struct("op_no", "op_ref", "reject_code", "origin")).alias("op"),
    )
    return agg.where("active").select(
        "dossier_id", F.col("op.origin").alias("origin"), F.col("op.reject_code").alias("reject_code"),
        F.datediff("last_op", "arrived").alias("age"),
    )


def oldest_reject(ops: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Oldest rejected dossier per origin and box, unknown ages last."""
    ages = reject_ages(ops, first, last)
    boxes = ops.select("dossier_id", "box").distinct()
    rows = ages.join(boxes, "dossier_id")
    best = first_row(rows, ["origin", "box"], [F.col("age").desc_nulls_last(), F.col("dossier_id")])
    listed = F.col("origin").isin(*FOLLOWED_ORIGINS)
    return best.select(
        "origin",
        F.when(listed, F.col("origin")).otherwise(F.concat(F.lit("Autre — "), "origin")).alias("libelle"),
        F.when(listed, F.col("origin")).otherwise("Autre").alias("groupe"),
        "box", "reject_code", "age", "dossier_id",
    )


def oldest_reject_per_box(oldest: DataFrame) -> DataFrame:
    """Oldest known age and its code per origin group and box, with box count and group maximum."""
    known = oldest.where("age is not null")
    best = first_row(known, ["groupe", "box"], [F.col("age").desc(), F.col("origin"), F.col("dossier_id")])
    totals = best.groupBy("groupe").agg(F.count("*").alias("nb_boites"), F.max("age").alias("age_max_groupe"))
    return lookup_join(best, totals, ["groupe"]).select(
        "groupe", "box", F.col("age").alias("age_jours_max"), "reject_code", "nb_boites", "age_max_groupe"
    )


def contracts_vs_duplicates(contracts: DataFrame) -> DataFrame:
    """Insured, contracts, duplicated insured and excess contracts: global and per offer.

    Counted per (offer, person) first; the offer rows and the global row both
    derive from that table.
    """
    per = contracts.select("offer", "person_id", "contract_id").distinct().groupBy("offer", "person_id").agg(F.count("*").alias("n"))
    measures = [
        F.count("*").alias("nb_assures"),
        F.sum("n").cast("bigint").alias("nb_contrats"),
        count_where(F.col("n") > 1).alias("nb_assures_doublonnes"),
    ]
    by_offer = per.groupBy(F.lit("PAR_OFFRE").alias("niveau"), F.col("offer").alias("code_offre")).agg(*measures)
    # Global persons are distinct over offers; the other measures add up over (offer, person).
    persons = per.groupBy("person_id").agg(F.sum("n").alias("n"), count_where(F.col("n") > 1).alias("dup"))
    total = persons.agg(
        F.lit("GLOBAL").alias("niveau"), F.lit(None).cast("string").alias("code_offre"),
        F.count("*").alias("nb_assures"), F.sum("n").cast("bigint").alias("nb_contrats"), F.sum("dup").cast("bigint").alias("nb_assures_doublonnes"),
    )
    return total.unionByName(by_offer).withColumn("nb_doublons", F.col("nb_contrats") - F.col("nb_assures"))


def grouping_sets_counts(feed: DataFrame) -> DataFrame:
    """Counters by (kind, state) and by kind, with first and last time and the span."""
    from concordat.functions import interval_hms

    base = feed.groupBy("typcou", "etat").agg(F.count("*").alias("n"), F.min("ts").alias("du"), F.max("ts").alias("au"))
    out = base.groupingSets([["typcou", "etat"], ["typcou"]], "typcou", "etat").agg(
        F.sum("n").cast("bigint").alias("nombre"), F.min("du").alias("du"), F.max("au").alias("au")
    )
    return out.select("typcou", F.coalesce("etat", F.lit("TOTAL")).alias("etat"), "nombre", "du", "au", interval_hms(F.col("du"), F.col("au")).alias("duree_hms"))


def recycle_counts(feed: DataFrame) -> DataFrame:
    """Rows waiting in the recycle queue by (kind, company) and by company."""
    base = feed.groupBy("typcou", "codsoc").agg(F.count("*").alias("n"))
    out = base.groupingSets([["typcou", "codsoc"], ["codsoc"]], "typcou", "codsoc").agg(F.sum("n").cast("bigint").alias("total_lignes"))
    return out.select(F.coalesce("typcou", F.lit("TOTAL_PAR_CODSOC")).alias("typcou"), "codsoc", "total_lignes")


def version_chain_join(persons: DataFrame, links: DataFrame, contracts: DataFrame, versions: DataFrame, offers: DataFrame) -> DataFrame:
    """Person to relation to contract to version to offer, latest version per contract.

    ``persons(person_no, company_no)``, ``links(company_no, company)``,
    ``contracts(contract_no, person_no)``, ``versions(contract_no, version,
    state, end_date, offer_no)`` with a totally ordered ``version``,
    ``offers(offer_no, offer)``.  The latest version is chosen before the
    other tables are joined, so they see one row per contract.
    """
    latest = first_row(versions, ["contract_no"], [F.col("version").desc()])
    rows = latest.join(contracts, "contract_no").join(persons, "person_no").join(links, "company_no").join(offers, "offer_no")
    return rows.select("contract_no", "person_no", "company", "offer", "version", "state", "end_date")


def parameter_cross_join(facts_df: DataFrame, params: DataFrame, column: str) -> DataFrame:
    """Rows inside the window of a one-row parameter table; any other number of rows raises."""
    only = F.when(F.count(F.lit(1)) == 1, F.min("d_debut")).otherwise(F.raise_error(F.lit("the parameter table must have one row")))
    one = params.agg(only.alias("d_debut"), F.min("d_fin").alias("d_fin"))
    return facts_df.crossJoin(F.broadcast(one)).where(  # one row: an aggregate without keys
        (F.col(column) >= F.col("d_debut")) & (F.col(column) < F.col("d_fin"))
    )


def in_subquery(ops: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in another result."""
    return lookup_join(ops, wanted.select(key).distinct(), [key], "left_semi")


def union_measures(heads: DataFrame, ops: DataFrame) -> DataFrame:
    """Totals of all labelled measures by origin."""
    return claim_measures(heads, ops).groupBy("requete", "origin").agg(F.sum("n").cast("bigint").alias("n"))
