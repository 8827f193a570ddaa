"""Third-party-payment card: eligibility of contracts and persons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.functions import date_or_null, day_delta, pct2
from concordat.operators.common import count_where, first_row, lookup_join, views
from concordat.operators.normalize import INSURED_TYPES, SPOUSE_MARK

# Scope and waiting time.
EXCLUDED_OFFER_PREFIXES = ("MEP", "IND")
EXCLUDED_OFFERS = ("INPPREVIND",)
EXCLUDED_COMPANY = "073"
WAIT_DAYS = 21
ELIGIBLE, FUTURE, OUT_OF_SCOPE = "ELIGIBLE_TP", "FUTURE_TP", "HORS_PERIMETRE_TP"


def offer_excluded(offer: Column, company: Column) -> Column:
    """Provident offers and the excluded company."""
    cond = offer.isin(*EXCLUDED_OFFERS) | (company == EXCLUDED_COMPANY)
    for prefix in EXCLUDED_OFFER_PREFIXES:
        cond = cond | offer.startswith(prefix)
    return F.coalesce(cond, F.lit(False))


def status_of(member_type: Column, offer: Column, company: Column, delta: Column) -> Column:
    """Status of a contract; an unknown delay counts as future."""
    return (
        F.when(~F.coalesce(member_type.isin(*INSURED_TYPES), F.lit(False)), OUT_OF_SCOPE)
        .when(offer_excluded(offer, company), OUT_OF_SCOPE)
        .when(delta <= WAIT_DAYS, ELIGIBLE)
        .otherwise(FUTURE)
    )


def card_status(member: DataFrame) -> DataFrame:
    """Contract rows with the days from adhesion to effect and the card status."""
    rows = member.withColumn("delta", day_delta(F.col("effect_date"), F.col("adhesion_date")))
    status = status_of(F.col("member_type"), F.col("offer"), F.col("company"), F.col("delta"))
    return rows.withColumn("status", status)


def card_scope(member: DataFrame) -> DataFrame:
    """Contracts inside the card scope, with their status."""
    return card_status(member).where(F.col("status") != OUT_OF_SCOPE)


def _french(day: Column) -> Column:
    return F.coalesce(F.date_format(day, "dd/MM/yyyy"), F.lit(""))


def eligibility_day(mode: str = "effect_minus") -> Column:
    """Displayed day: adhesion + 21 (``adhesion_plus``) or effect - 21 (``effect_minus``)."""
    if mode == "adhesion_plus":
        return F.date_add(date_or_null(F.col("adhesion_date")), WAIT_DAYS)
    return F.date_sub(date_or_null(F.col("effect_date")), WAIT_DAYS)


def card_display(member: DataFrame) -> DataFrame:
    """Displayed card columns of a contract, spouses included.

    A spouse is eligible at the effect date; everyone else follows the card
    scope, and out-of-scope rows carry a reason instead of a date.
    """
    rows = card_status(member)
    spouse = F.coalesce(F.col("member_type").contains(SPOUSE_MARK), F.lit(False))
    typed = F.coalesce(F.col("member_type").isin(*INSURED_TYPES), F.lit(False))
    inside = F.col("status") != OUT_OF_SCOPE
    shown = F.when(spouse, _french(date_or_null(F.col("effect_date")))).when(
        inside, _french(eligibility_day("effect_minus"))
    )
    return rows.select(
        "*",
        F.when(spouse | inside, "O").otherwise("N").alias("eligible"),
        F.coalesce(shown, F.lit("")).alias("eligibility_date"),
        F.when(spouse, "Conjoint").when(F.col("status") == FUTURE, "Futur").otherwise("").alias("value"),
        F.when(spouse | inside, "")
        .when(~typed, F.concat(F.lit("Type assuré non éligible ("), F.coalesce("member_type", F.lit("")), F.lit(")")))
        .otherwise("Offre PREV exclue")
        .alias("reason"),
        F.coalesce(F.substr(shown, F.lit(4), F.lit(7)), F.lit("")).alias("month_label"),
        F.when(inside, _french(eligibility_day("adhesion_plus"))).otherwise("").alias("adhesion_plus"),
    )


def person_card(member: DataFrame) -> DataFrame:
    """Best contract of every person in scope: eligible before future, then file order."""
    rows = card_scope(member).where(F.coalesce("person_id", F.lit("")) != "")
    priority = F.when(F.col("status") == ELIGIBLE, 0).otherwise(1)
    best = first_row(rows, ["person_id"], [priority, F.col("seq")])
    return best.select("person_id", "status", "company", "offer", "member_type", "effect_date")


def card_kpis(persons: DataFrame) -> DataFrame:
    """Totals and rates, by month of effect, and by company, offer and type."""
    both = [count_where(F.col("status") == ELIGIBLE).alias("eligible"), count_where(F.col("status") == FUTURE).alias("future")]
    month = F.substring("effect_date", 1, 7)
    month = F.when(date_or_null(F.col("effect_date")).isNotNull(), month)
    # One pass: the finest grouping is small, the three views roll it up.
    base = persons.groupBy(month.alias("month"), "company", "offer", "member_type").agg(*both)
    labels = {"TOTAL": F.lit(""), "MOIS": F.col("month"), "DETAIL": F.concat_ws(" | ", "company", "offer", "member_type")}
    rows = views(base, labels, ["eligible", "future"])
    total = F.col("eligible") + F.col("future")
    return rows.select("*", total.alias("base"), pct2(F.col("eligible"), total).alias("rate_eligible"), pct2(F.col("future"), total).alias("rate_future"))


def card_by_company(persons: DataFrame) -> DataFrame:
    """Status counts by company."""
    return persons.groupBy("company").agg(
        count_where(F.col("status") == ELIGIBLE).alias("eligible"), count_where(F.col("status") == FUTURE).alias("future")
    )


def card_unmatched(persons: DataFrame, match: DataFrame, emails: DataFrame, valid_email: Column) -> DataFrame:
    """Eligible persons without a match, and eligible persons without a valid account e-mail.

    ``match`` holds one row per insured person; ``emails`` one row per account.
    """
    status = match.select("person_id", "match_status", F.col("matched_id").alias("id"))
    rows = lookup_join(status, emails, ["id"]).withColumn("valid", F.coalesce(valid_email, F.lit(False)))
    joined = rows.join(persons.select("person_id", F.col("status").alias("card")), "person_id", "full_outer")
    eligible = F.col("card") == ELIGIBLE
    matched = F.col("match_status") == "RAPPROCHE"
    return joined.agg(
        count_where(eligible).alias("eligible"),
        count_where(F.col("match_status") == "NON_RAPPROCHE").alias("unmatched"),
        count_where(eligible & (F.col("match_status") == "NON_RAPPROCHE")).alias("eligible_unmatched"),
        count_where(eligible & ~F.coalesce(matched & F.col("valid"), F.lit(False))).alias("eligible_no_email"),
    ).select(
        "*",
        pct2(F.col("eligible_unmatched"), F.col("eligible")).alias("pct_unmatched"),
        pct2(F.col("eligible_no_email"), F.col("eligible")).alias("pct_no_email"),
    )


def card_delay(persons: DataFrame, run_day: str, today: str) -> DataFrame:
    """Days from the run to the effect date of future cards.

    Mean, upper median, extremes, five buckets, and how many remain more than
    30, 60 and 90 days after ``today``.  The median is read off a histogram of
    day counts, so no list of all delays is ever built.
    """
    day = date_or_null(F.col("effect_date"))
    rows = persons.where((F.col("status") == FUTURE) & day.isNotNull())
    ref, now = F.lit(run_day).cast("date"), F.lit(today).cast("date")
    # One row per effect day: bounded by the calendar, not by the population.
    hist = rows.groupBy(day.alias("day")).agg(F.count("*").alias("n"))
    hist = hist.select(F.datediff("day", ref).alias("d"), F.datediff("day", now).alias("left"), "n")
    entries = F.array_sort(F.collect_list(F.struct("d", "n")))
    agg = hist.agg(
        F.sum("n").alias("n"),
        F.sum(F.col("d") * F.col("n")).alias("total"),
        F.min("d").alias("d_min"),
        F.max("d").alias("d_max"),
        entries.alias("hist"),
        *[
            F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).alias(name)
            for name, cond in {
                "b0_30": F.col("d") <= 30,
                "b31_60": (F.col("d") > 30) & (F.col("d") <= 60),
                "b61_90": (F.col("d") > 60) & (F.col("d") <= 90),
                "b91_180": (F.col("d") > 90) & (F.col("d") <= 180),
                "b181": F.col("d") > 180,
                "gt30": F.col("left") > 30,
                "gt60": F.col("left") > 60,
                "gt90": F.col("left") > 90,
            }.items()
        ],
    )
    # Position n // 2 in sorted order: the first day whose running count exceeds it.
    walk = F.aggregate(
        "hist",
        F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("int").alias("hit")),
        lambda acc, x: F.struct(
            (acc["seen"] + x["n"]).alias("seen"),
            F.when(
                acc["hit"].isNull() & ((acc["seen"] + x["n"]) > F.floor(F.col("n") / 2)), x["d"]
            ).otherwise(acc["hit"]).alias("hit"),
        ),
    )["hit"]
    return agg.select(
        F.coalesce("n", F.lit(0)).cast("bigint").alias("population"),
        F.coalesce(F.round(F.col("total") / F.col("n"), 1), F.lit(0.0)).alias("mean_days"),
        F.coalesce(walk, F.lit(0)).cast("bigint").alias("median_days"),
        F.coalesce("d_min", F.lit(0)).cast("bigint").alias("min_days"),
        F.coalesce("d_max", F.lit(0)).cast("bigint").alias("max_days"),
        *[F.col(c).cast("bigint").alias(c) for c in ("b0_30", "b31_60", "b61_90", "b91_180", "b181", "gt30", "gt60", "gt90")],
    )
