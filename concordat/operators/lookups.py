"""Attribute look-ups over several sources and several snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordat.functions import day_delta, iso_date, normalize_text, run_date, squeeze
from concordat.operators.card import status_of
from concordat.operators.common import first_row, lookup_join

ATTRIBUTES = ("member_type", "offer", "company", "adhesion_date", "effect_date")


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    """Rows of the newest run; runs are ordered by date, not by text.

    The newest run is a scalar subquery over the run column, so a table
    partitioned by run reads one partition.
    """
    runs = snapshots.select("flux_id").distinct().withColumn("__day", run_date(F.col("flux_id")))
    newest = runs.where("__day is not null").orderBy(F.col("__day").desc()).limit(1).select("flux_id")
    return snapshots.join(F.broadcast(newest), "flux_id", "left_semi")  # one row


def historical_lookup(snapshots: DataFrame, current: str | None = None) -> DataFrame:
    """Attributes of every person from the newest snapshot holding them.

    All snapshots count, without a cap; the current run is left out.  Where runs
    come day by day, ``sources.newest`` keeps this result as a table instead.
    """
    rows = snapshots.where(F.coalesce("person_id", F.lit("")) != "").withColumn("__day", run_date(F.col("flux_id")))
    rows = rows.where("__day is not null")
    if current is not None:
        rows = rows.where(F.col("flux_id") != current)
    best = first_row(rows.select("person_id", "flux_id", "seq", "__day", *ATTRIBUTES), ["person_id"], [F.col("__day").desc(), F.col("seq")])
    return best.select("person_id", "flux_id", *ATTRIBUTES)


def _pick(*cols: Column) -> Column:
    return F.coalesce(*[F.nullif(squeeze(c), F.lit("")) for c in cols], F.lit(""))


def attribute_by_source_priority(ledger: DataFrame, snapshots: DataFrame, current: str, past: DataFrame | None = None) -> DataFrame:
    """Fill missing ledger attributes and derive the card label.

    Sources in order: the row itself, the snapshot of the same run, the current
    snapshot, older snapshots.  The stored eligibility flag counts only when
    the row itself carries its member type.  ``past`` may hand in the newest
    attributes before ``current`` (``sources.newest``); ``snapshots`` then need only
    hold the runs of the ledger and the current one.
    """
    run = F.regexp_extract("source_file", r"^(\d{8})", 1)
    # The ledger is small beside the history: only its persons are ranked.
    snapshots = lookup_join(snapshots, ledger.select("person_id").distinct(), ["person_id"], "left_semi")
    usable = snapshots.where(F.coalesce("person_id", F.lit("")) != "")
    same = first_row(usable, ["flux_id", "person_id"], [F.col("seq")])
    now = first_row(usable.where(F.col("flux_id") == current), ["person_id"], [F.col("seq")])
    past = historical_lookup(snapshots, current) if past is None else past

    def side(df: DataFrame, mark: str, keys: list[str]) -> DataFrame:
        return df.select(*keys, *[F.col(c).alias(mark + c) for c in ATTRIBUTES])

    rows = lookup_join(ledger.withColumn("flux_id", run), side(same, "s_", ["flux_id", "person_id"]), ["flux_id", "person_id"])
    rows = lookup_join(rows, side(now, "n_", ["person_id"]), ["person_id"])
    rows = lookup_join(rows, side(past, "h_", ["person_id"]), ["person_id"])
    own = {
        "member_type": normalize_text(F.col("member_type")),
        "offer": normalize_text(F.col("offer")),
        "company": squeeze(F.col("company")),
        "adhesion_date": iso_date(F.col("adhesion_date")),
        "effect_date": iso_date(F.col("effect_date")),
    }
    full = rows.select(
        *[c for c in ledger.columns if c not in ATTRIBUTES],
        (own["member_type"] != "").alias("typed"),
        *[_pick(own[c], F.col("s_" + c), F.col("n_" + c), F.col("h_" + c)).alias(c) for c in ATTRIBUTES],
    )
    delta = day_delta(F.col("effect_date"), F.col("adhesion_date"))
    flag, value = normalize_text(F.col("eligible")), normalize_text(F.col("card_value"))
    status = status_of(F.col("member_type"), F.col("offer"), F.col("company"), delta)
    label = (
        F.when(F.col("typed") & (flag == "N"), "Hors_Perimetre_TP")
        .when(F.col("typed") & (flag == "O") & (value == "FUTUR"), "Future_TP")
        .when(F.col("typed") & (flag == "O"), F.when(delta <= 21, "Eligible_TP").otherwise("Future_TP"))
        .when(status == "ELIGIBLE_TP", "Eligible_TP")
        .when(status == "FUTURE_TP", "Future_TP")
        .otherwise("Hors_Perimetre_TP")
    )
    kind = F.when(F.col("member_type") == "", "INCONNU").otherwise(F.col("member_type"))
    return full.withColumn("label", label).withColumn("member_type", kind).drop("typed")


def offer_enrich(df: DataFrame, mapping: DataFrame, offer: str = "offer") -> DataFrame:
    """Nature and company of an offer; unknown offers keep their code and get '?'.

    ``mapping`` is the small offer dimension: ``(code, nature, societe)``.
    """
    code = F.coalesce(F.upper(squeeze(F.col(offer))), F.lit(""))
    dim = mapping.select(F.upper(squeeze(F.col("code"))).alias("__code"), "nature", "societe")
    rows = df.withColumn("__code", code)
    rows = lookup_join(rows, dim, ["__code"])
    return rows.select(
        *df.columns, F.coalesce("nature", "__code").alias("nature"), F.coalesce("societe", F.lit("?")).alias("societe")
    )
