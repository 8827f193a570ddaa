"""Canonical frames of one data folder, built with the operators."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.operators import activity as av
from concordat.operators import card as cd
from concordat.operators import documents as dc
from concordat.operators import lookups as lk
from concordat.operators import matching as mt
from concordat.operators import normalize as nz
from concordat.operators import registry as rg
from concordat.operators.common import first_row, lookup_join
from concordat.workload.registry import Frames


def _plan(fn):
    """Build each canonical plan once per data folder."""

    @wraps(fn)
    def wrapped(f: Frames) -> DataFrame:
        key = "canon." + fn.__name__
        if key not in f.plans:
            f.plans[key] = fn(f)
        return f.plans[key]

    return wrapped


@_plan
def member(f: Frames) -> DataFrame:
    return nz.normalize_member(f.member_raw)


@_plan
def member_base(f: Frames) -> DataFrame:
    """Contracts without the effect date: spares the scan of the claim lines."""
    return nz.normalize_member(f.member_base_raw)


@_plan
def insured(f: Frames) -> DataFrame:
    return member_base(f).where(nz.is_insured(F.col("member_type")))


@_plan
def accounts(f: Frames) -> DataFrame:
    return nz.normalize_account(f.ck_raw, f.cm_raw)


@_plan
def last_accounts(f: Frames) -> DataFrame:
    return nz.normalize_search(f.last_raw, "LAST", 3)


@_plan
def middle_accounts(f: Frames) -> DataFrame:
    return nz.normalize_search(f.middle_raw, "MIDDLE", 4)


@_plan
def account_ref(f: Frames) -> DataFrame:
    return nz.account_reference(accounts(f))


@_plan
def match(f: Frames) -> DataFrame:
    return mt.match_cascade(insured(f), accounts(f), last_accounts(f), middle_accounts(f))


@_plan
def matched(f: Frames) -> DataFrame:
    """Matched persons with the attributes of their account."""
    return with_account(match(f), account_ref(f))


def with_account(match_rows: DataFrame, ref: DataFrame) -> DataFrame:
    hit = match_rows.where(F.col("match_status") == mt.MATCHED)
    return lookup_join(hit, ref.withColumnRenamed("id", "matched_id"), ["matched_id"])


@_plan
def registry(f: Frames) -> DataFrame:
    """Registry rows of the people in the snapshot, with their person key."""
    ids = member_base(f).select(F.col("person_id").alias("refperboccn"))
    return rg.registry_self_join(f.registry_raw, ids)


@_plan
def registry_first(f: Frames) -> DataFrame:
    return first_row(registry(f), ["refperboccn"], [F.col("seq")])


@_plan
def propagated(f: Frames) -> DataFrame:
    """Insured contracts with the person's match and the account attributes."""
    return mt.match_propagate(insured(f), match(f), accounts(f), last_accounts(f), middle_accounts(f))


@_plan
def user_events(f: Frames) -> DataFrame:
    """Directory event log in epoch milliseconds."""
    kind = F.when(F.col("event_type") == "click", "LOGIN").when(F.col("event_type") == "purchase", "UPDATE_PROFILE")
    return f.events.select(
        "event_id",
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("user_id"),
        F.coalesce(kind, F.upper("event_type")).alias("type"),
        F.concat(F.lit("app-"), F.col("event_type")).alias("client_id"),
        av.to_epoch_ms(F.col("ts")).alias("event_time"),
    )


CURRENT_RUN = "31122001"


@_plan
def person_card(f: Frames) -> DataFrame:
    return cd.person_card(member(f))


@_plan
def snapshots(f: Frames) -> DataFrame:
    """All runs of the snapshot: one per year of adhesion."""
    return nz.normalize_member(f.member_raw, keep=("seq", "flux_id"))


@_plan
def snapshots_base(f: Frames) -> DataFrame:
    """All runs without the effect date."""
    return nz.normalize_member(f.member_base_raw, keep=("seq", "flux_id"))


@_plan
def ko_labelled(f: Frames) -> DataFrame:
    return lk.attribute_by_source_priority(f.ko_ledger, snapshots(f), CURRENT_RUN)


@_plan
def eligible(f: Frames) -> DataFrame:
    """Contracts eligible for the document control."""
    return dc.document_eligibility(member_base(f)).where("reason = ''").drop("reason", "eligible")


@_plan
def document_detail(f: Frames) -> DataFrame:
    return dc.document_control(member_base(f), registry(f), f.document_keys, f.corrections)


@_plan
def offer_mapping(f: Frames) -> DataFrame:
    """Offer dimension read off the snapshot; one offer is left unmapped."""
    o = F.col("offre")
    nature = (
        F.when(F.lower(o).startswith("mesmen"), "MEN").when(o.startswith("MESMEAE"), "MEAE").when(o.startswith("MESLAD"), "MSOL")
        .when(o == "INPPREVIND", "PREV_INDIV").when(o == "INPCULT002", "PREV_CULTURE").otherwise("MSP")
    )
    societe = F.when(o.startswith("MES"), "010").when(o.startswith("IN"), "044").otherwise("052")
    rows = f.member_base_raw.where("offre is not null and offre <> 'INDSANTE1'")
    return rows.select(F.upper(F.btrim(o)).alias("code"), nature.alias("nature"), societe.alias("societe")).distinct()
