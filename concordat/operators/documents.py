"""Document control: eligible contracts against the keys of the document store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.functions import pct2, squeeze
from concordat.operators.common import count_where, first_row, lookup_join
from concordat.operators.normalize import INSURED_TYPES, SPOUSE_MARK

# Scope of the document control.
EXCLUDED_OFFER_PREFIXES = ("INP", "MEP")
EXCLUDED_COMPANY = "073"
DECISIONS = {"FORCE_RAPPROCHE": "RAPPROCHE", "FORCE_NON_RAPPROCHE": "NON_RAPPROCHE"}


def eligibility_reason(member_type: Column, offer: Column, company: Column) -> Column:
    """First reason that excludes a contract; '' when it is eligible."""
    kind = F.coalesce(F.upper(squeeze(member_type)), F.lit(""))
    code = F.coalesce(F.upper(squeeze(offer)), F.lit(""))
    prefixed = F.lit(False)
    for prefix in EXCLUDED_OFFER_PREFIXES:
        prefixed = prefixed | code.startswith(prefix)
    label = F.when(kind == "", "vide").otherwise(kind)
    return (
        F.when(kind.contains(SPOUSE_MARK), "Conjoint")
        .when(~kind.isin(*INSURED_TYPES), F.concat(F.lit("Type assuré non éligible ("), label, F.lit(")")))
        .when(prefixed, "Offre exclue (INP*/MEP*)")
        .when(F.coalesce(squeeze(company), F.lit("")) == EXCLUDED_COMPANY, "Société exclue (073)")
        .otherwise("")
    )


def document_eligibility(member: DataFrame) -> DataFrame:
    """Contract rows with the exclusion reason and the eligibility flag."""
    rows = member.withColumn("reason", eligibility_reason(F.col("member_type"), F.col("offer"), F.col("company")))
    return rows.withColumn("eligible", F.col("reason") == "")


def _registry_key() -> Column:
    """Person key of a registry row: its own key column, else a group id that is one."""
    own = F.coalesce(squeeze(F.col("kpep_iehe")), F.lit(""))
    group = F.coalesce(squeeze(F.col("idrpp")), F.lit(""))
    own = F.when(F.lower(own).isin("nan", "none", "null"), "").otherwise(own)
    return F.when(own != "", own).when(F.upper(group).startswith("KPEP"), group).otherwise("")


def key_with_fallback(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """Reference key of (person, company): exact, else another company's, else none.

    Among other companies a named one is preferred, then registry order.
    """
    keys = registry.select(
        squeeze(F.col("refperboccn")).alias("person_id"),
        F.coalesce(squeeze(F.col("socappr")), F.lit("")).alias("company"),
        _registry_key().alias("key"),
        "seq",
    ).where("key <> '' and coalesce(person_id, '') <> ''")
    exact = first_row(keys, ["person_id", "company"], [F.col("seq")])
    exact = exact.select("person_id", "company", F.col("key").alias("__exact"))
    other = first_row(keys, ["person_id"], [F.when(F.col("company") != "", 0).otherwise(1), F.col("seq")])
    other = other.select("person_id", F.col("key").alias("__other"))
    out = lookup_join(lookup_join(rows, exact, ["person_id", "company"]), other, ["person_id"])
    return out.select(
        *rows.columns,
        F.upper(F.coalesce("__exact", "__other", F.lit(""))).alias("kpep_reference"),
        F.when(F.col("__exact").isNotNull(), "match_societe")
        .when(F.col("__other").isNotNull(), "fallback_autre_societe")
        .otherwise("absent_iehe")
        .alias("motif_kpep"),
    )


def clean_keys(document_keys: DataFrame) -> DataFrame:
    """Distinct document keys, upper case and stripped."""
    key = F.upper(squeeze(F.col(document_keys.columns[0])))
    return document_keys.select(key.alias("kpep_reference")).where("kpep_reference <> ''").distinct()


def document_presence(rows: DataFrame, document_keys: DataFrame) -> DataFrame:
    """Presence in the document store, raw status and reason of keyed contracts."""
    known = clean_keys(document_keys).withColumn("__in", F.lit(True))
    out = lookup_join(rows, known, ["kpep_reference"])
    present = F.coalesce(F.col("__in"), F.lit(False)) & (F.col("kpep_reference") != "")
    return out.select(
        *rows.columns,
        F.when(present, "OUI").otherwise("NON").alias("present_ged"),
        F.when(present, "RAPPROCHE").otherwise("NON_RAPPROCHE").alias("statut_rapprochement"),
        F.when(F.col("kpep_reference") == "", "KPEP IEHE absent")
        .when(F.col("motif_kpep") == "fallback_autre_societe", "KPEP IEHE société différente (fallback)")
        .otherwise("")
        .alias("motif"),
    )


def override_by_specificity(rows: DataFrame, corrections: DataFrame) -> DataFrame:
    """Apply manual corrections: most specific wins, the last duplicate wins.

    A correction names a key and optionally company and offer; blanks are
    wildcards for the offer, or for company and offer together.
    """
    clean = corrections.select(
        F.upper(squeeze(F.col("kpep_ref"))).alias("kpep_reference"),
        F.coalesce(squeeze(F.col("code_societe")), F.lit("")).alias("company"),
        F.coalesce(F.upper(squeeze(F.col("offre"))), F.lit("")).alias("offer"),
        F.upper(squeeze(F.col("decision_manuelle"))).alias("decision"),
        F.coalesce(squeeze(F.col("commentaire")), F.lit("")).alias("note"),
        "seq",
    ).where((F.coalesce("kpep_reference", F.lit("")) != "") & F.col("decision").isin(*DECISIONS))
    last = first_row(clean, ["kpep_reference", "company", "offer"], [F.col("seq").desc()])

    def level(cond: Column, name: str) -> DataFrame:
        return last.where(cond).withColumn(name, F.struct("decision", "note")).drop("decision", "note", "seq")

    exact = level(F.lit(True), "__c1")
    by_company = level(F.col("offer") == "", "__c2").drop("offer")
    by_key = level((F.col("offer") == "") & (F.col("company") == ""), "__c3").drop("offer", "company")
    out = lookup_join(rows, exact, ["kpep_reference", "company", "offer"])
    out = lookup_join(out, by_company, ["kpep_reference", "company"])
    out = lookup_join(out, by_key, ["kpep_reference"])
    pick = F.coalesce("__c1", "__c2", "__c3")
    forced = F.when(pick["decision"] == "FORCE_RAPPROCHE", "RAPPROCHE").when(
        pick["decision"] == "FORCE_NON_RAPPROCHE", "NON_RAPPROCHE"
    )
    final = F.coalesce(forced, F.col("statut_rapprochement"))
    note = F.when(pick.isNull(), "").otherwise(
        F.btrim(F.concat(F.lit("["), pick["decision"], F.lit("] "), pick["note"]))
    )
    return out.select(
        *rows.columns,
        final.alias("statut_final"),
        F.when(final != F.col("statut_rapprochement"), "OUI").otherwise("NON").alias("correction_manuelle"),
        note.alias("commentaire"),
    )


def document_control(
    member: DataFrame, registry: DataFrame, document_keys: DataFrame, corrections: DataFrame
) -> DataFrame:
    """Full control of a run: one row per eligible contract."""
    rows = document_eligibility(member).where((F.col("reason") == "") & (F.coalesce("person_id", F.lit("")) != ""))
    keyed = key_with_fallback(rows.drop("reason", "eligible"), registry)
    return override_by_specificity(document_presence(keyed, document_keys), corrections)


def tracking_rows(member: DataFrame, registry: DataFrame) -> DataFrame:
    """Distinct (key, reason) of eligible contracts for the tracking table."""
    rows = document_eligibility(member).where((F.col("reason") == "") & (F.coalesce("person_id", F.lit("")) != ""))
    keyed = key_with_fallback(rows, registry)
    reason = F.when(F.col("kpep_reference") == "", "non rapproché iehe")
    return keyed.select(F.upper(squeeze(F.col("kpep"))).alias("kpep"), reason.alias("motif")).distinct()


def document_kpis(detail: DataFrame) -> DataFrame:
    """Counts and rates of the control, in total and by company."""
    flags = [
        F.count("*").alias("eligible"),
        count_where(F.col("present_ged") == "OUI").alias("found"),
        count_where(F.col("present_ged") == "NON").alias("not_found"),
        count_where(F.col("correction_manuelle") == "OUI").alias("corrected"),
        count_where(F.col("statut_final") == "RAPPROCHE").alias("matched_final"),
        count_where(F.col("statut_final") == "NON_RAPPROCHE").alias("unmatched_final"),
    ]
    company = F.when(F.coalesce("company", F.lit("")) == "", "(vide)").otherwise(F.col("company"))
    rows = detail.select(company.alias("company"), "present_ged", "correction_manuelle", "statut_final")
    out = rows.rollup("company").agg(*flags)
    return out.select(
        F.coalesce("company", F.lit("TOTAL")).alias("company"),
        "eligible", "found", "not_found", "corrected", "matched_final", "unmatched_final",
        pct2(F.col("found"), F.col("eligible")).alias("rate_found"),
        pct2(F.col("corrected"), F.col("eligible")).alias("rate_corrected"),
        pct2(F.col("matched_final"), F.col("eligible")).alias("rate_final"),
    )


def retry_document(
    ledger: DataFrame, registry: DataFrame, document_keys: DataFrame, corrections: DataFrame, today: str
) -> DataFrame:
    """Second look at open ledger rows: missing keys, presence, corrections, status.

    A row without a key even now keeps its old verdict; rows already OK are
    untouched.
    """
    base = ledger.columns
    is_open = F.upper(F.col("statut_retry")) == "KO"
    todo = ledger.where(is_open)
    done = ledger.where(~is_open)
    fresh = key_with_fallback(
        todo.withColumnRenamed("kpep_reference", "__old_key").withColumnRenamed("motif_kpep", "__old_motif"), registry
    )
    had = F.coalesce(F.upper(squeeze(F.col("__old_key"))), F.lit("")) != ""
    got = F.col("kpep_reference") != ""
    fresh = fresh.withColumn("motif_kpep", F.when(~had & got, F.col("motif_kpep")).otherwise(F.col("__old_motif")))
    fresh = fresh.withColumn("kpep_reference", F.when(had, F.upper(squeeze(F.col("__old_key")))).otherwise(F.col("kpep_reference")))
    old = {c: c + "__old" for c in ("present_ged", "statut_rapprochement", "motif", "statut_final", "correction_manuelle", "commentaire")}
    for name, kept in old.items():
        fresh = fresh.withColumnRenamed(name, kept)
    judged = override_by_specificity(document_presence(fresh, document_keys), corrections)
    keyed = F.col("kpep_reference") != ""
    out = {name: F.when(keyed, F.col(name)).otherwise(F.col(kept)) for name, kept in old.items()}
    out["commentaire"] = F.when(keyed & (F.col("commentaire") != ""), F.col("commentaire")).otherwise(F.col("commentaire__old"))
    out["statut_retry"] = F.when(keyed & (F.col("statut_final") == "RAPPROCHE"), "OK").otherwise(F.col("statut_retry"))
    out["date_derniere_verif"] = F.lit(today)
    judged = judged.select(*[out.get(c, F.col(c)).alias(c) for c in base])
    return judged.unionByName(done)
