"""Person-key registry: look-ups, presence and enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.functions import squeeze
from concordat.operators.common import first_row, lookup_join

KEY_MARK = "KPEP"
PRESENT, ABSENT = "Présent dans IEHE", "Non présent dans IEHE"


def reference_lookup(ids: DataFrame, registry: DataFrame, id_col: str = "refperboccn") -> DataFrame:
    """Registry rows of a set of ids."""
    wanted = ids.select(F.col(ids.columns[0]).alias(id_col)).distinct()
    return lookup_join(registry, wanted, [id_col], "left_semi")


def person_keys(registry: DataFrame) -> DataFrame:
    """One representative person key per person group."""
    key = F.when(F.col("refperboccn").startswith(KEY_MARK), F.col("refperboccn"))
    return registry.where(key.isNotNull()).groupBy("idrpp").agg(F.min(key).alias("kpep_iehe"))


def registry_self_join(registry: DataFrame, ids: DataFrame) -> DataFrame:
    """Distinct registry rows of the requested ids, with the key of their group.

    Rows without a group have nothing to be joined with and are left out.
    """
    rows = reference_lookup(ids, registry.where("idrpp is not null"))
    return lookup_join(rows.distinct(), person_keys(registry), ["idrpp"])


def registry_presence(persons: DataFrame, registry: DataFrame) -> DataFrame:
    """Persons with a flag telling whether the registry knows them."""
    known = registry.select(squeeze(F.col("refperboccn")).alias("person_id")).where("person_id <> ''")
    known = known.distinct().withColumn("present", F.lit(1))
    return lookup_join(persons, known, ["person_id"]).withColumn(
        "present", F.coalesce(F.col("present"), F.lit(0))
    )


def registry_enrich(member: DataFrame, registry: DataFrame, suffix: str = "_iehe") -> DataFrame:
    """Contract rows with one representative registry row; clashing names get a suffix."""
    one = first_row(registry, ["refperboccn"], [F.col("seq")]).drop("seq")
    renamed = one.select(
        F.col("refperboccn").alias("person_id"),
        *[F.col(c).alias(c + suffix if c in member.columns else c) for c in one.columns if c != "refperboccn"],
    )
    return lookup_join(member, renamed, ["person_id"])


def retry_registry(ledger: DataFrame, registry: DataFrame, today: str) -> DataFrame:
    """Re-check open ledger rows against the registry.

    A person found becomes OK with mail and key; every open row gets the check
    date; rows already OK stay untouched.
    """
    hit = lookup_join(registry.where("refperboccn is not null"), person_keys(registry), ["idrpp"])
    hit = first_row(hit, ["refperboccn"], [F.col("seq")]).select(
        squeeze(F.col("refperboccn")).alias("person_id"),
        F.coalesce("adrmailctc", F.lit("")).alias("__mail"),
        F.coalesce("kpep_iehe", F.lit("")).alias("__key"),
        F.lit(True).alias("__found"),
    )
    rows = lookup_join(ledger, hit, ["person_id"])
    is_open = F.col("statut_retry") == "KO"
    solved = is_open & F.coalesce(F.col("__found"), F.lit(False))
    out = {
        "statut_retry": F.when(solved, "OK").otherwise(F.col("statut_retry")),
        "date_derniere_verif": F.when(is_open, F.lit(today)).otherwise(F.col("date_derniere_verif")),
        "mail_iehe": F.when(solved, F.col("__mail")).otherwise(F.col("mail_iehe")),
        "kpep_iehe": F.when(solved, F.col("__key")).otherwise(F.col("kpep_iehe")),
    }
    return rows.select(*[out.get(c, F.col(c)).alias(c) for c in ledger.columns])
