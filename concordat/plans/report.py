"""The KPI document of a run: all blocks as long facts, then nested JSON."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.plans.supervision import KPI_PATHS
from concordat.session import materialize_union

FIELDS = ("section", "block", "indicator", "measure", "value")
# The published documents and the sections each one holds.
THEMES = {
    "Modele_clean": None,
    "KPI_CIAM": ("5_CIAM",),
    "KPI_IEHE": ("6_IEHE",),
    "KPI_Carte_TP": ("7_Carte_TP",),
    "KPI_Synthese_Volumetrie_Qualite": ("2_Volumetrie_Brute", "3_Population_Unique", "4_Qualite_Donnees", "Highlights"),
}
# Indicators repeated at the head of the synthesis.
HIGHLIGHTS = {
    "CIAM_Taux_Couverture": KPI_PATHS["taux_matching_ciam"],
    "CIAM_Rapproches": ("5_CIAM", "Matching_Global", "rapproches", "Nombre"),
    "CIAM_Non_Rapproches": KPI_PATHS["non_rapproches"],
    "IEHE_Taux_Presence": KPI_PATHS["taux_presence_iehe"],
    "IEHE_Manquants": KPI_PATHS["manquants_iehe"],
    "TP_Taux_Eligible": KPI_PATHS["taux_eligibilite_tp"],
    "Score_Data_Quality_OK_Pct": KPI_PATHS["score_qualite"],
    "Score_Data_Quality_KO_Nombre": ("5_CIAM", "Score_Qualite_Donnees", "DATA_QUALITY_KO", "Nombre"),
}


class Block(NamedTuple):
    """Where the rows of an operator's result stand in the document."""

    result: str
    section: str
    name: str
    indicator: str
    measures: dict[str, str]
    where: str = "true"


def _by(*columns: str) -> str:
    return f"concat_ws(' / ', {', '.join(columns)})"


_FACTS = {"Nombre": "nombre", "Pct": "pct"}
_LINES = {"Lignes": "lignes", "Personnes": "personnes", "Delta": "delta"}
_CARD = {"Base": "base", "Eligible": "eligible", "Future": "future", "Taux_Eligible": "rate_eligible"}
_MATCH = {"Total": "total", "Rapproches": "rapproches", "Non_Rapproches": "non_rapproches", "Taux": "taux"}
# Sections and names of the published blocks.
BLOCKS = (
    Block("volume_raw", "2_Volumetrie_Brute", "Resultats", "indicator", _FACTS),
    Block("population_unique", "3_Population_Unique", "Resultats", "indicator", _FACTS),
    Block("cross_role_ids", "4_Qualite_Donnees", "Doublons", "indicator", _FACTS),
    Block("duplicate_contracts", "4_Qualite_Donnees", "Contrats_Multiples", _by("kind", "member_type"), {"Personnes": "persons"}),
    Block("multi_key_persons", "4_Qualite_Donnees", "Detail_KPEP", "bucket", {"Total": "total", "Dont_Assures": "insured"}),
    Block("completeness_keys", "4_Qualite_Donnees", "Completude_Cles", "indicator", _FACTS),
    Block("completeness_fields", "4_Qualite_Donnees", "Completude_Champs", "indicator", _FACTS),
    Block("cancel_rate", "4_Qualite_Donnees", "Radiations", "indicator", _FACTS),
    Block("placeholder_births", "4_Qualite_Donnees", "Naissances_Par_Defaut", "indicator", _FACTS),
    Block("match_totals", "5_CIAM", "Matching_Global", "label", _FACTS, "view = 'GLOBAL'"),
    Block("match_totals", "5_CIAM", "Par_Methode", "label", {"Nombre": "nombre"}, "view = 'METHODE'"),
    Block("match_by_segment", "5_CIAM", "Matching_Par_Societe", "label", _MATCH, "view = 'SOCIETE'"),
    Block("match_by_segment", "5_CIAM", "Matching_Par_Segment", _by("view", "label"), _MATCH, "view <> 'SOCIETE'"),
    Block("match_method_by_company", "5_CIAM", "Methodes_Par_Societe", _by("match_method", "company"), {"Personnes": "persons"}),
    Block("unmatched_breakdown", "5_CIAM", "Non_Rapproches", "indicator", _FACTS),
    Block("matched_email_empty", "5_CIAM", "Emails_Des_Comptes", "indicator", _FACTS),
    Block("email_consistency", "5_CIAM", "Coherence_Emails", "indicator", _FACTS),
    Block("email_quality", "5_CIAM", "Qualite_Emails", _by("source", "view", "label"), _FACTS),
    Block("account_quality", "5_CIAM", "Qualite_Comptes_CIAM", "indicator", _FACTS),
    Block("key_coherence_two", "5_CIAM", "Coherence_KPEP_2_Sources", "indicator", _FACTS),
    Block("key_coherence_three", "5_CIAM", "Coherence_KPEP_3_Sources", "indicator", _FACTS),
    Block("quality_score", "5_CIAM", "Score_Qualite_Donnees", "indicator", _FACTS),
    Block(
        "registry_presence_by_type", "6_IEHE", "Presence_Globale", "member_type",
        {"Reference": "reference", "Presents": "presents", "Manquants": "manquants", "Taux_Presents": "taux_presents"},
    ),
    Block("lines_vs_persons", "6_IEHE", "Lignes_Et_Personnes", _by("scope", "member_type"), _LINES),
    Block("registry_email_quality", "6_IEHE", "Qualite_Emails", "indicator", _FACTS),
    Block("registry_email_concordance", "6_IEHE", "Concordance_Email", "indicator", _FACTS),
    Block("registry_company_concordance", "6_IEHE", "Concordance_Societe", "indicator", _FACTS),
    Block("card_kpis", "7_Carte_TP", "Eligibilite_Globale", "view", _CARD, "view = 'TOTAL'"),
    Block("card_kpis", "7_Carte_TP", "Eligibilite_Detail", _by("view", "label"), _CARD, "view <> 'TOTAL'"),
    Block("card_by_company", "7_Carte_TP", "Eligibilite_Par_Societe", "company", {"Eligible": "eligible", "Future": "future"}),
    Block(
        "card_delay", "7_Carte_TP", "Delai", "'carte'",
        {"Population": "population", "Moyenne": "mean_days", "Mediane": "median_days", "Minimum": "min_days", "Maximum": "max_days", "Plus_30": "gt30",
         "Plus_60": "gt60", "Plus_90": "gt90"},
    ),
    Block(
        "card_unmatched", "7_Carte_TP", "Non_Rapproches", "'carte'",
        {"Eligibles": "eligible", "Non_Rapproches": "unmatched", "Eligibles_Non_Rapproches": "eligible_unmatched", "Taux": "pct_unmatched"},
    ),
    Block("card_registry_correlation", "7_Carte_TP", "Correlation_IEHE", _by("scope", "member_type", "status"), _LINES),
    Block(
        "document_kpis", "7_Carte_TP", "Controle_GED_Quotidien", "company",
        {"Population_Eligible": "eligible", "Trouves_GED": "found", "Non_Trouves_GED": "not_found", "Taux_GED": "rate_found", "Rapproche_Final": "matched_final"},
    ),
    Block("oldest_reject_per_box", "8_Prestations", "Plus_Anciens_Rejets", _by("groupe", "box"), {"Age_Jours": "age_jours_max"}),
)


def block(df: DataFrame, *places: Block) -> DataFrame:
    """Long facts of one result at all its places: a row per place, indicator and measure, from one pass over the result."""
    cells = F.array(*[
        F.struct(
            F.lit(b.section).alias("section"), F.lit(b.name).alias("block"), F.expr(b.indicator).alias("indicator"), F.lit(m).alias("measure"),
            F.when(F.expr(b.where), F.col(c).cast("double")).alias("value"),
        )
        for b in places for m, c in b.measures.items()
    ])
    return df.select(F.inline(cells)).where("value is not null")


def kpi_report(results: Mapping[str, DataFrame], blocks: Sequence[Block] = BLOCKS) -> DataFrame:
    """All blocks of a run as ``(section, block, indicator, measure, value)``.

    ``results`` holds the operators' results by name; every entry of ``blocks``
    places the rows of one of them, and a result is asked for once, whatever
    the number of its blocks.  The results are written one after the other,
    since the plan of all of them grows beyond a driver; a mapping that makes a
    result when it is asked for keeps their plans apart too.
    """
    places: dict[str, list[Block]] = {}
    for b in blocks:
        places.setdefault(b.result, []).append(b)
    return materialize_union(block(results[name], *found) for name, found in places.items())


def blocks_at(*paths: Sequence[str]) -> tuple[Block, ...]:
    """The blocks that hold the facts below paths of the document that begin with section and block."""
    wanted = {tuple(path[:2]) for path in paths}
    return tuple(b for b in BLOCKS if (b.section, b.name) in wanted)


def highlights(facts: DataFrame) -> DataFrame:
    """The head indicators as facts of their own section."""
    place = F.concat_ws("|", "section", "block", "indicator", "measure")
    labels = F.create_map(*[F.lit(x) for label, path in HIGHLIGHTS.items() for x in ("|".join(path), label)])
    rows = facts.withColumn("label", F.try_element_at(labels, place)).where("label is not null")
    return rows.select(F.lit("Highlights").alias("section"), F.lit("Synthese").alias("block"), F.col("label").alias("indicator"), F.lit("Valeur").alias("measure"), "value")


def kpi_thematic(facts: DataFrame) -> DataFrame:
    """Facts of each published document, tagged with its name; every theme reads ``facts``, so hand over a written frame."""
    every = facts.unionByName(highlights(facts))
    out = None
    for theme, sections in THEMES.items():
        rows = facts if sections is None else every.where(F.col("section").isin(*sections))
        part = rows.select(F.lit(theme).alias("theme"), *FIELDS)
        out = part if out is None else out.unionByName(part)
    return out


def to_document(facts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One nested JSON document per key from long facts (a few thousand rows per run)."""
    levels = ("section", "block", "indicator", "measure")
    rows, value = facts, F.col("value")
    for i in range(len(levels) - 1, -1, -1):
        pairs = F.collect_list(F.struct(F.col(levels[i]).alias("k"), value.alias("v")))
        entries = F.map_from_entries(F.array_sort(pairs, lambda a, b: F.when(a["k"] < b["k"], -1).otherwise(1)))
        rows = rows.groupBy(*keys, *levels[:i]).agg(entries.alias("doc"))
        value = F.col("doc")
    return rows.select(*keys, F.to_json("doc").alias("payload"))
