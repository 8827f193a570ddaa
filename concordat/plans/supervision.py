"""Supervision of runs: series, deltas, alerts, comparisons.

History rows: flux_id, date_import, payload (one JSON document per run).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from concordat.functions import run_date
from concordat.sources.state import flatten_payload

# Where each followed indicator sits in the published document, as
# (section, block, indicator, measure).  The report, its head indicators and the
# series of runs all read this table.
KPI_PATHS = {
    "volume_flux": ("2_Volumetrie_Brute", "Resultats", "lignes", "Nombre"),
    "personnes_uniques": ("3_Population_Unique", "Resultats", "personnes", "Nombre"),
    "cible_ciam": ("5_CIAM", "Matching_Global", "cible", "Nombre"),
    "taux_matching_ciam": ("5_CIAM", "Matching_Global", "rapproches", "Pct"),
    "non_rapproches": ("5_CIAM", "Matching_Global", "non_rapproches", "Nombre"),
    "score_qualite": ("5_CIAM", "Score_Qualite_Donnees", "DATA_QUALITY_OK", "Pct"),
    "taux_presence_iehe": ("6_IEHE", "Presence_Globale", "(tous)", "Taux_Presents"),
    "manquants_iehe": ("6_IEHE", "Presence_Globale", "(tous)", "Manquants"),
    "taux_eligibilite_tp": ("7_Carte_TP", "Eligibilite_Globale", "TOTAL", "Taux_Eligible"),
    "eligibles_tp": ("7_Carte_TP", "Eligibilite_Globale", "TOTAL", "Eligible"),
    "taux_ged": ("7_Carte_TP", "Controle_GED_Quotidien", "TOTAL", "Taux_GED"),
    "ged_trouves": ("7_Carte_TP", "Controle_GED_Quotidien", "TOTAL", "Trouves_GED"),
    "ged_ko": ("7_Carte_TP", "Controle_GED_Quotidien", "TOTAL", "Non_Trouves_GED"),
}
# Alert levels per indicator.
THRESHOLDS = (
    ("taux_matching_ciam", 99.0, 97.0, True),
    ("taux_presence_iehe", 99.9, 99.0, True),
    ("score_qualite", 99.0, 97.0, True),
    ("taux_eligibilite_tp", 50.0, 20.0, True),
    ("taux_ged", 50.0, 10.0, True),
)
ALERTED = ("taux_matching_ciam", "taux_presence_iehe", "score_qualite", "taux_eligibilite_tp")
STALE_HOURS = 48
LOW_DOCUMENT_RATE = 5.0
FEW = 20


def variant_number(document: Column, *path: str) -> Column:
    """Number at a path of a parsed document; NULL when absent or no number."""
    return F.try_variant_get(document, "$" + "".join(f"['{p}']" for p in path), "double")


def json_number(payload: Column, *path: str) -> Column:
    """Number at a path of a JSON text; NULL when absent or no number."""
    return variant_number(F.try_parse_json(payload), *path)


def nested_document(values: Mapping[tuple[str, ...], Column]) -> Column:
    """JSON document with one value per path."""
    tree: dict = {}
    for path, col in values.items():
        node = tree
        for part in path[:-1]:
            node = node.setdefault(part, {})
        node[path[-1]] = col

    def build(node):
        return F.struct(*[(build(v) if isinstance(v, dict) else v).alias(k) for k, v in node.items()])

    return F.to_json(build(tree))


def kpi_series(history: DataFrame, paths: Mapping[str, Sequence[str]] = KPI_PATHS) -> DataFrame:
    """One row per run and indicator; each document is parsed once, into a VARIANT."""
    parsed = history.select("flux_id", "date_import", F.try_parse_json("payload").alias("doc"))
    cells = F.array(*[F.struct(F.lit(k).alias("kpi"), variant_number(F.col("doc"), *p).alias("value")) for k, p in paths.items()])
    return parsed.select("flux_id", "date_import", F.inline(cells))


def threshold_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(THRESHOLDS), "kpi string, green double, orange double, higher_is_better boolean")


def kpi_threshold_override(defaults: DataFrame, overrides: DataFrame) -> DataFrame:
    """Default thresholds with overridden levels; unknown keys are ignored."""
    o = overrides.select("kpi", F.col("green").alias("g2"), F.col("orange").alias("o2"))
    rows = defaults.join(o, "kpi", "left")
    return rows.select("kpi", F.coalesce("g2", "green").alias("green"), F.coalesce("o2", "orange").alias("orange"), "higher_is_better")


def badge(value: Column) -> Column:
    """Level of a value against the thresholds of its row."""
    better = F.col("higher_is_better")
    reach = lambda level: F.when(better, value >= F.col(level)).otherwise(value <= F.col(level))
    return (
        F.when(value.isNull(), "na").when(better.isNull(), "neutral")
        .when(reach("green"), "green").when(reach("orange"), "orange").otherwise("red")
    )


def _by_run() -> Window:
    """One indicator's runs in date order: a few rows per day of service."""
    return Window.partitionBy("kpi").orderBy(run_date(F.col("flux_id")))


def previous_run_delta(series: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Value, change since the previous run, and badge, per run and indicator."""
    rows = series.withColumn("previous", F.lag("value").over(_by_run()))
    rows = rows.join(F.broadcast(thresholds), "kpi", "left")  # one row per followed indicator
    return rows.select(
        "flux_id", "kpi", "value", "previous", F.round(F.col("value") - F.col("previous"), 2).alias("delta"), badge(F.col("value")).alias("badge")
    )


def kpi_period_average(series: DataFrame, runs: int = 30) -> DataFrame:
    """Value against the mean of the last ``runs`` runs up to it."""
    frame = _by_run().rowsBetween(-(runs - 1), 0)
    # Indicators have two decimals at most: whole hundredths keep the mean exact.
    cents = F.round(F.col("value") * 100).cast("bigint")
    twice = F.sum(cents).over(frame) * 2 + F.count(cents).over(frame)
    n2 = F.nullif(F.count(cents).over(frame) * 2, F.lit(0))
    average = ((twice - F.pmod(twice, n2)) / n2) / F.lit(100.0)
    return series.select("flux_id", "kpi", "value", average.alias("average"))


def kpi_alerts(series: DataFrame, thresholds: DataFrame, now: str) -> DataFrame:
    """Alerts of every run: thresholds, unmatched persons, stale data, low document rate."""
    rows = series.join(F.broadcast(thresholds), "kpi", "left")  # one row per followed indicator
    level = badge(F.col("value"))
    v, kpi = F.col("value"), F.col("kpi")
    title = (
        F.when(kpi.isin(*ALERTED) & (level == "red"), F.struct(F.lit("err").alias("level"), F.concat(kpi, F.lit(" critique")).alias("title")))
        .when(kpi.isin(*ALERTED) & (level == "orange"), F.struct(F.lit("warn").alias("level"), F.concat(kpi, F.lit(" à surveiller")).alias("title")))
        .when((kpi == "non_rapproches") & (v > 0), F.struct(F.when(v <= FEW, "warn").otherwise("err").alias("level"), F.lit("Non-rapprochés").alias("title")))
        .when((kpi == "taux_ged") & (v <= LOW_DOCUMENT_RATE), F.struct(F.lit("warn").alias("level"), F.lit("Taux GED très bas").alias("title")))
    )
    raised = rows.select("flux_id", title.alias("a"), "value").where("a is not null").select("flux_id", "a.level", "a.title", "value")
    hours = F.timestamp_diff("HOUR", F.col("date_import"), F.lit(now).cast("timestamp_ntz"))
    newest = series.select("flux_id", "date_import").orderBy(run_date(F.col("flux_id")).desc()).limit(1)
    stale = newest.where(hours > STALE_HOURS).select("flux_id", F.lit("warn").alias("level"), F.lit("Données obsolètes").alias("title"), hours.cast("double").alias("value"))
    return raised.unionByName(stale)


def flatten_runs(history: DataFrame) -> DataFrame:
    """All leaves of all run documents as ``(flux_id, path, value)``."""
    return flatten_payload(history, "payload", ["flux_id"])


def compare_runs(history: DataFrame, run_a: str, run_b: str) -> DataFrame:
    """Two runs aligned by path: both values, numeric difference, and whether they differ."""
    leaves = flatten_runs(history.where(F.col("flux_id").isin(run_a, run_b)))
    wide = leaves.groupBy("path").agg(
        F.max(F.when(F.col("flux_id") == run_a, F.col("value"))).alias("a"), F.max(F.when(F.col("flux_id") == run_b, F.col("value"))).alias("b")
    )
    delta = F.round(F.col("b").try_cast("double") - F.col("a").try_cast("double"), 4)
    return wide.select("path", "a", "b", delta.alias("delta"), (~F.col("a").eqNullSafe(F.col("b"))).cast("int").alias("changed"))


def kpi_detail(facts: DataFrame, section: str, block: str, measures: Sequence[str]) -> DataFrame:
    """Drill-down table of a block: one row per indicator, one column per measure.

    ``facts``: section, block, indicator, measure, value.
    """
    rows = facts.where((F.col("section") == section) & (F.col("block") == block))
    return rows.groupBy("indicator").agg(*[F.max(F.when(F.col("measure") == m, F.col("value"))).alias(m) for m in measures])


# Anomalies followed, as (section, block, indicator).
ANOMALIES = {
    "Comptes sans email": ("5_CIAM", "Qualite_Comptes_CIAM", "sans_email"),
    "Comptes sans KPEP": ("5_CIAM", "Qualite_Comptes_CIAM", "sans_kpep"),
    "Doublons email CIAM": ("5_CIAM", "Qualite_Comptes_CIAM", "emails_partages"),
    "Emails à risque": ("5_CIAM", "Score_Qualite_Donnees", "Email_CIAM_risque"),
    "KPEP NS ≠ CIAM": ("5_CIAM", "Score_Qualite_Donnees", "KPEP_NS_diff_CIAM"),
    "Prospects CIAM": ("5_CIAM", "Score_Qualite_Donnees", "Prospect_CIAM"),
    "Manquants IEHE": ("6_IEHE", "Presence_Globale", "(tous)"),
}


def quality_anomalies(facts: DataFrame) -> DataFrame:
    """Followed anomalies of a run with a severity by count."""
    place = F.concat_ws("|", "section", "block", "indicator")
    labels = F.create_map(*[F.lit(x) for label, path in ANOMALIES.items() for x in ("|".join(path), label)])
    rows = facts.withColumn("label", F.try_element_at(labels, place)).where("label is not null and measure in ('Nombre', 'Pct', 'Manquants')")
    wide = rows.groupBy("label").agg(
        F.max(F.when(F.col("measure").isin("Nombre", "Manquants"), F.col("value"))).alias("nombre"), F.max(F.when(F.col("measure") == "Pct", F.col("value"))).alias("pct")
    )
    n = F.col("nombre")
    return wide.where("nombre is not null").select("label", "nombre", "pct", F.when(n == 0, "ok").when(n <= FEW, "warn").otherwise("err").alias("level"))
