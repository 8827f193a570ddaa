"""The KPI document, its history and its supervision."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import functions as F

from concordat.functions import iso_date, pct2
from concordat.operators import windows as wn
from concordat.plans import report as rp
from concordat.plans import supervision as sv
from concordat.sources.state import flatten_payload as flatten
from concordat.session import materialize
from concordat.workload import canon, q_claims, q_matching, q_quality
from concordat.workload import oracle as q
from concordat.workload.oracle import oracle
from concordat.workload.registry import ORACLES, Frames, query

# ---- history ----------------------------------------------------------------------

_VALUES = {
    "volume_flux": ("n", None), "personnes_uniques": ("persons", None), "cible_ciam": ("target", None),
    "taux_matching_ciam": ("n - lost", "n"), "non_rapproches": ("lost", None), "score_qualite": ("n - bad", "n"),
    "taux_presence_iehe": ("n - missing", "n"), "manquants_iehe": ("missing", None), "taux_eligibilite_tp": ("eligible", "n"),
    "eligibles_tp": ("eligible", None), "taux_ged": ("found", "n"), "ged_trouves": ("found", None), "ged_ko": ("n - found", None),
}


@canon._plan
def history(f):
    """One nested document per run, built from the run's counts."""
    cols = {sv.KPI_PATHS[k]: (F.expr(n) if d is None else pct2(F.expr(n), F.expr(d))) for k, (n, d) in _VALUES.items()}
    return f.run_counts.select(
        "flux_id", F.concat("last_day", F.lit(" 06:00:00")).cast("timestamp_ntz").alias("date_import"), sv.nested_document(cols).alias("payload")
    )


_SER = "SELECT flux_id, last_day, strptime(flux_id, '%d%m%Y') AS rd, unnest([" + ", ".join(f"'{k}'" for k in _VALUES) + "]) AS kpi, unnest([" + ", ".join(
    f"cast({n} AS double)" if d is None else q.pct(f"({n})", d) for n, d in _VALUES.values()) + "]) AS value FROM run_counts"
_THR = "SELECT * FROM (VALUES " + ", ".join(f"('{k}', cast({g} AS double), cast({o} AS double), {str(h).lower()})" for k, g, o, h in sv.THRESHOLDS) + ") v(kpi, green, orange, higher_is_better)"
_BADGE = ("CASE WHEN value IS NULL THEN 'na' WHEN higher_is_better IS NULL THEN 'neutral' WHEN value >= green THEN 'green' "
          "WHEN value >= orange THEN 'orange' ELSE 'red' END")


@query("kpi_series", oracle("SELECT flux_id, kpi, value FROM ser", ser=_SER))
def kpi_series(f):
    return sv.kpi_series(history(f)).drop("date_import")


@query("previous_run_delta", oracle(
    f"""SELECT flux_id, kpi, value, previous, round(value - previous, 2) AS delta, {_BADGE} AS badge FROM (
      SELECT *, lag(value) OVER (PARTITION BY kpi ORDER BY rd) AS previous FROM ser) s LEFT JOIN thr USING (kpi)""", ser=_SER, thr=_THR))
def previous_run_delta(f):
    return sv.previous_run_delta(sv.kpi_series(history(f)), sv.threshold_table(f.spark))


@query("kpi_period_average", oracle(
    "SELECT flux_id, kpi, value, CASE WHEN n > 0 THEN cast((2 * s + n) // (2 * n) AS double) / 100.0 END AS average FROM (SELECT flux_id, kpi, value, "
    "cast(sum(cast(round(value * 100) AS bigint)) OVER w AS bigint) AS s, count(value) OVER w AS n FROM ser "
    "WINDOW w AS (PARTITION BY kpi ORDER BY rd ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)) t", ser=_SER))
def kpi_period_average(f):
    return sv.kpi_period_average(sv.kpi_series(history(f)), 30)


@query("last_n_runs", oracle(
    "SELECT flux_id, n FROM run_counts WHERE strptime(flux_id, '%d%m%Y') <= DATE '2000-10-15' ORDER BY strptime(flux_id, '%d%m%Y') DESC LIMIT 30"))
def last_n_runs(f):
    return wn.last_n_runs(f.run_counts.select("flux_id", "n"), 30, "2000-10-15")


@query("kpi_alerts", oracle(
    f"""SELECT flux_id, level, title, value FROM (SELECT flux_id, value,
      CASE WHEN kpi IN {sv.ALERTED} AND b = 'red' THEN 'err' WHEN kpi IN {sv.ALERTED} AND b = 'orange' THEN 'warn' WHEN kpi = 'non_rapproches' AND value > 0 THEN CASE WHEN value <= 20 THEN 'warn' ELSE 'err' END
        WHEN kpi = 'taux_ged' AND value <= 5 THEN 'warn' END AS level,
      CASE WHEN kpi IN {sv.ALERTED} AND b = 'red' THEN kpi || ' critique' WHEN kpi IN {sv.ALERTED} AND b = 'orange' THEN kpi || ' à surveiller' WHEN kpi = 'non_rapproches' AND value > 0 THEN 'Non-rapprochés'
        WHEN kpi = 'taux_ged' AND value <= 5 THEN 'Taux GED très bas' END AS title FROM (SELECT ser.*, {_BADGE} AS b FROM ser LEFT JOIN thr USING (kpi)) x) y WHERE level IS NOT NULL
    UNION ALL SELECT flux_id, 'warn', 'Données obsolètes', cast(h AS double) FROM (SELECT flux_id, date_diff('hour', strptime(last_day || ' 06:00:00', '%Y-%m-%d %H:%M:%S'), TIMESTAMP '2001-09-01 06:00:00') AS h
      FROM run_counts ORDER BY strptime(flux_id, '%d%m%Y') DESC LIMIT 1) z WHERE h > 48""", ser=_SER, thr=_THR))
def kpi_alerts(f):
    return sv.kpi_alerts(sv.kpi_series(history(f)), sv.threshold_table(f.spark), "2001-09-01 06:00:00")


_OVR = """SELECT kpi, floor(min(value)) AS green, cast(NULL AS double) AS orange FROM ser WHERE kpi IN ('taux_matching_ciam', 'score_qualite', 'volume_flux') GROUP BY 1"""


@query("kpi_threshold_override", oracle(
    "SELECT kpi, coalesce(o.green, t.green) AS green, coalesce(o.orange, t.orange) AS orange, cast(higher_is_better AS integer) AS better FROM thr t LEFT JOIN ovr o USING (kpi)",
    ser=_SER, thr=_THR, ovr=_OVR))
def kpi_threshold_override(f):
    series = sv.kpi_series(history(f)).where(F.col("kpi").isin("taux_matching_ciam", "score_qualite", "volume_flux"))
    overrides = series.groupBy("kpi").agg(F.floor(F.min("value")).cast("double").alias("green"), F.lit(None).cast("double").alias("orange"))
    out = sv.kpi_threshold_override(sv.threshold_table(f.spark), overrides)
    return out.select("kpi", "green", "orange", F.col("higher_is_better").cast("int").alias("better"))


_PATHS = {k: " › ".join(p) for k, p in sv.KPI_PATHS.items()}
_LEAF = "SELECT flux_id, unnest([" + ", ".join(f"'{_PATHS[k]}'" for k in _VALUES) + "]) AS path, unnest([" + ", ".join(
    f"cast({n} AS varchar)" if d is None else f"cast({q.pct(f'({n})', d)} AS varchar)" for n, d in _VALUES.values()) + "]) AS value FROM run_counts"


@query("flatten_payload", oracle(_LEAF))
def flatten_payload(f):
    return flatten(history(f), "payload", ["flux_id"])


@query("compare_runs", oracle(
    """SELECT path, a, b, round(try_cast(b AS double) - try_cast(a AS double), 4) AS delta, cast(a IS DISTINCT FROM b AS integer) AS changed FROM (
      SELECT path, max(CASE WHEN flux_id = '01061998' THEN value END) AS a, max(CASE WHEN flux_id = '01072000' THEN value END) AS b
      FROM leaf WHERE flux_id IN ('01061998', '01072000') GROUP BY 1) t""", leaf=_LEAF))
def compare_runs(f):
    return sv.compare_runs(history(f), "01061998", "01072000")


# ---- report -----------------------------------------------------------------------

def _block_sql(b):
    names = "[" + ", ".join(f"'{m}'" for m in b.measures) + "]"
    vals = "[" + ", ".join(f"cast({c} AS double)" for c in b.measures.values()) + "]"
    return (f"SELECT * FROM (SELECT '{b.section}' AS section, '{b.name}' AS block, {b.indicator} AS indicator, unnest({names}) AS measure, unnest({vals}) AS value "
            f"FROM ({ORACLES[b.result]}) b WHERE {b.where}) c WHERE value IS NOT NULL")


_REPORT = " UNION ALL ".join(_block_sql(b) for b in rp.BLOCKS)


class _Results(Mapping):
    """The queries' results by name, each made when it is asked for from frames of its own over the written ones."""

    def __init__(self, f, written):
        self.f, self.written, self.made = f, written, vars(q_quality) | vars(q_matching) | vars(q_claims)

    def __getitem__(self, name):
        own = Frames(self.f.spark, self.f.sf_dir)
        own.plans |= self.written
        return self.made[name](own)

    def __iter__(self):
        return iter(dict.fromkeys(b.result for b in rp.BLOCKS))

    def __len__(self):
        return len(set(self))


# Frames that several blocks read, each after the ones it is made from.
_SHARED = (canon.member, canon.accounts, canon.account_ref, canon.registry, canon.match, canon.matched, canon.person_card)


def results(f, shared=_SHARED):
    """The blocks' results; ``shared`` frames are written once and read by all of them."""
    written = {}
    for fn in shared:
        frame = fn(f)
        if fn in (canon.member, canon.member_base):
            # Most blocks count per person: a person's contracts lie together, so partial sums leave one row of them to shuffle.
            frame = frame.hint("rebalance", "person_id")
        written[f"canon.{fn.__name__}"] = materialize(frame)
        if fn is canon.member:
            # The same contracts without their effect date.
            written["canon.member_base"] = written["canon.member"].withColumn("effect_date", iso_date(F.lit(None).cast("string")))
        f.plans |= written
    return _Results(f, written)


def report(f):
    """The report on one snapshot."""
    return rp.kpi_report(results(f))


@query("kpi_report", _REPORT)
def kpi_report(f):
    return report(f)


_HL = "SELECT 'Highlights' AS section, 'Synthese' AS block, l AS indicator, 'Valeur' AS measure, value FROM rep JOIN (VALUES " + ", ".join(
    "('" + k + "', '" + "', '".join(p) + "')" for k, p in rp.HIGHLIGHTS.items()) + ") v(l, s, b, i, m) ON s = section AND b = block AND i = indicator AND m = measure"


@query("kpi_thematic", oracle(" UNION ALL ".join(
    f"SELECT '{t}' AS theme, * FROM {'rep' if s is None else 'every_row'} WHERE {'true' if s is None else 'section IN (' + ', '.join(chr(39) + x + chr(39) for x in s) + ')'}"
    for t, s in rp.THEMES.items()), rep=_REPORT, every_row=f"SELECT * FROM rep UNION ALL {_HL}"))
def kpi_thematic(f):
    return rp.kpi_thematic(report(f))


@query("kpi_detail", f"SELECT label AS indicator, cast(total AS double) AS \"Total\", cast(rapproches AS double) AS \"Rapproches\", cast(non_rapproches AS double) AS \"Non_Rapproches\", taux AS \"Taux\" "
       f"FROM ({ORACLES['match_by_segment']}) s WHERE view = 'SOCIETE'")
def kpi_detail(f):
    # Through the published document: the facts of the block to nested JSON and back.  No other block can reach the table.
    path = ("5_CIAM", "Matching_Par_Societe")
    docs = rp.to_document(rp.kpi_report(results(f, ()), rp.blocks_at(path)))
    leaves = flatten(docs, "payload", [], sep="|")
    parts = F.split("path", r"\|")
    facts = leaves.select(
        parts[0].alias("section"), parts[1].alias("block"), parts[2].alias("indicator"), parts[3].alias("measure"), F.col("value").try_cast("double").alias("value")
    )
    return sv.kpi_detail(facts, *path, ("Total", "Rapproches", "Non_Rapproches", "Taux"))


_AN = ", ".join("('" + k + "', '" + "', '".join(p) + "')" for k, p in sv.ANOMALIES.items())


@query("quality_anomalies", oracle(
    f"""SELECT label, nombre, pct, CASE WHEN nombre = 0 THEN 'ok' WHEN nombre <= 20 THEN 'warn' ELSE 'err' END AS level FROM (
      SELECT l AS label, max(CASE WHEN measure IN ('Nombre', 'Manquants') THEN value END) AS nombre, max(CASE WHEN measure = 'Pct' THEN value END) AS pct
      FROM rep JOIN (VALUES {_AN}) v(l, s, b, i) ON s = section AND b = block AND i = indicator WHERE measure IN ('Nombre', 'Pct', 'Manquants') GROUP BY 1) t
    WHERE nombre IS NOT NULL""", rep=_REPORT))
def quality_anomalies(f):
    # Only the blocks that hold a followed anomaly are made.
    made = results(f, (canon.member_base, canon.accounts, canon.account_ref))
    return sv.quality_anomalies(rp.kpi_report(made, rp.blocks_at(*sv.ANOMALIES.values())))
