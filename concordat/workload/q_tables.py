"""Portfolio tables, benefit pivots, post-processing and tickets."""

from __future__ import annotations

from pyspark.sql import functions as F

from concordat.operators import benefits as bn
from concordat.operators import claims as cl
from concordat.operators import lookups as lk
from concordat.operators import portfolio as pf
from concordat.operators import postprocess as pp
from concordat.operators import tickets as tk
from concordat.operators import windows as wn
from concordat.sources import columns as sc
from concordat.workload import canon, q_claims
from concordat.workload import oracle as q
from concordat.workload.oracle import big, cnt, oracle
from concordat.workload.registry import query

# ---- portfolio ------------------------------------------------------------------

_ORDER = "[" + ", ".join(f"'{r}'" for r in (*pf.REASON_ORDER, pf.EMPTY_REASON)) + "]"
_TERM = f"""SELECT company, reason, list_position({_ORDER}, reason) AS ordre, {big('sum(n)')} AS nombre FROM (
 SELECT company, CASE WHEN coalesce(trim(reason), '') = '' THEN '(vide)' ELSE trim(reason) END AS reason, n FROM block_term) t
 WHERE list_contains({_ORDER}, reason) GROUP BY 1, 2, 3"""
_TERM_ALL = f"SELECT * FROM term UNION ALL SELECT '(Toutes)', reason, ordre, {big('sum(nombre)')} FROM term GROUP BY 2, 3"


@query("terminations_by_reason", oracle(
    "SELECT company, reason, cast(ordre AS bigint) AS ordre, nombre, cast(nombre AS double) / cast(sum(nombre) OVER (PARTITION BY company) AS double) AS part FROM term_all",
    term=_TERM, term_all=_TERM_ALL))
def terminations_by_reason(f):
    return pf.terminations_by_reason(f.block_term)


def _table_sql(block: str, label: str, where: str) -> str:
    return oracle(
        f"""SELECT t.company, t.{label}, t.current, t.base, cast(t.base AS double) / nullif(cast(g.base AS double), 0) AS part,
          cast(t.base - t.current AS double) / nullif(cast(t.base AS double), 0) AS attrition FROM pt t JOIN pt g ON g.company = t.company AND g.{label} = 'Total général'""",
        pt=f"""SELECT CASE WHEN grouping(company) = 1 THEN '(Toutes)' ELSE company END AS company,
          CASE WHEN grouping({label}) = 1 THEN 'Total général' ELSE {label} END AS {label}, {big('sum(current)')} AS current, {big('sum(base)')} AS base
          FROM (SELECT CASE WHEN length(company) < 3 THEN lpad(company, 3, '0') ELSE company END AS company, {label}, current, base FROM {block}) b {where}
          GROUP BY GROUPING SETS ((company, {label}), (company), ({label}), ())""")


@query("portfolio_by_company_type", _table_sql("block_type", "member_type", "WHERE regexp_matches(company, '^0[1-9]\\d$')"))
def portfolio_by_company_type(f):
    return pf.portfolio_by_company_type(f.block_type)


@query("portfolio_by_age", _table_sql("block_age", "age_band", ""))
def portfolio_by_age(f):
    return pf.portfolio_by_age(f.block_age)


def _group_values() -> str:
    rows = []
    for key, number, label in pf.OFFER_GROUPS:
        members = [m.strip() for m in label.split("+")] if label else [key]
        shown = f"'{label}'" if len(members) > 1 else "NULL"
        n = "NULL" if number is None else str(number)
        rows.append(f"('{key}', {n}, {shown}, '{key}', -1)")
        rows += [f"('{key}', {n}, {shown}, '{m}', {i})" for i, m in enumerate(members) if m != key]
    return ", ".join(rows)


@query("offer_groups", oracle(
    """SELECT o.offer, o.nb, cast(o.nb AS double) / cast((SELECT sum(nb) FROM offs) AS double) AS part,
      CASE WHEN g.ordre IS NOT NULL OR g.label IS NOT NULL THEN g.total END AS total, g.label AS regroupement, cast(g.ordre AS bigint) AS ordre
    FROM offs o LEFT JOIN (SELECT group_key, ordre, label, arg_min(offer, pos) AS offer, cast(sum(nb) AS bigint) AS total FROM offs JOIN grp USING (offer) GROUP BY 1, 2, 3) g USING (offer)""",
    offs=f"SELECT offer, {big('sum(base)')} AS nb FROM block_type WHERE upper(member_type) = 'ASSURE' GROUP BY 1",
    grp=f"SELECT * FROM (VALUES {_group_values()}) v(group_key, ordre, label, offer, pos)"))
def offer_groups(f):
    return pf.offer_groups(f.block_type)


@query("portfolio_summary", oracle(
    """SELECT 'PORTEFEUILLE' AS section, unnest(['non_radies', 'a_date', 'taux_radiation']) AS label,
      unnest([cast(b AS double), cast(c AS double), cast(b - c AS double) / b]) AS value FROM (SELECT sum(base) AS b, sum(current) AS c FROM bt) t
    UNION ALL SELECT 'RESILIATIONS', 'total', cast(sum(nombre) AS double) FROM term
    UNION ALL SELECT 'MOTIF_DOMINANT', reason, cast(n AS double) FROM (SELECT reason, sum(nombre) AS n FROM term WHERE reason <> '(vide)' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1) t
    UNION ALL SELECT 'TOP_OFFRES', offer, cast(b AS double) FROM (SELECT offer, sum(base) AS b FROM bt WHERE upper(member_type) = 'ASSURE' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3) t
    UNION ALL SELECT 'TRANCHE_FIDELE', age_band, r FROM (SELECT age_band, cast(sum(base) - sum(current) AS double) / sum(base) AS r FROM block_age GROUP BY 1 ORDER BY 2, 1 LIMIT 1) t
    UNION ALL SELECT 'TYPE', member_type, cast(sum(base) AS double) FROM bt GROUP BY 2
    UNION ALL SELECT 'SOCIETE', lpad(company, 3, '0'), cast(sum(base) AS double) FROM bt GROUP BY 2""",
    term=_TERM, bt="SELECT * FROM block_type WHERE regexp_matches(lpad(company, 3, '0'), '^0[1-9]\\d$')"))
def portfolio_summary(f):
    return pf.portfolio_summary(f.block_type, f.block_term, f.block_age)


_GAPS = {
    "dep_mail": "email <> '' AND contact_email <> '' AND email <> contact_email",
    "dep_tel_port": "contact_email = '' AND insured",
    "dep_tel_telp": "contact_email = '' AND spouse",
    "dep_naissance": "birth_date = '1900-01-01'",
    "dep_deces": "cancel_date <> ''",
    "dep_adresses": "company = '073'",
}


@query("phase_gaps", oracle(
    "SELECT indicator, nb, cast(nb AS double) / cast((SELECT count(*) FROM insured) AS double) AS part FROM (SELECT * FROM gaps UNION ALL "
    f"SELECT 'total_telephone', {big('sum(nb)')} FROM gaps WHERE indicator LIKE 'dep_tel%') t",
    gaps=" UNION ALL ".join(f"SELECT '{n}' AS indicator, {cnt(c)} AS nb FROM member_base" for n, c in _GAPS.items())))
def phase_gaps(f):
    from concordat.operators.normalize import is_insured, is_spouse

    m = canon.member_base(f).withColumn("insured", is_insured(F.col("member_type"))).withColumn("spouse", is_spouse(F.col("member_type")))
    counted = m.agg(*[F.count_if(F.expr(c)).alias(n) for n, c in _GAPS.items()], F.count_if("insured").alias("base"))
    cells = F.array(*[F.struct(F.lit(n).alias("indicator"), F.col(n).alias("nb")) for n in _GAPS])
    return pf.phase_gaps(counted.select(F.inline(cells)), counted.select("base"))


_MB = """SELECT last_name, first_name, insee, birth_date, CASE WHEN length(company) < 3 THEN lpad(company, 3, '0') ELSE company END AS company,
 upper(trim(kind)) AS kind, n FROM block_multi"""
_MS = f"count(*) AS nb_assures, {big('sum(n)')} AS nb_contrats FROM mb"


@query("multi_contract_report", oracle(
    f"""SELECT 'TOTAL' AS section, '' AS k1, '' AS k2, {_MS} UNION ALL SELECT 'TYPE', kind, '', {_MS} GROUP BY 2 UNION ALL SELECT 'SOCIETE', company, '', {_MS} GROUP BY 2
    UNION ALL SELECT 'CROISE', company, kind, {_MS} GROUP BY 2, 3 UNION ALL SELECT 'DISTRIBUTION', cast(n AS varchar), '', {_MS} GROUP BY 2
    UNION ALL SELECT 'TOP', concat_ws('|', last_name, first_name, insee, birth_date), concat_ws('|', company, kind), 1, n FROM (
      SELECT * FROM mb ORDER BY n DESC, last_name, first_name, insee, birth_date, company, kind LIMIT 10) t
    UNION ALL SELECT 'MULTI_TYPES', '', '', count(*), {big('sum(n)')} FROM (SELECT sum(n) AS n FROM mb GROUP BY last_name, first_name, insee, birth_date
      HAVING count(DISTINCT kind) > 1) t""", mb=_MB))
def multi_contract_report(f):
    return pf.multi_contract_report(f.block_multi)


@query("share_of_total", oracle(
    """SELECT company, offer, n, cast(n AS double) / cast(sum(n) OVER (PARTITION BY company) AS double) AS share_group,
      cast(n AS double) / cast(sum(n) OVER () AS double) AS share_total FROM (SELECT company, offer, count(*) AS n FROM member_base GROUP BY 1, 2) t"""))
def share_of_total(f):
    counts = canon.member_base(f).groupBy("company", "offer").agg(F.count("*").alias("n"))
    return wn.share_of_total(counts, "company", "n")


@query("required_columns", oracle(
    """SELECT * FROM (VALUES ('MANQUANTE', 'nb pp a date'), ('INATTENDUE', 'current'), ('INATTENDUE', 'base'), ('MANQUANTE', 'nb pp non radie'),
      ('INATTENDUE', 'company'), ('MANQUANTE', 'codsoc'), ('INATTENDUE', 'member_type'), ('MANQUANTE', 'type assure'), ('MANQUANTE', 'offre'), ('INATTENDUE', 'offer')) v(issue, item)
    UNION ALL SELECT DISTINCT 'CODE_INCONNU', offer FROM block_type WHERE offer NOT IN (SELECT code FROM offer_mapping)"""))
def required_columns(f):
    block = f.block_type
    issues = sc.required_columns(block, ("offre", "codsoc", "type assure", "nb pp a date", "nb pp non radie"))
    return issues.unionByName(sc.unknown_codes(block, "offer", canon.offer_mapping(f)))


# ---- benefits --------------------------------------------------------------------

STATES = ("PA", "AC", "RJ")
ORIGINS = (*cl.AUTO_ORIGINS, *cl.MANUAL_ORIGINS)


@canon._plan
def benefits(f):
    rows = lk.offer_enrich(f.benefit_rows, canon.offer_mapping(f))
    return rows


_BEN = "SELECT b.*, coalesce(d.nature, b.offer) AS nature, coalesce(d.societe, '?') AS societe FROM benefit_rows b LEFT JOIN offer_mapping d ON d.code = b.offer"


def _pivot_sql(sheet, keys, on, values, where="true", total=True):
    cases = {v: f"sum(CASE WHEN {on} = '{v}' THEN nb ELSE 0 END)" for v in values}
    inside = ", ".join(f"'{v}'" for v in values)
    labels = "[" + ", ".join(f"'{v}'" for v in values) + (", 'Total'" if total else "") + "]"
    vals = "[" + ", ".join(big(c) for c in cases.values()) + (f", {big(f'sum(CASE WHEN {on} IN ({inside}) THEN nb ELSE 0 END)')}" if total else "") + "]"
    key = f"concat_ws('|', {', '.join(keys)})"
    return f"SELECT '{sheet}' AS sheet, {key} AS row_key, unnest({labels}) AS col_key, unnest({vals}) AS value FROM ben WHERE {where} GROUP BY {', '.join(keys)}"


_PROT = "('PREV_INDIV', 'PREV_MEAE', 'PREV_CULTURE', 'PREV_MEN')"
_NS = "nature || '-' || state"


@query("benefits_pivots", oracle(" UNION ALL ".join((
    _pivot_sql("TCD1", ["offer", "nature"], "state", STATES),
    _pivot_sql("Prestations par offre", ["date_arrivee"], "nature", bn.CARE_NATURES, f"nature NOT IN {_PROT}"),
    _pivot_sql("Prévoyance", ["date_arrivee"], "nature", bn.PROTECTION_NATURES, f"nature IN {_PROT}"),
    _pivot_sql("Ste 010", ["date_arrivee"], _NS, [f"{n}-{s}" for n in ("MEN", "MEAE") for s in STATES], "societe = '010'"),
    _pivot_sql("Ste 044", ["date_arrivee"], _NS, [f"{n}-{s}" for n in ("PREV_INDIV", "MSP") for s in STATES], "societe = '044'"),
    _pivot_sql("Ste 052", ["date_arrivee"], "state", STATES, "nature = 'MSOL'", False),
    _pivot_sql("TCD2", ["origin", "offer"], "state", STATES),
    _pivot_sql("MEN_ORIGINE", ["date_arrivee"], "origin", ORIGINS, "nature = 'MEN'", False))), ben=_BEN))
def benefits_pivots(f):
    keys = {"TCD1": ["offer", "nature"], "TCD2": ["origin", "offer"]}
    out = None
    for sheet, pivot in bn.benefits_pivots(benefits(f), STATES, ORIGINS).items():
        part = bn.as_cells(sheet, pivot, keys.get(sheet, ["date_arrivee"]))
        out = part if out is None else out.unionByName(part)
    return out


@query("benefits_daily_summary", oracle(
    f"""SELECT 'NATURE' AS view, nature AS label, {big('sum(nb)')} AS nb FROM today_rows WHERE nature IN {bn.CARE_NATURES} GROUP BY 2
    UNION ALL SELECT 'TOTAL', '', {big('sum(nb)')} FROM today_rows WHERE nature IN {bn.CARE_NATURES}
    UNION ALL SELECT 'SOCIETE', societe, {big('sum(nb)')} FROM today_rows GROUP BY 2
    UNION ALL SELECT 'SANS_OFFRE', '', {big('sum(nb)')} FROM ben WHERE offer = '__SANS_OFFRE__'""",
    ben=_BEN, today_rows=f"SELECT * FROM ben WHERE date_arrivee = (SELECT max(date_arrivee) FROM ben WHERE nature NOT IN {_PROT})"))
def benefits_daily_summary(f):
    return bn.benefits_daily_summary(benefits(f))


# ---- post-processing ----------------------------------------------------------------


@query("subtotal_row_all", oracle(
    "SELECT * FROM base_rows UNION ALL SELECT 'TOTAL_GENERAL', '', " + ", ".join(f"{big(f'sum({c})')}" for c in ("nb_recu", "nb_payes", "nb_attente")) + " FROM base_rows",
    foc=q_claims._FOC, base_rows="SELECT origin, substr(origin, 1, 2) AS family, nb_recu, nb_payes, nb_attente FROM foc"))
def subtotal_row_all(f):
    rows = cl.full_outer_counts(f.claim_heads, f.claim_ops)
    return pp.subtotal_row_all(rows.select("origin", F.substring("origin", 1, 2).alias("family"), "nb_recu", "nb_payes", "nb_attente"))


_SB = "SELECT box, count(DISTINCT dossier_id) AS \"Total\" FROM claim_ops WHERE state = 'RJ' GROUP BY 1"


@query("subtotal_rows_by_prefix", oracle(
    "SELECT * FROM sb UNION ALL SELECT 'TOTAL_' || p || '*', cast(coalesce(sum(CASE WHEN starts_with(box, p) THEN \"Total\" END), 0) AS bigint) "
    "FROM sb, (SELECT unnest(['DSI', 'GES', 'VDC']) AS p) x GROUP BY p", sb=_SB))
def subtotal_rows_by_prefix(f):
    rows = f.claim_ops.where("state = 'RJ'").select("box", "dossier_id").distinct().groupBy("box").agg(F.count("*").alias("Total"))
    return pp.subtotal_rows_by_prefix(rows)


_COLS = ("box", "reject_code", "libelle", *cl.AUTO_ORIGINS, "TOTAL_AUTO", *cl.MANUAL_ORIGINS, "TOTAL_MANUEL", "Total")


@query("post_processors", oracle(
    "SELECT " + ", ".join(f'"{c}"' for c in _COLS) + " FROM stock UNION ALL SELECT 'TOTAL_' || p || '*', " + ", ".join(["NULL"] * (len(_COLS) - 2))
    + ", cast(coalesce(sum(CASE WHEN starts_with(box, p) THEN \"Total\" END), 0) AS bigint) FROM stock, (SELECT unnest(['DSI', 'GES', 'VDC']) AS p) x GROUP BY p",
    labels_dim=q_claims._LABELS, stock=q_claims._STOCK))
def post_processors(f):
    rows = cl.stock_by_box(f.claim_ops.where(F.col("state") == cl.REJECTED), q_claims._labels(f))
    return pp.apply_post_processor(rows, "sum_boite_prefixes_stock")


@query("parameterised_query",
       "SELECT o_orderpriority, count(*) AS n, round(cast(sum(cast(o_totalprice AS decimal(14, 2))) AS double), 2) AS total FROM orders "
       "WHERE o_orderdate >= DATE '1996-01-01' AND o_orderstatus <> 'P' GROUP BY 1")
def parameterised_query(f):
    text = """SELECT o_orderpriority, count(*) AS n, round(cast(sum(cast(o_totalprice AS decimal(14, 2))) AS double), 2) AS total
      FROM {orders} WHERE o_orderdate >= :first AND o_orderstatus <> :skip GROUP BY 1"""
    import datetime as dt

    defaults = {"first": dt.date(1990, 1, 1), "skip": "P"}
    return pp.parameterised_query(f.spark, text, defaults, {"first": dt.date(1996, 1, 1)}, orders=f.orders)


def _warehouse(f):
    """The warehouse measures of the ratio, per day."""
    heads = f.claim_heads.select(F.lit("DWH-Intégré").alias("requete"), F.col("received").alias("day"), "origin")
    label = F.when(F.col("state").isin(*cl.WAITING), "DWH-Attente").when(F.col("state") == cl.REJECTED, "DWH_Rejets")
    ops = f.claim_ops.select(label.alias("requete"), F.col("op_date").alias("day"), "origin").where("requete is not null")
    return heads.unionByName(ops).groupBy("requete", "day").agg(F.count_if(F.col("origin") == "SELFC").alias("SELFC"))


def _ratio(got, waits, bad):
    return f"coalesce(cast(coalesce({bad}, 0) AS double) / nullif(cast(coalesce({got}, 0) - coalesce({waits}, 0) AS double), 0), 0.0)"


def _at(label, col):
    return f"sum(CASE WHEN requete = '{label}' THEN {col} END)"


@query("daily_block_ratios", oracle(
    "SELECT cast(day AS varchar) AS day, " + ", ".join(f"coalesce({c}, 0.0) AS {c}" for c in (*pp.RATIO_ORIGINS, "TOTAL", "SELFC")) + " FROM (SELECT day, "
    + ", ".join(f"{_ratio(_at('MDG_Intégrés', c), _at('MDG_Attente', c), _at('MDG_Rejets', c))} AS {n}" for n, c in
                [*((o, o) for o in pp.RATIO_ORIGINS), ("TOTAL", "(TOTAL_AUTO + TOTAL_MANUEL)")])
    + f" FROM (SELECT requete, day, {q_claims._MATRIX} FROM meas GROUP BY 1, 2) m GROUP BY 1) a FULL JOIN (SELECT day, "
    + _ratio(_at("DWH-Intégré", "n"), _at("DWH-Attente", "n"), _at("DWH_Rejets", "n")) + " AS SELFC FROM wh GROUP BY 1) b USING (day)",
    both_ops=q_claims._BOTH, meas=q_claims._MEAS,
    wh=f"""SELECT requete, day, {cnt("origin = 'SELFC'")} AS n FROM (SELECT 'DWH-Intégré' AS requete, received AS day, origin FROM claim_heads
      UNION ALL SELECT CASE WHEN state = 'RJ' THEN 'DWH_Rejets' ELSE 'DWH-Attente' END, op_date, origin FROM claim_ops WHERE state IN ('RJ', 'AC', 'VA')) u GROUP BY 1, 2"""))
def daily_block_ratios(f):
    matrix = cl.claims_daily_matrix(f.claim_heads, f.claim_ops)
    return pp.daily_block_ratios(matrix, _warehouse(f)).withColumn("day", F.col("day").cast("string"))


# ---- tickets -------------------------------------------------------------------------

_T = """SELECT *, CASE WHEN d >= 0 THEN cast(d AS double) END AS days, try_cast(priority AS integer) AS prio,
 CASE try_cast(priority AS integer) WHEN 1 THEN 0.5 WHEN 2 THEN 1.0 WHEN 3 THEN 3.0 WHEN 4 THEN 5.0 WHEN 5 THEN 10.0 END AS target
 FROM (SELECT *, date_diff('day', cast(opened AS date), cast(closed AS date)) AS d FROM tickets) x"""


def _p1(n, d):
    return f"coalesce(round(cast({n} AS double) / nullif(cast({d} AS double), 0) * 100, 1), 0.0)"


_SLA = _p1(cnt("days <= target"), cnt("days IS NOT NULL AND target IS NOT NULL"))
_MEAN = "round(sum(days) / nullif(count(days), 0), 1)"
_STK = {
    "total": "count(*)", "clos": "count(closed)", "ouverts": "count(*) - count(closed)", "taux_cloture": _p1("count(closed)", "count(*)"),
    "n_en_retard": cnt("trim(late_time) NOT IN ('', 'None', '00:00:00', '0', 'nan')"), "taux_sla": _SLA, "moyenne_jours": _MEAN,
    "mediane_jours": "round(quantile_cont(days, 0.5), 1)", "p90_jours": "round(quantile_cont(days, 0.9), 1)", "min_jours": "round(min(days), 1)",
    "max_jours": "round(max(days), 1)", "n_mesures": "count(days)",
}
_PRI = {"count": "count(days)", "moyenne_jours": _MEAN, "mediane_jours": "round(quantile_cont(days, 0.5), 1)", "pct_dans_sla": f"CASE WHEN {cnt('target IS NOT NULL')} > 0 THEN {_SLA} END"}


def _cells(scope, cols, tail):
    names = "[" + ", ".join(f"'{n}'" for n in cols) + "]"
    vals = "[" + ", ".join(f"cast({c} AS double)" for c in cols.values()) + "]"
    return f"SELECT {scope} AS scope, unnest({names}) AS indicator, unnest({vals}) AS value FROM tk {tail}"


@query("ticket_stock_kpis", oracle(
    _cells("'STOCK'", _STK, "") + " UNION ALL " + _cells("'P' || cast(prio AS varchar)", _PRI, "WHERE prio IS NOT NULL AND days IS NOT NULL GROUP BY prio"), tk=_T))
def ticket_stock_kpis(f):
    return tk.ticket_stock_kpis(f.tickets)


_DIMS = ("theme", "region", "brand", "solver")


def _break(table, dims):
    parts = [f"SELECT 'state' AS dim, coalesce(state, 'Inconnu') AS label, count(*) AS n FROM {table} GROUP BY 2",
             f"SELECT 'priority', cast(coalesce(try_cast(priority AS integer), 0) AS varchar), count(*) FROM {table} GROUP BY 2"]
    parts += [f"SELECT '{d}', {d}, n FROM (SELECT {d}, count(*) AS n FROM {table} WHERE {d} IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 12) t{d}" for d in dims]
    return " UNION ALL ".join(parts)


@query("ticket_breakdowns", oracle(_break("tickets", _DIMS)))
def ticket_breakdowns(f):
    return tk.ticket_breakdowns(f.tickets, _DIMS)


@query("ticket_monthly_evolution", oracle(
    "SELECT 'ouvertures' AS serie, substr(opened, 1, 7) AS mois, count(*) AS n FROM tickets GROUP BY 2 "
    "UNION ALL SELECT 'clotures', substr(closed, 1, 7), count(*) FROM tickets WHERE closed IS NOT NULL GROUP BY 2"))
def ticket_monthly_evolution(f):
    return tk.ticket_monthly_evolution(f.tickets)


_HD = "CASE WHEN try_cast(duration AS double) > 0 THEN try_cast(duration AS double) END"
_XD = "CASE WHEN try_cast({0} AS double) IS NOT NULL THEN DATE '1899-12-30' + cast(floor(try_cast({0} AS double)) AS integer) ELSE try_cast({0} AS date) END"


@query("ticket_legacy_kpis", oracle(
    "SELECT 'HISTORIQUE' AS scope, unnest(['total', 'n_mesures', 'moyenne_jours', 'mediane_jours', 'p90_jours']) AS label, "
    "unnest([cast(count(*) AS double), cast(count(d) AS double), round(sum(d) / count(d), 1), round(quantile_cont(d, 0.5), 1), round(quantile_cont(d, 0.9), 1)]) AS value "
    f"FROM (SELECT {_HD} AS d FROM ticket_history) h UNION ALL SELECT dim, label, cast(n AS double) FROM ({_break('ticket_history', ('theme', 'subject'))}) b "
    "UNION ALL SELECT serie, mois, n FROM (SELECT serie, mois, cast(count(*) AS double) AS n, row_number() OVER (PARTITION BY serie ORDER BY mois DESC) AS rn FROM ("
    f"SELECT 'ouvertures' AS serie, strftime({_XD.format('opened')}, '%Y-%m') AS mois FROM ticket_history UNION ALL SELECT 'clotures', strftime({_XD.format('closed')}, '%Y-%m') FROM ticket_history) u "
    "WHERE mois IS NOT NULL GROUP BY 1, 2) m WHERE rn <= 24"))
def ticket_legacy_kpis(f):
    return tk.ticket_legacy_kpis(f.ticket_history)


# ---- top lists -------------------------------------------------------------------------


@query("top_n_domains", oracle(
    "SELECT substr(email, strpos(email, '@') + 1) AS domain, count(*) AS n FROM member_base WHERE contains(email, '@') GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"))
def top_n_domains(f):
    from concordat.functions import email_domain

    rows = canon.member_base(f).where(F.col("email").contains("@")).groupBy(email_domain(F.col("email")).alias("domain")).agg(F.count("*").alias("n"))
    return wn.top_n(rows, "domain", "n", 10)


@query("top_n_per_dim", oracle(
    "SELECT company, offer, n FROM (SELECT company, offer, count(*) AS n, row_number() OVER (PARTITION BY company ORDER BY count(*) DESC, offer) AS rn FROM member_base GROUP BY 1, 2) t WHERE rn <= 3"))
def top_n_per_dim(f):
    rows = canon.member_base(f).groupBy("company", "offer").agg(F.count("*").alias("n"))
    return wn.top_n_per_dim(rows, "company", "offer", "n", 3)
