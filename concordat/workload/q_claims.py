"""Claims: filters, versions, matrices, delays and stock."""

from __future__ import annotations

from pyspark.sql import functions as F

from concordat.operators import activity as av
from concordat.operators import claims as cl
from concordat.operators import filters as fl
from concordat.operators import windows as wn
from concordat.workload import canon
from concordat.workload import oracle as q
from concordat.workload.oracle import big, cnt, oracle
from concordat.workload.registry import query

# ---- filters ----------------------------------------------------------------


@query("scope_filter", oracle(
    "SELECT contract_id, 'ASSURE' AS role FROM member_base WHERE insured UNION ALL SELECT contract_id, 'CONJOINT' FROM member_base WHERE spouse"))
def scope_filter(f):
    m = canon.member_base(f)
    parts = [fl.scope_filter(m, role).select("contract_id", F.lit(role).alias("role")) for role in ("ASSURE", "CONJOINT")]
    return parts[0].unionByName(parts[1])


@query("day_window_filter", oracle("SELECT dossier_id, op_no, op_ref, state FROM claim_ops WHERE op_date >= DATE '1998-06-15' AND op_date < DATE '1998-06-16'"))
def day_window_filter(f):
    return fl.day_window_filter(f.claim_ops, "op_date", "1998-06-15").select("dossier_id", "op_no", "op_ref", "state")


@query("week_window_filter", oracle(
    f"SELECT dossier_id, count(*) AS rows, {cnt('''op_date >= DATE '1998-06-09' AND op_date < DATE '1998-06-16' ''')} AS rows_in_week FROM claim_ops "
    "GROUP BY 1 HAVING count(CASE WHEN op_date >= DATE '1998-06-09' AND op_date < DATE '1998-06-16' THEN 1 END) > 0"))
def week_window_filter(f):
    return fl.week_window_filter(f.claim_ops, "dossier_id", "op_date", "1998-06-15")


@query("month_floor_window", oracle(
    """SELECT cast(d AS varchar) AS day, cast(s AS varchar) AS window_start, cast(e AS varchar) AS window_end,
      strftime(s - 1, '%Y%m%d') AS bound_low, strftime(e + 1, '%Y%m%d') AS bound_high FROM (
      SELECT d, greatest(d - 7, cast(date_trunc('month', d) AS date)) AS s, last_day(d) AS e
      FROM (SELECT DISTINCT received AS d FROM claim_heads) a) b"""))
def month_floor_window(f):
    out = fl.month_floor_window(f.claim_heads.select(F.col("received").alias("day")).distinct(), "day")
    return out.select(*[F.col(c).cast("string").alias(c) for c in out.columns])


@query("pattern_list_filter", oracle(
    """SELECT 'origin' AS filtre, origin AS code, count(*) AS n FROM claim_ops WHERE origin LIKE 'TP%' OR origin LIKE 'OXA' GROUP BY 2
    UNION ALL SELECT 'offre', offer, count(*) FROM claim_ops WHERE offer IS NULL OR offer LIKE 'OFF1' GROUP BY 2
    UNION ALL SELECT 'tout', 'x', count(*) FROM claim_ops
    UNION ALL SELECT 'table', box, count(*) FROM claim_ops WHERE box IN (SELECT box FROM (SELECT DISTINCT box FROM claim_ops) b
      JOIN (SELECT DISTINCT trim(pattern) AS pattern FROM box_patterns) p ON box LIKE pattern) GROUP BY 2"""))
def pattern_list_filter(f):
    ops = f.claim_ops
    a = fl.pattern_list_filter(ops, "origin", "TP%, OXA").groupBy(F.lit("origin").alias("filtre"), F.col("origin").alias("code"))
    b = fl.pattern_list_filter(ops, "offer", "NULL,OFF1").groupBy(F.lit("offre").alias("filtre"), F.col("offer").alias("code"))
    c = fl.pattern_list_filter(ops, "origin", "toutes").groupBy(F.lit("tout").alias("filtre"), F.lit("x").alias("code"))
    n = F.count("*").alias("n")
    d = fl.pattern_table_filter(ops, "box", f.box_patterns).groupBy(F.lit("table").alias("filtre"), F.col("box").alias("code"))
    return a.agg(n).unionByName(b.agg(n)).unionByName(c.agg(n)).unionByName(d.agg(n))


_LIST = "('" + "', '".join(cl.FOLLOWED_ORIGINS) + "')"


@query("code_list_filter", oracle(
    f"SELECT 'dans' AS side, origin, count(*) AS n FROM claim_ops WHERE origin IN {_LIST} GROUP BY 2 "
    f"UNION ALL SELECT 'hors', origin, count(*) FROM claim_ops WHERE origin NOT IN {_LIST} GROUP BY 2"))
def code_list_filter(f):
    n = F.count("*").alias("n")
    a = fl.code_list_filter(f.claim_ops, "origin", cl.FOLLOWED_ORIGINS).groupBy(F.lit("dans").alias("side"), "origin").agg(n)
    b = fl.code_list_filter(f.claim_ops, "origin", cl.FOLLOWED_ORIGINS, keep=False).groupBy(F.lit("hors").alias("side"), "origin").agg(n)
    return a.unionByName(b)


@query("regex_code_filter", oracle(
    "SELECT c_custkey, lpad(cast(c_nationkey AS varchar), 3, '0') AS code FROM customer WHERE regexp_matches(lpad(cast(c_nationkey AS varchar), 3, '0'), '^0[1-9]\\d$')"))
def regex_code_filter(f):
    return fl.regex_code_filter(f.customer.select("c_custkey", F.col("c_nationkey").cast("string").alias("code")), "code")


_LATEST_OPS = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dossier_id ORDER BY op_no DESC, op_ref DESC) AS rn FROM claim_ops) v WHERE rn = 1"""


@query("active_version_filter", oracle(
    "SELECT dossier_id, op_no, state, cast(op_date AS varchar) AS op_date FROM latest WHERE state = 'VA' OR op_date > DATE '2000-06-30'", latest=_LATEST_OPS))
def active_version_filter(f):
    latest = wn.latest_version(f.claim_ops, ["dossier_id"], [F.col("op_no").desc(), F.col("op_ref").desc()])
    out = fl.active_version_filter(latest, "2000-06-30", "state", "op_date")
    return out.select("dossier_id", "op_no", "state", F.col("op_date").cast("string").alias("op_date"))


@query("date_range_on_epoch", oracle(
    f"SELECT event_id, event_time FROM user_events WHERE {q.ms_day('event_time')} BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'"))
def date_range_on_epoch(f):
    return av.date_range_on_epoch(canon.user_events(f), "event_time", "2024-01-05", "2024-01-12").select("event_id", "event_time")


# ---- windows ----------------------------------------------------------------


@query("latest_version", oracle("SELECT dossier_id, op_no, op_ref, state FROM latest", latest=_LATEST_OPS))
def latest_version(f):
    return wn.latest_version(f.claim_ops, ["dossier_id"], [F.col("op_no").desc(), F.col("op_ref").desc()]).select("dossier_id", "op_no", "op_ref", "state")


@query("distinct_on", oracle(
    "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY email ORDER BY date_evt DESC, stamp DESC, id) AS rn FROM activity) a WHERE rn = 1"))
def distinct_on(f):
    rows = av.activity_choice(f.user_entity, canon.user_events(f), "2000-03-01", "2024-12-31")
    return av.distinct_on(rows, ["email"], [F.col("date_evt").desc(), F.col("stamp").desc(), F.col("id")])


_AGES = """SELECT dossier_id, max_by(origin, (op_no, op_ref)) AS origin, max_by(reject_code, (op_no, op_ref)) AS reject_code,
 date_diff('day', min(CASE WHEN op_no = 2 THEN op_date END), max(op_date)) AS age FROM claim_ops WHERE state = 'RJ' GROUP BY 1"""
_OLD = """SELECT * FROM (SELECT a.origin, b.box, a.reject_code, a.age, a.dossier_id,
 row_number() OVER (PARTITION BY a.origin, b.box ORDER BY a.age DESC NULLS LAST, a.dossier_id) AS rn
 FROM ages a JOIN (SELECT DISTINCT dossier_id, box FROM claim_ops) b USING (dossier_id)) o WHERE rn = 1"""
_GROUP = f"CASE WHEN origin IN {_LIST} THEN origin ELSE 'Autre' END"


@query("oldest_per_partition", oracle(
    f"SELECT origin, CASE WHEN origin IN {_LIST} THEN origin ELSE 'Autre — ' || origin END AS libelle, {_GROUP} AS groupe, box, reject_code, "
    "cast(age AS integer) AS age, dossier_id FROM old", ages=_AGES, old=_OLD))
def oldest_per_partition(f):
    return cl.oldest_reject(f.claim_ops)


@query("oldest_reject_per_box", oracle(
    """SELECT groupe, box, cast(age AS integer) AS age_jours_max, reject_code, count(*) OVER (PARTITION BY groupe) AS nb_boites,
      cast(max(age) OVER (PARTITION BY groupe) AS integer) AS age_max_groupe FROM (
      SELECT *, row_number() OVER (PARTITION BY groupe, box ORDER BY age DESC, origin, dossier_id) AS r2 FROM (
      SELECT *, """ + _GROUP + """ AS groupe FROM old WHERE age IS NOT NULL) g) h WHERE r2 = 1""", ages=_AGES, old=_OLD))
def oldest_reject_per_box(f):
    return cl.oldest_reject_per_box(cl.oldest_reject(f.claim_ops))


@query("distinct_per_partition", oracle(
    "SELECT contract_id, coalesce(n, 0) AS nb_kpep FROM member_base LEFT JOIN (SELECT person_id, count(DISTINCT kpep) AS n FROM member_base "
    "WHERE kpep NOT IN ('', 'NULL', 'null') GROUP BY 1) k USING (person_id)"))
def distinct_per_partition(f):
    from concordat.operators.matching import is_real_kpep

    value = F.when(is_real_kpep(F.col("kpep")), F.col("kpep"))
    return wn.distinct_per_partition(canon.member_base(f), "person_id", value, "nb_kpep").select("contract_id", "nb_kpep")


@query("duplicates_keep_all", oracle(
    "SELECT contract_id FROM insured WHERE person_id IN (SELECT person_id FROM insured GROUP BY 1 HAVING count(*) > 1)"))
def duplicates_keep_all(f):
    return wn.duplicates_keep_all(canon.insured(f), "person_id").select("contract_id")


@query("first_per_person", oracle(
    "SELECT person_id, coalesce(arg_min(member_type, seq), 'UNK') AS member_type, coalesce(arg_min(company, seq) FILTER (WHERE company <> 'UNK'), 'UNK') AS company "
    "FROM member_base WHERE coalesce(person_id, '') <> '' GROUP BY 1"))
def first_per_person(f):
    from concordat.operators.quality import first_per_person as op

    return op(canon.member_base(f), ["member_type", "company"])


# ---- day matrices -------------------------------------------------------------

_BOTH = """SELECT dossier_id, op_date, any_value(origin) AS origin,
 max((op_no, op_ref, state)) FILTER (WHERE state IN ('PA', 'RL')) AS p, max((op_no, op_ref, state)) AS l FROM claim_ops GROUP BY 1, 2"""


@query("latest_op_both", oracle(
    "SELECT dossier_id, cast(op_date AS varchar) AS op_date, origin, p[1] AS paid_op, p[3] AS paid_state, l[1] AS last_op, l[3] AS last_state FROM both_ops",
    both_ops=_BOTH))
def latest_op_both(f):
    return cl.latest_op_both(f.claim_ops).withColumn("op_date", F.col("op_date").cast("string"))


_MEAS = """SELECT 'MDG_Intégrés' AS requete, received AS day, origin, count(*) AS n FROM claim_heads GROUP BY 2, 3
 UNION ALL SELECT 'MDG_Payés', op_date, origin, count(*) FROM both_ops WHERE p IS NOT NULL GROUP BY 2, 3
 UNION ALL SELECT 'MDG_Relevés', op_date, origin, count(*) FROM both_ops WHERE p[3] = 'RL' GROUP BY 2, 3
 UNION ALL SELECT 'MDG_Attente', op_date, origin, count(*) FROM both_ops WHERE l[3] IN ('AC', 'VA') GROUP BY 2, 3
 UNION ALL SELECT 'MDG_Rejets', op_date, origin, count(*) FROM claim_ops WHERE state = 'RJ' AND op_no = 2 GROUP BY 2, 3"""


def _sum(values, col="n"):
    return [f"cast(sum(CASE WHEN origin = '{v}' THEN {col} ELSE 0 END) AS bigint) AS {v}" for v in values]


def _tot(values, name, col="n", no=""):
    inside = "('" + "', '".join(values) + "')"
    return f"cast(sum(CASE WHEN origin {no} IN {inside} THEN {col} ELSE 0 END) AS bigint) AS {name}"


_KNOWN = (*cl.AUTO_ORIGINS, *cl.MANUAL_ORIGINS)
_MATRIX = ", ".join([*_sum(cl.AUTO_ORIGINS), _tot(cl.AUTO_ORIGINS, "TOTAL_AUTO"), *_sum(cl.MANUAL_ORIGINS), _tot(cl.MANUAL_ORIGINS, "TOTAL_MANUEL")])


@query("claims_daily_matrix", oracle(
    f"SELECT requete, cast(day AS varchar) AS day, {_MATRIX}, {_tot(_KNOWN, 'AUTRES', no='NOT')} FROM meas GROUP BY 1, 2", both_ops=_BOTH, meas=_MEAS))
def claims_daily_matrix(f):
    return cl.claims_daily_matrix(f.claim_heads, f.claim_ops).withColumn("day", F.col("day").cast("string"))


@query("union_measures", oracle("SELECT requete, origin, cast(sum(n) AS bigint) AS n FROM meas GROUP BY 1, 2", both_ops=_BOTH, meas=_MEAS))
def union_measures(f):
    return cl.union_measures(f.claim_heads, f.claim_ops)


@query("ordered_by_label", oracle(
    "SELECT requete, cast(sum(n) AS bigint) AS n, cast(CASE requete WHEN 'MDG_Intégrés' THEN 1 WHEN 'MDG_Payés' THEN 2 WHEN 'MDG_Relevés' THEN 3 "
    "WHEN 'MDG_Attente' THEN 4 WHEN 'MDG_Rejets' THEN 5 END AS bigint) AS position FROM meas GROUP BY 1", both_ops=_BOTH, meas=_MEAS))
def ordered_by_label(f):
    totals = cl.union_measures(f.claim_heads, f.claim_ops).groupBy("requete").agg(F.sum("n").cast("bigint").alias("n"))
    return wn.ordered_by_label(totals, "requete", cl.MEASURES).withColumn("position", F.col("position").cast("bigint"))


_DWH = """SELECT 'DWH-Intégré' AS requete, origin, count(*) AS nb FROM claim_heads GROUP BY 2
 UNION ALL SELECT 'DWH_Payé', o, count(DISTINCT d) FROM (SELECT coalesce(a.dossier_id, b.dossier_id) AS d, coalesce(a.origin, b.origin) AS o
   FROM (SELECT DISTINCT dossier_id, origin FROM claim_ops WHERE state IN ('PA', 'RL')) a
   FULL JOIN (SELECT DISTINCT dossier_id, origin FROM claim_ops WHERE state = 'VA' AND amount < 20000) b ON a.dossier_id = b.dossier_id) x GROUP BY 2
 UNION ALL SELECT 'DWH_Relevé', origin, count(DISTINCT dossier_id) FROM claim_ops WHERE state = 'RL' GROUP BY 2
 UNION ALL SELECT 'DWH-Attente', origin, count(*) FROM claim_ops WHERE state IN ('AC', 'VA') GROUP BY 2
 UNION ALL SELECT 'DWH_Rejets', origin, count(*) FROM claim_ops WHERE state = 'RJ' GROUP BY 2"""


@query("claims_sources_dwh", oracle(_DWH))
def claims_sources_dwh(f):
    recovered = f.claim_ops.where("state = 'VA' and amount < 20000")
    return cl.claims_sources_dwh(f.claim_heads, f.claim_ops, recovered)


_FOC = """SELECT origin, coalesce(nb_recu, 0) AS nb_recu, coalesce(nb_payes, 0) AS nb_payes, cast(coalesce(mnt, 0) AS double) AS montant_payes,
 coalesce(nb_attente, 0) AS nb_attente FROM (SELECT origin, count(*) AS nb_recu FROM claim_heads GROUP BY 1) r
 FULL JOIN (SELECT origin, count(CASE WHEN p THEN 1 END) AS nb_payes, sum(CASE WHEN p THEN a ELSE 0 END) AS mnt, count(CASE WHEN w THEN 1 END) AS nb_attente
  FROM (SELECT dossier_id, any_value(origin) AS origin, bool_or(state IN ('PA', 'RL')) AS p, bool_or(state IN ('AC', 'VA')) AS w, sum(amount) AS a
   FROM claim_ops GROUP BY 1) d WHERE p OR w GROUP BY 1) m USING (origin)"""


@query("full_outer_counts", oracle("SELECT * FROM foc", foc=_FOC))
def full_outer_counts(f):
    return cl.full_outer_counts(f.claim_heads, f.claim_ops)


_FIELDS = {"recu": "nb_recu", "paye": "nb_payes", "mnt": "montant_payes"}


def _wrap(name, x):
    return f"round({x}, 2) AS {name}" if name.startswith("mnt") else f"cast({x} AS bigint) AS {name}"


@query("payment_summary", oracle("SELECT " + ", ".join(
    [_wrap(f"{p}_{o}", f"coalesce(max(CASE WHEN origin = '{o}' THEN {c} END), 0)") for o in cl.SUMMARY_ORIGINS for p, c in _FIELDS.items()]
    + [_wrap(f"{p}_TOTAL_MANUEL", f"coalesce(sum(CASE WHEN origin IN ('ASSUR', 'TIERS', 'REGUL') THEN {c} END), 0)")
       for p, c in {**_FIELDS, "attente": "nb_attente"}.items()]) + " FROM foc", foc=_FOC))
def payment_summary(f):
    return cl.payment_summary(f.claim_heads, f.claim_ops)


@query("delay_buckets_paid", oracle(
    "SELECT origin, count(*) AS paye_total, " + ", ".join(f"{cnt(f'd = {n}')} AS j{n}" for n in range(5)) + f", {cnt('d > 4')} AS j5_plus FROM ("
    "SELECT any_value(origin) AS origin, max((op_no, op_ref, state))[3] AS st, date_diff('day', min(created), max_by(op_date, (op_no, op_ref))) AS d "
    "FROM claim_ops GROUP BY dossier_id) t WHERE st IN ('PA', 'RL') GROUP BY 1"))
def delay_buckets_paid(f):
    return cl.delay_buckets_paid(f.claim_ops)


@query("delay_buckets_rejected", oracle(
    f"""SELECT type_rejet, count(*) AS nb, {cnt('d <= 4')} AS lt5, {cnt('d > 4 AND d <= 9')} AS d5_9, {cnt('d > 9 AND d <= 19')} AS d10_19, {cnt('d > 19')} AS ge20 FROM (
      SELECT DISTINCT r.dossier_id, CASE substr(box, 1, 3) WHEN 'GES' THEN 'Rejet_GESTION' WHEN 'DSI' THEN 'Rejet_DSI' END AS type_rejet,
       date_diff('day', s.f, r.op_date) AS d FROM claim_ops r
      JOIN (SELECT dossier_id, min(op_date) AS f FROM claim_ops WHERE state = 'RJ' AND op_no = 2 GROUP BY 1) s USING (dossier_id)
      WHERE r.state = 'RJ' AND substr(box, 1, 3) IN ('GES', 'DSI')) t GROUP BY 1"""))
def delay_buckets_rejected(f):
    return cl.delay_buckets_rejected(f.claim_ops)


# ---- offers, listings, stock --------------------------------------------------


def _contracts(f):
    return canon.member_base(f).select(F.col("person_id").cast("bigint").alias("person_no"), F.col("offer").alias("contract_offer"))


_PRICED = """SELECT o.*, coalesce(o.offer, c.offer) AS offer_used FROM claim_ops o LEFT JOIN
 (SELECT DISTINCT cast(person_id AS bigint) AS person_no, offer FROM member_base) c ON o.offer IS NULL AND c.person_no = o.person_no"""


@query("outer_when_unpriced", oracle("SELECT dossier_id, op_no, op_ref, offer, offer_used FROM priced", priced=_PRICED))
def outer_when_unpriced(f):
    return cl.outer_when_unpriced(f.claim_ops, _contracts(f)).select("dossier_id", "op_no", "op_ref", "offer", "offer_used")


_IN98 = "created BETWEEN DATE '1997-01-01' AND DATE '2000-12-31'"


@query("claims_count_by_offer", oracle(
    f"SELECT strftime(created, '%Y%m%d') AS date_arrivee, offer_used AS offre, origin, state, count(DISTINCT dossier_id) AS nb_demandes FROM priced "
    f"WHERE {_IN98} AND (origin LIKE 'TP%' OR origin LIKE 'NMASS') GROUP BY 1, 2, 3, 4", priced=_PRICED))
def claims_count_by_offer(f):
    return cl.claims_count_by_offer(f.claim_ops, _contracts(f), "1997-01-01", "2000-12-31", origins="TP%,NMASS")


@query("claims_list", oracle(
    f"SELECT strftime(created, '%Y%m%d') AS date_arrivee, dossier_id, op_no, op_ref, offer_used AS offre, origin, state FROM priced "
    f"WHERE {_IN98} AND (offer_used LIKE 'MES%' OR offer_used LIKE 'OFF2')", priced=_PRICED))
def claims_list(f):
    return cl.claims_list(f.claim_ops, _contracts(f), "1997-01-01", "2000-12-31", offers="MES%,OFF2")


_LABELS = "SELECT DISTINCT reject_code AS code, 'Libellé ' || reject_code AS libelle FROM claim_ops"


def _labels(f):
    """Code dimension: at most two line states times seven line numbers."""
    return f.claim_ops.select(F.col("reject_code").alias("code")).distinct().withColumn("libelle", F.concat(F.lit("Libellé "), "code"))


@query("wait_by_signature", oracle(
    f"SELECT *, TOTAL_AUTO + TOTAL_MANUEL AS TOTAL FROM (SELECT signature, libelle, {_MATRIX} FROM (SELECT reject_code AS signature, origin, "
    "count(DISTINCT dossier_id) AS n FROM claim_ops WHERE state IN ('AC', 'VA') GROUP BY 1, 2) w JOIN labels_dim ON code = signature GROUP BY 1, 2) t",
    labels_dim=_LABELS))
def wait_by_signature(f):
    waiting = f.claim_ops.where(F.col("state").isin(*cl.WAITING)).withColumn("signature", F.col("reject_code"))
    return cl.wait_by_signature(waiting, _labels(f))


_STOCK = (f"SELECT *, TOTAL_AUTO + TOTAL_MANUEL AS \"Total\" FROM (SELECT box, reject_code, libelle, {_MATRIX} FROM (SELECT box, reject_code, origin, "
          "count(DISTINCT dossier_id) AS n FROM claim_ops WHERE state = 'RJ' GROUP BY 1, 2, 3) w JOIN labels_dim ON code = reject_code GROUP BY 1, 2, 3) t")


@query("stock_by_box", oracle(_STOCK, labels_dim=_LABELS))
def stock_by_box(f):
    return cl.stock_by_box(f.claim_ops.where(F.col("state") == cl.REJECTED), _labels(f))


@query("contracts_vs_duplicates", oracle(
    f"""SELECT 'GLOBAL' AS niveau, NULL AS code_offre, count(DISTINCT person_id) AS nb_assures, {big('sum(n)')} AS nb_contrats,
      {cnt('n > 1')} AS nb_assures_doublonnes, {big('sum(n) - count(DISTINCT person_id)')} AS nb_doublons FROM syn
    UNION ALL SELECT 'PAR_OFFRE', offer, count(DISTINCT person_id), {big('sum(n)')}, {cnt('n > 1')}, {big('sum(n) - count(DISTINCT person_id)')} FROM syn GROUP BY 2""",
    syn="SELECT offer, person_id, count(DISTINCT contract_id) AS n FROM insured GROUP BY 1, 2"))
def contracts_vs_duplicates(f):
    return cl.contracts_vs_duplicates(canon.insured(f))


_FEED = """SELECT event_id, event_type AS typcou, ts, CASE WHEN value < 5 THEN 'REJETEES' WHEN value < 10 THEN 'RECYCLES' WHEN value < 20 THEN 'TRAITEES PAR RECYCLAGE'
 ELSE 'TRAITEES' END AS etat, concat('0', substr(props, 7, 1), '0') AS codsoc FROM {events}"""


@query("grouping_sets_counts", oracle(
    "SELECT typcou, coalesce(etat, 'TOTAL') AS etat, count(*) AS nombre, min(ts) AS du, max(ts) AS au, printf('%02d:%02d:%02d', s // 3600, (s % 3600) // 60, s % 60) AS duree_hms FROM ("
    "SELECT *, 0 AS s FROM feed WHERE false) z GROUP BY 1, 2, s UNION ALL "
    "SELECT typcou, etat, nombre, du, au, printf('%02d:%02d:%02d', s // 3600, (s % 3600) // 60, s % 60) FROM (SELECT typcou, coalesce(etat, 'TOTAL') AS etat, count(*) AS nombre, "
    "min(ts) AS du, max(ts) AS au, (date_diff('microsecond', min(ts), max(ts)) // 1000000) % 86400 AS s FROM feed GROUP BY GROUPING SETS ((typcou, etat), (typcou))) t",
    feed=_FEED.replace("{events}", "events")))
def grouping_sets_counts(f):
    return cl.grouping_sets_counts(f.spark.sql(_FEED, events=f.events))


@query("recycle_counts", oracle(
    "SELECT coalesce(typcou, 'TOTAL_PAR_CODSOC') AS typcou, codsoc, count(*) AS total_lignes FROM feed WHERE etat = 'RECYCLES' GROUP BY GROUPING SETS ((typcou, codsoc), (codsoc))",
    feed=_FEED.replace("{events}", "events")))
def recycle_counts(f):
    return cl.recycle_counts(f.spark.sql(_FEED, events=f.events).where("etat = 'RECYCLES'"))


# ---- joins on claims ------------------------------------------------------------


@query("version_chain_join", oracle(
    """SELECT dossier_id AS contract_no, o_custkey AS person_no, n_name AS company, p_name AS offer, version, state, cast(op_date AS varchar) AS end_date FROM (
      SELECT c.dossier_id, c.op_no, c.op_ref, lpad(cast(c.op_no AS varchar), 6, '0') || c.op_ref AS version, c.state, c.op_date, cast(substr(c.op_ref, 12, 12) AS bigint) AS part_no,
       row_number() OVER (PARTITION BY dossier_id ORDER BY lpad(cast(c.op_no AS varchar), 6, '0') || c.op_ref DESC) AS rn FROM claim_ops c) v
    JOIN orders ON o_orderkey = dossier_id JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    JOIN part ON p_partkey = part_no WHERE rn = 1"""))
def version_chain_join(f):
    versions = f.claim_ops.select(
        F.col("dossier_id").alias("contract_no"),
        F.concat(F.lpad(F.col("op_no").cast("string"), 6, "0"), "op_ref").alias("version"),
        "state", F.col("op_date").alias("end_date"), F.substring("op_ref", 12, 12).cast("bigint").alias("offer_no"),
    )
    out = cl.version_chain_join(
        f.customer.select(F.col("c_custkey").alias("person_no"), F.col("c_nationkey").alias("company_no")),
        f.nation.select(F.col("n_nationkey").alias("company_no"), F.col("n_name").alias("company")),
        f.orders.select(F.col("o_orderkey").alias("contract_no"), F.col("o_custkey").alias("person_no")),
        versions,
        f.part.select(F.col("p_partkey").alias("offer_no"), F.col("p_name").alias("offer")),
    )
    return out.withColumn("end_date", F.col("end_date").cast("string"))


@query("parameter_cross_join", oracle(
    "SELECT origin, count(*) AS n FROM claim_heads, (SELECT max(received) - 400 AS d0, max(received) AS d1 FROM claim_heads) p WHERE received >= d0 AND received < d1 GROUP BY 1"))
def parameter_cross_join(f):
    heads = f.claim_heads
    params = heads.agg(F.date_sub(F.max("received"), 400).alias("d_debut"), F.max("received").alias("d_fin"))
    return cl.parameter_cross_join(heads, params, "received").groupBy("origin").agg(F.count("*").alias("n"))


@query("in_subquery", oracle(
    "SELECT dossier_id, op_no, op_ref FROM claim_ops WHERE dossier_id IN (SELECT dossier_id FROM claim_ops WHERE state = 'RJ' AND op_no = 1)"))
def in_subquery(f):
    wanted = f.claim_ops.where("state = 'RJ' and op_no = 1")
    return cl.in_subquery(f.claim_ops, wanted, "dossier_id").select("dossier_id", "op_no", "op_ref")
