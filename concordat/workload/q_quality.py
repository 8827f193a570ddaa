"""Volumes, completeness, matching KPIs, quality, registry and card KPIs."""

from __future__ import annotations

from pyspark.sql import functions as F

from concordat import functions as fx
from concordat.operators import card as cd
from concordat.operators import quality as ql
from concordat.workload import canon
from concordat.workload import oracle as q
from concordat.workload.oracle import cnt, facts_sql, oracle
from concordat.workload.registry import query

_ROLES = (
    "SELECT person_id, count(*) AS lignes, " + cnt("insured") + " AS la, " + cnt("spouse")
    + " AS lc FROM member_base WHERE coalesce(person_id, '') <> '' GROUP BY 1"
)


def one(select: str, measures, source: str = "one_row", **local: str) -> str:
    """Oracle for a one-row aggregate turned into facts."""
    local["one_row"] = select
    return oracle(facts_sql(source, measures), **local)


def shares(names, base="n"):
    return {c: (c, base) for c in names}


# ---- volumes ----------------------------------------------------------------


@query("volume_raw", one(f"SELECT count(*) AS lignes, {cnt('insured')} AS assures, {cnt('spouse')} AS conjoints FROM member_base",
                         {c: c for c in ("lignes", "assures", "conjoints")}))
def volume_raw(f):
    return ql.volume_raw(canon.member_base(f))


@query("population_unique", one(
    f"SELECT count(*) AS personnes, {cnt('la > 0')} AS assures, {cnt('lc > 0')} AS conjoints, "
    "(SELECT count(DISTINCT contract_id) FROM member_base) AS contrats FROM roles",
    {c: c for c in ("personnes", "assures", "conjoints", "contrats")}, roles=_ROLES))
def population_unique(f):
    return ql.population_unique(canon.member_base(f))


@query("cross_role_ids", one(
    f"SELECT {cnt('la > 0 AND lc > 0')} AS assure_et_conjoint, {cnt('la > 1')} AS assures_multi, {cnt('lc > 1')} AS conjoints_multi FROM roles",
    {c: c for c in ("assure_et_conjoint", "assures_multi", "conjoints_multi")}, roles=_ROLES))
def cross_role_ids(f):
    return ql.cross_role_ids(canon.member_base(f))


@query("duplicate_contracts", oracle(
    """SELECT kind, member_type, count(*) AS persons FROM (
      SELECT kind, '(tous)' AS member_type FROM dup UNION ALL
      SELECT DISTINCT d.kind || '', i.member_type || '' FROM dup d JOIN insured i USING (person_id) WHERE false UNION ALL
      SELECT kind, member_type FROM (SELECT DISTINCT d.person_id, d.kind, i.member_type FROM dup d JOIN insured i USING (person_id)) x) y
    GROUP BY 1, 2""",
    dup="""SELECT person_id, CASE WHEN count(DISTINCT offer) = 1 THEN 'MEME_OFFRE' ELSE 'DIFF_OFFRE' END AS kind FROM insured
      WHERE coalesce(person_id, '') <> '' GROUP BY 1 HAVING count(DISTINCT contract_id) > 1"""))
def duplicate_contracts(f):
    return ql.duplicate_contracts(canon.insured(f))


@query("multi_key_persons", oracle(
    "SELECT CASE keys WHEN 2 THEN '2_kpep' WHEN 3 THEN '3_kpep' ELSE 'plus_3_kpep' END AS bucket, count(*) AS total, "
    f"{cnt('ins')} AS insured FROM (SELECT person_id, count(DISTINCT nullif(kpep, '')) AS keys, bool_or(insured) AS ins "
    "FROM member_base WHERE coalesce(person_id, '') <> '' GROUP BY 1) t WHERE keys > 1 GROUP BY 1"))
def multi_key_persons(f):
    return ql.multi_key_persons(canon.member_base(f))


# ---- completeness -----------------------------------------------------------

_CONTACTS = ("idkpep", "email", "email_other", "first_name", "last_name", "middlename")
_SOURCES = {"CK": "ck_raw", "CM": "cm_raw", "Last": "last_raw", "Middle": "middle_raw"}


def _null(c):
    return f"({c} IS NULL OR upper({q.strip(c)}) = 'NULL')"


@query("completeness_contacts", oracle(" UNION ALL ".join(
    f"SELECT '{s}' AS source, '{c}' AS \"column\", {cnt(_null(c))} AS n_null, "
    f"{cnt(f'''NOT {_null(c)} AND {q.strip(c)} = {chr(39) * 2}''')} AS n_empty, "
    f"{cnt(f'''NOT {_null(c)} AND {q.strip(c)} <> {chr(39) * 2}''')} AS n_filled FROM {t}"
    for s, t in _SOURCES.items() for c in _CONTACTS)))
def completeness_contacts(f):
    return ql.completeness_contacts({s: getattr(f, t) for s, t in _SOURCES.items()}, list(_CONTACTS))


@query("completeness_keys", one(
    f"""SELECT count(*) AS n, {cnt('m OR k OR i')} AS avec_cle, {cnt('NOT (m OR k OR i)')} AS sans_cle, {cnt('m')} AS avec_email,
      {cnt('k')} AS avec_kpep, {cnt('i')} AS avec_identite FROM (SELECT person_id,
      bool_or(len({q.emails('email')}) > 0 OR len({q.emails('contact_email')}) > 0) AS m,
      bool_or(kpep NOT IN ('', 'NULL', 'null')) AS k, bool_or(last_name <> '' AND first_name <> '' AND birth_date <> '') AS i
      FROM insured WHERE coalesce(person_id, '') <> '' GROUP BY 1) t""",
    {"population": "n", **shares(("avec_cle", "sans_cle", "avec_email", "avec_kpep", "avec_identite"))}))
def completeness_keys(f):
    return ql.completeness_keys(canon.insured(f))


@query("completeness_fields", one(
    "SELECT count(*) AS n, " + ", ".join(f"{cnt(c + chr(32) + '<> ' + chr(39) * 2)} AS {n}" for n, c in ql.FOLLOWED_FIELDS.items())
    + " FROM insured", shares(ql.FOLLOWED_FIELDS)))
def completeness_fields(f):
    return ql.completeness_fields(canon.insured(f))


@query("cancel_rate", one(
    "SELECT count(*) AS n, " + cnt("insured") + " AS ni, " + cnt("cancel_date <> ''") + " AS r, "
    + cnt("cancel_date <> '' AND insured") + " AS ri FROM member_base", {"toute_population": ("r", "n"), "assures": ("ri", "ni")}))
def cancel_rate(f):
    return ql.cancel_rate(canon.member_base(f))


_CONS = {
    "egaux": "email = contact_email",
    "vrais_egaux": "email = contact_email AND email <> ''",
    "differents": "email <> contact_email",
    "ciam_seul": "email <> '' AND contact_email = ''",
    "coord_seule": "email = '' AND contact_email <> ''",
    "deux_distincts": "email <> '' AND contact_email <> '' AND email <> contact_email",
    "ciam_vides": "email = ''",
    "coord_vides": "contact_email = ''",
    "deux_vides": "email = '' AND contact_email = ''",
}


@query("email_consistency", one(
    "SELECT count(*) AS n, " + ", ".join(f"{cnt(c)} AS {n}" for n, c in _CONS.items()) + " FROM member_base", shares(_CONS)))
def email_consistency(f):
    return ql.email_consistency(canon.member_base(f))


# ---- matching KPIs -----------------------------------------------------------

_HIT = "match_status = 'RAPPROCHE'"


@query("match_totals", oracle(
    f"""SELECT 'GLOBAL' AS view, indicator AS label, nombre, pct FROM ({facts_sql('tot', {'cible': 'cible', **shares(('rapproches', 'non_rapproches'), 'cible')})}) g
    UNION ALL SELECT 'METHODE', match_method, count(*), NULL FROM match WHERE {_HIT} GROUP BY 2
    UNION ALL SELECT 'SOURCE', CASE match_method WHEN 'Recherche_Large_Nom' THEN 'Fichier_Last' WHEN 'Recherche_Large_Middle' THEN 'Fichier_Middle'
      ELSE 'Standard_CK_CM' END, count(*), NULL FROM match WHERE {_HIT} GROUP BY 2""",
    tot=f"SELECT count(*) AS cible, {cnt(_HIT)} AS rapproches, {cnt(f'NOT ({_HIT})')} AS non_rapproches FROM match"))
def match_totals(f):
    return ql.match_totals(canon.match(f))


_FIRST = """SELECT person_id, coalesce(arg_min(member_type, seq), 'UNK') AS member_type,
 coalesce(arg_min(company, seq) FILTER (WHERE company <> 'UNK'), 'UNK') AS company FROM insured WHERE coalesce(person_id, '') <> '' GROUP BY 1"""


@query("match_by_segment", oracle(
    f"""SELECT view, label, total, rapproches, total - rapproches AS non_rapproches, {q.pct('rapproches', 'total')} AS taux FROM (
      SELECT 'TYPE' AS view, member_type AS label, count(*) AS total, {cnt(_HIT)} AS rapproches FROM seg GROUP BY 2
      UNION ALL SELECT 'SOCIETE', company, count(*), {cnt(_HIT)} FROM seg GROUP BY 2) t""",
    fp=_FIRST, seg="SELECT m.match_status, f.* FROM match m JOIN fp f USING (person_id)"))
def match_by_segment(f):
    return ql.match_by_segment(canon.match(f), canon.insured(f))


@query("match_method_by_company", oracle(
    f"SELECT match_method, company, count(*) AS persons FROM match JOIN fp USING (person_id) WHERE {_HIT} GROUP BY 1, 2", fp=_FIRST))
def match_method_by_company(f):
    return ql.match_method_by_company(canon.match(f), canon.insured(f))


@query("unmatched_breakdown", one(
    f"""SELECT count(*) AS n, {cnt('NOT (m OR k OR i)')} AS aucune_cle, {cnt('m OR k OR i')} AS cle_non_trouvee,
      {cnt('k AND NOT kk')} AS kpep_absent, {cnt('m AND NOT mk')} AS email_absent FROM (
      SELECT person_id, coalesce(bool_or(grp = 'EMAIL'), false) AS m, coalesce(bool_or(grp = 'KPEP'), false) AS k,
       coalesce(bool_or(step = 4), false) AS i,
       coalesce(bool_or(grp = 'EMAIL' AND key IN (SELECT e FROM known_mail)), false) AS mk,
       coalesce(bool_or(grp = 'KPEP' AND upper(key) IN (SELECT k FROM known_key)), false) AS kk
      FROM match LEFT JOIN cand USING (person_id) WHERE NOT ({_HIT}) GROUP BY 1) t""",
    {"non_rapproches": "n", **shares(("aucune_cle", "cle_non_trouvee", "kpep_absent", "email_absent"))},
    known_mail="SELECT email AS e FROM accounts WHERE email <> '' UNION SELECT email_other FROM accounts WHERE email_other <> ''",
    known_key="SELECT upper(idkpep) AS k FROM accounts WHERE upper(idkpep) LIKE 'KPEP%'"))
def unmatched_breakdown(f):
    return ql.unmatched_breakdown(canon.insured(f), canon.match(f), canon.accounts(f))


@query("matched_email_empty", one(
    f"""SELECT count(*) AS n, {cnt('e')} AS vides, {cnt('s')} AS egaux FROM (SELECT person_id,
      bool_or(len({q.emails('i.contact_email')}) > 0 AND coalesce(m.email, '') = '') AS e,
      bool_or(coalesce(m.email, '') <> '' AND list_contains({q.emails('i.contact_email')}, m.email)) AS s
      FROM insured i JOIN matched m USING (person_id) GROUP BY 1) t""",
    {"email_compte_vide": ("vides", "n"), "email_compte_egal_contact": ("egaux", "n")}))
def matched_email_empty(f):
    return ql.matched_email_empty(canon.insured(f), canon.matched(f))


_KF = """SELECT m.person_id, coalesce(max(m.idkpep), '') AS acc, count(k.kpep) > 0 AS own,
 coalesce(bool_or(k.kpep = m.idkpep), false) AS same, coalesce(bool_or(upper(k.kpep) = upper(m.idkpep)), false) AS same_up
 FROM matched m LEFT JOIN person_kpeps k USING (person_id) GROUP BY 1"""


@query("key_coherence_two", one(
    "SELECT count(*) AS n, " + cnt("same AND acc <> ''") + " AS coherent, " + cnt("NOT same AND acc <> ''") + " AS different, "
    + cnt("acc = ''") + " AS absent FROM kf WHERE own", {"base": "n", **shares(("coherent", "different", "absent"))}, kf=_KF))
def key_coherence_two(f):
    return ql.key_coherence_two(canon.insured(f), canon.matched(f))


_K3 = {
    "ns_avec_kpep": "own", "ciam_avec_kpep": "acc <> ''", "iehe_avec_kpep": "reg <> ''",
    "ns_egal_ciam": "own AND acc <> '' AND same_up", "ns_different_ciam": "own AND acc <> '' AND NOT same_up",
    "iehe_egal_ciam": "reg <> '' AND acc <> '' AND reg = upper(acc)", "iehe_different_ciam": "reg <> '' AND acc <> '' AND reg <> upper(acc)",
    "trois_egaux": "own AND acc <> '' AND reg <> '' AND same_up AND reg = upper(acc)",
}


@query("key_coherence_three", one(
    "SELECT count(*) AS n, " + ", ".join(f"{cnt(c)} AS {n}" for n, c in _K3.items())
    + " FROM (SELECT kf.*, coalesce(r.reg, '') AS reg FROM kf LEFT JOIN reg r USING (person_id)) t", shares(_K3), kf=_KF,
    reg="SELECT refperboccn AS person_id, arg_min(upper(kpep_iehe), seq) AS reg FROM registry WHERE upper(kpep_iehe) LIKE 'KPEP%' GROUP BY 1"))
def key_coherence_three(f):
    return ql.key_coherence_three(canon.insured(f), canon.matched(f), canon.registry(f))


def _births(name, frame, col):
    return (f"SELECT '{name}' AS indicator, p AS nombre, {q.pct('p', 'n')} AS pct, n AS base FROM "
            f"(SELECT count(*) AS n, count(CASE WHEN {col} = '1900-01-01' THEN 1 END) AS p FROM {frame}) {name}")


@query("placeholder_births", oracle(" UNION ALL ".join((
    _births("comptes", "account_ref", "birth_iso"), _births("lignes_assures", "insured", "birth_date"),
    _births("rapproches", "matched", "birth_iso")))))
def placeholder_births(f):
    return ql.placeholder_births(canon.account_ref(f), canon.insured(f), canon.matched(f))


_DOM = "CASE WHEN strpos(email, '@') > 0 THEN substr(email, strpos(email, '@') + 1) ELSE '' END"


@query("email_quality", oracle(
    f"""SELECT source, 'TOTAL' AS view, label, n AS nombre, {q.pct('n', 'total')} AS pct FROM (
      SELECT source, unnest(['total', 'invalides', 'a_risque']) AS label, unnest([t, i, r]) AS n, t AS total FROM (
        SELECT source, count(*) AS t, {cnt(f"NOT regexp_matches(email, '{q.EMAIL_ANCHORED}')")} AS i, {cnt(f"dom IN {q.RISKY}")} AS r FROM em GROUP BY 1) a) b
    UNION ALL SELECT source, 'DOMAINE', dom, n, NULL FROM (SELECT source, dom, count(*) AS n,
      row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, dom) AS rn FROM em WHERE dom <> '' GROUP BY 1, 2) c WHERE rn <= 10""",
    em=f"""SELECT *, {_DOM} AS dom FROM (SELECT 'CIAM' AS source, email FROM accounts UNION ALL SELECT 'CIAM', email_other FROM accounts
      UNION ALL SELECT 'NS_MAIL', email FROM member_base UNION ALL SELECT 'NS_COORD', contact_email FROM member_base) e WHERE email <> ''"""))
def email_quality(f):
    acc = canon.accounts(f)
    both = acc.select("email").unionByName(acc.select(F.col("email_other").alias("email")))
    m = canon.member_base(f)
    return ql.email_quality({"CIAM": both, "NS_MAIL": m.select("email"), "NS_COORD": m.select(F.col("contact_email").alias("email"))})


_REASONS = f"""SELECT kf.person_id, m.birth_iso = '1900-01-01' AS r1, own AND acc <> '' AND NOT same_up AS r2,
 coalesce(m.email, '') <> '' AND NOT regexp_matches(m.email, '{q.EMAIL_ANCHORED}') AS r3,
 coalesce(m.email, '') <> '' AND regexp_matches(m.email, '{q.EMAIL_ANCHORED}') AND {_DOM.replace('email', 'm.email')} IN {q.RISKY} AS r4
 FROM kf JOIN matched m USING (person_id)"""
_ANY = "(coalesce(r1, false) OR r2 OR r3 OR r4)"


@query("quality_score", oracle(
    f"""SELECT * FROM (SELECT indicator, nombre, {q.pct('nombre', 'base')} AS pct, base FROM (
      SELECT unnest(['DATA_QUALITY_OK', 'DATA_QUALITY_KO', 'Prospect_CIAM', 'KPEP_NS_diff_CIAM', 'Email_CIAM_invalide', 'Email_CIAM_risque']) AS indicator,
       unnest([n - ko, ko, p, kd, inv, ris]) AS nombre, unnest([n, n, ko, ko, ko, ko]) AS base FROM (
       SELECT count(*) AS n, {cnt(_ANY)} AS ko, {cnt('r1')} AS p, {cnt('r2')} AS kd, {cnt('r3')} AS inv, {cnt('r4')} AS ris FROM rs) a) b) c
      WHERE indicator LIKE 'DATA%' OR nombre > 0""", kf=_KF, rs=_REASONS))
def quality_score(f):
    return ql.quality_score(canon.insured(f), canon.matched(f))


@query("account_quality", oracle(
    facts_sql("tot", {"emails_partages": "emails_partages", **shares(("sans_email", "sans_kpep", "other_seul", "comptes_concernes"))}),
    ent="""SELECT id, email AS mail FROM account_ref WHERE email <> '' UNION SELECT id, email_other FROM account_ref WHERE email_other <> ''""",
    sh="SELECT mail FROM ent GROUP BY 1 HAVING count(DISTINCT id) > 1",
    tot="SELECT count(*) AS n, " + cnt("email = '' AND email_other = ''") + " AS sans_email, " + cnt("upper(idkpep) NOT LIKE 'KPEP%'")
    + " AS sans_kpep, " + cnt("email = '' AND email_other <> ''") + """ AS other_seul, (SELECT count(*) FROM sh) AS emails_partages,
    (SELECT count(DISTINCT id) FROM ent WHERE mail IN (SELECT mail FROM sh)) AS comptes_concernes FROM account_ref"""))
def account_quality(f):
    return ql.account_quality(canon.account_ref(f))


# Matching blocks of two names: the longest common piece, the earliest first, then the same left and right of it.
_BLOCK = ("list_extract(list_filter(flatten(list_transform(range(least(length(a), length(b)), 0, -1), lambda k: list_transform(range(1, length(a) - k + 2), "
          "lambda i: {'k': k, 'i': i, 'j': strpos(b, substr(a, i, k))}))), lambda x: x.j > 0), 1)")


def _ratio(a, b):
    return f"(SELECT 2.0 * coalesce(max(s), 0) / (length({a}) + length({b})) FROM matching WHERE a0 = {a} AND b0 = {b})"


def _known(*cols):
    return " AND ".join(f"coalesce({c}, '') <> ''" for c in cols)


_BASES = f"""SELECT coalesce(last_name, '') AS l0, coalesce(last_norm, '') AS l1, coalesce(first_name, '') AS f0, coalesce(first_norm, '') AS f1, contact_email, coalesce(email, '') AS email,
 birth_date, birth_iso, birth_date <> '' AND birth_iso <> '' AND birth_date <> '1900-01-01' AND birth_iso <> '1900-01-01' AS b FROM matched m JOIN (
 SELECT person_id, birth_date, last_name, first_name, contact_email FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY seq) AS rn FROM (
   SELECT person_id, seq, birth_date, last_name, first_name, contact_email FROM member_base WHERE coalesce(person_id, '') <> '') r0) r WHERE rn = 1) r1 USING (person_id) WHERE m.src_rank IS NOT NULL"""


@query("attribute_divergence", one(
    f"""SELECT {cnt("b")} AS b, {cnt("b AND birth_date <> birth_iso")} AS bd, {cnt(_known("l0", "l1"))} AS n, {cnt("contact_email <> ''")} AS m,
      {cnt("contact_email <> '' AND email <> contact_email")} AS md, {cnt(f"{_known('l0', 'l1')} AND NOT (l0 = l1 AND (f0 = f1 OR f0 = '' OR f1 = '')) AND ({_ratio('l0', 'l1')} + "
      f"CASE WHEN f0 <> '' AND f1 <> '' THEN {_ratio('f0', 'f1')} ELSE 1.0 END) / 2 < 0.7")} AS nd FROM bases""",
    {"ddn_differente": ("bd", "b"), "nom_divergent": ("nd", "n"), "email_different": ("md", "m")},
    bases=_BASES,
    blocks=f"""SELECT a0, b0, a0 AS a, b0 AS b, cast(0 AS bigint) AS m FROM (SELECT DISTINCT l0 AS a0, l1 AS b0 FROM bases UNION SELECT DISTINCT f0, f1 FROM bases) z
      UNION ALL SELECT a0, b0, unnest([substr(a, 1, x.i - 1), substr(a, x.i + x.k)]), unnest([substr(b, 1, x.j - 1), substr(b, x.j + x.k)]), unnest([x.k, 0])
      FROM (SELECT *, {_BLOCK} AS x FROM blocks WHERE a <> '' AND b <> '') y WHERE x IS NOT NULL""",
    matching="SELECT a0, b0, sum(m) AS s FROM blocks GROUP BY 1, 2").replace("WITH ", "WITH RECURSIVE ", 1))
def attribute_divergence(f):
    return ql.attribute_divergence(canon.member_base(f), canon.matched(f))


# ---- registry KPIs ------------------------------------------------------------

_RM = q.strip("adrmailctc")


@query("registry_email_quality", one(
    "SELECT count(*) AS n, " + cnt(f"coalesce({_RM}, '') <> ''") + " AS rempli, " + cnt(f"coalesce({_RM}, '') = ''") + " AS vide, "
    + cnt(f"coalesce({_RM}, '') <> '' AND NOT regexp_matches({_RM}, '{q.EMAIL_ANCHORED}')") + " AS invalide FROM registry",
    {"rempli": ("rempli", "n"), "vide": ("vide", "n"), "invalide": ("invalide", "rempli")}))
def registry_email_quality(f):
    return ql.registry_email_quality(canon.registry(f))


_RC = ("identiques", "differents", "iehe_vide", "ciam_vide", "deux_vides")


@query("registry_email_concordance", one(
    "SELECT count(*) AS n, " + ", ".join(cnt(f"c = '{c}'") + f" AS {c}" for c in _RC) + ", " + cnt("c IN ('ciam_vide', 'differents')")
    + f""" AS potentiel FROM (SELECT CASE WHEN a = '' AND r = '' THEN 'deux_vides' WHEN r = '' THEN 'iehe_vide' WHEN a = '' THEN 'ciam_vide'
      WHEN a = r THEN 'identiques' ELSE 'differents' END AS c FROM (SELECT {q.norm_email('m.email')} AS a, {q.norm_email('r.adrmailctc')} AS r
      FROM matched m JOIN registry_first r ON r.refperboccn = m.person_id) x) y""", shares((*_RC, "potentiel"))))
def registry_email_concordance(f):
    return ql.registry_email_concordance(canon.matched(f), canon.registry_first(f))


_CC = ("identiques", "differentes", "iehe_vide", "ns_vide")


@query("registry_company_concordance", one(
    "SELECT count(*) AS n, " + ", ".join(cnt(f"c = '{c}'") + f" AS {c}" for c in _CC)
    + f""" FROM (SELECT CASE WHEN coalesce({q.strip('socappr')}, '') = '' THEN 'iehe_vide' WHEN coalesce(own, '') = '' THEN 'ns_vide'
      WHEN {q.strip('socappr')} = own THEN 'identiques' ELSE 'differentes' END AS c FROM registry_first
      LEFT JOIN (SELECT person_id, arg_min(company, seq) AS own FROM member_base GROUP BY 1) p ON p.person_id = refperboccn) x""", shares(_CC)))
def registry_company_concordance(f):
    return ql.registry_company_concordance(canon.registry_first(f), canon.member_base(f))


_PT = """SELECT person_id, member_type, count(*) AS lignes, min(seq) AS seq,
 CASE WHEN person_id IN (SELECT refperboccn FROM registry) THEN 1 ELSE 0 END AS present
 FROM member_base WHERE coalesce(person_id, '') <> '' GROUP BY 1, 2"""


@query("registry_presence_by_type", oracle(
    f"""SELECT member_type, reference, presents, reference - presents AS manquants, {q.pct('presents', 'reference')} AS taux_presents,
      {q.pct('(reference - presents)', 'reference')} AS taux_manquants FROM (
      SELECT member_type, count(*) AS reference, cast(sum(present) AS bigint) AS presents FROM pt GROUP BY 1
      UNION ALL SELECT '(tous)', count(DISTINCT person_id), count(DISTINCT CASE WHEN present = 1 THEN person_id END) FROM pt) t""", pt=_PT))
def registry_presence_by_type(f):
    return ql.registry_presence_by_type(canon.member_base(f), canon.registry(f))


@query("lines_vs_persons", oracle(
    """SELECT scope, member_type, lignes, personnes, lignes - personnes AS delta FROM (
      SELECT 'TOTAL' AS scope, member_type, cast(sum(lignes) AS bigint) AS lignes, count(*) AS personnes FROM pt GROUP BY 2
      UNION ALL SELECT CASE present WHEN 1 THEN 'PRESENTS' ELSE 'MANQUANTS' END, member_type, cast(sum(lignes) AS bigint), count(*) FROM pt GROUP BY 1, 2
      UNION ALL SELECT CASE present WHEN 1 THEN 'PRESENTS' ELSE 'MANQUANTS' END, '(tous)', cast(sum(lignes) AS bigint), count(*) FROM pp GROUP BY 1
      UNION ALL SELECT 'TOTAL', '(tous)', cast(sum(lignes) AS bigint), count(*) FROM pp
      UNION ALL SELECT 'MULTI_CONTRATS', member_type, cast(sum(lignes) AS bigint), count(*) FROM pp WHERE lignes > 1 GROUP BY 2
      UNION ALL SELECT 'EXEMPLE ' || person_id, member_type, lignes, 1 FROM (SELECT * FROM pp WHERE lignes > 1 ORDER BY lignes DESC, person_id LIMIT 5) e) t""",
    pt=_PT, pp="SELECT person_id, max(present) AS present, cast(sum(lignes) AS bigint) AS lignes, arg_min(member_type, seq) AS member_type FROM pt GROUP BY 1"))
def lines_vs_persons(f):
    return ql.lines_vs_persons(canon.member_base(f), canon.registry(f))


# ---- card KPIs ----------------------------------------------------------------

_EF = cnt("status = 'ELIGIBLE_TP'") + " AS eligible, " + cnt("status = 'FUTURE_TP'") + " AS future"


@query("card_kpis", oracle(
    f"""SELECT view, label, eligible, future, eligible + future AS base, {q.pct('eligible', '(eligible + future)')} AS rate_eligible,
      {q.pct('future', '(eligible + future)')} AS rate_future FROM (
      SELECT 'TOTAL' AS view, '' AS label, {_EF} FROM person_card
      UNION ALL SELECT 'MOIS', substr(effect_date, 1, 7), {_EF} FROM person_card WHERE {q.day('effect_date')} IS NOT NULL GROUP BY 2
      UNION ALL SELECT 'DETAIL', concat_ws(' | ', company, offer, member_type), {_EF} FROM person_card GROUP BY 2) t"""))
def card_kpis(f):
    return cd.card_kpis(canon.person_card(f))


@query("card_by_company", oracle(f"SELECT company, {_EF} FROM person_card GROUP BY 1"))
def card_by_company(f):
    return cd.card_by_company(canon.person_card(f))


@query("card_unmatched", oracle(
    f"""SELECT eligible, unmatched, eligible_unmatched, eligible_no_email, {q.pct('eligible_unmatched', 'eligible')} AS pct_unmatched,
      {q.pct('eligible_no_email', 'eligible')} AS pct_no_email FROM (SELECT {cnt("card = 'ELIGIBLE_TP'")} AS eligible,
      {cnt("match_status = 'NON_RAPPROCHE'")} AS unmatched, {cnt("card = 'ELIGIBLE_TP' AND match_status = 'NON_RAPPROCHE'")} AS eligible_unmatched,
      {cnt("card = 'ELIGIBLE_TP' AND NOT coalesce(match_status = 'RAPPROCHE' AND valid, false)")} AS eligible_no_email FROM (
       SELECT p.status AS card, m.match_status, coalesce(regexp_matches(r.email, '{q.EMAIL_ANCHORED}'), false) AS valid
       FROM person_card p FULL JOIN match m USING (person_id) LEFT JOIN account_ref r ON r.id = m.matched_id) x) y"""))
def card_unmatched(f):
    emails = canon.account_ref(f).select("id", "email")
    return cd.card_unmatched(canon.person_card(f), canon.match(f), emails, fx.is_valid_email(F.col("email")))


_DAYS = f"date_diff('day', DATE '2000-01-01', {q.day('effect_date')})"
_LEFT = f"date_diff('day', DATE '2000-02-15', {q.day('effect_date')})"


@query("card_delay", oracle(
    f"""SELECT count(*) AS population, coalesce(round(cast(sum(d) AS double) / count(*), 1), 0.0) AS mean_days,
      coalesce(cast((SELECT d FROM (SELECT d, row_number() OVER (ORDER BY d) - 1 AS i FROM ft) z
        WHERE i = (SELECT count(*) // 2 FROM ft)) AS bigint), 0) AS median_days,
      cast(coalesce(min(d), 0) AS bigint) AS min_days, cast(coalesce(max(d), 0) AS bigint) AS max_days,
      {cnt('d <= 30')} AS b0_30, {cnt('d > 30 AND d <= 60')} AS b31_60, {cnt('d > 60 AND d <= 90')} AS b61_90,
      {cnt('d > 90 AND d <= 180')} AS b91_180, {cnt('d > 180')} AS b181, {cnt('l > 30')} AS gt30, {cnt('l > 60')} AS gt60, {cnt('l > 90')} AS gt90 FROM ft""",
    ft=f"SELECT {_DAYS} AS d, {_LEFT} AS l FROM person_card WHERE status = 'FUTURE_TP' AND {q.day('effect_date')} IS NOT NULL"))
def card_delay(f):
    return cd.card_delay(canon.person_card(f), "2000-01-01", "2000-02-15")


@query("card_registry_correlation", oracle(
    """SELECT scope, member_type, status, coalesce(l, 0) AS lignes, coalesce(p, 0) AS personnes, coalesce(l, 0) - coalesce(p, 0) AS delta FROM (
      SELECT CASE WHEN person_id IN (SELECT refperboccn FROM registry) THEN 'PRESENTS' ELSE 'MANQUANTS' END AS scope, member_type, status, count(*) AS l
      FROM card WHERE status <> 'HORS_PERIMETRE_TP' AND coalesce(person_id, '') <> '' GROUP BY 1, 2, 3) a
    FULL JOIN (SELECT CASE WHEN person_id IN (SELECT refperboccn FROM registry) THEN 'PRESENTS' ELSE 'MANQUANTS' END AS scope, member_type, status,
      count(*) AS p FROM person_card GROUP BY 1, 2, 3) b USING (scope, member_type, status)"""))
def card_registry_correlation(f):
    return ql.card_registry_correlation(canon.member(f), canon.registry(f))


@query("retry_totals", oracle(
    f"""SELECT coalesce(source_file, '(tous)') AS source_file, coalesce(member_type, '(tous)') AS member_type, coalesce(label, '(tous)') AS label,
      count(*) AS initial, {cnt("upper(trim(statut_retry)) = 'OK'")} AS resolus, count(*) - {cnt("upper(trim(statut_retry)) = 'OK'")} AS encore_ko,
      {q.pct(cnt("upper(trim(statut_retry)) = 'OK'"), 'count(*)')} AS taux, max(date_derniere_verif) AS derniere FROM ko_labelled
    GROUP BY GROUPING SETS ((source_file), (member_type), (label), (source_file, member_type), (source_file, label), ())"""))
def retry_totals(f):
    return ql.retry_totals(canon.ko_labelled(f))
