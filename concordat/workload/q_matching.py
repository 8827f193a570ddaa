"""Matching, joins and look-ups."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from concordat.operators import activity as av
from concordat.operators import documents as dc
from concordat.operators import lookups as lk
from concordat.operators import matching as mt
from concordat.operators import registry as rg
from concordat.operators import sets as ss
from concordat.session import checkpoint_dir
from concordat.sources import newest as nw
from concordat.sources import state as st
from concordat.workload import canon
from concordat.workload import oracle as q
from concordat.workload.oracle import cnt, oracle
from concordat.workload.registry import query


@query("match_cascade", oracle("SELECT * FROM match"))
def match_cascade(f):
    return canon.match(f)


@query("person_view", oracle(
    "SELECT p.person_id, " + ", ".join(
        f"coalesce(string_agg(key, ';' ORDER BY key) FILTER (WHERE step = {i}), '') AS {n}"
        for i, n in ((1, "emails_ciam"), (2, "emails_val"), (3, "kpeps"), (4, "ident_full"), (5, "ident_inv"), (6, "nom_ddn")))
    + " FROM (SELECT DISTINCT person_id FROM insured WHERE coalesce(person_id, '') <> '') p LEFT JOIN cand USING (person_id) GROUP BY 1"))
def person_view(f):
    view = mt.person_view(canon.insured(f))
    return view.select("person_id", *[F.array_join(c, ";").alias(c) for c in view.columns[1:]])


@query("email_index", oracle(
    "SELECT email, id FROM (SELECT *, row_number() OVER (PARTITION BY email ORDER BY part, src_rank, seq, id) AS rn FROM email_entries WHERE email <> '') e WHERE rn = 1"))
def email_index(f):
    return mt.email_index(canon.accounts(f))


_REF = {"last_name": "raw_last_name", "middlename": "middlename", "first_name": "raw_first_name", "birthdate": "raw_birthdate",
        "idkpep": "idkpep", "email": "email", "email_other": "email_other", "phonenumber": "phonenumber"}


def _clean(c):
    v = f"coalesce(trim({c}), '')"
    return f"CASE WHEN lower({v}) IN {q.WORDS} THEN '' ELSE {v} END"


@query("match_propagate", oracle(
    "SELECT i.contract_id, i.person_id, x.match_status, x.match_method, x.matched_id, " + ", ".join(f"{_clean('r.' + c)} AS acc_{n}" for n, c in _REF.items())
    + " FROM insured i LEFT JOIN match x USING (person_id) LEFT JOIN refs r ON r.id = x.matched_id",
    refs="""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY p, src_rank, seq) AS rn FROM (
      SELECT 0 AS p, * FROM accounts UNION ALL SELECT 1, * FROM last_acc UNION ALL SELECT 2, * FROM middle_acc) u) v WHERE rn = 1"""))
def match_propagate(f):
    rows = canon.propagated(f)
    return rows.select("contract_id", "person_id", "match_status", "match_method", "matched_id", *[f"acc_{n}" for n in _REF])


@query("unmatched_remainder", oracle(
    """SELECT DISTINCT search, value_a, value_b FROM (
      SELECT unnest(['LAST_DATE', 'LAST_FIRST', 'MIDDLE_DATE', 'MIDDLE_FIRST']) AS search, last_name AS value_a,
       unnest([birth_date, first_name, birth_date, first_name]) AS value_b FROM insured
      WHERE email NOT IN (SELECT email FROM cm WHERE email <> '') AND contact_email NOT IN (SELECT email FROM cm WHERE email <> '')
       AND kpep NOT IN (SELECT idkpep FROM ck WHERE idkpep <> '')) t WHERE value_a <> '' AND value_b <> ''""",
    cm="SELECT * FROM (" + q._account("cm_raw", "CM", 2) + ") u",
    ck="SELECT * FROM (" + q._account("ck_raw", "CK", 1) + ") u"))
def unmatched_remainder(f):
    from concordat.operators.normalize import normalize_account

    return mt.unmatched_remainder(canon.insured(f), normalize_account(f.cm_raw), normalize_account(f.ck_raw))


# ---- registry ---------------------------------------------------------------


@query("reference_lookup", oracle("SELECT * FROM registry_raw WHERE refperboccn IN (SELECT person_id FROM insured)"))
def reference_lookup(f):
    return rg.reference_lookup(canon.insured(f).select("person_id"), f.registry_raw)


@query("registry_self_join", oracle("SELECT refperboccn, idrpp, socappr, adrmailctc, telmbictc, seq, kpep_iehe FROM registry"))
def registry_self_join(f):
    return canon.registry(f)


@query("registry_presence", oracle(
    "SELECT person_id, cast(person_id IN (SELECT refperboccn FROM registry) AS integer) AS present FROM (SELECT DISTINCT person_id FROM member_base) p"))
def registry_presence(f):
    return rg.registry_presence(canon.member_base(f).select("person_id").distinct(), canon.registry(f))


@query("registry_enrich", oracle(
    "SELECT contract_id, person_id, idrpp, socappr, adrmailctc, telmbictc, kpep_iehe FROM member_base LEFT JOIN registry_first ON refperboccn = person_id"))
def registry_enrich(f):
    rows = rg.registry_enrich(canon.member_base(f), canon.registry(f))
    return rows.select("contract_id", "person_id", "idrpp", "socappr", "adrmailctc", "telmbictc", "kpep_iehe")


_RR = """SELECT r.refperboccn, r.adrmailctc, k.kp FROM (SELECT *, row_number() OVER (PARTITION BY refperboccn ORDER BY seq) AS rn FROM registry_raw) r
 LEFT JOIN (SELECT idrpp, min(refperboccn) AS kp FROM registry_raw WHERE refperboccn LIKE 'KPEP%' GROUP BY 1) k USING (idrpp) WHERE r.rn = 1"""


@query("retry_registry", oracle(
    """SELECT source_file, l.person_id, CASE WHEN statut_retry = 'KO' AND r.refperboccn IS NOT NULL THEN 'OK' ELSE statut_retry END AS statut_retry,
      CASE WHEN statut_retry = 'KO' THEN '2001-03-01' ELSE date_derniere_verif END AS date_derniere_verif,
      CASE WHEN statut_retry = 'KO' AND r.refperboccn IS NOT NULL THEN coalesce(adrmailctc, '') ELSE mail_iehe END AS mail_iehe,
      CASE WHEN statut_retry = 'KO' AND r.refperboccn IS NOT NULL THEN coalesce(kp, '') ELSE kpep_iehe END AS kpep_iehe
    FROM ko_ledger l LEFT JOIN rr r ON r.refperboccn = l.person_id""", rr=_RR))
def retry_registry(f):
    out = rg.retry_registry(f.ko_ledger, f.registry_raw, "2001-03-01")
    return out.select("source_file", "person_id", "statut_retry", "date_derniere_verif", "mail_iehe", "kpep_iehe")


# ---- documents ----------------------------------------------------------------


def control_sql(tag: str, registry: str, documents: str) -> dict[str, str]:
    """CTEs of the document control over given registry and document CTEs."""
    key = (f"CASE WHEN coalesce({q.strip('kpep_iehe')}, '') NOT IN ('', 'nan', 'none', 'null') THEN {q.strip('kpep_iehe')} "
           "WHEN upper(idrpp) LIKE 'KPEP%' THEN idrpp ELSE '' END")
    return {
        f"rk{tag}": f"SELECT * FROM (SELECT refperboccn AS person_id, coalesce({q.strip('socappr')}, '') AS company, {key} AS key, seq FROM {registry}) k WHERE key <> ''",
        f"rx{tag}": f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY person_id, company ORDER BY seq) AS rn FROM rk{tag}) k WHERE rn = 1",
        f"ro{tag}": f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY CASE WHEN company <> '' THEN 0 ELSE 1 END, seq) AS rn FROM rk{tag}) k WHERE rn = 1",
        f"keyed{tag}": f"""SELECT m.contract_id, m.person_id, m.company, m.offer, m.kpep, upper(coalesce(x.key, o.key, '')) AS kpep_reference,
          CASE WHEN x.key IS NOT NULL THEN 'match_societe' WHEN o.key IS NOT NULL THEN 'fallback_autre_societe' ELSE 'absent_iehe' END AS motif_kpep
          FROM (SELECT * FROM member_base WHERE {q.DOC_REASON} = '') m LEFT JOIN rx{tag} x USING (person_id, company) LEFT JOIN ro{tag} o USING (person_id)""",
        f"dk{tag}": f"SELECT DISTINCT upper({q.strip('idepsp')}) AS k FROM {documents}",
        f"present{tag}": f"""SELECT *, CASE WHEN kpep_reference <> '' AND kpep_reference IN (SELECT k FROM dk{tag}) THEN 'OUI' ELSE 'NON' END AS present_ged,
          CASE WHEN kpep_reference <> '' AND kpep_reference IN (SELECT k FROM dk{tag}) THEN 'RAPPROCHE' ELSE 'NON_RAPPROCHE' END AS statut_rapprochement,
          CASE WHEN kpep_reference = '' THEN 'KPEP IEHE absent' WHEN motif_kpep = 'fallback_autre_societe' THEN 'KPEP IEHE société différente (fallback)' ELSE '' END AS motif
          FROM keyed{tag}""",
        "corr": """SELECT * FROM (SELECT upper(kpep_ref) AS k, code_societe AS c, upper(offre) AS o, upper(decision_manuelle) AS d, commentaire AS n,
          row_number() OVER (PARTITION BY upper(kpep_ref), code_societe, upper(offre) ORDER BY seq DESC) AS rn FROM corrections
          WHERE upper(decision_manuelle) IN ('FORCE_RAPPROCHE', 'FORCE_NON_RAPPROCHE')) z WHERE rn = 1""",
        f"detail{tag}": f"""SELECT *, CASE WHEN statut_final <> statut_rapprochement THEN 'OUI' ELSE 'NON' END AS correction_manuelle FROM (
          SELECT p.*, CASE coalesce(a.d, b.d, e.d) WHEN 'FORCE_RAPPROCHE' THEN 'RAPPROCHE' WHEN 'FORCE_NON_RAPPROCHE' THEN 'NON_RAPPROCHE'
            ELSE statut_rapprochement END AS statut_final,
           coalesce(trim('[' || coalesce(a.d, b.d, e.d) || '] ' || CASE WHEN a.d IS NOT NULL THEN a.n WHEN b.d IS NOT NULL THEN b.n ELSE e.n END), '') AS commentaire
          FROM present{tag} p LEFT JOIN corr a ON a.k = p.kpep_reference AND a.c = p.company AND a.o = p.offer
          LEFT JOIN corr b ON b.k = p.kpep_reference AND b.c = p.company AND b.o = ''
          LEFT JOIN corr e ON e.k = p.kpep_reference AND e.c = '' AND e.o = '') w""",
    }


_FULL = control_sql("", "registry", "document_keys")


@query("key_with_fallback", oracle("SELECT contract_id, kpep_reference, motif_kpep FROM keyed", **_FULL))
def key_with_fallback(f):
    return dc.key_with_fallback(canon.eligible(f), canon.registry(f)).select("contract_id", "kpep_reference", "motif_kpep")


@query("document_presence", oracle("SELECT contract_id, present_ged, statut_rapprochement, motif FROM present", **_FULL))
def document_presence(f):
    keyed = dc.key_with_fallback(canon.eligible(f), canon.registry(f))
    return dc.document_presence(keyed, f.document_keys).select("contract_id", "present_ged", "statut_rapprochement", "motif")


@query("override_by_specificity", oracle("SELECT contract_id, statut_final, correction_manuelle, commentaire FROM detail", **_FULL))
def override_by_specificity(f):
    return canon.document_detail(f).select("contract_id", "statut_final", "correction_manuelle", "commentaire")


_DK = {"eligible": "count(*)", "found": cnt("present_ged = 'OUI'"), "not_found": cnt("present_ged = 'NON'"),
       "corrected": cnt("correction_manuelle = 'OUI'"), "matched_final": cnt("statut_final = 'RAPPROCHE'"), "unmatched_final": cnt("statut_final = 'NON_RAPPROCHE'")}


@query("document_kpis", oracle(
    f"""SELECT *, {q.pct('found', 'eligible')} AS rate_found, {q.pct('corrected', 'eligible')} AS rate_corrected, {q.pct('matched_final', 'eligible')} AS rate_final
    FROM (SELECT coalesce(company, 'TOTAL') AS company, {', '.join(f'{x} AS {n}' for n, x in _DK.items())} FROM detail GROUP BY ROLLUP (company)) t""", **_FULL))
def document_kpis(f):
    return dc.document_kpis(canon.document_detail(f))


_FIRST_RUN = {
    "registry1": "SELECT * FROM registry WHERE socappr <> '' AND adrmailctc IS NOT NULL",
    "documents1": "SELECT * FROM document_keys WHERE idepsp LIKE 'KPEP%'",
    **control_sql("1", "registry1", "documents1"),
}


@query("retry_document", oracle(
    """SELECT contract_id, coalesce(nullif(kpep_reference, ''), kr2) AS kpep_reference, CASE WHEN kpep_reference = '' AND kr2 <> '' THEN mk2 ELSE motif_kpep END AS motif_kpep,
      CASE WHEN open AND fk <> '' THEN pg ELSE present_ged END AS present_ged, CASE WHEN open AND fk <> '' THEN sf ELSE statut_final END AS statut_final,
      CASE WHEN open AND fk <> '' THEN CASE WHEN (CASE WHEN kpep_reference = '' THEN mk2 ELSE motif_kpep END) = 'fallback_autre_societe'
        THEN 'KPEP IEHE société différente (fallback)' ELSE '' END ELSE motif END AS motif,
      CASE WHEN NOT open OR (fk <> '' AND sf = 'RAPPROCHE') THEN 'OK' ELSE 'KO' END AS statut_retry,
      CASE WHEN open THEN '2001-03-01' ELSE '' END AS date_derniere_verif FROM (
      SELECT d.*, statut_final <> 'RAPPROCHE' AS open, CASE WHEN statut_final <> 'RAPPROCHE' THEN k2.kpep_reference ELSE '' END AS kr2, k2.motif_kpep AS mk2,
       coalesce(nullif(d.kpep_reference, ''), k2.kpep_reference) AS fk,
       CASE WHEN coalesce(nullif(d.kpep_reference, ''), k2.kpep_reference) IN (SELECT k FROM dk2) THEN 'OUI' ELSE 'NON' END AS pg,
       CASE coalesce(a.d, b.d, e.d) WHEN 'FORCE_RAPPROCHE' THEN 'RAPPROCHE' WHEN 'FORCE_NON_RAPPROCHE' THEN 'NON_RAPPROCHE'
        ELSE CASE WHEN coalesce(nullif(d.kpep_reference, ''), k2.kpep_reference) IN (SELECT k FROM dk2) THEN 'RAPPROCHE' ELSE 'NON_RAPPROCHE' END END AS sf
      FROM detail1 d JOIN keyed2 k2 USING (contract_id)
      LEFT JOIN corr a ON a.k = coalesce(nullif(d.kpep_reference, ''), k2.kpep_reference) AND a.c = d.company AND a.o = d.offer
      LEFT JOIN corr b ON b.k = coalesce(nullif(d.kpep_reference, ''), k2.kpep_reference) AND b.c = d.company AND b.o = ''
      LEFT JOIN corr e ON e.k = coalesce(nullif(d.kpep_reference, ''), k2.kpep_reference) AND e.c = '' AND e.o = '') t""",
    **_FIRST_RUN, **{k: v for k, v in control_sql("2", "registry", "document_keys").items() if k != "corr"}))
def retry_document(f):
    reg, docs = canon.registry(f), f.document_keys
    first = dc.document_control(
        canon.member_base(f), reg.where("socappr <> '' and adrmailctc is not null"), docs.where(F.col("idepsp").startswith("KPEP")), f.corrections
    )
    ledger = first.withColumn("statut_retry", F.when(F.col("statut_final") == "RAPPROCHE", "OK").otherwise("KO")).withColumn("date_derniere_verif", F.lit(""))
    out = dc.retry_document(ledger, reg, docs, f.corrections, "2001-03-01")
    return out.select("contract_id", "kpep_reference", "motif_kpep", "present_ged", "statut_final", "motif", "statut_retry", "date_derniere_verif")


# ---- attributes -----------------------------------------------------------------


@query("historical_lookup", oracle("SELECT * FROM history"))
def historical_lookup(f):
    # The state starts at an earlier run and is advanced by the runs since, one partition each.
    path = f"{checkpoint_dir(f.spark).rstrip('/')}/concordat-{uuid.uuid4().hex}"
    st.write_snapshot(canon.snapshots(f).select("person_id", "seq", *lk.ATTRIBUTES, "flux_id"), path + "/runs")
    nw.bootstrap(f.spark, path + "/runs", path + "/newest", "31121999")
    nw.advance(f.spark, path + "/runs", path + "/newest", "31122000")
    return nw.newest_before(f.spark, path + "/newest", canon.CURRENT_RUN)


@query("latest_snapshot", oracle("SELECT contract_id, person_id, flux_id FROM member WHERE flux_id = '31122001'"))
def latest_snapshot(f):
    return lk.latest_snapshot(canon.snapshots(f)).select("contract_id", "person_id", "flux_id")


@query("attribute_by_source_priority", oracle(
    "SELECT source_file, person_id, member_type, offer, company, adhesion_date, effect_date, label FROM ko_labelled"))
def attribute_by_source_priority(f):
    return canon.ko_labelled(f).select("source_file", "person_id", "member_type", "offer", "company", "adhesion_date", "effect_date", "label")


_ATTR = {"attr_realm_id": "societe-codeGestionnaire", "idkpep": "kpepId", "birthdate": "birthDate", "email_other": "email_other",
         "channel": "ActivationData-DeepLink-Chanel", "middlename": "middleName", "phonenumber": "phoneNumber", "origincreation": "originCreation"}


@query("attribute_pivot_join", oracle(
    "SELECT u.id, u.email, u.realm_id, " + ", ".join(f"coalesce(max(CASE WHEN a.name = '{n}' THEN a.value END), '') AS {c}" for c, n in _ATTR.items())
    + " FROM user_entity u LEFT JOIN user_attribute a ON a.user_id = u.id GROUP BY 1, 2, 3"))
def attribute_pivot_join(f):
    rows = av.attribute_pivot_join(f.user_entity.select("id", "email", "realm_id"), f.user_attribute)
    return rows


# ---- sets -----------------------------------------------------------------------


@query("id_set_ops", oracle(
    """SELECT person_id, CASE WHEN r IS NULL THEN 'GAUCHE' WHEN l IS NULL THEN 'DROITE' ELSE 'COMMUN' END AS place FROM (
      SELECT DISTINCT person_id, 1 AS l FROM member_base WHERE insured) a FULL JOIN (SELECT DISTINCT person_id, 1 AS r FROM member_base WHERE spouse) b USING (person_id)"""))
def id_set_ops(f):
    from concordat.operators.filters import scope_filter

    m = canon.member_base(f)
    return ss.id_set_ops(scope_filter(m, "ASSURE"), scope_filter(m, "CONJOINT"), "person_id")


@query("distinct_values", oracle("SELECT DISTINCT kpep FROM member_base WHERE coalesce(kpep, '') <> ''"))
def distinct_values(f):
    return ss.distinct_values(canon.member_base(f), "kpep")


_MAPPING = """SELECT DISTINCT upper(trim(o)) AS code, CASE WHEN o LIKE 'MESMEN%' OR o LIKE 'mesmen%' THEN 'MEN' WHEN o LIKE 'MESMEAE%' THEN 'MEAE'
 WHEN o LIKE 'MESLAD%' THEN 'MSOL' WHEN o = 'INPPREVIND' THEN 'PREV_INDIV' WHEN o = 'INPCULT002' THEN 'PREV_CULTURE' ELSE 'MSP' END AS nature,
 CASE WHEN o LIKE 'MES%' THEN '010' WHEN o LIKE 'IN%' THEN '044' ELSE '052' END AS societe
 FROM (SELECT offre AS o FROM {member_base_raw}) t WHERE o IS NOT NULL AND o <> 'INDSANTE1'"""
q.CTES["offer_mapping"] = _MAPPING.replace("{member_base_raw}", "member_base_raw")


@query("offer_enrich", oracle(
    "SELECT contract_id, m.offer, coalesce(d.nature, m.offer) AS nature, coalesce(d.societe, '?') AS societe FROM member_base m LEFT JOIN offer_mapping d ON d.code = m.offer"))
def offer_enrich(f):
    mapping = canon.offer_mapping(f)
    return lk.offer_enrich(canon.member_base(f).select("contract_id", "offer"), mapping)
