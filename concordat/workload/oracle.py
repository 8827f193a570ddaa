"""SQL twins of the canonical frames, for the DuckDB oracle.

``oracle(body)`` prefixes a query with the common table expressions it names,
directly or through others.
"""

from __future__ import annotations

import re

from concordat.functions.text import NULL_WORDS, RISKY_DOMAINS
from concordat.operators.normalize import INSURED_TYPES
from concordat.workload.frames import RAW

WS = r"chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||' '"
EMAIL_SEARCH = r"(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}"
EMAIL_ANCHORED = r"(?i)^[A-Z0-9._%+\-]+@[A-Z0-9.\-]+\.[A-Z]{2,}$"
RISKY = "(" + ", ".join(f"'{d}'" for d in RISKY_DOMAINS) + ")"
INSURED = "(" + ", ".join(f"'{d}'" for d in INSURED_TYPES) + ")"
WORDS = "(" + ", ".join(f"'{w}'" for w in NULL_WORDS) + ")"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def norm_text(x: str) -> str:
    up = f"strip_accents({strip(f'''upper(replace({x}, 'ß', 'SS'))''')})"
    return f"coalesce(regexp_replace({up}, '[^\\x00-\\x7F]', '', 'g'), '')"


def norm_email(x: str) -> str:
    low = strip(f"lower({x})")
    return f"(CASE WHEN {x} IS NULL OR {low} IN {WORDS} THEN '' ELSE {low} END)"


def emails(x: str) -> str:
    """Distinct e-mails in order of appearance, as a list."""
    s = strip(x)
    found = f"regexp_extract_all({s}, '{EMAIL_SEARCH}')"
    values = f"(CASE WHEN len({found}) > 0 THEN {found} WHEN contains({s}, '@') THEN [{s}] ELSE [] END)"
    low = f"list_filter(list_transform({values}, lambda v: lower(v)), lambda v: v <> '' AND v NOT IN {WORDS})"
    return f"(CASE WHEN {x} IS NULL THEN [] ELSE list_filter({low}, lambda v, i: list_position({low}, v) = i) END)"


def contact(x: str) -> str:
    return f"(CASE WHEN contains(coalesce({strip(x)}, ''), '@') THEN {norm_email(strip(x))} ELSE '' END)"


def iso(x: str) -> str:
    s = strip(x)
    day = f"regexp_replace({s}, '[T ]\\d{{1,2}}:\\d{{2}}.*$', '')"
    tries = ", ".join(
        f"CASE WHEN regexp_matches({day}, '{rx}') THEN cast(cast(try_strptime({day}, '{fmt}') AS date) AS varchar) END"
        for fmt, rx in (
            ("%d/%m/%Y", r"^\d{1,2}/\d{1,2}/\d{4}$"),
            ("%d-%m-%Y", r"^\d{1,2}-\d{1,2}-\d{4}$"),
            ("%Y/%m/%d", r"^\d{4}/\d{1,2}/\d{1,2}$"),
            ("%d.%m.%Y", r"^\d{1,2}\.\d{1,2}\.\d{4}$"),
            ("%Y%m%d", r"^\d{8}$"),
        )
    )
    return (
        f"(CASE WHEN regexp_matches({s}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN {s} "
        f"WHEN regexp_matches({day}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') "
        f"THEN coalesce(cast(try_cast({day} AS date) AS varchar), '') ELSE coalesce({tries}, '') END)"
    )


def ident(*parts: str) -> str:
    ok = " AND ".join(f"coalesce({strip(p)}, '') <> ''" for p in parts)
    return f"(CASE WHEN {ok} THEN concat_ws('|', {', '.join(strip(p) for p in parts)}) END)"


def pct(n: str, d: str) -> str:
    return (
        f"(CASE WHEN coalesce({d}, 0) = 0 THEN 0.0 ELSE "
        f"cast((cast({n} AS bigint) * 20000 + cast({d} AS bigint)) // (2 * cast({d} AS bigint)) AS double) / 100.0 END)"
    )


def big(x: str) -> str:
    return f"cast({x} AS bigint)"


def cnt(cond: str) -> str:
    return f"cast(count(CASE WHEN {cond} THEN 1 END) AS bigint)"


def facts_sql(source: str, measures) -> str:
    """UNION ALL of (indicator, nombre, pct, base) rows over a one-row source."""
    out = []
    for name, spec in measures.items():
        col, base = (spec, None) if isinstance(spec, str) else spec
        p = "cast(NULL AS double)" if base is None else pct(col, base)
        b = "cast(NULL AS bigint)" if base is None else big(base)
        out.append(f"SELECT '{name}' AS indicator, {big(col)} AS nombre, {p} AS pct, {b} AS base FROM {source}")
    return " UNION ALL ".join(out)


CTES: dict[str, str] = {name: re.sub(r"\{(\w+)\}", r"\1", text) for name, text in RAW.items()}


def _member(raw: str) -> str:
    return f"""
SELECT {strip('num_personne')} AS person_id, {strip('num_ctr_indiv')} AS contract_id, {strip('type_assure')} AS member_type,
 coalesce({strip('code_soc_appart')}, 'UNK') AS company, coalesce(upper({strip('offre')}), 'INCONNUE') AS offer,
 {norm_text('nom_long')} AS last_name, {norm_text('prenom')} AS first_name, {iso('date_naissance')} AS birth_date,
 {norm_email('mailciam')} AS email, {contact('valeur_coordonnee')} AS contact_email,
 coalesce({strip('idkpep')}, '') AS kpep, {iso('date_adhesion')} AS adhesion_date,
 {iso('date_effet_adhesion')} AS effect_date, {iso('dateradassure')} AS cancel_date, seq, flux_id,
 type_assure IN {INSURED} AS insured, contains(type_assure, 'CONJ') AS spouse
FROM {raw}"""


CTES["member"] = _member("member_raw")
CTES["member_base"] = _member("member_base_raw")
CTES["insured"] = "SELECT * FROM member_base WHERE insured"


def _account(raw: str, source: str, rank: int) -> str:
    last, first, birth = norm_text("last_name"), norm_text("first_name"), iso("birthdate")
    return f"""SELECT coalesce({strip('id')}, '') AS id, realm_id, coalesce({strip('idkpep')}, '') AS idkpep,
 {norm_email('email')} AS email, {norm_email('email_other')} AS email_other, last_name AS raw_last_name,
 first_name AS raw_first_name, middlename, birthdate AS raw_birthdate, phonenumber, {last} AS last_norm,
 {first} AS first_norm, {birth} AS birth_iso, {ident(last, first, birth)} AS identity,
 {ident(last, birth)} AS name_birth, '{source}' AS source, {rank} AS src_rank, cast(seq AS bigint) AS seq FROM {raw}"""


CTES["accounts"] = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY id, realm_id ORDER BY src_rank, seq) AS rn
  FROM ({_account('ck_raw', 'CK', 1)} UNION ALL {_account('cm_raw', 'CM', 2)}) u WHERE id <> '') r WHERE rn = 1"""
CTES["last_acc"] = _account("last_raw", "LAST", 3)
CTES["middle_acc"] = _account("middle_raw", "MIDDLE", 4)
CTES["account_ref"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY src_rank, seq) AS rn FROM accounts) r WHERE rn = 1"""
CTES["email_entries"] = f"""
SELECT 1 AS part, src_rank, seq, id, unnest({emails('email')}) AS email FROM accounts
UNION ALL SELECT 2, src_rank, seq, id, unnest({emails('email_other')}) FROM accounts"""
CTES["cand"] = f"""
SELECT DISTINCT person_id, step, grp, key FROM (
  SELECT person_id, 1 AS step, 'EMAIL' AS grp, unnest({emails('email')}) AS key FROM insured
  UNION ALL SELECT person_id, 2, 'EMAIL', unnest({emails('contact_email')}) FROM insured
  UNION ALL SELECT person_id, 3, 'KPEP', kpep FROM insured WHERE kpep NOT IN ('', 'NULL', 'null')
  UNION ALL SELECT person_id, 4, 'IDENTITY', {ident('last_name', 'first_name', 'birth_date')} FROM insured
  UNION ALL SELECT person_id, 5, 'IDENTITY', {ident('first_name', 'last_name', 'birth_date')} FROM insured
  UNION ALL SELECT person_id, 6, 'LAST', {ident('last_name', 'birth_date')} FROM insured
  UNION ALL SELECT person_id, 7, 'MIDDLE', {ident('last_name', 'birth_date')} FROM insured) c
WHERE key IS NOT NULL AND coalesce(person_id, '') <> ''"""
CTES["acc_index"] = """
SELECT grp, key, id AS account_id FROM (
  SELECT *, row_number() OVER (PARTITION BY grp, key ORDER BY part, src_rank, seq, id) AS rn FROM (
    SELECT 'EMAIL' AS grp, email AS key, part, src_rank, seq, id FROM email_entries
    UNION ALL SELECT 'KPEP', idkpep, 1, src_rank, seq, id FROM accounts WHERE idkpep <> ''
    UNION ALL SELECT 'IDENTITY', identity, 1, src_rank, seq, id FROM accounts WHERE identity IS NOT NULL
    UNION ALL SELECT 'LAST', name_birth, 1, src_rank, seq, id FROM last_acc WHERE name_birth IS NOT NULL
    UNION ALL SELECT 'MIDDLE', name_birth, 1, src_rank, seq, id FROM middle_acc WHERE name_birth IS NOT NULL) e) r
WHERE rn = 1"""
CTES["hits"] = """
SELECT * FROM (
  SELECT person_id, step, key, account_id, row_number() OVER (PARTITION BY person_id ORDER BY step, key) AS rn
  FROM cand JOIN acc_index USING (grp, key)) h WHERE rn = 1"""
CTES["match"] = """
SELECT p.person_id, CASE WHEN h.step IS NULL THEN 'NON_RAPPROCHE' ELSE 'RAPPROCHE' END AS match_status,
  CASE h.step WHEN 1 THEN 'Mail_CIAM' WHEN 2 THEN 'Valeur_Coord' WHEN 3 THEN 'KPEP' WHEN 4 THEN 'Nom_Prenom_DDN'
    WHEN 5 THEN 'Identite_Inversee' WHEN 6 THEN 'Recherche_Large_Nom' WHEN 7 THEN 'Recherche_Large_Middle' ELSE '' END AS match_method,
  h.account_id AS matched_id, h.key AS matched_key
FROM (SELECT DISTINCT person_id FROM insured WHERE coalesce(person_id, '') <> '') p LEFT JOIN hits h USING (person_id)"""
# Matched persons with the attributes of their account.
CTES["matched"] = """
SELECT m.person_id, m.match_method, m.matched_id, r.* EXCLUDE (id)
FROM match m LEFT JOIN account_ref r ON r.id = m.matched_id WHERE m.match_status = 'RAPPROCHE'"""
CTES["person_kpeps"] = "SELECT DISTINCT person_id, kpep FROM insured WHERE kpep NOT IN ('', 'NULL', 'null')"
CTES["registry"] = f"""
SELECT DISTINCT r.refperboccn, r.idrpp, r.socappr, r.adrmailctc, r.telmbictc, r.seq, k.kpep_iehe
FROM registry_raw r LEFT JOIN (SELECT idrpp, min(refperboccn) AS kpep_iehe FROM registry_raw
  WHERE refperboccn LIKE 'KPEP%' GROUP BY idrpp) k USING (idrpp)
WHERE r.idrpp IS NOT NULL AND r.refperboccn IN (SELECT person_id FROM member_base)"""
CTES["registry_first"] = """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY refperboccn ORDER BY seq) AS rn FROM registry) r
WHERE rn = 1"""

CTES["user_events"] = """
SELECT event_id, concat('U', cast(user_id AS varchar)) AS user_id, CASE event_type WHEN 'click' THEN 'LOGIN' WHEN 'purchase'
  THEN 'UPDATE_PROFILE' ELSE upper(event_type) END AS type, concat('app-', event_type) AS client_id,
  cast(epoch_us(ts) // 1000 AS bigint) AS event_time FROM events"""
EVENT_DAYS = "BETWEEN DATE '2000-03-01' AND DATE '2024-12-31'"


def ms_day(x: str) -> str:
    return f"cast(to_timestamp({x} // 1000) AT TIME ZONE 'UTC' AS date)"


CTES["activity"] = f"""
SELECT id, email, first_name, last_name, stamp, type, client, cast({ms_day('stamp')} AS varchar) AS date_evt,
  strftime(to_timestamp(stamp // 1000) AT TIME ZONE 'UTC', '%H:%M:%S') AS heure_evt FROM (
  SELECT u.id, u.email, u.first_name, u.last_name,
    CASE WHEN e.event_time >= u.created_timestamp THEN e.event_time ELSE u.created_timestamp END AS stamp,
    CASE WHEN e.event_time >= u.created_timestamp THEN e.type ELSE 'CREATION' END AS type,
    CASE WHEN e.event_time >= u.created_timestamp THEN e.client_id END AS client
  FROM user_entity u LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_time DESC, event_id DESC) AS rn
    FROM user_events WHERE type IN ('LOGIN', 'UPDATE_PROFILE') AND {ms_day('event_time')} {EVENT_DAYS}) e
  ON e.user_id = u.id AND e.rn = 1
  WHERE u.realm_id <> 'master' AND (coalesce(e.event_time >= u.created_timestamp, false) OR {ms_day('u.created_timestamp')} {EVENT_DAYS})) a"""


def day(x: str) -> str:
    return f"try_cast({strip(x)} AS date)"


DELTA = f"date_diff('day', {day('adhesion_date')}, {day('effect_date')})"
CARD_EXCLUDED = "(starts_with(offer, 'MEP') OR starts_with(offer, 'IND') OR offer = 'INPPREVIND' OR company = '073')"
CARD_STATUS = (
    f"CASE WHEN NOT coalesce(insured, false) OR {CARD_EXCLUDED} THEN 'HORS_PERIMETRE_TP' "
    f"WHEN {DELTA} <= 21 THEN 'ELIGIBLE_TP' ELSE 'FUTURE_TP' END"
)
CTES["card"] = f"SELECT *, {CARD_STATUS} AS status, {DELTA} AS delta FROM member"
CTES["person_card"] = """
SELECT person_id, status, company, offer, member_type, effect_date FROM (
  SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY CASE status WHEN 'ELIGIBLE_TP' THEN 0 ELSE 1 END, seq) AS rn
  FROM card WHERE status <> 'HORS_PERIMETRE_TP' AND coalesce(person_id, '') <> '') p WHERE rn = 1"""
DOC_REASON = (
    "CASE WHEN contains(upper(member_type), 'CONJ') THEN 'Conjoint' "
    f"WHEN upper(member_type) NOT IN {INSURED} THEN concat('Type assuré non éligible (', upper(member_type), ')') "
    "WHEN starts_with(offer, 'INP') OR starts_with(offer, 'MEP') THEN 'Offre exclue (INP*/MEP*)' "
    "WHEN company = '073' THEN 'Société exclue (073)' ELSE '' END"
)

_ATTRS = ("member_type", "offer", "company", "adhesion_date", "effect_date")
CTES["history"] = """
SELECT person_id, flux_id, member_type, offer, company, adhesion_date, effect_date FROM (
  SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY strptime(flux_id, '%d%m%Y') DESC, seq) AS rn
  FROM member WHERE flux_id <> '31122001' AND coalesce(person_id, '') <> '') h WHERE rn = 1"""
CTES["same_run"] = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY flux_id, person_id ORDER BY seq) AS rn FROM member) h WHERE rn = 1"""
CTES["ko_filled"] = f"""
SELECT l.source_file, l.person_id, l.eligible, l.card_value, l.statut_retry, l.date_derniere_verif, l.mail_iehe, l.kpep_iehe, l.seq,
 coalesce(l.member_type, '') <> '' AS typed, {', '.join(
    f"coalesce(nullif(trim(l.{c}), ''), nullif(s.{c}, ''), nullif(n.{c}, ''), nullif(h.{c}, ''), '') AS {c}" for c in _ATTRS)}
FROM ko_ledger l LEFT JOIN same_run s ON s.flux_id = substr(l.source_file, 1, 8) AND s.person_id = l.person_id
LEFT JOIN same_run n ON n.flux_id = '31122001' AND n.person_id = l.person_id
LEFT JOIN history h ON h.person_id = l.person_id"""
CTES["ko_labelled"] = f"""
SELECT * EXCLUDE (typed, member_type), CASE WHEN member_type = '' THEN 'INCONNU' ELSE member_type END AS member_type,
 CASE WHEN typed AND eligible = 'N' THEN 'Hors_Perimetre_TP' WHEN typed AND eligible = 'O' AND card_value = 'Futur' THEN 'Future_TP'
   WHEN typed AND eligible = 'O' THEN CASE WHEN {DELTA} <= 21 THEN 'Eligible_TP' ELSE 'Future_TP' END
   WHEN member_type NOT IN {INSURED} OR {CARD_EXCLUDED} THEN 'Hors_Perimetre_TP'
   WHEN {DELTA} <= 21 THEN 'Eligible_TP' ELSE 'Future_TP' END AS label FROM ko_filled"""

_WORD = re.compile(r"(?i)\b(?:FROM|JOIN)\s+([a-z_0-9]+)")


def _needed(text: str, seen: list[str]) -> None:
    for word in _WORD.findall(text):
        if word in CTES and word not in seen:
            _needed(CTES[word], seen)
            if word not in seen:
                seen.append(word)


def oracle(body: str, **local: str) -> str:
    """``WITH`` clause for everything ``body`` refers to, then ``body``."""
    order: list[str] = []
    for text in local.values():
        _needed(text, order)
    _needed(body, order)
    parts = [f"{name} AS ({CTES[name]})" for name in order if name not in local]
    parts += [f"{name} AS ({text})" for name, text in local.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
