"""Domain frames derived from the given tables.

The given tables hold no membership data, so each raw frame of the domain
(snapshot, directory extracts, registry, documents, claims, ...) is derived
from them with one SELECT over the whole tables.  The text is plain SQL that
Spark and the SQL oracle read alike; ``{name}`` stands for another frame or
table.  Which people are missing where is decided by account balances, market
segments, order states and the like, never by a filter on ids.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

RAW: dict[str, str] = {}

# One row per customer: the civil identity every other frame is derived from.
RAW["persona"] = """
SELECT c_custkey AS k,
  c_acctbal AS bal,
  c_mktsegment AS seg,
  c_nationkey AS nat,
  CASE WHEN c_nationkey = 7 THEN '073' ELSE lpad(cast(c_nationkey AS string), 3, '0') END AS company,
  CASE WHEN c_acctbal < -950 THEN NULL ELSE concat('Clémence ', substr(c_name, 10)) END AS last_name,
  concat('Zoé ', n_name) AS first_name,
  CASE WHEN c_acctbal < -800 OR c_acctbal > 9800 THEN '1900-01-01'
       ELSE concat(cast(1940 + c_nationkey * 2 AS string), '-', lpad(cast(c_custkey % 12 + 1 AS string), 2, '0'),
                   '-', lpad(cast(c_custkey % 28 + 1 AS string), 2, '0')) END AS birth,
  concat('client', cast(c_custkey AS string), '@',
         CASE WHEN c_nationkey = 3 THEN 'yopmail.com' WHEN c_nationkey = 4 THEN 'gmx.fr'
              WHEN c_nationkey = 9 THEN 'invalide'
              ELSE concat('mail', cast(c_nationkey AS string), '.example.org') END) AS mail,
  concat('KPEP', lpad(cast(c_custkey AS string), 12, '0')) AS kpep
FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey
"""

# First shipping day of an order, the stand-in for the effect date of a contract.
RAW["first_ship"] = """
SELECT l_orderkey AS ship_order, cast(min(l_shipdate) AS date) AS ship_day FROM {lineitem} GROUP BY l_orderkey
"""

_MEMBER_COLUMNS = """
  cast(o_custkey AS string) AS num_personne,
  cast(o_orderkey AS string) AS num_ctr_indiv,
  CASE WHEN o_orderpriority = '5-LOW' AND (o_orderstatus = 'P' OR seg = 'FURNITURE') THEN 'CONJOI'
       WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN 'ENFANT'
       WHEN seg = 'AUTOMOBILE' THEN 'MPACTI' WHEN seg = 'MACHINERY' THEN 'MPRETR'
       WHEN seg = 'HOUSEHOLD' THEN 'MPVRET' ELSE 'ASSPRI' END AS type_assure,
  company AS code_soc_appart,
  CASE WHEN o_orderpriority = '1-URGENT' THEN
            CASE o_orderstatus WHEN 'F' THEN 'MESMEN001' WHEN 'O' THEN 'MESMEN2003' ELSE 'mesmen3001 ' END
       WHEN o_orderpriority = '2-HIGH' THEN CASE WHEN o_orderstatus = 'F' THEN 'INSMAS001' ELSE 'MESMEAE202' END
       WHEN o_orderpriority = '3-MEDIUM' THEN CASE WHEN o_orderstatus = 'F' THEN 'MEPMAS001' ELSE 'MESLAD46' END
       WHEN o_orderpriority = '4-NOT SPECIFIED' THEN
            CASE WHEN o_orderstatus = 'O' THEN 'INPPREVIND' ELSE 'INPCULT002' END
       WHEN o_orderstatus = 'O' THEN NULL ELSE 'INDSANTE1' END AS offre,
  last_name AS nom_long,
  first_name AS prenom,
  CASE WHEN seg = 'MACHINERY' THEN concat(substr(birth, 9, 2), '/', substr(birth, 6, 2), '/', substr(birth, 1, 4))
       ELSE birth END AS date_naissance,
  CASE WHEN o_orderstatus = 'F' AND bal >= -500 THEN mail
       WHEN o_orderstatus = 'O' AND bal > 5000 THEN 'NULL' END AS mailciam,
  CASE WHEN o_orderstatus = 'O' AND bal >= 0 THEN concat(' ', upper(mail))
       WHEN o_orderstatus = 'P' THEN '06 12 34 56 78'
       WHEN bal < 2000 AND bal >= 0 THEN concat('alt', cast(k AS string), '@alt.example.org; copie', cast(k AS string), '@alt.example.org')
       WHEN bal > 9000 THEN 'none' END AS valeur_coordonnee,
  CASE WHEN bal < -950 THEN NULL
       WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN kpep
       WHEN o_orderpriority = '3-MEDIUM' THEN 'NULL'
       WHEN o_orderpriority = '4-NOT SPECIFIED' AND bal < 1500 THEN concat(kpep, 'B')
       WHEN o_orderpriority = '5-LOW' AND bal < 700 THEN concat(kpep, substr(o_orderstatus, 1, 1)) END AS idkpep,
  cast(cast(o_orderdate AS date) AS string) AS date_adhesion,
  {effect} AS date_effet_adhesion,
  CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH'
       THEN cast(cast(cast(o_orderdate AS date) + interval '365' day AS date) AS string) END AS dateradassure,
  o_orderkey AS seq,
  concat('3112', cast(year(o_orderdate) AS string)) AS flux_id
"""
_EFFECT = (
    "substr(cast(ship_day AS string), 9, 2) || '/' || substr(cast(ship_day AS string), 6, 2) || '/' || "
    "substr(cast(ship_day AS string), 1, 4)"
)
# Daily snapshot: one row per contract.
RAW["member_raw"] = (
    "SELECT "
    + _MEMBER_COLUMNS.replace("{effect}", _EFFECT)
    + " FROM {orders} JOIN {persona} ON k = o_custkey LEFT JOIN {first_ship} ON ship_order = o_orderkey"
)
# The same snapshot without the effect date, for operators that never read it.
RAW["member_base_raw"] = (
    "SELECT "
    + _MEMBER_COLUMNS.replace("{effect}", "cast(NULL AS string)")
    + " FROM {orders} JOIN {persona} ON k = o_custkey"
)

_CK = """
  concat('A', cast(k AS string)) AS id,
  {realm} AS realm_id,
  CASE WHEN seg IN ('AUTOMOBILE', 'MACHINERY') AND bal >= 8000 THEN ''
       WHEN seg = 'HOUSEHOLD' AND bal < 7000 THEN concat('X', cast(k AS string))
       WHEN nat = 11 THEN concat(kpep, 'Z') ELSE concat(' ', kpep) END AS idkpep,
  CASE WHEN seg = 'BUILDING' THEN NULL
       WHEN seg IN ('AUTOMOBILE', 'MACHINERY') AND bal >= 8000 THEN 'NULL' ELSE upper(mail) END AS email,
  CASE WHEN bal >= 9000 THEN concat('famille', cast(nat AS string), '@partage.example.org')
       WHEN bal < 3500 THEN concat(' Alt', cast(k AS string), '@alt.example.org, autre', cast(k AS string), '@alt.example.org')
       END AS email_other,
  CASE WHEN seg = 'MACHINERY' AND bal >= 8000 THEN last_name ELSE first_name END AS first_name,
  CASE WHEN seg = 'MACHINERY' AND bal >= 8000 THEN first_name
       WHEN nat = 12 THEN 'Bernadette' ELSE last_name END AS last_name,
  '' AS middlename,
  CASE WHEN nat = 13 THEN '05/05/1970'
       WHEN seg = 'FURNITURE' THEN concat(substr(birth, 9, 2), '/', substr(birth, 6, 2), '/', substr(birth, 1, 4))
       ELSE birth END AS birthdate,
  '0102030405' AS phonenumber,
  {seq} AS seq
"""
# Directory extract found by key; the richest people exist in two realms.
RAW["ck_raw"] = (
    "SELECT " + _CK.replace("{realm}", "company").replace("{seq}", "k")
    + " FROM {persona} WHERE bal >= 3000 UNION ALL SELECT "
    + _CK.replace("{realm}", "'R2'").replace("{seq}", "k + 1000000000000")
    + " FROM {persona} WHERE bal >= 9500"
)
# Directory extract found by e-mail; overlaps the first one.
RAW["cm_raw"] = """
SELECT concat('A', cast(k AS string)) AS id, company AS realm_id,
  CASE WHEN bal < 1500 THEN NULL ELSE kpep END AS idkpep,
  CASE WHEN bal < 300 THEN NULL ELSE mail END AS email,
  CASE WHEN bal < 900 THEN concat('alt', cast(k AS string), '@alt.example.org') END AS email_other,
  first_name, last_name, 'Zoé' AS middlename,
  CASE WHEN nat = 13 THEN '1971-06-07' ELSE birth END AS birthdate,
  '0102030406' AS phonenumber, k AS seq
FROM {persona} WHERE bal >= 0 AND bal < 6000
"""
RAW["last_raw"] = """
SELECT concat('L', cast(k AS string)) AS id, company AS realm_id, '' AS idkpep, '' AS email,
  '' AS email_other, first_name, lower(last_name) AS last_name, '' AS middlename, birth AS birthdate,
  '' AS phonenumber, k AS seq
FROM {persona} WHERE bal < 0 AND bal >= -500
"""
RAW["middle_raw"] = """
SELECT concat('M', cast(k AS string)) AS id, company AS realm_id, 'NULL' AS idkpep, mail AS email,
  '' AS email_other, first_name, last_name, first_name AS middlename, birth AS birthdate,
  '' AS phonenumber, k AS seq
FROM {persona} WHERE bal < -500 AND bal >= -850
"""

# Person-key registry: person rows, key rows and second rows of the same person.
RAW["registry_raw"] = """
SELECT cast(k AS string) AS refperboccn, concat('G', cast(k AS string)) AS idrpp,
  CASE WHEN nat = 5 THEN '' WHEN nat = 6 THEN '099' ELSE company END AS socappr,
  CASE WHEN seg = 'BUILDING' AND bal < 6000 THEN NULL
       WHEN seg = 'HOUSEHOLD' THEN concat('autre', cast(k AS string), '@ailleurs.example.org')
       WHEN nat = 9 THEN 'pas un mail' ELSE mail END AS adrmailctc,
  '0102030405' AS telmbictc, k AS seq
FROM {persona} WHERE bal >= -700
UNION ALL
SELECT kpep, concat('G', cast(k AS string)), company, NULL, NULL, k + 1000000000000
FROM {persona} WHERE bal >= 500
UNION ALL
SELECT cast(k AS string), concat('G', cast(k AS string)), CASE WHEN bal < 7000 THEN '088' ELSE '' END, mail, NULL,
  k + 2000000000000
FROM {persona} WHERE bal >= 5000
UNION ALL
SELECT concat(kpep, 'Z'), concat('G', cast(k AS string)), '088', NULL, NULL, k + 3000000000000
FROM {persona} WHERE nat = 11 OR bal >= 9900
"""

# Keys found in the document store, as raw text.
RAW["document_keys"] = """
SELECT concat(' ', lower(kpep)) AS idepsp FROM {persona} WHERE bal >= 2500 AND seg <> 'HOUSEHOLD'
UNION ALL
SELECT kpep FROM {persona} WHERE bal >= 9000
"""
# Manual corrections; an empty company or offer is a wildcard.
RAW["corrections"] = """
SELECT kpep AS kpep_ref, company AS code_societe, 'MESMEN001' AS offre, 'FORCE_RAPPROCHE' AS decision_manuelle,
  'exact' AS commentaire, k AS seq FROM {persona} WHERE bal >= 500 AND bal < 1500
UNION ALL
SELECT kpep, company, '', 'force_non_rapproche', 'societe', k + 1000000000000 FROM {persona} WHERE bal >= 1000 AND bal < 3000
UNION ALL
SELECT lower(kpep), '', '', 'FORCE_RAPPROCHE', '', k + 2000000000000 FROM {persona} WHERE bal >= 2000 AND bal < 2600
UNION ALL
SELECT kpep, '', '', 'INCONNU', 'ignoree', k + 3000000000000 FROM {persona} WHERE bal >= 2500 AND bal < 2700
UNION ALL
SELECT kpep, '', '', 'FORCE_NON_RAPPROCHE', 'derniere', k + 4000000000000 FROM {persona} WHERE bal >= 2400 AND bal < 2500
"""

# Retry ledger: one row per person of an earlier run; attributes partly missing.
RAW["ko_ledger"] = """
SELECT concat('3112', CASE seg WHEN 'BUILDING' THEN '1996' WHEN 'AUTOMOBILE' THEN '1997' WHEN 'MACHINERY' THEN '1998'
         WHEN 'HOUSEHOLD' THEN '1999' ELSE '2000' END, '_IEHE_KO.csv') AS source_file,
  cast(k AS string) AS person_id,
  CASE WHEN bal < 3000 THEN NULL WHEN nat < 5 THEN 'CONJOI' ELSE 'ASSPRI' END AS member_type,
  CASE WHEN bal < 3500 THEN '' WHEN nat = 20 THEN 'MEPMAS001' ELSE 'MESMEN001' END AS offer,
  CASE WHEN bal < 4000 THEN NULL ELSE company END AS company,
  CASE WHEN bal < 4500 THEN NULL ELSE concat('2000-01-', lpad(cast(nat + 1 AS string), 2, '0')) END AS adhesion_date,
  CASE WHEN bal < 4800 THEN NULL ELSE concat('2000-02-', lpad(cast(k % 28 + 1 AS string), 2, '0')) END AS effect_date,
  CASE WHEN nat < 5 THEN 'N' WHEN nat < 20 THEN 'O' ELSE '' END AS eligible,
  CASE WHEN bal > 8000 THEN 'Futur' ELSE '' END AS card_value,
  CASE WHEN bal > 9000 THEN 'OK' WHEN bal > 8800 THEN ' ok' ELSE 'KO' END AS statut_retry,
  CASE WHEN bal > 9000 THEN '2001-02-01' WHEN bal > 0 THEN '2001-01-15' END AS date_derniere_verif,
  CASE WHEN bal > 9000 THEN mail ELSE '' END AS mail_iehe,
  CASE WHEN bal > 9000 THEN kpep ELSE '' END AS kpep_iehe,
  k AS seq
FROM {persona}
"""

# Claims: one row per operation on a dossier.
_ORIGIN = """CASE o_orderpriority
    WHEN '1-URGENT' THEN CASE o_orderstatus WHEN 'F' THEN 'NMASS' WHEN 'O' THEN 'LUMAS' ELSE 'OXA' END
    WHEN '2-HIGH' THEN CASE o_orderstatus WHEN 'F' THEN 'TPVIA' WHEN 'O' THEN 'TPHOS' ELSE 'TPCVM' END
    WHEN '3-MEDIUM' THEN CASE o_orderstatus WHEN 'F' THEN 'ASSUR' WHEN 'O' THEN 'SELFC' ELSE 'TIERS' END
    WHEN '4-NOT SPECIFIED' THEN CASE o_orderstatus WHEN 'F' THEN 'REGUL' WHEN 'O' THEN 'DRASS' ELSE 'NMFOU' END
    ELSE CASE o_orderstatus WHEN 'F' THEN 'NMCMU' WHEN 'O' THEN 'PAPIE' ELSE 'PORTA' END END"""
RAW["claim_ops"] = f"""
SELECT l_orderkey AS dossier_id, l_linenumber AS op_no,
  concat(cast(cast(l_shipdate AS date) AS string), '|', lpad(cast(l_partkey AS string), 12, '0'), '|',
    lpad(cast(l_suppkey AS string), 12, '0'), '|', lpad(cast(cast(l_extendedprice AS decimal(14, 2)) AS string), 17, '0')) AS op_ref,
  cast(l_shipdate AS date) AS op_date, cast(o_orderdate AS date) AS created,
  CASE l_returnflag WHEN 'R' THEN 'RJ' WHEN 'A' THEN CASE l_linestatus WHEN 'O' THEN 'PA' ELSE 'RL' END
       ELSE CASE l_linestatus WHEN 'O' THEN 'AC' ELSE 'VA' END END AS state,
  {_ORIGIN} AS origin,
  concat(CASE WHEN l_linenumber <= 2 THEN 'DSI' WHEN l_linenumber <= 4 THEN 'GES' WHEN l_linenumber <= 6 THEN 'VDC' ELSE 'AUT' END,
         lpad(cast(l_suppkey AS string), 6, '0')) AS box,
  concat('CR', cast(l_linenumber AS string), l_linestatus) AS reject_code,
  cast(l_extendedprice AS decimal(14, 2)) AS amount,
  CASE WHEN l_tax < 0.02 THEN NULL ELSE concat('OFF', substr(o_orderpriority, 1, 1)) END AS offer,
  o_custkey AS person_no
FROM {{lineitem}} JOIN {{orders}} ON o_orderkey = l_orderkey
"""
# Patterns of boxes, as many as there are customers: exact, by beginning, by end, inside, with gaps.
RAW["box_patterns"] = """
SELECT CASE WHEN bal < 0 THEN concat('%', lpad(cast(k AS string), 6, '0')) WHEN bal < 3000 THEN concat(' DSI', lpad(cast(k AS string), 6, '0'))
  WHEN bal < 3200 THEN concat('G_S%', cast(nat AS string)) WHEN bal < 5000 THEN concat('%', cast(k AS string), 'x%')
  WHEN bal < 5200 THEN concat('%', lpad(cast(k AS string), 5, '0'), '%') ELSE concat('VDC', lpad(cast(k AS string), 5, '0'), '%') END AS pattern
FROM {persona}
"""
# Claims received: one row per dossier.
RAW["claim_heads"] = f"""
SELECT o_orderkey AS dossier_id, cast(o_orderdate AS date) AS received, {_ORIGIN} AS origin,
  o_custkey AS person_no, o_orderstatus AS state FROM {{orders}}
"""

# Directory tables: users with their creation time, and their attributes.
RAW["user_entity"] = """
SELECT concat('U', cast(k AS string)) AS id, CASE WHEN nat < 2 THEN concat('foyer', cast(k % 50 AS string), '@commun.example.org') ELSE mail END AS email,
  first_name, last_name,
  cast(1704067200000 AS bigint) + (k % 30) * 86400000 + (k % 86400) * 1000
    + CASE WHEN bal > 9000 THEN cast(315360000000 AS bigint) ELSE cast(0 AS bigint) END AS created_timestamp,
  CASE WHEN bal < -900 THEN 'master' ELSE company END AS realm_id, k AS seq
FROM {persona}
"""
RAW["user_attribute"] = """
SELECT concat('U', cast(k AS string)) AS user_id, 'societe-codeGestionnaire' AS name, company AS value FROM {persona}
UNION ALL SELECT concat('U', cast(k AS string)), 'kpepId', kpep FROM {persona} WHERE bal > 2000
UNION ALL SELECT concat('U', cast(k AS string)), 'birthDate', birth FROM {persona} WHERE seg <> 'BUILDING'
UNION ALL SELECT concat('U', cast(k AS string)), 'email_other', concat('alt', cast(k AS string), '@alt.example.org') FROM {persona} WHERE bal < 1000
UNION ALL SELECT concat('U', cast(k AS string)), 'phoneNumber', '0102030405' FROM {persona} WHERE nat > 10
UNION ALL SELECT concat('U', cast(k AS string)), 'locale', 'fr' FROM {persona}
"""

# Portfolio blocks: counts per offer, company and type or age band; terminations.
RAW["block_type"] = """
SELECT coalesce(upper(trim(offre)), 'OFFSUP') AS offer,
  CASE WHEN substr(code_soc_appart, 1, 1) = '0' THEN substr(code_soc_appart, 2) ELSE code_soc_appart END AS company,
  CASE WHEN type_assure = 'CONJOI' THEN 'CONJOINT' WHEN type_assure = 'ENFANT' THEN 'ENFANT' ELSE 'Assure' END AS member_type,
  count(CASE WHEN dateradassure IS NULL THEN 1 END) AS current, count(*) AS base
FROM {member_base_raw} GROUP BY 1, 2, 3
"""
RAW["block_age"] = """
SELECT CASE WHEN substr(company, 1, 1) = '0' THEN substr(company, 2) ELSE company END AS company,
  CASE WHEN birth < '1950' THEN '70+' WHEN birth < '1965' THEN '55-69' WHEN birth < '1980' THEN '40-54' ELSE '0-39' END AS age_band,
  count(CASE WHEN o_orderstatus <> 'P' THEN 1 END) AS current, count(*) AS base
FROM {orders} JOIN {persona} ON k = o_custkey GROUP BY 1, 2
"""
RAW["block_term"] = """
SELECT company, CASE WHEN o_orderpriority = '1-URGENT' THEN 'DECES' WHEN o_orderpriority = '2-HIGH' THEN ' DEM'
    WHEN o_orderpriority = '3-MEDIUM' THEN CASE WHEN seg = 'BUILDING' THEN NULL ELSE '' END
    WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'CODEINCONNU' ELSE CASE WHEN nat < 10 THEN 'COT+' ELSE 'IMP' END END AS reason,
  count(*) AS n
FROM {orders} JOIN {persona} ON k = o_custkey WHERE o_orderstatus = 'P' GROUP BY 1, 2
"""
# Persons holding several contracts of one kind.
RAW["block_multi"] = """
SELECT coalesce(last_name, '') AS last_name, first_name, cast(k AS string) AS insee, birth AS birth_date,
  CASE WHEN substr(company, 1, 1) = '0' THEN substr(company, 2) ELSE company END AS company,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'sante' WHEN o_orderpriority = '3-MEDIUM' THEN ' PREV' ELSE 'EPARGNE' END AS kind,
  count(*) AS n
FROM {orders} JOIN {persona} ON k = o_custkey GROUP BY 1, 2, 3, 4, 5, 6 HAVING count(*) > 1
"""
# Benefit volumes per day, offer, origin and state.
RAW["benefit_rows"] = """
SELECT replace(date_adhesion, '-', '') AS date_arrivee, coalesce(upper(trim(offre)), '__SANS_OFFRE__') AS offer,
  c.origin, CASE c.state WHEN 'F' THEN 'PA' WHEN 'O' THEN 'AC' ELSE 'RJ' END AS state, count(*) AS nb
FROM {member_base_raw} JOIN {claim_heads} c ON cast(c.dossier_id AS string) = num_ctr_indiv GROUP BY 1, 2, 3, 4
"""
# Support tickets and their history sheet.
RAW["tickets"] = """
SELECT o_orderkey AS ticket_id, cast(cast(o_orderdate AS date) AS string) AS opened, cast(ship_day AS string) AS closed,
  CASE WHEN o_orderstatus = 'P' AND seg = 'BUILDING' THEN 'n/a' ELSE substr(o_orderpriority, 1, 1) END AS priority,
  CASE WHEN o_totalprice > 400000 THEN '12:30:00' WHEN o_totalprice > 300000 THEN ' 00:00:00' WHEN o_totalprice > 200000 THEN '' END AS late_time,
  CASE o_orderstatus WHEN 'F' THEN 'Clos' WHEN 'O' THEN 'Ouvert' END AS state,
  seg AS theme, company AS region, split_part(mail, '@', 2) AS brand, last_name AS solver
FROM {orders} JOIN {persona} ON k = o_custkey LEFT JOIN {first_ship} ON ship_order = o_orderkey
"""
RAW["ticket_history"] = """
SELECT o_orderkey AS ticket_id,
  CASE WHEN o_orderstatus = 'P' THEN 'inconnu' WHEN seg = 'BUILDING' THEN '-3' ELSE cast(cast(floor(o_totalprice / 20000) AS bigint) AS string) END AS duration,
  CASE WHEN o_orderstatus = 'F' THEN cast(34700 + o_orderkey % 2400 AS string) ELSE cast(cast(o_orderdate AS date) AS string) END AS opened,
  CASE WHEN o_orderstatus = 'F' THEN cast(34710 + o_orderkey % 2400 AS string) WHEN o_orderstatus = 'O' THEN 'en cours' END AS closed,
  substr(o_orderpriority, 1, 1) AS priority, CASE o_orderstatus WHEN 'F' THEN 'Clos' WHEN 'O' THEN 'Ouvert' END AS state,
  seg AS theme, company AS subject
FROM {orders} JOIN {persona} ON k = o_custkey
"""

# Runs: one per month of orders, with the counts their indicators are made of.
RAW["run_counts"] = """
SELECT concat('01', substr(m, 6, 2), substr(m, 1, 4)) AS flux_id, cast(max(d) AS string) AS last_day, count(*) AS n,
  count(DISTINCT o_custkey) AS persons, count(DISTINCT CASE WHEN o_orderstatus <> 'P' THEN o_custkey END) AS target,
  count(CASE WHEN o_totalprice > 485000 THEN 1 END) AS lost, count(CASE WHEN o_totalprice < 12000 THEN 1 END) AS bad,
  count(CASE WHEN o_totalprice > 250000 AND o_totalprice < 252000 THEN 1 END) AS missing,
  count(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 END) AS eligible,
  count(CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' AND o_totalprice > 150000 THEN 1 END) AS found
FROM (SELECT *, cast(o_orderdate AS date) AS d, substr(cast(cast(o_orderdate AS date) AS string), 1, 7) AS m FROM {orders}) t GROUP BY m
"""
# Free text of support tickets: labelled personal data of a customer.
RAW["descriptions"] = """
SELECT k AS doc_id, concat('NomDURAND Prénom', substr('Jean-Pierre', 1, 4), ' ', kpep, ' Adresse ', mail, ' tel 06 12 34 56 78 ou +33 6.12.34.56.78 nir 1 85 05 78 006 084 36 fin') AS text
FROM {persona}
"""
# Call notes: the names of a person in running text, in capitals or not.
RAW["notes"] = """
SELECT k AS doc_id, concat('Appel de ', upper(coalesce(last_name, '?')), ' pour ', CASE WHEN bal > 5000 THEN first_name ELSE upper(first_name) END,
  ', dossier ', kpep, CASE WHEN bal < 0 THEN concat(' (', coalesce(last_name, ''), ')') ELSE '.' END) AS text FROM {persona}
"""

# Tracking table of an earlier day, and snapshots of keys that arrive later.
RAW["tracking_old"] = """
SELECT '31122000' AS flux_id, upper(kpep) AS kpep, CASE WHEN bal > 5000 THEN DATE '2001-01-05' END AS date_found,
  CASE WHEN nat = 3 THEN 'ancien' END AS motif FROM {persona} WHERE bal > 3000
UNION ALL SELECT '01022000', upper(kpep), CASE WHEN bal > 8000 THEN DATE '2000-02-05' END, NULL FROM {persona} WHERE bal > 1000
"""
RAW["arrivals"] = """
SELECT '01022000' AS flux_id, 'ELIGIBLE' AS kind, kpep, CASE WHEN nat = 3 THEN 'non rapproché iehe' END AS motif FROM {persona} WHERE bal > 0
UNION ALL SELECT '01022000', 'FOUND', kpep, NULL FROM {persona} WHERE bal > 6000
UNION ALL SELECT '31012000', 'ELIGIBLE', kpep, NULL FROM {persona} WHERE bal > 5000
UNION ALL SELECT '15032000', 'ELIGIBLE', kpep, CASE WHEN nat = 4 THEN 'non rapproché iehe' END FROM {persona} WHERE bal > 2000
UNION ALL SELECT '15032000', 'FOUND', concat(' ', kpep), NULL FROM {persona} WHERE bal > 3000 AND bal < 7000
"""

_NAME = re.compile(r"\{(\w+)\}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw(spark: SparkSession, sf_dir: str, name: str, plans: dict[str, DataFrame]) -> DataFrame:
    """One derived frame (or given table); ``plans`` keeps the plans already built."""
    if name not in plans:
        if name in TABLES:
            plans[name] = table(spark, sf_dir, name)
        else:
            text = RAW[name]
            parts = {part: raw(spark, sf_dir, part, plans) for part in sorted(set(_NAME.findall(text)))}
            plans[name] = spark.sql(text, **parts)
            if name == "persona":
                # A few bytes a customer in the file become several wide rows: a split is too many for one task.
                plans[name] = plans[name].repartition("k")
    return plans[name]
