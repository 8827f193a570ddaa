"""Scalar functions, projections and row rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from concordat import functions as fx
from concordat.operators import activity as av
from concordat.operators import card as cd
from concordat.operators import documents as dc
from concordat.operators import normalize as nz
from concordat.operators import quality as ql
from concordat.workload import canon
from concordat.workload import oracle as q
from concordat.workload.oracle import oracle
from concordat.workload.registry import query

# ---- text ------------------------------------------------------------------


@query("normalize_text", f"SELECT doc_id, {q.norm_text('text')} AS norm FROM documents")
def normalize_text(f):
    return f.documents.select("doc_id", fx.normalize_text(F.col("text")).alias("norm"))


@query(
    "normalize_email",
    oracle(f"SELECT num_ctr_indiv, {q.norm_email('mailciam')} AS email, "
           f"{q.norm_email('valeur_coordonnee')} AS contact FROM member_base_raw"),
)
def normalize_email(f):
    return f.member_base_raw.select(
        "num_ctr_indiv",
        fx.normalize_email(F.col("mailciam")).alias("email"),
        fx.normalize_email(F.col("valeur_coordonnee")).alias("contact"),
    )


@query(
    "extract_emails",
    "SELECT doc_id, cast(i AS integer) AS pos, e[i] AS email FROM (SELECT doc_id, e, unnest(range(1, len(e) + 1)) AS i "
    f"FROM (SELECT doc_id, {q.emails('text')} AS e FROM documents) a) b",
)
def extract_emails(f):
    return f.documents.select(
        "doc_id", F.posexplode(fx.extract_emails(F.col("text"))).alias("pos", "email")
    ).select("doc_id", (F.col("pos") + 1).alias("pos"), "email")


_TOKENS = (
    "SELECT doc_id, unnest(regexp_split_to_array(text, '[ \\n\\t]+')) AS token FROM documents"
)


@query(
    "valid_email",
    f"SELECT token, cast(regexp_matches(token, '{q.EMAIL_ANCHORED}') AS integer) AS valid, count(*) AS n "
    f"FROM ({_TOKENS}) t WHERE contains(token, '@') GROUP BY 1, 2",
)
def valid_email(f):
    tokens = f.documents.select(F.explode(F.split("text", "[ \n\t]+")).alias("token")).where(
        F.col("token").contains("@")
    )
    return tokens.groupBy("token", fx.is_valid_email(F.col("token")).cast("int").alias("valid")).agg(
        F.count("*").alias("n")
    )


_DOMAIN = "CASE WHEN strpos({0}, '@') > 0 THEN substr({0}, strpos({0}, '@') + 1) ELSE '' END"


@query(
    "email_domain",
    oracle(f"SELECT {_DOMAIN.format('email')} AS domain, count(*) AS n FROM email_entries GROUP BY 1"),
)
def email_domain(f):
    from concordat.operators.matching import email_entries

    return email_entries(canon.accounts(f)).groupBy(fx.email_domain(F.col("email")).alias("domain")).agg(
        F.count("*").alias("n")
    )


@query(
    "risky_domain",
    oracle(f"SELECT contract_id, {_DOMAIN.format('email')} AS domain, "
           f"cast({_DOMAIN.format('email')} IN {q.RISKY} AS integer) AS risky FROM member_base WHERE email <> ''"),
)
def risky_domain(f):
    domain = fx.email_domain(F.col("email"))
    return canon.member_base(f).where("email <> ''").select(
        "contract_id", domain.alias("domain"), fx.is_risky_domain(domain).cast("int").alias("risky")
    )


@query(
    "contact_to_email",
    oracle(f"SELECT num_ctr_indiv, {q.contact('valeur_coordonnee')} AS email FROM member_base_raw"),
)
def contact_to_email(f):
    value = F.coalesce(fx.squeeze(F.col("valeur_coordonnee")), F.lit(""))
    return f.member_base_raw.select("num_ctr_indiv", fx.contact_to_email(value).alias("email"))


# ---- dates, codes, numbers --------------------------------------------------

_MIXED_SQL = """
SELECT o_orderkey, CASE o_orderpriority
  WHEN '1-URGENT' THEN d WHEN '2-HIGH' THEN concat(substr(d, 9, 2), '/', substr(d, 6, 2), '/', substr(d, 1, 4))
  WHEN '3-MEDIUM' THEN concat(' ', substr(d, 9, 2), '-', substr(d, 6, 2), '-', substr(d, 1, 4))
  WHEN '4-NOT SPECIFIED' THEN CASE o_orderstatus WHEN 'F' THEN concat(substr(d, 1, 4), '/', substr(d, 6, 2), '/', substr(d, 9, 2))
       WHEN 'O' THEN concat(d, ' 00:00:00') ELSE 'inconnue' END
  ELSE CASE o_orderstatus WHEN 'F' THEN '31/02/2020' WHEN 'O' THEN replace(d, '-', '') END END AS txt
FROM (SELECT *, cast(cast(o_orderdate AS date) AS string) AS d FROM {orders}) t"""


@query(
    "parse_date_multi",
    f"SELECT o_orderkey, txt, coalesce({q.iso('txt')}, '') AS iso FROM ({_MIXED_SQL.replace('{orders}', 'orders')}) m",
)
def parse_date_multi(f):
    mixed = f.spark.sql(_MIXED_SQL, orders=f.orders)
    return mixed.select("o_orderkey", "txt", fx.iso_date(F.col("txt")).alias("iso"))


@query(
    "identity_keys",
    oracle(f"SELECT contract_id, {q.ident('last_name', 'first_name', 'birth_date')} AS direct, "
           f"{q.ident('first_name', 'last_name', 'birth_date')} AS inverted, "
           f"{q.ident('last_name', 'birth_date')} AS name_birth FROM member_base"),
)
def identity_keys(f):
    last, first, birth = F.col("last_name"), F.col("first_name"), F.col("birth_date")
    return canon.member_base(f).select(
        "contract_id",
        fx.identity_key(last, first, birth).alias("direct"),
        fx.identity_key(first, last, birth).alias("inverted"),
        fx.identity_key(last, birth).alias("name_birth"),
    )


@query(
    "zero_pad_code",
    "SELECT c_custkey, CASE WHEN length(k) < 3 THEN lpad(k, 3, '0') ELSE k END AS code, lpad(n, 3, '0') AS nation "
    "FROM (SELECT c_custkey, cast(c_custkey AS varchar) AS k, cast(c_nationkey AS varchar) AS n FROM customer) t",
)
def zero_pad_code(f):
    return f.customer.select(
        "c_custkey",
        fx.zero_pad_code(F.col("c_custkey")).alias("code"),
        fx.zero_pad_code(F.col("c_nationkey")).alias("nation"),
    )


@query(
    "to_number_lenient",
    "SELECT p_partkey, coalesce(try_cast(split_part(p_brand, '#', 2) AS double), 0.0) AS brand_no, "
    "coalesce(try_cast(p_name AS double), 0.0) AS name_no, try_cast(p_type AS double) AS type_no FROM part",
)
def to_number_lenient(f):
    return f.part.select(
        "p_partkey",
        fx.lenient_number(F.split_part("p_brand", F.lit("#"), F.lit(2))).alias("brand_no"),
        fx.lenient_number(F.col("p_name")).alias("name_no"),
        fx.lenient_number(F.col("p_type"), None).alias("type_no"),
    )


_LABELS = """
SELECT o_orderkey, concat('Total ', o_orderpriority, ' : ', cast(cast(floor(o_totalprice / 1000) AS bigint) AS string),
  CASE o_orderstatus WHEN 'F' THEN ' ' WHEN 'O' THEN ' ' ELSE '' END,
  lpad(cast(o_orderkey % 1000 AS string), 3, '0'), CASE WHEN o_orderpriority = '5-LOW' THEN ' euros' ELSE ' ' END) AS label
FROM {orders}"""


@query(
    "parse_embedded_number",
    "SELECT o_orderkey, try_cast(regexp_replace(regexp_extract(label, ':\\s*(\\d[\\d\\s ]*)\\s*$', 1), "
    "'[\\s ]', '', 'g') AS bigint) AS n FROM (" + _LABELS.replace("{orders}", "orders") + ") t",
)
def parse_embedded_number(f):
    return f.spark.sql(_LABELS, orders=f.orders).select("o_orderkey", fx.embedded_number(F.col("label")).alias("n"))


_FLX = """
SELECT event_id, concat('{{"id":', cast(event_id AS string), CASE WHEN event_type = 'view' THEN ',"autre":"' ELSE ',"dateTraitement":"' END,
  replace(cast(cast(ts AS date) AS string), '-', ''), '"}}') AS flx FROM {events}"""


@query(
    "substr_after_token",
    "SELECT event_id, CASE WHEN strpos(flx, 'dateTraitement') > 0 THEN cast(cast(try_strptime("
    "substr(flx, strpos(flx, 'dateTraitement') + 17, 8), '%Y%m%d') AS date) AS varchar) END AS jour FROM ("
    + _FLX.replace("{events}", "events").replace("{{", "{").replace("}}", "}") + ") t",
)
def substr_after_token(f):
    rows = f.spark.sql(_FLX, events=f.events)
    return rows.select("event_id", fx.token_date(F.col("flx"), "dateTraitement", 17).cast("string").alias("jour"))


@query(
    "attrition_rate",
    "SELECT c_nationkey, round(CASE WHEN base = 0 THEN NULL ELSE cast(base - cur AS double) / base END, 9) AS rate FROM ("
    "SELECT c_nationkey, count(*) AS base, count(CASE WHEN o_orderstatus <> 'P' THEN 1 END) AS cur "
    "FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1) t",
)
def attrition_rate(f):
    counts = (
        f.orders.join(f.customer, F.col("c_custkey") == F.col("o_custkey"))
        .groupBy("c_nationkey")
        .agg(F.count("*").alias("base"), F.count_if(F.col("o_orderstatus") != "P").alias("cur"))
    )
    return counts.select("c_nationkey", F.round(fx.attrition_rate(F.col("cur"), F.col("base")), 9).alias("rate"))


@query(
    "pct2",
    f"SELECT o_orderpriority, {q.pct('nf', 'n')} AS pct FROM (SELECT o_orderpriority, count(*) AS n, "
    "count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS nf FROM orders GROUP BY 1) t",
)
def pct2(f):
    counts = f.orders.groupBy("o_orderpriority").agg(
        F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("nf")
    )
    return counts.select("o_orderpriority", fx.pct2(F.col("nf"), F.col("n")).alias("pct"))


@query(
    "interval_hms",
    "SELECT user_id, printf('%02d:%02d:%02d', s // 3600, (s % 3600) // 60, s % 60) AS duree FROM ("
    "SELECT user_id, (date_diff('microsecond', min(ts), max(ts)) // 1000000) % 86400 AS s FROM events GROUP BY 1) t",
)
def interval_hms(f):
    return f.events.groupBy("user_id").agg(fx.interval_hms(F.min("ts"), F.max("ts")).alias("duree"))


_MS = "cast(epoch_us(ts) // 1000 AS bigint)"


@query(
    "epoch_ms",
    "SELECT event_id, ms, cast(cast(to_timestamp(ms // 1000) AT TIME ZONE 'UTC' AS date) AS varchar) AS jour, "
    "strftime(to_timestamp(ms // 1000) AT TIME ZONE 'UTC', '%H:%M:%S') AS heure "
    f"FROM (SELECT event_id, {_MS} AS ms FROM events) t",
)
def epoch_ms(f):
    rows = f.events.select("event_id", av.to_epoch_ms(F.col("ts")).alias("ms"))
    day, clock = fx.epoch_ms_parts(F.col("ms"))
    return rows.select("event_id", "ms", day.cast("string").alias("jour"), clock.alias("heure"))


@query(
    "json_path_value",
    "SELECT event_id, try_cast(json_extract_string(props, '$.k') AS double) AS k, "
    "try_cast(json_extract_string(props, '$.absent') AS double) AS absent FROM events",
)
def json_path_value(f):
    from concordat.plans.supervision import json_number

    return f.events.select(
        "event_id", json_number(F.col("props"), "k").alias("k"), json_number(F.col("props"), "absent").alias("absent")
    )


# ---- projections and row rules ----------------------------------------------

_MEMBER_COLS = (
    "person_id, contract_id, member_type, company, offer, last_name, first_name, birth_date, email, "
    "contact_email, kpep, adhesion_date, effect_date, cancel_date, seq"
)


@query("normalize_member", oracle(f"SELECT {_MEMBER_COLS} FROM member"))
def normalize_member(f):
    return canon.member(f)


@query(
    "normalize_account",
    oracle("SELECT id, realm_id, idkpep, email, email_other, last_norm, first_norm, birth_iso, identity, name_birth, "
           "source, cast(src_rank AS integer) AS src_rank, seq FROM accounts"),
)
def normalize_account(f):
    return canon.accounts(f).drop("raw_last_name", "raw_first_name", "middlename", "raw_birthdate", "phonenumber")


def _class_sql(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NULL OR upper({q.strip(c)}) = 'NULL' THEN 'NULL' WHEN {q.strip(c)} = '' THEN 'VIDE' "
        f"ELSE 'REMPLI' END AS {c}_class"
    )


@query(
    "data_origin_class",
    oracle("SELECT id, realm_id, seq, " + ", ".join(_class_sql(c) for c in ("idkpep", "email", "email_other", "middlename"))
           + " FROM ck_raw"),
)
def data_origin_class(f):
    cols = ["idkpep", "email", "email_other", "middlename"]
    return nz.data_origin_class(f.ck_raw, cols).select("id", "realm_id", "seq", *[f"{c}_class" for c in cols])


@query("card_status_row", oracle("SELECT contract_id, status, cast(delta AS integer) AS delta FROM card"))
def card_status_row(f):
    return cd.card_status(canon.member(f)).select("contract_id", "status", "delta")


_EFF, _ADH = q.day("effect_date"), q.day("adhesion_date")
_SHOWN = (
    f"CASE WHEN spouse THEN coalesce(strftime({_EFF}, '%d/%m/%Y'), '') "
    f"WHEN status <> 'HORS_PERIMETRE_TP' THEN coalesce(strftime({_EFF} - 21, '%d/%m/%Y'), '') ELSE '' END"
)


@query(
    "card_eligibility_date",
    oracle(f"""SELECT contract_id, CASE WHEN spouse OR status <> 'HORS_PERIMETRE_TP' THEN 'O' ELSE 'N' END AS eligible,
 {_SHOWN} AS eligibility_date, CASE WHEN spouse THEN 'Conjoint' WHEN status = 'FUTURE_TP' THEN 'Futur' ELSE '' END AS value,
 CASE WHEN spouse OR status <> 'HORS_PERIMETRE_TP' THEN '' WHEN NOT insured THEN concat('Type assuré non éligible (', member_type, ')')
      ELSE 'Offre PREV exclue' END AS reason, substr({_SHOWN}, 4, 7) AS month_label,
 CASE WHEN status <> 'HORS_PERIMETRE_TP' THEN coalesce(strftime({_ADH} + 21, '%d/%m/%Y'), '') ELSE '' END AS adhesion_plus FROM card"""),
)
def card_eligibility_date(f):
    return cd.card_display(canon.member(f)).select(
        "contract_id", "eligible", "eligibility_date", "value", "reason", "month_label", "adhesion_plus"
    )


@query("document_eligibility", oracle(f"SELECT contract_id, {q.DOC_REASON} AS reason, cast({q.DOC_REASON} = '' AS integer) AS eligible FROM member_base"))
def document_eligibility(f):
    rows = dc.document_eligibility(canon.member_base(f))
    return rows.select("contract_id", "reason", F.col("eligible").cast("int").alias("eligible"))


_PROP = """
SELECT m.contract_id, m.birth_date, m.kpep, m.contact_email, x.match_status, r.birth_iso, coalesce(r.idkpep, '') AS acc_kpep,
 coalesce(r.email, '') AS acc_email, coalesce(trim(coalesce(r.raw_birthdate, l.raw_birthdate, d.raw_birthdate)), '') AS acc_birth,
 coalesce(r.email, l.email, d.email, '') AS any_email, coalesce(r.idkpep, l.idkpep, d.idkpep, '') AS any_kpep, x.match_method, x.matched_id
FROM insured m LEFT JOIN match x USING (person_id) LEFT JOIN account_ref r ON r.id = x.matched_id
LEFT JOIN last_acc l ON l.id = x.matched_id LEFT JOIN middle_acc d ON d.id = x.matched_id"""
_CLEAN_EMAIL = f"CASE WHEN lower(trim(any_email)) IN {q.WORDS} THEN '' ELSE trim(any_email) END"
_CLEAN_KPEP = f"CASE WHEN lower(trim(any_kpep)) IN {q.WORDS} THEN '' ELSE trim(any_kpep) END"


@query(
    "quality_flag_row",
    oracle(f"""SELECT contract_id, CASE WHEN reasons = '' THEN 'OK' ELSE concat('KO: ', reasons) END AS quality FROM (
 SELECT contract_id, CASE WHEN match_status <> 'RAPPROCHE' THEN 'Non rapproché' ELSE concat_ws('; ',
   CASE WHEN birth_date = '1900-01-01' THEN 'DDN prospect (NS)' END,
   CASE WHEN acc_birth = '1900-01-01' THEN 'DDN prospect (CIAM)' END,
   CASE WHEN kpep <> '' AND kp <> '' AND upper(kpep) <> upper(kp) THEN 'KPEP NS≠CIAM' END,
   CASE WHEN em <> '' AND NOT regexp_matches(em, '{q.EMAIL_ANCHORED}') THEN 'Email CIAM invalide'
        WHEN em <> '' AND {_DOMAIN.format('em')} IN {q.RISKY} THEN 'Email CIAM risque' END) END AS reasons
 FROM (SELECT *, {_CLEAN_EMAIL} AS em, {_CLEAN_KPEP} AS kp FROM prop) a) b""", prop=_PROP),
)
def quality_flag_row(f):
    rows = canon.propagated(f)
    return rows.select("contract_id", ql.quality_flag().alias("quality"))


@query(
    "email_match_value",
    oracle(f"""SELECT contract_id, CASE WHEN match_status = 'RAPPROCHE' AND em <> '' AND em = contact_email THEN em ELSE '' END AS shown
 FROM (SELECT *, {_CLEAN_EMAIL} AS em FROM prop) a""", prop=_PROP),
)
def email_match_value(f):
    return canon.propagated(f).select("contract_id", ql.email_shown().alias("shown"))


@query("activity_choice", oracle("SELECT * FROM activity"))
def activity_choice(f):
    return av.activity_choice(f.user_entity, canon.user_events(f), "2000-03-01", "2024-12-31")


@query(
    "rename_prefix",
    oracle("SELECT person_id AS \"NS_person_id\", contract_id AS \"NS_contract_id\", offer AS \"NS_offer\", "
           "kpep AS \"NS_kpep\", CASE WHEN insured THEN 'O' ELSE 'N' END AS insured_flag FROM member_base"),
)
def rename_prefix(f):
    rows = canon.member_base(f).select("person_id", "contract_id", "offer", "kpep", "member_type", "seq").withColumn(
        "insured_flag", F.when(nz.is_insured(F.col("member_type")), "O").otherwise("N")
    )
    return nz.rename_prefix(rows, "NS_", drop=("seq", "member_type"), extra=("insured_flag",))
