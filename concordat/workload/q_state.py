"""Sources, sinks, state tables, privacy and streaming."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from concordat.operators import documents as dc
from concordat.operators import privacy as pv
from concordat.session import checkpoint_dir
from concordat.sources import columns as sc
from concordat.sources import files as fs
from concordat.sources import grids as gr
from concordat.sources import state as st
from concordat.streaming import tracking as tr
from concordat.workload import canon, q_matching
from concordat.workload import oracle as q
from concordat.workload.oracle import oracle
from concordat.workload.registry import query


def work_dir(f) -> str:
    """A new folder beside the checkpoints, which every executor can reach."""
    return f"{checkpoint_dir(f.spark).rstrip('/')}/concordat-{uuid.uuid4().hex}"


# ---- files ---------------------------------------------------------------------

_CSV = ("num_personne", "num_ctr_indiv", "nom_long", "prenom", "offre", "date_adhesion")


_SPARSE = "CASE WHEN offre NOT LIKE '1%' THEN {c} END AS {c}"  # empty first and second fields


@query("read_csv_snapshot", oracle(
    f"SELECT {', '.join(_SPARSE.format(c=c) for c in _CSV[:2])}, {', '.join(_CSV[2:])} FROM member_base_raw"))
def read_csv_snapshot(f):
    path = work_dir(f)
    rows = f.member_base_raw.select("seq", *_CSV).withColumns({c: F.when(~F.col("offre").startswith("1"), F.col(c)) for c in _CSV[:2]})
    part = F.floor(F.col("seq") / 4096).alias("part")
    style = {"sep": ";", "ignoreTrailingWhiteSpace": "false", "emptyValue": ""}
    body = rows.select(part, F.lit(2).alias("place"), F.to_csv(F.struct(*_CSV), style).alias("value"))
    head = F.array(*[F.struct(F.lit(i).alias("place"), F.lit(t).alias("value")) for i, t in enumerate(("Extraction du jour;;", ";".join(_CSV)))])
    lines = body.unionByName(body.select("part").distinct().select("part", F.inline(head)))
    # One file a part, as extracts come: preamble and header first, in the old encoding.
    out = lines.repartition("part").sortWithinPartitions("part", "place").select("part", "value").write.partitionBy("part")
    out.option("sep", "\x01").option("quote", "").option("encoding", "iso-8859-1").option("ignoreTrailingWhiteSpace", "false").csv(path)
    return fs.read_csv_snapshot(f.spark, path, preamble=1)


@query("read_wrapped_csv", oracle(f"SELECT {', '.join(_CSV)} FROM member_base_raw"))
def read_wrapped_csv(f):
    path = work_dir(f)
    # Every part begins with the header, as extracts come: one quoted cell a line.
    line = F.to_csv(F.struct(*_CSV), {"sep": ";", "ignoreTrailingWhiteSpace": "false"}).alias(";".join(_CSV))
    out = f.member_base_raw.select(line).write.option("header", "true").option("quoteAll", "true").option("escape", '"')
    out.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
    return fs.read_wrapped_csv(f.spark, path)


@query("resolve_columns", oracle(
    "SELECT num_personne AS person_id, num_ctr_indiv AS contract_id, offre AS offer, 'UNK' AS company, seq FROM member_base_raw"))
def resolve_columns(f):
    odd = f.member_base_raw.select(
        F.col("num_personne").alias(' "Num_Personne" '), F.col("num_ctr_indiv").alias("CONTRAT"), F.col("offre").alias("Offré"), "seq", F.col("prenom").alias("libelle_offre")
    )
    wanted = {k: sc.MEMBER_ALIASES[k] for k in ("person_id", "contract_id", "offer", "company")}
    return sc.resolve_columns(odd, wanted, {"company": F.lit("UNK")}, keep=("seq",))


@query("union_parts", oracle("SELECT id, realm_id, first_name, phonenumber FROM ck_raw UNION ALL SELECT id, realm_id, first_name, NULL FROM cm_raw"))
def union_parts(f):
    path = work_dir(f)
    f.ck_raw.select("id", "realm_id", "first_name", "phonenumber").write.option("header", "true").option("sep", ",").csv(path)
    f.cm_raw.select("id", "realm_id", "first_name").write.mode("append").option("header", "true").option("sep", ";").csv(path)
    return fs.union_parts(f.spark, path, "*.csv", exclude="RETRY")


@query("tag_source_file", oracle(
    "SELECT num_ctr_indiv, flux_id || '_New_S.csv' AS source_file, flux_id, cast(cast(strptime(flux_id, '%d%m%Y') AS date) AS varchar) AS flux_date FROM member_base_raw"))
def tag_source_file(f):
    path = work_dir(f)
    rows = f.member_base_raw.select("num_ctr_indiv", F.concat("flux_id", F.lit("_New_S.csv")).alias("dataset"))
    rows.write.partitionBy("dataset").option("header", "true").csv(path)
    tagged = fs.tag_source_file(f.spark.read.option("header", "true").csv(path).drop("dataset"))
    return tagged.withColumn("flux_date", F.col("flux_date").cast("string"))


_LINES = """SELECT cast(doc_id AS varchar) AS file, i AS "row", j AS col, w[j] AS value FROM (
 SELECT doc_id, i, w, unnest(range(1, len(w) + 1)) AS j FROM (SELECT doc_id, i, regexp_split_to_array(l[i], '[ \\t]+') AS w FROM (
 SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents) a) b) c) d WHERE w[j] <> ''"""
_MARK = "le"


@query("extract_block", oracle(
    f"""SELECT c.file, cast(c."row" AS integer) AS "row", cast(c.col AS integer) AS col, c.value FROM cells c JOIN (SELECT file, min("row") AS m FROM cells WHERE lower(trim(value)) = '{_MARK}' GROUP BY 1) k USING (file)
      WHERE c."row" > m AND c."row" < coalesce((SELECT min(g) FROM (SELECT file AS gf, "row" + 1 AS g FROM (SELECT DISTINCT file, "row" FROM cells) r
        WHERE NOT EXISTS (SELECT 1 FROM cells n WHERE n.file = r.file AND n."row" = r."row" + 1)) z WHERE gf = c.file AND g > m), 1000000000)""", cells=_LINES))
def extract_block(f):
    cells = gr.lines_to_cells(f.documents, "doc_id", "text")
    return gr.extract_block(cells, _MARK).drop("sheet")


_SHEETS = """SELECT cast(o_orderkey AS string) AS file, r AS row, c AS col, v AS value FROM (
 SELECT o_orderkey, 2 AS r, 1 AS c, 'KPI 1 souscriptions' AS v FROM {orders}
 UNION ALL SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 1 ELSE 4 END, 3, cast(cast(floor(o_totalprice) AS bigint) AS string) FROM {orders}
 UNION ALL SELECT o_orderkey, 2, 2, 'texte' FROM {orders}
 UNION ALL SELECT o_orderkey, 7, 1, concat('Déphasages mails : ', cast(cast(floor(o_totalprice / 1000) AS bigint) AS string), ' ', substr(o_orderpriority, 1, 1), '00') FROM {orders}
 UNION ALL SELECT o_orderkey, 9, 4, 'kpi 1 bis' FROM {orders}) t"""


@query("extract_scalar", oracle(
    """SELECT cast(o_orderkey AS varchar) AS file, 'kpi1' AS key, cast(floor(o_totalprice) AS double) AS value FROM orders
    UNION ALL SELECT cast(o_orderkey AS varchar), 'mails', cast(cast(floor(o_totalprice / 1000) AS bigint) * 1000 + cast(substr(o_orderpriority, 1, 1) AS bigint) * 100 AS double) FROM orders"""))
def extract_scalar(f):
    cells = f.spark.sql(_SHEETS, orders=f.orders).withColumn("sheet", F.lit("s"))
    return gr.extract_scalar(cells, {"kpi1": r"^kpi\s*1\b(?!\s*(bis|ter))", "mails": "déphasages mails"}).drop("sheet")


# ---- sinks ------------------------------------------------------------------------

_SNAP = ("contract_id", "person_id", "member_type", "offer", "company", "adhesion_date", "seq")
_SNAP_SQL = ", ".join(_SNAP)


@query("write_snapshot", oracle(f"SELECT {_SNAP_SQL}, flux_id FROM member"))
def write_snapshot(f):
    path = work_dir(f)
    st.write_snapshot(canon.snapshots_base(f).select(*_SNAP, "flux_id"), path)
    return st.read_table(f.spark, path)


@query("replace_flux", oracle(
    f"SELECT {_SNAP_SQL}, flux_id FROM member WHERE flux_id <> '31122001' OR insured"))
def replace_flux(f):
    path = work_dir(f)
    rows = canon.snapshots_base(f).select(*_SNAP, "flux_id")
    st.write_snapshot(rows.withColumn("date_import", F.lit("2001-01-01").cast("timestamp_ntz")), path)
    current = rows.where(F.col("flux_id") == canon.CURRENT_RUN)
    for _ in range(2):  # a second load of the same run changes nothing
        st.replace_flux(current.where(F.col("member_type").isin("ASSPRI", "MPACTI", "MPRETR", "MPVRET")), path, canon.CURRENT_RUN, "2001-02-01")
    return st.read_table(f.spark, path).drop("date_import")


@query("reconcile_load", oracle(
    """SELECT flux_id, s AS source_rows, coalesce(p, 0) AS prepared_rows, coalesce(d, 0) AS deleted_rows, coalesce(t, 0) AS stored_rows,
      coalesce(p, 0) - coalesce(t, 0) AS gap, CASE WHEN coalesce(p, 0) = 0 THEN 'SKIPPED' WHEN p = coalesce(t, 0) THEN 'OK' ELSE 'WARN' END AS status FROM (
      SELECT flux_id, count(*) AS s, count(CASE WHEN insured AND flux_id <> '31121995' THEN 1 END) AS p, count(CASE WHEN spouse THEN 1 END) AS d,
       count(CASE WHEN insured AND flux_id NOT IN ('31121995', '31121996') THEN 1 END) AS t FROM member GROUP BY 1) x"""))
def reconcile_load(f):
    from concordat.operators.filters import scope_filter

    rows = canon.snapshots_base(f)
    prepared = scope_filter(rows, "ASSURE").where("flux_id <> '31121995'")
    path = work_dir(f)
    st.write_snapshot(prepared.where("flux_id <> '31121996'").select(*_SNAP, "flux_id"), path)
    return st.reconcile_load(rows, prepared, scope_filter(rows, "CONJOINT"), st.read_table(f.spark, path))


@query("evolve_schema", oracle("SELECT person_id, contract_id, cast(NULL AS varchar) AS legacy, offer, cast(NULL AS varchar) AS kpep_iehe FROM member_base"))
def evolve_schema(f):
    rows = canon.member_base(f).select("person_id", "contract_id", "offer")
    added, out = st.evolve_schema(rows, ["person_id", "contract_id", "legacy"], conformance=["kpep_iehe"])
    assert added == ["offer", "kpep_iehe"]
    return out


@query("dedupe_load", oracle("SELECT id, realm_id, seq FROM (SELECT *, row_number() OVER (PARTITION BY realm_id ORDER BY seq) AS rn FROM ck_raw) t WHERE rn = 1"))
def dedupe_load(f):
    return st.dedupe_load(f.ck_raw.select("id", "realm_id", "seq"))


@query("append_history", oracle("SELECT flux_id, count(*) AS n FROM (SELECT '31121999' AS flux_id FROM detail UNION ALL SELECT '31122000' FROM detail WHERE present_ged = 'OUI') t GROUP BY 1",
                                **q_matching._FULL))
def append_history(f):
    path, detail = work_dir(f), canon.document_detail(f).select("contract_id", "present_ged", "statut_final")
    st.append_history(detail.withColumn("flux_id", F.lit("31121999")), path)
    st.append_history(detail.where("present_ged = 'OUI'").withColumn("flux_id", F.lit("31122000")), path)
    return st.read_table(f.spark, path).groupBy("flux_id").agg(F.count("*").alias("n"))


@query("store_kpi_payload", oracle("SELECT flux_id, cast(n AS double) AS lignes, cast(persons AS double) AS personnes FROM run_counts"))
def store_kpi_payload(f):
    from concordat.plans.supervision import json_number

    cells = F.array(*[F.struct(F.lit(p).alias("path"), F.col(c).alias("value")) for p, c in (("lignes", "n"), ("personnes", "persons"))])
    path = work_dir(f)
    st.store_kpi_payload(f.run_counts.select("flux_id", F.inline(cells)), path, "2001-01-01 06:00:00")
    back = st.read_table(f.spark, path)
    return back.select("flux_id", *[json_number(F.col("payload"), p).alias(p) for p in ("lignes", "personnes")])


# ---- tracking ------------------------------------------------------------------------

_TODAY = "DATE '2001-03-01'"


@query("upsert_tracking", oracle(
    f"""SELECT '31122000' AS flux_id, kpep, cast(coalesce(t.date_found, CASE WHEN h.hit THEN {_TODAY} END) AS varchar) AS date_found,
      greatest(e.motif, t.motif) AS motif FROM (SELECT kpep, date_found, motif, true AS was FROM tracking_old WHERE flux_id = '31122000') t
    FULL JOIN (SELECT DISTINCT trim(idepsp) AS kpep, true AS hit FROM document_keys) h USING (kpep)
    FULL JOIN (SELECT upper(trim(kpep)) AS kpep, max(CASE WHEN kpep_reference = '' THEN 'non rapproché iehe' END) AS motif, true AS want FROM keyed GROUP BY 1) e USING (kpep)""",
    **q_matching._FULL))
def upsert_tracking(f):
    wanted = dc.tracking_rows(canon.member_base(f), canon.registry(f))
    out = st.upsert_tracking(f.tracking_old, f.document_keys, wanted, "31122000", "2001-03-01")
    return out.withColumn("date_found", F.col("date_found").cast("string"))


@query("resolve_tracking", oracle(
    f"""SELECT flux_id, kpep, cast(CASE WHEN date_found IS NULL AND kpep IN (SELECT trim(idepsp) FROM document_keys) THEN {_TODAY} ELSE date_found END AS varchar) AS date_found, motif
    FROM tracking_old"""))
def resolve_tracking(f):
    out = st.resolve_tracking(f.tracking_old, f.document_keys, "2001-03-01")
    return out.withColumn("date_found", F.col("date_found").cast("string"))


@query("pending_window", oracle(
    f"""SELECT count(*) AS pending, cast(least(coalesce(min(cast(strptime(flux_id, '%d%m%Y') AS date)), {_TODAY}), {_TODAY}) AS varchar) AS window_start,
      '2001-03-01' AS window_end FROM tracking_old WHERE date_found IS NULL"""))
def pending_window(f):
    out = st.pending_window(f.tracking_old, "2001-03-01")
    return out.select("pending", *[F.col(c).cast("string").alias(c) for c in ("window_start", "window_end")])


@query("incremental_tracking", oracle(
    """SELECT e.flux_id, e.kpep, CASE WHEN own.kpep IS NOT NULL OR EXISTS (SELECT 1 FROM arrivals x WHERE x.kind = 'FOUND' AND trim(x.kpep) = e.kpep
         AND strptime(x.flux_id, '%d%m%Y') > strptime(e.flux_id, '%d%m%Y')) THEN '2001-03-01' END AS date_found, e.motif
    FROM (SELECT flux_id, trim(kpep) AS kpep, max(motif) AS motif FROM arrivals GROUP BY 1, 2) e
    LEFT JOIN (SELECT DISTINCT flux_id, trim(kpep) AS kpep FROM arrivals WHERE kind = 'FOUND') own ON own.flux_id = e.flux_id AND own.kpep = e.kpep"""))
def incremental_tracking(f):
    path = work_dir(f)
    # Runs and kinds come in files of their own, a few files in each batch.
    f.arrivals.repartition("flux_id", "kind").write.parquet(path + "/in")
    tr.incremental_tracking(f.spark, path + "/in", path + "/table", path + "/ckpt", "2001-03-01", files_per_batch=2)
    out = tr.tracking_table(f.spark, path + "/table")
    return out.withColumn("date_found", F.col("date_found").cast("string"))


# ---- privacy --------------------------------------------------------------------------

_KEY = "cle-de-test"


def _pseudo(c):
    return f"CASE WHEN coalesce({q.strip(c)}, '') <> '' THEN 'P-' || sha256('{_KEY}' || lower({q.strip(c)})) ELSE {c} END AS {c}"


@query("pseudonymize_columns", oracle(f"SELECT contract_id, {_pseudo('last_name')}, {_pseudo('email')}, {_pseudo('kpep')} FROM member_base"))
def pseudonymize_columns(f):
    rows = canon.member_base(f).select("contract_id", "last_name", "email", "kpep")
    return pv.pseudonymize_columns(rows, ["last_name", "email", "kpep"], _KEY)


_UP = "A-ZÀÉÈÊËÏÎÔÙÛÜ"
_FN = pv.FIRST_NAME
_RED = "text"
for _rx, _to in ((pv.EMAIL, "[EMAIL]"), (pv.PHONE, "[TEL]"), (pv.NIR, "[NIR]"), (f"(Nom)([{_UP}]+)(Prénom|KPEP|Adresse|\\s|$)", "\\1[NOM]\\3"),
                 (_FN, "\\1[PRENOM]"), (pv.KPEP, "\\1[CLE]")):
    _RED = f"regexp_replace({_RED}, '{_rx}', '{_to}', 'g')"


@query("redact_text", oracle(f"SELECT src, doc_id, {_RED} AS text FROM (SELECT 'doc' AS src, doc_id, text FROM documents UNION ALL SELECT 'ticket', doc_id, text FROM descriptions) t"))
def redact_text(f):
    rows = f.documents.select(F.lit("doc").alias("src"), "doc_id", "text").unionByName(f.descriptions.select(F.lit("ticket").alias("src"), "doc_id", "text"))
    return rows.withColumn("text", pv.redact_text(F.col("text")))


_NAMES = "SELECT text AS name FROM benchmark UNION ALL SELECT last_name FROM persona UNION ALL SELECT first_name FROM persona"
_QUOTED = "regexp_replace(name, '([\\.\\[\\]{}()*+?^$|\\-])', '\\\\\\1', 'g')"


@query("redact_known_names", oracle(
    f"""SELECT t.src, t.doc_id, CASE WHEN p IS NULL THEN text ELSE array_to_string(list_transform(list_zip(regexp_split_to_array(text, p),
      list_transform(regexp_extract_all(text, p), lambda m: 'P-' || sha256('{_KEY}' || lower({q.strip('m')})))), lambda x: x[1] || coalesce(x[2], '')), '') END AS text
    FROM known_texts t LEFT JOIN (SELECT src, doc_id, '(?i)' || string_agg({_QUOTED}, '|' ORDER BY length(name) DESC, name) AS p
      FROM known_texts JOIN known ON contains(lower(text), name) GROUP BY src, doc_id) h ON h.src = t.src AND h.doc_id = t.doc_id""",
    known=f"SELECT DISTINCT lower({q.strip('name')}) AS name FROM ({_NAMES}) n WHERE length({q.strip('name')}) >= {pv.MIN_NAME}",
    known_texts="SELECT 'doc' AS src, doc_id, text FROM documents UNION ALL SELECT 'note', doc_id, text FROM notes"))
def redact_known_names(f):
    # Known names: whole benchmark passages, and the last and first names of all persons.
    person = f.persona.select(F.explode(F.array("last_name", "first_name")).alias("name"))
    names = f.benchmark.select(F.col("text").alias("name")).unionByName(person)
    texts = f.documents.select(F.lit("doc").alias("src"), "doc_id", "text").unionByName(f.notes.select(F.lit("note").alias("src"), "doc_id", "text"))
    known = pv.redact_known_names(texts.withColumn("key", F.struct("src", "doc_id")), names, "key", "text", _KEY)
    return known.drop("key")


_CL = (("emails", pv.EMAIL, 0), ("telephones", pv.PHONE, 0), ("nir", pv.NIR, 0), ("kpep", pv.KPEP, 2))


@query("redaction_stats", oracle(
    "SELECT kind, count(DISTINCT v) AS unique_values, count(*) AS matches FROM (" + " UNION ALL ".join(
        f"SELECT '{n}' AS kind, lower(unnest(regexp_extract_all(text, '{rx}', {g}))) AS v FROM txt" for n, rx, g in _CL) + ") t GROUP BY 1",
    txt="SELECT text FROM documents UNION ALL SELECT text FROM descriptions"))
def redaction_stats(f):
    return pv.redaction_stats(f.documents.select("text").unionByName(f.descriptions.select("text")), "text")
