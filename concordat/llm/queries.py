"""Registered queries of this package: thin digests over the operators' results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.llm import (
    byte_bpe,
    chat_format,
    html_extract,
    line_dedup,
    merkle,
    mixing,
    near_dedup,
    packing,
    phrases,
    quality_classifier,
    quality_rules,
    spot_signatures,
    substring_dedup,
)

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove every word of a 50-word window that starts in an earlier document too."""
    found = substring_dedup.dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(list_slice(ws, i, i + 49), ' ')) AS h
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d WHERE len(ws) >= 50)
),
least AS (SELECT h, min(doc_id) AS m FROM win GROUP BY h),
rep AS (SELECT doc_id, i FROM win JOIN least USING (h) WHERE doc_id > m),
w AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS k FROM d),
judged AS (
  SELECT w.doc_id, w.w, w.k, rep.i IS NOT NULL AND w.k - rep.i < 50 AS gone
  FROM w ASOF LEFT JOIN rep ON w.doc_id = rep.doc_id AND w.k >= rep.i
),
kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(w, ' ' ORDER BY k) FILTER (NOT gone) AS t FROM judged GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every document, decode the ids, return counts and digests."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN).drop("text")
    decoded = byte_bpe.decode(encoded, RANKS, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove lines that are similar to an earlier line of the corpus."""
    found = line_dedup.dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i
  FROM documents
),
filled AS (
  SELECT doc_id, i, list_sort(list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) AS s
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
),
sets AS (SELECT s, min({'d': doc_id, 'i': i}) AS f, len(s) AS n, row_number() OVER () AS k FROM filled GROUP BY s),
tok AS (SELECT k, n, f, unnest(s) AS w FROM sets),
df AS (SELECT w, count(*) AS c FROM tok GROUP BY w),
ranked AS (SELECT k, n, f, w, row_number() OVER (PARTITION BY k ORDER BY c, w) AS r FROM tok JOIN df USING (w)),
pre AS (SELECT * FROM ranked WHERE r <= n - ceil(0.8 * n - 1e-9) + 1),
pairs AS (
  SELECT DISTINCT a.k AS ak, b.k AS bk FROM pre a JOIN pre b ON a.w = b.w
  WHERE a.f < b.f AND a.n >= 0.8 * b.n - 1e-9 AND b.n >= 0.8 * a.n - 1e-9
),
gone AS (
  SELECT DISTINCT bk AS k FROM (
    SELECT bk, a.n AS an, b.n AS bn, len(list_intersect(a.s, b.s)) AS o FROM pairs JOIN sets a ON a.k = ak JOIN sets b ON b.k = bk
  ) WHERE o >= 0.8 * (an + bn - o) - 1e-9
),
firsts AS (SELECT f.d AS doc_id, f.i AS i FROM sets WHERE k NOT IN (SELECT k FROM gone)),
judged AS (
  SELECT l.doc_id, l.i, l.line, regexp_matches(l.line, '[^\x20\x09-\x0D]') AS has_word, firsts.i IS NOT NULL AS first
  FROM l LEFT JOIN firsts ON l.doc_id = firsts.doc_id AND l.i = firsts.i
)
SELECT doc_id, count(*) FILTER (has_word) AS n_lines, count(*) FILTER (has_word AND NOT first) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (first OR NOT has_word), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak supervision over quality rules for every document."""
    judged = quality_rules.judge(_table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("quality", 6).alias("quality")
    )


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document for quality."""
    return quality_classifier.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near copies of every document."""
    return near_dedup.classes(_table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op8_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint every document and its edited text, and compare them."""
    found = spot_signatures.fingerprint(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        spot_signatures.as_text(F.col("found")).alias("fingerprint"),
        spot_signatures.as_text(F.col("edited_found")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format every conversation and conversation -7, read the turns back from the output."""
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    both = "</s>[INST] ok [/INST]"
    probe = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.explode(F.array(*[F.struct(F.lit(n).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(both).alias("text")) for n, r in enumerate(("user", "assistant"))])).alias("t"),
    )
    rows = given.unionByName(probe.select("conv_id", "t.*"))
    records = chat_format.dealt_records(chat_format.conversation_records(rows))
    turns = chat_format.canonical_turns(records, [c for c in records.columns if c != "conv_id"])
    read = chat_format.read_back(chat_format.format_turns(turns))
    said = F.transform("read_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("read_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length(F.array_join("loss_texts", "")).cast("long").alias("loss_chars"),
        F.sha2(F.array_join("loss_texts", ""), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


_ESCAPED = "replace({x}, '\\', '\\\\')"
for _plain, _inside in chat_format.CONTROL.items():
    _ESCAPED = f"replace({_ESCAPED}, '{_plain}', '{_inside}')"
_FIXED = len(chat_format.OPEN + chat_format.CLOSE + chat_format.END)

OP9_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({_FIXED} + length({_ESCAPED.format(x="role")}) + length({_ESCAPED.format(x="text")})) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack every document into sequences of 1024 tokens."""
    pieces = packing.pack(_table(spark, sf_dir, "documents"), VOCABULARY)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all sources to target weights."""
    taken = mixing.plan(_table(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of all documents, and proofs of originals and of tampered documents."""
    fields = [merkle.lower_ascii(F.col(c)) if c == "text" else F.col(c) for c in merkle.FIELDS]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    shown = F.when(tampered, merkle.leaf_digest(fields)).otherwise(merkle.leaf_digest([F.col(c) for c in merkle.FIELDS]))
    found = merkle.manifest(_table(spark, sf_dir, "documents"), shown=shown)
    found = found.withColumn("folded_root", merkle.fold(F.col("shown"), F.col("proof")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


#: DuckDB has no CRC-32: eight shifts for each byte of the decimal id, one byte at a time.
_CRC32_SQL = r"""bytes AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS s FROM documents WHERE doc_id IS NOT NULL GROUP BY doc_id
),
crc AS (
  SELECT doc_id, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(s) + 1), lambda i: CAST(ascii(s[i]) AS BIGINT))),
         lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END))) AS crc
  FROM bytes
)"""


def _op12_sql() -> str:
    """Levels written out: eight above the leaves of a source, eight above the subroots."""

    def leaf(text: str) -> str:
        fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
        return f"sha256({' || '.join(f"coalesce(strlen({x}) || ':' || {x}, '-')" for x in fields)})"

    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    parts = [
        f"""d AS (
  SELECT doc_id, coalesce('1' || source, '0') AS g, {leaf("text")} AS leaf,
         CASE WHEN doc_id IN (SELECT doc_id FROM tampered_ids) THEN {leaf(f"translate(text, '{upper}', '{upper.lower()}')")} ELSE {leaf("text")} END AS cur
  FROM documents
)""",
        "l0 AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM d)",
        "a0 AS (SELECT g, i, n, leaf AS h FROM l0)",
    ]

    def climb(name: str, level: int) -> None:
        parts.append(f"{name}r{level} AS (SELECT g, i // 16 AS p, n, list(h ORDER BY i) AS hs FROM {name}{level} WHERE n > 1 GROUP BY g, p, n)")
        parts.append(
            f"{name}{level + 1} AS (SELECT g, p AS i, (n + 15) // 16 AS n, sha256(array_to_string(hs, '')) AS h FROM {name}r{level} "
            f"UNION ALL SELECT g, i, n, h FROM {name}{level} WHERE n = 1)"
        )

    for level in range(8):
        climb("a", level)
    parts.append("b0 AS (SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n, h, g AS name FROM a8)")
    for level in range(8):
        climb("b", level)
    parts.append("p0 AS (SELECT l0.doc_id, l0.leaf, l0.g, l0.i, a8.h AS subroot, b8.h AS root, l0.cur, '' AS proof FROM l0 JOIN a8 ON l0.g = a8.g CROSS JOIN b8)")
    step = 0
    for name in ("a", "b"):
        if name == "b":
            parts.append(f"q AS (SELECT p.* REPLACE ('' AS g, b0.i AS i) FROM p{step} p JOIN b0 ON p.g = b0.name)")
        for level in range(8):
            before = "q" if name == "b" and not level else f"p{step}"
            step += 1
            left, right = "array_to_string(hs[: p.i % 16], '')", "array_to_string(hs[p.i % 16 + 2 :], '')"
            parts.append(
                f"p{step} AS (SELECT p.* REPLACE (p.i // 16 AS i, CASE WHEN hs IS NULL THEN cur ELSE sha256({left} || cur || {right}) END AS cur, "
                f"proof || CASE WHEN hs IS NULL THEN '' ELSE {left} || {right} END AS proof) FROM {before} p LEFT JOIN {name}r{level} r ON p.g = r.g AND p.i // 16 = r.p)"
            )
    body = ",\n".join(parts)
    tail = f"SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root AS verified FROM p{step}"
    return f"WITH {_CRC32_SQL},\ntampered_ids AS (SELECT doc_id FROM crc WHERE crc % 5 = 0),\n{body}\n{tail}"


OP12_SQL = _op12_sql()


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best phrases of two to five words of every language."""
    return phrases.mine(_table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
total AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
grams AS (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w CROSS JOIN unnest(range(1, 6)) t(k) WHERE len(ws) >= k),
f AS (SELECT lang, k, ws[i : i + k - 1] AS p, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
cand AS (SELECT *, array_to_string(p, ' ') AS phrase FROM f WHERE k >= 2),
cuts AS (SELECT lang, k, p, phrase, a, unnest(range(1, k)) AS j FROM cand),
scores AS (
  SELECT c.lang, c.phrase, c.k, c.a, c.j, x.a AS l, y.a AS r, t.n, CAST(CAST(1000 AS HUGEINT) * c.a * t.n // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM cuts c JOIN total t USING (lang) JOIN f x ON x.lang = c.lang AND x.p = c.p[: c.j] JOIN f y ON y.lang = c.lang AND y.p = c.p[c.j + 1 :]
),
best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
free AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM cand c WHERE c.lang = b.lang AND c.a = b.a AND c.k > b.k AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' '))
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM free QUALIFY rank <= 2000
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_line_dedup": op3_line_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_html_extract": op5_html_extract,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_near_dedup": op7_near_dedup,
    "op8_spot_signatures": op8_spot_signatures,
    "op9_chat_format": op9_chat_format,
    "op10_packing": op10_packing,
    "op11_mixing": op11_mixing,
    "op12_merkle": op12_merkle,
    "op13_phrases": op13_phrases,
}
ORACLES: dict[str, str] = {"op1_substring_dedup": OP1_SQL, "op3_line_dedup": OP3_SQL, "op9_chat_format": OP9_SQL, "op12_merkle": OP12_SQL, "op13_phrases": OP13_SQL}
