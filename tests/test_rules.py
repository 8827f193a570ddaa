"""Card, documents, corrections, ledgers and tracking on edge rows."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from concordat.operators import card as cd
from concordat.operators import documents as dc
from concordat.operators import lookups as lk
from concordat.operators import privacy as pv
from concordat.operators import registry as rg
from concordat.operators import windows as wn
from concordat.sources import state as st

CARD = "person_id string, contract_id string, member_type string, offer string, company string, adhesion_date string, effect_date string, seq long"


def contracts(rows):
    base = "2024-01-01"
    return rows(
        CARD,
        ("1", "a", "ASSPRI", "MES1", "010", base, "2024-01-22", 1),  # 21 days
        ("1", "b", "ASSPRI", "MES1", "010", base, "2024-01-23", 2),  # 22 days
        ("2", "c", "MPACTI", "MES1", "010", base, "2023-12-01", 3),  # negative
        ("3", "d", "ASSPRI", "MEPX", "010", base, base, 4),
        ("3", "e", "ASSPRI", "INDX", "010", base, base, 5),
        ("3", "f", "ASSPRI", "INPPREVIND", "010", base, base, 6),
        ("3", "g", "ASSPRI", "MES1", "073", base, base, 7),
        ("4", "h", "CONJOI", "MES1", "010", base, base, 8),
        ("5", "i", "MPRETR", "MES1", "010", "", base, 9),
        ("6", "j", "MPVRET", "MES1", "010", base, "2024-99-99", 10),
        ("7", "k", "ASSPRI", "INPX", "010", base, base, 11),
    )


def test_card_status(rows):
    got = {r["contract_id"]: r["status"] for r in cd.card_status(contracts(rows)).collect()}
    out, el, fu = cd.OUT_OF_SCOPE, cd.ELIGIBLE, cd.FUTURE
    assert got == dict(a=el, b=fu, c=el, d=out, e=out, f=out, g=out, h=out, i=fu, j=fu, k=el)


def test_card_person_prefers_eligible_then_order(rows):
    got = {r["person_id"]: (r["status"], r["effect_date"]) for r in cd.person_card(contracts(rows)).collect()}
    assert got["1"] == (cd.ELIGIBLE, "2024-01-22")
    assert set(got) == {"1", "2", "5", "6", "7"}


def test_card_display(rows):
    got = {r["contract_id"]: r for r in cd.card_display(contracts(rows)).collect()}
    assert (got["a"]["eligibility_date"], got["a"]["adhesion_plus"], got["a"]["value"]) == ("01/01/2024", "22/01/2024", "")
    assert (got["h"]["eligible"], got["h"]["value"], got["h"]["month_label"]) == ("O", "Conjoint", "01/2024")
    assert got["d"]["reason"] == "Offre PREV exclue"


def test_card_delay_takes_the_upper_median(rows):
    persons = rows("person_id string, status string, effect_date string", *[(str(i), cd.FUTURE, d) for i, d in enumerate(("2024-01-11", "2024-01-21", "2024-02-10", "2024-05-01"))])
    r = cd.card_delay(persons, "2024-01-01", "2024-01-01").first()
    assert (r["population"], r["median_days"], r["b0_30"], r["b31_60"], r["b91_180"], r["gt30"]) == (4, 40, 2, 1, 1, 2)
    empty = cd.card_delay(persons.where("false"), "2024-01-01", "2024-01-01").first()
    assert (empty["population"], empty["median_days"], empty["mean_days"]) == (0, 0, 0.0)


def test_document_scope_differs_from_card_scope(rows):
    got = {r["contract_id"]: r["reason"] for r in dc.document_eligibility(contracts(rows)).collect()}
    assert got["e"] == "" and got["k"] == "Offre exclue (INP*/MEP*)" and got["h"] == "Conjoint" and got["g"] == "Société exclue (073)"


def test_key_fallback_prefers_named_company(rows):
    reg = rows("refperboccn string, idrpp string, socappr string, kpep_iehe string, seq long",
               ("1", "G", "", "KPEP0", 1), ("1", "G", "044", "kpep1", 2), ("1", "G", "052", "KPEP2", 3), ("2", "KPEP9", "", "nan", 4), ("3", "G3", "010", "", 5))
    wanted = rows("person_id string, company string", ("1", "052"), ("1", "010"), ("2", "010"), ("3", "010"))
    got = {(r["person_id"], r["company"]): (r["kpep_reference"], r["motif_kpep"]) for r in dc.key_with_fallback(wanted, reg).collect()}
    assert got == {("1", "052"): ("KPEP2", "match_societe"), ("1", "010"): ("KPEP1", "fallback_autre_societe"),
                   ("2", "010"): ("KPEP9", "fallback_autre_societe"), ("3", "010"): ("", "absent_iehe")}


def test_corrections_most_specific_then_last(rows):
    work = rows("kpep_reference string, company string, offer string, statut_rapprochement string",
                ("K1", "010", "A", "NON_RAPPROCHE"), ("K1", "010", "B", "NON_RAPPROCHE"), ("K1", "044", "A", "RAPPROCHE"), ("K2", "010", "A", "RAPPROCHE"))
    corr = rows("kpep_ref string, code_societe string, offre string, decision_manuelle string, commentaire string, seq long",
                ("k1", "010", "a", "FORCE_RAPPROCHE", "x", 1), ("K1", "010", "", "FORCE_NON_RAPPROCHE", "", 2), ("K1", "", "", "FORCE_RAPPROCHE", "", 3),
                ("K1", "", "", "force_non_rapproche", "last", 4), ("K2", "", "A", "FORCE_NON_RAPPROCHE", "offer alone is no level", 5))
    got = {(r["kpep_reference"], r["company"], r["offer"]): (r["statut_final"], r["correction_manuelle"], r["commentaire"]) for r in dc.override_by_specificity(work, corr).collect()}
    assert got == {("K1", "010", "A"): ("RAPPROCHE", "OUI", "[FORCE_RAPPROCHE] x"), ("K1", "010", "B"): ("NON_RAPPROCHE", "NON", "[FORCE_NON_RAPPROCHE]"),
                   ("K1", "044", "A"): ("NON_RAPPROCHE", "OUI", "[FORCE_NON_RAPPROCHE] last"), ("K2", "010", "A"): ("RAPPROCHE", "NON", "")}


def test_retry_registry_is_idempotent(rows):
    ledger = rows("person_id string, statut_retry string, date_derniere_verif string, mail_iehe string, kpep_iehe string",
                  ("1", "KO", "", "", ""), ("2", "KO", "", "", ""), ("3", "OK", "old", "keep", "keep"))
    reg = rows("refperboccn string, idrpp string, adrmailctc string, seq long", ("1", "G", "a@b.fr", 1), ("KPEP1", "G", None, 2), ("3", "G", "new@b.fr", 3))
    once = rg.retry_registry(ledger, reg, "today")
    got = {r["person_id"]: tuple(r)[1:] for r in once.collect()}
    assert got == {"1": ("OK", "today", "a@b.fr", "KPEP1"), "2": ("KO", "today", "", ""), "3": ("OK", "old", "keep", "keep")}
    assert sorted(map(tuple, rg.retry_registry(once, reg, "today").collect())) == sorted(map(tuple, once.collect()))


def test_tracking_upsert_resolve_window(rows, spark):
    d = dt.date(2024, 1, 5)
    old = rows("flux_id string, kpep string, date_found date, motif string", ("01082024", "A", None, "m"), ("01082024", "B", d, None), ("17072024", "A", None, None))
    found, want = rows("idepsp string", ("A",), (" C ",), ("",)), rows("kpep string, motif string", ("B", None), ("D", "r"), ("D", None))
    got = {r["kpep"]: (r["date_found"], r["motif"]) for r in st.upsert_tracking(old, found, want, "01082024", "2024-08-02").collect()}
    assert got == {"A": (dt.date(2024, 8, 2), "m"), "B": (d, None), "C": (dt.date(2024, 8, 2), None), "D": (None, "r")}
    solved = st.resolve_tracking(old, found, "2024-08-03")
    assert {(r["flux_id"], r["kpep"]): r["date_found"] for r in solved.collect()} == {
        ("01082024", "A"): dt.date(2024, 8, 3), ("01082024", "B"): d, ("17072024", "A"): dt.date(2024, 8, 3)}
    w = st.pending_window(old, "2024-08-10").first()
    assert (w["pending"], w["window_start"], w["window_end"]) == (2, dt.date(2024, 7, 17), dt.date(2024, 8, 10))
    assert st.pending_window(old.where("false"), "2024-08-10").first()["window_start"] == dt.date(2024, 8, 10)


def test_latest_snapshot_by_date_not_text(rows):
    runs = rows("flux_id string, v long", ("31012024", 1), ("01022024", 2), ("xx", 3))
    assert [r["v"] for r in lk.latest_snapshot(runs).collect()] == [2]
    assert [r["flux_id"] for r in wn.last_n_runs(runs, 5).collect()] == ["01022024", "31012024"]


def test_known_names_against_brute_force(rows):
    import re

    names = ["Durand", "De La Durandière", "Léa", "ab", "A.B*C", "élo"]
    texts = ["Mme DURAND et Léa-Anne durandal", "vu de la durandière hier", "a.b*c puis ÉLO, axbxc", "rien", "", "xx léa", "İstanbul durand"]
    kept = sorted({n.strip().lower() for n in names if len(n.strip()) >= 3}, key=lambda n: (-len(n), n))
    rx = re.compile("|".join(map(re.escape, kept)), re.IGNORECASE)
    docs = rows("id long, text string", *enumerate(texts))
    listed = rows("name string", *[(n,) for n in names])
    want_hits = {i: rx.findall(t) for i, t in enumerate(texts)}
    got = {r["id"]: r["text"] for r in pv.redact_known_names(docs, listed, "id", "text", "k").collect()}
    for i, text in enumerate(texts):
        marks = re.findall(r"P-[0-9a-f]{64}", got[i])
        assert len(marks) == len(want_hits[i]), text
        assert re.sub(r"P-[0-9a-f]{64}", "#", got[i]) == rx.sub("#", text)


def test_many_names_do_not_let_more_of_a_text_through(spark):
    """A table of a fixed size is full of the grams of half a million names."""
    names = spark.range(500_000).select(F.md5(F.col("id").cast("string")).substr(1, 8).alias("name"))
    low = spark.range(200).select("id", F.concat_ws("", *[F.md5(F.concat(F.lit(f"{k}-"), "id")) for k in range(8)]).alias("__low"))
    marks = pv._marks(pv._name_grams(names))
    assert marks[1] == [8]
    grams = pv._marked_grams(low, *marks, "id").count()
    assert grams < 0.05 * 200 * 249
    own = names.select(F.monotonically_increasing_id().alias("id"), F.col("name").alias("__low"))
    assert pv._marked_grams(own, *marks, "id").count() == 500_000


def test_grams_of_a_text_that_is_dealt():
    texts = ["", None, "ab", "abcdefgh", "é" * 20 + "𝄞" * 9, "xyz" * 500_000]
    for width in (3, 8):
        want = {(i, t[k : k + width]) for i, t in enumerate(texts) if t for k in range(len(t) - width + 1)}
        name_of = {pv._grams(np.array([ord(c) for c in g], np.uint64), width).item(): g for _, g in want}
        assert len(name_of) == len({g for _, g in want})
        got = set()
        for rows, lengths, codes in pv._pieces(texts):
            assert len(codes) < 3 * pv._FLUSH
            grams, owner = pv._placed(codes, lengths, width)
            got |= {(int(r), name_of[g]) for r, g in zip(*pv._unlike(rows[owner], grams))}
        assert got == want


def test_known_names_are_looked_up_by_their_rarest_gram(spark, rows):
    """Names and texts share beginnings and common parts; only texts that hold a name leave the explode."""
    texts = [f"monsieur le directeur general no {i:06d} est absent, monsieur le directeur est la" for i in range(3000)]
    names = [f"Monsieur le directeur general No {i * 31:06d}" for i in range(90)] + ["monsieur le president", "zzz"]
    docs = rows("id long, text string", *enumerate(texts))
    low = docs.select("id", F.lower("text").alias("__low"))
    clean = rows("name string", *[(n.lower(),) for n in names])
    keys = {r["name"] for r in pv.name_keys(low, clean, "id").collect()}
    assert len(keys) == 90 and not keys & {"zzz", "monsieur le president"}
    hits = {(i, n.lower()) for i, t in enumerate(texts) for n in names if n.lower() in t}
    found = pv.known_name_candidates(low, clean, "id").collect()
    assert hits <= {(r["id"], r["name"]) for r in found} and len(found) <= 3 * len(hits)
    got = {(r["id"], n) for r in pv.known_name_hits(docs, rows("name string", *[(n,) for n in names]), "id", "text").collect() for n in r["names"]}
    assert got == hits and len(hits) == 90


def test_known_names_at_every_place_and_length(rows):
    """Names of all lengths, at all offsets, inside words, at both ends, overlapping."""
    import random

    draw = random.Random(11)
    word = lambda n: "".join(draw.choice("abÉ -.") for _ in range(n))
    names = [word(n) for n in (3, 4, 5, 6, 7, 8, 9, 12, 14, 15, 16, 17, 23, 40) for _ in range(3)]
    texts = [word(draw.randrange(0, 12)) + draw.choice(names) + word(draw.randrange(0, 30)) + draw.choice(names).upper() for _ in range(300)]
    got = {(r["id"], n) for r in pv.known_name_hits(rows("id long, t string", *enumerate(texts)), rows("a string, b string", *zip(names[::2], names[1::2])), "id", "t").collect() for n in r["names"]}
    clean = {n.strip().lower() for n in names if len(n.strip()) >= 3}
    assert got == {(i, n) for i, t in enumerate(texts) for n in clean if n in t.lower()}


def test_extract_block_spreads_one_giant_sheet(spark, rows):
    from concordat.sources import grids as gr

    cells = spark.range(1, 60_001).selectExpr("'f' AS file", "'s' AS sheet", "cast(id AS int) AS row", "1 AS col", "CASE WHEN id = 10 THEN ' Marque ' ELSE 'v' END AS value")
    cells = cells.where("row <> 50010")
    block = gr.extract_block(cells, "marque")
    plan = block._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    got = [r["row"] for r in block.select("row").collect()]
    assert sorted(got) == list(range(11, 50_010))
    met = rows("file string, sheet string, row int, col int, value string", ("a", "s", 1, 1, "m"), ("a", "s", 3, 1, "x"), ("b", "s", 2, 1, "m"), ("b", "s", 3, 1, "x"), ("b", "s", 3, 2, "m"),
               ("b", "s", 4, 1, "y"), ("c", "s", 1, 1, "x"), ("d", None, 1, 1, "m"))
    assert sorted((r["file"], r["row"], r["col"]) for r in gr.extract_block(met, "M").collect()) == [("b", 3, 1), ("b", 3, 2), ("b", 4, 1)]


def test_pattern_table(spark, rows):
    import random

    from concordat.operators import filters as fl

    draw = random.Random(3)
    values = ["".join(draw.choice("abC9%_é") for _ in range(draw.randrange(0, 9))) for _ in range(400)] + [None]
    df = rows("c string, n int", *[(v, i) for i, v in enumerate(values * 2)])
    for _ in range(12):
        pats = ["".join(draw.choice(["a", "b", "C", "9", "%", "%", "_", "é", "\\\\%", "\\\\_"]) for _ in range(draw.randrange(1, 6))) for _ in range(draw.randrange(1, 8))]
        pats = [p.replace("\\\\", "\\") for p in pats] + draw.choice([[], ["NULL"], [" abC "]])
        got = fl.pattern_table_filter(df, "c", rows("p string", *[(p,) for p in pats])).collect()
        want = df.where(fl.matches_patterns(F.col("c"), ",".join(pats))).collect()
        assert sorted(map(str, got)) == sorted(map(str, want)), pats
    assert fl.pattern_table_filter(df, "c", rows("p string", ("toutes",))).count() == 802
    assert fl.pattern_table_filter(df, "c", rows("p string").where("false")).count() == 0


def test_ten_thousand_patterns_without_a_nested_loop(spark):
    from concordat.operators import filters as fl

    df = spark.range(20_000).selectExpr("concat('BOX', lpad(id, 8, '0'), 'Z') AS c")
    kinds = "CASE id % 5 WHEN 0 THEN concat('BOX', lpad(id, 8, '0'), 'Z') WHEN 1 THEN concat('BOX', lpad(id, 8, '0'), '%') WHEN 2 THEN concat('%', lpad(id, 8, '0'), 'Z') WHEN 3 THEN concat('%', lpad(id, 8, '0'), '%') ELSE concat('B_X', lpad(id, 8, '0'), '_') END"
    out = fl.pattern_table_filter(df, "c", spark.range(10_000).selectExpr(f"{kinds} AS p"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    # Cross joins only meet tables of one row.
    assert plan.count("BroadcastNestedLoopJoin") == 2 and "CartesianProduct" not in plan
    assert out.count() == 10_000


def test_exact_percentiles(spark, rows, monkeypatch):
    import numpy as np

    from concordat.operators import quantiles as qt

    draw = np.random.default_rng(7)
    data = {"a": draw.lognormal(3, 2, 30_000), "b": draw.integers(0, 5, 7000).astype(float), "c": np.array([4.0]), "d": np.array([1.0, 2.0]), "hot": np.append(np.full(20_000, 3.5), draw.random(9000))}
    df = spark.createDataFrame([(k, float(x)) for k, v in data.items() for x in v] + [("a", None), ("e", None)], "k string, v double")
    want = {k: (np.percentile(v, 50), np.percentile(v, 90), v.min()) for k, v in data.items()}

    def got():
        out = qt.exact_percentiles(df, "k", "v", {"m": 0.5, "p": 0.9, "least": 0.0})
        return {r["k"]: (r["m"], r["p"], r["least"]) for r in out.collect()}

    for k, x in got().items():
        assert np.allclose(x, want[k], rtol=1e-12, atol=0), k
    inside = qt.brackets(df.where("v is not null"), "k", "v", {"m": 0.5}).where("k = 'a'").first()
    assert ((data["a"] >= inside["low"]) & (data["a"] <= inside["high"])).mean() < 0.02
    # A bracket that misses its places is widened.
    monkeypatch.setattr(qt, "MARGIN", -0.01)
    for k, x in got().items():
        assert np.allclose(x, want[k], rtol=1e-12, atol=0), k


def test_similarity_bounds_enclose_the_measure(rows):
    import random
    from difflib import SequenceMatcher

    from concordat.operators import quality as ql
    from concordat.operators import similarity as sm

    draw = random.Random(5)
    name = lambda: "".join(draw.choice("ABCé- ") for _ in range(draw.randrange(0, 9)))
    pairs = [(name(), name(), name(), name()) for _ in range(300)] + [("", "", "", ""), ("DURAND", "DURANT", "ANNE", ""), ("A", "A", "B", "B")]
    df = rows("last_name string, last_norm string, first_name string, first_norm string", *pairs)
    low, high = sm.similarity_bounds(*map(F.col, ql._NAMES))
    for r in df.select(*ql._NAMES, low.alias("low"), high.alias("high")).collect():
        ratio = lambda a, b: SequenceMatcher(None, a, b).ratio()
        s = (ratio(r[0], r[1]) + (ratio(r[2], r[3]) if r[2] and r[3] else 1.0)) / 2
        assert r["low"] - 1e-9 <= s <= r["high"] + 1e-9, r
    want = {p for p in pairs if (SequenceMatcher(None, p[0], p[1]).ratio() + (SequenceMatcher(None, p[2], p[3]).ratio() if p[2] and p[3] else 1.0)) / 2 < 0.7}
    assert {tuple(r)[:4] for r in ql.divergent_names(df, 0.7).collect()} == want
    # Unlike names and names with a common beginning need no Python.
    clear = rows("last_name string, last_norm string, first_name string, first_norm string", *[(f"DURAND{i:04}", f"DURAND{i:04}X", "ANNE", "ANNE") for i in range(200)], *[(f"XYZ{i}", "BOUQUET", "LOU", "TIA") for i in range(200)])
    far, doubtful = ql.doubtful_names(clear, 0.7)
    assert far.count() == 200 and doubtful.count() == 0


def test_newest_attributes_read_one_partition(spark, tmp_path, rows):
    from concordat.sources import newest as nw

    schema = "flux_id string, person_id string, member_type string, offer string, company string, adhesion_date string, effect_date string, seq long"
    runs = ["31122023", "15012024", "01022024", "03022024"]
    data = [(r, str(p), f"T{r}{p}", "o", "c", "", "", p) for i, r in enumerate(runs) for p in range(i, 12, i + 1)] + [("01022024", "3", "second", "", "", "", "", 99), ("01022024", "", "none", "", "", "", "", 1)]
    snaps, state = str(tmp_path / "s"), str(tmp_path / "n")
    table = rows(schema, *data)
    st.write_snapshot(table, snaps)

    def want(current):
        day = lambda r: r[4:] + r[2:4] + r[:2]
        return sorted(map(str, lk.historical_lookup(table.where(F.col("flux_id").isin([r for r in runs if day(r) < day(current)]))).collect()))

    def found(current):
        return sorted(map(str, nw.newest_before(spark, state, current).collect()))

    nw.bootstrap(spark, snaps, state, runs[0])
    assert nw.advance(spark, snaps, state, runs[2]) == [runs[2]]
    # A late run is entered in its place and later partitions follow.
    assert nw.advance(spark, snaps, state, runs[1]) == [runs[1], runs[2]]
    nw.advance(spark, snaps, state, runs[3])
    for current in (*runs[1:], "01012030"):
        assert found(current) == want(current)
    assert found("01012000") == []
    plan = nw.merged(spark, snaps, state, runs[3], runs[2])._jdf.queryExecution().executedPlan().toString()
    filters = [x for x in plan.split("PartitionFilters: ")[1:]]
    assert len(filters) >= 2 and all(x.startswith("[isnotnull(flux_id") and f"= {runs[3]}" in x[:90] or f"= {runs[2]}" in x[:90] for x in filters)
    current = rows(schema, *[d for d in data if d[0] == runs[3]])
    ledger = rows("source_file string, person_id string, member_type string, offer string, company string, adhesion_date string, effect_date string, eligible string, card_value string",
                  *[("03022024_KO.csv", str(p), "", "", "", "", "", "", "") for p in range(12)])
    full = lk.attribute_by_source_priority(ledger, table, runs[3])
    short = lk.attribute_by_source_priority(ledger, current, runs[3], nw.newest_before(spark, state, runs[3]))
    assert sorted(map(str, full.collect())) == sorted(map(str, short.collect()))


def test_redact_text(rows):
    text = "a@b.fr 06 12 34 56 78 et +33 6.12.34.56.78, NomDUPONTPrénomJean-Marie KPEP1234567890 nir 1 85 05 78 006 084 36"
    got = rows("t string", (text,)).select(pv.redact_text(F.col("t"))).first()[0]
    assert "a@b.fr" not in got and "DUPONT" not in got and "Jean" not in got and "1234567890" not in got and "06 12" not in got
    assert got.startswith("[EMAIL] [TEL] et") and "Nom[NOM]Prénom[PRENOM] KPEP[CLE]" in got and "[NIR]" in got


def test_flatten_payload(rows):
    doc = '{"a": {"b": 1, "c": [1, 2, null], "d": [{"e": "x"}, {"e": null}]}, "f": "txt", "g": {}}'
    got = {r["path"]: r["value"] for r in st.flatten_payload(rows("id long, p string", (1, doc)), "p", ["id"]).collect()}
    assert got["a › b"] == "1" and got["a › c"] == "1, 2, " and got["a › d [0] › e"] == "x" and got["a › d [1] › e"] is None and got["f"] == "txt"


def test_flatten_payload_however_deep(rows):
    deep = "".join('{"k%d": ' % i for i in range(12)) + '"{[ \\" text"' + "}" * 12
    got = st.flatten_payload(rows("id long, p string", (1, deep), (2, None), (3, '{"a": [[1, 2], {"b": [3]}]}')), "p", ["id"]).collect()
    found = {(r["id"], r["path"]): r["value"] for r in got}
    assert found[1, " › ".join(f"k{i}" for i in range(12))] == '{[ " text'
    assert found[3, "a [0]"] == "1, 2" and found[3, "a [1] › b"] == "3"


def test_flatten_payload_runs_no_job_and_keeps_texts(spark, rows):
    docs = rows("id long, p string", (1, '{"a": 1.50, "b": true, "c": [], "d": {}, "e": "{\\"x\\": 1}", "f": [null, 2e3], "g": null}'), (2, "plain"), (3, "{broken"), (4, "[[1], 2]"), (5, ""))
    sc = spark.sparkContext
    sc.setJobGroup("flatten-plan", "")
    out = st.flatten_payload(docs, "p", ["id"])
    assert not sc.statusTracker().getJobIdsForGroup("flatten-plan")
    sc.setLocalProperty("spark.jobGroup.id", None)
    got = {(r["id"], r["path"]): r["value"] for r in out.collect()}
    assert got == {(1, "a"): "1.50", (1, "b"): "true", (1, "c"): "", (1, "e"): '{"x": 1}', (1, "f"): ", 2e3", (1, "g"): None, (2, ""): "plain", (3, ""): "{broken", (4, " [0]"): "1", (4, " [1]"): "2", (5, ""): ""}


def test_kpi_series_parses_once(rows):
    from concordat.plans import supervision as sv

    h = rows("flux_id string, date_import string, payload string", ("01012024", "", '{"a b": {"c": 12.50, "d": "7", "e": "x", "f": null}}'), ("02012024", "", "{bad"), ("03012024", "", None))
    paths = {k: ("a b", k) for k in "cdefg"}
    got = {(r["flux_id"], r["kpi"]): r["value"] for r in sv.kpi_series(h, paths).collect()}
    assert {k: v for k, v in got.items() if v is not None} == {("01012024", "c"): 12.5, ("01012024", "d"): 7.0} and len(got) == 15
    plan = sv.kpi_series(h, paths)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parse_json") + plan.lower().count("parsejson") <= 2


def test_tracking_does_not_depend_on_batches(spark, tmp_path):
    from concordat.streaming import tracking as tr

    arrivals = [
        ("02022024", "FOUND", "A", None), ("02022024", "ELIGIBLE", "A", "r1"), ("02022024", "ELIGIBLE", "B", None), ("02022024", "ELIGIBLE", "B", "r2"),
        ("01012024", "ELIGIBLE", "A", "old"), ("01012024", "ELIGIBLE", "C", None), ("03032024", "FOUND", "B", None), ("01012024", "FOUND", "D", None),
        ("03032024", "ELIGIBLE", "D", "late"), ("03032024", "ELIGIBLE", "C", None), ("04042024", "FOUND", "C", None), ("04042024", "ELIGIBLE", "C", "r9"),
    ]
    seen = []
    for n, order in ((100, 1), (1, 1), (1, -1)):
        base = str(tmp_path / f"{n}{order}")
        for row in arrivals[::order]:
            spark.createDataFrame([row], tr.ARRIVAL).coalesce(1).write.mode("append").parquet(base + "/in")
        tr.incremental_tracking(spark, base + "/in", base + "/table", base + "/ckpt", "2024-05-01", files_per_batch=n)
        seen.append(sorted(map(str, tr.tracking_table(spark, base + "/table").collect())))
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == 9


def test_tracking_writes_once_a_batch(spark, tmp_path, monkeypatch):
    """Many runs in one batch are one write, and untouched runs keep their files."""
    from concordat.streaming import tracking as tr

    table, writes = str(tmp_path / "table"), []
    plain = st.write_snapshot
    monkeypatch.setattr(tr.state, "write_snapshot", lambda df, path, **kw: (writes.append(path), plain(df, path, **kw)))

    def arrive(*rows):
        tr.apply_arrivals(spark.createDataFrame(list(rows), tr.ARRIVAL), table, "2024-05-01")
        return {(r["flux_id"], r["kpep"]): (r["date_found"] is not None, r["motif"]) for r in tr.tracking_table(spark, table).collect()}

    months = [f"01{m:02}2024" for m in range(1, 13)]
    got = arrive(*[(m, "ELIGIBLE", f"K{i}", None) for i, m in enumerate(months)], ("01062024", "FOUND", " K2 ", None), ("01062024", "FOUND", " ", None))
    assert len(writes) == 1 and got[months[2], "K2"] == (True, None) and got["01062024", "K2"] == (True, None) and len(got) == 13
    before = {p.parent.name: p.name for p in (tmp_path / "table").rglob("*.parquet")}
    got = arrive(("01022024", "ELIGIBLE", "K2", "tard"), ("01122024", "FOUND", "K5", None))
    after = {p.parent.name: p.name for p in (tmp_path / "table").rglob("*.parquet")}
    assert len(writes) == 2 and got["01022024", "K2"] == (True, "tard") and got[months[5], "K5"][0] and not got[months[7], "K7"][0]
    changed = {k for k in before if before[k] != after[k]}
    assert changed == {"flux_id=01022024", "flux_id=01062024", "flux_id=01122024"}


def test_history_lookup_newest_wins(rows):
    snap = rows("flux_id string, person_id string, member_type string, offer string, company string, adhesion_date string, effect_date string, seq long",
                ("31012024", "1", "OLD", "", "", "", "", 1), ("01022024", "1", "NEW", "", "", "", "", 9), ("01022024", "1", "NEW2", "", "", "", "", 5), ("01032024", "1", "CUR", "", "", "", "", 1))
    assert [r["member_type"] for r in lk.historical_lookup(snap, "01032024").collect()] == ["NEW2"]
