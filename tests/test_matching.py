"""The cascade on hand-made people, against a plain reading of its rules."""

import itertools
import random

from pyspark.sql import functions as F

from concordat.operators import matching as mt
from concordat.operators import normalize as nz

MEMBER = (
    "num_personne string, num_ctr_indiv string, type_assure string, nom_long string, prenom string, date_naissance string, "
    "mailciam string, valeur_coordonnee string, idkpep string, seq long"
)
ACCOUNT = "id string, realm_id string, idkpep string, email string, email_other string, last_name string, first_name string, birthdate string, seq long"


def people():
    rng = random.Random(7)
    mails = [f"m{i}@x.fr" for i in range(60)]
    rows = []
    for i in range(160):
        pid = str(i % 90)
        rows.append((
            pid, f"c{i}", "ASSPRI", rng.choice(["Dupré", "Martin", "Noël", None]), rng.choice(["Léa", "Jean", ""]),
            rng.choice(["1980-01-02", "03/04/1990", "", None]), rng.choice([None, "NULL", rng.choice(mails), rng.choice(mails).upper()]),
            rng.choice([None, "0612345678", f"{rng.choice(mails)}; {rng.choice(mails)}"]), rng.choice([None, "NULL", f"KPEP{rng.randrange(40)}"]), i,
        ))
    return rows


def directory(prefix, seed, n=14):
    rng = random.Random(seed)
    return [
        (f"{prefix}{rng.randrange(10)}", rng.choice(["010", "044"]), rng.choice([None, "", f"KPEP{rng.randrange(9)}"]), rng.choice([None, f"M{rng.randrange(14)}@x.fr"]),
         rng.choice([None, f"m{rng.randrange(14)}@x.fr"]), rng.choice(["DUPRE", "Martin", "Jean"]), rng.choice(["Lea", "Jean", "Martin"]),
         rng.choice(["1980-01-02", "1990-04-03"]), i)
        for i in range(n)
    ]


def expected(spark, member, accounts, last, middle):
    """Straight reading of the rules on collected rows."""
    acc = sorted((r.asDict() for r in accounts.collect()), key=lambda r: (r["src_rank"], r["seq"]))
    index = {"EMAIL": {}, "KPEP": {}, "IDENTITY": {}, "LAST": {}, "MIDDLE": {}}
    for field in ("email", "email_other"):
        for r in acc:
            if r[field]:
                index["EMAIL"].setdefault(r[field], r["id"])
    for r in acc:
        if r["idkpep"]:
            index["KPEP"].setdefault(r["idkpep"], r["id"])
        if r["identity"]:
            index["IDENTITY"].setdefault(r["identity"], r["id"])
    for group, df in (("LAST", last), ("MIDDLE", middle)):
        for r in sorted((x.asDict() for x in df.collect()), key=lambda r: r["seq"]):
            if r["name_birth"]:
                index[group].setdefault(r["name_birth"], r["id"])
    out = {}
    for pid, group in itertools.groupby(sorted((r.asDict() for r in member.collect()), key=lambda r: r["person_id"]), key=lambda r: r["person_id"]):
        rows = list(group)
        def split(v):
            return [x.strip() for x in v.split(";") if x.strip()]
        full = {f"{r['last_name']}|{r['first_name']}|{r['birth_date']}" for r in rows if r["last_name"] and r["first_name"] and r["birth_date"]}
        inv = {f"{r['first_name']}|{r['last_name']}|{r['birth_date']}" for r in rows if r["last_name"] and r["first_name"] and r["birth_date"]}
        nb = {f"{r['last_name']}|{r['birth_date']}" for r in rows if r["last_name"] and r["birth_date"]}
        steps = [
            ("Mail_CIAM", "EMAIL", {e for r in rows for e in split(r["email"])}), ("Valeur_Coord", "EMAIL", {e for r in rows for e in split(r["contact_email"])}),
            ("KPEP", "KPEP", {r["kpep"] for r in rows} - {"", "NULL", "null"}), ("Nom_Prenom_DDN", "IDENTITY", full), ("Identite_Inversee", "IDENTITY", inv),
            ("Recherche_Large_Nom", "LAST", nb), ("Recherche_Large_Middle", "MIDDLE", nb),
        ]
        out[pid] = ("NON_RAPPROCHE", "", None, None)
        for method, grp, keys in steps:
            hit = next((k for k in sorted(keys) if k in index[grp]), None)
            if hit:
                out[pid] = ("RAPPROCHE", method, index[grp][hit], hit)
                break
    return out


def test_cascade_matches_rules_and_ignores_row_order(spark, rows):
    ck, cm = directory("a", 1), directory("a", 2)
    last, middle = directory("l", 3, 4), directory("m", 4, 6)
    member = nz.normalize_member(rows(MEMBER, *people()))
    accounts = nz.normalize_account(rows(ACCOUNT, *ck), rows(ACCOUNT, *cm))
    la, mi = nz.normalize_search(rows(ACCOUNT, *last), "LAST", 3), nz.normalize_search(rows(ACCOUNT, *middle), "MIDDLE", 4)
    got = {r["person_id"]: tuple(r)[1:] for r in mt.match_cascade(member, accounts, la, mi).collect()}
    assert got == expected(spark, member, accounts, la, mi)
    assert len({v[1] for v in got.values()}) >= 4
    shuffled = people()
    random.Random(3).shuffle(shuffled)
    again = mt.match_cascade(nz.normalize_member(rows(MEMBER, *shuffled)), accounts, la, mi)
    assert {r["person_id"]: tuple(r)[1:] for r in again.collect()} == got


def test_blank_person_is_left_out(rows):
    member = nz.normalize_member(rows(MEMBER, (None, "c", "ASSPRI", "A", "B", "1990-01-01", "a@b.fr", None, None, 1)))
    accounts = nz.normalize_account(rows(ACCOUNT, ("a", "r", "", "a@b.fr", None, "A", "B", "1990-01-01", 1)))
    assert mt.match_cascade(member, accounts).count() == 0


def test_hot_key_is_split(spark, rows):
    """A key held by a third of all rows joins through a skew-aware plan."""
    from concordat.operators.common import lookup_join

    keep = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
                                                 "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor")}
    try:
        for k, v in zip(keep, ("-1", "200KB", "100KB", "2")):
            spark.conf.set(k, v)
        left = spark.range(0, 1_000_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 10000).alias("k"), "id")
        right = spark.range(0, 20000, 1, 4).groupBy((F.col("id") % 10000).alias("k")).agg(F.min("id").alias("m"))
        out = lookup_join(left, right, ["k"]).groupBy((F.col("id") % 7).alias("z")).agg(F.sum("m"), F.count("*").alias("n"))
        assert sum(r["n"] for r in out.collect()) == 1_000_000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in keep.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_no_candidate_key_is_shared_by_everyone(spark):
    """Persons without keys stay in the result, and no key of the join has a row for each of them."""
    from concordat.operators import matching as mt

    fields = "person_id string, email string, contact_email string, kpep string, last_name string, first_name string, birth_date string"
    people = spark.range(500).select(F.col("id").cast("string").alias("person_id"), *[F.lit(None).cast("string").alias(c.split()[0]) for c in fields.split(", ")[1:]])
    keys = mt.candidate_keys(people)
    assert keys.groupBy("grp", "key").count().agg(F.max("count")).first()[0] == 1
    assert keys.select("person_id").distinct().count() == 500
