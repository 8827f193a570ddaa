"""Person to account matching: ordered keys, first hit wins."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.functions import extract_emails, identity_key
from concordat.operators.common import first_row, lookup_join

# Method names in cascade order.
METHODS = {
    1: "Mail_CIAM",
    2: "Valeur_Coord",
    3: "KPEP",
    4: "Nom_Prenom_DDN",
    5: "Identite_Inversee",
    6: "Recherche_Large_Nom",
    7: "Recherche_Large_Middle",
}
MATCHED, UNMATCHED = "RAPPROCHE", "NON_RAPPROCHE"
_NO_STEP = 99


def is_real_kpep(col):
    """A key that is neither blank nor the literal NULL."""
    return ~F.coalesce(col, F.lit("")).isin("", "NULL", "null")


def _key(step: int, group: str, value):
    return F.struct(F.lit(step).alias("step"), F.lit(group).alias("grp"), value.alias("key"))


def candidate_keys(member: DataFrame) -> DataFrame:
    """``(person_id, step, grp, key)`` rows, one for each key of a contract row.

    Blank keys are dropped here, before any join.  Only a contract row without
    any key gives a row of step 99, whose key is the person itself: the person
    stays in the result and missing values never form a hot key.  A key may
    come again with another contract row of the person.
    """
    columns, keys = _candidate_expressions()
    rows = member.where("coalesce(person_id, '') <> ''").select(*columns)
    return rows.select("person_id", keys)


@lru_cache
def _candidate_expressions():
    last, first, birth = F.col("last_name"), F.col("first_name"), F.col("birth_date")
    columns = (
        F.col("person_id"),
        extract_emails(F.col("email")).alias("mails"),
        extract_emails(F.col("contact_email")).alias("contacts"),
        F.when(is_real_kpep(F.col("kpep")), F.col("kpep")).alias("kpep"),
        identity_key(last, first, birth).alias("direct"),
        identity_key(first, last, birth).alias("inverted"),
        identity_key(last, birth).alias("name_birth"),
    )
    keys = F.concat(
        F.transform("mails", lambda v: _key(1, "EMAIL", v)),
        F.transform("contacts", lambda v: _key(2, "EMAIL", v)),
        F.array(
            _key(3, "KPEP", F.col("kpep")),
            _key(4, "IDENTITY", F.col("direct")),
            _key(5, "IDENTITY", F.col("inverted")),
            _key(6, "LAST", F.col("name_birth")),
            _key(7, "MIDDLE", F.col("name_birth")),
        ),
    )
    filled = F.filter(keys, lambda k: k["key"].isNotNull())
    return columns, F.inline(F.when(F.size(filled) > 0, filled).otherwise(F.array(_key(_NO_STEP, "-", F.col("person_id")))))


def _entry(group: str, part: int, value):
    return F.struct(F.lit(group).alias("grp"), F.lit(part).alias("part"), value.alias("key"))


def account_entries(accounts: DataFrame, *groups: str) -> DataFrame:
    """Every ``(grp, key)`` an account can be found by, from one pass over the accounts.

    Groups: EMAIL (main addresses come before other ones), KPEP, IDENTITY, and
    LAST or MIDDLE for the accounts of a name search.
    """
    columns, entries = _entry_expressions(groups)
    rows = accounts.select(*columns)
    return rows.select("src_rank", "seq", "id", entries).where("coalesce(key, '') <> ''")


@lru_cache
def _entry_expressions(groups: tuple[str, ...]):
    mails = [extract_emails(F.col(c)).alias(c) for c in ("email", "email_other")] if "EMAIL" in groups else []
    columns = [F.col(c) for c in ("src_rank", "seq", "id", "idkpep", "identity", "name_birth")] + mails
    single = {"KPEP": "idkpep", "IDENTITY": "identity", "LAST": "name_birth", "MIDDLE": "name_birth"}
    entries = [F.array(*[_entry(g, 1, F.col(c)) for g, c in single.items() if g in groups])] if set(groups) & set(single) else []
    if "EMAIL" in groups:
        entries.append(F.transform("email", lambda v: _entry("EMAIL", 1, v)))
        entries.append(F.transform("email_other", lambda v: _entry("EMAIL", 2, v)))
    return columns, F.inline(F.concat(*entries))


_ENTRY_ORDER = ("part", "src_rank", "seq", "id")


def email_entries(accounts: DataFrame) -> DataFrame:
    """Every e-mail of every account."""
    return account_entries(accounts, "EMAIL").drop("grp").withColumnRenamed("key", "email")


def email_index(accounts: DataFrame) -> DataFrame:
    """First account of every e-mail."""
    return first_row(email_entries(accounts), ["email"], [F.col(c) for c in _ENTRY_ORDER]).select("email", "id")


def account_index(accounts: DataFrame, last: DataFrame | None = None, middle: DataFrame | None = None) -> DataFrame:
    """First account of every ``(grp, key)``."""
    index = account_entries(accounts, "EMAIL", "KPEP", "IDENTITY")
    for search, group in ((last, "LAST"), (middle, "MIDDLE")):
        if search is not None:
            index = index.unionByName(account_entries(search, group))
    best = first_row(index, ["grp", "key"], [F.col(c) for c in _ENTRY_ORDER])
    return best.select("grp", "key", F.col("id").alias("account_id"))


def match_cascade(
    member: DataFrame, accounts: DataFrame, last: DataFrame | None = None, middle: DataFrame | None = None
) -> DataFrame:
    """One row per person: status, method, account and the key that hit.

    Steps are tried in order; within a step keys are tried in sorted order; a
    key stands for its first account.  Expressed as the minimum of
    ``(step, key)`` over all hits, so no list of keys is ever held per person.
    """
    hits = lookup_join(candidate_keys(member), account_index(accounts, last, middle), ["grp", "key"])
    best = F.min(F.when(F.col("account_id").isNotNull(), F.struct("step", "key", "account_id")))
    per_person = hits.groupBy("person_id").agg(best.alias("hit"))
    names = F.create_map(*[F.lit(x) for pair in METHODS.items() for x in pair])
    return per_person.select(
        "person_id",
        F.when(F.col("hit").isNotNull(), MATCHED).otherwise(UNMATCHED).alias("match_status"),
        F.coalesce(names[F.col("hit.step")], F.lit("")).alias("match_method"),
        F.col("hit.account_id").alias("matched_id"),
        F.col("hit.key").alias("matched_key"),
    )


def person_view(member: DataFrame) -> DataFrame:
    """One row per person with sorted arrays of distinct candidate keys."""
    names = {1: "emails_ciam", 2: "emails_val", 3: "kpeps", 4: "ident_full", 5: "ident_inv", 6: "nom_ddn"}
    keys = candidate_keys(member)
    return keys.groupBy("person_id").agg(
        *[
            F.array_sort(F.collect_set(F.when(F.col("step") == step, F.col("key")))).alias(name)
            for step, name in names.items()
        ]
    )


def match_propagate(member: DataFrame, match: DataFrame, *sources: DataFrame) -> DataFrame:
    """Spread the person's match over the contract rows, with account attributes.

    ``sources`` are account frames in order of preference; the first source
    holding an id gives its attributes.
    """
    wanted = (
        "raw_last_name middlename raw_first_name raw_birthdate idkpep email email_other phonenumber".split()
    )
    ref = None
    for rank, source in enumerate(sources):
        part = source.select(F.lit(rank).alias("__part"), "src_rank", "seq", "id", *wanted)
        ref = part if ref is None else ref.unionByName(part)
    ref = first_row(ref, ["id"], [F.col("__part"), F.col("src_rank"), F.col("seq")])
    ref = ref.select(F.col("id").alias("matched_id"), *[F.col(c).alias("acc_" + c.replace("raw_", "")) for c in wanted])
    enriched = lookup_join(match, ref, ["matched_id"])
    rows = lookup_join(member, enriched, ["person_id"])
    for name in ref.columns[1:]:
        value = F.coalesce(F.btrim(F.col(name)), F.lit(""))
        rows = rows.withColumn(name, F.when(F.lower(value).isin("nan", "none", "null"), "").otherwise(value))
    return rows


def unmatched_remainder(member: DataFrame, mail_account: DataFrame, key_account: DataFrame) -> DataFrame:
    """Search pairs of people found neither by e-mail nor by key.

    Returns distinct ``(search, value_a, value_b)`` rows: last name and birth
    date, last name and first name.  When a snapshot has no middle name column
    the last name stands in for it, so the middle searches use the same pairs.
    """
    mails = mail_account.select(F.col("email").alias("v")).where("v <> ''").distinct()
    keys = key_account.select(F.col("idkpep").alias("v")).where("v <> ''").distinct()
    rest = lookup_join(member.withColumn("v", F.col("email")), mails, ["v"], "left_anti")
    rest = lookup_join(rest.withColumn("v", F.col("contact_email")), mails, ["v"], "left_anti")
    rest = lookup_join(rest.withColumn("v", F.col("kpep")), keys, ["v"], "left_anti")

    def pair(name: str, a: str, b: str):
        return F.struct(F.lit(name).alias("search"), F.col(a).alias("value_a"), F.col(b).alias("value_b"))

    pairs = F.array(
        pair("LAST_DATE", "last_name", "birth_date"),
        pair("LAST_FIRST", "last_name", "first_name"),
        pair("MIDDLE_DATE", "last_name", "birth_date"),
        pair("MIDDLE_FIRST", "last_name", "first_name"),
    )
    return rest.select(F.inline(pairs)).where("value_a <> '' and value_b <> ''").distinct()
