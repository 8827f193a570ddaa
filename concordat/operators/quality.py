"""Data quality rules and indicators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordat.functions import (
    email_domain,
    extract_emails,
    is_risky_domain,
    is_valid_email,
    normalize_email,
    origin_class,
    pct2,
    squeeze,
)
from concordat.operators.card import card_scope, person_card
from concordat.operators.common import any_where, count_where, facts, first_row, lookup_join, views
from concordat.operators.matching import MATCHED, candidate_keys, is_real_kpep
from concordat.operators.normalize import UNKNOWN_COMPANY, is_insured, is_spouse
from concordat.operators.registry import registry_presence
from concordat.operators.similarity import name_similarity, similarity_bounds
from concordat.operators.windows import top_n_per_dim
from concordat.session import materialize

# Fixed value: birth date of accounts created without a real one.
PLACEHOLDER_BIRTH = "1900-01-01"


def quality_flag() -> Column:
    """``OK`` or ``KO: reason; reason`` of a propagated contract row."""
    own, theirs = F.upper(F.col("kpep")), F.upper(F.col("acc_idkpep"))
    mail = F.lower(F.col("acc_email"))
    filled = mail != ""
    reasons = F.concat_ws(
        "; ",
        F.when(F.col("birth_date") == PLACEHOLDER_BIRTH, "DDN prospect (NS)"),
        F.when(F.col("acc_birthdate") == PLACEHOLDER_BIRTH, "DDN prospect (CIAM)"),
        F.when((own != "") & (theirs != "") & (own != theirs), "KPEP NS≠CIAM"),
        F.when(filled & ~is_valid_email(mail), "Email CIAM invalide").when(
            filled & is_risky_domain(email_domain(mail)), "Email CIAM risque"
        ),
    )
    reasons = F.when(F.coalesce(F.col("match_status") == MATCHED, F.lit(False)), reasons).otherwise("Non rapproché")
    return F.when(reasons == "", "OK").otherwise(F.concat(F.lit("KO: "), reasons))


def email_shown() -> Column:
    """Account e-mail of a propagated row when it equals the contact e-mail."""
    mail = F.lower(squeeze(F.col("acc_email")))
    same = (F.col("match_status") == MATCHED) & (mail != "") & (mail == F.col("contact_email"))
    return F.when(same, mail).otherwise("")


# ---- volumes and persons ------------------------------------------------------


def volume_raw(member: DataFrame) -> DataFrame:
    """Rows, insured rows and spouse rows."""
    row = member.agg(
        F.count("*").alias("lignes"),
        count_where(is_insured(F.col("member_type"))).alias("assures"),
        count_where(is_spouse(F.col("member_type"))).alias("conjoints"),
    )
    return facts(row, {"lignes": "lignes", "assures": "assures", "conjoints": "conjoints"})


def person_roles(member: DataFrame) -> DataFrame:
    """Rows per person: all, insured and spouse."""
    return (
        member.where(F.coalesce("person_id", F.lit("")) != "")
        .groupBy("person_id")
        .agg(
            F.count("*").alias("lignes"),
            count_where(is_insured(F.col("member_type"))).alias("lignes_assure"),
            count_where(is_spouse(F.col("member_type"))).alias("lignes_conjoint"),
        )
    )


def population_unique(member: DataFrame) -> DataFrame:
    """Distinct persons (all, insured, spouse) and distinct contracts."""
    row = person_roles(member).agg(
        F.count("*").alias("personnes"),
        count_where(F.col("lignes_assure") > 0).alias("assures"),
        count_where(F.col("lignes_conjoint") > 0).alias("conjoints"),
    )
    contracts = member.agg(F.countDistinct("contract_id").alias("contrats"))
    return facts(row, {"personnes": "personnes", "assures": "assures", "conjoints": "conjoints"}).unionByName(
        facts(contracts, {"contrats": "contrats"})
    )


def cross_role_ids(member: DataFrame) -> DataFrame:
    """Persons both insured and spouse, and persons on several rows of one role."""
    row = person_roles(member).agg(
        count_where((F.col("lignes_assure") > 0) & (F.col("lignes_conjoint") > 0)).alias("assure_et_conjoint"),
        count_where(F.col("lignes_assure") > 1).alias("assures_multi"),
        count_where(F.col("lignes_conjoint") > 1).alias("conjoints_multi"),
    )
    return facts(row, {c: c for c in ("assure_et_conjoint", "assures_multi", "conjoints_multi")})


def duplicate_contracts(insured: DataFrame) -> DataFrame:
    """Persons with several contracts on the same or on different offers, in total and by type.

    "Several distinct values" is a minimum below the maximum, so no distinct
    count is needed; the set of types of a person is bounded by the scope.
    """
    spans = [F.min("contract_id").alias("c0"), F.max("contract_id").alias("c1"), F.min("offer").alias("o0"), F.max("offer").alias("o1")]
    per_person = (
        insured.where(F.coalesce("person_id", F.lit("")) != "")
        .groupBy("person_id")
        .agg(*spans, F.collect_set("member_type").alias("types"))
        .where("c0 < c1")
    )
    kind = F.when(F.col("o0") == F.col("o1"), "MEME_OFFRE").otherwise("DIFF_OFFRE")
    labels = F.concat(F.array(F.lit("(tous)")), F.col("types"))
    return (
        per_person.select(kind.alias("kind"), F.explode(labels).alias("member_type"))
        .groupBy("kind", "member_type")
        .agg(F.count("*").alias("persons"))
    )


def multi_key_persons(member: DataFrame) -> DataFrame:
    """Persons with 2, 3 or more keys, and how many of them are insured."""
    pairs = (
        member.where(F.coalesce("person_id", F.lit("")) != "")
        .groupBy("person_id", "kpep")
        .agg(any_where(is_insured(F.col("member_type"))).alias("insured"))
    )
    per_person = pairs.groupBy("person_id").agg(
        count_where(F.col("kpep") != "").alias("keys"), any_where(F.col("insured")).alias("insured")
    )
    bucket = F.when(F.col("keys") == 2, "2_kpep").when(F.col("keys") == 3, "3_kpep").otherwise("plus_3_kpep")
    return (
        per_person.where("keys > 1")
        .groupBy(bucket.alias("bucket"))
        .agg(F.count("*").alias("total"), count_where(F.col("insured")).alias("insured"))
    )


# ---- completeness -------------------------------------------------------------


def completeness_contacts(sources: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    """NULL, empty and filled counts per source and raw column."""
    out = None
    for name, df in sources.items():
        classes = [origin_class(F.col(c)) for c in columns]
        aggs = [
            F.struct(
                F.lit(c).alias("column"),
                count_where(k == "NULL").alias("n_null"),
                count_where(k == "VIDE").alias("n_empty"),
                count_where(k == "REMPLI").alias("n_filled"),
            )
            for c, k in zip(columns, classes)
        ]
        part = df.agg(F.array(*aggs).alias("a")).select(F.lit(name).alias("source"), F.inline("a"))
        out = part if out is None else out.unionByName(part)
    return out


def completeness_keys(insured: DataFrame) -> DataFrame:
    """Persons with an e-mail, a key, a full identity, any of them, or none."""
    has_mail = (F.size(extract_emails(F.col("email"))) > 0) | (F.size(extract_emails(F.col("contact_email"))) > 0)
    full = (F.col("last_name") != "") & (F.col("first_name") != "") & (F.col("birth_date") != "")
    per_person = (
        insured.where(F.coalesce("person_id", F.lit("")) != "")
        .select("person_id", has_mail.alias("m"), is_real_kpep(F.col("kpep")).alias("k"), full.alias("i"))
        .groupBy("person_id")
        .agg(any_where(F.col("m")).alias("m"), any_where(F.col("k")).alias("k"), any_where(F.col("i")).alias("i"))
    )
    anything = F.col("m") | F.col("k") | F.col("i")
    row = per_person.agg(
        F.count("*").alias("n"),
        count_where(anything).alias("avec_cle"),
        count_where(~anything).alias("sans_cle"),
        count_where(F.col("m")).alias("avec_email"),
        count_where(F.col("k")).alias("avec_kpep"),
        count_where(F.col("i")).alias("avec_identite"),
    )
    names = ("avec_cle", "sans_cle", "avec_email", "avec_kpep", "avec_identite")
    return facts(row, {"population": "n", **{c: (c, "n") for c in names}})


# Fields whose filling is followed.
FOLLOWED_FIELDS = {
    "mailciam": "email",
    "idkpep": "kpep",
    "date_naissance": "birth_date",
    "nom": "last_name",
    "prenom": "first_name",
}


def completeness_fields(insured: DataFrame) -> DataFrame:
    """Filled rows and share per followed field."""
    row = insured.agg(
        F.count("*").alias("n"), *[count_where(F.col(c) != "").alias(name) for name, c in FOLLOWED_FIELDS.items()]
    )
    return facts(row, {name: (name, "n") for name in FOLLOWED_FIELDS})


def cancel_rate(member: DataFrame) -> DataFrame:
    """Rows with a cancellation date, over all rows and over insured rows."""
    cancelled, insured = F.col("cancel_date") != "", is_insured(F.col("member_type"))
    row = member.agg(
        F.count("*").alias("n"),
        count_where(insured).alias("ni"),
        count_where(cancelled).alias("r"),
        count_where(cancelled & insured).alias("ri"),
    )
    return facts(row, {"toute_population": ("r", "n"), "assures": ("ri", "ni")})


def email_consistency(member: DataFrame) -> DataFrame:
    """How the two e-mails of a contract row relate."""
    a, b = F.col("email"), F.col("contact_email")
    row = member.agg(
        F.count("*").alias("n"),
        count_where(a == b).alias("egaux"),
        count_where((a == b) & (a != "")).alias("vrais_egaux"),
        count_where(a != b).alias("differents"),
        count_where((a != "") & (b == "")).alias("ciam_seul"),
        count_where((a == "") & (b != "")).alias("coord_seule"),
        count_where((a != "") & (b != "") & (a != b)).alias("deux_distincts"),
        count_where(a == "").alias("ciam_vides"),
        count_where(b == "").alias("coord_vides"),
        count_where((a == "") & (b == "")).alias("deux_vides"),
    )
    names = [c for c in row.columns if c != "n"]
    return facts(row, {c: (c, "n") for c in names})


# ---- matching KPIs --------------------------------------------------------------


def match_totals(match: DataFrame) -> DataFrame:
    """Target, matched, unmatched and coverage; matched by method and by source file."""
    method = F.col("match_method")
    source = F.when(method == "Recherche_Large_Nom", "Fichier_Last").when(
        method == "Recherche_Large_Middle", "Fichier_Middle"
    ).otherwise("Standard_CK_CM")
    base = match.groupBy("match_status", "match_method").agg(F.count("*").alias("n"))
    hit = F.col("match_status") == MATCHED
    side = F.when(hit, F.col("n")).otherwise(0)

    def cell(view: str, label: Column, n: Column) -> Column:
        return F.struct(F.lit(view).alias("view"), label.alias("label"), n.cast("bigint").alias("n"))

    cells = F.array(
        cell("GLOBAL", F.lit("cible"), F.col("n")),
        cell("GLOBAL", F.lit("rapproches"), side),
        cell("GLOBAL", F.lit("non_rapproches"), F.col("n") - side),
        cell("METHODE", F.when(hit, method), F.col("n")),
        cell("SOURCE", F.when(hit, source), F.col("n")),
    )
    rows = base.select(F.inline(cells)).where("label is not null").groupBy("view", "label").agg(F.sum("n").alias("nombre"))
    # A dozen rows by now: the target is read from its neighbour row.
    target = F.max(F.when(F.col("label") == "cible", F.col("nombre"))).over(Window.partitionBy("view"))
    shared = (F.col("view") == "GLOBAL") & (F.col("label") != "cible")
    return rows.select("view", "label", "nombre", F.when(shared, pct2(F.col("nombre"), target)).alias("pct"))


def first_per_person(member: DataFrame, columns: list[str], unknown: str = UNKNOWN_COMPANY) -> DataFrame:
    """First known value of each column per person, in file order."""
    def first(c: str):
        known = F.col(c).isNotNull() & (F.col(c) != unknown)
        return F.coalesce(F.min_by(F.when(known, F.col(c)), F.when(known, F.col("seq"))), F.lit(unknown)).alias(c)

    return member.where(F.coalesce("person_id", F.lit("")) != "").groupBy("person_id").agg(*[first(c) for c in columns])


def match_by_segment(match: DataFrame, insured: DataFrame) -> DataFrame:
    """Totals and coverage by member type and by company."""
    rows = match.join(first_per_person(insured, ["member_type", "company"]), "person_id", "left")
    hit = F.col("match_status") == MATCHED
    base = rows.groupBy("member_type", "company").agg(F.count("*").alias("total"), count_where(hit).alias("rapproches"))
    labels = {"TYPE": F.coalesce("member_type", F.lit(UNKNOWN_COMPANY)), "SOCIETE": F.coalesce("company", F.lit(UNKNOWN_COMPANY))}
    return views(base, labels, ["total", "rapproches"]).select(
        "*", (F.col("total") - F.col("rapproches")).alias("non_rapproches"), pct2(F.col("rapproches"), F.col("total")).alias("taux")
    )


def match_method_by_company(match: DataFrame, insured: DataFrame) -> DataFrame:
    """Matched persons by method and company."""
    rows = match.where(F.col("match_status") == MATCHED).join(first_per_person(insured, ["company"]), "person_id", "left")
    return rows.groupBy("match_method", F.coalesce("company", F.lit(UNKNOWN_COMPANY)).alias("company")).agg(
        F.count("*").alias("persons")
    )


def unmatched_breakdown(insured: DataFrame, match: DataFrame, accounts: DataFrame) -> DataFrame:
    """Unmatched persons: no key at all, key present but not found, key or e-mail unknown to the directory."""
    lost = match.where(F.col("match_status") != MATCHED).select("person_id")
    keys = candidate_keys(lookup_join(insured, lost, ["person_id"], "left_semi"))
    key = F.when(F.col("grp") == "KPEP", F.upper("key")).otherwise(F.col("key"))
    known = accounts.select(
        F.inline(
            F.array(
                F.struct(F.lit("EMAIL").alias("grp"), F.col("email").alias("key")),
                F.struct(F.lit("EMAIL").alias("grp"), F.col("email_other").alias("key")),
                F.struct(
                    F.lit("KPEP").alias("grp"),
                    F.when(F.upper("idkpep").startswith("KPEP"), F.upper("idkpep")).otherwise("").alias("key"),
                ),
            )
        )
    ).where("key <> ''").distinct().withColumn("known", F.lit(True))
    rows = lookup_join(keys.withColumn("key", key), known, ["grp", "key"])
    mail, kpep = F.col("grp") == "EMAIL", F.col("grp") == "KPEP"
    seen = F.coalesce(F.col("known"), F.lit(False))
    per_person = rows.groupBy("person_id").agg(
        any_where(mail).alias("mail"),
        any_where(kpep).alias("kpep"),
        any_where(F.col("step") == 4).alias("ident"),
        any_where(mail & seen).alias("mail_known"),
        any_where(kpep & seen).alias("kpep_known"),
    )
    anything = F.col("mail") | F.col("kpep") | F.col("ident")
    row = per_person.agg(
        F.count("*").alias("n"),
        count_where(~anything).alias("aucune_cle"),
        count_where(anything).alias("cle_non_trouvee"),
        count_where(F.col("kpep") & ~F.col("kpep_known")).alias("kpep_absent"),
        count_where(F.col("mail") & ~F.col("mail_known")).alias("email_absent"),
    )
    names = ("aucune_cle", "cle_non_trouvee", "kpep_absent", "email_absent")
    return facts(row, {"non_rapproches": "n", **{c: (c, "n") for c in names}})


def matched_email_empty(insured: DataFrame, matched: DataFrame) -> DataFrame:
    """Matched persons with a contact e-mail but an empty account e-mail, or the same one."""
    account = matched.select("person_id", F.col("email").alias("acc_email"))
    rows = lookup_join(insured.select("person_id", extract_emails(F.col("contact_email")).alias("mails")), account, ["person_id"], "inner")
    per_person = rows.groupBy("person_id").agg(
        any_where((F.size("mails") > 0) & (F.coalesce("acc_email", F.lit("")) == "")).alias("empty"),
        any_where((F.coalesce("acc_email", F.lit("")) != "") & F.array_contains("mails", F.col("acc_email"))).alias("same"),
    )
    row = per_person.agg(F.count("*").alias("n"), count_where(F.col("empty")).alias("vides"), count_where(F.col("same")).alias("egaux"))
    return facts(row, {"email_compte_vide": ("vides", "n"), "email_compte_egal_contact": ("egaux", "n")})


def _kpep_facts(insured: DataFrame, matched: DataFrame) -> DataFrame:
    """Per matched person: has own keys, account key, and whether they agree (upper case)."""
    account = matched.select("person_id", F.coalesce("idkpep", F.lit("")).alias("acc_kpep"), "birth_iso", "email")
    own = insured.select("person_id", F.when(is_real_kpep(F.col("kpep")), F.col("kpep")).alias("kpep"))
    rows = lookup_join(own, account, ["person_id"], "inner")
    return rows.groupBy("person_id").agg(
        any_where(F.col("kpep").isNotNull()).alias("has_key"),
        # One account per person: any aggregate carries its attributes along.
        *[F.max(c).alias(c) for c in ("acc_kpep", "birth_iso", "email")],
        any_where(F.col("kpep") == F.col("acc_kpep")).alias("same"),
        any_where(F.upper("kpep") == F.upper("acc_kpep")).alias("same_upper"),
    )


def key_coherence_two(insured: DataFrame, matched: DataFrame) -> DataFrame:
    """Matched persons with a key: same key on the account, another one, or none."""
    rows = _kpep_facts(insured, matched).where("has_key")
    row = rows.agg(
        F.count("*").alias("n"),
        count_where(F.col("same") & (F.col("acc_kpep") != "")).alias("coherent"),
        count_where(~F.col("same") & (F.col("acc_kpep") != "")).alias("different"),
        count_where(F.col("acc_kpep") == "").alias("absent"),
    )
    return facts(row, {"base": "n", **{c: (c, "n") for c in ("coherent", "different", "absent")}})


def key_coherence_three(insured: DataFrame, matched: DataFrame, registry: DataFrame) -> DataFrame:
    """Agreement of the person key between snapshot, account and registry."""
    key = F.upper(squeeze(F.col("kpep_iehe")))
    reg = registry.where(key.startswith("KPEP")).groupBy(squeeze(F.col("refperboccn")).alias("person_id")).agg(
        F.min_by(key, F.col("seq")).alias("reg_kpep")
    )
    rows = _kpep_facts(insured, matched).join(reg, "person_id", "left")
    own, acc, third = F.col("has_key"), F.upper("acc_kpep"), F.coalesce("reg_kpep", F.lit(""))
    both, reg_both = own & (acc != ""), (third != "") & (acc != "")
    row = rows.agg(
        F.count("*").alias("n"),
        count_where(own).alias("ns_avec_kpep"),
        count_where(acc != "").alias("ciam_avec_kpep"),
        count_where(third != "").alias("iehe_avec_kpep"),
        count_where(both & F.col("same_upper")).alias("ns_egal_ciam"),
        count_where(both & ~F.col("same_upper")).alias("ns_different_ciam"),
        count_where(reg_both & (third == acc)).alias("iehe_egal_ciam"),
        count_where(reg_both & (third != acc)).alias("iehe_different_ciam"),
        count_where(both & reg_both & F.col("same_upper") & (third == acc)).alias("trois_egaux"),
    )
    return facts(row, {c: (c, "n") for c in row.columns if c != "n"})


def placeholder_births(account_ref: DataFrame, insured: DataFrame, matched: DataFrame) -> DataFrame:
    """Placeholder birth dates among accounts, insured rows and matched accounts."""
    parts = (
        ("comptes", account_ref, "birth_iso"),
        ("lignes_assures", insured, "birth_date"),
        ("rapproches", matched, "birth_iso"),
    )
    out = None
    for name, df, col in parts:
        row = df.agg(F.count("*").alias("n"), count_where(F.col(col) == PLACEHOLDER_BIRTH).alias("p"))
        part = facts(row, {name: ("p", "n")})
        out = part if out is None else out.unionByName(part)
    return out


def email_quality(sources: dict[str, DataFrame], top: int = 10) -> DataFrame:
    """Per source: e-mails, invalid ones, risky ones, and the most frequent domains.

    ``sources`` maps a label to a frame with one ``email`` column.  One
    aggregate by domain serves all four outputs.
    """
    rows = None
    for name, df in sources.items():
        part = df.select(F.lit(name).alias("source"), F.lower(squeeze(F.col("email"))).alias("email")).where("email <> ''")
        rows = part if rows is None else rows.unionByName(part)
    domain = email_domain(F.col("email"))
    base = rows.groupBy("source", domain.alias("domain"), is_valid_email(F.col("email")).alias("valid")).agg(F.count("*").alias("n"))
    bad, risky = ~F.col("valid"), is_risky_domain(F.col("domain"))
    totals = base.groupBy("source").agg(
        F.sum("n").alias("total"),
        F.sum(F.when(bad, F.col("n")).otherwise(0)).alias("invalides"),
        F.sum(F.when(risky, F.col("n")).otherwise(0)).alias("a_risque"),
    )
    counts = totals.select(
        "source",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit("TOTAL").alias("view"),
                        F.lit(c).alias("label"),
                        F.col(c).alias("nombre"),
                        pct2(F.col(c), F.col("total")).alias("pct"),
                    )
                    for c in ("total", "invalides", "a_risque")
                ]
            )
        ),
    )
    domains = base.where("domain <> ''").groupBy("source", "domain").agg(F.sum("n").alias("n"))
    best = top_n_per_dim(domains, "source", "domain", "n", top)
    none = F.lit(None).cast("double").alias("pct")
    return counts.unionByName(
        best.select("source", F.lit("DOMAINE").alias("view"), F.col("domain").alias("label"), F.col("n").alias("nombre"), none)
    )


# Reasons of a KO person.
KO_REASONS = ("Prospect_CIAM", "KPEP_NS_diff_CIAM", "Email_CIAM_invalide", "Email_CIAM_risque")


def quality_reasons(insured: DataFrame, matched: DataFrame) -> DataFrame:
    """Matched persons with the array of reasons that make them KO."""
    rows = _kpep_facts(insured, matched)
    mail = F.coalesce("email", F.lit(""))
    return rows.select(
        "person_id",
        F.array_compact(
            F.array(
                F.when(F.col("birth_iso") == PLACEHOLDER_BIRTH, F.lit("Prospect_CIAM")),
                F.when(F.col("has_key") & (F.col("acc_kpep") != "") & ~F.col("same_upper"), F.lit("KPEP_NS_diff_CIAM")),
                F.when((mail != "") & ~is_valid_email(mail), F.lit("Email_CIAM_invalide")).when(
                    (mail != "") & is_risky_domain(email_domain(mail)), F.lit("Email_CIAM_risque")
                ),
            )
        ).alias("reasons"),
    )


def quality_score(insured: DataFrame, matched: DataFrame) -> DataFrame:
    """Matched persons OK and KO, and how often each reason occurs."""
    rows = quality_reasons(insured, matched)
    bad = F.size("reasons") > 0
    row = rows.agg(
        F.count("*").alias("n"), count_where(~bad).alias("ok"), count_where(bad).alias("ko"),
        *[count_where(F.array_contains("reasons", r)).alias(r) for r in KO_REASONS],
    )
    out = facts(row, {"DATA_QUALITY_OK": ("ok", "n"), "DATA_QUALITY_KO": ("ko", "n"), **{r: (r, "ko") for r in KO_REASONS}})
    return out.where(F.col("indicator").startswith("DATA_QUALITY") | (F.col("nombre") > 0))


def account_quality(account_ref: DataFrame) -> DataFrame:
    """Accounts without e-mail, without valid key, with only a secondary e-mail; shared e-mails."""
    mail, other = F.col("email"), F.col("email_other")
    row = account_ref.agg(
        F.count("*").alias("n"),
        count_where((mail == "") & (other == "")).alias("sans_email"),
        count_where(~F.upper("idkpep").startswith("KPEP")).alias("sans_kpep"),
        count_where((mail == "") & (other != "")).alias("other_seul"),
    )
    entries = account_ref.select("id", F.explode(F.array_distinct(F.array(mail, other))).alias("mail")).where("mail <> ''")
    # (mail, id) pairs are distinct: an e-mail is shared when it has two pairs.
    shared = entries.groupBy("mail").agg(F.count("*").alias("n")).where("n > 1")
    concerned = lookup_join(entries, shared.select("mail"), ["mail"], "left_semi").select("id").distinct()
    n_mail = shared.agg(F.count("*").alias("emails_partages"))
    n_acc = concerned.agg(F.count("*").alias("comptes_concernes"))
    wide = row.crossJoin(F.broadcast(n_mail)).crossJoin(F.broadcast(n_acc))  # one row each
    names = ("sans_email", "sans_kpep", "other_seul", "comptes_concernes")
    return facts(wide, {"emails_partages": "emails_partages", **{c: (c, "n") for c in names}})


_NAMES = ("last_name", "last_norm", "first_name", "first_norm")


def doubtful_names(unequal: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Name pairs that are surely too unlike, and those that only the measure itself can tell.

    Pairs whose bounds both lie on one side of the threshold are decided by built-in expressions.
    """
    low, high = similarity_bounds(*map(F.col, _NAMES))
    # Room for rounding: a bound beside the threshold decides nothing.
    bounded = unequal.withColumns({"__low": low, "__high": high})
    open_pairs = bounded.where((F.col("__high") >= threshold - 1e-9) & (F.col("__low") < threshold + 1e-9))
    return bounded.where(F.col("__high") < threshold - 1e-9).drop("__low", "__high"), open_pairs.drop("__low", "__high")


def divergent_names(pairs: DataFrame, threshold: float) -> DataFrame:
    """Distinct name pairs less similar than the threshold, each with its number ``k``."""
    unequal = materialize(pairs.groupBy(*_NAMES).agg(F.count("*").alias("k")))
    far, doubtful = doubtful_names(unequal, threshold)
    return far.unionByName(doubtful.where(name_similarity(*map(F.col, _NAMES)) < threshold))


def attribute_divergence(member: DataFrame, matched: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Birth dates, names and e-mails that differ between contract and account.

    Each comparison has its own base; names are compared by similarity, on
    rows where they are not simply equal and built-in bounds do not decide.
    """
    first = first_row(member.where(F.coalesce("person_id", F.lit("")) != ""), ["person_id"], [F.col("seq")]).select(
        "person_id", "birth_date", "last_name", "first_name", "contact_email"
    )
    rows = matched.where(F.col("src_rank").isNotNull()).join(first, "person_id")
    births = (F.col("birth_date") != "") & (F.col("birth_iso") != "") & (F.col("birth_date") != PLACEHOLDER_BIRTH) & (F.col("birth_iso") != PLACEHOLDER_BIRTH)
    names = (F.col("last_name") != "") & (F.col("last_norm") != "")
    same = (F.col("last_name") == F.col("last_norm")) & (
        (F.col("first_name") == F.col("first_norm")) | (F.col("first_name") == "") | (F.col("first_norm") == "")
    )
    mails = F.col("contact_email") != ""
    # Two aggregates read these rows; the matching behind them runs once.
    pairs = materialize(rows.select(
        births.alias("b"),
        (births & (F.col("birth_date") != F.col("birth_iso"))).alias("b_diff"),
        names.alias("n"),
        (names & ~same).alias("n_check"),
        mails.alias("m"),
        (mails & (F.coalesce("email", F.lit("")) != F.col("contact_email"))).alias("m_diff"),
        "last_name", "last_norm", "first_name", "first_norm",
    ))
    counted = pairs.agg(
        *[count_where(F.col(c)).alias(c + "_count") for c in ("b", "b_diff", "n", "m", "m_diff")]
    )
    far = divergent_names(pairs.where("n_check"), threshold).agg(F.coalesce(F.sum("k"), F.lit(0)).alias("n_diff_count"))
    wide = counted.crossJoin(F.broadcast(far))  # one row each
    return facts(
        wide,
        {
            "ddn_differente": ("b_diff_count", "b_count"),
            "nom_divergent": ("n_diff_count", "n_count"),
            "email_different": ("m_diff_count", "m_count"),
        },
    )


# ---- registry KPIs -----------------------------------------------------------------


def registry_email_quality(registry: DataFrame) -> DataFrame:
    """Registry rows with, without and with an invalid e-mail."""
    mail = F.coalesce(squeeze(F.col("adrmailctc")), F.lit(""))
    row = registry.select(mail.alias("mail")).agg(
        F.count("*").alias("n"),
        count_where(F.col("mail") != "").alias("rempli"),
        count_where(F.col("mail") == "").alias("vide"),
        count_where((F.col("mail") != "") & ~is_valid_email(F.col("mail"))).alias("invalide"),
    )
    return facts(row, {"rempli": ("rempli", "n"), "vide": ("vide", "n"), "invalide": ("invalide", "rempli")})


def registry_email_concordance(matched: DataFrame, registry_first: DataFrame) -> DataFrame:
    """Registry e-mail against account e-mail of matched persons the registry knows."""
    reg = registry_first.select(F.col("refperboccn").alias("person_id"), normalize_email(F.col("adrmailctc")).alias("reg"))
    rows = matched.select("person_id", normalize_email(F.col("email")).alias("acc")).join(reg, "person_id")
    a, r = F.col("acc"), F.col("reg")
    label = (
        F.when((a == "") & (r == ""), "deux_vides").when(r == "", "iehe_vide").when(a == "", "ciam_vide")
        .when(a == r, "identiques").otherwise("differents")
    )
    row = rows.select(label.alias("c")).agg(
        F.count("*").alias("n"),
        *[count_where(F.col("c") == c).alias(c) for c in ("identiques", "differents", "iehe_vide", "ciam_vide", "deux_vides")],
        count_where(F.col("c").isin("ciam_vide", "differents")).alias("potentiel"),
    )
    return facts(row, {c: (c, "n") for c in row.columns if c != "n"})


def registry_company_concordance(registry_first: DataFrame, member: DataFrame) -> DataFrame:
    """Registry company against the company of the person's first contract."""
    first = first_row(member, ["person_id"], [F.col("seq")]).select("person_id", F.col("company").alias("own"))
    reg = registry_first.select(F.col("refperboccn").alias("person_id"), F.coalesce(squeeze(F.col("socappr")), F.lit("")).alias("reg"))
    rows = reg.join(first, "person_id", "left")
    own, r = F.coalesce("own", F.lit("")), F.col("reg")
    label = F.when(r == "", "iehe_vide").when(own == "", "ns_vide").when(own == r, "identiques").otherwise("differentes")
    row = rows.select(label.alias("c")).agg(
        F.count("*").alias("n"), *[count_where(F.col("c") == c).alias(c) for c in ("identiques", "differentes", "iehe_vide", "ns_vide")]
    )
    return facts(row, {c: (c, "n") for c in row.columns if c != "n"})


def _present_types(member: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows per (person, type) with the registry flag."""
    rows = member.where(F.coalesce("person_id", F.lit("")) != "").groupBy("person_id", "member_type").agg(
        F.count("*").alias("lignes"), F.min("seq").alias("seq")
    )
    return registry_presence(rows, registry)


def registry_presence_by_type(member: DataFrame, registry: DataFrame) -> DataFrame:
    """Reference, present and missing persons, in total and by type, with shares."""
    rows = _present_types(member, registry)
    by_type = rows.groupBy("member_type").agg(F.count("*").alias("reference"), F.sum("present").cast("bigint").alias("presents"))
    persons = rows.groupBy("person_id").agg(F.max("present").alias("present"))
    total = persons.agg(F.lit("(tous)").alias("member_type"), F.count("*").alias("reference"), F.sum("present").cast("bigint").alias("presents"))
    out = by_type.unionByName(total.select("member_type", "reference", "presents"))
    missing = F.col("reference") - F.col("presents")
    return out.select(
        "*", missing.alias("manquants"),
        pct2(F.col("presents"), F.col("reference")).alias("taux_presents"),
        pct2(missing, F.col("reference")).alias("taux_manquants"),
    )


def lines_vs_persons(member: DataFrame, registry: DataFrame, examples: int = 5) -> DataFrame:
    """Rows, persons and their difference: all, present and missing, in total and by type.

    Also counts the persons on several contracts and lists the largest ones.
    """
    rows = _present_types(member, registry)
    per_person = rows.groupBy("person_id").agg(
        F.sum("lignes").alias("lignes"), F.max("present").alias("present"),
        F.min_by("member_type", "seq").alias("member_type"),
    )
    scope = F.when(F.col("present") == 1, "PRESENTS").otherwise("MANQUANTS")
    fine = rows.groupBy(scope.alias("scope"), "member_type").agg(F.sum("lignes").alias("lignes"), F.count("*").alias("personnes"))
    coarse = per_person.groupBy(scope.alias("scope")).agg(F.sum("lignes").alias("lignes"), F.count("*").alias("personnes"))
    both = [F.sum("lignes").cast("bigint").alias("lignes"), F.sum("personnes").cast("bigint").alias("personnes")]
    out = fine.groupBy(F.lit("TOTAL").alias("scope"), "member_type").agg(*both).unionByName(
        fine.select("scope", "member_type", F.col("lignes").cast("bigint").alias("lignes"), "personnes")
    ).unionByName(
        coarse.select("scope", F.lit("(tous)").alias("member_type"), F.col("lignes").cast("bigint").alias("lignes"), "personnes")
    ).unionByName(coarse.groupBy(F.lit("TOTAL").alias("scope"), F.lit("(tous)").alias("member_type")).agg(*both))
    multi = per_person.where("lignes > 1")
    by_type = multi.groupBy(F.lit("MULTI_CONTRATS").alias("scope"), "member_type").agg(
        F.sum("lignes").cast("bigint").alias("lignes"), F.count("*").alias("personnes")
    )
    top = multi.orderBy(F.col("lignes").desc(), "person_id").limit(examples).select(
        F.concat(F.lit("EXEMPLE "), "person_id").alias("scope"), "member_type", F.col("lignes").cast("bigint").alias("lignes"), F.lit(1).cast("bigint").alias("personnes")
    )
    return out.unionByName(by_type).unionByName(top).select("*", (F.col("lignes") - F.col("personnes")).alias("delta"))


def card_registry_correlation(member: DataFrame, registry: DataFrame) -> DataFrame:
    """Card status by registry presence and type: rows, persons and their difference.

    Persons count once, by their best contract.  Rows flagged MANQUANTS and
    ELIGIBLE are the alert population.
    """
    lines = registry_presence(card_scope(member).where(F.coalesce("person_id", F.lit("")) != ""), registry)
    persons = registry_presence(person_card(member), registry)
    keys = [F.when(F.col("present") == 1, "PRESENTS").otherwise("MANQUANTS").alias("scope"), F.col("member_type"), F.col("status")]
    a = lines.groupBy(*keys).agg(F.count("*").alias("lignes"))
    b = persons.groupBy(*keys).agg(F.count("*").alias("personnes"))
    out = a.join(b, ["scope", "member_type", "status"], "full_outer")
    n, p = F.coalesce("lignes", F.lit(0)), F.coalesce("personnes", F.lit(0))
    return out.select("scope", "member_type", "status", n.alias("lignes"), p.alias("personnes"), (n - p).alias("delta"))


# ---- retry ledger ------------------------------------------------------------------


def ko_label(status) -> Column:
    """Card label of an unresolved person."""
    return F.when(status == "ELIGIBLE_TP", "Eligible_TP").when(status == "FUTURE_TP", "Future_TP").otherwise("Hors_Perimetre_TP")


def retry_totals(ledger: DataFrame) -> DataFrame:
    """Initial, resolved and open rows and the last check, by file, type and card label."""
    done = F.upper(squeeze(F.col("statut_retry"))) == "OK"
    base = ledger.groupBy("source_file", "member_type", "label").agg(
        F.count("*").alias("initial"), count_where(done).alias("resolus"), F.max("date_derniere_verif").alias("derniere")
    )
    sets = base.groupingSets(
        [["source_file"], ["member_type"], ["label"], ["source_file", "member_type"], ["source_file", "label"], []],
        "source_file", "member_type", "label",
    ).agg(
        F.sum("initial").cast("bigint").alias("initial"), F.sum("resolus").cast("bigint").alias("resolus"), F.max("derniere").alias("derniere"),
    )
    return sets.select(
        F.coalesce("source_file", F.lit("(tous)")).alias("source_file"),
        F.coalesce("member_type", F.lit("(tous)")).alias("member_type"),
        F.coalesce("label", F.lit("(tous)")).alias("label"),
        "initial", "resolus", (F.col("initial") - F.col("resolus")).alias("encore_ko"),
        pct2(F.col("resolus"), F.col("initial")).alias("taux"), "derniere",
    )
