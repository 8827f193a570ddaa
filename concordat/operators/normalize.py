"""Raw text rows to canonical member and account rows."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.functions import (
    contact_to_email,
    identity_key,
    iso_date,
    normalize_email,
    normalize_text,
    origin_class,
    squeeze,
)
from concordat.operators.common import first_row
from concordat.sources.columns import ACCOUNT_ALIASES, MEMBER_ALIASES, clean_header, resolve_columns

# Business scope.
INSURED_TYPES = ("ASSPRI", "MPACTI", "MPRETR", "MPVRET")
SPOUSE_MARK = "CONJ"
UNKNOWN_OFFER = "INCONNUE"
UNKNOWN_COMPANY = "UNK"


def is_insured(member_type: Column) -> Column:
    return F.coalesce(member_type.isin(*INSURED_TYPES), F.lit(False))


def is_spouse(member_type: Column) -> Column:
    return F.coalesce(member_type.contains(SPOUSE_MARK), F.lit(False))


def _text(col: Column) -> Column:
    return F.coalesce(squeeze(col), F.lit(""))


def normalize_member(raw: DataFrame, keep: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Canonical contract rows of a snapshot.

    The effect date falls back to the adhesion date only when the snapshot has
    no effect-date column at all; an unknown offer is called ``INCONNUE``.
    """
    has_effect = {clean_header(c) for c in raw.columns} & {
        clean_header(a) for a in MEMBER_ALIASES["effect_date"]
    }
    df = resolve_columns(raw, MEMBER_ALIASES, keep=keep)
    return df.select(*_member_columns(bool(has_effect)), *[F.col(k) for k in keep if k in df.columns])


@lru_cache
def _member_columns(has_effect: bool) -> tuple[Column, ...]:
    """Expressions of the canonical contract columns; built once, they depend on names only."""
    adhesion = iso_date(F.col("adhesion_date"))
    return (
        squeeze(F.col("person_id")).alias("person_id"),
        squeeze(F.col("contract_id")).alias("contract_id"),
        squeeze(F.col("member_type")).alias("member_type"),
        F.coalesce(squeeze(F.col("company")), F.lit(UNKNOWN_COMPANY)).alias("company"),
        F.coalesce(F.upper(squeeze(F.col("offer"))), F.lit(UNKNOWN_OFFER)).alias("offer"),
        normalize_text(F.col("last_name")).alias("last_name"),
        normalize_text(F.col("first_name")).alias("first_name"),
        iso_date(F.col("birth_date")).alias("birth_date"),
        normalize_email(F.col("email")).alias("email"),
        contact_to_email(F.coalesce(squeeze(F.col("contact_value")), F.lit(""))).alias("contact_email"),
        _text(F.col("kpep")).alias("kpep"),
        adhesion.alias("adhesion_date"),
        (iso_date(F.col("effect_date")) if has_effect else adhesion).alias("effect_date"),
        iso_date(F.col("cancel_date")).alias("cancel_date"),
    )


@lru_cache
def _account_expressions() -> tuple[tuple[Column, ...], tuple[Column, ...]]:
    """Expressions of the canonical account columns, then of the keys read off them."""
    base = (
        _text(F.col("id")).alias("id"),
        F.col("realm_id"),
        _text(F.col("idkpep")).alias("idkpep"),
        normalize_email(F.col("email")).alias("email"),
        normalize_email(F.col("email_other")).alias("email_other"),
        F.col("last_name").alias("raw_last_name"),
        F.col("first_name").alias("raw_first_name"),
        F.col("middlename"),
        F.col("birthdate").alias("raw_birthdate"),
        F.col("phonenumber"),
        normalize_text(F.col("last_name")).alias("last_norm"),
        normalize_text(F.col("first_name")).alias("first_norm"),
        iso_date(F.col("birthdate")).alias("birth_iso"),
    )
    last, first, birth = F.col("last_norm"), F.col("first_norm"), F.col("birth_iso")
    keys = (F.col("*"), identity_key(last, first, birth).alias("identity"), identity_key(last, birth).alias("name_birth"))
    return base, keys


def _account_columns(raw: DataFrame, source: str, rank: int) -> DataFrame:
    df = resolve_columns(raw, ACCOUNT_ALIASES, keep=("seq",))
    base, keys = _account_expressions()
    tags = (F.lit(source).alias("source"), F.lit(rank).alias("src_rank"), F.col("seq").cast("bigint").alias("seq"))
    # Two steps: the keys read the normalised columns instead of repeating them.
    return df.select(*base, *tags).select(*keys)


def normalize_account(by_key: DataFrame, by_email: DataFrame | None = None) -> DataFrame:
    """Main directory accounts: both extracts, one row per (id, realm), first wins."""
    accounts = _account_columns(by_key, "CK", 1)
    if by_email is not None:
        accounts = accounts.unionByName(_account_columns(by_email, "CM", 2))
    with_id = accounts.where(F.col("id") != "")
    return first_row(with_id, ["id", "realm_id"], [F.col("src_rank"), F.col("seq")])


def normalize_search(raw: DataFrame, source: str, rank: int) -> DataFrame:
    """Accounts of one name search (last or middle name)."""
    return _account_columns(raw, source, rank).where(F.col("id") != "")


def account_reference(accounts: DataFrame) -> DataFrame:
    """One account row per id, in source order."""
    return first_row(accounts, ["id"], [F.col("src_rank"), F.col("seq")])


def data_origin_class(df: DataFrame, columns: list[str]) -> DataFrame:
    """Presence class of raw columns, one ``<column>_class`` per column."""
    return df.select("*", *[origin_class(F.col(c)).alias(f"{c}_class") for c in columns])


def rename_prefix(
    df: DataFrame, prefix: str, drop: tuple[str, ...] = (), extra: tuple[str, ...] = ()
) -> DataFrame:
    """Prefix source columns, drop technical ones, then append computed ones."""
    source = [c for c in df.columns if c not in drop and c not in extra]
    return df.select(*[F.col(c).alias(prefix + c) for c in source], *extra)
