"""Text and e-mail expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\n\r\x0b\x0c"

# Words that stand for a missing value.
NULL_WORDS = ("null", "nan", "none")

# E-mail patterns (search and anchored form).
EMAIL_SEARCH = r"(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}"
EMAIL_ANCHORED = r"(?i)^[A-Z0-9._%+\-]+@[A-Z0-9.\-]+\.[A-Z]{2,}$"

# Domains of throw-away or otherwise untrusted mailboxes.
RISKY_DOMAINS = (
    "yopmail.com",
    "mailinator.com",
    "guerrillamail.com",
    "throwam.com",
    "sharklasers.com",
    "grr.la",
    "spam4.me",
    "trashmail.com",
    "dispostable.com",
    "fakeinbox.com",
    "mailnull.com",
    "maildrop.cc",
    "spamgourmet.com",
    "spamgourmet.net",
    "spamgourmet.org",
    "gmx.com",
    "gmx.fr",
    "gmx.de",
    "gmx.net",
    "jetable.fr.nf",
    "jetable.net",
    "jetable.org",
    "example.com",
    "test.com",
    "noemail.com",
)


def _accent_table() -> tuple[str, str]:
    """Accented Latin letters and the base letter each decomposes to."""
    blocks = (range(0x00C0, 0x0250), range(0x1E00, 0x1F00))
    source, target = [], []
    for block in blocks:
        for code in block:
            base = unicodedata.normalize("NFD", chr(code))[0]
            if base != chr(code) and base.isascii():
                source.append(chr(code))
                target.append(base)
    return "".join(source), "".join(target)


_ACCENTED, _PLAIN = _accent_table()


def squeeze(col: Column) -> Column:
    """Strip every kind of white space at both ends."""
    return F.btrim(col.cast("string"), F.lit(WHITESPACE))


def is_blank(col: Column) -> Column:
    """True for NULL and for white space only."""
    return F.coalesce(squeeze(col) == "", F.lit(True))


def normalize_text(col: Column) -> Column:
    """Upper case, stripped, accents removed, other non-ASCII dropped; NULL gives ''."""
    plain = F.translate(squeeze(F.upper(col)), _ACCENTED, _PLAIN)
    return F.coalesce(F.regexp_replace(plain, r"[^\x00-\x7F]", ""), F.lit(""))


def normalize_email(col: Column) -> Column:
    """Lower case and stripped; NULL and null words give ''."""
    low = squeeze(F.lower(col))
    return F.when(col.isNull() | low.isin(*NULL_WORDS), F.lit("")).otherwise(low)


def extract_emails(col: Column) -> Column:
    """Distinct e-mails in order of appearance.

    A value with an ``@`` but no well-formed address is kept whole.
    """
    text = squeeze(col)
    found = F.regexp_extract_all(text, F.lit(EMAIL_SEARCH), F.lit(0))
    values = F.transform(F.when(F.size(found) > 0, found).otherwise(F.array(text)), lambda v: F.lower(v))
    cleaned = F.array_distinct(F.filter(values, lambda v: ~v.isin("", *NULL_WORDS)))
    return F.when(col.contains("@"), cleaned).otherwise(F.array().cast("array<string>"))


def is_valid_email(col: Column) -> Column:
    """Whole value is one well-formed address."""
    return F.coalesce(col.rlike(EMAIL_ANCHORED), F.lit(False))


def email_domain(col: Column) -> Column:
    """Part after the first ``@``; '' when there is none."""
    at = F.locate("@", col)
    return F.when(at > 0, F.substr(col, at + F.lit(1))).otherwise(F.lit(""))


def is_risky_domain(domain: Column) -> Column:
    """Domain belongs to the fixed list of untrusted domains."""
    return F.coalesce(domain.isin(*RISKY_DOMAINS), F.lit(False))


def contact_to_email(col: Column) -> Column:
    """Contact value kept only when it can be an e-mail."""
    return F.when(col.contains("@"), normalize_email(col)).otherwise(F.lit(""))


def identity_key(*parts: Column) -> Column:
    """Parts joined by a pipe; NULL when any part is blank."""
    ok = ~is_blank(parts[0])
    for part in parts[1:]:
        ok = ok & ~is_blank(part)
    return F.when(ok, F.concat_ws("|", *[squeeze(p) for p in parts]))


def origin_class(col: Column) -> Column:
    """Three-state presence of a raw value: NULL, VIDE or REMPLI."""
    text = squeeze(col)
    return (
        F.when(col.isNull() | (F.upper(text) == "NULL"), F.lit("NULL"))
        .when(text == "", F.lit("VIDE"))
        .otherwise(F.lit("REMPLI"))
    )
