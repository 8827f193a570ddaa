"""Scalar expressions on edge values."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from concordat import functions as fx


def one(spark, col, value, schema="string"):
    return spark.createDataFrame([(value,)], f"v {schema}").select(col(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "value, want",
    [(None, ""), ("", ""), (" Élodie \t", "ELODIE"), ("Straße", "STRASSE"), ("Cœur", "CUR"), ("Ångström-Ñ", "ANGSTROM-N"), ("ḁž", "AZ")],
)
def test_normalize_text(spark, value, want):
    assert one(spark, fx.normalize_text, value) == want


def test_accents_follow_decomposition(spark):
    letters = [chr(c) for c in list(range(0xC0, 0x250)) + list(range(0x1E00, 0x1F00))]
    got = {r["v"]: r["r"] for r in spark.createDataFrame([(x,) for x in letters], "v string").select("v", fx.normalize_text(F.col("v")).alias("r")).collect()}
    for letter in letters:
        want = unicodedata.normalize("NFD", letter.upper().strip()).encode("ascii", "ignore").decode()
        assert got[letter] == want, letter


@pytest.mark.parametrize("value, want", [(None, ""), (" NULL ", ""), ("NaN", ""), (" A@B.fr ", "a@b.fr"), ("x", "x")])
def test_normalize_email(spark, value, want):
    assert one(spark, fx.normalize_email, value) == want


@pytest.mark.parametrize(
    "value, want",
    [(None, []), ("", []), ("a@b.fr; A@B.FR, c@d.org", ["a@b.fr", "c@d.org"]), ("moi@local", ["moi@local"]), ("rien", []), ("NULL", [])],
)
def test_extract_emails(spark, value, want):
    assert one(spark, fx.extract_emails, value) == want


@pytest.mark.parametrize(
    "value, want",
    [
        ("2020-01-31", "2020-01-31"), ("31/01/2020", "2020-01-31"), ("1/2/2020", "2020-02-01"), ("31-01-2020", "2020-01-31"),
        ("2020/01/31", "2020-01-31"), ("20200131", "2020-01-31"), ("31.01.2020", "2020-01-31"), ("2020-01-31 10:20:30", "2020-01-31"),
        ("31/02/2020", ""), ("abc", ""), (None, ""), ("2020-99-99", "2020-99-99"),
    ],
)
def test_iso_date(spark, value, want):
    assert one(spark, fx.iso_date, value) == want


def test_run_date_is_not_text_order(spark):
    assert str(one(spark, fx.run_date, "01082026")) == "2026-08-01"
    assert one(spark, fx.run_date, "99992026") is None
    assert one(spark, fx.run_date, "x") is None


@pytest.mark.parametrize("value, want", [("7", "007"), ("012", "012"), ("12345", "12345"), (None, None)])
def test_zero_pad_never_cuts(spark, value, want):
    assert one(spark, fx.zero_pad_code, value) == want


@pytest.mark.parametrize("n, d, want", [(1, 3, 33.33), (2, 3, 66.67), (0, 0, 0.0), (1, 800, 0.13), (5, 5, 100.0), (201, 20000, 1.01)])
def test_pct2(spark, n, d, want):
    got = spark.createDataFrame([(n, d)], "n long, d long").select(fx.pct2(F.col("n"), F.col("d")).alias("r")).first()["r"]
    assert got == want


@pytest.mark.parametrize("value, want", [("mails : 40 047", 40047), ("total : 1 234 ", 1234), ("sans nombre", None), ("a : 5 euros", None)])
def test_embedded_number(spark, value, want):
    assert one(spark, fx.embedded_number, value) == want


@pytest.mark.parametrize("value, want", [(None, "NULL"), (" null ", "NULL"), ("  ", "VIDE"), ("", "VIDE"), ("x", "REMPLI")])
def test_origin_class(spark, value, want):
    assert one(spark, fx.origin_class, value) == want


def test_email_domain_and_risk(spark):
    assert one(spark, fx.email_domain, "a@b@c") == "b@c"
    assert one(spark, fx.email_domain, "abc") == ""
    assert one(spark, lambda c: fx.is_risky_domain(c), "yopmail.com") is True
    assert one(spark, lambda c: fx.is_valid_email(c), "a@b") is False
