"""Date expressions.  Canonical dates at rest are ISO strings, '' when unknown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from concordat.functions.text import squeeze

ISO_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
# Accepted layouts after ISO (day first), each with the shape that selects it,
# so that a layout is only tried on text it can read.
LAYOUTS = {
    "d/M/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$",
    "d-M-yyyy": r"^\d{1,2}-\d{1,2}-\d{4}$",
    "yyyy/M/d": r"^\d{4}/\d{1,2}/\d{1,2}$",
    "d.M.yyyy": r"^\d{1,2}\.\d{1,2}\.\d{4}$",
    "yyyyMMdd": r"^\d{8}$",
    "yyyy-MM-dd": ISO_PATTERN,
}


def iso_date(col: Column) -> Column:
    """ISO text of a date in any accepted layout; '' when unreadable.

    Text already shaped like an ISO date is returned as it is, even when it
    is no calendar day; a time part after the date is ignored.
    """
    text = squeeze(col)
    day = F.regexp_replace(text, r"[T ]\d{1,2}:\d{2}.*$", "")
    out = F.when(text.rlike(ISO_PATTERN), text)
    for layout, shape in LAYOUTS.items():
        out = out.when(day.rlike(shape), F.try_to_date(day, layout).cast("string"))
    return F.coalesce(out, F.lit(""))


def date_or_null(iso_text: Column) -> Column:
    """DATE from canonical ISO text; NULL when blank or no calendar day."""
    return iso_text.try_cast("date")


def date_of(col: Column) -> Column:
    """DATE from text in any accepted layout."""
    return date_or_null(iso_date(col))


def run_date(run_id: Column) -> Column:
    """DATE of a ``DDMMYYYY`` run id; NULL when malformed."""
    return F.when(squeeze(run_id).rlike(r"^\d{8}$"), F.try_to_date(squeeze(run_id), "ddMMyyyy"))


def day_delta(later: Column, earlier: Column) -> Column:
    """Whole days between two canonical ISO texts; NULL when one is unknown."""
    return F.datediff(date_or_null(later), date_or_null(earlier))


def epoch_ms_parts(ms: Column) -> tuple[Column, Column]:
    """Calendar day and clock time (whole seconds, UTC) of an epoch-millisecond value."""
    seconds = F.floor(ms / F.lit(1000))
    clock = F.pmod(seconds, F.lit(86400))
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / F.lit(86400)).cast("int"))
    return day, hms(clock)


def hms(seconds: Column) -> Column:
    """Whole seconds as HH:MM:SS; the hours wrap at a day."""
    s = F.pmod(seconds.cast("bigint"), F.lit(86400))
    return F.concat_ws(
        ":",
        F.lpad(F.floor(s / 3600).cast("string"), 2, "0"),
        F.lpad(F.floor(F.pmod(s, F.lit(3600)) / 60).cast("string"), 2, "0"),
        F.lpad(F.pmod(s, F.lit(60)).cast("string"), 2, "0"),
    )


def interval_hms(start: Column, end: Column) -> Column:
    """Time of day part of ``end - start`` as HH:MM:SS."""
    seconds = F.timestamp_diff("SECOND", start, end)
    return hms(seconds)


def token_date(text: Column, token: str, gap: int, layout: str = "yyyyMMdd", width: int = 8) -> Column:
    """DATE read at a fixed distance after the first occurrence of ``token``."""
    at = F.locate(token, text)
    piece = F.substr(text, at + F.lit(gap), F.lit(width))
    return F.when(at > 0, F.try_to_date(piece, layout))
