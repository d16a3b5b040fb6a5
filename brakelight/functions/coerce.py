"""Typing rules for dirty string fields (numbers, dates, flags, date pairs).

ANSI mode is on by default in Spark 4, so every conversion of dirty input
uses a ``try_*`` form: bad values become null instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import DATE_HIGH, DATE_LOW
from .text import col_, strip_ws, strip_ws_sql


# Java's parser also takes ``1d``, ``2f``, ``NaN`` and ``Infinity``; only plain decimal text counts as a number.
NUMBER_PATTERN = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def to_number(c) -> Column:
    """Coerce to double; anything but a decimal number (blank, ``N/A``, ``1d``, ``NaN``) -> null."""
    text = F.trim(col_(c))
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def to_date_compact(c) -> Column:
    """Parse ``yyyyMMdd``; bad -> null."""
    return F.try_to_date(col_(c), "yyyyMMdd")


def to_date_iso(c) -> Column:
    """Parse ``yyyy-MM-dd``; bad -> null."""
    return F.try_to_date(col_(c), "yyyy-MM-dd")


def out_of_range(d: Column, low: str = DATE_LOW, high: str = DATE_HIGH) -> Column:
    return (d > F.lit(high).cast("date")) | (d < F.lit(low).cast("date"))


def guard_date(d: Column, low: str = DATE_LOW, high: str = DATE_HIGH) -> tuple[Column, Column]:
    """(kept date, moved date): an out-of-range date moves to the second column."""
    bad = out_of_range(d, low, high)
    return F.when(~bad, d), F.when(bad, d)


def parse_yn(c) -> Column:
    """``Y`` -> true, ``N`` -> false (any case, trimmed); anything else -> null, never false."""
    u = F.upper(strip_ws(c))
    return F.when(u == "Y", F.lit(True)).when(u == "N", F.lit(False))


def int_or_zero(c, strict: bool = False) -> Column:
    """Whole number or 0.

    Default: any numeric text counts and is truncated (``12.0`` -> 12), which
    repairs the float-formatted integers written by the cleaning step.
    ``strict=True`` accepts only integer text, as a plain integer parser would.
    """
    s = strip_ws(c)
    if strict:
        v = s.try_cast("long")
    else:
        v = F.when(s.rlike(NUMBER_PATTERN), s.try_cast("double").try_cast("long"))
    return F.coalesce(v, F.lit(0).cast("long"))


def date_pair(date_text, invalid_text) -> tuple[Column, Column]:
    """Typed (date, invalid mark) from the processed text form.

    A non-blank invalid mark wins -> (null, mark); blank date -> (null, null);
    unparseable ISO date -> (null, raw text); else (date, null).
    """
    d = F.coalesce(strip_ws(date_text), F.lit(""))
    inv = F.coalesce(strip_ws(invalid_text), F.lit(""))
    parsed = to_date_iso(d)
    date_col = F.when((inv == "") & (d != ""), parsed)
    mark = (F.when(inv != "", inv)
            .when(d == "", F.lit(None).cast("string"))
            .when(parsed.isNull(), d))
    return date_col, mark


def date_text(d: Column) -> Column:
    """Date rendered as ``yyyy-MM-dd`` text, null -> empty string (processed-file form)."""
    return F.coalesce(F.date_format(d, "yyyy-MM-dd"), F.lit(""))


# SQL-text forms of the load rules above, for the ~60-column typed row (one JVM
# call per column instead of dozens); ``x`` arguments are SQL expression text.
# tests/test_text_and_types.py checks both forms agree on the edge rows.
def parse_yn_sql(x: str) -> str:
    u = f"upper({strip_ws_sql(x)})"
    return f"CASE WHEN {u} = 'Y' THEN true WHEN {u} = 'N' THEN false END"


def int_or_zero_sql(x: str, strict: bool = False) -> str:
    s = strip_ws_sql(x)
    v = f"try_cast({s} AS BIGINT)" if strict else (
        f"CASE WHEN {s} RLIKE '{NUMBER_PATTERN}' THEN try_cast(try_cast({s} AS DOUBLE) AS BIGINT) END")
    return f"coalesce({v}, CAST(0 AS BIGINT))"


def date_pair_sql(date_text_sql: str, invalid_text_sql: str) -> tuple[str, str]:
    d = f"coalesce({strip_ws_sql(date_text_sql)}, '')"
    inv = f"coalesce({strip_ws_sql(invalid_text_sql)}, '')"
    parsed = f"try_to_date({d}, 'yyyy-MM-dd')"
    date_col = f"CASE WHEN {inv} = '' AND {d} <> '' THEN {parsed} END"
    mark = (f"CASE WHEN {inv} <> '' THEN {inv} WHEN {d} = '' THEN CAST(NULL AS STRING) "
            f"WHEN {parsed} IS NULL THEN {d} END")
    return date_col, mark


def date_text_sql(d: str) -> str:
    return f"coalesce(date_format({d}, 'yyyy-MM-dd'), '')"
