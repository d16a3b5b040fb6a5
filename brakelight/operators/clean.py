"""Cleaning chain for raw complaint rows (all strings) -> one row per report.

Order of steps follows the source pipeline: strip quotes -> defang links ->
numbers -> dates -> date range guard -> length filter -> first row per
complaint id -> canonical maker name -> merge per report -> summary.
Every step is a column expression or an aggregation with map-side partial
aggregation; order-dependent steps take an explicit ``order`` column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import coerce, text
from ..functions.sql import ident, string_lit
from ..session import ensure_parallelism
from ..schemas import (DATE_COLUMNS, DATE_HIGH, DATE_LOW, INVALID_SUFFIX, LINK_TEXT_COLUMNS,
                       MIN_COMPDESC_LEN, NUMERIC_COLUMNS, PIPE_SEP)


def _string_cols(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if f.dataType.simpleString() == "string" and f.name not in exclude]


def strip_quotes(df: DataFrame, cols=None) -> DataFrame:
    """Remove ``"`` from every string column (or ``cols``)."""
    cols = set(cols or _string_cols(df))
    return df.selectExpr(*[f"replace({ident(c)}, '\"', '') AS {ident(c)}" if c in cols else ident(c)
                           for c in df.columns])


def defang_columns(df: DataFrame, cols=LINK_TEXT_COLUMNS) -> DataFrame:
    return df.withColumns({c: text.defang_links(c) for c in cols if c in df.columns})


def coerce_numeric(df: DataFrame, cols=NUMERIC_COLUMNS) -> DataFrame:
    return df.withColumns({c: coerce.to_number(c) for c in cols})


def parse_dates(df: DataFrame, cols=DATE_COLUMNS) -> DataFrame:
    return df.withColumns({c: coerce.to_date_compact(c) for c in cols})


def date_range_guard(df: DataFrame, cols=DATE_COLUMNS, low: str = DATE_LOW,
                     high: str = DATE_HIGH) -> DataFrame:
    """Move dates outside ``[low, high]`` to ``<col>_raw_invalid`` and clear the source."""
    out = {}
    for c in cols:
        kept, moved = coerce.guard_date(F.col(c), low, high)
        out[c] = kept
        out[c + INVALID_SUFFIX.lower()] = moved
    return df.withColumns(out)


def filter_short_text(df: DataFrame, col: str = "compdesc", min_len: int = MIN_COMPDESC_LEN) -> DataFrame:
    """Keep rows whose text is longer than ``min_len`` characters."""
    return df.where(F.length(col) > min_len)


def canonical_names(df: DataFrame, col: str = "mfr_name") -> DataFrame:
    return df.withColumn(col, text.canonical_name(col))


def dedup_first(df: DataFrame, key: str = "cmplid", order: str = "seq", scope=()) -> DataFrame:
    """First row per ``key`` in ``order``.

    ``min_by`` over the whole row is an aggregate with map-side partial
    aggregation, so a key holding a third of all rows is reduced to one row
    per input partition before the shuffle (a window would sort the whole
    group in one task).
    """
    keys = [*scope, key]
    others = [c for c in df.columns if c not in keys]
    row = "struct(" + ", ".join(ident(c) for c in others) + ")"
    agg = df.groupBy(*keys).agg(F.expr(f"min_by({row}, {ident(order)}) AS _r"))
    return agg.selectExpr(*[ident(c) if c in keys else f"_r.{ident(c)} AS {ident(c)}" for c in df.columns])


def merge_by_report(df: DataFrame, key: str = "odino", order: str = "seq", min_col: str = "cmplid",
                    join_col: str = "compdesc", sep: str = PIPE_SEP, scope=()) -> DataFrame:
    """One row per report ``key``.

    ``min_col``: smallest value (string order). ``join_col``: distinct non-null
    values in first-seen order joined by ``sep``. Every other column: first
    non-null value in ``order``. ``order`` itself becomes the first row's order.

    Two aggregation levels keep hot keys bounded: (key, join value) first
    (partial aggregation collapses repeats map-side), then key, where the list
    holds only distinct values of the report.
    """
    keys = [*scope, key]
    others = [c for c in df.columns if c not in (*keys, order, min_col, join_col)]
    o, m, j = ident(order), ident(min_col), ident(join_col)

    def first_nn(c):
        return F.expr(f"min(CASE WHEN {ident(c)} IS NOT NULL THEN named_struct('o', {o}, 'v', {ident(c)}) END)"
                      f" AS {ident('_f_' + c)}")

    lvl1 = (df.groupBy(*keys, join_col)
            .agg(F.expr(f"min({o}) AS _first"), F.expr(f"min({m}) AS _min"), *[first_nn(c) for c in others]))
    lvl2 = (lvl1.groupBy(*keys)
            .agg(F.expr(f"min(_first) AS {o}"), F.expr(f"min(_min) AS {m}"),
                 F.expr(f"collect_list(CASE WHEN {j} IS NOT NULL THEN named_struct('o', _first, 'v', {j}) END)"
                        " AS _vals"),
                 *[F.expr(f"min({ident('_f_' + c)}) AS {ident('_f_' + c)}") for c in others]))
    joined = f"array_join(transform(array_sort(_vals), x -> x.v), {string_lit(sep)})"
    cols = []
    for c in df.columns:
        if c in (*keys, order, min_col):
            cols.append(ident(c))
        elif c == join_col:
            cols.append(f"{joined} AS {ident(c)}")
        else:
            cols.append(f"{ident('_f_' + c)}.v AS {ident(c)}")
    return lvl2.selectExpr(*cols)


def add_sentence_summary(df: DataFrame, col: str = "summary") -> DataFrame:
    return df.withColumn(col, text.summary_sentence())


def clean_complaints(raw: DataFrame, order: str = "seq", low: str = DATE_LOW,
                     high: str = DATE_HIGH, scope=()) -> DataFrame:
    """Whole cleaning chain: raw string rows -> 57 clean columns (+ ``order``).

    ``scope``: extra key columns (e.g. the source file) so that several inputs
    are cleaned independently in one job, as separate clean jobs would.
    """
    df = strip_quotes(ensure_parallelism(raw))
    df = defang_columns(df)
    df = coerce_numeric(df)
    df = parse_dates(df)
    df = date_range_guard(df, low=low, high=high)
    df = filter_short_text(df)
    df = dedup_first(df, "cmplid", order, scope)
    df = canonical_names(df)
    df = merge_by_report(df, "odino", order, scope=scope)
    return add_sentence_summary(df)


def rejected_rows(raw: DataFrame, order: str = "seq") -> DataFrame:
    """Rows the cleaning chain drops, with the reason (quarantine sink input).

    ``short_compdesc``: failed the length filter; ``duplicate_cmplid``: a later
    row of an id whose first (length-checked) row was kept.
    """
    df = defang_columns(strip_quotes(raw))
    short = F.length("compdesc") <= MIN_COMPDESC_LEN
    # first order per id (narrow aggregate, partial map-side), then one pass over the rows:
    # a row is a duplicate when it is not its id's first kept row (null ids form one group,
    # as in dedup_first)
    winners = (df.where(~short).groupBy("cmplid").agg(F.min(order).alias("_first"))
               .withColumnRenamed("cmplid", "_wid"))
    flagged = df.join(winners, df["cmplid"].eqNullSafe(winners["_wid"]), "left")
    reason = (F.when(short, F.lit("short_compdesc"))
              .when(F.col(order) != F.col("_first"), F.lit("duplicate_cmplid")))
    return (flagged.withColumn("reason", reason).where(F.col("reason").isNotNull())
            .select(*df.columns, "reason"))
