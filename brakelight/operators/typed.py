"""Processed-file text form and the typed corpus row (loader rules).

``processed_text`` renders a clean frame the way the interchange CSV holds it
(lower-case names, ``yyyy-MM-dd`` dates, empty string for missing values).
``typed_rows`` applies the load rules: trim every field, Y/N flags to
three-valued booleans, numbers to whole numbers or 0, date/mark pairs, vector
literal parsing, and a ``reject_reason`` for rows the loader skips.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import coerce, text, vectors
from ..functions.sql import ident
from ..schemas import DATE_COLUMNS, FLAG_COLUMNS, NUMERIC_COLUMNS, PROCESSED_COLUMNS


def processed_text(clean_df: DataFrame, keep=("seq",)) -> DataFrame:
    """All processed columns as strings (missing -> ``""``); ``keep`` columns pass through."""
    out = [ident(k) for k in keep if k in clean_df.columns]
    types = dict((f.name, f.dataType.simpleString()) for f in clean_df.schema.fields)
    for c in PROCESSED_COLUMNS:
        if c not in types:
            continue
        t = types[c]
        if t == "date":
            v = coerce.date_text_sql(ident(c))
        elif t == "string":
            v = f"coalesce({ident(c)}, '')"
        else:
            v = f"coalesce(CAST({ident(c)} AS STRING), '')"
        out.append(f"{v} AS {ident(c)}")
    return clean_df.selectExpr(*out)


def typed_rows(processed: DataFrame, strict_numbers: bool = False, keep=("seq",)) -> DataFrame:
    """Typed corpus columns + ``reject_reason`` (null for loadable rows).

    The per-column rules are SQL text (``coerce.*_sql``): one expression per
    column keeps the ~60-column row cheap to build on the driver.
    """
    cols = set(processed.columns)

    def get(c):  # missing column or empty CSV field -> ""
        return f"coalesce({text.strip_ws_sql(ident(c))}, '')" if c in cols else "''"

    out = [ident(k) for k in keep if k in cols]
    for c in PROCESSED_COLUMNS:
        if c == "embedding" or c.endswith("_raw_invalid"):
            continue
        if c in FLAG_COLUMNS:
            out.append(f"{coerce.parse_yn_sql(get(c))} AS {ident(c)}")
        elif c in NUMERIC_COLUMNS:
            out.append(f"{coerce.int_or_zero_sql(get(c), strict=strict_numbers)} AS {ident(c)}")
        elif c in DATE_COLUMNS:
            d, mark = coerce.date_pair_sql(get(c), get(c + "_raw_invalid"))
            out += [f"{d} AS {ident(c)}", f"{mark} AS {ident(c + '_raw_invalid')}"]
        else:
            out.append(f"{get(c)} AS {ident(c)}")
    exprs = [F.expr(x) for x in out]
    reason = F.when(F.expr(f"{get('cmplid')} = ''"), F.lit("missing cmplid"))
    if "embedding" in cols:
        vec, ok = vectors.parse_literal(F.expr(get("embedding")))
        exprs.append(vec.alias("embedding"))
        reason = reason.when(~ok, F.lit("bad embedding"))
    return processed.select(*exprs, reason.alias("reject_reason"))


def split_rejects(typed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(loadable rows, rejected rows with reason) from one typed frame."""
    good = typed.where(F.col("reject_reason").isNull()).drop("reject_reason")
    bad = typed.where(F.col("reject_reason").isNotNull())
    return good, bad
