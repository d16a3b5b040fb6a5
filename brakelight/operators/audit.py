"""Data audits: table-constraint violations, blank profile, field lengths,
invalid-date rows, sensitive values and vector shape.

Each audit is one scan with aggregate expressions (``count_if``/``max``) and
returns a small long-form table; no rows are collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text, vectors
from ..schemas import BOUNDED_LENGTHS, INVALID_COLUMNS
from ..session import ensure_parallelism

# Patterns for values that should not reach the corpus.
EMAIL_RX = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE_RX = r"(^|[^0-9])\(?[0-9]{3}\)?[-. ][0-9]{3}[-. ][0-9]{4}([^0-9]|$)"
VIN_RX = r"(^|[^A-Za-z0-9])[A-HJ-NPR-Z0-9]{17}([^A-Za-z0-9]|$)"
SHORT_CONTEXT_CHARS = 20
# Texts that hold a match of the patterns above, each begun by the first character that a match needs and without
# repeats that are tried again at every position: a long run of letters or digits takes time by its length, not its square.
_EMAIL_FIND = r"[A-Za-z0-9._%+-]@[A-Za-z0-9.-]+\.[A-Za-z]{2}"
_PHONE_FIND = r"[0-9]{3}(?<![0-9]{4})\)?[-. ][0-9]{3}[-. ][0-9]{4}(?![0-9])"
_VIN_FIND = r"[A-HJ-NPR-Z0-9](?<![A-Za-z0-9]{2})[A-HJ-NPR-Z0-9]{16}(?![A-Za-z0-9])"


def _long_form(row_df: DataFrame, names: list[str], key: str, value: str) -> DataFrame:
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return row_df.selectExpr(f"stack({len(names)}, {pairs}) AS ({key}, {value})")


def constraint_audit(df: DataFrame, key: str = "cmplid") -> DataFrame:
    """Rows the corpus table would reject, per rule: ``(rule, violations)``.

    Rules: key null / blank / repeated (rows beyond the first per key), report
    id null, summary null, and each bounded text column longer than its limit.
    """
    cols = set(df.columns)
    aggs = {
        f"{key}_null": F.count_if(F.col(key).isNull()),
        f"{key}_blank": F.count_if(F.col(key) == ""),
        f"{key}_repeated": F.count(F.col(key)) - F.count_distinct(F.col(key)),
    }
    if "odino" in cols:
        aggs["odino_null"] = F.count_if(F.col("odino").isNull())
    if "summary" in cols:
        aggs["summary_null"] = F.count_if(F.col("summary").isNull())
    for c, n in BOUNDED_LENGTHS:
        if c in cols:
            aggs[f"{c}_over_{n}"] = F.count_if(F.length(c) > n)
    row = df.agg(*[v.cast("long").alias(k) for k, v in aggs.items()])
    return _long_form(row, list(aggs), "rule", "violations")


def blank_profile(df: DataFrame, cols=("mfr_name", "cmplid", "odino")) -> DataFrame:
    """Count of empty-string values per column, one row."""
    return df.agg(*[F.count_if(F.col(c) == "").cast("long").alias(f"blank_{c}") for c in cols])


def invalid_date_rows(guarded: DataFrame, keep=("seq", "cmplid")) -> DataFrame:
    """Rows holding any out-of-range date mark."""
    marks = [c for c in INVALID_COLUMNS if c in guarded.columns]
    return guarded.where(F.coalesce(*[F.col(c) for c in marks]).isNotNull()).select(*keep, *marks)


def field_length_probe(df: DataFrame, cols=None) -> DataFrame:
    """Longest value per text column: ``(column_name, max_length)``."""
    cols = cols or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    row = df.agg(*[F.max(F.length(c)).cast("long").alias(c) for c in cols])
    return _long_form(row, list(cols), "column_name", "max_length")


def sensitive_value_flags(df: DataFrame, col: str = "cdescr", keep=("seq",)) -> DataFrame:
    """Per row: e-mail / phone / VIN-like values and too-short context."""
    c = F.coalesce(F.col(col), F.lit(""))
    return ensure_parallelism(df.select(*keep, col)).select(
                     *keep,
                     (c.contains("@") & c.rlike(_EMAIL_FIND)).alias("has_email"),
                     c.rlike(_PHONE_FIND).alias("has_phone"),
                     c.rlike(_VIN_FIND).alias("has_vin"),
                     (F.length(text.strip_ws(c)) < SHORT_CONTEXT_CHARS).alias("short_context"))


def check_vector_dim(df: DataFrame, col: str = "embedding", dim: int = 64, tol: float = 1e-3) -> DataFrame:
    """Per vector length: count, rows off unit norm, and whether the length is ``dim``."""
    return (df.groupBy(F.size(col).alias("dim"))
            .agg(F.count(F.lit(1)).alias("n_vectors"),
                 F.count_if(F.abs(vectors.norm(col) - 1.0) > tol).cast("long").alias("n_not_unit"))
            .withColumn("dim_ok", F.col("dim") == dim))
