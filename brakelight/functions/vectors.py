"""Dense-vector column expressions (array<float>), evaluated in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WS_CLASS, col_


def round6(c) -> Column:
    """``round(c, 6)`` of scores: decimal arithmetic, which costs more than a score, only next to a tie."""
    x = col_(c)
    y = x * 1e6
    clear = (F.abs(x) < 2.0) & (F.abs(y - F.floor(y) - 0.5) > 1e-6)   # the product is off by less than 1e-9
    return F.when(clear, F.floor(y + 0.5) / 1e6).otherwise(F.round(x, 6))


def dot(a, b) -> Column:
    prods = F.zip_with(col_(a), col_(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(col_(a), F.lit(0.0).cast("double"),
                              lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine(a, b) -> Column:
    """Cosine similarity ``1 - cosine distance`` in one pass; null when either norm is 0."""
    terms = F.zip_with(col_(a), col_(b), lambda x, y: F.struct(
        (x.cast("double") * y.cast("double")).alias("xy"), (x.cast("double") * x.cast("double")).alias("xx"),
        (y.cast("double") * y.cast("double")).alias("yy")))
    zero = F.struct(F.lit(0.0).alias("xy"), F.lit(0.0).alias("xx"), F.lit(0.0).alias("yy"))
    return F.aggregate(
        terms, zero,
        lambda acc, t: F.struct((acc["xy"] + t["xy"]).alias("xy"), (acc["xx"] + t["xx"]).alias("xx"),
                                (acc["yy"] + t["yy"]).alias("yy")),
        lambda acc: F.when((acc["xx"] > 0) & (acc["yy"] > 0),
                           acc["xy"] / (F.sqrt(acc["xx"]) * F.sqrt(acc["yy"]))))


def l2_normalize(a) -> Column:
    """Unit-length copy of the vector (zero vectors stay zero).

    The norm is the accumulator of ``aggregate`` and the rescaling happens in
    its finish function, so the norm is computed once per row, not per element.
    """
    v = col_(a)
    return F.aggregate(
        v, F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double") * x.cast("double"),
        lambda ss: F.transform(v, lambda x: F.when(ss > 0, x / F.sqrt(ss)).otherwise(x).cast("float")))


def parse_literal(s) -> tuple[Column, Column]:
    """Parse ``[f, f, ...]`` text -> (vector or null, is_valid).

    Brackets are trimmed from both ends, the body is split on ``,`` and every
    part must be a float; an empty literal or any bad part rejects the row.
    """
    text = col_(s)
    body = F.regexp_replace(text, r"^[\[\]]+|[\[\]]+$", "")
    vals = F.transform(F.split(body, ",", -1),
                       lambda x: F.regexp_replace(x, "^[" + WS_CLASS + "]+|[" + WS_CLASS + "]+$", "")
                       .try_cast("float"))
    ok = (F.coalesce(text, F.lit("")) != "") & ~F.exists(vals, lambda x: x.isNull())
    return F.when(ok, vals), F.coalesce(ok, F.lit(False))


def format_literal(v) -> Column:
    """``[f,f,...]`` text form of a vector (for CSV interchange)."""
    return F.concat(F.lit("["), F.array_join(F.transform(col_(v), lambda x: x.cast("string")), ","),
                    F.lit("]"))
