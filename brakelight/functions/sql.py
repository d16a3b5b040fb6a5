"""Spark SQL expression text for wide projections and aggregations.

A row of 50+ columns built from ``pyspark.sql.functions`` costs thousands of
Python-to-JVM calls per query (every ``F.col``/``F.when``/``alias`` is one or
more); the same expressions written as SQL text cost one call each and plan
identically. These helpers quote names and literals for that text.
"""

from __future__ import annotations


def ident(name: str) -> str:
    """Back-quoted column name."""
    return "`" + name.replace("`", "``") + "`"


def string_lit(s: str) -> str:
    """Single-quoted SQL string literal (backslash and quote escaped)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
