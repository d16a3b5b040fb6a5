"""Exact de-duplication: local winners, salted digest groups, then one combination of the salt winners."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, scratch_table, text_or_empty

SHA256 = "sha2(norm, 256)"


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16,
                digest: str = SHA256) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z. Every stage groups by the whole normalised text next
    to its digest, so a digest never decides alone:

    1. each input partition keeps one row per distinct text (map-side aggregation);
    2. those rows meet per (digest, salt, text); the salt is the input partition modulo ``salts``, so a text with
       copies in every partition is merged by ``salts`` tasks;
    3. at most ``salts`` winners per text meet per (digest, text).

    Rows then find their group by digest. Digests shared by different texts (``variants`` > 1) are matched on the
    text itself; that branch only runs when such a digest exists.

    Null text counts as empty; null ids lose against any id (a group of null ids only keeps id null and ``kept``
    is true for it). Rows that repeat the largest id are all ``kept``: they carry the same id. An empty
    table gives an empty result; further columns are ignored, whatever their names.
    """
    base = docs.select(F.col(id_col).alias("id"), ascii_lower(text_or_empty(text_col)).alias("norm"))
    base = base.select("id", "norm", F.expr(digest).alias("digest"))
    salted = base.withColumn("salt", F.spark_partition_id() % salts)
    by_salt = salted.groupBy("digest", "salt", "norm").agg(F.max("id").alias("id"), F.count("*").alias("n"))
    texts = (by_salt.repartition("digest").groupBy("digest", "norm")
             .agg(F.max("id").alias("keep_id"), F.sum("n").alias("group_size")))
    groups = scratch_table(
        texts.groupBy("digest").agg(F.count("*").alias("variants"), F.max("keep_id").alias("keep_id"),
                                    F.sum("group_size").alias("group_size")), "exact-groups")
    # the text itself stays behind: a digest of one variant names its group
    named = base.select("id", "digest", F.expr(SHA256).alias("text_sha256"))
    out = _finish(named.join(groups.filter("variants = 1"), "digest"))
    clash = groups.filter("variants > 1").select("digest")
    if not clash.isEmpty():
        rows = base.join(clash, "digest", "left_semi")
        same = rows.groupBy("digest", "norm").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
        clashing = rows.join(same, ["digest", "norm"]).withColumn("text_sha256", F.expr(SHA256))
        out = out.unionByName(_finish(clashing))
    return out.withColumnRenamed("id", id_col)


def _finish(df: DataFrame) -> DataFrame:
    return df.select("id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
                     F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
