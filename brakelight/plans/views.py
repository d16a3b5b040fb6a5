"""Complaint-shaped views derived from the driver tables.

The driver ships generic tables (``documents``, ``embeddings``, ``pages``,
``events``); these functions derive the complaint data model from them with
plain column expressions, so every query's work grows with the tables.
The same rules are written as DuckDB SQL in ``plans/oracle.py``.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _pad9(c: Column) -> Column:
    return F.lpad(c.cast("string"), 9, "0")


def complaints(documents: DataFrame) -> DataFrame:
    """One raw complaint row (51 strings + ``seq`` order key) per document.

    Written as SQL text: 52 columns of ``F`` calls cost thousands of JVM
    round trips per query, one expression string costs one.
    """
    pad9 = "lpad(CAST({} AS STRING), 9, '0')".format
    ymd = ("concat(CAST(2000 + doc_id % 25 AS STRING), lpad(CAST(1 + doc_id % 12 AS STRING), 2, '0'), "
           "lpad(CAST(1 + doc_id % 28 AS STRING), 2, '0'))")
    special = {
        "cmplid": f"CASE WHEN doc_id % 11 = 0 AND doc_id > 0 THEN {pad9('doc_id - 1')} ELSE {pad9('doc_id')} END",
        "odino": f"CASE WHEN doc_id % 101 = 0 THEN '' ELSE {pad9('CAST((doc_id - doc_id % 3) / 3 AS BIGINT)')} END",
        "mfr_name": ("CASE WHEN doc_id % 4 = 0 THEN concat('  ', lower(source), ' motor co ') "
                     "ELSE concat(upper(source), ' MOTOR CO') END"),
        "maketxt": "upper(lang)",
        "modeltxt": "concat('M', CAST(doc_id % 50 AS STRING))",
        "yeartxt": "CASE WHEN doc_id % 13 = 0 THEN '9999' ELSE CAST(1990 + doc_id % 35 AS STRING) END",
        "crash": ("CASE WHEN doc_id % 5 = 0 THEN 'Y' WHEN doc_id % 5 = 1 THEN 'n' "
                  "WHEN doc_id % 5 = 2 THEN '' ELSE 'N' END"),
        "faildate": ("CASE WHEN doc_id % 17 = 0 THEN '' WHEN doc_id % 19 = 0 THEN '20201399' "
                     "WHEN doc_id % 23 = 0 THEN '20990101' WHEN doc_id % 29 = 0 THEN '18500101' "
                     f"ELSE {ymd} END"),
        "miles": ("CASE WHEN doc_id % 7 = 0 THEN 'N/A' WHEN doc_id % 7 = 1 THEN '' "
                  "WHEN doc_id % 7 = 2 THEN concat(' ', CAST(n_chars AS STRING), ' ') "
                  "ELSE CAST(n_chars AS STRING) END"),
        "compdesc": ("CASE WHEN doc_id % 31 = 0 THEN 'ABC' WHEN doc_id % 2 = 0 THEN concat('AIR BAGS:', upper(lang)) "
                     "ELSE concat('SERVICE BRAKES:\"', upper(lang), '\"') END"),
        "cdescr": "text",
    }
    cols = ["doc_id AS seq"] + [f"{special.get(c, chr(39) * 2)} AS {c}" for c in RAW_COLUMNS]
    return documents.selectExpr(*cols)


def corpus(embeddings: DataFrame, documents: DataFrame) -> DataFrame:
    """Vector corpus: one row per embedding, text from the matching document."""
    e = embeddings.alias("e")
    t = documents.select("doc_id", "text", "source").alias("t")
    i = F.col("e.vec_id")
    return (e.join(t, F.col("t.doc_id") == i, "left")
            .select(i.alias("id"), _pad9(i).alias("cmplid"), _pad9((i / 3).cast("long")).alias("odino"),
                    F.when(F.col("t.source").isNotNull(),
                           F.concat(F.upper("t.source"), F.lit("_MOTOR_CO"))).alias("mfr_name"),
                    F.concat(F.lit("M"), (i % 50).cast("string")).alias("modeltxt"),
                    F.when(i % 37 != 0, F.concat(F.lit("COMPONENT "), F.col("e.label").cast("string")))
                    .alias("compdesc"),
                    F.col("t.text").alias("cdescr"),
                    F.col("e.embedding").alias("embedding"),
                    F.col("e.label").alias("label")))


def vectors(embeddings: DataFrame) -> DataFrame:
    """Scoring input: ``(id, embedding, label)`` straight from the embeddings table.

    Vector search reads only this; document fields are joined onto the k
    results per query afterwards (``topk.attach_docs``), so no query plan joins
    the documents table just to score.
    """
    return embeddings.select(F.col("vec_id").alias("id"), "embedding", "label")


def query_vectors(vectors_df: DataFrame) -> DataFrame:
    """Every corpus record asked as a query, vectors only: ``(incident_id, qv)``."""
    return vectors_df.select(F.col("id").alias("incident_id"), F.col("embedding").alias("qv"))


def incidents(corpus_df: DataFrame) -> DataFrame:
    """Every corpus record is also asked as an incident (its own row excluded from results)."""
    return corpus_df.select(
        F.col("id").alias("incident_id"),
        F.col("embedding").alias("qv"),
        F.concat(F.lit("COMPONENT "), F.col("label").cast("string")).alias("expected_component"),
        F.coalesce(F.col("cdescr"), F.lit("")).alias("incident_text"))


def drafts(retrieved: DataFrame) -> DataFrame:
    """Draft per incident citing its rank-1 and rank-3 documents (rules in FIXTURES §2.2)."""
    r = retrieved
    firsts = (r.groupBy("incident_id")
              .agg(F.min(F.when(F.col("rank") == 1, F.col("id"))).alias("r1"),
                   F.min(F.when(F.col("rank") == 3, F.col("id"))).alias("r3")))
    i = F.col("incident_id")
    body = F.concat(F.lit("Cause A ["), F.col("r1").cast("string"), F.lit("]. Cause B ["),
                    F.col("r3").cast("string"), F.lit("]."))
    draft = (F.when(i % 5 == 0, F.lit("Insufficient data to conclude."))
             .when(i % 3 == 0, F.concat(body, F.lit(" See [999999].")))
             .otherwise(body))
    return firsts.select(i, draft.alias("draft_report"))


def cause_drafts(retrieved: DataFrame) -> DataFrame:
    """Draft per incident with 0 to 4 causes taken from its first four documents; every sixth leaves a cause without
    citation, every sixth cites a record for another component."""
    r = retrieved.where(F.col("rank") <= 4).groupBy("incident_id").agg(*[
        F.min(F.when(F.col("rank") == k, F.col(c))).alias(f"{n}{k}") for k in range(1, 5) for n, c in (("r", "id"), ("c", "compdesc"))])

    def cause(k: int, claim=None, cite=True):
        tail = F.concat(F.lit(" ["), F.col(f"r{k}").cast("string"), F.lit("].")) if cite else F.lit(".")
        return F.concat(F.lit(f"Cause {'ABCD'[k - 1]}: "), F.lit(claim) if claim else F.col(f"c{k}"), tail, F.lit(" "))

    kind = F.pmod("incident_id", F.lit(6))
    draft = (F.when(kind == 0, F.lit("Insufficient data to conclude.")).when(kind == 1, cause(1))
             .when(kind == 2, F.concat(*map(cause, (1, 2, 3)))).when(kind == 3, F.concat(*map(cause, (1, 2, 3, 4))))
             .when(kind == 4, F.concat(cause(1), cause(2, cite=False)))
             .otherwise(F.concat(cause(1), cause(2, claim="no such part"))))
    return r.select("incident_id", draft.alias("draft_report"))


def messages(events: DataFrame) -> DataFrame:
    """Job messages; every tenth body is not JSON."""
    e = F.col("event_id")
    body = F.when(e % 10 == 0, F.concat(F.lit("not json "), e.cast("string"))).otherwise(
        F.concat(F.lit('{"jobId":"j'), F.col("user_id").cast("string"),
                 F.lit('","bucket":"b","resultKey":"processed/'), (e % 50).cast("string"),
                 F.lit('.csv"}')))
    return events.select(e.alias("message_id"), body.alias("body"), F.col("ts"))


def grades(events: DataFrame) -> DataFrame:
    """Grader outputs: pass, fail, out-of-enum status, not JSON (by ``event_id % 4``)."""
    e = F.col("event_id")
    g = (F.when(e % 4 == 0, F.lit('{"status":"pass","critique":""}'))
         .when(e % 4 == 1, F.lit('{"status":"fail","critique":"no citation"}'))
         .when(e % 4 == 2, F.lit('{"status":"maybe","critique":""}'))
         .otherwise(F.lit("not json")))
    return events.select(e.alias("grade_id"), g.alias("grade_json"),
                         (e % 5).cast("int").alias("revision_count"))


def vec_literals(embeddings: DataFrame) -> DataFrame:
    v = F.col("vec_id")
    lit_ = (F.when(v % 13 == 0, F.lit("")).when(v % 17 == 0, F.lit("[1,x]"))
            .otherwise(F.concat(F.lit("["), (v % 7).cast("string"), F.lit(", "),
                                (v % 11).cast("string"), F.lit("]"))))
    return embeddings.select(v, lit_.alias("literal"))


def load_rows(complaints_df: DataFrame, which: str) -> DataFrame:
    """Typed load rows over the whole complaint view.

    ``base``: key = zero-padded ``seq`` (unique). ``batch``: key = padded
    ``2*seq`` (half the keys exist in the base, half are new), and every row with
    ``seq % 11 == 0`` repeats the previous row's key; it carries a new summary.
    """
    s = F.col("seq")
    if which == "base":
        key = _pad9(s)
        summary = F.concat(F.lit("base "), F.col("compdesc"))
        emb = F.array((s % 7).cast("float"), (s % 11).cast("float"))
    else:
        key = F.when((s % 11 == 0) & (s > 0), _pad9(s * 2 - 2)).otherwise(_pad9(s * 2))
        summary = F.concat(F.lit("batch "), F.col("modeltxt"))
        emb = F.array((s % 5).cast("float"), (s % 13).cast("float"))
    return complaints_df.select(s, key.alias("cmplid"), "odino", "compdesc",
                                summary.alias("summary"), emb.alias("embedding"))
