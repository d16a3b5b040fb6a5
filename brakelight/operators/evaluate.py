"""Deterministic evaluation metrics per case and across runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text


def component_hit_rate(cases: DataFrame, retrieved: DataFrame, case_col: str = "incident_id",
                       expected: str = "expected_component") -> DataFrame:
    """Share of a case's retrieved docs whose component contains the expected text
    (case-insensitive); a null component is a miss; 0.0 when nothing was retrieved."""
    exp = cases.select(case_col, expected)
    hits = (retrieved.join(exp, case_col)
            .groupBy(case_col)
            .agg(F.avg(F.when(F.contains(F.upper("compdesc"), F.upper(F.col(expected))), 1.0)
                       .otherwise(0.0)).alias("component_hit_rate")))
    return (exp.join(hits, case_col, "left")
            .select(case_col, expected, F.coalesce("component_hit_rate", F.lit(0.0)).alias("component_hit_rate")))


def hit_rate_alarm(rates: DataFrame) -> DataFrame:
    """Cases where no retrieved doc matched the expected component."""
    return rates.where(F.col("component_hit_rate") == 0.0)


def eval_context(prefix_cols=("id", "mfr_name", "modeltxt", "compdesc"), body="cdescr") -> "F.Column":
    """``[doc_id=.. mfr=.. model=.. component=..] text`` (missing values print as None)."""
    i, m, mo, c = prefix_cols
    return F.concat(F.lit("[doc_id="), F.col(i).cast("string"), F.lit(" mfr="), text.py_str(m),
                    F.lit(" model="), text.py_str(mo), F.lit(" component="), text.py_str(c), F.lit("] "),
                    text.py_str(body))


def eval_rows(cases: DataFrame, retrieved: DataFrame, drafts: DataFrame, rates: DataFrame) -> DataFrame:
    """Per case: question, contexts in rank order (k at most), response and metadata."""
    ctx = (retrieved.groupBy("incident_id")
           .agg(F.array_sort(F.collect_list(F.struct("rank", eval_context().alias("c")))).alias("_s"))
           .select("incident_id", F.transform("_s", lambda x: x["c"]).alias("retrieved_contexts")))
    return (cases.select("incident_id", F.col("incident_text").alias("user_input"),
                         F.col("case_id"), F.col("category"))
            .join(ctx, "incident_id", "left")
            .join(drafts.select("incident_id", F.col("draft_report").alias("response")), "incident_id", "left")
            .join(rates.select("incident_id", "component_hit_rate"), "incident_id", "left")
            .withColumn("retrieved_contexts", F.coalesce("retrieved_contexts", F.array().cast("array<string>"))))


def metric_spread(runs: DataFrame, case_col: str, metric: str) -> DataFrame:
    """Per case over repeated runs: count, mean, min, max, sample standard deviation."""
    m = F.col(metric)
    return runs.groupBy(case_col).agg(F.count(m).alias("n_runs"), F.avg(m).alias("mean"),
                                      F.min(m).alias("min"), F.max(m).alias("max"),
                                      F.stddev_samp(m).alias("stddev"))
