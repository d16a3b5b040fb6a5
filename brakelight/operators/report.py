"""Retrieval-report operators over a table of incidents.

Inputs are long-form retrieved rows ``(incident_id, id, rank, score, cmplid,
odino, mfr_name, modeltxt, compdesc, cdescr)`` and per-incident drafts. Every
per-incident list is bounded by k (the retrieval depth), so the
``collect_list`` calls below never gather an unbounded group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text
from ..schemas import GRADE, GRADE_STATUSES, MAX_REVISION, RETRIEVED_DOC
from ..operators import topk
from ..session import stored

CITATION_RX = r"\[(\d+)\]"
CONTEXT_SEP = "\n---\n"
CONTEXT_CHARS = 500


def retrieve(corpus: DataFrame, incidents: DataFrame, k: int = 20, method: str = "blocked",
             exclude_self: bool = True, vectors: DataFrame | None = None, once: bool = False) -> DataFrame:
    """Long-form retrieved rows: exact top-k per incident with the document fields.

    ``vectors``: ``(id, embedding)`` table to score (default: ``corpus``); the
    document fields of ``corpus`` are joined onto the k rows per incident only.
    ``once``: the search runs now and its rows are stored, for callers that read the result more than once.
    """
    ranked = topk.topk_exact(vectors if vectors is not None else corpus, incidents, k, method=method,
                             exclude_self=exclude_self)
    if once:
        ranked = stored(ranked, "ranked")
    return (topk.attach_docs(ranked, corpus)
            .select(F.col("qid").alias("incident_id"), "id", "rank", "score", "cmplid", "odino",
                    "mfr_name", "modeltxt", "compdesc", "cdescr"))


def docs_array(retrieved: DataFrame) -> DataFrame:
    """``(incident_id, retrieved_docs array<struct>)`` in rank order (k entries at most)."""
    fields = [f.name for f in RETRIEVED_DOC.fields]
    return (retrieved.groupBy("incident_id")
            .agg(F.array_sort(F.collect_list(F.struct("rank", F.struct(*fields).alias("d")))).alias("_s"))
            .select("incident_id", F.transform("_s", lambda x: x["d"]).alias("retrieved_docs")))


def _ordered_join(df: DataFrame, group: str, order: str, piece, sep: str, alias: str) -> DataFrame:
    return (df.groupBy(group)
            .agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), piece.alias("p")))).alias("_s"))
            .select(group, F.array_join(F.transform("_s", lambda x: x["p"]), sep).alias(alias)))


def context_piece() -> "F.Column":
    return F.concat(F.lit("["), F.col("id").cast("string"), F.lit("] (score="), text.fixed2("score"),
                    F.lit(", component category: "), text.or_default("compdesc"), F.lit(") "),
                    F.substring(F.coalesce(F.col("cdescr"), F.lit("")), 1, CONTEXT_CHARS))


def context_pack(retrieved: DataFrame) -> DataFrame:
    """Per incident: ``[id] (score=0.83, component category: X) text[:500]`` joined by ``\\n---\\n``."""
    return _ordered_join(retrieved, "incident_id", "rank", context_piece(), CONTEXT_SEP, "context")


# Short neutral defaults; the wording of requests is a parameter of the operators.
ANALYSIS_TEMPLATE = "Incident:\n{incident_text}\n\nRecords:\n{context}\n\nName the cause and its records.{revision}"
REVISION_TEMPLATE = "\n\nLast review: {critique}"


def fill_template(template: str, values: dict) -> "F.Column":
    """Substitute ``{name}`` placeholders with columns (JVM ``concat``)."""
    import re
    parts = re.split(r"\{(\w+)\}", template)
    cols = []
    for i, p in enumerate(parts):
        if i % 2 == 0:
            if p:
                cols.append(F.lit(p))
        else:
            cols.append(values[p])
    return F.concat(*cols)


def prompt_rows(states: DataFrame, contexts: DataFrame, template: str = ANALYSIS_TEMPLATE,
                revision: str = REVISION_TEMPLATE) -> DataFrame:
    """Analysis request per incident; the critique paragraph only when a critique exists."""
    crit = F.coalesce(F.col("critique"), F.lit(""))
    rev = F.when(crit != "", fill_template(revision, {"critique": crit})).otherwise(F.lit(""))
    j = states.join(contexts, "incident_id", "left")
    return j.select("incident_id", fill_template(template, {
        "incident_text": F.coalesce(F.col("incident_text"), F.lit("")),
        "context": F.coalesce(F.col("context"), F.lit("")),
        "revision": rev}).alias("prompt"))


# Short neutral default, as above.
GRADE_TEMPLATE = "Report:\n{draft}\n\nReply with JSON: status (pass or fail), critique."


def grade_prompt_rows(drafts: DataFrame, template: str = GRADE_TEMPLATE, col: str = "draft_report") -> DataFrame:
    """Grading request per draft."""
    return drafts.select("incident_id", fill_template(template, {
        "draft": F.coalesce(F.col(col), F.lit(""))}).alias("grade_prompt"))


def initial_states(incidents: DataFrame, max_revision: int = MAX_REVISION) -> DataFrame:
    """Incident request -> initial state row."""
    return incidents.select(
        "incident_id", "incident_text",
        F.lit("").alias("draft_report"), F.lit("").alias("critique"),
        F.lit(0).alias("revision_count"), F.lit(max_revision).alias("max_revision"),
        F.lit("pending").alias("status"), F.lit(None).cast("string").alias("report"))


def extract_citations(drafts: DataFrame, col: str = "draft_report") -> DataFrame:
    """Distinct cited ids (first-seen order) per draft: ``citations array<string>``."""
    return drafts.withColumn("citations", F.array_distinct(
        F.regexp_extract_all(F.coalesce(F.col(col), F.lit("")), F.lit(CITATION_RX), F.lit(1))))


def _cited_long(drafts: DataFrame) -> DataFrame:
    return (extract_citations(drafts).select("incident_id", F.posexplode("citations").alias("pos", "cited_id")))


def cited_docs(retrieved: DataFrame, drafts: DataFrame) -> DataFrame:
    """Retrieved rows whose id is cited by the incident's draft (semi-join)."""
    cited = _cited_long(drafts).select("incident_id", F.col("cited_id").alias("_cid"))
    r = retrieved.withColumn("_cid", F.col("id").cast("string"))
    return r.join(cited, ["incident_id", "_cid"], "left_semi").drop("_cid")


def invented_citations(retrieved: DataFrame, drafts: DataFrame) -> DataFrame:
    """Cited ids that were never retrieved for that incident (anti-join)."""
    cited = _cited_long(drafts)
    r = retrieved.select("incident_id", F.col("id").cast("string").alias("cited_id"))
    return cited.join(r, ["incident_id", "cited_id"], "left_anti")


def reference_piece() -> "F.Column":
    return F.concat(F.lit("- ["), F.col("id").cast("string"), F.lit("] ODI #"), text.py_str("odino"),
                    F.lit(" | "), text.py_str("mfr_name"), F.lit(" "), text.py_str("modeltxt"), F.lit(" | "),
                    text.or_default("compdesc"), F.lit(" (score="), text.fixed2("score"), F.lit(")"))


def reference_list(retrieved: DataFrame, drafts: DataFrame) -> DataFrame:
    """Per draft: cited documents only, one line each in rank order ('' when none)."""
    refs = _ordered_join(cited_docs(retrieved, drafts), "incident_id", "rank", reference_piece(), "\n",
                         "references")
    return (drafts.select("incident_id").join(refs, "incident_id", "left")
            .select("incident_id", F.coalesce("references", F.lit("")).alias("references")))


REPORT_TEMPLATE = ("# Root Cause Analysis Report\n\n## Incident\n{incident}\n\n## Analysis\n{analysis}\n\n"
                   "## Revisions\n{revisions}\n\n## References\n{references}\n")


def final_report(states: DataFrame, references: DataFrame, template: str = REPORT_TEMPLATE) -> DataFrame:
    """Report text per incident; incident, analysis and references are defanged."""
    j = states.join(references, "incident_id", "left")
    return j.select("incident_id", fill_template(template, {
        "incident": text.defang_links_once(F.coalesce("incident_text", F.lit(""))),
        "analysis": text.defang_links_once(F.coalesce("draft_report", F.lit(""))),
        "revisions": F.col("revision_count").cast("string"),
        "references": text.defang_links_once(F.coalesce("references", F.lit(""))),
    }).alias("report"))


def parse_grades(df: DataFrame, col: str = "grade_json") -> DataFrame:
    """Decode grader output ``{status, critique}``; exactly these two keys, status in pass/fail.

    Adds ``status``, ``critique``, ``grade_ok`` and ``grade_error``.
    """
    schema = T.StructType(GRADE.fields + [T.StructField("_corrupt_record", T.StringType())])
    p = F.from_json(F.col(col), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    keys = F.json_object_keys(F.col(col))
    not_json = p.isNull() | p["_corrupt_record"].isNotNull() | keys.isNull()
    error = (F.when(not_json, F.lit("not a JSON object"))
             .when(F.size(keys) != 2, F.lit("unexpected keys"))
             .when(p["status"].isNull() | p["critique"].isNull(), F.lit("missing field"))
             .when(~p["status"].isin(*GRADE_STATUSES), F.lit("status not in enum")))
    return df.withColumns({
        "status": F.when(error.isNull(), p["status"]),
        "critique": F.when(error.isNull(), p["critique"]),
        "grade_ok": error.isNull(),
        "grade_error": error,
    })


def route(status="status", revision_count="revision_count", max_revision="max_revision") -> "F.Column":
    """Next step: ``action`` on pass or when revisions are used up, else ``analysis``."""
    return (F.when(F.col(status) == "pass", F.lit("action"))
            .when(F.col(revision_count) >= F.col(max_revision), F.lit("action"))
            .otherwise(F.lit("analysis")))


def rule_grade(retrieved: DataFrame, drafts: DataFrame, max_causes: int = 3) -> DataFrame:
    """Model-free grade: at least one citation, every cited id retrieved, at most ``max_causes`` ids."""
    cites = extract_citations(drafts).select("incident_id", F.size("citations").alias("n_cited"))
    inv = invented_citations(retrieved, drafts).groupBy("incident_id").agg(F.count(F.lit(1)).alias("n_invented"))
    j = cites.join(inv, "incident_id", "left").fillna(0, ["n_invented"])
    critique = (F.when(F.col("n_cited") == 0, F.lit("no citation"))
                .when(F.col("n_invented") > 0, F.lit("cites a complaint that was not retrieved"))
                .when(F.col("n_cited") > max_causes, F.lit("too many causes")))
    return j.select("incident_id", F.when(critique.isNull(), F.lit("pass")).otherwise(F.lit("fail")).alias("status"),
                    F.coalesce(critique, F.lit("")).alias("critique"))


#: where a cause begins in a draft
CAUSE_RX = r"(?i)\bcause [a-z0-9]+\b"


def draft_causes(drafts: DataFrame, col: str = "draft_report") -> DataFrame:
    """(incident_id, cause, claim, cited): the causes that a draft lists, in order from 1, each with the text up to the next
    one and the distinct ids cited in it. A draft that names no cause has no row; a null draft is empty."""
    pieces = F.split(F.coalesce(F.col(col), F.lit("")), CAUSE_RX, -1)
    rows = drafts.select("incident_id", F.posexplode(F.slice(pieces, F.lit(2), F.size(pieces))).alias("cause", "claim"))
    return rows.select("incident_id", (F.col("cause") + 1).alias("cause"), "claim",
                       F.array_distinct(F.regexp_extract_all("claim", F.lit(CITATION_RX), F.lit(1))).alias("cited"))


def cause_grade(retrieved: DataFrame, drafts: DataFrame, max_causes: int = 3) -> DataFrame:
    """Model-free grade of the causes of each draft: incident_id, n_causes, n_uncited, n_misapplied, status, critique.

    Every cause needs a citation of its own, and one of its cited records must have been retrieved and have a component
    that the claim names (any case); at most ``max_causes`` causes. A draft without causes fails. Records without a
    component support nothing; repeated drafts of an incident are graded together.
    """
    causes = draft_causes(drafts)
    records = retrieved.select("incident_id", F.col("id").cast("string").alias("cited_id"), "compdesc")
    named = F.coalesce((F.col("compdesc") != "") & F.contains(F.upper("claim"), F.upper("compdesc")), F.lit(False))
    cited = causes.select("incident_id", "cause", "claim", F.size("cited").alias("n_cited"), F.explode_outer("cited").alias("cited_id"))
    each = (cited.join(records, ["incident_id", "cited_id"], "left").groupBy("incident_id", "cause")
            .agg(F.max("n_cited").alias("n_cited"), F.max(named).alias("supported")))
    per = each.groupBy("incident_id").agg(
        F.count(F.lit(1)).alias("n_causes"), F.count_if(F.col("n_cited") == 0).alias("n_uncited"),
        F.count_if((F.col("n_cited") > 0) & ~F.col("supported")).alias("n_misapplied"))
    j = drafts.select("incident_id").distinct().join(per, "incident_id", "left").fillna(0, ["n_causes", "n_uncited", "n_misapplied"])
    critique = (F.when(F.col("n_causes") == 0, F.lit("no cause"))
                .when(F.col("n_uncited") > 0, F.lit("a cause has no citation of its own"))
                .when(F.col("n_misapplied") > 0, F.lit("a citation does not support its cause"))
                .when(F.col("n_causes") > max_causes, F.lit("too many causes")))
    return j.select("*", F.when(critique.isNull(), F.lit("pass")).otherwise(F.lit("fail")).alias("status"),
                    F.coalesce(critique, F.lit("")).alias("critique"))


def grounding_ratio(retrieved: DataFrame, drafts: DataFrame) -> DataFrame:
    """Share of cited ids that were retrieved; null when nothing is cited."""
    cites = extract_citations(drafts).select("incident_id", F.size("citations").alias("n_cited"))
    ok = (cited_docs(retrieved, drafts).groupBy("incident_id").agg(F.count(F.lit(1)).alias("n_grounded")))
    j = cites.join(ok, "incident_id", "left").fillna(0, ["n_grounded"])
    return j.select("incident_id", "n_cited", "n_grounded",
                    F.when(F.col("n_cited") > 0, F.col("n_grounded") / F.col("n_cited")).alias("grounding_ratio"))
