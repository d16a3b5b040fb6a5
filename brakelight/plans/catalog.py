"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus DuckDB oracle SQL.

Each query reads the driver tables through ``plans/views.py`` and calls the
library operators; the output is flattened to scalar columns (dates as ISO
text, scores rounded to 6 places) so that both engines can be compared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import coerce, text, vectors
from ..functions.sql import ident
from ..operators import clean, topk
from ..schemas import DATE_COLUMNS, NUMERIC_COLUMNS, RAW_COLUMNS, SUMMARY_PIPE_COLUMNS
from . import oracle as O
from . import views as V

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def _complaints(spark: SparkSession, sf: str) -> DataFrame:
    return V.complaints(V.table(spark, sf, "documents"))


def _corpus(spark: SparkSession, sf: str) -> DataFrame:
    return V.corpus(V.table(spark, sf, "embeddings"), V.table(spark, sf, "documents"))


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    return V.vectors(V.table(spark, sf, "embeddings"))


def _dates_as_text(df: DataFrame) -> DataFrame:
    return df.selectExpr(*[f"date_format({ident(f.name)}, 'yyyy-MM-dd') AS {ident(f.name)}"
                           if f.dataType.simpleString() == "date" else ident(f.name)
                           for f in df.schema.fields])


# ---------------------------------------------------------------- vectors
@query("l2_normalize", """
SELECT vec_id, round(nrm, 6) AS norm_in,
       round(list_sum(list_transform(embedding, lambda x: CAST(CAST(CAST(x AS DOUBLE) / nrm AS FLOAT) AS DOUBLE))), 6) AS sum_out,
       round(sqrt(list_sum(list_transform(embedding, lambda x: pow(CAST(CAST(CAST(x AS DOUBLE) / nrm AS FLOAT) AS DOUBLE), 2)))), 6) AS norm_out
FROM (SELECT vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS nrm
      FROM embeddings)""")
def q_l2_normalize(spark, sf):
    e = V.table(spark, sf, "embeddings")
    n = e.select("vec_id", "embedding", vectors.l2_normalize("embedding").alias("u"))
    return n.select("vec_id", F.round(vectors.norm("embedding"), 6).alias("norm_in"),
                    F.round(F.aggregate("u", F.lit(0.0), lambda a, x: a + x.cast("double")), 6).alias("sum_out"),
                    F.round(vectors.norm("u"), 6).alias("norm_out"))


@query("topk_exact", O.with_views(
    "SELECT incident_id, id, rank, score FROM retrieved", corpus=True))
def q_topk_exact(spark, sf):
    v = _vectors(spark, sf)
    r = topk.topk_exact(v, V.query_vectors(v), k=20)
    return r.select(F.col("qid").alias("incident_id"), "id", F.col("rank").cast("long").alias("rank"),
                    F.round("score", 6).alias("score"))


# ---------------------------------------------------------------- cleaning steps
@query("strip_quotes", O.with_views(
    "SELECT seq, " + ", ".join(f"replace({c}, '\"', '') AS {c}" for c in RAW_COLUMNS) + " FROM complaints",
    complaints=True))
def q_strip_quotes(spark, sf):
    return clean.strip_quotes(_complaints(spark, sf))


@query("coerce_numeric", O.with_views(
    "SELECT seq, cmplid, " + ", ".join(f"TRY_CAST(trim({c}) AS DOUBLE) AS {c}" for c in NUMERIC_COLUMNS)
    + " FROM complaints", complaints=True))
def q_coerce_numeric(spark, sf):
    return clean.coerce_numeric(_complaints(spark, sf)).select("seq", "cmplid", *NUMERIC_COLUMNS)


@query("parse_dates", O.with_views(
    "SELECT seq, " + ", ".join(f"{O.date_text_sql(O.compact_date_sql(c))} AS {c}" for c in DATE_COLUMNS)
    + " FROM complaints", complaints=True))
def q_parse_dates(spark, sf):
    return _dates_as_text(clean.parse_dates(_complaints(spark, sf)).select("seq", *DATE_COLUMNS))


_GUARD_COLS = [x for c in DATE_COLUMNS for x in (c, c + "_raw_invalid")]


@query("date_range_guard", O.with_views(
    "SELECT seq, " + ", ".join(
        f"{O.date_text_sql(O.guard_sql('d_' + c, True))} AS {c}, "
        f"{O.date_text_sql(O.guard_sql('d_' + c, False))} AS {c}_raw_invalid" for c in DATE_COLUMNS)
    + " FROM (SELECT seq, " + ", ".join(f"{O.compact_date_sql(c)} AS d_{c}" for c in DATE_COLUMNS)
    + " FROM complaints)", complaints=True))
def q_date_range_guard(spark, sf):
    df = clean.date_range_guard(clean.parse_dates(_complaints(spark, sf)))
    return _dates_as_text(df.select("seq", *_GUARD_COLS))


@query("filter_short_text", O.with_views(
    "SELECT seq, cmplid, compdesc FROM complaints WHERE length(compdesc) > 5", complaints=True))
def q_filter_short_text(spark, sf):
    return clean.filter_short_text(_complaints(spark, sf)).select("seq", "cmplid", "compdesc")


@query("canonical_name", O.with_views(
    f"SELECT seq, {O.canonical_sql('mfr_name')} AS mfr_name FROM complaints", complaints=True))
def q_canonical_name(spark, sf):
    return clean.canonical_names(_complaints(spark, sf)).select("seq", "mfr_name")


@query("summary_sentence", O.with_views(
    f"SELECT seq, {O.sentence_sql()} AS summary FROM complaints", complaints=True))
def q_summary_sentence(spark, sf):
    return _complaints(spark, sf).select("seq", text.summary_sentence().alias("summary"))


@query("summary_pipe", O.with_views(
    f"SELECT seq, {O.pipe_summary_sql(SUMMARY_PIPE_COLUMNS)} AS summary FROM complaints", complaints=True))
def q_summary_pipe(spark, sf):
    return _complaints(spark, sf).select("seq", text.summary_pipe(SUMMARY_PIPE_COLUMNS).alias("summary"))


@query("summary_fallback", O.with_views(
    f"""SELECT seq, CASE WHEN coalesce(NOT {O.nonblank_sql('s')}, TRUE) THEN 'NO_DESCRIPTION_AVAILABLE' ELSE s END AS summary,
       coalesce(NOT {O.nonblank_sql('s')}, TRUE) AS used_fallback
FROM (SELECT seq, {O.pipe_summary_sql(SUMMARY_PIPE_COLUMNS)} AS s FROM complaints)""", complaints=True))
def q_summary_fallback(spark, sf):
    df = _complaints(spark, sf).select("seq", text.summary_pipe(SUMMARY_PIPE_COLUMNS).alias("s"))
    return df.select("seq", text.with_fallback(F.col("s")).alias("summary"),
                     F.coalesce(text.is_blank("s"), F.lit(True)).alias("used_fallback"))


@query("embed_input", O.with_views(
    f"SELECT seq, 'search_document: ' || coalesce({O.pipe_summary_sql(SUMMARY_PIPE_COLUMNS)}, '') AS embed_text "
    "FROM complaints", complaints=True))
def q_embed_input(spark, sf):
    df = _complaints(spark, sf)
    return df.select("seq", text.task_prefix(text.summary_pipe(SUMMARY_PIPE_COLUMNS)).alias("embed_text"))


@query("parse_yn", O.with_views(
    f"SELECT seq, crash, {O.yn_sql('crash')} AS crash_flag FROM complaints", complaints=True))
def q_parse_yn(spark, sf):
    return _complaints(spark, sf).select("seq", "crash", coerce.parse_yn("crash").alias("crash_flag"))


@query("int_or_zero", O.with_views(
    f"SELECT seq, miles, {O.int_or_zero_sql('miles')} AS miles_int, "
    f"{O.int_or_zero_sql('miles', strict=True)} AS miles_strict FROM complaints", complaints=True))
def q_int_or_zero(spark, sf):
    return _complaints(spark, sf).select("seq", "miles", coerce.int_or_zero("miles").alias("miles_int"),
                                         coerce.int_or_zero("miles", strict=True).alias("miles_strict"))


@query("dedup_first", O.with_views(
    "SELECT seq, cmplid, odino, compdesc FROM complaints "
    "QUALIFY row_number() OVER (PARTITION BY cmplid ORDER BY seq) = 1", complaints=True))
def q_dedup_first(spark, sf):
    return clean.dedup_first(_complaints(spark, sf)).select("seq", "cmplid", "odino", "compdesc")


@query("merge_by_report", O.with_views(
    """SELECT r.odino, r.seq, r.cmplid, coalesce(j.compdesc, '') AS compdesc, r.modeltxt, r.miles
FROM (SELECT odino, min(seq) AS seq, min(cmplid) AS cmplid,
             arg_min(modeltxt, seq) FILTER (WHERE modeltxt IS NOT NULL) AS modeltxt,
             arg_min(miles, seq) FILTER (WHERE miles IS NOT NULL) AS miles
      FROM (SELECT seq, odino, cmplid, compdesc, modeltxt, TRY_CAST(trim(miles) AS DOUBLE) AS miles FROM complaints)
      GROUP BY odino) r
LEFT JOIN (SELECT odino, string_agg(compdesc, ' | ' ORDER BY f) AS compdesc
           FROM (SELECT odino, compdesc, min(seq) AS f FROM complaints GROUP BY odino, compdesc)
           WHERE compdesc IS NOT NULL GROUP BY odino) j USING (odino)""", complaints=True))
def q_merge_by_report(spark, sf):
    df = clean.coerce_numeric(_complaints(spark, sf).select("seq", "odino", "cmplid", "compdesc",
                                                             "modeltxt", "miles"), ["miles"])
    return clean.merge_by_report(df)


_CLEAN_OUT = ["seq", "odino", "cmplid", "compdesc", "summary"] + \
    [c for c in RAW_COLUMNS if c not in ("odino", "cmplid", "compdesc")] + [d + "_raw_invalid" for d in DATE_COLUMNS]


def _clean_sql_select() -> str:
    cols = []
    for c in _CLEAN_OUT:
        if c in DATE_COLUMNS or c.endswith("_raw_invalid"):
            cols.append(f"{O.date_text_sql(c)} AS {c}")
        else:
            cols.append(c)
    return "SELECT " + ", ".join(cols) + " FROM clean"


@query("clean_complaints", O.with_views(_clean_sql_select(), complaints=True, extra=O.clean_ctes()))
def q_clean_complaints(spark, sf):
    return _dates_as_text(clean.clean_complaints(_complaints(spark, sf)).select(*_CLEAN_OUT))


@query("defang_urls", f"SELECT page_id, {O.defang_sql('url')} AS url FROM pages")
def q_defang_urls(spark, sf):
    return V.table(spark, sf, "pages").select("page_id", text.defang_links("url").alias("url"))


@query("defang_html", f"SELECT page_id, {O.defang_sql('html')} AS html FROM pages")
def q_defang_html(spark, sf):
    return V.table(spark, sf, "pages").select("page_id", text.defang_links("html").alias("html"))


# ---------------------------------------------------------------- typed corpus, audits, quarantine
from ..operators import audit, evaluate, report, typed  # noqa: E402


def _guarded_text(spark, sf) -> DataFrame:
    """Complaints after date parsing and range guard, rendered in processed text form."""
    g = clean.date_range_guard(clean.parse_dates(_complaints(spark, sf)))
    return typed.processed_text(g)


_PAIR_SQL_SRC = ("(SELECT seq, " + ", ".join(
    f"coalesce({O.date_text_sql(O.guard_sql(O.compact_date_sql(c), True))}, '') AS {c}, "
    f"coalesce({O.date_text_sql(O.guard_sql(O.compact_date_sql(c), False))}, '') AS {c}_raw_invalid"
    for c in DATE_COLUMNS) + " FROM complaints)")


def _pair_select() -> str:
    out = []
    for c in DATE_COLUMNS:
        d, m = O.date_pair_sql(c, c + "_raw_invalid")
        out.append(f"{O.date_text_sql(d)} AS {c}, {m} AS {c}_raw_invalid")
    return ", ".join(out)


@query("date_pair", O.with_views(f"SELECT seq, {_pair_select()} FROM {_PAIR_SQL_SRC}", complaints=True))
def q_date_pair(spark, sf):
    t = _guarded_text(spark, sf)
    cols = [F.col("seq")]
    for c in DATE_COLUMNS:
        d, m = coerce.date_pair(F.col(c), F.col(c + "_raw_invalid"))
        cols += [F.date_format(d, "yyyy-MM-dd").alias(c), m.alias(c + "_raw_invalid")]
    return t.select(*cols)


def _typed_sql(keep=("seq",), src_sql: str | None = None) -> str:
    from ..schemas import FLAG_COLUMNS, PROCESSED_COLUMNS
    cols = list(keep)
    for c in PROCESSED_COLUMNS:
        if c == "embedding" or c.endswith("_raw_invalid"):
            continue
        src = f"coalesce({c}, '')"
        if c in FLAG_COLUMNS:
            cols.append(f"{O.yn_sql(src)} AS {c}")
        elif c in NUMERIC_COLUMNS:
            cols.append(f"{O.int_or_zero_sql(src)} AS {c}")
        elif c in DATE_COLUMNS:
            d, m = O.date_pair_sql(src, f"coalesce({c}_raw_invalid, '')")
            cols.append(f"{O.date_text_sql(d)} AS {c}, {m} AS {c}_raw_invalid")
        else:
            cols.append(f"{O.strip_ws_sql(src)} AS {c}")
    cols.append(f"CASE WHEN {O.strip_ws_sql('coalesce(cmplid, chr(0))')} = '' THEN 'missing cmplid' END AS reject_reason")
    # processed text form of the clean output: numbers as text, dates ISO, missing -> ''
    txt = ["seq"]
    from ..schemas import CLEAN_COLUMNS
    for c in CLEAN_COLUMNS:
        if c in DATE_COLUMNS or c.endswith("_raw_invalid"):
            txt.append(f"coalesce({O.date_text_sql(c)}, '') AS {c}")
        elif c in NUMERIC_COLUMNS:
            txt.append(f"coalesce(CAST({c} AS VARCHAR), '') AS {c}")
        else:
            txt.append(f"coalesce({c}, '') AS {c}")
    src = src_sql or f"SELECT {', '.join(txt)} FROM clean"
    return f"SELECT {', '.join(cols)} FROM ({src})"


def _load_jobs_sql() -> str:
    from ..schemas import CLEAN_COLUMNS
    txt = ["'processed/' || CAST(seq % 50 AS VARCHAR) || '.csv' AS result_key"]
    for c in CLEAN_COLUMNS:
        if c in DATE_COLUMNS or c.endswith("_raw_invalid"):
            txt.append(f"coalesce({O.date_text_sql(c)}, '') AS {c}")
        elif c in NUMERIC_COLUMNS:
            txt.append(f"coalesce(CAST({c} AS VARCHAR), '') AS {c}")
        else:
            txt.append(f"coalesce({c}, '') AS {c}")
    src = (f"SELECT t.*, j.n_messages, j.first_job_id FROM (SELECT {', '.join(txt)} FROM clean) t JOIN "
           "(SELECT json_extract_string(body, '$.resultKey') AS result_key, count(*) AS n_messages, "
           "min(json_extract_string(body, '$.jobId')) AS first_job_id FROM dm WHERE is_valid GROUP BY 1) j "
           "USING (result_key)")
    return _typed_sql(keep=("result_key", "n_messages", "first_job_id"), src_sql=src)


@query("typed_corpus", O.with_views(_typed_sql(), complaints=True, extra=O.clean_ctes()))
def q_typed_corpus(spark, sf):
    t = typed.typed_rows(typed.processed_text(clean.clean_complaints(_complaints(spark, sf))))
    return _dates_as_text(t)


@query("constraint_audit")
def q_constraint_audit(spark, sf):
    df = _complaints(spark, sf).withColumn("summary", text.summary_sentence())
    return audit.constraint_audit(df)


def _audit_sql() -> str:
    from ..schemas import BOUNDED_LENGTHS
    rules = [("cmplid_null", "count_if(cmplid IS NULL)"), ("cmplid_blank", "count_if(cmplid = '')"),
             ("cmplid_repeated", "count(cmplid) - count(DISTINCT cmplid)"),
             ("odino_null", "count_if(odino IS NULL)"), ("summary_null", f"count_if(({O.sentence_sql()}) IS NULL)")]
    rules += [(f"{c}_over_{n}", f"count_if(length({c}) > {n})") for c, n in BOUNDED_LENGTHS]
    return " UNION ALL ".join(f"SELECT '{r}' AS rule, CAST({e} AS BIGINT) AS violations FROM complaints"
                              for r, e in rules)


SQL["constraint_audit"] = O.with_views(_audit_sql(), complaints=True)


@query("blank_profile", O.with_views(
    "SELECT CAST(count_if(mfr_name = '') AS BIGINT) AS blank_mfr_name, CAST(count_if(cmplid = '') AS BIGINT) AS blank_cmplid, "
    "CAST(count_if(odino = '') AS BIGINT) AS blank_odino FROM complaints", complaints=True))
def q_blank_profile(spark, sf):
    return audit.blank_profile(_complaints(spark, sf))


@query("invalid_date_rows", O.with_views(
    "SELECT seq, cmplid, " + ", ".join(f"{O.date_text_sql(c + '_raw_invalid')} AS {c}_raw_invalid" for c in DATE_COLUMNS)
    + " FROM (SELECT seq, cmplid, " + ", ".join(f"{O.guard_sql(O.compact_date_sql(c), False)} AS {c}_raw_invalid"
                                             for c in DATE_COLUMNS)
    + " FROM complaints) WHERE coalesce(" + ", ".join(f"{c}_raw_invalid" for c in DATE_COLUMNS) + ") IS NOT NULL",
    complaints=True))
def q_invalid_date_rows(spark, sf):
    g = clean.date_range_guard(clean.parse_dates(_complaints(spark, sf)))
    return _dates_as_text(audit.invalid_date_rows(g))


@query("field_length_probe", O.with_views(
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST(max(length({c})) AS BIGINT) AS max_length FROM complaints"
                       for c in RAW_COLUMNS), complaints=True))
def q_field_length_probe(spark, sf):
    return audit.field_length_probe(_complaints(spark, sf), RAW_COLUMNS)


@query("sensitive_value_flags", O.with_views(
    f"""SELECT seq, regexp_matches(coalesce(cdescr, ''), {O.q(audit.EMAIL_RX)}) AS has_email,
       regexp_matches(coalesce(cdescr, ''), {O.q(audit.PHONE_RX)}) AS has_phone,
       regexp_matches(coalesce(cdescr, ''), {O.q(audit.VIN_RX)}) AS has_vin,
       length({O.strip_ws_sql("coalesce(cdescr, '')")}) < {audit.SHORT_CONTEXT_CHARS} AS short_context
FROM complaints""", complaints=True))
def q_sensitive_value_flags(spark, sf):
    return audit.sensitive_value_flags(_complaints(spark, sf))


@query("quarantine_rows", O.with_views(
    """SELECT seq, cmplid, 'short_compdesc' AS reason FROM s1 WHERE length(compdesc) <= 5
UNION ALL
SELECT seq, cmplid, 'duplicate_cmplid' AS reason FROM s1 WHERE length(compdesc) > 5
QUALIFY row_number() OVER (PARTITION BY cmplid ORDER BY seq) > 1""", complaints=True,
    extra="s1 AS (SELECT seq, cmplid, replace(compdesc, '\"', '') AS compdesc FROM complaints)"))
def q_quarantine_rows(spark, sf):
    return clean.rejected_rows(_complaints(spark, sf)).select("seq", "cmplid", "reason")


# ---------------------------------------------------------------- vectors
@query("cosine_scores", """
WITH e AS (SELECT vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS nrm FROM embeddings),
q AS (SELECT embedding AS qv, nrm AS qn FROM e WHERE vec_id = (SELECT min(vec_id) FROM embeddings))
SELECT vec_id, round(list_sum(list_transform(range(1, len(embedding) + 1),
       lambda i: CAST(embedding[i] AS DOUBLE) * CAST(qv[i] AS DOUBLE))) / (nrm * qn), 6) AS score
FROM e CROSS JOIN q""")
def q_cosine_scores(spark, sf):
    e = V.table(spark, sf, "embeddings")
    # the one query vector is a scalar subquery (evaluated once, no join)
    qv = e.where(F.col("vec_id") == e.select(F.min("vec_id")).scalar()).select("embedding").scalar()
    return (e.withColumn("qv", qv)
            .select("vec_id", F.round(vectors.cosine("embedding", "qv"), 6).alias("score")))


@query("check_vector_dim", """
SELECT len(embedding) AS dim, count(*) AS n_vectors,
       CAST(count_if(abs(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) - 1.0) > 0.001) AS BIGINT) AS n_not_unit,
       len(embedding) = 64 AS dim_ok
FROM embeddings GROUP BY len(embedding)""")
def q_check_vector_dim(spark, sf):
    r = audit.check_vector_dim(V.table(spark, sf, "embeddings"), dim=64)
    return r.withColumn("dim", F.col("dim").cast("long"))


@query("format_embedding_literal")
def q_format_embedding_literal(spark, sf):
    e = V.table(spark, sf, "embeddings")
    return e.select("vec_id", vectors.format_literal("embedding").alias("embedding"))


@query("vector_csv_round_trip", """
SELECT vec_id, label, TRUE AS is_valid, CAST(len(embedding) AS BIGINT) AS dim,
       round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 6) AS vsum,
       round(list_sum(list_transform(embedding, lambda x, i: CAST(x AS DOUBLE) * i)), 6) AS placed_sum
FROM embeddings""")
def q_vector_csv_round_trip(spark, sf):
    """Vectors written as literals to an interchange CSV and read back from its files."""
    d = _run_dir(spark, "interchange")
    sinks.write_interchange_csv(V.table(spark, sf, "embeddings").select("vec_id", "label", "embedding"), d)
    back = src.scan_clean_csv(spark, d, required=["vec_id", "embedding"])
    vec, ok = vectors.parse_literal("embedding")
    rows = back.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").try_cast("int").alias("label"),
                       vec.alias("v"), ok.alias("is_valid"))

    def total(values):
        return F.round(F.aggregate(values, F.lit(0.0), lambda a, x: a + x), 6)

    return rows.select("vec_id", "label", "is_valid", F.size("v").cast("long").alias("dim"),
                       total(F.transform("v", lambda x: x.cast("double"))).alias("vsum"),
                       total(F.transform("v", lambda x, i: x.cast("double") * (i + 1))).alias("placed_sum"))


@query("parse_embedding", """
SELECT vec_id, ok AS is_valid, CASE WHEN ok THEN len(vals) END AS dim,
       CASE WHEN ok THEN round(list_sum(list_transform(vals, lambda x: CAST(x AS DOUBLE))), 6) END AS vsum
FROM (SELECT vec_id, vals, coalesce(literal <> '' AND len(list_filter(vals, lambda x: x IS NULL)) = 0, FALSE) AS ok
      FROM (SELECT vec_id, literal, list_transform(string_split(regexp_replace(literal, '^[\\[\\]]+|[\\[\\]]+$', '', 'g'), ','),
                   lambda x: TRY_CAST(trim(x) AS FLOAT)) AS vals
            FROM (SELECT vec_id, CASE WHEN vec_id % 13 = 0 THEN '' WHEN vec_id % 17 = 0 THEN '[1,x]'
                         ELSE '[' || CAST(vec_id % 7 AS VARCHAR) || ', ' || CAST(vec_id % 11 AS VARCHAR) || ']' END AS literal
                  FROM embeddings)))""")
def q_parse_embedding(spark, sf):
    lits = V.vec_literals(V.table(spark, sf, "embeddings"))
    vec, ok = vectors.parse_literal("literal")
    p = lits.select("vec_id", vec.alias("v"), ok.alias("is_valid"))
    return p.select("vec_id", "is_valid", F.size("v").cast("long").alias("dim"),
                    F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double")), 6).alias("vsum"))


# ---------------------------------------------------------------- ranking and retrieval
_TEXT_PRED_SQL = "(cdescr ILIKE '%data%' OR compdesc ILIKE '%component 3%')"


def _text_pred():
    return F.col("cdescr").ilike("%data%") | F.col("compdesc").ilike("%component 3%")


def _retrieved(spark, sf, once: bool = False, context: bool = False) -> tuple[DataFrame, DataFrame]:
    """``context``: the text is read by ``context_pack`` only, so records meet their incidents with as much of it as that takes."""
    c, v = _corpus(spark, sf), _vectors(spark, sf)
    records = c.withColumn("cdescr", F.substring("cdescr", 1, report.CONTEXT_CHARS)) if context else c
    return report.retrieve(records, V.query_vectors(v), k=20, vectors=v, once=once), V.incidents(c)


@query("incident_states", O.with_views(
    "SELECT incident_id, incident_text, '' AS draft_report, '' AS critique, 0 AS revision_count, "
    "3 AS max_revision, 'pending' AS status, CAST(NULL AS VARCHAR) AS report FROM incidents", corpus=True))
def q_incident_states(spark, sf):
    return report.initial_states(V.incidents(_corpus(spark, sf)))


@query("rank_exact", O.with_views(
    "SELECT qid AS incident_id, id, rank, round(score, 6) AS score FROM ranked", corpus=True))
def q_rank_exact(spark, sf):
    v = _vectors(spark, sf)
    r = topk.rank_exact(v, V.query_vectors(v))
    return r.select(F.col("qid").alias("incident_id"), "id", "rank", vectors.round6("score").alias("score"))


@query("rank_then_filter", O.with_views(
    f"""SELECT r.qid AS incident_id, r.id, r.rank, round(r.score, 6) AS score
FROM ranked r JOIN corpus c ON c.id = r.id
WHERE {_TEXT_PRED_SQL}
QUALIFY row_number() OVER (PARTITION BY r.qid ORDER BY r.rank) <= 30""", corpus=True))
def q_rank_then_filter(spark, sf):
    c, v = _corpus(spark, sf), _vectors(spark, sf)
    r = topk.rank_then_filter(c, V.query_vectors(v), _text_pred(), limit=30, vectors=v)
    return r.select(F.col("qid").alias("incident_id"), "id", "rank", F.round("score", 6).alias("score"))


@query("filter_then_topk", O.with_views(
    f"""SELECT s.qid AS incident_id, s.id, row_number() OVER (PARTITION BY s.qid ORDER BY s.score DESC, s.id) AS rank,
       round(s.score, 6) AS score
FROM scores s JOIN corpus c ON c.id = s.id
WHERE {_TEXT_PRED_SQL}
QUALIFY rank <= 20""", corpus=True))
def q_filter_then_topk(spark, sf):
    c, v = _corpus(spark, sf), _vectors(spark, sf)
    r = topk.filter_then_topk(c, V.query_vectors(v), _text_pred(), k=20)
    return r.select(F.col("qid").alias("incident_id"), "id", F.col("rank").cast("long").alias("rank"),
                    F.round("score", 6).alias("score"))


@query("count_text_predicate", O.with_views(
    "SELECT count(*) AS n FROM clean WHERE mfr_name = 'SRC3_MOTOR_CO' AND modeltxt LIKE '%1%' "
    "AND (cdescr ILIKE '%data%' OR compdesc ILIKE '%bags%')", complaints=True, extra=O.clean_ctes()))
def q_count_text_predicate(spark, sf):
    c = clean.clean_complaints(_complaints(spark, sf))
    pred = ((F.col("mfr_name") == "SRC3_MOTOR_CO") & F.col("modeltxt").like("%1%")
            & (F.col("cdescr").ilike("%data%") | F.col("compdesc").ilike("%bags%")))
    return c.where(pred).agg(F.count(F.lit(1)).alias("n"))


@query("topn_by_column", O.with_views(
    "SELECT seq, cmplid, miles FROM clean ORDER BY miles DESC NULLS LAST, seq LIMIT 100",
    complaints=True, extra=O.clean_ctes()))
def q_topn_by_column(spark, sf):
    c = clean.clean_complaints(_complaints(spark, sf))
    return topk.topn_by_column(c.select("seq", "cmplid", "miles"), "miles", 100)


# ---------------------------------------------------------------- report assembly
@query("retrieve_docs", O.with_views(
    """SELECT incident_id, count(*) AS n_docs, string_agg(CAST(id AS VARCHAR), ',' ORDER BY rank) AS doc_ids,
       max(score) AS top_score
FROM retrieved GROUP BY incident_id""", corpus=True))
def q_retrieve_docs(spark, sf):
    r, _ = _retrieved(spark, sf)
    arr = report.docs_array(r)
    return arr.select("incident_id", F.size("retrieved_docs").cast("long").alias("n_docs"),
                      F.array_join(F.transform("retrieved_docs", lambda d: d["id"].cast("string")), ",").alias("doc_ids"),
                      F.round(F.col("retrieved_docs")[0]["score"], 6).alias("top_score"))


_CONTEXT_PIECE_SQL = ("'[' || CAST(id AS VARCHAR) || '] (score=' || " + O.fixed2_sql("score")
                      + " || ', component category: ' || " + O.or_default_sql("compdesc")
                      + " || ') ' || substring(coalesce(cdescr, ''), 1, 500)")


@query("context_pack", O.with_views(
    f"SELECT incident_id, string_agg({_CONTEXT_PIECE_SQL}, chr(10) || '---' || chr(10) ORDER BY rank) AS context "
    "FROM retrieved GROUP BY incident_id", corpus=True))
def q_context_pack(spark, sf):
    r, _ = _retrieved(spark, sf, context=True)
    return report.context_pack(r)


def _template_sql(template: str, values: dict) -> str:
    import re
    parts = re.split(r"\{(\w+)\}", template)
    out = []
    for i, p in enumerate(parts):
        if i % 2 == 0:
            if p:
                out.append(O.q(p).replace("\n", "' || chr(10) || '"))
        else:
            out.append(f"({values[p]})")
    return " || ".join(out)


@query("prompt_rows", O.with_views(
    "SELECT i.incident_id, " + _template_sql(report.ANALYSIS_TEMPLATE, {
        "incident_text": "coalesce(i.incident_text, '')", "context": "coalesce(x.context, '')",
        "revision": "''"}) + " AS prompt FROM incidents i LEFT JOIN ("
    f"SELECT incident_id, string_agg({_CONTEXT_PIECE_SQL}, chr(10) || '---' || chr(10) ORDER BY rank) AS context "
    "FROM retrieved GROUP BY incident_id) x USING (incident_id)", corpus=True))
def q_prompt_rows(spark, sf):
    r, inc = _retrieved(spark, sf, context=True)
    return report.prompt_rows(report.initial_states(inc), report.context_pack(r))


@query("grade_prompts", O.with_views(
    "SELECT incident_id, " + _template_sql(report.GRADE_TEMPLATE, {"draft": "coalesce(draft_report, '')"})
    + " AS grade_prompt FROM drafts", corpus=True, extra=O.REPORT_CTE))
def q_grade_prompts(spark, sf):
    _, d, _ = _drafted(spark, sf)
    return report.grade_prompt_rows(d)


def _drafted(spark, sf):
    r, inc = _retrieved(spark, sf, once=True)  # read by the drafts, and by what checks them
    return r, V.drafts(r), inc


@query("extract_citations", O.with_views(
    "SELECT incident_id, len(citations) AS n_cited, array_to_string(citations, ',') AS cited FROM cites",
    corpus=True, extra=O.REPORT_CTE))
def q_extract_citations(spark, sf):
    _, d, _ = _drafted(spark, sf)
    c = report.extract_citations(d)
    return c.select("incident_id", F.size("citations").cast("long").alias("n_cited"),
                    F.array_join("citations", ",").alias("cited"))


@query("cited_docs", O.with_views(
    "SELECT incident_id, id, rank, score FROM cited_docs", corpus=True, extra=O.REPORT_CTE))
def q_cited_docs(spark, sf):
    r, d, _ = _drafted(spark, sf)
    return report.cited_docs(r, d).select("incident_id", "id", F.col("rank").cast("long").alias("rank"),
                                          F.round("score", 6).alias("score"))


@query("invented_citations", O.with_views(
    "SELECT incident_id, cited_id FROM invented", corpus=True, extra=O.REPORT_CTE))
def q_invented_citations(spark, sf):
    r, d, _ = _drafted(spark, sf)
    return report.invented_citations(r, d).select("incident_id", "cited_id")


_REF_PIECE_SQL = ("'- [' || CAST(id AS VARCHAR) || '] ODI #' || coalesce(odino, 'None') || ' | ' || "
                  "coalesce(mfr_name, 'None') || ' ' || coalesce(modeltxt, 'None') || ' | ' || "
                  + O.or_default_sql("compdesc") + " || ' (score=' || " + O.fixed2_sql("score") + " || ')'")
_REFS_SQL = (f"SELECT d.incident_id, coalesce(x.refs, '') AS references FROM drafts d LEFT JOIN "
             f"(SELECT incident_id, string_agg({_REF_PIECE_SQL}, chr(10) ORDER BY rank) AS refs FROM cited_docs "
             f"GROUP BY incident_id) x USING (incident_id)")


@query("reference_list", O.with_views(_REFS_SQL, corpus=True, extra=O.REPORT_CTE))
def q_reference_list(spark, sf):
    r, d, _ = _drafted(spark, sf)
    return report.reference_list(r, d)


def _defang_once_sql(x: str) -> str:
    return f"(CASE WHEN contains({x}, '[.]') THEN {x} ELSE {O.defang_sql(x)} END)"


def _final_report_sql(revisions: str) -> str:
    return _template_sql(report.REPORT_TEMPLATE, {
        "incident": _defang_once_sql("coalesce(i.incident_text, '')"),
        "analysis": _defang_once_sql("coalesce(d.draft_report, '')"),
        "revisions": f"CAST({revisions} AS VARCHAR)",
        "references": _defang_once_sql("coalesce(f.references, '')")})


@query("final_report", O.with_views(
    "SELECT d.incident_id, " + _final_report_sql("0") + " AS report FROM drafts d JOIN incidents i USING (incident_id) "
    "JOIN (" + _REFS_SQL + ") f USING (incident_id)", corpus=True, extra=O.REPORT_CTE))
def q_final_report(spark, sf):
    r, d, inc = _drafted(spark, sf)
    states = report.initial_states(inc).drop("draft_report").join(d, "incident_id")
    return report.final_report(states, report.reference_list(r, d))


@query("rule_grade", O.with_views(
    """SELECT c.incident_id,
       CASE WHEN len(c.citations) = 0 THEN 'fail' WHEN coalesce(i.n, 0) > 0 THEN 'fail'
            WHEN len(c.citations) > 3 THEN 'fail' ELSE 'pass' END AS status,
       CASE WHEN len(c.citations) = 0 THEN 'no citation'
            WHEN coalesce(i.n, 0) > 0 THEN 'cites a complaint that was not retrieved'
            WHEN len(c.citations) > 3 THEN 'too many causes' ELSE '' END AS critique
FROM cites c LEFT JOIN (SELECT incident_id, count(*) AS n FROM invented GROUP BY incident_id) i USING (incident_id)""",
    corpus=True, extra=O.REPORT_CTE))
def q_rule_grade(spark, sf):
    r, d, _ = _drafted(spark, sf)
    return report.rule_grade(r, d)


@query("cause_grade", O.with_views(
    """SELECT d.incident_id, coalesce(n_causes, 0) AS n_causes, coalesce(n_uncited, 0) AS n_uncited,
       coalesce(n_misapplied, 0) AS n_misapplied,
       CASE WHEN coalesce(n_causes, 0) IN (1, 2, 3) AND n_uncited = 0 AND n_misapplied = 0 THEN 'pass' ELSE 'fail' END AS status,
       CASE WHEN coalesce(n_causes, 0) = 0 THEN 'no cause' WHEN n_uncited > 0 THEN 'a cause has no citation of its own'
            WHEN n_misapplied > 0 THEN 'a citation does not support its cause'
            WHEN n_causes > 3 THEN 'too many causes' ELSE '' END AS critique
FROM cause_drafts d LEFT JOIN (
  SELECT incident_id, count(*) AS n_causes, count(*) FILTER (len(cited) = 0) AS n_uncited,
         count(*) FILTER (len(cited) > 0 AND NOT supported) AS n_misapplied
  FROM (SELECT c.*, EXISTS (SELECT 1 FROM retrieved r WHERE r.incident_id = c.incident_id
                            AND list_contains(c.cited, CAST(r.id AS VARCHAR)) AND r.compdesc <> ''
                            AND contains(upper(c.claim), upper(r.compdesc))) AS supported FROM causes c)
  GROUP BY incident_id) USING (incident_id)""", corpus=True, extra=O.CAUSES_CTE))
def q_cause_grade(spark, sf):
    """Each cause of a draft has its own citation, of a retrieved record whose component the cause names."""
    r, _ = _retrieved(spark, sf, once=True)
    g = report.cause_grade(r, V.cause_drafts(r))
    return g.select("incident_id", *[F.col(c).cast("long").alias(c) for c in ("n_causes", "n_uncited", "n_misapplied")],
                    "status", "critique")


@query("grounding_ratio", O.with_views(
    """SELECT c.incident_id, CAST(len(c.citations) AS BIGINT) AS n_cited, coalesce(g.n, 0) AS n_grounded,
       CASE WHEN len(c.citations) > 0 THEN round(coalesce(g.n, 0) / len(c.citations), 6) END AS grounding_ratio
FROM cites c LEFT JOIN (SELECT incident_id, count(*) AS n FROM cited_docs GROUP BY incident_id) g USING (incident_id)""",
    corpus=True, extra=O.REPORT_CTE))
def q_grounding_ratio(spark, sf):
    r, d, _ = _drafted(spark, sf)
    g = report.grounding_ratio(r, d)
    return g.select("incident_id", F.col("n_cited").cast("long").alias("n_cited"),
                    F.col("n_grounded").cast("long").alias("n_grounded"),
                    F.round("grounding_ratio", 6).alias("grounding_ratio"))


# ---------------------------------------------------------------- evaluation
_HIT_SQL = """hits AS (
  SELECT i.incident_id, i.expected_component,
         coalesce(avg(CASE WHEN contains(upper(r.compdesc), upper(i.expected_component)) THEN 1.0 ELSE 0.0 END)
                  FILTER (WHERE r.id IS NOT NULL), 0.0) AS component_hit_rate
  FROM incidents i LEFT JOIN retrieved r USING (incident_id)
  GROUP BY i.incident_id, i.expected_component)"""


@query("component_hit_rate", O.with_views(
    "SELECT incident_id, expected_component, round(component_hit_rate, 6) AS component_hit_rate FROM hits",
    corpus=True, extra=_HIT_SQL))
def q_component_hit_rate(spark, sf):
    r, inc = _retrieved(spark, sf)
    h = evaluate.component_hit_rate(inc, r)
    return h.withColumn("component_hit_rate", F.round("component_hit_rate", 6))


@query("hit_rate_alarm", O.with_views(
    "SELECT incident_id, expected_component FROM hits WHERE component_hit_rate = 0", corpus=True, extra=_HIT_SQL))
def q_hit_rate_alarm(spark, sf):
    r, inc = _retrieved(spark, sf)
    return evaluate.hit_rate_alarm(evaluate.component_hit_rate(inc, r)).select("incident_id", "expected_component")


_EVAL_CTX_SQL = ("'[doc_id=' || CAST(id AS VARCHAR) || ' mfr=' || coalesce(mfr_name, 'None') || ' model=' || "
                 "coalesce(modeltxt, 'None') || ' component=' || coalesce(compdesc, 'None') || '] ' || coalesce(cdescr, 'None')")


@query("eval_contexts", O.with_views(
    f"SELECT incident_id, rank, {_EVAL_CTX_SQL} AS context FROM retrieved", corpus=True))
def q_eval_contexts(spark, sf):
    r, _ = _retrieved(spark, sf)
    return r.select("incident_id", F.col("rank").cast("long").alias("rank"), evaluate.eval_context().alias("context"))


def _cases(inc: DataFrame) -> DataFrame:
    return inc.withColumns({"case_id": F.concat(F.lit("CASE-"), F.col("incident_id").cast("string")),
                            "category": F.col("expected_component")})


_EVAL_ROWS_SQL = f"""SELECT i.incident_id, 'CASE-' || CAST(i.incident_id AS VARCHAR) AS case_id, i.expected_component AS category,
       i.incident_text AS user_input, coalesce(x.n, 0) AS n_contexts, coalesce(x.ctx, '') AS contexts,
       d.draft_report AS response, round(h.component_hit_rate, 6) AS component_hit_rate
FROM incidents i
LEFT JOIN (SELECT incident_id, count(*) AS n, string_agg({_EVAL_CTX_SQL}, chr(10) ORDER BY rank) AS ctx
           FROM retrieved GROUP BY incident_id) x USING (incident_id)
LEFT JOIN drafts d USING (incident_id)
LEFT JOIN hits h USING (incident_id)"""


def _eval_rows(spark, sf):
    r, d, inc = _drafted(spark, sf)
    rates = evaluate.component_hit_rate(inc, r)
    return evaluate.eval_rows(_cases(inc), r, d, rates), r, d


@query("eval_rows", O.with_views(_EVAL_ROWS_SQL, corpus=True, extra=O.REPORT_CTE + ",\n" + _HIT_SQL))
def q_eval_rows(spark, sf):
    e, _, _ = _eval_rows(spark, sf)
    return e.select("incident_id", "case_id", "category", "user_input",
                    F.size("retrieved_contexts").cast("long").alias("n_contexts"),
                    F.array_join("retrieved_contexts", "\n").alias("contexts"), "response",
                    F.round("component_hit_rate", 6).alias("component_hit_rate"))


@query("metric_spread", """
SELECT event_type, count(m) AS n_runs, round(avg(m), 6) AS mean, round(min(m), 6) AS min, round(max(m), 6) AS max,
       round(stddev_samp(m), 6) AS stddev
FROM (SELECT event_type, user_id, avg(value) AS m FROM events GROUP BY event_type, user_id)
GROUP BY event_type""")
def q_metric_spread(spark, sf):
    ev = V.table(spark, sf, "events")
    runs = ev.groupBy("event_type", "user_id").agg(F.avg("value").alias("m"))
    s = evaluate.metric_spread(runs, "event_type", "m")
    return s.select("event_type", F.col("n_runs").cast("long").alias("n_runs"),
                    *[F.round(c, 6).alias(c) for c in ("mean", "min", "max", "stddev")])


# ---------------------------------------------------------------- grades and routing
_GRADES_SQL = """g AS (
  SELECT event_id AS grade_id, CAST(event_id % 5 AS INTEGER) AS revision_count,
         CASE event_id % 4 WHEN 0 THEN '{"status":"pass","critique":""}'
              WHEN 1 THEN '{"status":"fail","critique":"no citation"}'
              WHEN 2 THEN '{"status":"maybe","critique":""}' ELSE 'not json' END AS grade_json
  FROM events),
pg AS (
  SELECT grade_id, revision_count, s, c,
         CASE WHEN NOT is_obj THEN 'not a JSON object' WHEN len(json_keys(CASE WHEN is_obj THEN grade_json END)) <> 2 THEN 'unexpected keys'
              WHEN s IS NULL OR c IS NULL THEN 'missing field' WHEN s NOT IN ('pass', 'fail') THEN 'status not in enum'
         END AS grade_error
  FROM (SELECT *, coalesce(json_type(CASE WHEN json_valid(grade_json) THEN grade_json END) = 'OBJECT', FALSE) AS is_obj,
               json_extract_string(CASE WHEN json_valid(grade_json) THEN grade_json END, '$.status') AS s,
               json_extract_string(CASE WHEN json_valid(grade_json) THEN grade_json END, '$.critique') AS c FROM g))"""


@query("parse_grades", O.with_views(
    "SELECT grade_id, CASE WHEN grade_error IS NULL THEN s END AS status, CASE WHEN grade_error IS NULL THEN c END AS critique, "
    "grade_error IS NULL AS grade_ok, grade_error FROM pg", extra=_GRADES_SQL))
def q_parse_grades(spark, sf):
    g = report.parse_grades(V.grades(V.table(spark, sf, "events")))
    return g.select("grade_id", "status", "critique", "grade_ok", "grade_error")


@query("route_states", O.with_views(
    "SELECT grade_id, CASE WHEN grade_error IS NULL AND s = 'pass' THEN 'action' WHEN revision_count >= 3 THEN 'action' "
    "ELSE 'analysis' END AS route FROM pg", extra=_GRADES_SQL))
def q_route_states(spark, sf):
    g = report.parse_grades(V.grades(V.table(spark, sf, "events"))).withColumn("max_revision", F.lit(3))
    return g.select("grade_id", report.route().alias("route"))


# ---------------------------------------------------------------- sources, sinks and streams
import uuid  # noqa: E402
import posixpath  # noqa: E402

from ..session import scratch_path, stored  # noqa: E402
from ..sinks import tables as sinks  # noqa: E402
from ..sources import files as src  # noqa: E402
from ..sources import messages as msg  # noqa: E402
from ..streaming import ingest, load  # noqa: E402
from ..operators import typed as typed_ops  # noqa: E402


def _run_dir(spark, name: str) -> str:
    return scratch_path(spark, "runs", f"{name}-{uuid.uuid4().hex[:10]}")


_SANITIZED = "complaints_s AS (SELECT seq, " + ", ".join(
    f"regexp_replace({c}, '[\\t\\r\\n]', ' ', 'g') AS {c}" for c in RAW_COLUMNS) + " FROM complaints)"


@query("scan_raw_tsv", O.with_views(
    "SELECT " + ", ".join(RAW_COLUMNS) + ", FALSE AS ragged FROM complaints_s", complaints=True, extra=_SANITIZED))
def q_scan_raw_tsv(spark, sf):
    d = _run_dir(spark, "raw")
    src.write_raw_tsv(_complaints(spark, sf), d)
    raw = src.scan_raw_tsv(spark, d, encoding="UTF-8")
    return raw.select(*RAW_COLUMNS, F.col("_ragged").alias("ragged"))


def _processed_text_sql(src_cte: str = "clean") -> str:
    from ..schemas import CLEAN_COLUMNS
    txt = []
    for c in CLEAN_COLUMNS:
        if c in DATE_COLUMNS or c.endswith("_raw_invalid"):
            txt.append(f"coalesce({O.date_text_sql(c)}, '') AS {c}")
        elif c in NUMERIC_COLUMNS:
            txt.append(f"coalesce(CAST({c} AS VARCHAR), '') AS {c}")
        else:
            txt.append(f"coalesce({c}, '') AS {c}")
    return f"SELECT {', '.join(txt)} FROM {src_cte}"


@query("scan_clean_csv", O.with_views(_processed_text_sql(), complaints=True, extra=O.clean_ctes()))
def q_scan_clean_csv(spark, sf):
    from ..schemas import CLEAN_COLUMNS
    d = _run_dir(spark, "processed")
    t = typed_ops.processed_text(clean.clean_complaints(_complaints(spark, sf)), keep=())
    src.write_processed_csv(t.toDF(*[c.upper() for c in t.columns]), d)
    return src.scan_clean_csv(spark, d, required=SUMMARY_PIPE_COLUMNS).select(*CLEAN_COLUMNS)


def _ragged_sql() -> str:
    from ..schemas import LOADER_COLUMNS
    inner = _processed_text_sql().replace("SELECT ", "SELECT seq, ", 1)
    cols = [(f"CASE WHEN seq % 7 = 0 THEN '' ELSE {c} END AS {c}" if c in ("cmplid", "odino", "mfr_name") else c)
            for c in LOADER_COLUMNS if c != "embedding"]
    cols = ["CASE WHEN seq % 5 = 0 THEN replace(cdescr, ' ', chr(10)) ELSE cdescr END AS cdescr" if c == "cdescr" else c for c in cols]
    return f"SELECT {', '.join(cols)} FROM ({inner})"


@query("scan_ragged_csv", O.with_views(_ragged_sql(), complaints=True, extra=O.clean_ctes()))
def q_scan_ragged_csv(spark, sf):
    """Header in a different column order, every 7th row missing its last three fields, line breaks in quoted fields."""
    from ..schemas import CLEAN_COLUMNS, LOADER_COLUMNS
    d = _run_dir(spark, "ragged")
    t = typed_ops.processed_text(clean.clean_complaints(_complaints(spark, sf)), keep=("seq",))
    t = t.withColumn("cdescr", F.when(F.col("seq") % 5 == 0, F.replace("cdescr", F.lit(" "), F.lit("\n"))).otherwise(F.col("cdescr")))
    cols = list(reversed(CLEAN_COLUMNS))

    def quoted(c):
        return F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"'))

    full = F.concat_ws(",", *[quoted(c) for c in cols])
    short = F.concat_ws(",", *[quoted(c) for c in cols[:-3]])
    # files of one bucket each: header line first, then the bucket's rows (no single writer task)
    nb = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = t.select("seq", F.when(F.col("seq") % 7 == 0, short).otherwise(full).alias("value"),
                     F.pmod(F.xxhash64("seq"), F.lit(nb)).cast("int").alias("bucket"))
    header = spark.range(nb).select(F.lit(-1).cast("long").alias("seq"), F.lit(",".join(cols)).alias("value"),
                                    F.col("id").cast("int").alias("bucket"))
    (header.unionByName(lines).repartition(nb, "bucket").sortWithinPartitions("bucket", "seq")
     .select("value", "bucket").write.partitionBy("bucket").text(d))
    return src.scan_ragged_csv(spark, d, [c for c in LOADER_COLUMNS if c != "embedding"])


_CASES_SQL = ("SELECT 'CASE-' || CAST(incident_id AS VARCHAR) AS case_id, expected_component AS category, "
              "'component match' AS targets, expected_component, incident_text FROM incidents")


@query("scan_eval_cases", O.with_views(_CASES_SQL, corpus=True))
def q_scan_eval_cases(spark, sf):
    d = _run_dir(spark, "cases")
    inc = V.incidents(_corpus(spark, sf))
    cases = inc.select(F.concat(F.lit("CASE-"), F.col("incident_id").cast("string")).alias("case_id"),
                       F.col("expected_component").alias("category"), F.lit("component match").alias("targets"),
                       "expected_component", "incident_text")
    lines = cases.select(F.to_json(F.struct(*cases.columns)).alias("value"))
    blanks = inc.where(F.col("incident_id") % 10 == 0).select(F.lit("").alias("value"))
    lines.unionAll(blanks).write.text(d)
    return src.scan_eval_cases(spark, d)


_MSG_SQL = """m AS (
  SELECT event_id AS message_id,
         CASE WHEN event_id % 10 = 0 THEN 'not json ' || CAST(event_id AS VARCHAR)
              ELSE '{"jobId":"j' || CAST(user_id AS VARCHAR) || '","bucket":"b","resultKey":"processed/'
                   || CAST(event_id % 50 AS VARCHAR) || '.csv"}' END AS body
  FROM events),
dm AS (
  SELECT message_id, body, coalesce(json_type(CASE WHEN json_valid(body) THEN body END) = 'OBJECT', FALSE) AS is_valid FROM m)"""


@query("decode_job_messages", O.with_views(
    """SELECT message_id, is_valid, CASE WHEN is_valid THEN json_extract_string(body, '$.jobId') END AS job_id,
       CASE WHEN is_valid THEN json_extract_string(body, '$.bucket') END AS bucket,
       CASE WHEN is_valid THEN json_extract_string(body, '$.resultKey') END AS result_key
FROM (SELECT message_id, is_valid, CASE WHEN is_valid THEN body END AS body FROM dm)""", extra=_MSG_SQL))
def q_decode_job_messages(spark, sf):
    m = msg.decode_job_messages(V.messages(V.table(spark, sf, "events")))
    return m.select("message_id", "is_valid", "job_id", "bucket", "result_key")


def _write_processed_files(spark, sf, base: str) -> None:
    """Processed CSV files for keys ``processed/<n>.csv`` (n = seq % 50): one folder per key."""
    t = typed_ops.processed_text(clean.clean_complaints(_complaints(spark, sf)), keep=("seq",))
    t = t.withColumn("_name", F.concat((F.col("seq") % 50).cast("string"), F.lit(".csv")))
    # every task writes its own part file (with header) into each key folder: a hot key
    # is spread over all writers instead of one task
    (t.drop("seq").write.partitionBy("_name").option("header", True).option("escape", '"')
     .csv(posixpath.join(base, "processed")))


def _resolver(base: str):
    return lambda key: posixpath.join(base, posixpath.dirname(key), "_name=" + posixpath.basename(key))


def _read_processed(spark, paths):
    return src.read_by_header(spark, paths, file_col="_file")


@query("load_jobs", O.with_views(_load_jobs_sql(), complaints=True, extra=O.clean_ctes() + ",\n" + _MSG_SQL))
def q_load_jobs(spark, sf):
    base = _run_dir(spark, "bucket")
    _write_processed_files(spark, sf, base)
    dm = msg.decode_job_messages(V.messages(V.table(spark, sf, "events")))
    rows = msg.claim_check_read(spark, dm, _resolver(base), _read_processed)
    t = typed_ops.typed_rows(rows, keep=("result_key", "n_messages", "first_job_id"))
    return _dates_as_text(t)


@query("write_clean_zone", O.with_views(
    "SELECT 'job-1' AS job_id, count(*) AS rows FROM clean", complaints=True, extra=O.clean_ctes()))
def q_write_clean_zone(spark, sf):
    zone = _run_dir(spark, "zone")
    sinks.write_clean_zone(clean.clean_complaints(_complaints(spark, sf)), zone, "job-1")
    z = spark.read.parquet(posixpath.join(zone, "data.parquet"))
    return z.groupBy("job_id").agg(F.count(F.lit(1)).alias("rows"))


@query("job_manifest", O.with_views(
    "SELECT 'job-1' AS job_id, 'b' AS bucket, 'cleaned/job-1/data.parquet' AS cleaned_key, "
    "(SELECT count(*) FROM clean) AS rows, (SELECT count(*) FROM complaints) AS loaded, "
    "(SELECT CAST(count_if(coalesce(trim(summary) = '', TRUE)) AS BIGINT) FROM clean) AS blank_summary",
    complaints=True, extra=O.clean_ctes()))
def q_job_manifest(spark, sf):
    raw = _complaints(spark, sf)
    m = sinks.job_manifest(raw, clean.clean_complaints(raw), "job-1", "b", "cleaned/job-1/data.parquet")
    path = _run_dir(spark, "manifest")
    m.write.mode("append").parquet(path)
    return spark.read.parquet(path)


_LOAD_SQL = """base AS (
  SELECT seq, lpad(CAST(seq AS VARCHAR), 9, '0') AS cmplid, odino, compdesc, 'base ' || compdesc AS summary,
         CAST(seq % 7 AS DOUBLE) + CAST(seq % 11 AS DOUBLE) AS emb_sum
  FROM complaints),
batch AS (
  SELECT seq, CASE WHEN seq % 11 = 0 AND seq > 0 THEN lpad(CAST(seq * 2 - 2 AS VARCHAR), 9, '0')
                   ELSE lpad(CAST(seq * 2 AS VARCHAR), 9, '0') END AS cmplid,
         odino, compdesc, 'batch ' || modeltxt AS summary, CAST(seq % 5 AS DOUBLE) + CAST(seq % 13 AS DOUBLE) AS emb_sum
  FROM complaints),
bc AS (
  SELECT cmplid, arg_min(odino, seq) AS odino, arg_min(compdesc, seq) AS compdesc, min(seq) AS seq,
         arg_max(summary, seq) AS summary, arg_max(emb_sum, seq) AS emb_sum
  FROM batch GROUP BY cmplid),
upserted AS (
  SELECT coalesce(s.cmplid, b.cmplid) AS cmplid,
         CASE WHEN s.cmplid IS NOT NULL THEN s.odino ELSE b.odino END AS odino,
         CASE WHEN s.cmplid IS NOT NULL THEN s.compdesc ELSE b.compdesc END AS compdesc,
         CASE WHEN b.cmplid IS NOT NULL THEN b.summary ELSE s.summary END AS summary,
         CASE WHEN b.cmplid IS NOT NULL THEN b.emb_sum ELSE s.emb_sum END AS emb_sum
  FROM base s FULL OUTER JOIN bc b ON s.cmplid = b.cmplid)"""


def _load_out(df: DataFrame) -> DataFrame:
    return df.select("cmplid", "odino", "compdesc", "summary",
                     F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double")), 6).alias("emb_sum"))


@query("append_with_count_check", O.with_views(
    "SELECT cmplid, odino, compdesc, summary, emb_sum FROM base UNION ALL "
    "SELECT cmplid, odino, compdesc, summary, emb_sum FROM batch", complaints=True, extra=_LOAD_SQL))
def q_append_with_count_check(spark, sf):
    c = _complaints(spark, sf)
    target = _run_dir(spark, "append")
    sinks.append_with_count_check(spark, target, V.load_rows(c, "base"))
    # the batch arrives with its columns in another order: appended by name
    b = V.load_rows(c, "batch")
    out = sinks.append_with_count_check(spark, target, b.select(*reversed(b.columns)))
    return _load_out(out)


@query("upsert_corpus", O.with_views(
    "SELECT cmplid, odino, compdesc, summary, emb_sum FROM upserted", complaints=True, extra=_LOAD_SQL))
def q_upsert_corpus(spark, sf):
    c = _complaints(spark, sf)
    return _load_out(sinks.upsert(V.load_rows(c, "base"), V.load_rows(c, "batch")))


@query("stream_upsert", O.with_views(
    "SELECT cmplid, odino, compdesc, summary, emb_sum FROM upserted", complaints=True, extra=_LOAD_SQL))
def q_stream_upsert(spark, sf):
    c = _complaints(spark, sf)
    run = _run_dir(spark, "stream-upsert")
    table = sinks.KeyedTable(spark, posixpath.join(run, "table"))
    table.init(V.load_rows(c, "base"))
    inbox = posixpath.join(run, "inbox")
    batch = V.load_rows(c, "batch")
    batch.write.parquet(inbox)
    stream = spark.readStream.schema(batch.schema).parquet(inbox)
    load.run_upsert_stream(spark, stream, table, posixpath.join(run, "ckpt"))
    table.apply(spark.read.parquet(inbox))  # delivered again: no change
    return _load_out(table.current())


@query("stream_job_status", O.with_views(
    "SELECT message_id, CASE WHEN is_valid THEN 'ok' ELSE 'failed: malformed message' END AS status FROM dm",
    extra=_MSG_SQL))
def q_stream_job_status(spark, sf):
    run = _run_dir(spark, "status")
    base = posixpath.join(run, "bucket")
    _write_processed_files(spark, sf, base)
    inbox = posixpath.join(run, "inbox")
    m = V.messages(V.table(spark, sf, "events"))
    m.write.parquet(inbox)
    out = posixpath.join(run, "status")
    load.run_status_stream(spark, spark.readStream.schema(m.schema).parquet(inbox), _resolver(base), out,
                           posixpath.join(run, "ckpt"))
    return spark.read.parquet(out).select("message_id", "status")


@query("dead_letter", O.with_views(
    "SELECT message_id, CAST(CASE WHEN NOT is_valid THEN 5 ELSE 1 END AS BIGINT) AS receives, "
    "CAST(CASE WHEN NOT is_valid THEN 5 ELSE 0 END AS BIGINT) AS failures, NOT is_valid AS dead_lettered FROM dm",
    extra=_MSG_SQL))
def q_dead_letter(spark, sf):
    run = _run_dir(spark, "dlq")
    m = V.messages(V.table(spark, sf, "events"))
    # delivery log: a message that fails is redelivered until it reaches the receive limit
    bad = ~F.col("body").startswith("{")
    deliveries = m.withColumn("attempt", F.explode(F.sequence(F.lit(1), F.when(bad, 5).otherwise(1))))
    inbox = posixpath.join(run, "inbox")
    deliveries.write.parquet(inbox)
    out = posixpath.join(run, "out")
    load.run_dead_letter_stream(spark, spark.readStream.schema(deliveries.schema).parquet(inbox), out,
                                posixpath.join(run, "ckpt"), max_receives=5)
    return load.latest_status(spark, out).select("message_id", F.col("receives").cast("long").alias("receives"),
                                                 F.col("failures").cast("long").alias("failures"), "dead_lettered")


@query("stream_clean", O.with_views(
    "SELECT " + ", ".join(
        (f"{O.date_text_sql(c)} AS {c}" if (c in DATE_COLUMNS or c.endswith('_raw_invalid')) else c)
        for c in _CLEAN_OUT if c != "seq") + " FROM clean",
    complaints=True, extra=_SANITIZED + ",\n" + O.clean_ctes("complaints_s")))
def q_stream_clean(spark, sf):
    run = _run_dir(spark, "ingest")
    folder = posixpath.join(run, "incoming")
    # one upload = one folder of part files written in parallel
    src.write_raw_tsv(_complaints(spark, sf), posixpath.join(folder, "upload-1"))
    zone, quarantine = posixpath.join(run, "zone"), posixpath.join(run, "failed")
    ingest.run_clean_stream(spark, posixpath.join(folder, "*"), zone, quarantine, posixpath.join(run, "ckpt"),
                            glob="part-*", encoding="UTF-8", unit="folder")
    z = spark.read.parquet(zone)
    return _dates_as_text(z.select(*[c for c in _CLEAN_OUT if c != "seq"]))


@query("stream_files")
def q_stream_files(spark, sf):
    """New-file events: files written before the stream starts are skipped."""
    import time
    run = _run_dir(spark, "files")
    folder = posixpath.join(run, "incoming")
    c = _complaints(spark, sf)
    src.write_raw_tsv(c.where(F.col("seq") % 2 == 0), posixpath.join(folder, "old"))
    since = int(time.time() * 1000) + 1000
    time.sleep(1.5)
    src.write_raw_tsv(c, posixpath.join(folder, "new"))
    out = posixpath.join(run, "events")
    stream = ingest.file_listing_stream(spark, posixpath.join(folder, "*"), glob="part-*", since_ms=since)
    h = (stream.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", posixpath.join(run, "ckpt")).trigger(availableNow=True).start())
    h.awaitTermination()
    return spark.read.parquet(out)


@query("eval_report", O.with_views(
    """SELECT 'CASE-' || CAST(h.incident_id AS VARCHAR) AS case_id, h.expected_component AS category,
       round(h.component_hit_rate, 6) AS component_hit_rate,
       CASE WHEN len(c.citations) > 0 THEN round(coalesce(g.n, 0) / len(c.citations), 6) END AS grounding_ratio
FROM hits h JOIN cites c USING (incident_id)
LEFT JOIN (SELECT incident_id, count(*) AS n FROM cited_docs GROUP BY incident_id) g USING (incident_id)""",
    corpus=True, extra=O.REPORT_CTE + ",\n" + _HIT_SQL))
def q_eval_report(spark, sf):
    e, r, d = _eval_rows(spark, sf)
    g = report.grounding_ratio(r, d).select("incident_id", "grounding_ratio")
    metrics = e.select("case_id", "incident_id", "component_hit_rate").join(g, "incident_id")
    meta = e.select("case_id", "category")
    out = sinks.write_eval_report(meta, metrics.drop("incident_id"), _run_dir(spark, "eval-report"))
    return out.select("case_id", "category", F.round("component_hit_rate", 6).alias("component_hit_rate"),
                      F.round("grounding_ratio", 6).alias("grounding_ratio"))


# ---------------------------------------------------------------- approximate search, duplicates, embedding, loop
from ..operators import ann, dedupe, embed, loop  # noqa: E402


@query("topk_ann")
def q_topk_ann(spark, sf):
    v = _vectors(spark, sf)
    r = ann.topk_ann(v, V.query_vectors(v), k=20)
    return r.select(F.col("qid").alias("incident_id"), "id", F.col("rank").cast("long").alias("rank"),
                    F.round("score", 6).alias("score"))


@query("recall_at_k")
def q_recall_at_k(spark, sf):
    v = _vectors(spark, sf)
    inc = V.query_vectors(v)
    exact = stored(topk.topk_exact(v, inc, k=20).select("qid", "id"), "exact")  # counted, and matched
    approx = ann.topk_ann(v, inc, k=20)
    rec = ann.recall_at_k(exact, approx, 20)
    return rec.select(F.col("qid").alias("incident_id"), "n_exact", "n_hit", F.round("recall", 6).alias("recall"))


@query("exact_duplicate_groups", """
WITH n AS (SELECT doc_id, regexp_replace(regexp_replace(text, '[\\t\\n\\f\\r ]+', ' ', 'g'), '^ | $', '', 'g') AS t
           FROM documents),
g AS (SELECT t, min(doc_id) AS group_id, count(*) AS group_size FROM n GROUP BY t HAVING count(*) >= 2)
SELECT n.doc_id, g.group_id, g.group_size FROM n JOIN g USING (t)""")
def q_exact_duplicate_groups(spark, sf):
    return dedupe.exact_duplicate_groups(V.table(spark, sf, "documents"))


@query("near_duplicate_pairs")
def q_near_duplicate_pairs(spark, sf):
    """Each near-duplicate document paired with its cluster representative (smallest id)."""
    return dedupe.near_duplicate_clusters(V.table(spark, sf, "documents"))


@query("embed_hashed")
def q_embed_hashed(spark, sf):
    df = _complaints(spark, sf).select("seq", text.task_prefix(text.summary_pipe(SUMMARY_PIPE_COLUMNS)).alias("t"))
    e = df.select("seq", embed.embed_column("t", dim=64).alias("embedding"))
    return e.select("seq", F.size("embedding").alias("dim"), F.round(vectors.norm("embedding"), 6).alias("norm"))


_LOOP_DRAFTS = """drafts AS (
  SELECT incident_id,
         CASE WHEN incident_id % 5 = 0 THEN 'Most likely cause [' || r1 || ']; next step: inspect the component.'
              ELSE 'Cause A [' || r1 || ']. Cause B [' || r3 || '].' END AS draft_report,
         CASE WHEN incident_id % 5 = 0 THEN 2 ELSE 1 END AS revision_count
  FROM (SELECT incident_id, min(CASE WHEN rank = 1 THEN id END) AS r1, min(CASE WHEN rank = 3 THEN id END) AS r3
        FROM retrieved GROUP BY incident_id)),
""" + O.REPORT_CTE[O.REPORT_CTE.index("cites AS ("):]


@query("revise_loop", O.with_views(
    "SELECT d.incident_id, i.incident_text, d.draft_report, '' AS critique, d.revision_count, 3 AS max_revision, "
    "'pass' AS status, " + _final_report_sql("d.revision_count") + " AS report "
    "FROM drafts d JOIN incidents i USING (incident_id) JOIN (" + _REFS_SQL + ") f USING (incident_id)",
    corpus=True, extra=_LOOP_DRAFTS))
def q_revise_loop(spark, sf):
    r, inc = _retrieved(spark, sf, once=True, context=True)
    ids = (r.groupBy("incident_id")
           .agg(F.array_sort(F.collect_list(F.struct("rank", "id"))).alias("_s"))
           .select("incident_id", F.transform("_s", lambda x: x["id"]).alias("retrieved_ids")))
    states = (report.initial_states(inc).join(ids, "incident_id", "left")
              .join(report.context_pack(r), "incident_id", "left"))
    done = loop.revise_loop(states)
    refs = report.reference_list(r, done.select("incident_id", "draft_report"))
    rep = report.final_report(done, refs)
    return done.drop("retrieved_ids", "context", "report").join(rep, "incident_id")


@query("retry_queue", O.with_views("SELECT message_id, body FROM dm WHERE NOT is_valid", extra=_MSG_SQL))
def q_retry_queue(spark, sf):
    """Partial batch failure: after the status stream, only failed messages are queued again."""
    run = _run_dir(spark, "retry")
    m = V.messages(V.table(spark, sf, "events"))
    inbox = posixpath.join(run, "inbox")
    m.write.parquet(inbox)
    out = posixpath.join(run, "status")
    base = posixpath.join(run, "bucket")
    _write_processed_files(spark, sf, base)
    load.run_status_stream(spark, spark.readStream.schema(m.schema).parquet(inbox), _resolver(base), out,
                           posixpath.join(run, "ckpt"))
    return load.retry_queue(spark.read.parquet(inbox), spark.read.parquet(out)).select("message_id", "body")
