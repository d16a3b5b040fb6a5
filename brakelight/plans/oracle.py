"""DuckDB SQL for the derived views and each registered query (the oracle side).

Written independently of the Spark code paths: the views follow the same
rules as ``plans/views.py``, stated in SQL.
"""

from __future__ import annotations

from ..schemas import RAW_COLUMNS

_SPECIAL = {
    "cmplid": "CASE WHEN doc_id % 11 = 0 AND doc_id > 0 THEN lpad(CAST(doc_id - 1 AS VARCHAR), 9, '0') "
              "ELSE lpad(CAST(doc_id AS VARCHAR), 9, '0') END",
    "odino": "CASE WHEN doc_id % 101 = 0 THEN '' ELSE lpad(CAST((doc_id - doc_id % 3) // 3 AS VARCHAR), 9, '0') END",
    "mfr_name": "CASE WHEN doc_id % 4 = 0 THEN '  ' || lower(source) || ' motor co ' "
                "ELSE upper(source) || ' MOTOR CO' END",
    "maketxt": "upper(lang)",
    "modeltxt": "'M' || CAST(doc_id % 50 AS VARCHAR)",
    "yeartxt": "CASE WHEN doc_id % 13 = 0 THEN '9999' ELSE CAST(1990 + doc_id % 35 AS VARCHAR) END",
    "crash": "CASE doc_id % 5 WHEN 0 THEN 'Y' WHEN 1 THEN 'n' WHEN 2 THEN '' ELSE 'N' END",
    "faildate": "CASE WHEN doc_id % 17 = 0 THEN '' WHEN doc_id % 19 = 0 THEN '20201399' "
                "WHEN doc_id % 23 = 0 THEN '20990101' WHEN doc_id % 29 = 0 THEN '18500101' "
                "ELSE CAST(2000 + doc_id % 25 AS VARCHAR) || lpad(CAST(1 + doc_id % 12 AS VARCHAR), 2, '0') "
                "|| lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0') END",
    "miles": "CASE doc_id % 7 WHEN 0 THEN 'N/A' WHEN 1 THEN '' "
             "WHEN 2 THEN ' ' || CAST(n_chars AS VARCHAR) || ' ' ELSE CAST(n_chars AS VARCHAR) END",
    "compdesc": "CASE WHEN doc_id % 31 = 0 THEN 'ABC' WHEN doc_id % 2 = 0 THEN 'AIR BAGS:' || upper(lang) "
                "ELSE 'SERVICE BRAKES:\"' || upper(lang) || '\"' END",
    "cdescr": "text",
}


def complaints_cte() -> str:
    cols = ",\n    ".join(f"{_SPECIAL.get(c, chr(39) * 2)} AS {c}" for c in RAW_COLUMNS)
    return f"complaints AS (\n  SELECT doc_id AS seq,\n    {cols}\n  FROM documents)"


CORPUS_CTE = """corpus AS (
  SELECT e.vec_id AS id, lpad(CAST(e.vec_id AS VARCHAR), 9, '0') AS cmplid,
         lpad(CAST(e.vec_id // 3 AS VARCHAR), 9, '0') AS odino,
         CASE WHEN t.source IS NOT NULL THEN upper(t.source) || '_MOTOR_CO' END AS mfr_name,
         'M' || CAST(e.vec_id % 50 AS VARCHAR) AS modeltxt,
         CASE WHEN e.vec_id % 37 <> 0 THEN 'COMPONENT ' || CAST(e.label AS VARCHAR) END AS compdesc,
         t.text AS cdescr, e.embedding AS embedding, e.label AS label,
         sqrt(list_sum(list_transform(e.embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS nrm
  FROM embeddings e LEFT JOIN documents t ON t.doc_id = e.vec_id),
incidents AS (
  SELECT id AS incident_id, embedding AS qv, nrm AS qn,
         'COMPONENT ' || CAST(label AS VARCHAR) AS expected_component,
         coalesce(cdescr, '') AS incident_text
  FROM corpus),
scores AS (
  SELECT q.incident_id AS qid, c.id AS id,
         list_sum(list_transform(range(1, len(c.embedding) + 1),
                  lambda i: CAST(c.embedding[i] AS DOUBLE) * CAST(q.qv[i] AS DOUBLE))) / (c.nrm * q.qn) AS score
  FROM corpus c CROSS JOIN incidents q
  WHERE c.id <> q.incident_id AND c.embedding IS NOT NULL AND c.nrm > 0 AND q.qn > 0),
ranked AS (
  SELECT qid, id, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank
  FROM scores),
retrieved AS (
  SELECT r.qid AS incident_id, r.id, r.rank, round(r.score, 6) AS score, r.score AS raw_score,
         c.cmplid, c.odino, c.mfr_name, c.modeltxt, c.compdesc, c.cdescr
  FROM ranked r JOIN corpus c ON c.id = r.id
  WHERE r.rank <= 20)"""


def with_views(body: str, complaints: bool = False, corpus: bool = False, extra: str = "") -> str:
    ctes = []
    if complaints:
        ctes.append(complaints_cte())
    if corpus:
        ctes.append(CORPUS_CTE)
    if extra:
        ctes.append(extra)
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body

# --- scalar SQL helpers mirroring functions/text.py ---------------------------------
from ..functions.text import BARE_URL_RX, LINK_HINT_RX, MD_LINK_RX, WS_CLASS  # noqa: E402


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip_ws_sql(x: str) -> str:
    return f"regexp_replace({x}, {q('^[' + WS_CLASS + ']+|[' + WS_CLASS + ']+$')}, '', 'g')"


def nonblank_sql(x: str) -> str:
    return f"regexp_matches({x}, {q('[^' + WS_CLASS + ']')})"


def defang_url_sql(u: str) -> str:
    return f"replace(regexp_replace({u}, '^http', 'hxxp'), '.', '[.]')"


def _rewrite_sql(x: str, pattern: str, build, groups: int = 1) -> str:
    p = q(pattern)
    pieces = f"string_split_regex({x}, {p})"
    g1 = f"regexp_extract_all({x}, {p}, 1)"
    g2 = f"regexp_extract_all({x}, {p}, 2)" if groups > 1 else None
    item = build(f"{g1}[i]", f"{g2}[i]" if g2 else None)
    return (f"({pieces}[1] || array_to_string(list_transform(range(1, len({g1}) + 1), "
            f"lambda i: {item} || {pieces}[i + 1]), ''))")


def defang_sql(x: str) -> str:
    md = _rewrite_sql(x, MD_LINK_RX, lambda a, b: f"{a} || ' (' || {defang_url_sql(b)} || ')'", 2)
    both = _rewrite_sql(md, BARE_URL_RX, lambda a, _: defang_url_sql(a))
    return f"(CASE WHEN regexp_matches({x}, {q(LINK_HINT_RX)}) THEN {both} ELSE {x} END)"


def canonical_sql(x: str) -> str:
    return f"replace(upper({strip_ws_sql(x)}), ' ', '_')"


def pipe_summary_sql(cols) -> str:
    parts = ", ".join(f"CASE WHEN {nonblank_sql(c)} THEN {c} END" for c in cols)
    return f"concat_ws(' | ', {parts})"


def sentence_sql() -> str:
    return ("'a ' || maketxt || ' model ' || modeltxt || ' produced in ' || yeartxt || ' was ' "
            "|| compdesc || ' with detail: ' || cdescr")


def date_text_sql(d: str) -> str:
    return f"strftime({d}, '%Y-%m-%d')"


def compact_date_sql(x: str) -> str:
    return f"CAST(try_strptime({x}, '%Y%m%d') AS DATE)"


def guard_sql(d: str, keep: bool) -> str:
    bad = f"({d} > DATE '2026-09-08' OR {d} < DATE '1886-01-01')"
    return f"CASE WHEN {bad} THEN {'NULL' if keep else d} ELSE {d if keep else 'NULL'} END"


def yn_sql(x: str) -> str:
    u = f"upper({strip_ws_sql(x)})"
    return f"CASE WHEN {u} = 'Y' THEN TRUE WHEN {u} = 'N' THEN FALSE END"


def int_or_zero_sql(x: str, strict: bool = False) -> str:
    t = strip_ws_sql(x)
    if strict:
        return (f"coalesce(CASE WHEN regexp_full_match({t}, '[+-]?[0-9]+') "
                f"THEN TRY_CAST({t} AS BIGINT) END, 0)")
    return f"coalesce(TRY_CAST(trunc(TRY_CAST({t} AS DOUBLE)) AS BIGINT), 0)"


def date_pair_sql(dtext: str, itext: str) -> tuple[str, str]:
    d = f"coalesce({strip_ws_sql(dtext)}, '')"
    i = f"coalesce({strip_ws_sql(itext)}, '')"
    parsed = f"CAST(try_strptime({d}, '%Y-%m-%d') AS DATE)"
    date_col = f"CASE WHEN {i} = '' AND {d} <> '' THEN {parsed} END"
    mark = (f"CASE WHEN {i} <> '' THEN {i} WHEN {d} = '' THEN NULL "
            f"WHEN {parsed} IS NULL THEN {d} END")
    return date_col, mark


def clean_ctes(src: str = "complaints") -> str:
    """CTEs ``s1`` ... ``clean`` for the whole cleaning chain over ``src``."""
    from ..schemas import DATE_COLUMNS, LINK_TEXT_COLUMNS, NUMERIC_COLUMNS
    s1 = ", ".join(f"replace({c}, '\"', '') AS {c}" for c in RAW_COLUMNS)

    def typed(c):
        if c in LINK_TEXT_COLUMNS:
            return f"{defang_sql(c)} AS {c}"
        if c in NUMERIC_COLUMNS:
            return f"TRY_CAST(trim({c}) AS DOUBLE) AS {c}"
        if c in DATE_COLUMNS:
            return f"{compact_date_sql(c)} AS {c}"
        return c

    s2 = ", ".join(typed(c) for c in RAW_COLUMNS)
    s3 = ", ".join(
        (f"{guard_sql(c, True)} AS {c}, {guard_sql(c, False)} AS {c}_raw_invalid" if c in DATE_COLUMNS else c)
        for c in RAW_COLUMNS)
    others = [c for c in RAW_COLUMNS if c not in ("odino", "cmplid", "compdesc")] + \
             [d + "_raw_invalid" for d in DATE_COLUMNS]
    mr = ", ".join(f"arg_min({c}, seq) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in others)
    final_cols = ", ".join(
        ["seq", "odino", "cmplid", "coalesce(mj.compdesc, '') AS compdesc"] + others)
    return f"""s1 AS (SELECT seq, {s1} FROM {src}),
s2 AS (SELECT seq, {s2} FROM s1),
s3 AS (SELECT seq, {s3} FROM s2 WHERE length(compdesc) > 5),
s4 AS (SELECT * FROM s3 QUALIFY row_number() OVER (PARTITION BY cmplid ORDER BY seq) = 1),
s5 AS (SELECT * REPLACE ({canonical_sql('mfr_name')} AS mfr_name) FROM s4),
mv AS (SELECT odino, compdesc, min(seq) AS f FROM s5 GROUP BY odino, compdesc),
mj AS (SELECT odino, string_agg(compdesc, ' | ' ORDER BY f) AS compdesc FROM mv
       WHERE compdesc IS NOT NULL GROUP BY odino),
mr AS (SELECT odino, min(seq) AS seq, min(cmplid) AS cmplid, {mr} FROM s5 GROUP BY odino),
clean0 AS (SELECT {final_cols} FROM mr LEFT JOIN mj USING (odino)),
clean AS (SELECT *, {sentence_sql()} AS summary FROM clean0)"""


REPORT_CTE = """drafts AS (
  SELECT incident_id,
         CASE WHEN incident_id % 5 = 0 THEN 'Insufficient data to conclude.'
              WHEN incident_id % 3 = 0 THEN 'Cause A [' || r1 || ']. Cause B [' || r3 || ']. See [999999].'
              ELSE 'Cause A [' || r1 || ']. Cause B [' || r3 || '].' END AS draft_report
  FROM (SELECT incident_id, min(CASE WHEN rank = 1 THEN id END) AS r1,
               min(CASE WHEN rank = 3 THEN id END) AS r3
        FROM retrieved GROUP BY incident_id)),
cites AS (
  SELECT incident_id, list_filter(l, lambda x, i: list_position(l, x) = i) AS citations
  FROM (SELECT incident_id, regexp_extract_all(coalesce(draft_report, ''), '\\[(\\d+)\\]', 1) AS l FROM drafts)),
cited_long AS (
  SELECT incident_id, unnest(citations) AS cited_id FROM cites),
cited_docs AS (
  SELECT r.* FROM retrieved r
  WHERE EXISTS (SELECT 1 FROM cited_long c WHERE c.incident_id = r.incident_id
                AND c.cited_id = CAST(r.id AS VARCHAR))),
invented AS (
  SELECT c.incident_id, c.cited_id FROM cited_long c
  WHERE NOT EXISTS (SELECT 1 FROM retrieved r WHERE r.incident_id = c.incident_id
                    AND CAST(r.id AS VARCHAR) = c.cited_id))"""


def _cause(k: int, claim: str | None = None, cite: bool = True) -> str:
    tail = f"' [' || r{k} || ']. '" if cite else "'. '"
    return f"'Cause {'ABCD'[k - 1]}: ' || {repr(claim) if claim else f'c{k}'} || {tail}"


_RANKED = ", ".join(f"min(CASE WHEN rank = {k} THEN {c} END) AS {n}{k}" for k in range(1, 5) for n, c in (("r", "id"), ("c", "compdesc")))
CAUSES_CTE = f"""cause_drafts AS (
  SELECT incident_id, CASE incident_id % 6 WHEN 0 THEN 'Insufficient data to conclude.' WHEN 1 THEN {_cause(1)}
         WHEN 2 THEN {' || '.join(map(_cause, (1, 2, 3)))} WHEN 3 THEN {' || '.join(map(_cause, (1, 2, 3, 4)))}
         WHEN 4 THEN {_cause(1)} || {_cause(2, cite=False)} ELSE {_cause(1)} || {_cause(2, 'no such part')} END AS draft_report
  FROM (SELECT incident_id, {_RANKED} FROM retrieved GROUP BY incident_id)),
causes AS (
  SELECT incident_id, claim, list_distinct(regexp_extract_all(claim, '\\[(\\d+)\\]', 1)) AS cited
  FROM (SELECT incident_id, unnest(list_slice(l, 2, len(l))) AS claim
        FROM (SELECT incident_id, regexp_split_to_array(coalesce(draft_report, ''), '(?i)\\bcause [a-z0-9]+\\b') AS l FROM cause_drafts)))"""


def fixed2_sql(x: str) -> str:
    r = f"CAST(round(CAST(round({x}, 6) AS DECIMAL(20, 6)), 2) AS DECIMAL(20, 2))"
    return f"(CASE WHEN {x} < 0 AND {r} = 0 THEN '-0.00' ELSE CAST({r} AS VARCHAR) END)"


def or_default_sql(x: str, d: str = "N/A") -> str:
    return f"coalesce(nullif({x}, ''), '{d}')"
