"""The registered queries of the pipeline operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import contam, exact, idfiles, langid, mixing, neardup, packing, pii, repair, secrets, tokens, warc, whiten
from .common import scratch_path, table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _sha(text: Column) -> Column:
    return F.sha2(text, 256)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact token counts of every document, and where the token limit cuts it."""
    counts = tokens.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), 4096)
    over = F.when(F.col("over_limit"), F.col("prefix_steps"))
    return counts.select("doc_id", "n_bytes", "n_tokens", "over_limit",
                         F.coalesce(tokens.prefix_within(over, 4096), F.col("n_chars")).alias("chars_within_limit"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources takes from every document."""
    draws = mixing.mix(table(spark, sf_dir, "documents"))
    return mixing.taken_per_document(draws).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op3_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every document, write the id files, and describe every document from the files."""
    docs = table(spark, sf_dir, "documents")
    path = idfiles.new_folder(spark)
    idfiles.write_ids(docs, path, tokenizer_path("byte_bpe_50k.json"))
    return idfiles.read_documents(spark, path, docs.schema["doc_id"].dataType)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: counts and spans."""
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", _sha(secrets.span_text(F.col("base"))).alias("base_sha256"),
                        secrets.span_text(F.col("spans")).alias("spans"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = contam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        _sha(F.array_join("items", ",")).alias("items_sha256"), "contaminated")


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row that stays for every document, equal but for the case of A-Z."""
    return exact.exact_dedup(table(spark, sf_dir, "documents"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and spans."""
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                        _sha(pii.span_text(F.col("base"))).alias("base_sha256"),
                        pii.span_text(F.col("spans")).alias("spans"))


def op10_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page to WARC archives and describe every record from the archives.

    Responses are decoded and checked against their digest; revisits are read by their headers alone.
    """
    path = scratch_path(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    head = ["record_id", "record_type", "refers_to", "payload_digest", "payload_length"]
    full = warc.read_warc(spark, path, [*head, "payload"], verify=True).filter("record_type = 'response'").select(
        "record_id", "record_type", "refers_to", "payload_digest", F.octet_length("payload").cast("long").alias("payload_bytes"))
    light = warc.read_warc(spark, path, head).filter("record_type = 'revisit'").select(
        "record_id", "record_type", "refers_to", "payload_digest", F.col("payload_length").alias("payload_bytes"))
    return full.unionByName(light).select(
        warc.page_of(F.col("record_id")).alias("page_id"), "payload_bytes",
        F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"), "record_type",
        warc.page_of(F.col("refers_to")).alias("refers_to"))


def op11_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after the stated damage."""
    return repair.repair(repair.damage(table(spark, sf_dir, "conversations")))


def op12_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences that hold lexical neighbours."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_whiten_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leading whitened components of every embedding."""
    return whiten.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_mix_sources, op3_token_id_files, op4_secret_scan,
                                   op5_language_id, op6_decontaminate, op7_near_duplicates, op8_exact_dedup,
                                   op9_personal_data, op10_warc_round_trip, op11_repair_conversations, op12_pack_documents, op13_whiten_embeddings)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: crc32 of an ASCII text: bitwise over its bytes, the reflected polynomial 0xEDB88320
_CRC = """xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(split({}, ''), lambda ch: unicode(ch)::BIGINT),
           lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384::BIGINT * (x & 1)))))"""

SQL = {
    "op2_mix_sources": r"""
WITH d AS (
  SELECT doc_id, source, md5('0:' || CAST(doc_id AS VARCHAR)) AS u,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
p AS (
  SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY u, doc_id, size
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (
  SELECT *, 2 * source_size AS bound,
         CASE ((row_number() OVER (ORDER BY source IS NULL, encode(coalesce(source, ''))) - 1) % 3)
              WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w,
         row_number() OVER (ORDER BY source IS NULL, encode(coalesce(source, ''))) AS rk FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () * 1.5e0
             - coalesce(sum(bound) OVER (ORDER BY bound / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY bound / w, rk
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM r),
t AS (
  SELECT source, source_size,
         least(CAST(bound AS DOUBLE), greatest(max(level) OVER (), 0e0) * w) AS target FROM l),
e AS (
  SELECT *, CAST(round(target) AS BIGINT) AS want,
         CASE WHEN source_size > 0 THEN CAST(floor(round(target) / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t)
SELECT p.doc_id, p.size, e.source_size, e.target,
       CAST(CASE WHEN p.size = 0 THEN 0 ELSE e.epochs * p.size
            + greatest(0, least(p.size, e.want - e.epochs * e.source_size - p.before)) END AS BIGINT) AS taken
FROM p JOIN e ON p.source IS NOT DISTINCT FROM e.source""",
    "op6_decontaminate": rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, list_slice(w, i, i + 12) AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(win) AS n FROM bw),
dw AS (
  SELECT rid, i, n, list_slice(w, i, i + n - 1) AS win
  FROM (SELECT rid, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d JOIN sizes ON len(w) >= n)),
h AS (SELECT rid, i, n, item_id FROM dw JOIN bw USING (win)),
hit AS (
  SELECT rid, count(*) AS n_hit
  FROM (SELECT DISTINCT rid, unnest(generate_series(i, i + n - 1)) AS p FROM h) GROUP BY rid),
it AS (
  SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM h WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(hit.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(it.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(it.ids, '')) AS items_sha256,
       coalesce(hit.n_hit, 0) > 0 AND 20 * coalesce(hit.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN it USING (rid)""",
    "op8_exact_dedup": rf"""
WITH n AS (SELECT doc_id, {_LOWER} AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT n.doc_id, g.keep_id, CAST(g.group_size AS BIGINT) AS group_size,
       n.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(n.norm) AS text_sha256
FROM n JOIN g USING (norm)""",
    "op11_repair_conversations": rf"""
WITH RECURSIVE n AS (
  SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_CRC.format("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS code
  FROM conversations),
d AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
         CASE code WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN code = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM n WHERE code <> 0),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
         rtrim(text, E' \t\n\x0b\x0c\r') AS body FROM d),
f AS (
  SELECT conv_id, turn, role, text, i, role[1] AS c,
         CASE WHEN body = '' THEN 1 WHEN seen > 1 THEN 2 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
         lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair
  FROM o),
k AS (SELECT DISTINCT conv_id FROM conversations),
-- cheapest (cost, audit) per state of the repaired roles: e nothing, s system alone, u user last, a assistant last
v AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, {{'c': CAST(0 AS BIGINT), 't': ''}} AS e, {{'c': CAST(1000000000 AS BIGINT), 't': ''}} AS s,
         {{'c': CAST(5 AS BIGINT), 't': 'I'}} AS u, {{'c': CAST(10 AS BIGINT), 't': 'II'}} AS a FROM k
  UNION ALL
  SELECT conv_id, i, e1, s1, u2, least(a1, {{'c': u2.c + 5, 't': u2.t || 'I'}}) FROM (
    SELECT *, least(u1, {{'c': e1.c + 5, 't': e1.t || 'I'}}, {{'c': s1.c + 5, 't': s1.t || 'I'}},
                    {{'c': a1.c + 5, 't': a1.t || 'I'}}) AS u2 FROM (
      SELECT v.conv_id, f.i, {{'c': e.c + 2, 't': e.t || 'D'}} AS e1,
             least({{'c': s.c + 2, 't': s.t || 'D'}}, {{'c': e.c + stay + CASE f.c WHEN 's' THEN 0 ELSE CAST(1000000000 AS BIGINT) END, 't': e.t || 'K'}}) AS s1,
             least({{'c': u.c + 2, 't': u.t || 'D'}}, {{'c': e.c + stay + ku, 't': e.t || 'K'}}, {{'c': s.c + stay + ku, 't': s.t || 'K'}},
                   {{'c': a.c + stay + ku, 't': a.t || 'K'}}, {{'c': e.c + stay + 1, 't': e.t || 'R'}},
                   {{'c': s.c + stay + 1, 't': s.t || 'R'}}, {{'c': a.c + stay + 1, 't': a.t || 'R'}}) AS u1,
             least({{'c': a.c + 2, 't': a.t || 'D'}}, {{'c': u.c + stay + CASE f.c WHEN 'a' THEN 0 ELSE CAST(1000000000 AS BIGINT) END, 't': u.t || 'K'}},
                   {{'c': u.c + stay + 1, 't': u.t || 'R'}}) AS a1
      FROM v JOIN (SELECT *, CASE fault WHEN 0 THEN 0 WHEN 3 THEN 5 ELSE CAST(1000000000 AS BIGINT) END AS stay,
                          CASE c WHEN 'u' THEN 0 ELSE CAST(1000000000 AS BIGINT) END AS ku FROM f) AS f
           ON f.conv_id IS NOT DISTINCT FROM v.conv_id AND f.i = v.i + 1))),
w AS (
  SELECT conv_id, least(e, a) AS b FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS last FROM v)
  WHERE last = 1),
p AS (
  SELECT conv_id, b.c AS cost, b.t AS audit, unnest(split(b.t, '')) AS op, generate_subscripts(split(b.t, ''), 1) AS place FROM w
  WHERE b.t <> ''),
q AS (
  SELECT *, count(*) FILTER (op <> 'I') OVER (PARTITION BY conv_id ORDER BY place) AS i,
         count(*) FILTER (op <> 'D') OVER (PARTITION BY conv_id ORDER BY place) AS pos,
         count(*) FILTER (op <> 'D') OVER (PARTITION BY conv_id) % 2 AS odd FROM p),
r AS (
  SELECT q.conv_id, string_agg(CASE WHEN op = 'K' THEN f.role WHEN pos % 2 = odd THEN 'assistant' ELSE 'user' END
                               || ':' || CASE WHEN op = 'I' THEN '' ELSE f.text END, chr(10) ORDER BY place) AS body
  FROM q LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM q.conv_id AND f.i = q.i AND op <> 'I' WHERE op <> 'D' GROUP BY q.conv_id),
g AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
         count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
SELECT w.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(w.b.c AS BIGINT) AS cost, w.b.t AS audit,
       sha256(coalesce(r.body, '')) AS repaired_sha256
FROM w LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM w.conv_id LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id""",
}
