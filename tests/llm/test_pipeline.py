"""The pipeline on the smallest fixture: each stage judged on its own input."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from brakelight.llm import contam, langid, neardup
from brakelight.llm.common import scratch_path, table

DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DIR), reason="needs the driver's tables")
def test_stages(spark):
    docs, seen = table(spark, DIR, "documents"), {}
    for name, stage in C.STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, DIR).write.parquet(path)
        seen[name] = (docs, spark.read.parquet(path))
        docs = seen[name][1]
        assert name == "token_ids" or docs.columns == C.COLUMNS
    before, after = seen["language"]
    pred = {r.doc_id: r for r in langid.identify(before, langid.train(before)).collect()}
    assert {r.doc_id for r in after.collect()} == {i for i, r in pred.items() if r.lang_pred != "und" and r.fit >= 0.5}
    before, after = seen["near_duplicates"]
    classes = {r.doc_id: r.class_id for r in neardup.near_duplicates(before).collect()}
    assert sorted(r.doc_id for r in after.collect()) == sorted(set(classes.values()))
    before, after = seen["decontamination"]
    bad = {r.doc_id for r in contam.decontaminate(before, table(spark, DIR, "benchmark")).filter("contaminated").collect()}
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()} - bad
    before, after = seen["mixture"]
    times = {r.doc_id: r["count"] for r in after.groupBy("doc_id").count().collect()}
    assert max(times.values()) <= 2 and set(times) <= {r.doc_id for r in before.collect()}
    before, after = seen["token_ids"]
    got = after.orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted(r.doc_id for r in before.collect())
    assert got[0].start == 0 and all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))


def test_clashing_row_names(spark, tmp_path):
    df = spark.createDataFrame([(1, "the words", "en", "a", 9, 5)], "doc_id long, text string, lang string, source string, n_chars long, _row int")
    keyed, name = C._keyed(df)
    assert name == "_row_" and keyed.agg(F.count(name)).first()[0] == 1


def test_keys_do_not_depend_on_splits(spark, tmp_path):
    spark.range(5000).selectExpr("id as doc_id", "repeat(cast(id as string), 50) as text").repartition(3).write.parquet(str(tmp_path / "t"))
    docs, seen, old = spark.read.parquet(str(tmp_path / "t")), [], spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("128m", "2k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        keyed, name = C._keyed(docs)
        seen.append({r.doc_id: r[name] for r in keyed.select("doc_id", name).collect()})
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert seen[0] == seen[1] and len(set(seen[0].values())) == 5000


EDGE = [(1, "the cat and the dog went with them to that house and the garden of the king", "en", "a", 1),
        (2, "der hund und die katze gehen nicht durch das haus in den garten von dem könig", "de", "a", 1),
        (3, None, None, None, None), (4, "", "en", None, 0), (5, "12 34 !!", "en", "b", 1),
        (1, "the cat and the dog went with them to that house and the garden of the king", "en", "a", 1),
        (1, "another text that shares the number of the first and the words of no one else here", "en", "a", 1),
        (None, "a document without a number that has the words of the language in it for all", "en", None, 1),
        (None, "und ein dokument ohne nummer das die wörter der sprache in sich hat für alle", "de", None, 1)]


def test_stages_on_edge_rows(spark, tmp_path):
    """Null and empty texts, repeated and missing ids, empty tables: every stage keeps what its docstring says."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(EDGE, schema).coalesce(1).write.parquet(str(tmp_path / "docs"))
    spark.createDataFrame([(1, "never seen words of a benchmark")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, sf = spark.read.parquet(str(tmp_path / "docs")), str(tmp_path)
    texts = lambda df: sorted(r.text or "" for r in df.collect())
    prose = [t for _, t, *_ in EDGE if t and t[0].isalpha()]
    assert texts(C.language(spark, docs, sf)) == sorted(prose)
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert C.language(spark, unlabelled, sf).count() == len(EDGE)
    kept = C.near_duplicates(spark, docs, sf)
    # the repeated row goes; rows that share its id, or have none, are classes of their own
    assert texts(kept) == sorted([t or "" for _, t, *_ in EDGE[:5]] + [t for _, t, *_ in EDGE[6:]])
    assert C.decontamination(spark, docs, sf).count() == len(EDGE)
    assert set(texts(C.mixture(spark, docs, sf))) <= {t for _, t, *_ in EDGE if t}
    assert C.token_ids(spark, docs, sf).count() == len(EDGE)
    none = spark.read.schema(schema).parquet(str(tmp_path / "docs")).filter("doc_id > 99")
    none.write.parquet(str(tmp_path / "none"))
    none = spark.read.parquet(str(tmp_path / "none"))
    assert [stage(spark, none, sf).count() for _, stage in C.STAGES] == [0] * 5
