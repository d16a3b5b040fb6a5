from pyspark.sql import functions as F

from brakelight.operators import clean


def test_merge_by_report(spark):
    df = spark.createDataFrame(
        [(1, "R1", "10", "b", None), (2, "R1", "9", "a", None), (3, "R1", "11", "b", "z"), (4, "R2", "5", None, "q")],
        "seq long, odino string, cmplid string, compdesc string, other string")
    got = {r["odino"]: r for r in clean.merge_by_report(df).collect()}
    assert got["R1"]["compdesc"] == "b | a"
    assert got["R1"]["other"] == "z"
    assert got["R1"]["cmplid"] == "10"  # string minimum
    assert got["R1"]["seq"] == 1
    assert got["R2"]["compdesc"] == ""


def test_length_filter_before_dedup(spark):
    df = spark.createDataFrame([(1, "K", "ABC"), (2, "K", "LONG ENOUGH")], "seq long, cmplid string, compdesc string")
    out = clean.dedup_first(clean.filter_short_text(df)).collect()
    assert [(r["seq"], r["compdesc"]) for r in out] == [(2, "LONG ENOUGH")]


def test_dedup_hot_key_matches_window(spark):
    # a third of the rows share one key
    df = spark.range(3000).select(F.col("id").alias("seq"),
                                  F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string"))
                                  .alias("cmplid"), (F.col("id") * 7 % 11).cast("string").alias("v"))
    got = sorted(tuple(r) for r in clean.dedup_first(df).collect())
    from pyspark.sql import Window
    w = Window.partitionBy("cmplid").orderBy("seq")
    want = sorted(tuple(r) for r in df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn").collect())
    assert got == want


def test_rejected_rows_reasons(spark):
    df = spark.createDataFrame([(1, "A", "ABC"), (2, "B", "LONG ENOUGH"), (3, "B", "LONG AGAIN")],
                               "seq long, cmplid string, compdesc string")
    got = sorted((r["seq"], r["reason"]) for r in clean.rejected_rows(df).collect())
    assert got == [(1, "short_compdesc"), (3, "duplicate_cmplid")]


def test_rejected_rows_null_ids_follow_dedup_first(spark):
    df = spark.createDataFrame([(1, None, "LONG ONE"), (2, None, "LONG TWO"), (3, "C", "LONG"),
                                (4, None, "ABC")], "seq long, cmplid string, compdesc string")
    got = sorted((r["seq"], r["reason"]) for r in clean.rejected_rows(df).collect())
    assert got == [(2, "duplicate_cmplid"), (3, "short_compdesc"), (4, "short_compdesc")]
    kept = {r["seq"] for r in clean.dedup_first(clean.filter_short_text(df), "cmplid", "seq").collect()}
    assert kept == {1}
