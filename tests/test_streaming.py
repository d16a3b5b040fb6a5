import datetime as dt
import posixpath

from pyspark.sql import functions as F

from brakelight.operators import clean
from brakelight.schemas import RAW_COLUMNS
from brakelight.sources import files
from brakelight.streaming import ingest, load


def _raw_rows(spark, n, offset=0):
    df = spark.range(n).select((F.col("id") + offset).alias("seq"))
    cols = {c: F.lit("") for c in RAW_COLUMNS}
    cols.update({"cmplid": (F.col("seq") % 7).cast("string"), "odino": (F.col("seq") % 3).cast("string"),
                 "compdesc": F.concat(F.lit("COMP-"), (F.col("seq") % 2).cast("string")),
                 "faildate": F.lit("20200101"), "miles": F.col("seq").cast("string"),
                 "cdescr": F.concat(F.lit("see http://x.y/"), F.col("seq").cast("string"))})
    return df.select("seq", *[cols[c].alias(c) for c in RAW_COLUMNS])


def test_stream_equals_per_file_batch(spark, tmp_dir):
    folder = posixpath.join(tmp_dir, "in")
    files.write_raw_tsv(_raw_rows(spark, 40), posixpath.join(folder, "a"), n_files=3)
    files.write_raw_tsv(_raw_rows(spark, 30, 100), posixpath.join(folder, "b"), n_files=2)
    zone, bad = posixpath.join(tmp_dir, "zone"), posixpath.join(tmp_dir, "bad")
    ingest.run_clean_stream(spark, posixpath.join(folder, "*"), zone, bad, posixpath.join(tmp_dir, "ck"),
                            glob="part-*", encoding="UTF-8", unit="folder")
    got = spark.read.parquet(zone).drop("batch")
    raw = files.scan_raw_tsv(spark, posixpath.join(folder, "*"), encoding="UTF-8", glob="part-*")
    good, _ = files.split_ragged(raw)
    good = good.withColumn("_source_file", files.upload_of("_source_file", "folder"))
    want = clean.clean_complaints(good, order="_order", scope=("_source_file",)).drop("_order")
    assert {r[0].rsplit("/", 1)[-1] for r in got.select("_source_file").distinct().collect()} == {"a", "b"}
    cols = sorted(want.columns)
    norm = lambda df: sorted(tuple(str(x) for x in r) for r in df.select(*cols).collect())
    assert norm(got) == norm(want)
    assert got.where(F.col("cdescr").contains("hxxp://x[.]y/")).count() == got.count()


def test_raw_writer_keeps_order_across_part_files(spark, tmp_dir):
    path = posixpath.join(tmp_dir, "raw")
    files.write_raw_tsv(_raw_rows(spark, 200), path, n_files=4)
    raw = files.scan_raw_tsv(spark, path, encoding="UTF-8")
    assert raw.select("_source_file").distinct().count() > 1
    got = [int(r["miles"]) for r in raw.orderBy("_order").select("miles").collect()]
    assert got == list(range(200))


def test_redelivery_dedup_and_dead_letter(spark, tmp_dir):
    t0 = dt.datetime(2026, 1, 1)
    rows = [(1, '{"jobId":"a","bucket":"b","resultKey":"k"}', t0), (1, '{"jobId":"a","bucket":"b","resultKey":"k"}', t0),
            (2, "not json", t0)]
    inbox = posixpath.join(tmp_dir, "inbox")
    spark.createDataFrame(rows, "message_id long, body string, ts timestamp").write.parquet(inbox)
    schema = "message_id long, body string, ts timestamp"
    s = load.drop_redeliveries(spark.readStream.schema(schema).parquet(inbox))
    out = posixpath.join(tmp_dir, "dedup")
    h = (s.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", posixpath.join(tmp_dir, "ck1")).trigger(availableNow=True).start())
    h.awaitTermination()
    assert spark.read.parquet(out).count() == 2
    dl = posixpath.join(tmp_dir, "dl")
    load.run_dead_letter_stream(spark, spark.readStream.schema(schema).parquet(inbox), dl,
                                posixpath.join(tmp_dir, "ck2"), max_receives=1)
    st = {r["message_id"]: r["dead_lettered"] for r in load.latest_status(spark, dl).collect()}
    assert st == {1: False, 2: True}
