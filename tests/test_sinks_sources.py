import os
import posixpath

from pyspark.sql import functions as F

from brakelight.sinks import tables
from brakelight.sources import files


def _batch(spark, rows):
    return spark.createDataFrame(rows, "seq long, cmplid string, odino string, summary string, embedding array<float>")


def test_upsert_repeat_and_replay(spark, tmp_dir):
    base = _batch(spark, [(1, "A", "o1", "s1", [1.0]), (2, "B", "o2", "s2", [2.0])])
    batch = _batch(spark, [(3, "B", "NEW", "b-first", [3.0]), (4, "C", "oc", "c-first", [4.0]),
                           (5, "C", "oc2", "c-last", [5.0])])
    t = tables.KeyedTable(spark, posixpath.join(tmp_dir, "t"), buckets=4)
    t.init(base)
    t.apply(batch)
    got = {r["cmplid"]: r for r in t.current().collect()}
    assert got["B"]["odino"] == "o2" and got["B"]["summary"] == "b-first"
    assert got["C"]["odino"] == "oc" and got["C"]["summary"] == "c-last" and got["C"]["embedding"] == [5.0]
    assert got["A"]["summary"] == "s1"
    t.apply(batch)  # replay: unchanged
    assert sorted(map(tuple, t.current().collect())) == sorted(map(tuple, got.values()))
    # other rows are applied whatever came before; only their buckets are written again
    files_before = set(t.current().inputFiles())
    other = _batch(spark, [(9, "D", "od", "d", [9.0]), (10, None, "on", "null key", [1.0])])
    t.apply(other)
    t.apply(other)
    now = {r["cmplid"]: r["summary"] for r in t.current().collect()}
    assert now == {"A": "s1", "B": "b-first", "C": "c-last", "D": "d", None: "null key"}
    assert t.current().count() == 5
    bucket = lambda f: f.split("_bucket=")[1][0]
    touched = {str(r[0]) for r in t._with_bucket(other).select("_bucket").collect()}
    kept = {f for f in files_before if bucket(f) not in touched}
    assert kept <= set(t.current().inputFiles())


def test_append_by_name(spark, tmp_dir):
    p = posixpath.join(tmp_dir, "append")
    a = _batch(spark, [(1, "A", "o1", "s1", [1.0])])
    tables.append_with_count_check(spark, p, a)
    b = _batch(spark, [(2, "B", "o2", "s2", [2.0])])
    out = tables.append_with_count_check(spark, p, b.select(*reversed(b.columns)))
    assert sorted(r["summary"] for r in out.collect()) == ["s1", "s2"]


def test_raw_tsv_edge_rows(spark, tmp_dir):
    d = posixpath.join(tmp_dir, "raw")
    os.makedirs(d.replace("file:", ""), exist_ok=True)
    good = ["1", "R1", "MAKER", 'He said "hi"', "caf\xe9"] + [""] * 46
    short = ["2", "R2"]
    long_ = [str(i) for i in range(55)]
    with open(os.path.join(d.replace("file:", ""), "in.tsv"), "wb") as fh:
        for r in (good, short, long_):
            fh.write(("\t".join(r) + "\n").encode("latin-1"))
    raw = files.scan_raw_tsv(spark, d)
    ok, bad = files.split_ragged(raw)
    rows = ok.collect()
    assert len(rows) == 1
    r = rows[0]
    assert r["maketxt"] == 'He said "hi"' and r["modeltxt"] == "café" and r["yeartxt"] == ""
    assert bad.count() == 2
    assert sorted(r["_raw_line"][:4] for r in bad.collect()) == ["0\t1\t", "2\tR2"]


def test_clean_csv_missing_column(spark, tmp_dir):
    p = posixpath.join(tmp_dir, "proc")
    spark.createDataFrame([("a", "b")], "X string, Y string").write.option("header", True).csv(p)
    import pytest
    with pytest.raises(ValueError):
        files.scan_clean_csv(spark, p, required=["x", "summary"])
    assert files.scan_clean_csv(spark, p, required=["x"]).columns == ["x", "y"]


def test_zone_write_replaces_its_own_job(spark, tmp_dir):
    from brakelight.sinks import tables as sinks
    df = spark.range(10)
    for job in ("a", "b", "a"):
        assert sinks.write_clean_zone(df, tmp_dir, job) == 10
    back = spark.read.parquet(tmp_dir + "/data.parquet").groupBy("job_id").count().collect()
    assert {r.job_id: r["count"] for r in back} == {"a": 10, "b": 10}


def test_files_with_other_headers_are_read_by_name(spark, tmp_path):
    from brakelight.plans import catalog
    (tmp_path / "a.csv").write_text('CMPLID,odino,mfr_name\n1,o1,"MAKER, ""ONE"""\n2,o2,"two\nlines"\n')
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "b.csv").write_text('mfr_name,extra,cmplid,odino\nMAKER2,x,3,o3\nshort\n')
    (tmp_path / "c.csv").write_text("cmplid\n4\n")
    (tmp_path / "empty.csv").write_text("")
    got = files.scan_ragged_csv(spark, str(tmp_path), ["cmplid", "odino", "mfr_name", "absent"])
    assert sorted(map(tuple, got.collect())) == [
        ("", "", "short", ""), ("1", "o1", 'MAKER, "ONE"', ""), ("2", "o2", "two\nlines", ""),
        ("3", "o3", "MAKER2", ""), ("4", "", "", "")]
    rows = catalog._read_processed(spark, [str(tmp_path / "a.csv"), str(tmp_path / "deep" / "b.csv")])
    assert {(r["cmplid"], r["mfr_name"]) for r in rows.collect()} == {
        ("1", 'MAKER, "ONE"'), ("2", "two\nlines"), ("3", "MAKER2"), (None, "short")}
    import pytest
    with pytest.raises(ValueError, match="odino"):   # a file without a required column
        files.scan_clean_csv(spark, str(tmp_path), required=["odino"])
    assert files.scan_clean_csv(spark, str(tmp_path)).count() == 5
