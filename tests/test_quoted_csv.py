"""Quoted CSV read split by split: the same rows as a reader that sees each file whole."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from brakelight.sources import files


def make(folder, n_files, seed):
    rng, want = random.Random(seed), []
    for f in range(n_files):
        names = rng.sample(["a", "b", "c", "d"], 3)
        with open(folder / f"f{f}.csv", "w", newline="") as out:
            w = csv.writer(out, lineterminator=rng.choice(["\n", "\r\n"]))
            w.writerow(n.upper() for n in names)
            for i in range(rng.choice([0, 1, 60, 200])):
                row = [rng.choice(["x", "", 'say "hi", ok', "two\nlines", "é\n\n" * rng.choice([1, 60]), "q" * 30]) for _ in names]
                row = row[:rng.choice([1, 3, 3, 3])]
                row[0] = row[0] + f"{f}-{i}"
                w.writerow(row)
                got = dict(zip(names, row))
                want.append((f, *[got.get(c, "") for c in "abcd"]))
    (folder / "none.csv").write_text("")
    return want


@pytest.mark.parametrize("size, sent", [("64", 50_000), ("1000", 0), ("128m", 50_000)])
def test_rows_do_not_depend_on_splits(spark, tmp_path, monkeypatch, size, sent):
    monkeypatch.setattr(files, "SENT_SPLITS", sent)
    want = make(tmp_path, 9, 5)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "16")
    try:
        df = files.read_by_header(spark, str(tmp_path), list("abcd"), file_col="_file")
        rows = df.select(F.regexp_extract("_file", r"f([0-9]+)\.csv$", 1).cast("int").alias("f"),
                         *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in "abcd"]).collect()
        assert sorted(map(tuple, rows)) == sorted(want)
        splits = files.csv_splits(files._lines(spark, str(tmp_path)))
        assert size != "64" or splits.filter("inside = 1").count() > 20  # records do cross splits
        assert len(files.headers_of(spark, str(tmp_path))) >= 2
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_broken_end_and_empty_folder(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"open\nto the end\n')
    assert [tuple(r) for r in files.scan_ragged_csv(spark, str(tmp_path), ["x", "y", "z"]).collect()] == [("1", "open\nto the end", "")]
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "e.csv").write_text("")
    assert files.scan_ragged_csv(spark, str(tmp_path / "sub"), ["x"]).collect() == []
