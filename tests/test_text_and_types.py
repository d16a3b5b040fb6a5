import datetime as dt

from pyspark.sql import functions as F

from brakelight.functions import coerce, text, vectors


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_defang_cases(spark):
    cases = {
        "see http://a.b/c.d. now": "see hxxp://a[.]b/c[.]d[.] now",
        "[x.y](https://m.n/o.p?q=1) and www.foo.com/bar.": "x.y (hxxps://m[.]n/o[.]p?q=1) and www[.]foo[.]com/bar[.]",
        "HTTP://A.B/C": "HTTP://A[.]B/C",
        "no links here.": "no links here.",
        "": "",
    }
    for src, want in cases.items():
        assert one(spark, text.defang_links(F.col("x")), src) == want
    assert one(spark, text.defang_links(F.col("x")), None) is None


def test_defang_once_guard(spark):
    once = one(spark, text.defang_links(F.col("x")), "HTTP://A.B/C")
    assert one(spark, text.defang_links_once(F.col("x")), once) == once


def test_strip_canonical_summaries(spark):
    assert one(spark, text.strip_quotes(F.col("x")), 'a "b" c') == "a b c"
    assert one(spark, text.canonical_name(F.col("x")), "  general motors llc ") == "GENERAL_MOTORS_LLC"
    df = spark.createDataFrame([("A", "", None, " ", "E")], "a string, b string, c string, d string, e string")
    assert df.select(text.summary_pipe(["a", "b", "c", "d", "e"])).first()[0] == "A | E"
    blank = spark.createDataFrame([("", " ", None)], "a string, b string, c string")
    s = blank.select(text.with_fallback(text.summary_pipe(["a", "b", "c"]))).first()[0]
    assert s == "NO_DESCRIPTION_AVAILABLE"


def test_dates_and_guard(spark):
    rows = [("",), ("20201399",), ("20990101",), ("18850101",), ("20200229",), ("20260908",),
            ("20260909",), ("18860101",)]
    df = spark.createDataFrame(rows, "x string")
    d = coerce.to_date_compact("x")
    kept, moved = coerce.guard_date(d)
    got = [(r[0], r[1]) for r in df.select(kept, moved).collect()]
    D = dt.date
    assert got == [(None, None), (None, None), (None, D(2099, 1, 1)), (None, D(1885, 1, 1)),
                   (D(2020, 2, 29), None), (D(2026, 9, 8), None), (None, D(2026, 9, 9)), (D(1886, 1, 1), None)]


def test_flags_and_numbers(spark):
    df = spark.createDataFrame([("y",), ("N",), ("",), ("U",)], "x string")
    assert [r[0] for r in df.select(coerce.parse_yn("x")).collect()] == [True, False, None, None]
    df = spark.createDataFrame([("",), (" 12 ",), ("N/A",), ("12.0",)], "x string")
    assert [r[0] for r in df.select(coerce.int_or_zero("x")).collect()] == [0, 12, 0, 12]
    assert [r[0] for r in df.select(coerce.int_or_zero("x", strict=True)).collect()] == [0, 12, 0, 0]


def test_date_pair(spark):
    df = spark.createDataFrame([("2020-01-02", "2099-01-01"), ("", ""), ("2020-13-01", ""), ("2020-01-02", "")],
                               "d string, i string")
    d, m = coerce.date_pair("d", "i")
    got = [(r[0], r[1]) for r in df.select(d, m).collect()]
    assert got == [(None, "2099-01-01"), (None, None), (None, "2020-13-01"), (dt.date(2020, 1, 2), None)]


def test_sql_text_rules_equal_column_rules(spark):
    from pyspark.sql import functions as F
    vals = ["y", "N", "", "U", " 12 ", "N/A", "12.0", "\u00a0n\u3000", "2020-01-02", "2020-13-01", None,
            "99999999999999999999", "-3.7"]
    df = spark.createDataFrame([(v, w) for v in vals for w in ("", "2099-01-01", None)], "x string, i string")
    d1, m1 = coerce.date_pair("x", "i")
    d2, m2 = coerce.date_pair_sql("x", "i")
    pairs = [(coerce.parse_yn("x"), F.expr(coerce.parse_yn_sql("x"))),
             (coerce.int_or_zero("x"), F.expr(coerce.int_or_zero_sql("x"))),
             (coerce.int_or_zero("x", strict=True), F.expr(coerce.int_or_zero_sql("x", strict=True))),
             (d1, F.expr(d2)), (m1, F.expr(m2)),
             (text.strip_ws("x"), F.expr(text.strip_ws_sql("x")))]
    for a, b in pairs:
        assert df.where(~a.eqNullSafe(b)).count() == 0
    assert df.select(F.expr(coerce.parse_yn_sql("x"))).where("x = '\u00a0n\u3000'").first()[0] is False


def test_vector_literal(spark):
    df = spark.createDataFrame([("",), ("[1,x]",), ("[1, 2.5]",)], "x string")
    v, ok = vectors.parse_literal("x")
    got = [(r[0], r[1]) for r in df.select(v, ok).collect()]
    assert got == [(None, False), (None, False), ([1.0, 2.5], True)]
    f = spark.createDataFrame([([1.0, 2.5],)], "v array<float>").select(vectors.format_literal("v")).first()[0]
    assert f == "[1.0,2.5]"


def test_cosine_and_normalize(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    r = df.select(vectors.cosine("a", "b"), vectors.l2_normalize("a")).collect()
    assert abs(r[0][0] - 0.96) < 1e-9 and r[1][0] is None
    assert [round(x, 6) for x in r[0][1]] == [0.6, 0.8] and r[1][1] == [0.0, 0.0]


def test_numbers_are_plain_decimal_text(spark):
    from pyspark.sql import functions as F

    from brakelight.functions import coerce
    rows = [("1d",), ("2f",), ("NaN",), ("Infinity",), (" 1.5 ",), ("-3e2",), ("",), (None,), ("7",), (".5",)]
    got = spark.createDataFrame(rows, "x string").select(
        coerce.to_number("x").alias("n"), coerce.int_or_zero("x").alias("i"), F.expr(coerce.int_or_zero_sql("x")).alias("j")).collect()
    assert [r.n for r in got] == [None, None, None, None, 1.5, -300.0, None, None, 7.0, 0.5]
    assert [r.i for r in got] == [r.j for r in got] == [0, 0, 0, 0, 1, -300, 0, 0, 7, 0]
