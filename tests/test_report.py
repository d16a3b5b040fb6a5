from pyspark.sql import functions as F

from brakelight.operators import audit, evaluate, loop, report


def _retrieved(spark):
    rows = [(1, 12, 1, 0.9, "AIR BAGS"), (1, 3, 2, 0.8, None), (1, 7, 3, 0.7, "air bags: front"),
            (2, 5, 1, 0.5, "BRAKES")]
    return spark.createDataFrame(rows, "incident_id long, id long, rank int, score double, compdesc string") \
        .withColumns({"cmplid": F.lit("c"), "odino": F.lit("o"), "mfr_name": F.lit(None).cast("string"),
                      "modeltxt": F.lit("M"), "cdescr": F.lit("text")})


def test_citations_and_grounding(spark):
    d = spark.createDataFrame([(1, "[12] [12] [x] [ 3 ]"), (2, "no citation"), (3, "[5] [6]")],
                              "incident_id long, draft_report string")
    c = {r["incident_id"]: r["citations"] for r in report.extract_citations(d).collect()}
    assert c[1] == ["12"] and c[2] == []
    r = _retrieved(spark).unionByName(_retrieved(spark).where("incident_id = 2").withColumn("incident_id", F.lit(3).cast("long")))
    g = {x["incident_id"]: x["grounding_ratio"] for x in report.grounding_ratio(r, d).collect()}
    assert g[1] == 1.0 and g[2] is None and g[3] == 0.5
    inv = [(x["incident_id"], x["cited_id"]) for x in report.invented_citations(r, d).collect()]
    assert inv == [(3, "6")]
    refs = {x["incident_id"]: x["references"] for x in report.reference_list(r, d).collect()}
    assert refs[1] == "- [12] ODI #o | None M | AIR BAGS (score=0.90)" and refs[2] == ""


def test_route(spark):
    df = spark.createDataFrame([("pass", 1, 3), ("fail", 3, 3), ("fail", 2, 3)],
                               "status string, revision_count int, max_revision int")
    assert [r[0] for r in df.select(report.route()).collect()] == ["action", "action", "analysis"]


def test_hit_rate(spark):
    cases = spark.createDataFrame([(1, "Air Bags"), (2, "AIR BAGS"), (9, "X")], "incident_id long, expected_component string")
    h = {r["incident_id"]: r["component_hit_rate"] for r in evaluate.component_hit_rate(cases, _retrieved(spark)).collect()}
    assert abs(h[1] - 2 / 3) < 1e-12 and h[2] == 0.0 and h[9] == 0.0


def test_grades(spark):
    df = spark.createDataFrame([('{"status":"pass","critique":""}',), ('{"status":"maybe","critique":""}',),
                                ("not json",), ('{"status":"fail","critique":"x","extra":1}',)], "grade_json string")
    got = [(r["grade_ok"], r["grade_error"]) for r in report.parse_grades(df).collect()]
    assert got == [(True, None), (False, "status not in enum"), (False, "not a JSON object"), (False, "unexpected keys")]


def test_loop_never_passing_grader_stops_at_max(spark):
    states = spark.createDataFrame([(1, "text", [5, 6, 7], "", 0, 3, "pending")],
                                   "incident_id long, incident_text string, retrieved_ids array<long>, critique string, "
                                   "revision_count int, max_revision int, status string")
    states = states.withColumn("draft_report", F.lit(""))
    import pandas as pd

    def never(pdf):
        return pd.DataFrame({"status": ["fail"] * len(pdf), "critique": ["still wrong"] * len(pdf)})

    out = loop.revise_loop(states, grader=never).collect()
    assert len(out) == 1 and out[0]["revision_count"] == 3 and out[0]["status"] == "fail"
    ok = loop.revise_loop(states).collect()
    assert ok[0]["status"] == "pass" and ok[0]["revision_count"] == 1


def test_every_cause_needs_its_own_supporting_citation(spark):
    from brakelight.operators import report
    docs = spark.createDataFrame([(i, d, c) for i in range(9) for d, c in ((1, "AIR BAGS"), (2, "STEERING"), (3, "BRAKES"), (4, ""))],
                                 "incident_id long, id long, compdesc string")
    texts = ["Nothing to say.", "Cause A: air bags [1].", "Cause A: air bags [1]. Cause B: STEERING column [2]. cause 3: brakes [3].",
             "Cause A: air bags [1]. Cause B: steering [2]. Cause C: brakes [3]. Cause D: brakes again [3].",
             "Cause A: air bags [1]. Cause B: steering.", "Cause A: steering [1].", "Cause A: brakes [77].", None, "Cause A: any [4]."]
    drafts = spark.createDataFrame(list(enumerate(texts)), "incident_id long, draft_report string")
    got = {r.incident_id: (r.n_causes, r.n_uncited, r.n_misapplied, r.status, r.critique) for r in report.cause_grade(docs, drafts).collect()}
    other = "a citation does not support its cause"
    assert got == {0: (0, 0, 0, "fail", "no cause"), 1: (1, 0, 0, "pass", ""), 2: (3, 0, 0, "pass", ""),
                   3: (4, 0, 0, "fail", "too many causes"), 4: (2, 1, 0, "fail", "a cause has no citation of its own"),
                   5: (1, 0, 1, "fail", other), 6: (1, 0, 1, "fail", other), 7: (0, 0, 0, "fail", "no cause"), 8: (1, 0, 1, "fail", other)}
    assert report.draft_causes(drafts).where("incident_id = 2").count() == 3


def _searches(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("FlatMapCoGroupsInPandas")


def test_reports_search_once(spark):
    from brakelight.plans import catalog
    # the drafts and what checks them read one stored search: none is left in the plan
    for name in ("rule_grade", "reference_list", "grounding_ratio", "invented_citations", "cited_docs", "cause_grade", "eval_rows"):
        assert _searches(catalog.QUERIES[name](spark, "/root/testdata/sf0.001")) == 0, name


def test_sensitive_values_match_the_patterns_in_linear_time(spark):
    import re
    import time

    edge = ["joe@mail.example.com", "a@b.c", "@x.yz", "x@.yz", "x@y..zz", "5(123) 456-7890", "(123)456-7890", "1123 456-7890", "123-456-78901",
            "123.456.7890\n", "x123 456 7890y", "123)-456-7890", "1HGCM82633A004352", "x1HGCM82633A004352", "é1HGCM82633A004352é",
            "1HGCM82633A0043521", "1HGCM82633A00435I", "", None, " \t\u3000short\u2003 ", "\n" + "t" * 20 + "\x85", "😀" * 19, "t" * 19 + " \n"]
    rows = [(i, t) for i, t in enumerate(edge)]
    got = audit.sensitive_value_flags(spark.createDataFrame(rows, "seq long, cdescr string")).collect()
    for r in got:
        t = edge[r.seq] or ""
        assert r.has_email == bool(re.search(audit.EMAIL_RX, t)), t
        assert r.has_phone == bool(re.search(audit.PHONE_RX, t)), t
        assert r.has_vin == bool(re.search(audit.VIN_RX, t)), t
        assert r.short_context == (len(t.strip()) < audit.SHORT_CONTEXT_CHARS), t
    long = spark.createDataFrame([(0, "a" * 300_000 + "@"), (1, "a " + " " * 300_000 + "b" * 20)], "seq long, cdescr string")
    at = time.time()
    assert audit.sensitive_value_flags(long).where("has_email or short_context").count() == 0
    assert time.time() - at < 20


def test_loop_asks_the_model_once_per_row_and_round(spark, tmp_path):
    import uuid

    states = spark.createDataFrame([(i, "text", [5, 6, 7], "", 0, 3, "pending", "") for i in range(1, 5)],
                                   "incident_id long, incident_text string, retrieved_ids array<long>, critique string, "
                                   "revision_count int, max_revision int, status string, draft_report string")
    folder = str(tmp_path)

    def counted(pdf):
        for i in pdf["incident_id"]:
            open(f"{folder}/{i}-{uuid.uuid4().hex}", "w").close()
        return loop.default_generator(pdf)

    assert loop.revise_loop(states, generator=counted).where("status = 'pass'").count() == 4
    assert len(list(tmp_path.iterdir())) == 4
