import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brakelight.operators import ann, topk


def _corpus(spark, n=300, d=8, seed=3):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, d)).astype(np.float32)
    rows = [(i, [float(x) for x in m[i]], "brake" if i % 4 == 0 else "other") for i in range(n)]
    return spark.createDataFrame(rows, "id long, embedding array<float>, cdescr string")


def _queries(c):
    return c.where(F.col("id") % 10 == 0).select(F.col("id").alias("incident_id"), F.col("embedding").alias("qv"))


def _brute(c, q, k):
    cp, qp = c.toPandas(), q.toPandas()
    C = np.vstack(cp.embedding.to_numpy()).astype(np.float64)
    out = {}
    for qid, qv in zip(qp.incident_id, qp.qv):
        qv = np.asarray(qv, dtype=np.float64)
        s = C @ qv / (np.linalg.norm(C, axis=1) * np.linalg.norm(qv))
        order = sorted((-s[i], cp.id[i]) for i in range(len(cp)) if cp.id[i] != qid)
        out[qid] = [int(i) for _, i in order[:k]]
    return out


@pytest.mark.parametrize("method", ["blocked", "expr"])
def test_topk_methods_match_brute_force(spark, method):
    c = _corpus(spark)
    q = _queries(c)
    r = topk.topk_exact(c, q, 5, method=method, block_rows=64)
    got = {}
    for row in r.orderBy("qid", "rank").collect():
        got.setdefault(row["qid"], []).append(row["id"])
    assert got == _brute(c, q, 5)


def test_ties_nulls_and_small_corpus(spark):
    c = spark.createDataFrame([(5, [1.0, 0.0]), (3, [1.0, 0.0]), (4, None), (9, [0.0, 1.0])],
                              "id long, embedding array<float>")
    q = spark.createDataFrame([(100, [1.0, 0.0])], "incident_id long, qv array<float>")
    r = [(x["id"], x["rank"]) for x in topk.topk_exact(c, q, 10).orderBy("rank").collect()]
    assert r == [(3, 1), (5, 2), (9, 3)]


def test_prefix_property(spark):
    c = _corpus(spark)
    q = _queries(c)
    a = topk.topk_exact(c, q, 10).select("qid", "id", "rank")
    b = topk.topk_exact(c, q, 20).where("rank <= 10").select("qid", "id", "rank")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_rank_then_filter_vs_full_rank(spark):
    c = _corpus(spark)
    q = _queries(c)
    pred = F.col("cdescr") == "brake"
    r = topk.rank_then_filter(c, q, pred, limit=7)
    full = topk.global_rank(topk.scored_pairs(c, q, keep=["cdescr"]), n_parts=5)
    from pyspark.sql import Window
    w = Window.partitionBy("qid").orderBy("rank")
    want = (full.where(pred).withColumn("j", F.row_number().over(w)).where("j <= 7")
            .select("qid", "id", "rank"))
    assert sorted(map(tuple, r.select("qid", "id", "rank").collect())) == sorted(map(tuple, want.collect()))
    # filter before ranking: ranks restart at 1
    f = topk.filter_then_topk(c, q, pred, 7)
    assert f.groupBy("qid").agg(F.min("rank")).distinct().collect()[0][1] == 1


def test_global_rank_matches_window(spark):
    c = _corpus(spark, n=200)
    q = _queries(c)
    p = topk.scored_pairs(c, q)
    got = topk.global_rank(p, n_parts=7).select("qid", "id", "rank")
    from pyspark.sql import Window
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), "id")
    want = p.withColumn("rank", F.row_number().over(w)).select("qid", "id", "rank")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_plan_uses_partial_window_limit(spark):
    c = _corpus(spark)
    r = topk.topk_exact(c, _queries(c), 5)
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_ann_recall_full_probe_is_exact(spark):
    c = _corpus(spark)
    q = _queries(c)
    exact = topk.topk_exact(c, q, 5)
    approx = ann.topk_ann(c, q, 5, n_lists=4, n_probe=4, list_rows=50)
    rec = ann.recall_at_k(exact, approx, 5).collect()
    assert all(r["recall"] == 1.0 for r in rec)
    part = ann.recall_at_k(exact, ann.topk_ann(c, q, 5, n_lists=4, n_probe=1), 5).collect()
    assert all(0.0 <= r["recall"] <= 1.0 for r in part)


def test_ann_scores_exactly_the_probed_lists(spark, tmp_path):
    c = _corpus(spark)
    q = _queries(c)
    lists = ann.store_lists(ann.build_lists(c, 4, 7), str(tmp_path / "lists"))
    assert lists[0].inputFiles() and lists[0].count() == 300
    cents = {r["list_id"]: np.asarray(r["centroid"]) for r in lists[1].collect()}
    member = {r["id"]: r["list_id"] for r in lists[0].collect()}
    vec = {r["id"]: np.asarray(r["embedding"], np.float64) for r in c.collect()}
    cos = lambda a, b: a @ b / (np.linalg.norm(a) * np.linalg.norm(b))
    for list_rows in (7, 50, 1000):
        got = {}
        for r in ann.topk_ann(c, q, 5, n_probe=2, lists=lists, list_rows=list_rows).orderBy("qid", "rank").collect():
            got.setdefault(r["qid"], []).append(r["id"])
        for qid, ids in got.items():
            probed = sorted(cents, key=lambda x: -cos(cents[x], vec[qid]))[:2]
            pool = [i for i in vec if member[i] in probed and i != qid]
            assert ids == sorted(pool, key=lambda i: -cos(vec[i], vec[qid]))[:5]
        assert len(got) == 30


@pytest.mark.parametrize("parts", [1, 7, 60, 400])
def test_repeated_vectors_rank_alike_in_any_blocks(spark, parts):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(25, 48)).astype(np.float32)
    vec = [base[i % 25] * np.float32(1 + i % 3) for i in range(500)]   # repeats and multiples
    rows = [(i, [float(x) for x in vec[i]], "brake" if i % 3 == 0 else "other") for i in range(500)]
    c = spark.createDataFrame(rows, "id long, embedding array<float>, cdescr string").repartition(parts)
    q = c.where("id % 50 = 0").select(F.col("id").alias("incident_id"), F.col("embedding").alias("qv"))

    def score(a, b):   # the defined score: sums in ascending dimension order
        xy = xx = yy = 0.0
        for x, y in zip(a.astype(float), b.astype(float)):
            xy, xx, yy = xy + x * y, xx + x * x, yy + y * y
        return xy / (np.sqrt(xx) * np.sqrt(yy))

    order = {qi: sorted((-score(vec[i], vec[qi]), i) for i in range(500) if i != qi) for qi in range(0, 500, 50)}
    top = {(qi, i, r + 1, -s) for qi, o in order.items() for r, (s, i) in enumerate(o[:30])}
    kept = {(qi, *x) for qi, o in order.items()
            for x in [(i, r + 1, -s) for r, (s, i) in enumerate(o) if i % 3 == 0][:12]}
    sizes = (8192, 130) if parts == 7 else (130,)
    for rows_ in sizes:
        got = topk.topk_exact(c, q, 30, block_rows=rows_).select("qid", "id", "rank", "score").collect()
        assert {tuple(r) for r in got} == top and len(got) == len(top)
        got = topk.rank_then_filter(c, q, F.col("cdescr") == "brake", 12, block_rows=rows_)
        assert {tuple(r) for r in got.select("qid", "id", "rank", "score").collect()} == kept
    got = topk.topk_exact(c, q, 30, method="expr", block_rows=64).select("qid", "id", "rank", "score").collect()
    assert {tuple(r) for r in got} == top


def test_tiles_do_not_change_results(spark, monkeypatch):
    rng = np.random.default_rng(9)
    v = rng.integers(-2, 3, size=(400, 6)).astype(float)
    import pandas as pd
    cdf = pd.DataFrame({"id": range(400), "v": list(v)})
    qdf = pd.DataFrame({"qid": range(0, 400, 7), "qv": list(v[::7])})
    whole = topk._block_topk(15, True)(cdf, qdf).sort_values(["qid", "id"], ignore_index=True)
    for tile in (1, 17, 64, 399):
        monkeypatch.setattr(topk, "TILE", tile)
        got = topk._block_topk(15, True)(cdf, qdf).sort_values(["qid", "id"], ignore_index=True)
        assert got.equals(whole)


def test_rank_then_filter_with_ties_vs_brute_force(spark):
    # 8 distinct directions, each repeated: many corpus rows share a candidate's exact score
    base = [[1.0, 0.0], [0.0, 1.0], [1.0, 1.0], [-1.0, 0.5], [0.3, -1.0], [2.0, 1.0], [-1.0, -1.0], [0.5, 2.0]]
    rows = [(i, base[i % 8], "brake" if i % 3 == 0 else "other") for i in range(120)]
    c = spark.createDataFrame(rows, "id long, embedding array<float>, cdescr string").repartition(4)
    q = c.where(F.col("id") % 17 == 0).select(F.col("id").alias("incident_id"), F.col("embedding").alias("qv"))
    pred = F.col("cdescr") == "brake"
    got = sorted(map(tuple, topk.rank_then_filter(c, q, pred, limit=6)
                     .select("qid", "id", "rank").collect()))
    want = []
    for qi in range(0, 120, 17):
        qv = np.asarray(base[qi % 8], dtype=np.float64)
        sc = []
        for i in range(120):
            if i == qi:
                continue
            v = np.asarray(base[i % 8], dtype=np.float64)
            sc.append((-(v @ qv) / (np.linalg.norm(v) * np.linalg.norm(qv)), i))
        ranked = [(r + 1, i) for r, (_, i) in enumerate(sorted(sc))]
        want += [(qi, i, r) for r, i in ranked if i % 3 == 0][:6]
    assert got == sorted(want)


def test_ann_lists_grow_with_the_corpus(spark):
    c = _corpus(spark, n=300)
    assert ann.list_count(300) == 17 and ann.list_count(30_000) == 173
    assigned, cents = ann.build_lists(c, 4, 7)
    assert assigned.count() == 300
    assert assigned.select("list_id").distinct().count() == cents.count() <= 4
    exact = topk.topk_exact(c, _queries(c), 5)
    approx = ann.topk_ann(c, _queries(c), 5, n_lists=4, n_probe=4, lists=(assigned, cents))
    assert all(r["recall"] == 1.0 for r in ann.recall_at_k(exact, approx, 5).collect())


@pytest.mark.parametrize("n", [200, 1500])
def test_ann_default_reaches_its_recall_at_every_size(spark, n, monkeypatch):
    """Vectors without clusters, every one a query: the default probes find 0.95, one probe fewer does not."""
    c = _corpus(spark, n=n).persist()
    q = c.select(F.col("id").alias("incident_id"), F.col("embedding").alias("qv"))
    lists = ann.build_lists(c, seed=7, max_iter=5)
    lists = lists[0].checkpoint(), lists[1].checkpoint()
    exact = topk.topk_exact(c, q, 20).checkpoint()

    def found(**kw):
        return ann.recall_at_k(exact, ann.topk_ann(c, q, 20, lists=lists, **kw), 20).agg(F.avg("recall")).first()[0]

    assert found() >= 0.95
    p = ann.probes_for_recall(c, q, lists, 20, 0.95)
    assert 1 < p <= lists[1].count() and found(n_probe=p - 1) < 0.95
    monkeypatch.setattr(ann, "MEASURED_QUERIES", n // 4)
    assert found() >= 0.9


def test_scored_pairs_forms_agree(spark):
    c = _corpus(spark, n=120)
    q = _queries(c)
    got = {}
    for method in ("blocked", "expr"):
        p = topk.scored_pairs(c, q, method=method, block_rows=40)
        got[method] = sorted((r["qid"], r["id"], r["score"]) for r in p.collect())
    assert len(got["blocked"]) == 12 * 119  # every query against every other row
    assert got["blocked"] == got["expr"]


def test_equal_vectors_leave_few_candidates_and_the_same_rows():
    import pandas as pd
    rng = np.random.default_rng(4)
    v = rng.normal(size=(600, 16)).astype(np.float32)
    v[100:500] = v[100]                       # one very common vector
    v[590] = 0                                # no direction
    ids = np.arange(600)
    ids[200:260] = 150                        # an id of many rows
    c, every = topk._Side(pd.Series(list(v))), np.arange(600)
    assert len(topk._first_copies(c, ids, every, 5)) <= 199 + 6 * 5
    got = topk._block_topk(5, True)(pd.DataFrame({"id": ids, "v": list(v)}), pd.DataFrame({"qid": ids[::9], "qv": list(v[::9])}))
    q = topk._Side(pd.Series(list(v[::9])))
    want = []
    for j in np.flatnonzero(q.ok):
        r = np.flatnonzero(c.ok & (ids != ids[::9][j]))
        s = topk._pair_scores(c, q, r, np.full(len(r), j))
        want += [(ids[::9][j], ids[r[i]], s[i]) for i in np.lexsort((ids[r], -s))[:5]]
    assert sorted(map(tuple, got.to_numpy().tolist())) == sorted((float(a), float(b), c) for a, b, c in want)


def test_block_sizes_follow_the_vectors(spark):
    """A block of the top-k has a number of vector entries: 40,000 short vectors asked by themselves meet in one corpus block."""
    c = spark.range(40000).select("id", F.array(*[F.col("id").cast("float")] * 4).alias("v"))
    _, cb, qb = topk.block_counts(c, c)
    one = spark.range(1).select(cb.alias("cb"), qb.alias("qb")).first()
    assert one["cb"] == 1 and one["qb"] == spark.sparkContext.defaultParallelism


def test_full_rank_shuffles_vectors_not_pairs(spark, monkeypatch):
    m = np.random.default_rng(11).integers(-1, 2, size=(150, 3)).astype(float)   # many ties, and zero vectors
    rows = [(None if i == 7 else i // 2 if i < 20 else i, m[i].tolist()) for i in range(150)] + [(200, None), (201, [])]
    c = spark.createDataFrame(rows, "id long, embedding array<float>")
    q = c.where("id % 3 = 0 OR id IS NULL").select(F.col("id").alias("incident_id"), F.col("embedding").alias("qv"))
    for exclude in (True, False):
        r = topk.rank_exact(c, q, exclude_self=exclude)
        got = sorted(map(tuple, r.select("qid", "rank", "score", "id").collect()))
        want = topk.global_rank(topk.scored_pairs(c, q, exclude_self=exclude), n_parts=5)
        assert got == sorted(map(tuple, want.select("qid", "rank", "score", "id").collect()))
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "MapInPandas" in plan[:plan.index("Exchange")], plan
    monkeypatch.setattr(topk, "RANKED_VALUES", 100)   # the way of a larger corpus
    r = topk.rank_exact(c, q, exclude_self=False)
    assert sorted(map(tuple, r.select("qid", "rank", "score", "id").collect())) == got


def test_rank_exact_query_keeps_pairs_off_the_disk(spark):
    from brakelight.plans import catalog
    plan = catalog.QUERIES["rank_exact"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and plan.count("Exchange") == 1, plan   # no checkpoint of the pairs


def test_round6_is_round(spark):
    from brakelight.functions.vectors import round6
    rng = np.random.default_rng(2)
    k = rng.integers(-10**6, 10**6, 3000)
    ties = np.r_[(k + 0.5) / 1e6, np.nextafter((k + 0.5) / 1e6, 2), np.nextafter((k + 0.5) / 1e6, -2)]
    x = np.r_[ties, rng.uniform(-1, 1, 3000), k / 1e6, 0.0, -0.0, -1e-9, 1.0, -1.0, 5.1234565, 1e300, np.inf, -np.inf, np.nan]
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double")
    assert df.where(~round6("x").eqNullSafe(F.round("x", 6))).count() == 0


def test_block_pairs_are_dealt_evenly(spark):
    c = _corpus(spark, n=200)
    v, q = topk._corpus_vectors(c, "id", "embedding"), topk._query_vectors(c.select(F.col("id").alias("qid"), "embedding"), "qid", "embedding")
    for side in topk._block_pairs(v, q, 50, q):
        pairs = side.select(F.spark_partition_id().alias("p"), "_cb", "_qb").distinct().groupBy("p").count().collect()
        assert sum(r["count"] for r in pairs) == 16 and max(r["count"] for r in pairs) == 1, pairs


def test_rows_closer_than_single_precision_are_told_apart():
    import pandas as pd
    rng = np.random.default_rng(8)
    v = np.r_[rng.normal(size=(1, 16)) + rng.normal(size=(2600, 16)) * 1e-7, rng.normal(size=(300, 16))][rng.permutation(2900)]
    ids = rng.permutation(2900)
    c, k = topk._Side(pd.Series(list(v))), 6
    got = topk._block_topk(k, True)(pd.DataFrame({"id": ids, "v": list(v)}), pd.DataFrame({"qid": ids[::90], "qv": list(v[::90])}))
    q = topk._Side(pd.Series(list(v[::90])))
    want = []
    for j, own in enumerate(ids[::90]):
        r = np.flatnonzero(ids != own)
        s = topk._pair_scores(c, q, r, np.full(len(r), j))
        want += [(own, ids[r[i]], s[i]) for i in np.lexsort((ids[r], -s))[:k]]
    assert sorted(map(tuple, got.to_numpy().tolist())) == sorted((float(a), float(b), s) for a, b, s in want)
    # gathering stays small: what is close to the best is scored exactly once it is too much to keep
    best = topk._Best(c, ids, q, ids[::90], np.arange(len(ids[::90])), k, True)
    for a in range(0, len(ids), 256):
        best.score(np.arange(a, min(a + 256, len(ids))), np.arange(len(best.cols)))
        best._trim()
        assert len(best.found[0][0]) <= 4 * k * len(best.cols)
    for mask in (rng.random((7, 33)) < 0.05, np.zeros((1, 3), bool), np.ones((2, 9), bool)):
        assert (topk._hits(mask) == np.flatnonzero(mask)).all()


def test_a_large_k_makes_small_blocks_of_queries(spark, monkeypatch):
    """About ``CANDIDATES`` rows leave a block, however many rows each of its queries gets."""
    c = _corpus(spark, n=400).select("id", F.col("embedding").alias("v"))
    q = c.select(F.col("id").alias("qid"), F.col("v").alias("qv"))
    monkeypatch.setattr(topk, "CANDIDATES", 1000)
    for k, fewest in ((100, 40), (5000, 400)):
        _, _, qb = topk.block_counts(c, q, None, k)
        assert spark.range(1).select(qb).first()[0] == fewest
    got = {}
    for r in topk.topk_exact(c, q, 100, vec_col="v", qid_col="qid").orderBy("qid", "rank").collect():
        got.setdefault(r["qid"], []).append(r["id"])
    assert got == _brute(c.withColumnRenamed("v", "embedding"),
                         q.select(F.col("qid").alias("incident_id"), "qv"), 100)


def test_a_shelf_keeps_candidates_of_few_queries_at_a_time(monkeypatch):
    rng, seen, real = np.random.default_rng(5), [], topk._Best
    v = list(rng.normal(size=(500, 6)).astype(np.float32))
    cdf = pd.DataFrame({"id": np.arange(500), "v": v, "list_id": (np.arange(500) % 5).astype(np.int32)})
    qdf = pd.DataFrame({"qid": np.arange(500), "qv": v, "lists": [np.arange(i % 5 + 1, dtype=np.int32) for i in range(500)]})
    whole = ann._shelf_topk(4, True)(cdf, qdf)

    def best(c, cid, q, qid, cols, k, exclude_self):
        seen.append(len(cols))
        return real(c, cid, q, qid, cols, k, exclude_self)

    monkeypatch.setattr(topk, "_Best", best)
    monkeypatch.setattr(ann, "SHELF_QUERIES", 64)
    parts = ann._shelf_topk(4, True)(cdf, qdf)
    assert seen == [64] * 7 + [52]
    key = ["qid", "score", "id"]
    pd.testing.assert_frame_equal(whole.sort_values(key, ignore_index=True), parts.sort_values(key, ignore_index=True))


def test_visits_leave_the_centroids_by_shelf(spark, monkeypatch):
    """A row per query and shelf, not per list; repeated query ids share their probes, lists without rows are passed over."""
    rng = np.random.default_rng(6)
    vec = lambda: [float(x) for x in rng.normal(size=5).astype(np.float32)]
    cents = spark.createDataFrame([(i, vec()) for i in range(40)] + [(40, None), (41, [0.0] * 5)], "list_id int, centroid array<float>")
    shelves = spark.createDataFrame([(i, i // 4, 3 if i % 7 == 0 else 1) for i in range(39)], "list_id int, shelf int, wide int")
    twice = vec()
    q = spark.createDataFrame([(i, vec()) for i in range(30)] + [(3, vec()), (50, twice), (50, twice), (51, [0.0] * 5)],
                              "qid long, qv array<float>")

    def found(n_probe):
        rows = [(r["qid"], r["_shelf"], tuple(sorted(r["lists"]))) for r in ann._visits(cents, shelves, q, n_probe).collect()]
        assert len(rows) == len({x[:2] for x in rows})
        return sorted(rows)

    def plan(n_probe):
        return ann._visits(cents, shelves, q, n_probe)._jdf.queryExecution().toString()

    for n_probe in (7, 41):
        monkeypatch.setattr(topk, "CANDIDATES", 100)
        here = found(n_probe)
        assert "Window" not in plan(n_probe)
        with monkeypatch.context() as m:
            m.setattr(topk, "BLOCK_VALUES", 100)
            assert "Window" in plan(n_probe)
            assert found(n_probe) == here
