from collections import defaultdict

from pyspark.sql import functions as F

from brakelight.operators import dedupe


def test_exact_groups_brute_force(spark):
    texts = ["a  b", "a b", "c", "a\tb ", "c", "d"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(r) for r in dedupe.exact_duplicate_groups(df).collect())
    import re
    groups = defaultdict(list)
    for i, t in enumerate(texts):
        groups[re.sub(r"[\t\n\f\r ]+", " ", t).strip(" ")].append(i)
    want = sorted((i, min(g), len(g)) for g in groups.values() if len(g) > 1 for i in g)
    assert got == want


def test_near_duplicates_lose_no_pair_that_shares_a_band(spark, monkeypatch):
    import numpy as np
    rng = np.random.default_rng(4)
    rows, words = [], [f"w{i}" for i in range(400)]
    for g in range(12):   # groups that drift: neighbours agree, ends do not
        text = list(rng.choice(words, 60))
        for _ in range(25):
            rows.append((len(rows), " ".join(text)))
            text[int(rng.integers(60))] = str(rng.choice(words))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sig = {r["doc_id"]: np.array(r["sig"]) for r in dedupe.minhash_signatures(df, n_hashes=32).collect()}
    parent = {i: i for i in sig}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sig:
        for b in sig:
            same = sig[a] == sig[b]
            if a < b and same.mean() >= 0.7 and same.reshape(8, 4).all(axis=1).any():
                parent[max(find(a), find(b))] = min(find(a), find(b))
    want = {}
    for i in sig:
        want.setdefault(find(i), set()).add(i)
    want = {frozenset(v) for v in want.values() if len(v) > 1}
    for block in (2000, 3):
        monkeypatch.setattr(dedupe, "BLOCK_ROWS", block)
        got = {}
        for r in dedupe.near_duplicate_clusters(df).collect():
            got.setdefault(r["cluster_id"], set()).add(r["doc_id"])
        assert {frozenset(v) for v in got.values()} == want


def test_near_duplicates_cluster(spark):
    base = " ".join(f"word{i}" for i in range(60))
    near = base.replace("word30", "changed")
    other = " ".join(f"other{i}" for i in range(60))
    df = spark.createDataFrame([(1, base), (2, near), (3, other), (4, base)], "doc_id long, text string")
    cl = {r["doc_id"]: r["cluster_id"] for r in dedupe.near_duplicate_clusters(df, threshold=0.6).collect()}
    assert cl.get(1) == cl.get(2) == cl.get(4) == 1 and 3 not in cl


def test_entry_and_registry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 70


def test_minhash_kernel_vs_python(spark):
    import numpy as np
    texts = ["one", "Two words", "a b c d e f g a b c", "Ünïcode straße, café! x9 y", "   ", None,
             " ".join(f"w{i % 7}" for i in range(40))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")  # rows split over batches
    try:
        got = {r["doc_id"]: list(r["sig"]) for r in dedupe.minhash_signatures(df, n_hashes=8, seed=5).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    words = F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    hashes = {r["doc_id"]: [h % (1 << 64) for h in r["wh"]]
              for r in df.select("doc_id", F.transform(words, lambda w: F.xxhash64(w)).alias("wh")).collect()}
    rng = np.random.default_rng(5)
    p = dedupe.MINHASH_PRIME
    a = [int(x) for x in rng.integers(1, p, size=8, dtype=np.uint64)]
    b = [int(x) for x in rng.integers(0, p, size=8, dtype=np.uint64)]
    mult = [int(x) * 2 + 1 for x in rng.integers(1, 1 << 62, size=3, dtype=np.uint64)]
    want = {}
    for d, wh in hashes.items():
        if not wh:
            continue
        n = max(1, len(wh) - 2)
        sh = set()
        for i in range(n):
            part = wh[i:i + 3]
            sh.add(sum(x * m for x, m in zip(part, mult)) % (1 << 64) % p)
        want[d] = [min((a[j] * x + b[j]) % p for x in sh) for j in range(8)]
    assert got == want
    assert set(got) == {0, 1, 2, 3, 6}


def test_components_long_chain_and_hot_star(spark, monkeypatch):
    # a chain of 200 nodes (3 plain rounds, then ~log2(200) with pointer jumping) plus a star of 300 leaves
    chain = [(i, i + 1) for i in range(1000, 1199)]
    star = [(5000 + i, 4999) for i in range(300)]
    edges = spark.createDataFrame(chain + star + [(7, 8)], "src long, dst long")
    from types import SimpleNamespace
    monkeypatch.setattr(dedupe, "itertools", SimpleNamespace(count=lambda: range(15)))   # 15 rounds must do
    got = {r["doc_id"]: r["cluster_id"] for r in dedupe._components(edges).collect()}
    assert {got[i] for i in range(1000, 1200)} == {1000}
    assert {got[i] for i in range(5000, 5300)} | {got[4999]} == {4999}
    assert got[7] == got[8] == 7 and len(got) == 200 + 301 + 2


def test_package_zip_for_workers(spark):
    import glob
    import os
    import zipfile
    from brakelight.session import ensure_checkpoint_dir, ship_package
    ship_package(spark)  # idempotent per SparkContext
    zips = glob.glob(os.path.join(ensure_checkpoint_dir(spark).replace("file:", ""), "pyfiles", "*.zip"))
    assert zips
    names = set(zipfile.ZipFile(sorted(zips)[-1]).namelist())
    assert {"brakelight/__init__.py", "brakelight/operators/topk.py", "brakelight/streaming/load.py"} <= names


def test_exact_groups_decide_on_texts(spark):
    """With a fingerprint as weak as the length, the groups are the same."""
    rows = [(1, "a b"), (2, "a  b"), (3, "c d"), (4, "c d"), (5, "e f"), (6, None), (7, None), (8, ""), (9, "longer text")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = [(1, 1, 2), (2, 1, 2), (3, 3, 2), (4, 3, 2)]   # null texts are in no group
    for marks in (lambda n: [F.length(n).alias("_len")], dedupe.fingerprint):
        assert sorted(map(tuple, dedupe.exact_duplicate_groups(df, marks=marks).collect())) == want
