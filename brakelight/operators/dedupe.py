"""Exact and near-duplicate groups of texts, without emitting pairs inside a group.

Exact: a fingerprint (two hashes and the length) of the whitespace-normalised
text names the candidates, their texts are compared, and every member is joined to its group's
smallest id. Near: MinHash signatures (words hashed in Spark SQL, shingle
and MinHash arithmetic vectorised over Arrow batches) cut into bands; inside each
band bucket every member links to the bucket's smallest id (a star, never
all pairs), links are kept when the signatures agree enough, and connected
components are found by iterative min-label propagation, checkpointed each
round. Buckets that still span several components are then searched in
blocks; only links between components leave a task.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_parallelism

# Whitespace collapsed before fingerprinting.
WS_RUN = r"[\t\n\f\r ]+"


def normalized(c) -> "F.Column":
    return F.regexp_replace(F.regexp_replace(F.col(c), WS_RUN, " "), r"^ | $", "")


def fingerprint(norm) -> "list[F.Column]":
    """Two hashes and the length of a text: equal texts have equal fingerprints, the reverse is checked on the texts."""
    return [F.xxhash64(norm).alias("_h1"), F.hash(norm).alias("_h2"), F.length(norm).alias("_len")]


def exact_duplicate_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", marks=fingerprint) -> DataFrame:
    """``(doc_id, group_id, group_size)`` for every text that occurs at least twice.

    Only rows whose fingerprint occurs again send their normalised text, and copies are combined before the shuffle. A
    fingerprint of one text needs no more than its number; rows of a fingerprint that several texts share are matched
    on the text itself. Null texts are in no group.
    """
    n = normalized(text_col)
    rows = ensure_parallelism(df.select(F.col(id_col).alias("doc_id"), F.col(text_col)))
    # the narrow (id, fingerprint) table is used twice (group sizes, join back): written once to the
    # shared checkpoint folder
    keyed = rows.select("doc_id", *marks(n)).checkpoint()
    keys = keyed.columns[1:]
    again = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n >= 2").drop("n")
    texts = rows.select("doc_id", n.alias("_norm"), *marks(n)).join(again, keys, "left_semi")
    classes = (texts.groupBy(*keys, "_norm").agg(F.min("doc_id").alias("group_id"), F.count(F.lit(1)).alias("group_size"))
               .checkpoint())
    per = classes.groupBy(*keys).agg(F.count(F.lit(1)).alias("_texts"), F.min("group_id").alias("group_id"),
                                     F.sum("group_size").alias("group_size"))
    out = ["doc_id", "group_id", "group_size"]
    plain = keyed.join(per.where("_texts = 1"), keys).select(*out)
    shared = texts.join(per.where("_texts > 1").select(*keys), keys, "left_semi").alias("t").join(
        classes.where("group_size >= 2").alias("c"),
        (F.col("t._norm").eqNullSafe(F.col("c._norm"))) & (F.col(f"t.{keys[0]}") == F.col(f"c.{keys[0]}")))
    return plain.unionByName(shared.select(*out))


# Mersenne prime 2^31 - 1: the universal hash family ((a * x + b) mod P) of the signatures.
MINHASH_PRIME = (1 << 31) - 1


def _minhash_kernel(n_hashes: int, shingle: int, seed: int):
    """``mapInArrow`` function: word-hash lists -> ``n_hashes`` MinHash values per document.

    Vectorised per Arrow batch (no per-row Python): shingle hashes are built
    from ``shingle`` consecutive word hashes of the flattened batch (a text
    shorter than one shingle is one shingle of all its words), and each hash
    function's minimum per document is one ``np.minimum.reduceat``. The minimum
    over a multiset equals the minimum over its set, so repeats need no dedup.
    """
    rng = np.random.default_rng(seed)
    a = rng.integers(1, MINHASH_PRIME, size=n_hashes, dtype=np.uint64)
    b = rng.integers(0, MINHASH_PRIME, size=n_hashes, dtype=np.uint64)
    mult = rng.integers(1, 1 << 62, size=shingle, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    prime = np.uint64(MINHASH_PRIME)

    def run(batches):
        for rb in batches:
            words = rb.column("wh")
            lens = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = pc.list_flatten(words).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            n = len(lens)
            if n == 0:
                continue
            starts = np.cumsum(lens) - lens
            ends = starts + lens
            m = np.maximum(1, lens - shingle + 1)              # shingles per document
            row = np.repeat(np.arange(n), m)
            first = np.cumsum(m) - m
            pos = np.arange(int(m.sum())) - first[row] + starts[row]
            sh = np.zeros(len(pos), dtype=np.uint64)
            for i in range(shingle):                            # uint64 arithmetic wraps
                idx = pos + i
                ok = idx < ends[row]
                sh += np.where(ok, flat[np.minimum(idx, len(flat) - 1)], np.uint64(0)) * mult[i]
            sh %= prime
            sig = np.empty((n, n_hashes), dtype=np.int64)
            for j in range(n_hashes):
                sig[:, j] = np.minimum.reduceat((sh * a[j] + b[j]) % prime, first).astype(np.int64)
            offsets = pa.array(np.arange(0, (n + 1) * n_hashes, n_hashes, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [rb.column("doc_id"), pa.ListArray.from_arrays(offsets, pa.array(sig.reshape(-1)))],
                names=["doc_id", "sig"])

    return run


def minhash_signatures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                       n_hashes: int = 32, seed: int = 11) -> DataFrame:
    """``(doc_id, sig array<bigint>)`` over word ``shingle``-grams; texts without words get no signature.

    Lower-casing, splitting into words and hashing every word (``xxhash64``)
    are Spark SQL expressions; the shingle and MinHash arithmetic runs
    vectorised over Arrow batches (``_minhash_kernel``).
    """
    # rows are spread first, so splitting and hashing run in every task (not in a lone scan task)
    base = ensure_parallelism(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_t")))
    words = F.filter(F.split(F.lower(F.coalesce(F.col("_t"), F.lit(""))), r"[^\p{L}\p{N}]+"),
                     lambda w: w != "")
    hashed = (base.select("doc_id", words.alias("_w")).where(F.size("_w") > 0)
              .select("doc_id", F.transform("_w", lambda w: F.xxhash64(w)).alias("wh")))
    return hashed.mapInArrow(_minhash_kernel(n_hashes, shingle, seed), "doc_id long, sig array<bigint>")


def _components(edges: DataFrame, jump_after: int = 3) -> DataFrame:
    """Connected components of an undirected edge list ``(src, dst)``: ``(doc_id, cluster_id)``.

    Each round takes the smallest label among a node's neighbours. Shallow
    graphs (the usual case for near-duplicates) converge in a few such rounds;
    from round ``jump_after`` on, every round also jumps once along the label
    pointers (a node adopts its label's label), which halves chains, so a long
    path needs about log2(n) more rounds instead of n. Labels only decrease and
    stay inside the component; every round is checkpointed to the shared folder.
    """
    both = edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    both = both.checkpoint()
    labels = both.select(F.col("src").alias("doc_id")).distinct().withColumn("label", F.col("doc_id"))
    labels = labels.checkpoint()
    for rnd in itertools.count():   # labels only decrease, so this ends
        prop = (both.join(labels.withColumnRenamed("doc_id", "src"), "src")
                .groupBy(F.col("dst").alias("doc_id")).agg(F.min("label").alias("nl")))
        step = labels.join(prop, "doc_id", "left").select(
            "doc_id", F.least("label", F.coalesce("nl", F.col("label"))).alias("label"),
            F.col("label").alias("_old"))
        if rnd >= jump_after:
            ptr = step.select(F.col("doc_id").alias("label"), F.col("label").alias("_ll"))
            step = (step.join(ptr, "label", "left")
                    .select("doc_id", F.least("label", F.coalesce("_ll", F.col("label"))).alias("label"), "_old"))
        new = step.withColumn("_chg", F.col("label") < F.col("_old")).drop("_old")
        new = new.checkpoint()
        changed = new.where("_chg").limit(1).count()
        labels = new.drop("_chg")
        if changed == 0:
            return labels.withColumnRenamed("label", "cluster_id")


#: distinct signatures of a bucket in one block
BLOCK_ROWS = 2000


def _cross_links(min_agree: int):
    """Pandas function: signatures of a block pair -> links that join different components, one per merge."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sig = np.vstack(pdf["sig"].to_numpy())
        label, doc = pdf["label"].to_numpy(), pdf["doc_id"].to_numpy()
        left, right = np.flatnonzero(pdf["_side"] <= 0), np.flatnonzero(pdf["_side"] >= 0)
        root: dict = {}

        def find(x):
            while root.get(x, x) != x:
                x = root[x]
            return x

        out = []
        for at in range(0, len(left), 256):
            some = left[at:at + 256]
            agree = np.zeros((len(some), len(right)), np.int16)
            for j in range(sig.shape[1]):
                agree += sig[some, j][:, None] == sig[right, j][None, :]
            a, b = np.nonzero((agree >= min_agree) & (label[some][:, None] != label[right][None, :]))
            for x, y in zip(some[a], right[b]):
                fx, fy = find(label[x]), find(label[y])
                if fx != fy:
                    root[fx] = fy
                    out.append((doc[x], doc[y]))
        return pd.DataFrame(out, columns=["src", "dst"])

    return run


def _links_between_components(banded: DataFrame, sig: DataFrame, labels: DataFrame, min_agree: int) -> DataFrame:
    """Links ``(src, dst)`` that buckets hold between different components.

    Equal signatures of a component count once, so large groups of copies shrink to one row per bucket; the
    others of a bucket are cut into blocks that meet pair by pair.
    """
    known = banded.join(labels, "doc_id", "left").withColumn("label", F.coalesce("cluster_id", "doc_id"))
    spanning = (known.groupBy("band", "bkey").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi"))
                .where("_lo < _hi").select("band", "bkey"))
    rows = (known.select("band", "bkey", "label", "doc_id").join(spanning, ["band", "bkey"]).join(sig, "doc_id")
            .groupBy("band", "bkey", "label", "sig").agg(F.min("doc_id").alias("doc_id"))).checkpoint()
    sizes = rows.groupBy("band", "bkey").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_ROWS)).cast("int").alias("_nb"))
    other = (rows.join(sizes, ["band", "bkey"]).withColumn("_b", F.pmod(F.xxhash64("doc_id"), "_nb").cast("int"))
             .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)))
             .select("band", "bkey", "label", "doc_id", "sig", F.least("_b", "_o").alias("_i"),
                     F.greatest("_b", "_o").alias("_j"), F.signum(F.col("_b") - F.col("_o")).cast("int").alias("_side")))
    kind = dict(sig.dtypes)["doc_id"]
    return (other.groupBy("band", "bkey", "_i", "_j")
            .applyInPandas(_cross_links(min_agree), f"src {kind}, dst {kind}").distinct())


def near_duplicate_clusters(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: int = 8,
                            rows_per_band: int = 4, threshold: float = 0.7, seed: int = 11) -> DataFrame:
    """``(doc_id, cluster_id)`` for documents whose MinHash signatures agree on at least
    ``threshold`` of positions with another member of their cluster; every such pair that
    shares a band is in one cluster."""
    n = bands * rows_per_band
    sig = minhash_signatures(df, id_col, text_col, n_hashes=n, seed=seed).checkpoint()
    banded = sig.select("doc_id", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda b: F.xxhash64(F.slice("sig", b * rows_per_band + 1, rows_per_band)))).alias("band", "bkey"))
    reps = banded.groupBy("band", "bkey").agg(F.min("doc_id").alias("rep"))
    star = (banded.join(reps, ["band", "bkey"]).where(F.col("doc_id") != F.col("rep"))
            .select(F.col("doc_id").alias("src"), F.col("rep").alias("dst")).distinct())
    s1 = sig.select(F.col("doc_id").alias("src"), F.col("sig").alias("s1"))
    s2 = sig.select(F.col("doc_id").alias("dst"), F.col("sig").alias("s2"))
    agree = F.size(F.filter(F.arrays_zip("s1", "s2"), lambda p: p["s1"] == p["s2"])) / F.lit(float(n))
    edges = star.join(s1, "src").join(s2, "dst").where(agree >= threshold).select("src", "dst").checkpoint()
    labels = _components(edges)
    more = _links_between_components(banded, sig, labels, int(np.ceil(threshold * n - 1e-9))).checkpoint()
    return _components(edges.unionByName(more)) if more.limit(1).count() else labels
