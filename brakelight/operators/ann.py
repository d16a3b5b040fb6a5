"""Approximate top-k: a two-level tree of centroids, probed lists, exact rescore; recall@k.

Re-aims the graph index of the source system for Spark. The corpus is dealt to about sqrt(rows) lists by a tree of two
levels: about rows^(1/4) cells, each with lists in proportion to its rows. Each level is trained by spherical k-means on a
bounded sample (``TRAIN_ROWS`` vectors per centroid, chosen by a hash of their id), cells side by side; every vector is then
assigned, and centroids become the means of their members. The driver holds the cells' centroids only.

Lists stand on shelves of about as many vectors as a block of the exact search has (a larger list fills several). A query travels once per shelf that
holds any of its lists, with their numbers, and is scored there against the rows of those lists alone, exactly. Shelves
and query blocks are split by size, so no task holds a hot list or all queries of a popular one. Queries meet the
centroids in blocks, too, as many as give about ``topk.CANDIDATES`` probes, and leave with a row per shelf rather than per
list; on a shelf they are scored ``SHELF_QUERIES`` at a time. The number of probed lists follows from a measured recall and is
stored with the lists.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vectors
from ..session import scratch_path
from . import topk

#: vectors per centroid that a level is trained on
TRAIN_ROWS = 256
#: queries that a shelf keeps candidates of at a time
SHELF_QUERIES = 8 * topk.TILE


def list_count(n_rows: int) -> int:
    """Lists for a corpus: about the square root of its rows, so lists and centroids grow alike."""
    return max(1, round(n_rows ** 0.5))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def _kmeans(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Spherical k-means of unit vectors, begun with the first distinct ones; at most ``k`` centroids."""
    _, first = np.unique(x, axis=0, return_index=True)
    c = x[np.sort(first)[:k]]
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        new = np.where((np.bincount(near, minlength=len(c)) > 0)[:, None], _unit(sums), c)
        if np.array_equal(new, c):
            break
        c = new
    return c


def _trained(sample: DataFrame, rounds: int) -> DataFrame:
    """(cell, at, centroid): ``n`` centroids for each cell of the sample; a group holds a bounded sample."""
    def train(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values("order", kind="stable")
        c = _kmeans(_unit(np.vstack(df["v"].to_numpy()).astype(np.float64)), int(df["n"].iloc[0]), rounds)
        return pd.DataFrame({"cell": df["cell"].iloc[0], "at": np.arange(len(c)), "centroid": [r.tolist() for r in c]})

    return sample.groupBy("cell").applyInPandas(train, "cell int, at int, centroid array<double>")


def _nearest(rows: pd.Series, centroids: np.ndarray) -> np.ndarray:
    return (np.vstack(rows.to_numpy()).astype(np.float64) @ centroids.T).argmax(axis=1)


def build_lists(corpus: DataFrame, n_lists: int | None = None, seed: int = 7, id_col: str = "id",
                vec_col: str = "embedding", max_iter: int = 12) -> tuple[DataFrame, DataFrame]:
    """(corpus with ``list_id``, centroids ``(list_id, centroid)``).

    Every vector is in one list; null, empty and zero vectors are in none. At most about ``n_lists`` lists, fewer where a
    cell has fewer distinct vectors. Trained on at most about 4 * ``TRAIN_ROWS`` vectors per centroid of a cell.
    """
    spark = corpus.sparkSession
    data = (corpus.where(F.col(vec_col).isNotNull() & (F.size(vec_col) > 0) & (vectors.norm(vec_col) > 0))
            .select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
            .withColumn("order", F.xxhash64("id", F.lit(seed))))
    n = data.count()
    lists = n_lists or list_count(n)
    cells = max(1, round(lists ** 0.5))
    chosen = data.where(F.pmod("order", F.lit(max(1, n))) < TRAIN_ROWS * cells)
    top = _trained(chosen.select("v", "order", F.lit(0).alias("cell"), F.lit(cells).alias("n")), max_iter)
    # one centroid per cell: the fourth root of the rows
    centroids = np.array([r["centroid"] for r in top.orderBy("at").collect()] or np.zeros((1, 1)))

    @F.pandas_udf("int")
    def cell_of(v: pd.Series) -> pd.Series:
        return pd.Series(_nearest(v, centroids).astype(np.int32))

    celled = data.withColumn("cell", cell_of("v"))
    # a cell gets lists by its rows, and a sample of bounded size however many rows it holds
    sizes = celled.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"))
    sizes = sizes.withColumn("n", F.greatest(F.lit(1), F.least(F.lit(4 * cells), F.round(F.col("rows") * lists / max(1, n)))).cast("int"))
    second = celled.join(F.broadcast(sizes), "cell").where(F.pmod(F.xxhash64("order"), "rows") < TRAIN_ROWS * F.col("n"))
    tree = _trained(second.select("v", "order", "cell", "n"), max_iter)

    block = F.pmod("order", F.greatest(F.lit(1), F.ceil(F.col("rows") / topk.DEFAULT_BLOCK_ROWS)))
    rows = celled.join(F.broadcast(sizes), "cell").select("cell", block.cast("int").alias("block"), "id", "v")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("rows") / topk.DEFAULT_BLOCK_ROWS)).cast("int")
    copies = tree.join(F.broadcast(sizes), "cell").select("cell", "at", "centroid", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))
    width = 4 * cells

    def assign(df: pd.DataFrame, children: pd.DataFrame) -> pd.DataFrame:
        if df.empty:
            return pd.DataFrame({"id": [], "v": [], "list_id": []})
        children = children.sort_values("at")
        at = children["at"].to_numpy()[_nearest(df["v"], np.vstack(children["centroid"].to_numpy()))]
        return pd.DataFrame({"id": df["id"], "v": df["v"], "list_id": (df["cell"] * width + at).astype(np.int32)})

    kind = data.schema["v"].dataType.simpleString()
    key = ["cell", "block"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assigned = (rows.repartition(parts, *key).groupBy(*key).cogroup(copies.repartition(parts, *key).groupBy(*key))
                .applyInPandas(assign, f"id long, v {kind}, list_id int"))
    return assigned, centroid_means(assigned)


def centroid_means(assigned: DataFrame) -> DataFrame:
    """(list_id, centroid): mean of the unit vectors of each list."""
    unit = assigned.select("list_id", array_to_vector(vectors.l2_normalize("v")).alias("u"))
    return unit.groupBy("list_id").agg(Summarizer.mean(F.col("u")).alias("c")).select(
        "list_id", vector_to_array("c", "float32").alias("centroid"))


def store_lists(lists: tuple[DataFrame, DataFrame], path: str) -> tuple[DataFrame, DataFrame]:
    """Write the lists once, with the means of their members as centroids, and read them back."""
    assigned, _ = lists
    spark = assigned.sparkSession
    assigned.write.parquet(f"{path}/lists")
    centroid_means(spark.read.parquet(f"{path}/lists")).coalesce(1).write.parquet(f"{path}/centroids")
    return read_lists(spark, path)


def read_lists(spark, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/lists"), spark.read.parquet(f"{path}/centroids")


def build_index(corpus: DataFrame, queries: DataFrame, path: str, k: int = 20, recall: float = 0.95, n_lists: int | None = None,
                seed: int = 7, id_col: str = "id", vec_col: str = "embedding", qid_col: str = "incident_id",
                qvec_col: str = "qv", exclude_self: bool = True) -> tuple[tuple[DataFrame, DataFrame], int]:
    """Build and store the lists and the number of probes that finds ``recall`` of the queries' exact top-k."""
    lists = store_lists(build_lists(corpus, n_lists, seed, id_col, vec_col), path)
    n = probes_for_recall(corpus, queries, lists, k, recall, id_col, vec_col, qid_col, qvec_col, exclude_self)
    corpus.sparkSession.createDataFrame([(n,)], "n_probe int").coalesce(1).write.json(f"{path}/probes")
    return lists, n


def read_index(spark, path: str) -> tuple[tuple[DataFrame, DataFrame], int]:
    return read_lists(spark, path), spark.read.schema("n_probe int").json(f"{path}/probes").first()["n_probe"]


#: queries that the number of probes is measured on; a smaller set is measured whole
MEASURED_QUERIES = 2000


def probes_for_recall(corpus: DataFrame, queries: DataFrame, lists: tuple[DataFrame, DataFrame], k: int,
                      recall: float, id_col: str = "id", vec_col: str = "embedding", qid_col: str = "incident_id",
                      qvec_col: str = "qv", exclude_self: bool = True) -> int:
    """Fewest probes with which the queries find ``recall`` of their exact top-k.

    A neighbour is found when its list is among the probed ones, so the answer is the ``recall`` quantile of the
    rank that the list of an exact neighbour has for its query. Measured against ``topk_exact`` on all queries, or
    on about ``MEASURED_QUERIES`` of them, chosen by a hash of their id, so the cost grows with the corpus alone.
    """
    assigned, cents = lists
    q, n_lists = topk._query_vectors(queries, qid_col, qvec_col), cents.count()
    n = q.count()
    if n > MEASURED_QUERIES:
        q = q.where(F.pmod(F.xxhash64("qid", F.lit(5)), F.lit(n)) < MEASURED_QUERIES)
    near = topk.topk_exact(corpus, q, k, id_col=id_col, vec_col=vec_col, qid_col="qid", qvec_col="qv",
                           exclude_self=exclude_self).select("qid", "id")
    order = topk.topk_exact(cents, q, max(1, n_lists), id_col="list_id", vec_col="centroid", qid_col="qid",
                            qvec_col="qv", exclude_self=False)
    order = order.select("qid", F.col("id").cast("int").alias("list_id"), F.col("rank").alias("at"))
    ranks = near.join(assigned.select("id", "list_id"), "id").join(order, ["qid", "list_id"])
    at = ranks.agg(F.expr(f"percentile_disc({float(recall)}) WITHIN GROUP (ORDER BY at)")).first()[0]
    return int(at or 1)


def topk_ann(corpus: DataFrame, queries: DataFrame, k: int = 20, n_lists: int | None = None,
             n_probe: int | None = None, seed: int = 7, id_col: str = "id", vec_col: str = "embedding",
             qid_col: str = "incident_id", qvec_col: str = "qv", exclude_self: bool = True,
             list_rows: int | None = None, lists: tuple[DataFrame, DataFrame] | None = None,
             recall: float = 0.95) -> DataFrame:
    """Approximate top-k ``(qid, id, score, rank)`` scoring only the probed lists.

    ``n_probe``: lists probed per query; measured by ``probes_for_recall`` to reach ``recall`` when not given.
    ``lists``: what ``store_lists`` or ``build_lists`` returned; built and stored below the shared scratch
    folder when not given. Ties between centroids go to the lower list id. ``list_rows``: rows of a shelf and of a
    block of queries (default: as many as a block of the exact search has).
    """
    spark = corpus.sparkSession
    if lists is None:
        lists = store_lists(build_lists(corpus, n_lists, seed, id_col, vec_col), scratch_path(spark, f"lists-{uuid.uuid4().hex}"))
    assigned, cents = lists
    q = topk._query_vectors(queries, qid_col, qvec_col)
    n_probe = n_probe or probes_for_recall(corpus, queries, lists, k, recall, id_col, vec_col, qid_col, qvec_col,
                                           exclude_self)
    # shelves: lists one after the other, cut every ``shelf_rows`` vectors (a row per list, sqrt(rows) of them)
    shelf_rows, _, n_q = topk.block_counts(assigned, q, list_rows, k)
    before = Window.orderBy("list_id").rowsBetween(Window.unboundedPreceding, -1)
    shelves = (assigned.groupBy("list_id").agg(F.count(F.lit(1)).alias("rows"))
               .withColumn("shelf", F.floor(F.coalesce(F.sum("rows").over(before), F.lit(0)) / shelf_rows).cast("int"))
               .withColumn("wide", F.ceil(F.col("rows") / shelf_rows).cast("int")).drop("rows"))
    n = topk.block_partitions(spark)
    key = ["_shelf", "_qb"]
    c2 = assigned.join(shelves, "list_id").select(
        (F.col("shelf") + F.pmod(F.xxhash64("id"), "wide")).cast("int").alias("_shelf"),
        F.explode(F.sequence(F.lit(0), n_q - 1)).alias("_qb"), "id", "v", "list_id")
    visits = _visits(cents, shelves, q, n_probe)
    q2 = q.join(visits, "qid").select("_shelf", F.pmod(F.xxhash64("qid"), n_q).cast("int").alias("_qb"), "qid", "qv", "lists")
    cands = (c2.repartition(n, *key).groupBy(*key).cogroup(q2.repartition(n, *key).groupBy(*key))
             .applyInPandas(_shelf_topk(k, exclude_self), schema=topk.CAND_SCHEMA))
    return topk._final_topk(cands, k)


VISIT_SCHEMA = "qid long, _shelf int, lists array<int>"


def _visits(cents: DataFrame, shelves: DataFrame, q: DataFrame, n_probe: int) -> DataFrame:
    """``(qid, _shelf, lists)``: the shelves that hold any of the ``n_probe`` lists closest to a query, and those lists.

    The closest centroids are an exact top-k themselves. While all centroids fit into one block (about the square root of the
    rows), the task that has found them tells the shelves; more of them are ranked block by block first.
    """
    rows, dim = cents.agg(F.count(F.lit(1)), F.max(F.size("centroid"))).first()
    if rows * (dim or 0) <= topk.BLOCK_VALUES:
        placed = (topk._corpus_vectors(cents, "list_id", "centroid")
                  .join(shelves.select(F.col("list_id").cast("long").alias("id"), "shelf", "wide"), "id", "left"))
        return topk._cogroup(placed, q, None, _block_visits(n_probe), VISIT_SCHEMA, k=n_probe, whole=True)
    closest = topk.topk_exact(cents, q, n_probe, id_col="list_id", vec_col="centroid", qid_col="qid", qvec_col="qv",
                              exclude_self=False).select("qid", F.col("id").cast("int").alias("list_id"))
    return (closest.join(shelves, "list_id")
            .select("qid", "list_id", F.explode(F.sequence(F.col("shelf"), F.col("shelf") + F.col("wide") - 1)).alias("_shelf"))
            .groupBy("qid", "_shelf").agg(F.collect_set("list_id").alias("lists")))


def _block_visits(n_probe: int):
    """Pandas function: all centroids, with the shelves of their lists, against one block of queries."""

    def run(cdf: pd.DataFrame, qdf: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"qid": np.zeros(0, np.int64), "_shelf": np.zeros(0, np.int32), "lists": np.zeros(0, object)})
        if cdf.empty or qdf.empty:
            return empty
        c, q = topk._Side(cdf["v"]), topk._Side(qdf["qv"])
        cid, qid = cdf["id"].to_numpy(dtype=np.int64), qdf["qid"].to_numpy(dtype=np.int64)
        shelf, wide = (cdf[x].fillna(0).to_numpy(dtype=np.int64) for x in ("shelf", "wide"))   # a list without rows has none
        ids, who = np.unique(qid, return_inverse=True)
        again = np.bincount(who)[who] > 1   # rows of one query id share its probes
        shared = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))

        def visits(w: np.ndarray, r: np.ndarray) -> pd.DataFrame:
            n = wide[r]
            if not n.any():
                return empty
            w, r, nth = np.repeat(w, n), np.repeat(r, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            order = np.lexsort((cid[r], shelf[r] + nth, w))
            w, at, r = w[order], (shelf[r] + nth)[order], cid[r[order]]
            new = np.r_[True, (w[1:] != w[:-1]) | (at[1:] != at[:-1])]
            other = new | np.r_[True, r[1:] != r[:-1]]
            w, at, r, starts = w[other], at[other], r[other].astype(np.int32), np.flatnonzero(new[other])
            return pd.DataFrame({"qid": ids[w[starts]], "_shelf": at[starts].astype(np.int32), "lists": np.split(r, starts[1:])})

        rows, cols = topk._first_copies(c, cid, np.arange(len(cid)), n_probe), np.flatnonzero(q.ok)
        parts, width = [empty], topk.tile_queries(n_probe)
        for b in range(0, len(cols), width):
            best = topk._Best(c, cid, q, qid, cols[b:b + width], n_probe, False)
            every = np.arange(len(best.cols))
            for a in range(0, len(rows), topk.TILE):
                best.score(rows[a:a + topk.TILE], every)
            j, r, score = best.merged()
            j = best.cols[j]
            alone = ~again[j]
            parts.append(visits(who[j[alone]], r[alone]))
            w, r, score = (np.concatenate(x) for x in zip(shared, (who[j[~alone]], r[~alone], score[~alone])))
            first = topk._first_k(w, score, cid[r], n_probe)
            shared = w[first], r[first], score[first]
        parts.append(visits(*shared[:2]))
        return pd.concat(parts, ignore_index=True)

    return run


def _shelf_topk(k: int, exclude_self: bool):
    """Pandas function: the lists of a shelf against the queries that probe each of them, top-k per query."""

    def run(cdf: pd.DataFrame, qdf: pd.DataFrame) -> pd.DataFrame:
        if cdf.empty or qdf.empty:
            return topk._frame()
        c, q = topk._Side(cdf["v"]), topk._Side(qdf["qv"])
        cid, qid = cdf["id"].to_numpy(dtype=np.int64), qdf["qid"].to_numpy(dtype=np.int64)
        of_list = cdf["list_id"].to_numpy()
        by_list = np.argsort(of_list, kind="stable")
        lists = [(of_list[rows[0]], topk._first_copies(c, cid, rows, k))
                 for rows in np.split(by_list, np.flatnonzero(np.diff(of_list[by_list])) + 1)]
        cols = np.flatnonzero(q.ok)
        parts, width = [topk._frame()], topk.tile_queries(k, SHELF_QUERIES)
        for start in range(0, len(cols), width):
            best = topk._Best(c, cid, q, qid, cols[start:start + width], k, exclude_self)
            asked = qdf["lists"].iloc[best.cols]
            probed = np.concatenate(asked.map(np.asarray).to_list())
            who = np.repeat(np.arange(len(asked)), asked.map(len).to_numpy())
            order = np.argsort(probed, kind="stable")
            probed, who = probed[order], who[order]
            for list_id, rows in lists:
                at = who[np.searchsorted(probed, list_id):np.searchsorted(probed, list_id, side="right")]
                for a in range(0, len(rows), topk.TILE):
                    for b in range(0, len(at), topk.TILE):
                        best.score(rows[a:a + topk.TILE], at[b:b + topk.TILE])
            j, r, score = best.merged()
            parts.append(topk._frame(qid[best.cols[j]], cid[r], score))
        return pd.concat(parts, ignore_index=True)

    return run


def recall_at_k(exact: DataFrame, approx: DataFrame, k: int) -> DataFrame:
    """Per query: share of the exact top-k found by the approximate top-k."""
    hit = exact.select("qid", "id").join(approx.select("qid", "id"), ["qid", "id"], "left_semi")
    n_exact = exact.groupBy("qid").agg(F.count(F.lit(1)).alias("n_exact"))
    n_hit = hit.groupBy("qid").agg(F.count(F.lit(1)).alias("n_hit"))
    return (n_exact.join(n_hit, "qid", "left").fillna(0, ["n_hit"])
            .select("qid", "n_exact", "n_hit",
                    (F.col("n_hit") / F.least(F.lit(k), F.col("n_exact"))).alias("recall")))
