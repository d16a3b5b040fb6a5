"""Exact cosine ranking and top-k over a vector corpus, for a batch of queries.

Corpus and queries are cut into blocks by a hash of their id; every (corpus block, query block) pair meets in
one ``cogroup().applyInPandas`` call (``blocked``, the default), at any size of either side: corpus rows are
replicated once per query block and queries once per corpus block, nothing is broadcast, and no task holds
more than one block of each. A block of a top-k has ``BLOCK_VALUES`` vector entries (65,536 vectors of 64
dimensions, 5,461 of 768; 50 MB a side in Python), so vectors are replicated, and candidates leave a block, as
seldom as memory allows; a large ``k`` makes blocks of fewer queries, so that about ``CANDIDATES`` rows leave one. Inside a task the blocks are scored in tiles of ``TILE`` x ``TILE`` pairs with a
running top-k, so besides the two blocks a worker holds a few tiles of 4 or 8 MB. ``expr`` is the JVM-only form
of the same blocks: an equi-join on the block pair and a cosine expression.

A score is one function of the two vectors, bit for bit, whatever block or tile they meet in: products and
squares are summed dimension by dimension in ascending order (``vectors.cosine`` does the same). The matrix
product, whose last bits depend on the shape of the tile, only preselects: pairs within ``SLACK`` of a bound
(``_Best.slack`` for the top-k, which preselects in single precision) are scored again in that fixed order before
they are compared.

The candidates of the blocks are merged with ``row_number() <= k``, which Spark plans as a partial
``WindowGroupLimit`` before the shuffle. Ties are broken by the lower corpus id, rows with a null, empty or
zero vector are dropped, and a query never returns its own id when ``exclude_self`` is set.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectors import cosine

DEFAULT_BLOCK_ROWS = 8192
#: vector entries of one side's block of a top-k
BLOCK_VALUES = 1 << 22
#: rows that the queries of a block get from it at most, on average: a large ``k`` makes blocks of fewer queries
CANDIDATES = 1 << 21
#: fewest rows of a block when a small input is spread over the cluster
LEAST_BLOCK_ROWS = 256
TILE = 1024
#: far above the error of a matrix product of unit vectors, far below any difference that matters
SLACK = 1e-9
_RESCORE_PAIRS = 1 << 18
#: vector entries of the corpus that a task of a full ranking holds
RANKED_VALUES = 1 << 25
#: scores of one query id that it holds
RANKED_SCORES = 1 << 24
_TILE_SCORES, _STRIP_SCORES = 1 << 20, 1 << 16

CAND_SCHEMA = T.StructType([
    T.StructField("qid", T.LongType()),
    T.StructField("id", T.LongType()),
    T.StructField("score", T.DoubleType()),
])


def _corpus_vectors(corpus: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    return (corpus.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
            .where(F.col("v").isNotNull() & (F.size("v") > 0)))


def _query_vectors(queries: DataFrame, qid_col: str, qvec_col: str) -> DataFrame:
    return (queries.select(F.col(qid_col).cast("long").alias("qid"), F.col(qvec_col).alias("qv"))
            .where(F.col("qv").isNotNull() & (F.size("qv") > 0)))


# ------------------------------------------------------------------ scoring
class _Side:
    """Vectors of one block, dimension by dimension, with norms summed in ascending dimension order."""

    def __init__(self, vectors: pd.Series):
        self.dims = np.ascontiguousarray(np.vstack(vectors.to_numpy()).T, dtype=np.float64)
        squares = np.zeros(self.dims.shape[1])
        for x in self.dims:
            squares += x * x
        self.norms = np.sqrt(squares)
        self.ok = np.isfinite(self.norms) & (self.norms > 0)

    def keep(self, rows: np.ndarray) -> None:
        self.dims, self.norms, self.ok = np.ascontiguousarray(self.dims[:, rows]), self.norms[rows], self.ok[rows]

    def _units(self, dtype) -> np.ndarray:
        return np.ascontiguousarray((self.dims / np.where(self.ok, self.norms, 1.0)).T, dtype=dtype)

    @cached_property
    def unit(self) -> np.ndarray:
        return self._units(np.float64)

    @cached_property
    def unit32(self) -> np.ndarray:
        return self._units(np.float32)


def _pair_scores(c: _Side, q: _Side, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Scores of the pairs (rows[i], cols[i]); the same two vectors give the same bits in any call."""
    out = np.empty(len(rows))
    for at in range(0, len(rows), _RESCORE_PAIRS):
        r, j = rows[at:at + _RESCORE_PAIRS], cols[at:at + _RESCORE_PAIRS]
        total = np.zeros(len(r))
        for x, y in zip(c.dims, q.dims):
            total += x[r] * y[j]
        out[at:at + _RESCORE_PAIRS] = total / (c.norms[r] * q.norms[j])
    return out


def _tiles(c: _Side, q: _Side, cid: np.ndarray, qid: np.ndarray, exclude_self: bool):
    """(first corpus row, first query, preselection scores) of every tile; pairs left out score -inf."""
    for b in range(0, len(qid), TILE):
        for a in range(0, len(cid), TILE):
            s = c.unit[a:a + TILE] @ q.unit[b:b + TILE].T
            s[~c.ok[a:a + TILE], :] = -np.inf
            s[:, ~q.ok[b:b + TILE]] = -np.inf
            if exclude_self:
                s[cid[a:a + TILE, None] == qid[None, b:b + TILE]] = -np.inf
            yield a, b, s


def _first_k(col: np.ndarray, score: np.ndarray, rid: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first ``k`` entries per ``col`` by score descending, then id."""
    order = np.lexsort((rid, -score, col))
    sorted_col = col[order]
    start = np.searchsorted(sorted_col, sorted_col, side="left")
    return order[np.arange(len(order)) - start < k]


def _frame(qid=(), rid=(), score=()) -> pd.DataFrame:
    return pd.DataFrame({"qid": np.asarray(qid, np.int64), "id": np.asarray(rid, np.int64),
                         "score": np.asarray(score, np.float64)})


def _first_copies(c: _Side, cid: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Those of ``rows`` that can be among the first ``k`` of any query: of equal vectors the first ``k`` rows of each
    of the first ``k + 1`` ids (one of which may be the query's own); rows without a norm never."""
    rows = rows[c.ok[rows]]
    _, kind, n = np.unique(c.norms[rows], return_inverse=True, return_counts=True)
    many = n[kind] > k   # equal vectors have equal norms
    if not many.any():
        return rows
    some = rows[many]
    kind = np.unique(np.ascontiguousarray(c.dims[:, some].T).view(f"V{8 * len(c.dims)}").ravel(), return_inverse=True)[1]
    order = np.lexsort((cid[some], kind))
    kind, ids, at = kind[order], cid[some][order], np.arange(len(some))
    new = np.r_[True, (kind[1:] != kind[:-1]) | (ids[1:] != ids[:-1])]
    nth = np.cumsum(new)
    nth_id = nth - nth[np.searchsorted(kind, kind, side="left")]
    nth_row = at - np.maximum.accumulate(np.where(new, at, 0))
    return np.sort(np.concatenate([rows[~many], some[order[(nth_id <= k) & (nth_row < k)]]]))


def _hits(mask: np.ndarray) -> np.ndarray:
    """``np.flatnonzero`` of a mask with few hits: eight entries are looked at as one."""
    flat = mask.ravel()
    whole = len(flat) & ~7
    at = (np.flatnonzero(flat[:whole].view(np.uint64))[:, None] * 8 + np.arange(8)).ravel()
    return np.concatenate([at[flat[at]], np.flatnonzero(flat[whole:]) + whole])


class _Best:
    """The first ``k`` corpus rows of each of the queries ``cols``, of all rows scored so far.

    Rows are gathered by single precision: a product of unit vectors of d dimensions is off by at most
    (d + 3) * 2^-24, and ``slack`` is more than four times that. Whatever lies within ``slack`` of the k-th best product
    stays, so no row that belongs to the first ``k`` is passed over; ``merged`` scores what is left exactly, as does
    ``_trim`` where too many rows are that close.
    """

    def __init__(self, c: _Side, cid: np.ndarray, q: _Side, qid: np.ndarray, cols: np.ndarray, k: int, exclude_self: bool):
        self.c, self.cid, self.q, self.qid, self.cols, self.k, self.exclude_self = c, cid, q, qid, cols, k, exclude_self
        self.slack = (len(c.dims) + 8) * 2.0 ** -22
        self.unit = np.ascontiguousarray(q.unit32[cols])
        self.least = np.full(len(cols), -np.inf)   # a row below it is not among the first k
        self.found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        self.fresh = 0

    def score(self, rows: np.ndarray, at: np.ndarray) -> None:
        """Take in the corpus rows ``rows`` for the queries at the places ``at`` of ``cols``."""
        own = self.qid[self.cols[at]]
        s = (self.unit if len(at) == len(self.cols) else self.unit[at]) @ self.c.unit32[rows].T
        least = self.least[at]
        begun = np.isfinite(least)
        if not begun.all() and len(rows) >= self.k:
            t = s[~begun]
            if self.exclude_self:
                t[own[~begun, None] == self.cid[None, rows]] = -np.inf
            least[~begun] = np.partition(t, len(rows) - self.k, axis=1)[:, len(rows) - self.k] - self.slack
        hits = _hits(s >= least.astype(np.float32)[:, None])
        j, r = np.divmod(hits, len(rows))
        if self.exclude_self:
            other = own[j] != self.cid[rows[r]]
            hits, j, r = hits[other], j[other], r[other]
        if not len(r):
            return
        self.found.append((at[j], rows[r], s.ravel()[hits].astype(np.float64)))
        self.fresh += len(r)
        if 2 * self.fresh >= self.k * len(self.cols):
            self._trim()

    def _trim(self) -> None:
        """Drop what is not near the first ``k``; the bounds follow."""
        j, r, score = (np.concatenate(x) for x in zip(*self.found))
        order = np.argsort(j * 4.0 - score)   # scores lie in [-1, 1]: one number line for all queries
        j, r, score = j[order], r[order], score[order]
        start = np.searchsorted(j, np.arange(len(self.cols)))
        last = start + self.k - 1
        full = last < np.append(start[1:], len(j))
        self.least[full] = score[last[full]] - self.slack
        near = score >= self.least[j]
        j, r, score = j[near], r[near], score[near]
        if len(j) > 4 * self.k * len(self.cols):
            j, r, score = self._exact(j, r)
        self.found, self.fresh = [(j, r, score)], 0

    def _exact(self, j: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        score = _pair_scores(self.c, self.q, r, self.cols[j])
        best = _first_k(j, score, self.cid[r], self.k)
        return j[best], r[best], score[best]

    def merged(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places of the queries, corpus rows, scores) of the best rows."""
        self._trim()
        (j, r, _), = self.found
        return self._exact(j, r)


def tile_queries(k: int, at_most: int = TILE) -> int:
    """Queries whose running first ``k`` a task keeps at a time."""
    return max(1, min(at_most, CANDIDATES // (4 * k)))


def _block_topk(k: int, exclude_self: bool):
    """Pandas function: score one corpus block against one query block, keep top-k per query."""

    def run(cdf: pd.DataFrame, qdf: pd.DataFrame) -> pd.DataFrame:
        if cdf.empty or qdf.empty:
            return _frame()
        c, q = _Side(cdf["v"]), _Side(qdf["qv"])
        cid, qid = cdf["id"].to_numpy(dtype=np.int64), qdf["qid"].to_numpy(dtype=np.int64)
        rows, cols = _first_copies(c, cid, np.arange(len(cid)), k), np.flatnonzero(q.ok)
        parts, width = [_frame()], tile_queries(k)
        for b in range(0, len(cols), width):
            best = _Best(c, cid, q, qid, cols[b:b + width], k, exclude_self)
            every = np.arange(len(best.cols))
            for a in range(0, len(rows), TILE):
                best.score(rows[a:a + TILE], every)
            j, r, score = best.merged()
            parts.append(_frame(qid[best.cols[j]], cid[r], score))
        return pd.concat(parts, ignore_index=True)

    return run


def _block_scores(exclude_self: bool):
    """Pandas function: every (corpus row, query) score of one block pair."""

    def run(cdf: pd.DataFrame, qdf: pd.DataFrame) -> pd.DataFrame:
        if cdf.empty or qdf.empty:
            return _frame()
        c, q = _Side(cdf["v"]), _Side(qdf["qv"])
        cid, qid = cdf["id"].to_numpy(dtype=np.int64), qdf["qid"].to_numpy(dtype=np.int64)
        parts = []
        for a, b, s in _tiles(c, q, cid, qid, exclude_self):
            r, j = np.nonzero(np.isfinite(s))
            parts.append(_frame(qid[j + b], cid[r + a], _pair_scores(c, q, r + a, j + b)))
        return pd.concat(parts, ignore_index=True)

    return run


BETTER_SCHEMA = T.StructType([
    T.StructField("qid", T.LongType()),
    T.StructField("id", T.LongType()),
    T.StructField("n_better", T.LongType()),
])


def _block_better_counts(exclude_self: bool):
    """Pandas function: per (query, candidate), rows of the corpus block ranked before the candidate.

    A preselection score further than ``SLACK`` from every candidate score of its query already decides the
    comparison; the others are scored exactly. A candidate's own row is never before it.
    """

    def run(cdf: pd.DataFrame, qdf: pd.DataFrame) -> pd.DataFrame:
        n_cand = qdf["cs"].map(len).to_numpy(dtype=np.int64) if len(qdf) else np.zeros(0, np.int64)
        if cdf.empty or not n_cand.sum():
            return pd.DataFrame({"qid": np.zeros(0, np.int64), "id": np.zeros(0, np.int64),
                                 "n_better": np.zeros(0, np.int64)})
        c, q = _Side(cdf["v"]), _Side(qdf["qv"])
        cid, qid = cdf["id"].to_numpy(dtype=np.int64), qdf["qid"].to_numpy(dtype=np.int64)
        cand_col = np.repeat(np.arange(len(qid)), n_cand)
        cand_score = np.concatenate(qdf["cs"].map(np.asarray).to_list()).astype(np.float64)
        cand_id = np.concatenate(qdf["ci"].map(np.asarray).to_list()).astype(np.int64)
        total = np.zeros(len(cand_id), np.int64)
        lowest = np.full(len(qid), np.inf)
        np.minimum.at(lowest, cand_col, cand_score)
        for a, b, s in _tiles(c, q, cid, qid, exclude_self):
            mine = np.flatnonzero((cand_col >= b) & (cand_col < b + s.shape[1]))
            r, j = np.nonzero(s >= lowest[None, b:b + s.shape[1]] - SLACK)
            if not len(r) or not len(mine):
                continue
            v, mc = s[r, j], cand_col[mine] - b
            # scores lie in [-1, 1]: one number line for all queries of the tile
            line = np.sort(mc * 4.0 + cand_score[mine])
            near = (np.searchsorted(line, j * 4.0 + v - SLACK)
                    < np.searchsorted(line, j * 4.0 + v + SLACK, side="right"))
            v[near] = _pair_scores(c, q, r[near] + a, j[near] + b)
            is_row = np.concatenate([np.zeros(len(mine), np.int64), np.ones(len(r), np.int64)])
            col = np.concatenate([mc, j])
            order = np.lexsort((is_row, np.concatenate([cand_id[mine], cid[r + a]]),
                                -np.concatenate([cand_score[mine], v]), col))
            seen = np.cumsum(is_row[order])
            sorted_col = col[order]
            start = np.searchsorted(sorted_col, sorted_col, side="left")
            before = seen - np.where(start > 0, seen[start - 1], 0)
            cand_at = order < len(mine)
            total[mine[order[cand_at]]] += before[cand_at]
        return pd.DataFrame({"qid": qid[cand_col], "id": cand_id, "n_better": total})

    return run


# ------------------------------------------------------------------ blocks
def _rows(df: DataFrame):
    return df.agg(F.count(F.lit(1))).scalar()


def block_counts(c: DataFrame, counted: DataFrame, block_rows: int | None = None, k: int = 1):
    """(rows a block holds on average at most, corpus blocks, query blocks) as scalar subqueries.

    ``block_rows`` rows a block, or ``BLOCK_VALUES`` vector entries when it is None; fewer for a small input that would
    leave cores idle, and fewer queries where each gets ``k`` rows from a block. ``counted``: the rows that number the
    query blocks."""
    if block_rows:
        at_most, least = F.lit(block_rows), F.lit(min(block_rows, LEAST_BLOCK_ROWS))
    else:
        at_most = F.greatest(F.lit(1), F.lit(BLOCK_VALUES) / F.coalesce(c.agg(F.max(F.size("v"))).scalar(), F.lit(1)))
        least = F.least(at_most, F.lit(LEAST_BLOCK_ROWS))
    rows, asked, cores = _rows(c), _rows(counted), F.lit(c.sparkSession.sparkContext.defaultParallelism)
    few = F.greatest(F.lit(1), F.ceil(rows / at_most))
    asks = F.least(at_most, F.lit(max(1, CANDIDATES // k)))
    # queries are split further first: a corpus block more is one more list of candidates per query
    qb = F.greatest(F.lit(1), F.ceil(asked / asks), F.least(F.ceil(cores / few), F.ceil(asked / least))).cast("int")
    cb = F.greatest(few, F.least(F.ceil(cores / qb), F.ceil(rows / least))).cast("int")
    return at_most, cb, qb


def block_partitions(spark) -> int:
    """A number of partitions that is given is not coalesced: block pairs are few, and heavy, so they get room to lie apart."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * spark.sparkContext.defaultParallelism)


#: a block pair, and the partition where it lies
_PAIR = ["_at", "_cb", "_qb"]


def _block_pairs(c: DataFrame, q: DataFrame, block_rows: int | None, counted: DataFrame, k: int = 1,
                 whole: bool = False) -> tuple[DataFrame, DataFrame]:
    """2-D blocks: corpus rows get a block id and are replicated once per query block, queries
    likewise; each (corpus block, query block) key meets once. Pairs are dealt to the partitions in turn: no task
    gets two of them while another has none. ``whole``: the corpus is one block."""
    _, cb, qb = block_counts(c, counted, block_rows, k)
    cb = F.lit(1) if whole else cb
    n = block_partitions(c.sparkSession)
    c2 = (c.withColumn("_cb", F.pmod(F.xxhash64("id"), cb).cast("int"))
          .withColumn("_qb", F.explode(F.sequence(F.lit(0), qb - 1))))
    q2 = (q.withColumn("_qb", F.pmod(F.xxhash64("qid"), qb).cast("int"))
          .withColumn("_cb", F.explode(F.sequence(F.lit(0), cb - 1))))
    turn = F.pmod(F.col("_cb").cast("long") * qb + F.col("_qb"), F.lit(n)).cast("int")
    return tuple(x.withColumn("_at", turn).repartitionById(n, F.col("_at")) for x in (c2, q2))


def _cogroup(c: DataFrame, q: DataFrame, block_rows: int | None, fn, schema, counted: DataFrame | None = None, k: int = 1,
             whole: bool = False) -> DataFrame:
    c2, q2 = _block_pairs(c, q, block_rows, counted if counted is not None else q, k, whole)
    return c2.groupBy(_PAIR).cogroup(q2.groupBy(_PAIR)).applyInPandas(fn, schema=schema)


def _final_topk(cands: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("id").asc())
    return cands.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def attach_docs(ranked: DataFrame, corpus: DataFrame, cols=("cmplid", "odino", "mfr_name",
                                                            "modeltxt", "compdesc", "cdescr")) -> DataFrame:
    """Join corpus attributes onto ``(qid, id, ...)`` rows (AQE picks the join side at run time)."""
    attrs = corpus.select(F.col("id").cast("long").alias("id"), *[F.col(c) for c in cols])
    return ranked.join(attrs, "id", "left")


def global_rank(pairs: DataFrame, group="qid", score="score", id_col="id",
                n_parts: int | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY group ORDER BY score DESC, id)`` without a
    single-task window per group.

    Rows are range-partitioned on the full sort key (a large group spreads over
    many tasks), numbered inside each partition, and shifted by the row counts
    of the earlier partitions of the same group (a table of partitions x groups).
    The sorted input is checkpointed to the shared folder so both uses see the
    same partitioning.
    """
    spark = pairs.sparkSession
    n = n_parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = [F.col(group), F.col(score).desc(), F.col(id_col)]
    r = (pairs.repartitionByRange(n, *key).sortWithinPartitions(*key)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_mid", F.monotonically_increasing_id())
         .checkpoint(eager=True))
    stats = r.groupBy("_pid", group).agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    w = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    return (r.join(stats.select("_pid", group, "_off", "_m0"), ["_pid", group])
            .withColumn("rank", (F.col("_off") + F.col("_mid") - F.col("_m0") + 1).cast("long"))
            .drop("_pid", "_mid", "_m0", "_off"))


RANK_SCHEMA = T.StructType(CAND_SCHEMA.fields + [T.StructField("rank", T.LongType())])


def _every_score(c: _Side, q: _Side, a: int, b: int) -> np.ndarray:
    """Scores of the queries from ``a`` to ``b`` (rows) with every corpus row, to the bits of ``_pair_scores``."""
    out = np.zeros((b - a, c.dims.shape[1]))
    width = max(1, _STRIP_SCORES // (b - a))
    for at in range(0, out.shape[1], width):
        total = out[:, at:at + width]
        product = np.empty(total.shape)
        for x, y in zip(c.dims, q.dims):
            total += np.multiply(x[None, at:at + width], y[a:b, None], out=product)
        total /= c.norms[None, at:at + width] * q.norms[a:b, None]
    return out


def _ranked(score: np.ndarray, rid: np.ndarray) -> np.ndarray:
    """Positions by score descending (NaN first, as Spark sorts), then id."""
    key = np.where(np.isnan(score), -np.inf, -score)
    order = np.argsort(key)
    ordered = key[order]
    return np.lexsort((rid, key)) if (ordered[1:] == ordered[:-1]).any() else order


def _partition_ranks(exclude_self: bool):
    """Pandas frames of a partition, ``side`` 0 (corpus) and 1 (queries) -> every corpus row of each query id, ranked."""

    def run(frames):
        sides = ([], [])
        for pdf in frames:
            for n in (0, 1):
                sides[n].append(pdf.loc[pdf["side"] == n, ["id", "v"]])
        if not sides[0]:
            return
        cdf, qdf = (pd.concat(x, ignore_index=True) for x in sides)
        sides = None
        if cdf.empty or qdf.empty:
            return
        qdf = qdf.sort_values("id", ignore_index=True)
        c, q = _Side(cdf["v"]), _Side(qdf["v"])
        cid, qid = cdf["id"].to_numpy(dtype=np.int64)[c.ok], qdf["id"].to_numpy(dtype=np.int64)[q.ok]
        cdf = qdf = None
        c.keep(c.ok)
        q.keep(q.ok)
        if not len(cid) or not len(qid):
            return
        starts = np.flatnonzero(np.r_[True, qid[1:] != qid[:-1], True])   # of a query id, whose rows are ranked together
        most = max(1, _TILE_SCORES // len(cid))
        g = 0
        while g < len(starts) - 1:
            last = max(g + 1, int(np.searchsorted(starts, starts[g] + most, side="right")) - 1)
            scores = _every_score(c, q, starts[g], starts[last])
            for h in range(g, last):
                own = qid[starts[h]]
                score = scores[starts[h] - starts[g]:starts[h + 1] - starts[g]]
                rid = np.tile(cid, len(score))
                score = score.ravel()
                if exclude_self:
                    other = rid != own
                    rid, score = rid[other], score[other]
                order = _ranked(score, rid)
                yield pd.DataFrame({"qid": np.full(len(order), own), "id": rid[order], "score": score[order],
                                    "rank": np.arange(1, len(order) + 1)})
            g = last

    return run


def rank_exact(corpus: DataFrame, queries: DataFrame, *, id_col="id", vec_col="embedding", qid_col="incident_id",
               qvec_col="qv", exclude_self=True) -> DataFrame:
    """Every corpus row per query with its rank: ``(qid, id, score, rank)``; rows of one query id are ranked together.

    Vectors travel, pairs do not: a task gets the corpus and its share of the queries, and ranks one small tile of
    queries after the other, so disk grows with the vectors and the number of tasks. A corpus of more than
    ``RANKED_VALUES`` entries, or a query id of more than ``RANKED_SCORES`` scores, is ranked by ``global_rank``, which
    shuffles the pairs and holds none of this in a task.
    """
    c, q = _corpus_vectors(corpus, id_col, vec_col), _query_vectors(queries, qid_col, qvec_col)
    rows, dim = c.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    asked, most = q.groupBy("qid").count().agg(F.sum("count"), F.max("count")).first()
    if rows * (dim or 0) > RANKED_VALUES or rows * (most or 0) > RANKED_SCORES:
        return global_rank(scored_pairs(corpus, queries, id_col=id_col, vec_col=vec_col, qid_col=qid_col,
                                        qvec_col=qvec_col, exclude_self=exclude_self))
    n = max(4 * c.sparkSession.sparkContext.defaultParallelism, -(-(asked or 0) * (dim or 0) // BLOCK_VALUES))
    n = max(1, min(n, asked or 0))
    no_id = F.lit(-1 << 63)   # a null id, as the block search takes it
    c2 = c.select(F.coalesce("id", no_id).alias("id"), "v", F.lit(0).alias("side"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("part"))
    q2 = q.select(F.coalesce("qid", no_id).alias("id"), F.col("qv").alias("v"), F.lit(1).alias("side"),
                  F.pmod(F.xxhash64("qid"), F.lit(n)).cast("int").alias("part"))
    return (c2.unionByName(q2).repartitionById(n, F.col("part")).select("side", "id", "v")
            .mapInPandas(_partition_ranks(exclude_self), RANK_SCHEMA))


def topn_by_column(df: DataFrame, col: str, n: int = 100, tie="seq") -> DataFrame:
    """Largest ``n`` rows by ``col`` (nulls last, ties by ``tie``): a TakeOrderedAndProject."""
    return df.orderBy(F.col(col).desc_nulls_last(), F.col(tie).asc()).limit(n)


def topk_exact(corpus: DataFrame, queries: DataFrame, k: int = 20, *, id_col="id",
               vec_col="embedding", qid_col="incident_id", qvec_col="qv", exclude_self=True,
               method="blocked", block_rows: int | None = None) -> DataFrame:
    """Top-k corpus rows per query by cosine: ``(qid, id, score, rank)``."""
    if method == "blocked":
        cands = _cogroup(_corpus_vectors(corpus, id_col, vec_col), _query_vectors(queries, qid_col, qvec_col),
                         block_rows, _block_topk(k, exclude_self), CAND_SCHEMA, k=k)
    else:
        cands = scored_pairs(corpus, queries, id_col=id_col, vec_col=vec_col, qid_col=qid_col, qvec_col=qvec_col,
                             exclude_self=exclude_self, method=method, block_rows=block_rows or DEFAULT_BLOCK_ROWS)
    return _final_topk(cands, k)


def scored_pairs(corpus: DataFrame, queries: DataFrame, *, id_col="id", vec_col="embedding",
                 qid_col="incident_id", qvec_col="qv", exclude_self=True, keep=None, method="blocked",
                 block_rows=TILE) -> DataFrame:
    """Every (query, corpus row) with its cosine ``score``: ``(qid, id, score, *keep)``.

    For a small set of given queries: the result holds a row per pair, and so does a task for its block pair.
    """
    keep = [x for x in (keep or []) if x != id_col]
    c, q = _corpus_vectors(corpus, id_col, vec_col), _query_vectors(queries, qid_col, qvec_col)
    if method == "blocked":
        pairs = _cogroup(c, q, block_rows, _block_scores(exclude_self), CAND_SCHEMA)
    elif method == "expr":
        c2, q2 = _block_pairs(c, q, block_rows, q)
        p = c2.join(q2, _PAIR)
        if exclude_self:
            p = p.where(F.col("id") != F.col("qid"))
        pairs = (p.select("qid", "id", cosine("v", "qv").alias("score"))
                 .where(F.col("score").isNotNull() & ~F.isnan("score")))
    else:
        raise ValueError(f"unknown method {method!r}")
    if keep:
        attrs = corpus.select(F.col(id_col).cast("long").alias("id"), *[F.col(x) for x in keep])
        pairs = pairs.join(attrs, "id")
    return pairs


def rank_then_filter(corpus: DataFrame, queries: DataFrame, predicate, limit: int = 30, *, id_col="id",
                     vec_col="embedding", qid_col="incident_id", qvec_col="qv", exclude_self=True,
                     block_rows: int | None = None, vectors: DataFrame | None = None) -> DataFrame:
    """Rank every corpus row per query, keep the first ``limit`` rows matching ``predicate``
    (on corpus columns) with their whole-corpus rank: ``(qid, id, score, rank)``.

    Two passes instead of a full ranking: the filtered top-``limit`` per query
    (candidates, checkpointed), then a count, per candidate, of all corpus rows
    ranked before it: each query carries its at most ``limit`` candidates to
    the corpus blocks, and the counts are summed over blocks. ``vectors``: the
    unfiltered ``(id, embedding)`` table for the counting pass (default:
    ``corpus``), so only the predicate pass reads the columns the predicate needs.
    """
    cands = topk_exact(corpus.where(predicate), queries, limit, id_col=id_col, vec_col=vec_col, qid_col=qid_col,
                       qvec_col=qvec_col, exclude_self=exclude_self, block_rows=block_rows).checkpoint(eager=True)
    found = cands.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("_c"))
    every = _query_vectors(queries, qid_col, qvec_col)
    q = (every.join(found, "qid")
         .select("qid", "qv", F.col("_c.score").alias("cs"), F.col("_c.id").alias("ci")))
    c = _corpus_vectors(vectors if vectors is not None else corpus, id_col, vec_col)
    counts = (_cogroup(c, q, block_rows or DEFAULT_BLOCK_ROWS, _block_better_counts(exclude_self), BETTER_SCHEMA, every)
              .groupBy("qid", "id").agg((F.sum("n_better") + 1).alias("rank")))
    return cands.drop("rank").join(counts, ["qid", "id"])


def filter_then_topk(corpus: DataFrame, queries: DataFrame, predicate, k: int = 20, **kw) -> DataFrame:
    """Filter the corpus first, then rank inside the filtered rows (ranks start at 1)."""
    return topk_exact(corpus.where(predicate), queries, k, **kw)
