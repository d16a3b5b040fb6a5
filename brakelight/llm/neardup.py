"""Near duplicates: improved consistent weighted sampling over TF-IDF shingles, banded and verified."""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD_BYTES, byte_words, remove_tables, scratch_table
from .components import components

SHINGLE = 5
#: bytes of the texts that ask for their document frequencies together, least number of buckets that shingles
#: are counted in, and bytes of text for one more bucket
CHUNK, BUCKETS, BUCKET_BYTES = 700_000, 128, 1 << 23
#: entries of each random table
POOL = 1 << 15
_U = np.uint64
_ODD = np.random.default_rng(20240229).integers(1, 1 << 63, 64, dtype=np.uint64) * _U(2) + _U(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x9E3779B97F4A7C15)
    return x ^ (x >> _U(29))


#: a random number per byte, the base of word hashes and its inverse modulo 2^64, bytes of text hashed at once
_BYTE = np.random.default_rng(20240301).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE, SEGMENT = int(_ODD[40]), 1 << 19
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """The first ``n`` powers of the base and of its inverse."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            _POWERS[k] = np.cumprod(np.append(_U(1), np.full(n - 1, base, np.uint64)))
    return _POWERS


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words of a text: of each, the sum of its bytes' numbers times powers of the base, mixed.

    Prefix sums over the text give all words at once. Long texts are cut between words.
    """
    data = text.encode("utf-8", "surrogatepass").translate(WORD_BYTES) if text else b""
    found, at = [], 0
    while at < len(data):
        end = len(data) if len(data) - at <= SEGMENT else data.find(b" ", at + SEGMENT)
        end = len(data) if end < 0 else end
        x = np.frombuffer(data, np.uint8, end - at, at)
        edge = np.flatnonzero(np.diff((x != 32).view(np.int8), prepend=np.int8(0), append=np.int8(0)))
        start, stop = edge[::2], edge[1::2]
        power, inverse = _powers(max(len(x), SEGMENT))
        total = np.cumsum(_BYTE[x] * power[:len(x)])
        found.append(_mix((total[stop - 1] - np.where(start > 0, total[start - 1], _U(0))) * inverse[start]))
        at = end
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """Hashes of the runs of five words of a text, repeats kept; a shorter text is one shingle of all its words."""
    w = word_hashes(text)
    if not len(w):
        return w
    if len(w) < SHINGLE:
        w = np.concatenate([w, np.zeros(SHINGLE - len(w), np.uint64)])
    n = len(w) - SHINGLE + 1
    h = np.zeros(n, np.uint64)
    for j in range(SHINGLE):
        h = _mix(h + w[j:j + n] * _ODD[j])
    return h


class Frequencies:
    """Inverse document frequencies over ``texts`` distinct texts."""

    def __init__(self, texts: int):
        self.texts = texts

    def idf(self, df: np.ndarray) -> np.ndarray:
        """Smoothed inverse document frequency, from 1 (in every text) to 2 (in one)."""
        full = np.log1p(self.texts)
        return (1 + np.clip((full - np.log1p(df)) / max(full, 1e-9), 0, 1)).astype(np.float32)


def weighted(text: str | None, freq: Frequencies, df: bytes | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingles in ascending order, their TF-IDF weights); ``df``: their document frequencies as int64, 1 if not given."""
    h, tf = np.unique(shingles(text), return_counts=True)
    return h, tf.astype(np.float32) * freq.idf(np.ones(len(h)) if df is None else np.frombuffer(df, np.int64))


def similarity(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity: sum of minima over sum of maxima."""
    _, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    both = float(np.minimum(x[1][i], y[1][j]).sum(dtype=np.float64))
    all_ = float(x[1].sum(dtype=np.float64)) + float(y[1].sum(dtype=np.float64)) - both
    return both / all_ if all_ else 0.0


class Sampler:
    """Improved consistent weighted sampling: sample k of a weighted set is (element, level) with the least

    ``ln c - r * (t - beta + 1)`` where ``t = floor(ln w / r + beta)``, r and c are Gamma(2, 1) and beta is uniform.
    Two sets agree on a sample with the probability of their weighted Jaccard similarity. The variables of an
    element come from tables of ``POOL`` entries per sample, by a multiplicative hash of the element; equal
    entries are told apart by the element's hash.
    """

    def __init__(self, samples: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.samples = samples
        self.r = rng.gamma(2, 1, (samples, POOL)).astype(np.float32)
        self.inverse = 1 / self.r
        self.c = np.log(rng.gamma(2, 1, (samples, POOL))).astype(np.float32)
        self.beta = rng.random((samples, POOL), np.float32)
        self.mult = rng.integers(1, 1 << 63, samples, dtype=np.uint64) * _U(2) + _U(1)

    def sign(self, h: np.ndarray, w: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Samples (sets x samples, 64-bit) of sets given one after the other."""
        starts = np.cumsum(lens) - lens
        out = np.empty((len(lens), self.samples), np.uint64)
        lw = np.log(w)
        for k in range(self.samples):
            s = ((h * self.mult[k]) >> _U(64 - 15)).astype(np.int64)
            beta = self.beta[k].take(s)
            t = self.inverse[k].take(s)
            t *= lw
            t += beta
            np.floor(t, out=t)
            a = beta
            a -= t
            a -= np.float32(1)
            a *= self.r[k].take(s)
            a += self.c[k].take(s)
            low = np.repeat(np.minimum.reduceat(a, starts), lens)
            hit = np.flatnonzero(a == low)
            key = _mix(h[hit] + t[hit].astype(np.int64).view(np.uint64) * _ODD[20])
            first = np.searchsorted(hit, starts)
            out[:, k] = np.minimum.reduceat(key, first)
        return out


@cache
def _sampler(samples: int) -> Sampler:
    return Sampler(samples)


#: the node of texts without words
_NO_WORDS = hashlib.md5(b"").digest()


def _nodes(docs: DataFrame, id_col: str, text_col: str, with_text: bool) -> DataFrame:
    """(id, node) or (id, node, text): node is the digest of the word sequence of the whole text."""
    schema = T.StructType().add("id", docs.schema[id_col].dataType).add("node", "binary")
    if with_text:
        schema = schema.add("text", "string")

    def run(batches):
        for big in batches:
            for at in range(0, big.num_rows, 1000):
                b = big.slice(at, 1000)
                node = [hashlib.md5(b" ".join(byte_words(t))).digest() for t in b.column(1).to_pylist()]
                cols = [b.column(0), pa.array(node, pa.binary())] + ([b.column(1)] if with_text else [])
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def _chunked(texts: DataFrame) -> DataFrame:
    """The rows of ``texts`` with their ``chunk``: runs of about ``CHUNK`` bytes of text, named by their first node."""
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in texts.schema]).add("chunk", "binary")
    at_node, at_text = texts.columns.index("node"), texts.columns.index("text")

    def run(batches):
        chunk, held = None, 0
        for b in batches:
            names = []
            for node, size in zip(b.column(at_node).to_pylist(), pc.binary_length(b.column(at_text)).to_pylist()):
                if chunk is None or held >= CHUNK:
                    chunk, held = node, 0
                held += size
                names.append(chunk)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names, pa.binary())], names=schema.names)

    return texts.mapInArrow(run, schema)


def _asked(texts: DataFrame, buckets: int) -> DataFrame:
    """(chunk, bucket, h, n): per chunk and bucket its distinct shingles, ascending, and the number of its texts that each is in."""
    def asked(chunk, hs):
        h, n = np.unique(np.concatenate(hs), return_counts=True)
        bucket = _bucket(h, buckets)
        order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")  # 16 bits sort by radix
        h, n, bucket = h[order], n[order].astype(np.int64), bucket[order]
        cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(h)]
        parts = list(zip(cuts, cuts[1:]))
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk] * len(parts), pa.binary()), pa.array(bucket[cuts[:-1]].astype(np.int32)),
             pa.array([h[x:y].tobytes() for x, y in parts], pa.binary()),
             pa.array([n[x:y].tobytes() for x, y in parts], pa.binary())], names=["chunk", "bucket", "h", "n"])

    def run(batches):
        last, hs = None, []
        for b in batches:
            for chunk, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if hs and chunk != last:
                    yield asked(last, hs)
                    hs = []
                last = chunk
                hs.append(np.unique(shingles(text)))
        if hs:
            yield asked(last, hs)

    return texts.select("chunk", "text").mapInArrow(run, "chunk binary, bucket int, h binary, n binary")


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h * _ODD[8]) >> _U(33)).astype(np.int64) % buckets


def _answers(asked: DataFrame) -> DataFrame:
    """(chunk, h, n): the shingles of a chunk that are in more than one text, and in how many, counted exactly.

    All that is asked about a shingle is in one bucket; a shingle that every text has is there once per chunk.
    """
    schema = T.StructType().add("chunk", "binary").add("h", "binary").add("n", "binary")

    def run(pdf):
        import pandas as pd

        lens = pdf["h"].map(len).to_numpy() // 8
        h = np.frombuffer(b"".join(pdf["h"]), np.uint64)
        values, at = np.unique(h, return_inverse=True)
        total = np.zeros(len(values), np.int64)
        np.add.at(total, at, np.frombuffer(b"".join(pdf["n"]), np.int64))
        out, end = [], 0
        for chunk, m in zip(pdf["chunk"], lens.tolist()):
            x, n = h[end:end + m], total[at[end:end + m]]
            end += m
            if (n > 1).any():
                out.append((chunk, x[n > 1].tobytes(), n[n > 1].tobytes()))
        return pd.DataFrame(out, columns=schema.names)

    return asked.groupBy("bucket").applyInPandas(run, schema)


def _signatures(texts: DataFrame, answers: DataFrame, freq, bands: int, rows: int) -> DataFrame:
    """Texts with ``df``, ``sig``, ``bands``, ``size``: the document frequencies of the distinct shingles, the low
    byte of every sample, one hash per band, the bytes of the text."""
    schema = (T.StructType([f for f in texts.schema if f.name != "chunk"]).add("df", "binary").add("sig", "binary")
              .add("bands", T.ArrayType(T.LongType())).add("size", "long"))

    def run(pdf, found):
        import pandas as pd

        if not len(pdf):
            return pd.DataFrame({name: [] for name in schema.names})
        h = np.frombuffer(b"".join(found["h"]), np.uint64)
        n = np.frombuffer(b"".join(found["n"]), np.int64)
        order = np.argsort(h)
        h, n = np.append(h[order], _U(0xFFFFFFFFFFFFFFFF)), np.append(n[order], 1)
        sets = [np.unique(shingles(text), return_counts=True) for text in pdf["text"]]
        lens = np.fromiter((len(x) for x, _ in sets), np.int64, len(sets))
        own, tf = np.concatenate([x for x, _ in sets]), np.concatenate([c for _, c in sets])
        at = np.minimum(np.searchsorted(h, own), len(h) - 1)
        df = np.where(h[at] == own, n[at], 1)
        sig = _sampler(bands * rows).sign(own, tf.astype(np.float32) * freq.value.idf(df), lens)
        band = np.zeros((len(lens), bands), np.uint64)
        for j in range(rows):
            band = _mix(band + sig[:, j::rows] * _ODD[30 + j])
        low, ends = (sig & _U(255)).astype(np.uint8), np.cumsum(lens)
        return pdf.drop(columns="chunk").assign(
            df=[df[e - k:e].tobytes() for e, k in zip(ends.tolist(), lens.tolist())], sig=[x.tobytes() for x in low],
            bands=list(band.view(np.int64)), size=[len(t.encode("utf-8", "surrogatepass")) for t in pdf["text"]])

    return texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(run, schema)


def _verify(pairs: DataFrame, texts: DataFrame, freq) -> DataFrame:
    """(a, b, sim) of every pair, from the whole texts of both."""
    t = texts.select("node", "text", "df")
    both = (pairs.join(t.toDF("a", "text_a", "df_a"), "a").join(t.toDF("b", "text_b", "df_b"), "b")
            .select("a", "b", "text_a", "text_b", "df_a", "df_b"))
    schema = T.StructType().add("a", "binary").add("b", "binary").add("sim", "double")

    def run(batches):
        kept: OrderedDict[bytes, tuple] = OrderedDict()

        def sets(node, text, df):
            if node not in kept:
                kept[node] = weighted(text, freq.value, df)
                if len(kept) > 64:
                    kept.popitem(last=False)
            return kept[node]

        for big in batches:
            for at in range(0, big.num_rows, 1000):
                b = big.slice(at, 1000)
                cols = [c.to_pylist() for c in b.columns]
                sims = [similarity(sets(x, tx, dx), sets(y, ty, dy)) for x, y, tx, ty, dx, dy in zip(*cols)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sims, pa.float64())],
                                                 names=schema.names)

    return both.mapInArrow(run, schema)


def _candidates(pdf, floor: float) -> list[tuple[int, np.ndarray]]:
    """(query row, other rows) of one task that may be similar: other component, and signatures that agree enough.

    A pair is taken in the first band it shares and, where both rows are queries, from the smaller node.
    """
    sig = np.frombuffer(b"".join(pdf["sig"]), np.uint8).reshape(len(pdf), -1)
    bands = np.stack(pdf["bands"].to_numpy())
    _, root = np.unique(pdf["root"].to_numpy().astype(object), return_inverse=True)
    _, rank = np.unique(pdf["node"].to_numpy().astype(object), return_inverse=True)
    query, minor = pdf["query"].to_numpy(), pdf["minor"].to_numpy()
    others, band = np.flatnonzero(~query), int(pdf["band"].iloc[0])
    found = []
    for x in np.flatnonzero(query).tolist():
        ys = others[(root[others] != root[x]) & (~minor[others] | (rank[others] > rank[x]))]
        ys = ys[(sig[ys] == sig[x]).mean(1) >= floor]
        ys = ys[~(bands[ys, :band] == bands[x, :band]).any(1)]
        if len(ys):
            found.append((x, ys))
    return found


def _similar_rows(pdf, floor: float, threshold: float, freq: Frequencies) -> list[tuple[int, int]]:
    """Links (row, row) of one task that connect components: every candidate is compared on its whole text."""
    sets = [weighted(t, freq, df) for t, df in zip(pdf["text"], pdf["df"] if "df" in pdf else [None] * len(pdf))]
    vocabulary, at = np.unique(np.concatenate([h for h, _ in sets]), return_inverse=True)
    w = np.concatenate([x for _, x in sets])
    lens = np.fromiter((len(h) for h, _ in sets), np.int64, len(sets))
    starts = np.cumsum(lens) - lens
    total = np.add.reduceat(w, starts, dtype=np.float64)
    _, group = np.unique(pdf["root"].to_numpy().astype(object), return_inverse=True)
    dense, links = np.zeros(len(vocabulary), np.float32), []
    for x, ys in _candidates(pdf, floor):
        own = slice(starts[x], starts[x] + lens[x])
        dense[at[own]] = w[own]
        both = np.add.reduceat(np.minimum(w, dense[at]), starts, dtype=np.float64)[ys]
        dense[at[own]] = 0
        for y in ys[both >= threshold * (total[x] + total[ys] - both)].tolist():
            if group[x] != group[y]:
                group[group == group[y]] = group[x]
                links.append((x, y))
    return links


def _across(inside: DataFrame, roots: DataFrame, signed: DataFrame, texts: DataFrame, freq, threshold: float,
            floor: float, block: int = 256, block_bytes: int = 1 << 24, paths: list[str] | None = None) -> DataFrame:
    """(a, b): links between the components that one bucket spans.

    In a bucket the members outside its most frequent component are queries, and all members are searched. Both are
    dealt to blocks of about ``block`` rows and ``block_bytes`` of text; a task takes one block of queries and one
    of members. A first pass compares signatures and names the members of candidate pairs, a second one reads the
    texts of these and compares them exactly. A task gives out no more links than it has rows.
    """
    rows = inside.filter("n > 2").join(roots, "node", "left").select(
        "band", "key", "node", F.coalesce("root", "node").alias("root"))
    parts = rows.groupBy("band", "key", "root").agg(F.count("*").alias("m"))
    spans = parts.groupBy("band", "key").agg(F.max(F.struct("m", "root"))["root"].alias("main"),
                                             F.count("*").alias("parts")).filter("parts > 1")
    rows = rows.join(spans.select("band", "key", "main"), ["band", "key"]).join(signed.select("node", "sig", "bands", "size"), "node")
    rows = scratch_table(rows.withColumn("minor", F.col("root") != F.col("main")).drop("main"), "open-buckets", paths)

    def blocks(n, size):
        return F.greatest(F.ceil(n / block), F.ceil(size / block_bytes), F.lit(1)).cast("int")

    dealt = rows.groupBy("band", "key").agg(
        blocks(F.count("*"), F.sum("size")).alias("bs"),
        blocks(F.sum(F.col("minor").cast("int")), F.sum(F.when(F.col("minor"), F.col("size")))).alias("qs"))
    rows = rows.join(dealt, ["band", "key"]).withColumn("h", F.xxhash64("node", F.lit(3)))
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    own = lambda n: F.pmod("h", F.col(n)).cast("int")
    cols = ["band", "key", "b", "q", "query", "node", "root", "minor", "sig", "bands"]
    members = rows.withColumn("b", own("bs")).withColumn("q", F.explode(every("qs"))).withColumn("query", F.lit(False))
    queries = rows.filter("minor").withColumn("q", own("qs")).withColumn("b", F.explode(every("bs"))).withColumn("query", F.lit(True))
    tasks = members.select(cols).unionByName(queries.select(cols))

    def named(pdf):
        found = _candidates(pdf, floor)
        at = np.unique(np.concatenate([[x for x, _ in found], *[ys for _, ys in found]]).astype(int)) if found else []
        return pdf.iloc[at]

    def verified(pdf):
        import pandas as pd

        nodes = [bytes(x) for x in pdf["node"]]
        links = [sorted((nodes[x], nodes[y])) for x, y in _similar_rows(pdf, floor, threshold, freq.value)]
        return pd.DataFrame({"a": pd.Series([x for x, _ in links], dtype=object),
                             "b": pd.Series([y for _, y in links], dtype=object)})

    task = ["band", "key", "b", "q"]
    close = scratch_table(tasks.groupBy(task).applyInPandas(named, tasks.schema), "candidates", paths)
    links = close.join(texts.select("node", *[c for c in ("text", "df") if c in texts.columns]), "node").groupBy(task).applyInPandas(
        verified, T.StructType().add("a", "binary").add("b", "binary"))
    return scratch_table(links.distinct(), "links-across", paths)


def near_duplicates(docs: DataFrame, threshold: float = 0.8, bands: int = 14, rows: int = 4,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, class_id, rep_id, class_size, n_texts, kept.

    Texts are compared as weighted sets of five-word shingles (words as in decontamination; weight: occurrences
    times inverse document frequency over all distinct texts). Classes are the connected components of the links
    of weighted Jaccard similarity ``threshold`` or more; ``class_id`` is the smallest id of the class.

    1. Rows with equal word sequences collapse into one text (``rep_id``: smallest id among them). The document
       frequency of every shingle is counted exactly: chunks of texts ask for their distinct shingles, bucket by
       bucket, and get back those that other texts hold too.
    2. Every text is signed with ``bands`` * ``rows`` samples; a bucket holds the texts that agree on a whole band.
    3. In each bucket all texts are verified exactly against its hub, the text that meets most others over all its
       buckets (the original of many edited copies rather than one of these); links give components.
    4. Buckets that still span several components are searched for links across them: blocks of signatures
       are compared, and pairs whose signatures agree on at least ``threshold`` less five standard deviations are
       verified exactly where their block is. A pair at the threshold meets in some band with probability
       1 - (1 - threshold^rows)^bands (0.9994 by default), more similar pairs sooner.

    Null text, and text without words, is a class of its own row. Repeated rows share a class; null ids
    are never the smallest unless a class has no other; one row per class is ``kept`` when its smallest id is not
    repeated, otherwise all rows with that id. An empty table gives an empty result; further columns are ignored.
    """
    spark: SparkSession = docs.sparkSession
    paths: list[str] = []
    n_bytes = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    texts = (_nodes(docs, id_col, text_col, True).filter(F.col("node") != F.lit(_NO_WORDS)).groupBy("node")
             .agg(F.min("id").alias("rep_id"), F.count("*").alias("copies"), F.first("text").alias("text")))
    first: list[str] = []
    texts = scratch_table(_chunked(texts), "texts", first)
    freq = spark.sparkContext.broadcast(Frequencies(texts.count()))
    answers = scratch_table(_answers(_asked(texts, max(BUCKETS, n_bytes // BUCKET_BYTES))), "answers", first)
    texts = signed = scratch_table(_signatures(texts, answers, freq, bands, rows), "signatures", paths)
    remove_tables(spark, first)
    member = signed.select("node", F.posexplode("bands").alias("band", "key"))
    sizes = member.groupBy("band", "key").agg(F.count("*").alias("n")).filter("n > 1")
    inside = scratch_table(member.join(sizes, ["band", "key"]), "members", paths)
    near = inside.groupBy("node").agg(F.sum("n").alias("near"))
    hubs = inside.join(near, "node").groupBy("band", "key").agg(F.max(F.struct("near", "node"))["node"].alias("hub"))
    pairs = inside.join(hubs, ["band", "key"]).filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    links = scratch_table(_verify(pairs.distinct(), texts, freq).filter(F.col("sim") >= threshold).select("a", "b"), "links-hub", paths)
    roots = components(links, paths)
    floor = threshold - 5 * (threshold * (1 - threshold) / (bands * rows)) ** 0.5
    more = _across(inside, roots, signed, texts, freq, threshold, floor, paths=paths)
    if not more.isEmpty():
        roots = components(roots.toDF("a", "b").unionByName(more), paths)

    nodes = texts.select("node", "rep_id", "copies").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    classes = nodes.groupBy("root").agg(F.min("rep_id").alias("class_id"), F.sum("copies").alias("class_size"), F.count("*").alias("n_texts"))
    nodes = scratch_table(nodes.join(classes, "root").select("node", "rep_id", "class_id", "class_size", "n_texts"), "classes")
    remove_tables(spark, paths)
    # rows without words find no node: each is a class of its own
    one = F.lit(1).cast("long")
    out = _nodes(docs, id_col, text_col, False).join(nodes, "node", "left").select(
        "id", F.when(F.col("n_texts").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(F.col("n_texts").isNull(), F.col("id")).otherwise(F.col("rep_id")).alias("rep_id"),
        F.coalesce("class_size", one).alias("class_size"), F.coalesce("n_texts", one).alias("n_texts"))
    out = out.withColumn("kept", F.col("id").eqNullSafe(F.col("class_id")))
    return out.withColumnRenamed("id", id_col)
