"""Packing of documents into training sequences: each window is filled with the lexical neighbours of its seed."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import scratch_path, slices
from .idfiles import SLICE_BYTES, encoder

K1, B = 1.2, 0.75
#: tokens of the documents that one index holds; a document longer than this has an index of its own
SHARD_TOKENS = 1 << 19
#: documents that one index holds: it has a column for each
SHARD_DOCS = 512
#: rows of the scratch table: the rest of a document, its whole windows, document frequencies
RESTS, WHOLE, COUNTS = 0, 1, 2
_STORED = (T.StructType().add("row", "long").add("rare", "long").add("start", "long").add("doc_tokens", "long").add("ids", "binary")
           .add("width", "integer").add("term", "integer").add("count", "long").add("kind", "integer"))


def _terms(ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, token id) pairs of consecutive documents, in order."""
    key = np.repeat(np.arange(len(n), dtype=np.uint64 if len(n) << 16 > 1 << 32 or ids.itemsize > 2 else np.uint32), n)
    shift = 8 * ids.itemsize
    key = np.sort(key << key.dtype.type(shift) | ids)
    key = key[np.append(True, key[1:] != key[:-1])]
    return (key >> key.dtype.type(shift)).astype(np.int64), (key & key.dtype.type((1 << shift) - 1)).astype(np.int64)


def _encoded(docs: DataFrame, path: str, tokenizer_file: str, size: int, end_id: int, id_col: str, text_col: str) -> None:
    """Encode every document once: whole windows, rests of less than a window, and each task's document frequencies."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *_STORED.fields])

    def run(batches):
        from pyspark import TaskContext

        row, df, n_docs, n_ids, id_type = TaskContext.get().partitionId() << 40, np.zeros(0, np.int64), 0, 0, None
        enc = encoder(tokenizer_file)
        width = enc.dtype.itemsize

        def stored(keys, rows, rare, start, n, ends, ids, kind):
            m = len(rows)
            # the ids between two rows of this kind belong to the other kind: only pieces are copied
            body = pa.array([ids[e - k:e].tobytes() for e, k in zip(ends.tolist(), n[0].tolist())], pa.binary())
            return pa.RecordBatch.from_arrays([
                keys, pa.array(rows), pa.array(rare, pa.int64()), pa.array(start), pa.array(n[1]), body,
                pa.array(np.full(m, width, np.int32)), pa.nulls(m, pa.int32()), pa.nulls(m, pa.int64()),
                pa.array(np.full(m, kind, np.int32))], names=schema.names)

        for big in batches:
            id_type = big.column(0).type
            for b in slices(big, 1, SLICE_BYTES):
                ids, n = enc.encode(b.column(1), end_id)
                ends, m = np.cumsum(n), len(n)
                doc, term = _terms(ids, n)
                found = np.bincount(term, minlength=len(df))
                last = np.cumsum(np.bincount(doc, minlength=m)) - 1
                # a byte-pair vocabulary numbers its tokens by falling frequency: the last ones are the rarest
                second = np.where(np.append(-1, last[:-1]) < last - 1, term[last - 1], 0)
                rare = term[last] << 32 | second
                found[:len(df)] += df
                df, n_docs, n_ids = found, n_docs + m, n_ids + int(ends[-1])
                whole = n // size * size
                rest = n - whole
                rows = np.arange(row, row + m)
                row += m
                some = np.flatnonzero(rest)
                part = ids[np.repeat(ends - rest, rest) + np.arange(rest.sum()) - np.repeat(np.cumsum(rest) - rest, rest)]
                if len(some):
                    yield stored(b.column(0).take(pa.array(some)), rows[some], rare[some], whole[some],
                                 (rest[some], n[some]), np.cumsum(rest)[some], part, RESTS)
                some = np.flatnonzero(whole)
                if len(some):
                    yield stored(b.column(0).take(pa.array(some)), rows[some], np.zeros(len(some), np.int64),
                                 np.zeros(len(some), np.int64), (whole[some], n[some]), (ends - rest)[some], ids, WHOLE)
        if n_docs:
            terms = np.flatnonzero(df)
            count = np.concatenate([[n_docs, n_ids], df[terms]])
            m = len(count)
            none = [pa.nulls(m, t) for t in (id_type, *[pa.int64()] * 4, pa.binary(), pa.int32())]
            yield pa.RecordBatch.from_arrays([
                *none, pa.array(np.concatenate([[-1, -2], terms]), pa.int32()), pa.array(count, pa.int64()),
                pa.array(np.full(m, COUNTS, np.int32))], names=schema.names)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows.mapInArrow(run, schema).write.partitionBy("kind").option("compression", "zstd").parquet(path)


class Idf:
    """BM25 statistics of the whole corpus: inverse document frequency by token id, mean length."""

    def __init__(self, counts: dict[int, int]):
        n = counts.pop(-1)
        self.mean = counts.pop(-2) / n
        df = np.zeros(max(counts) + 1)
        df[list(counts)] = list(counts.values())
        self.idf = np.log1p((n - df + 0.5) / (df + 0.5)).astype(np.float32)


class Index:
    """Inverted index of one shard: a row of BM25 weights over the shard's documents for every term."""

    def __init__(self, docs: list[np.ndarray], stats: Idf):
        pairs = [np.unique(d, return_counts=True) for d in docs]
        size = np.array([len(t) for t, _ in pairs])
        flat, tf = np.concatenate([t for t, _ in pairs]), np.concatenate([c for _, c in pairs])
        slot = np.zeros(len(stats.idf), np.int32)
        slot[flat] = 1
        used = np.flatnonzero(slot)
        slot[used] = np.arange(len(used))
        doc = np.repeat(np.arange(len(docs)), size)
        length = np.repeat([len(d) for d in docs], size) / stats.mean
        self.weights = np.zeros((len(used), len(docs)), np.float32)
        self.weights[slot[flat], doc] = stats.idf[flat] * (tf * (K1 + 1) / (tf + K1 * (1 - B + B * length)))
        self.slot, self.used, self.terms = slot, used, [t for t, _ in pairs]

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """BM25 score of every document of the shard for a query of distinct terms."""
        known = self.slot[terms]
        known = known[self.used[known] == terms]
        return self.weights[known].sum(axis=0)


class Packer:
    """Fills windows of ``size`` ids; pieces are (document, start, length, sequence, offset)."""

    def __init__(self, size: int, stats: Idf, first_sequence: int):
        self.size, self.stats, self.sequence = size, stats, first_sequence
        self.open: list = []  # pieces of the window that the shard before left open
        self.filled, self.query, self.pieces = 0, None, []

    def _place(self, doc, start: int, length: int) -> None:
        self.open.append((doc, start, length, self.filled))
        self.filled += length
        if self.filled == self.size:
            self._close()

    def _close(self) -> None:
        for doc, start, length, offset in self.open:
            self.pieces.append((doc, start, length, self.sequence, offset))
        self.sequence, self.open, self.filled = self.sequence + 1, [], 0

    def shard(self, docs: list) -> None:
        """Place all rests of a shard: (key, ids, start, doc_tokens). Only the last window may stay open."""
        if not docs:
            return
        rests = [d[1] for d in docs]
        start, left = np.zeros(len(docs), np.int64), np.array([len(r) for r in rests])
        index = Index(rests, self.stats)
        free, seed = np.ones(len(docs), bool), 0
        while True:
            if not self.filled:
                while seed < len(docs) and not free[seed]:
                    seed += 1
                if seed == len(docs):
                    return
                self.query = index.terms[seed]
                free[seed] = False
                self._place(docs[seed], int(start[seed]), int(left[seed]))
            near = np.flatnonzero(free)
            near = near[np.argsort(-index.scores(self.query)[near], kind="stable")]
            size = left[near]
            while True:
                # best neighbour that fits whole
                fits = np.flatnonzero(size <= self.size - self.filled)
                if not len(fits):
                    break
                best = fits[0]
                i = near[best]
                free[i], size[best] = False, self.size + 1
                self._place(docs[i], int(start[i]), int(left[i]))
                if not self.filled:
                    break
            if not self.filled:
                continue
            rest = np.flatnonzero(size <= self.size)
            if not len(rest):
                return
            # none fits: the best one is cut, and its rest is the next seed
            i, room = near[rest[0]], self.size - self.filled
            self._place(docs[i], int(start[i]), room)
            start[i], left[i], free[i] = start[i] + room, left[i] - room, False
            self.query = index.terms[i]
            self._place(docs[i], int(start[i]), int(left[i]))

    def end(self) -> None:
        """The last window becomes sequences whose lengths are powers of two, which need no padding."""
        pieces, room = self.open, 0
        total = self.filled
        self.open, self.filled = [], 0
        for doc, start, length, _ in pieces:
            while length:
                if not room:
                    room = 1 << (total.bit_length() - 1)
                n = min(length, room)
                self.open.append((doc, start, n, self.filled))
                self.filled, start, length, room, total = self.filled + n, start + n, length - n, room - n, total - n
                if not room:
                    self._close()

    def taken(self) -> list:
        done, self.pieces = self.pieces, []
        return done


def pack(docs: DataFrame, tokenizer_file: str, seq_len: int = 2048, end_id: int = 1, id_col: str = "doc_id",
         text_col: str = "text", shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """A row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    Documents are encoded once into a scratch table; their document frequencies come from the same pass. Whole windows of
    a long document are sequences of their own and are not shuffled; the rests, each of less than a window, are range
    partitioned by the rarest tokens of their document, so lexically close documents meet in a shard and a group of copies spreads over as
    many shards as it fills. A shard of about ``shard_tokens`` (and at most
    512 documents) has an inverted index with BM25 weights from the statistics of
    the whole corpus. The first unused document is the seed of a window; its unused neighbours fill it by falling score,
    first those that fit whole, then the best one is cut, and its rest seeds the next window. A window that a shard leaves open goes on in the next one; the last one of a
    partition is cut into sequences of lengths that are powers of two, so nothing is padded.

    Null and empty texts hold the end id alone; rows that repeat an id are documents of their own; null ids are kept; ties
    go to the row that comes first in the shard; an empty table gives an empty result; further columns are ignored. A
    task holds one shard and its index; of the statistics the driver gets one row per token of the vocabulary.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "pack")
    _encoded(docs, path, tokenizer_file, seq_len, end_id, id_col, text_col)
    id_field = T.StructField("id", docs.schema[id_col].dataType)
    stored = spark.read.schema(T.StructType([id_field, *_STORED.fields])).parquet(path)
    schema = T.StructType([T.StructField("doc_id", id_field.dataType)]).add("start", "long").add("length", "long")
    schema = schema.add("ids", "binary").add("doc_tokens", "long").add("sequence_id", "long").add("offset", "long")
    counted = stored.filter(F.col("kind") == COUNTS).groupBy("term").agg(F.sum("count").alias("n")).collect()
    if not counted:
        return spark.createDataFrame([], schema)
    stats = Idf({r["term"]: r["n"] for r in counted})
    columns = ["id", "ids", "start", "doc_tokens", "width"]
    rests = stored.filter(F.col("kind") == RESTS).select("rare", "row", *columns)
    ordered = rests.repartitionByRange("rare", "row").sortWithinPartitions("rare", "row").select(*columns)

    def read(b):
        for key, body, start, n, width in zip(b.column(0).to_pylist(), b.column(1), *(c.to_pylist() for c in b.columns[2:])):
            yield key, np.frombuffer(body.as_buffer(), f"<u{width}"), start, n

    def neighbours(batches):
        from pyspark import TaskContext

        packer, shard, held, id_type = Packer(seq_len, stats, TaskContext.get().partitionId() << 40), [], 0, None
        for b in batches:
            id_type = b.column(0).type
            for doc in read(b):
                shard.append(doc)
                held += len(doc[1])
                if held >= shard_tokens or len(shard) >= SHARD_DOCS:
                    packer.shard(shard)
                    shard, held = [], 0
                    yield _pieces(packer.taken(), id_type, schema.names)
        if id_type is not None:
            packer.shard(shard)
            packer.end()
            yield _pieces(packer.taken(), id_type, schema.names)

    def windows(batches):
        from pyspark import TaskContext

        # sequences of the other kind begin at partition << 40
        sequence = (1 << 62) + (TaskContext.get().partitionId() << 40)
        for b in batches:
            pieces = []
            for doc in read(b):
                for at in range(0, len(doc[1]), seq_len):
                    pieces.append((doc, at, seq_len, sequence, 0))
                    sequence += 1
                if len(pieces) * seq_len >= shard_tokens:
                    yield _pieces(pieces, b.column(0).type, schema.names)
                    pieces = []
            if pieces:
                yield _pieces(pieces, b.column(0).type, schema.names)

    whole = stored.filter(F.col("kind") == WHOLE).select(*columns)
    return ordered.mapInArrow(neighbours, schema).unionByName(whole.mapInArrow(windows, schema))


def _pieces(pieces: list, id_type, names: list[str]) -> pa.RecordBatch:
    body = [doc[1][start:start + n].astype("<u4").tobytes() for doc, start, n, _, _ in pieces]
    return pa.RecordBatch.from_arrays([
        pa.array([p[0][0] for p in pieces], id_type), pa.array([p[0][2] + p[1] for p in pieces], pa.int64()),
        pa.array([p[2] for p in pieces], pa.int64()), pa.array(body, pa.binary()),
        pa.array([p[0][3] for p in pieces], pa.int64()), pa.array([p[3] for p in pieces], pa.int64()),
        pa.array([p[4] for p in pieces], pa.int64())], names=names)
