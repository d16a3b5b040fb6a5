"""Token-id files: Arrow IPC files of equal-length sequences with masks, read back without copying."""

from __future__ import annotations

import re
import zlib
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import open_fs, scratch_path, slices

#: chunks kept per Python worker; a full cache keeps those of the texts at hand, which never changes an id
CACHED_CHUNKS = 1_200_000
#: bytes of text that are split and gathered at once
SLICE_BYTES = 8 << 20
#: texts in which a single space may touch other white space
_ODD = r"  |\n | \n|[\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_BREAK = re.compile(r"(?<=\S) (?=\S)")


class Encoder:
    """Ids of whole texts by the tokenizers library, as one array per batch.

    A byte-level pre-tokenizer always begins a new word at a single space between two other characters, so a text
    is the concatenation of its chunks there. Arrow splits the texts and numbers their distinct chunks; each is encoded
    once and kept in a pool, and the ids of the batch are gathered from it. Chunks are handed to the library joined by a
    special token, which no chunk merges with. Other kinds of vocabulary are encoded text by text.
    """

    def __init__(self, file: str):
        import json

        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(file)
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        pre, added = spec.get("pre_tokenizer") or {}, spec.get("added_tokens", [])
        self.chunked = (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
                        and pre.get("use_regex", True) and not spec.get("normalizer")
                        and not any(t.get("lstrip") or t.get("rstrip") or " " in t["content"] for t in added))
        # a separator must not overlap itself, or its matches would depend on the chunk before
        self.separator = next(((t["content"], t["id"]) for t in added if t.get("special") and not t.get("single_word") and not any(
            t["content"].startswith(t["content"][i:]) for i in range(1, len(t["content"])))), None)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.limit = CACHED_CHUNKS
        if self.chunked:
            from tokenizers import pre_tokenizers

            #: the same vocabulary without the splitting pattern, for words of letters alone, which it never splits
            self.letters = Tokenizer.from_file(file)
            self.letters.no_truncation()
            self.letters.no_padding()
            self.letters.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._clear()

    def _clear(self) -> None:
        #: place in the pool by word: of the word after a space, and of the word that begins a text
        self.after, self.first = {}, {}
        self.pool, self.starts, self.sizes = np.zeros(0, self.dtype), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def _keep(self, after: list[str], first: list[str]) -> None:
        """Only the words given stay in the pool, so that frequent ones are not encoded again."""
        kept = [{w: known[w] for w in words if w in known} for words, known in ((after, self.after), (first, self.first))]
        at = np.fromiter(chain(*(k.values() for k in kept)), np.int32)
        old, self.sizes = self.starts[at], self.sizes[at]
        self.starts = np.cumsum(self.sizes, dtype=np.int32) - self.sizes
        self.pool = self.pool[np.repeat(old - self.starts, self.sizes) + np.arange(self.sizes.sum())]
        numbers = iter(range(len(at)))
        self.after, self.first = ({w: next(numbers) for w in k} for k in kept)

    def _encode(self, texts: list[str], tok=None) -> list[np.ndarray]:
        return [np.asarray(e.ids, self.dtype) for e in (tok or self.tok).encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_joined(self, chunks: list[str], tok) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks, number of ids of each)."""
        if self.separator:
            content, mark = self.separator
            # short groups stay in the processor's cache; each ends with a mark of its own
            groups = self._encode([content.join(chunks[i:i + 64]) for i in range(0, len(chunks), 64)], tok)
            end = np.array([mark], self.dtype)
            whole = np.concatenate([x for g in groups for x in (g, end)])
            ends = np.flatnonzero(whole == mark)
            if len(ends) == len(chunks):  # else a chunk holds the separator itself
                return whole[whole != mark], np.diff(ends, prepend=-1) - 1
        each = self._encode(chunks, tok)
        return np.concatenate(each), np.array(list(map(len, each)))

    def _places(self, words: list[str], known: dict[str, int], lead: str) -> np.ndarray:
        """Places in the pool of ``lead`` + word for every word; new ones are encoded and added."""
        found = np.fromiter(map(known.get, words, repeat(-1)), np.int32, len(words))
        places = np.flatnonzero(found < 0)
        if len(places):
            new = [words[i] for i in places.tolist()]
            letters = np.fromiter(map(str.isalpha, new), bool, len(new))
            order = np.argsort(~letters, kind="stable")
            new, split = [new[i] for i in order.tolist()], int(letters.sum())
            ids, sizes, first = [self.pool], [self.sizes], len(self.sizes)
            for part, tok in ((new[:split], self.letters), (new[split:], self.tok)):
                for at in range(0, len(part), 20_000):
                    got, n = self._encode_joined([lead + w for w in part[at:at + 20_000]], tok)
                    ids.append(got)
                    sizes.append(n.astype(np.int32))
            numbers = range(first, first + len(new))
            known.update(zip(new, numbers))
            found[places[order]] = numbers
            self.pool, self.sizes = np.concatenate(ids), np.concatenate(sizes)
            self.starts = np.cumsum(self.sizes, dtype=np.int32) - self.sizes
        return found

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, one after the other; number of ids of each). Null is empty; ``end_id`` ends each text."""
        texts = texts.fill_null("")
        n = len(texts)
        if not n:
            return np.zeros(0, self.dtype), np.zeros(0, np.int64)
        if not self.chunked:
            end = np.array([] if end_id is None else [end_id], self.dtype)
            each = [np.concatenate([x, end]) for x in self._encode(texts.to_pylist())]
            return np.concatenate(each), np.array(list(map(len, each)), np.int64)
        # a space next to other white space is no break; most texts have none
        odd = pc.match_substring_regex(texts, _ODD)
        parts = pc.split_pattern(texts, " ")
        if pc.any(odd).as_py():
            mask = odd.to_numpy(zero_copy_only=False)
            broken = pa.array([_BREAK.split(t) for t in texts.filter(odd).to_pylist()], parts.type)
            place = np.arange(n)
            place[mask] = n + np.arange(mask.sum())
            parts = pa.concat_arrays([parts, broken]).take(pa.array(place))
        counts = parts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        begins = np.cumsum(counts) - counts
        flat = parts.flatten()
        coded = flat.dictionary_encode()
        inner, leading = (x.to_numpy(zero_copy_only=False).tolist() for x in (coded.dictionary, flat.take(pa.array(begins))))
        if len(self.after) + len(self.first) > self.limit:
            self._keep(inner, leading)
        after, first = self._places(inner, self.after, " "), self._places(leading, self.first, "")
        at = after[coded.indices.to_numpy()]
        at[begins] = first
        starts, sizes = self.starts[at], self.sizes[at]
        total = np.add.reduceat(sizes, begins, dtype=np.int64)
        if end_id is not None:
            starts = np.insert(starts, begins + counts, len(self.pool))
            sizes = np.insert(sizes, begins + counts, 1)
            total += 1
        pool = self.pool if end_id is None else np.append(self.pool, self.dtype.type(end_id))
        # 32 bits address what a batch and the pool hold
        ends = np.cumsum(sizes, dtype=np.int32)
        at = np.repeat(starts - ends + sizes, sizes)
        at += np.arange(len(at), dtype=np.int32)
        return pool[at], total


_ENCODERS: dict[str, Encoder] = {}


def encoder(file: str, cached_chunks: int = CACHED_CHUNKS) -> Encoder:
    """The worker's encoder of a vocabulary file; it keeps its chunks as long as the worker lives."""
    if file not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use every core
        _ENCODERS[file] = Encoder(file)
    _ENCODERS[file].limit = cached_chunks
    return _ENCODERS[file]


_MANIFEST = (T.StructType().add("part", "integer").add("file", "string").add("n_docs", "long").add("n_ids", "long")
             .add("n_sequences", "long"))


def write_ids(docs: DataFrame, path: str, tokenizer_file: str, seq_len: int = 2048, end_id: int = 0,
              id_col: str = "doc_id", text_col: str = "text", batch_seqs: int = 256,
              cached_chunks: int = CACHED_CHUNKS) -> DataFrame:
    """Encode every whole text, append ``end_id`` and write the ids in ascending id order below ``path``.

    Each partition of the range-partitioned documents writes

    * ``part-N-A.arrow``: an Arrow IPC file; each row holds ``ids`` (fixed-size list of ``seq_len`` unsigned
      integers of 16 or 32 bits, by vocabulary size) and ``mask`` (fixed-size list of booleans, false on the
      padding of the last row). Rows have equal length, so sequence i of a memory-mapped file is a slice;
    * ``part-N-A.docs.arrow``: doc id, start within the file and number of ids of each document.

    ``A`` names the task attempt; the returned manifest (also written below ``path``) names the files of the
    attempts that count, so files of lost attempts are never read. Null text gives the end id alone; null ids
    come first; ``cached_chunks`` bounds what a worker keeps (about 200 bytes each); rows that repeat an id are written next to each other; an empty table gives an empty
    manifest; further columns are ignored.
    """
    spark = docs.sparkSession

    def run(batches):
        from pyspark import TaskContext

        ctx = TaskContext.get()
        name = f"part-{ctx.partitionId():06d}-{ctx.taskAttemptId()}"
        enc, out, n_docs = None, None, 0
        for big in batches:
            for b in slices(big, 1, SLICE_BYTES):
                if out is None:
                    enc = encoder(tokenizer_file, cached_chunks)
                    out = _Writer(path, name, enc.dtype, seq_len, batch_seqs, b.schema.field(0).type)
                out.add(b.column(0), *enc.encode(b.column(1), end_id))
                n_docs += b.num_rows
        if out is not None:
            n_ids, n_seq = out.close()
            yield pa.RecordBatch.from_pylist([{"part": ctx.partitionId(), "file": name, "n_docs": n_docs,
                                               "n_ids": n_ids, "n_sequences": n_seq}],
                                             schema=pa.schema([("part", pa.int32()), ("file", pa.string()),
                                                               ("n_docs", pa.int64()), ("n_ids", pa.int64()),
                                                               ("n_sequences", pa.int64())]))

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    ordered = rows.repartitionByRange("id", "row").sortWithinPartitions("id", "row").select("id", "text")
    fs, local = open_fs(path)
    fs.create_dir(local, recursive=True)
    ordered.mapInArrow(run, _MANIFEST).write.mode("overwrite").parquet(f"{path}/manifest")
    return spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")


class _Writer:
    def __init__(self, path, name, dtype, seq_len, batch_seqs, id_type):
        fs, local = open_fs(path)
        self.dtype, self.seq_len, self.full = dtype, seq_len, seq_len * batch_seqs * dtype.itemsize
        value = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("ids", pa.list_(value, seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))])
        self.docs_schema = pa.schema([("id", id_type), ("start", pa.int64()), ("n", pa.int64())])
        self.sinks = [fs.open_output_stream(f"{local}/{name}.arrow", compression=None),
                      fs.open_output_stream(f"{local}/{name}.docs.arrow", compression=None)]
        self.ids = pa.ipc.new_file(self.sinks[0], self.schema)
        self.docs = pa.ipc.new_file(self.sinks[1], self.docs_schema)
        self.buffer, self.at, self.sequences = bytearray(), 0, 0

    def add(self, doc_ids, ids: np.ndarray, n: np.ndarray) -> None:
        start = self.at + np.cumsum(n) - n
        self.docs.write_batch(pa.RecordBatch.from_arrays([doc_ids, pa.array(start), pa.array(n)],
                                                         schema=self.docs_schema))
        self.at += int(n.sum())
        self.buffer += ids.tobytes()
        done = len(self.buffer) - len(self.buffer) % self.full
        for at in range(0, done, self.full):
            self._flush(bytes(self.buffer[at:at + self.full]), self.full)
        del self.buffer[:done]

    def _flush(self, data: bytes, size: int) -> None:
        values = pa.array(np.frombuffer(data, self.dtype))
        mask = pa.array(np.arange(len(values)) < size // self.dtype.itemsize)
        self.ids.write_batch(pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(values, self.seq_len),
             pa.FixedSizeListArray.from_arrays(mask, self.seq_len)], schema=self.schema))
        self.sequences += len(values) // self.seq_len

    def close(self) -> tuple[int, int]:
        if self.buffer:
            row = self.seq_len * self.dtype.itemsize
            padded = bytes(self.buffer) + bytes(-len(self.buffer) % row)
            self._flush(padded, len(self.buffer))
        self.ids.close()
        self.docs.close()
        for s in self.sinks:
            s.close()
        return self.at, self.sequences


def open_ids(path: str, name: str) -> pa.ipc.RecordBatchFileReader:
    """A file of sequences; local files are memory mapped, so batches are views of the file."""
    import pyarrow.fs as pafs

    fs, local = open_fs(path)
    file = f"{local}/{name}.arrow"
    return pa.ipc.open_file(pa.memory_map(file) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(file))


def sequence(reader: pa.ipc.RecordBatchFileReader, i: int, batch_seqs: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Sequence i of a file: (ids without copying, mask). All batches but the last hold ``batch_seqs`` rows."""
    batch, row = reader.get_batch(i // batch_seqs), i % batch_seqs
    n = batch.schema.field("ids").type.list_size
    ids = batch.column("ids").values.slice(row * n, n).to_numpy(zero_copy_only=True)
    return ids, batch.column("mask").values.slice(row * n, n).to_numpy(zero_copy_only=False)


_READ = T.StructType().add("doc_id", "long").add("start", "long").add("n_tokens", "long").add("ids_crc32", "long")


def read_documents(spark: SparkSession, path: str, id_type: T.DataType | None = None) -> DataFrame:
    """One row per written document, read from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it over all files; ``ids_crc32`` is taken over the ids as
    little-endian unsigned 32-bit integers. Files are read one per row of the manifest, batch by batch.
    """
    manifest = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")
    # one row per file: the running sum is over the list of files, not over documents
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("part", "file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("offset"))
    schema = T.StructType([T.StructField("doc_id", id_type or T.LongType()), *_READ.fields[1:]])

    def run(batches):
        for b in batches:
            for name, offset in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                yield from _read_file(path, name, offset, schema.names)

    n = max(1, manifest.count())
    return files.repartition(n, "part").mapInArrow(run, schema)


def _read_file(path, name, offset, names):
    fs, local = open_fs(path)
    with fs.open_input_file(f"{local}/{name}.docs.arrow") as f:
        docs = pa.ipc.open_file(f).read_all().combine_chunks()
    reader = open_ids(path, name)
    n = docs.column("n").to_numpy()
    ends = np.cumsum(n)
    crcs, k, crc, at = np.zeros(len(n), np.int64), 0, 0, 0
    for i in range(reader.num_record_batches):
        batch = reader.get_batch(i)
        ids = batch.column("ids").values.to_numpy(zero_copy_only=False)
        live = batch.column("mask").values.to_numpy(zero_copy_only=False)
        ids = ids[:int(np.count_nonzero(live))].astype("<u4")
        lo = 0
        while lo < len(ids):
            hi = min(len(ids), int(ends[k]) - at)
            crc = zlib.crc32(ids[lo:hi], crc)
            if at + hi == ends[k]:
                crcs[k], k, crc = crc, k + 1, 0
            lo = hi
        at += len(ids)
    if k != len(n):
        raise ValueError(f"{name}: ids end after {k} of {len(n)} documents")
    if len(n):
        yield pa.RecordBatch.from_arrays(
            [docs.column("id").combine_chunks() if isinstance(docs.column("id"), pa.ChunkedArray) else docs.column("id"),
             pa.array(offset + ends - n), pa.array(n), pa.array(crcs)], names=names)


def new_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "ids")
