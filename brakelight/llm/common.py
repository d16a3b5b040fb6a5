"""Helpers shared by the training-data operators: text rules, row keys, scratch tables, prefix sums."""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: separators of words: every ASCII character that is neither a digit nor a lower-case letter
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]++"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII texts take the byte-wise ``lower``."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def words(lowered: Column) -> Column:
    return F.regexp_extract_all(lowered, F.lit(WORD_PATTERN), F.lit(0))


#: byte table of the same word rule for tasks in Python: separators become spaces, A-Z lower case
WORD_BYTES = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else c + 32 if 65 <= c < 91 else 32
                   for c in range(256))


def byte_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


#: Spark's setting for removing shuffle files at the end of a query
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder below the shared folder named by ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


def scratch_table(df: DataFrame, label: str, paths: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the lineage, survives lost executors.

    The shuffle files of the write are not needed once it has ended, so Spark is told to remove them then. The folder is
    added to ``paths``, for ``remove_tables``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    if paths is not None:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_tables(spark: SparkSession, paths: list[str]) -> None:
    """Remove scratch tables that no returned DataFrame reads any more."""
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def open_fs(uri: str):
    """(pyarrow file system, path) of a URI or plain path; any store that pyarrow knows."""
    import pyarrow.fs as pafs

    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), os.path.abspath(uri)
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def slices(batch: pa.RecordBatch, column: int, size: int):
    """Runs of rows whose texts in ``column`` hold about ``size`` bytes; a longer text is a run of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy())
    at = 0
    while at < batch.num_rows:
        last = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
        yield batch.slice(at, last - at)
        at = last


def ordered_prefix(df: DataFrame, order: list[str], group: str, value: str, out: str, label: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows of the same ``group`` that come before in ``order``.

    ``order`` must begin with ``group``. The rows are range partitioned on the whole order, so a group that
    holds a third of all rows spreads over many partitions; each partition sums its own rows as a stream, and
    the totals per (partition, group) give the offsets. No group is ever gathered in one task. ``value`` must
    not be null; rows with equal order keys get distinct, consecutive sums. The result is a scratch table.
    """
    cols = df.columns
    schema = df.select(*cols).schema.add("_part", "integer").add("_local", "long")
    gi, vi, names = cols.index(group), cols.index(value), schema.names

    def local_sums(batches):
        from pyspark import TaskContext

        part, last, run = TaskContext.get().partitionId(), None, 0
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            v = b.column(vi).to_numpy(zero_copy_only=False).astype(np.int64)
            key = b.column(gi).to_pylist()
            total = np.cumsum(v)
            before = total - v
            starts = [0] + [i for i in range(1, n) if key[i] != key[i - 1]]
            for s, e in zip(starts, starts[1:] + [n]):
                if last is None or key[s] != last[0]:
                    run, last = 0, (key[s],)
                at = before[s]
                before[s:e] += run - at
                run = int(before[e - 1] + v[e - 1])
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(n, part, np.int32)), pa.array(before)], names=names)

    parts = scratch_table(
        df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(local_sums, schema), label)
    from pyspark.sql import Window

    sums = parts.groupBy(group, "_part").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col(group).alias("_g"), F.col("_part").alias("_p"),
                          F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    joined = parts.join(offsets, (parts["_part"] == offsets["_p"]) & parts[group].eqNullSafe(offsets["_g"]))
    return joined.select(*cols, (F.col("_offset") + F.col("_local")).alias(out))


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def in_blocks(items: Column, block: Column, fold) -> Column:
    """``fold`` of each run of ``block`` items, as an array: folds that copy what they grow stay short."""
    n = F.size(items)
    starts = F.when(n > 0, F.sequence(F.lit(1), F.greatest(n, F.lit(1)), block)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda at: fold(F.slice(items, at, block), at))


def running_sums(values: Column) -> Column:
    """Sum of each value (int) and all before it. Blocks of about the root of their number are summed on their own and
    shifted by the blocks before, so the work grows with the power 1.5 of the number of values."""
    none = F.array().cast("array<int>")

    def sums(xs):
        return F.aggregate(xs, none, lambda acc, x: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + x)))

    def shifted(inner):
        before = sums(F.concat(F.array(F.lit(0)), F.transform(inner, lambda x: F.element_at(x, -1))))
        return F.flatten(F.filter(F.zip_with(inner, before, lambda x, b: F.transform(x, lambda y: y + b)), lambda x: x.isNotNull()))

    block = lambda v: F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(v))).cast("int"))
    return let(values, lambda v: let(in_blocks(v, block(v), lambda xs, at: sums(xs)), shifted))


def located(text: Column, pattern: str) -> Column:
    """Array of structs (s, e, m): code-point start, exclusive end and text of every match, left to right.

    The pattern must never match the empty string. ``split`` and ``regexp_extract_all`` walk the same leftmost,
    non-overlapping matches, so match i ends after pieces 0..i and matches 0..i; lengths count code points.
    """
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    steps = F.filter(F.zip_with(found, between, lambda m, g: F.struct(F.char_length(g).alias("gap"), m.alias("m"))),
                     lambda x: x["m"].isNotNull())

    def placed(steps):
        ends = running_sums(F.transform(steps, lambda x: x["gap"] + F.char_length(x["m"])))
        return F.zip_with(steps, ends, lambda x, e: F.struct((e - F.char_length(x["m"])).alias("s"), e.alias("e"), x["m"].alias("m")))

    return let(steps, placed)


def located_if(test: Column, text: Column, pattern: str) -> Column:
    """``located`` where the cheap ``test`` holds, an empty array elsewhere."""
    return F.when(test, located(text, pattern)).otherwise(F.array().cast("array<struct<s:int,e:int,m:string>>"))


def span_list(spans: Column, kinds: list[str], kind: str = "k") -> Column:
    """``kind:start:end`` of each struct, comma-joined, in the order of the array."""
    names = F.array(*[F.lit(x) for x in kinds])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(names, x[kind] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")
