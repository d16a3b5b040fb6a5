"""File sources: raw complaint TSV, processed CSV (strict or ragged), eval-case JSON lines.

All readers take a declared schema (no inference) and return lower-case
column names. The raw scan adds an order key that reproduces file order:
``struct(file path, split start, row id)`` -- the row id alone is not file
order because splits are packed into partitions by size.
"""

from __future__ import annotations

import csv

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CORRUPT_COLUMN, EVAL_CASE, RAW_COLUMNS

ORDER_COL = "_order"


def raw_tsv_reader(reader, encoding: str = "ISO-8859-1"):
    """Read the raw layout one line per row (charset decoding by the CSV reader).

    Lines are split on tab afterwards with ``split``: field counts are then
    exact whatever columns a query reads (the CSV parser's own malformed-row
    detection changes with column pruning), and blank fields stay ``""``.
    """
    return (reader.schema("_line string, _corrupt_record string")
            .option("sep", "\u0001").option("header", False).option("quote", "")
            .option("encoding", encoding).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
            .option("maxCharsPerColumn", -1)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def with_raw_columns(df: DataFrame, order: bool = True) -> DataFrame:
    """51 string fields by position, ``_ragged`` (field count is not 51), ``_raw_line``,
    ``_source_file`` and, unless ``order`` is False (streams add it per micro-batch),
    the ``_order`` key."""
    line = F.coalesce(F.col(CORRUPT_COLUMN), F.col("_line"), F.lit(""))
    fields = F.split(line, "\t", -1)
    out = df.select(line.alias("_raw_line"), fields.alias("_f"),
                    F.col("_metadata.file_path").alias("_source_file"),
                    F.col("_metadata.file_block_start").alias("_block_start"))
    out = out.select(*[F.coalesce(F.try_element_at("_f", F.lit(i + 1)), F.lit("")).alias(c)
                       for i, c in enumerate(RAW_COLUMNS)],
                     (F.size("_f") != len(RAW_COLUMNS)).alias("_ragged"), "_raw_line", "_source_file",
                     "_block_start")
    return add_order_key(out) if order else out


def upload_of(file_col: str = "_source_file", unit: str = "file") -> F.Column:
    """The clean-job unit of a row: its file, or the folder holding it (an upload
    written by a parallel writer is a folder of part files)."""
    if unit == "file":
        return F.col(file_col)
    if unit == "folder":
        return F.regexp_extract(F.col(file_col), r"^(.*)/[^/]*$", 1)
    raise ValueError(f"unit must be 'file' or 'folder', not {unit!r}")


def add_order_key(df: DataFrame) -> DataFrame:
    """``_order = struct(file, split start, row id)``: file order across splits and files."""
    return df.withColumn(ORDER_COL, F.struct(F.col("_source_file").alias("f"), F.col("_block_start").alias("b"),
                                             F.monotonically_increasing_id().alias("i"))).drop("_block_start")


def scan_raw_tsv(spark: SparkSession, path, encoding: str = "ISO-8859-1", glob: str | None = None) -> DataFrame:
    """Raw complaint rows: 51 strings, ``_ragged``, ``_raw_line``, ``_source_file``, ``_order``."""
    r = raw_tsv_reader(spark.read, encoding)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return with_raw_columns(r.csv(path))


def split_ragged(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows, ragged rows with reason) -- one scan, two predicates."""
    good = raw.where(~F.col("_ragged")).drop("_ragged", "_raw_line")
    rej = raw.where(F.col("_ragged")).withColumn("reason", F.lit("field count"))
    return good, rej


def write_raw_tsv(df: DataFrame, path: str, encoding: str = "UTF-8", order: str | None = "seq",
                  n_files: int | None = None) -> None:
    """Write rows in the raw layout (tab and line breaks inside fields become spaces).

    ``n_files``: fixed number of ordered part files (default: AQE sizes them).
    """
    cols = [F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"[\t\r\n]", " ").alias(c) for c in RAW_COLUMNS]
    out = df.select(*([F.col(order)] if order else []), *cols)
    if order:
        # Range partitions are written as part files numbered in key order, so
        # (file, split, row) -- the reader's order key -- is the global order;
        # no task holds more than one range.
        ranged = (out.repartitionByRange(n_files, F.col(order)) if n_files
                  else out.repartitionByRange(F.col(order)))
        out = ranged.sortWithinPartitions(order).drop(order)
    (out.write.mode("errorifexists").option("sep", "\t").option("header", False).option("quote", "")
     .option("emptyValue", "").option("encoding", encoding)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_processed_csv(df: DataFrame, path: str) -> None:
    """Headered CSV with standard quoting (multi-line values allowed)."""
    (df.write.mode("errorifexists").option("header", True).option("quote", '"').option("escape", '"')
     .option("emptyValue", "").option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


_HEADER = "_header"


def _lines(spark: SparkSession, path) -> DataFrame:
    """Physical lines of the files at any depth below ``path``, with their file and split."""
    return (spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value",
                    F.monotonically_increasing_id().alias("line")))


#: splits whose table is sent to every executor (about 300 bytes each)
SENT_SPLITS = 50_000


def _with_splits(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """Lines with what is known of their split, those of a split together and in order.

    The table of splits is broadcast while the files make at most ``SENT_SPLITS`` of them, which keeps the order of the
    scan; beyond that, lines are shuffled by split and sorted.
    """
    spark = lines.sparkSession
    plan = lines._jdf.queryExecution().optimizedPlan()
    size = int(str(plan.stats().sizeInBytes()))
    least = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    many = len(lines.inputFiles()) + size // max(1, min(least, 4 << 20)) > SENT_SPLITS
    known = lines.join(splits if many else F.broadcast(splits), ["file", "block"])
    if many:
        known = known.repartition("file", "block").sortWithinPartitions("file", "block", "line")
    return known.select("file", "block", "value", "inside", _HEADER)


def _runs(batch):
    """(first row, end) of the runs of rows of one split in an Arrow batch; ``file, block`` are its first columns."""
    block = batch.column(1).to_numpy()
    file = batch.column(0).dictionary_encode().indices.to_numpy()
    cut = np.flatnonzero((block[1:] != block[:-1]) | (file[1:] != file[:-1])) + 1
    return zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows])


def csv_splits(lines: DataFrame) -> DataFrame:
    """A row per split of headered CSV files: file, block, header, inside, open.

    A task streams its splits and sends one row for each: the parity of its quotes, and the file's first line from its
    first split. The prefix sums of the parities over the splits of a file tell whether a split begins inside a quoted
    field (``inside``) and whether its last record goes on in the next split (``open``).
    """
    def run(batches):
        rows = []
        for b in batches:
            quotes = pc.count_substring(b.column(2), '"').to_numpy()
            for at, end in _runs(b):
                file, block, n = b.column(0)[at].as_py(), b.column(1)[at].as_py(), int(quotes[at:end].sum())
                if rows and rows[-1][:2] == [file, block]:
                    rows[-1][3] ^= n & 1
                else:
                    first = b.column(2)[at].as_py().lstrip("\ufeff").rstrip("\r") if block == 0 else None
                    rows.append([file, block, first, n & 1])
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
            (pa.string(), pa.int64(), pa.string(), pa.int32()))], names=["file", "block", "first", "odd"])

    splits = lines.mapInArrow(run, "file string, block long, first string, odd int")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2
    return splits.select("file", "block", F.max("first").over(Window.partitionBy("file")).alias(_HEADER),
                         inside.cast("int").alias("inside"), ((inside + F.col("odd")) % 2).cast("int").alias("open"))


def header_names(line: str | None) -> tuple[str, ...]:
    return tuple(n.strip().lower() for n in next(csv.reader([line or ""]), []))


def headers_of(spark: SparkSession, path) -> list[tuple[str, ...]]:
    """Distinct headers (names in lower case) of the files at any depth below ``path``; files without a line have none.

    The driver gets the distinct first lines, not one for each file.
    """
    first = csv_splits(_lines(spark, path)).where(F.col("block") == 0).select(_HEADER).distinct()
    return sorted({header_names(r[_HEADER]) for r in first.collect()} - {()})


def _fields(records: list[str], header: str, names: list[str]) -> list[list]:
    """Columns ``names`` of records, by the names of their header; blank records are skipped, what is absent is null."""
    at = {n: i for i, n in reversed(list(enumerate(header_names(header))))}   # of repeated names the first counts
    rows = [r for r in csv.reader(records) if r]
    return [[r[at[n]] or None if n in at and at[n] < len(r) else None for r in rows] for n in names]


def read_by_header(spark: SparkSession, path, columns=None, file_col: str | None = None) -> DataFrame:
    """Headered CSV files, every file by its own header: all strings, names in lower case, empty and absent fields null.

    Quoted fields may hold line breaks, and files are still read split by split: the lines are counted once for
    the quotes before each split (``csv_splits``), then every task assembles the records that begin and end in its
    split, and the few parts of records that cross splits are joined by file. The lines of a record are joined by "\\n", a
    "\\r" at its end is left out. A header is one line; quotes must be balanced within a record (a quote in an unquoted field
    is read as the beginning of a quoted one). ``columns``: names to return (default: all that occur).
    """
    names = list(columns) if columns is not None else list(dict.fromkeys(n for g in headers_of(spark, path) for n in g))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names + ([file_col] if file_col else [])])
    if not schema.fields:
        return spark.createDataFrame([], schema)
    lines, splits = _lines(spark, path), csv_splits(_lines(spark, path))

    def assembled(batches, crossing: bool):
        """(file, block, header, records) of each run of lines; with ``crossing`` the parts of unfinished records instead."""
        split, held, head = None, None, False
        for b in batches:
            odd = (pc.count_substring(b.column(2), '"').to_numpy() & 1).astype(bool)
            for at, end in _runs(b):
                key = (b.column(0)[at].as_py(), b.column(1)[at].as_py())
                out, text = [], b.column(2).slice(at, end - at).to_pylist()
                if key != split:
                    if crossing and held is not None:
                        yield *split, header, [(head, "\n".join(held))]
                    split, header, head = key, b.column(4)[at].as_py(), b.column(3)[at].as_py() == 1
                    held = [] if head else None
                    if key[1] == 0:
                        text, odd[at:end - 1], end = text[1:], odd[at + 1:end].copy(), end - 1
                plain = not odd[at:end].any() and held is None
                if plain and not crossing:
                    out = text
                elif not plain:
                    for line, flips in zip(text, odd[at:end].tolist()):
                        if held is None and not flips:
                            out += [] if crossing else [line]
                        elif held is None:
                            held = [line]
                        else:
                            held.append(line)
                            if flips:
                                whole, held = "\n".join(held), None
                                out += [(True, whole)] if crossing and head else [] if crossing or head else [whole]
                                head = False
                if out:
                    yield *key, header, out
        if crossing and held is not None:
            yield *split, header, [(head, "\n".join(held))]

    def batch(found: list, files: list) -> pa.RecordBatch:
        found = found + ([files] if file_col else [])
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in found], names=schema.names)

    def records(batches):
        for file, _, header, texts in assembled(batches, False):
            cols = _fields([t.rstrip("\r") for t in texts], header, names)
            n = len(cols[0]) if cols else len([t for t in texts if t])
            yield batch(cols, [file] * n)

    def parts(batches):
        rows = [(file, block, header, head, text) for file, block, header, found in assembled(batches, True) for head, text in found]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
            (pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.string()))], names=["file", "block", _HEADER, "head", "text"])

    def joined(batches):
        for b in batches:
            for file, header, text in zip(*(c.to_pylist() for c in b.columns)):
                cols = _fields([text.rstrip("\r")], header, names)
                yield batch(cols, [file] * (len(cols[0]) if cols else 1))

    # lines of splits that a record enters or leaves; of most files there are none
    edge = splits.where((F.col("inside") == 1) | (F.col("open") == 1))
    pieces = _with_splits(lines, edge).mapInArrow(
        parts, f"file string, block long, {_HEADER} string, head boolean, text string")
    # a record begins with a part that is no head and takes the heads that follow; one that no split ends is the file's last
    begun = F.sum(F.when(F.col("head"), 0).otherwise(1)).over(Window.partitionBy("file").orderBy("block", "head_last"))
    chain = pieces.withColumn("head_last", F.when(F.col("head"), 0).otherwise(1)).withColumn("record", begun)
    whole = chain.groupBy("file", "record", _HEADER).agg(F.array_join(F.transform(F.array_sort(F.collect_list(
        F.struct("block", "head_last", "text"))), lambda x: x["text"]), "\n").alias("text"))
    crossing = whole.select("file", _HEADER, "text").mapInArrow(joined, schema)
    return _with_splits(lines, splits).mapInArrow(records, schema).unionByName(crossing)


def scan_clean_csv(spark: SparkSession, path, required=None) -> DataFrame:
    """Processed CSV files, each by its own header: all strings, blanks kept, names lower-cased.

    ``required``: columns that every file must have; raises listing the missing ones.
    """
    headers = headers_of(spark, path)
    for names in headers if required else []:
        missing = [c for c in required if c not in names]
        if missing:
            raise ValueError(f"missing expected columns: {missing}; available: {list(names)}")
    df = read_by_header(spark, path, list(dict.fromkeys(n for g in headers for n in g)))
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns])


def scan_ragged_csv(spark: SparkSession, path, columns) -> DataFrame:
    """Headered CSV tolerant of short rows; ``columns`` looked up by each file's own header names
    (case-insensitive), absent columns and missing trailing fields read as ``""``.
    ``path`` is a file or a folder of files at any depth.
    """
    df = read_by_header(spark, path, columns)
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns])


def scan_eval_cases(spark: SparkSession, path) -> DataFrame:
    """JSON-lines eval cases (blank lines skipped), declared schema."""
    return spark.read.schema(EVAL_CASE).json(path)
