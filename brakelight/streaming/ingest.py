"""Streaming ingest: new raw files -> cleaning chain -> clean zone.

A file-source stream replaces the folder watcher: Spark lists the folder,
remembers processed files in the checkpoint, and each micro-batch is cleaned
with the same batch operators inside ``foreachBatch``. Producers must write
elsewhere and rename into the folder (names starting with ``_`` or ``.`` are
ignored), which replaces "wait until the file size is stable".
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import clean_complaints
from ..sources.files import ORDER_COL, add_order_key, raw_tsv_reader, split_ragged, upload_of, with_raw_columns


def raw_file_stream(spark: SparkSession, folder: str, glob: str = "*", encoding: str = "ISO-8859-1",
                    since_ms: int | None = None, max_files: int | None = None) -> DataFrame:
    """Streaming raw rows of files in ``folder`` (non-recursive, ``glob`` filter).

    ``since_ms``: skip files whose modification time is before this instant
    (files present at start are not processed).
    """
    r = raw_tsv_reader(spark.readStream, encoding).option("pathGlobFilter", glob)
    r = r.option("ignoreCorruptFiles", True)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    df = with_raw_columns(r.csv(folder), order=False)
    if since_ms is not None:
        df = df.where(F.col("_metadata.file_modification_time") >= F.timestamp_millis(F.lit(since_ms)))
    return df


def clean_batch_writer(zone: str, quarantine: str, unit: str = "file"):
    """``foreachBatch`` function: clean each upload of the micro-batch independently and
    write the zone partition ``batch=<id>`` (overwritten on replay, so re-runs are idempotent).

    ``unit``: an upload is one file (``file``) or one folder of part files
    (``folder``); the folder's files must land in the folder together (rename in).
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        good, ragged = split_ragged(add_order_key(batch))
        good = good.withColumn("_upload", upload_of("_source_file", unit))
        cleaned = clean_complaints(good.drop("_source_file"), order=ORDER_COL, scope=("_upload",))
        (cleaned.drop(ORDER_COL).withColumnRenamed("_upload", "_source_file").write.mode("overwrite")
         .parquet(posixpath.join(zone, f"batch={batch_id}")))
        ragged.select("_source_file", "_raw_line", "reason").write.mode("overwrite") \
            .parquet(posixpath.join(quarantine, f"batch={batch_id}"))

    return run


def run_clean_stream(spark: SparkSession, folder: str, zone: str, quarantine: str, checkpoint: str,
                     glob: str = "*", encoding: str = "ISO-8859-1", since_ms: int | None = None,
                     available_now: bool = True, interval: str = "2 seconds", unit: str = "file"):
    """Start the ingest stream; with ``available_now`` it processes what is there and stops."""
    q = (raw_file_stream(spark, folder, glob, encoding, since_ms).writeStream
         .foreachBatch(clean_batch_writer(zone, quarantine, unit))
         .option("checkpointLocation", checkpoint))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime=interval)
    handle = q.start()
    if available_now:
        handle.awaitTermination()
    return handle


def file_listing_stream(spark: SparkSession, folder: str, glob: str = "*", since_ms: int | None = None) -> DataFrame:
    """One row per new file (path, size, modification time): the new-file event source."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    r = (spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", glob)
         .option("recursiveFileLookup", False).load(folder))
    df = r.select("path", "length", "modificationTime")
    if since_ms is not None:
        df = df.where(F.col("modificationTime") >= F.timestamp_millis(F.lit(since_ms)))
    return df
