"""Streaming load: job messages / processed rows -> idempotent keyed upsert,
per-message status, and dead-lettering of messages that keep failing."""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.tables import KeyedTable, path_exists
from ..sources.messages import decode_job_messages


def run_upsert_stream(spark: SparkSession, source: DataFrame, table: KeyedTable, checkpoint: str):
    """Each micro-batch is upserted; a replayed batch leaves the table as it was."""

    def run(batch: DataFrame, batch_id: int) -> None:
        table.apply(batch)

    h = (source.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    h.awaitTermination()
    return h


def message_status(decoded: DataFrame, resolve, spark: SparkSession) -> DataFrame:
    """``ok`` when the message decodes and the file it names exists, else ``failed: <reason>``.

    Only the batch's distinct keys are checked on the driver (file-system metadata)."""
    keys = [r["result_key"] for r in decoded.where("is_valid").select("result_key").distinct().collect()]
    present = [k for k in keys if path_exists(spark, resolve(k))]
    found = F.col("result_key").isin(present) if present else F.lit(False)
    status = (F.when(~F.col("is_valid"), F.lit("failed: malformed message"))
              .when(~found, F.lit("failed: file not found")).otherwise(F.lit("ok")))
    return decoded.withColumn("status", status)


def run_status_stream(spark: SparkSession, source: DataFrame, resolve, status_table: str, checkpoint: str):
    """Write one status row per message; the partition of a batch is overwritten on replay."""

    def run(batch: DataFrame, batch_id: int) -> None:
        st = message_status(decode_job_messages(batch), resolve, spark)
        (st.select("message_id", "status", "job_id", "result_key").write.mode("overwrite")
         .parquet(posixpath.join(status_table, f"batch={batch_id}")))

    h = (source.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    h.awaitTermination()
    return h


def retry_queue(messages: DataFrame, status: DataFrame, key: str = "message_id") -> DataFrame:
    """Messages whose latest status is not ``ok``: only the failed subset is delivered again."""
    failed = status.where(F.col("status") != "ok").select(key)
    return messages.join(failed, key, "left_semi")


def drop_redeliveries(stream: DataFrame, key: str = "message_id", ts: str = "ts",
                      delay: str = "10 minutes") -> DataFrame:
    """De-duplicate redelivered messages that carry a send time (state kept for ``delay``)."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def run_dead_letter_stream(spark: SparkSession, deliveries: DataFrame, out: str, checkpoint: str,
                           max_receives: int = 5):
    """Count failed receives per message id in streaming state (update mode); a message whose
    failures reach ``max_receives`` is marked dead-lettered. The per-batch updates are written
    to ``out/batch=<id>`` and the latest count per message wins."""
    decoded = decode_job_messages(deliveries)
    counts = (decoded.groupBy("message_id")
              .agg(F.count(F.lit(1)).alias("receives"),
                   F.sum(F.when(~F.col("is_valid"), 1).otherwise(0)).alias("failures")))

    def run(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("dead_lettered", F.col("failures") >= max_receives)
         .withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").parquet(posixpath.join(out, f"batch={batch_id}")))

    h = (counts.writeStream.outputMode("update").foreachBatch(run)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    h.awaitTermination()
    return h


def latest_status(spark: SparkSession, out: str, key: str = "message_id") -> DataFrame:
    """Latest row per key across the per-batch outputs."""
    df = spark.read.parquet(out)
    return (df.groupBy(key).agg(F.max_by(F.struct(*[c for c in df.columns if c not in (key, "batch")]),
                                         F.col("batch")).alias("r"))
            .select(key, "r.*"))
