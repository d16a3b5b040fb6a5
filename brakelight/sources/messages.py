"""Job messages: decode, and claim-check reads of the files they name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import JOB_MESSAGE


def decode_job_messages(df: DataFrame, body: str = "body") -> DataFrame:
    """``{jobId, bucket, resultKey}`` from a JSON body; malformed bodies get ``is_valid = false``."""
    schema = T.StructType(JOB_MESSAGE.fields + [T.StructField("_corrupt_record", T.StringType())])
    p = F.from_json(F.col(body), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    ok = p.isNotNull() & p["_corrupt_record"].isNull() & F.json_object_keys(F.col(body)).isNotNull()
    return df.withColumns({
        "is_valid": F.coalesce(ok, F.lit(False)),
        "job_id": F.when(ok, p["jobId"]),
        "bucket": F.when(ok, p["bucket"]),
        "result_key": F.when(ok, p["resultKey"]),
    })


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def claim_check_read(spark: SparkSession, decoded: DataFrame, resolve, reader) -> DataFrame | None:
    """Read every distinct file named by a batch of decoded messages in one scan.

    Only the distinct keys of the batch (bounded by the batch size) reach the
    driver to build the path list; rows are matched back to their key by an
    equi-join on the parent folder, on the executors. ``resolve(key)`` maps a
    message key to a folder; ``reader(spark, paths)`` returns rows with a
    ``_file`` column (``_metadata.file_path``).
    """
    keys = [r["result_key"] for r in decoded.where("is_valid").select("result_key").distinct().collect()]
    found = [(k, resolve(k)) for k in sorted(keys) if _exists(spark, resolve(k))]
    if not found:
        return None
    rows = reader(spark, [p for _, p in found])
    no_scheme = lambda c: F.regexp_replace(c, r"^[A-Za-z][A-Za-z0-9+.-]*:", "")
    rows = rows.withColumn("_dir", no_scheme(F.regexp_replace(F.col("_file"), r"/[^/]*$", ""))).drop("_file")
    key_dirs = spark.createDataFrame([(k, p.rstrip("/")) for k, p in found], "result_key string, _dir string") \
        .withColumn("_dir", no_scheme(F.col("_dir")))
    jobs = (decoded.where("is_valid").groupBy("result_key")
            .agg(F.count(F.lit(1)).alias("n_messages"), F.min("job_id").alias("first_job_id")))
    return rows.join(key_dirs, "_dir").drop("_dir").join(jobs, "result_key")
