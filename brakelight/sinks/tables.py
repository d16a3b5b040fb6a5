"""Sinks: clean zone, job manifest, append with count check, keyed upsert into
hash buckets, eval report CSV, quarantine.

Files are written with Spark's commit protocol (a failed job leaves no
partial output); re-running a batch (at-least-once delivery) gives the
same table.
"""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import UPSERT_UPDATE_COLUMNS
from ..session import scratch_path


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def write_clean_zone(df: DataFrame, zone: str, job_id: str, file_name: str = "data.parquet") -> int:
    """Write under ``zone/job_id=<id>/`` (partitioned by job) and return the row count,
    measured by an ``Observation`` on the write itself (no second scan). A job that is run
    again replaces its own partition and no other."""
    obs = Observation(f"zone_{abs(hash((zone, job_id)))}")
    (df.withColumn("job_id", F.lit(job_id)).observe(obs, F.count(F.lit(1)).alias("rows"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("job_id")
     .parquet(posixpath.join(zone, file_name)))
    return int(obs.get["rows"])


def job_manifest(raw: DataFrame, clean_df: DataFrame, job_id: str, bucket: str, cleaned_key: str,
                 summary: str = "summary") -> DataFrame:
    """One manifest row per job: ``job_id, bucket, cleaned_key, rows, loaded, blank_summary``.

    Counts are Spark aggregates of the job's own data; the raw count enters as a scalar subquery."""
    loaded = raw.agg(F.count(F.lit(1)).alias("loaded")).scalar()
    out = clean_df.agg(F.count(F.lit(1)).alias("rows"),
                       F.count_if(F.coalesce(F.trim(F.col(summary)) == "", F.lit(True))).cast("long")
                       .alias("blank_summary"))
    return (out.withColumn("loaded", loaded)
            .select(F.lit(job_id).alias("job_id"), F.lit(bucket).alias("bucket"),
                    F.lit(cleaned_key).alias("cleaned_key"), "rows", "loaded", "blank_summary"))


def append_with_count_check(spark: SparkSession, target: str, batch: DataFrame) -> DataFrame:
    """Append ``batch`` by column name (missing columns null), all of it or nothing.

    The target's column list comes from its schema, so a reordered batch
    cannot shift values between columns. The rows are staged first; the staged
    files must hold as many rows as the write took in, or nothing is published.
    """
    if path_exists(spark, target):
        cur = spark.read.parquet(target)
        batch = batch.select(*[F.col(c) if c in batch.columns else F.lit(None).cast(cur.schema[c].dataType).alias(c)
                               for c in cur.columns])
    staged = scratch_path(spark, f"staged-{uuid.uuid4().hex}")
    obs = Observation(f"append_{uuid.uuid4().hex}")
    batch.observe(obs, F.count(F.lit(1)).alias("n")).write.parquet(staged)
    rows = spark.read.schema(batch.schema).parquet(staged)
    taken, found = int(obs.get["n"]), rows.count()
    if taken != found:
        raise RuntimeError(f"count check failed: {taken} rows written, {found} found; nothing was appended")
    rows.write.mode("append").parquet(target)
    fs, p = _fs(spark, staged)
    fs.delete(p, True)
    return spark.read.parquet(target)


def collapse_batch(batch: DataFrame, key: str = "cmplid", order: str = "seq",
                   update_cols=UPSERT_UPDATE_COLUMNS) -> DataFrame:
    """One row per key: first row's columns, last row's ``update_cols`` (map-side partial aggregation)."""
    upd = [c for c in update_cols if c in batch.columns]
    others = [c for c in batch.columns if c not in upd and c != key]
    agg = batch.groupBy(key).agg(F.min_by(F.struct(*others), F.col(order)).alias("_first"),
                                 F.max_by(F.struct(*upd), F.col(order)).alias("_last"))
    return agg.select(key, *[F.col("_first." + c).alias(c) for c in others],
                      *[F.col("_last." + c).alias(c) for c in upd])


def upsert(snapshot: DataFrame, batch: DataFrame, key: str = "cmplid", order: str = "seq",
           update_cols=UPSERT_UPDATE_COLUMNS) -> DataFrame:
    """Insert new keys; for existing keys replace only ``update_cols``.

    Full outer null-safe equi-join on the (unique) key of the snapshot and the collapsed
    batch -- both sides have at most one row per key, so no key is hot. The same batch
    applied twice gives what it gives once.
    """
    b = collapse_batch(batch, key, order, update_cols)
    upd = [c for c in update_cols if c in b.columns]
    ss = snapshot.withColumn("_in_snapshot", F.lit(True)).alias("s")
    bb = b.withColumn("_in_batch", F.lit(True)).alias("b")
    j = ss.join(bb, F.col(f"s.{key}").eqNullSafe(F.col(f"b.{key}")), "full_outer")
    in_s, in_b = F.col("s._in_snapshot").isNotNull(), F.col("b._in_batch").isNotNull()
    out = []
    for c in snapshot.columns:
        if c in upd:
            out.append(F.when(in_b, F.col(f"b.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
        elif c in b.columns:
            out.append(F.when(in_s, F.col(f"s.{c}")).otherwise(F.col(f"b.{c}")).alias(c))
        else:
            out.append(F.col(f"s.{c}").alias(c))
    return j.select(*out)


class KeyedTable:
    """A Parquet table of unique keys in hash buckets of the key (folders ``_bucket=<n>``).

    ``apply`` upserts a batch by rewriting only the buckets that the batch touches. The new buckets are
    written to the shared scratch folder first and then replace the old ones (dynamic partition overwrite).
    Every batch is applied, whatever its number: a batch that is delivered again, also after a failure half
    way, leaves the table as one delivery does.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "cmplid", order: str = "seq",
                 update_cols=UPSERT_UPDATE_COLUMNS, buckets: int = 64):
        self.spark, self.path, self.key, self.order = spark, path, key, order
        self.update_cols, self.buckets = update_cols, buckets

    def _with_bucket(self, df: DataFrame) -> DataFrame:
        return df.withColumn("_bucket", F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"))

    def _publish(self, df: DataFrame) -> None:
        staged = scratch_path(self.spark, f"staged-{uuid.uuid4().hex}")
        self._with_bucket(df).write.parquet(staged)
        # rebalancing gives a bucket about one file and splits large ones
        (self.spark.read.parquet(staged).hint("rebalance", "_bucket").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(self.path))
        fs, p = _fs(self.spark, staged)
        fs.delete(p, True)

    def current(self) -> DataFrame | None:
        if not list_dirs(self.spark, self.path):
            return None
        return self.spark.read.parquet(self.path).drop("_bucket")

    def init(self, df: DataFrame) -> None:
        if self.current() is None:
            self._publish(df)

    def apply(self, batch: DataFrame) -> None:
        if self.current() is None:
            return self._publish(collapse_batch(batch, self.key, self.order, self.update_cols))
        touched = [r[0] for r in self._with_bucket(batch).select("_bucket").distinct().collect()]  # <= buckets rows
        cur = self.spark.read.parquet(self.path).where(F.col("_bucket").isin(touched)).drop("_bucket")
        rows = batch.select(*[c for c in batch.columns if c in cur.columns or c == self.order])
        self._publish(upsert(cur, rows, self.key, self.order, self.update_cols))


def write_interchange_csv(df: DataFrame, path: str, vector_cols=("embedding",)) -> None:
    """Headered CSV with vectors as ``[f,f,...]`` literals (for bulk loaders that read text)."""
    from ..functions.vectors import format_literal
    out = df.withColumns({c: format_literal(c) for c in vector_cols if c in df.columns})
    out.write.mode("errorifexists").option("header", True).option("escape", '"').csv(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict, batch_size: int = 500,
               mode: str = "append") -> None:
    """Batched insert into a database table (one transaction per partition, ``batch_size`` rows per batch).

    Vector columns must be formatted by the caller for the target type."""
    df.write.jdbc(url, table, mode=mode, properties={**properties, "batchsize": str(batch_size)})


def write_eval_report(rows: DataFrame, metrics: DataFrame, path: str, key: str = "case_id") -> DataFrame:
    """Re-attach per-case metadata by ``case_id`` (not by position) and write CSV."""
    out = metrics.join(rows, key, "left")
    out.write.mode("errorifexists").option("header", True).option("escape", '"').csv(path)
    return out.sparkSession.read.schema(out.schema).option("header", True).option("escape", '"').csv(path)
