"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "brakelight") -> SparkSession:
    """Build (or reuse) a session with AQE on, UI off and UTC time.

    ``master`` defaults to ``local[$BENCH_CPUS or 8]`` only when no master is
    configured by the launcher (spark-submit sets it on a cluster).
    """
    builder = SparkSession.builder.appName(app_name)
    if master is None and "SPARK_MASTER" not in os.environ and not os.environ.get("PYSPARK_SUBMIT_ARGS"):
        master = f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    if master:
        builder = builder.master(master)
    parts = shuffle_partitions or int(os.environ.get("BRAKELIGHT_SHUFFLE_PARTITIONS", "8"))
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BRAKELIGHT_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (``addPyFile``).

    Arrow-batched operators (``mapInPandas``, ``applyInPandas``) pickle
    functions defined here; on a cluster the executors need the package, and
    locally the workers may start in another folder. The zip goes to the
    shared checkpoint folder; done once per SparkContext.
    """
    sc = spark.sparkContext
    if getattr(sc, "_brakelight_shipped", False):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(ensure_checkpoint_dir(spark), "pyfiles")
    if out.startswith("file:"):
        out = out[len("file:"):]
    if "://" in out:
        # checkpoint folder on a distributed file system: the job is launched with
        # ``spark-submit --py-files brakelight.zip``, which ships the package already
        sc._brakelight_shipped = True
        return
    os.makedirs(out, exist_ok=True)
    zpath = os.path.join(out, f"brakelight-{os.getpid()}-{id(sc)}.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(zpath)
    sc._brakelight_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be configured (a shared file system); a
    machine-local folder is only created when the master is local, as in tests.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="brakelight-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, *parts)


def stored(df, label: str):
    """Write ``df`` once below the shared checkpoint folder and read it back: its work is done once however often it is read."""
    path = scratch_path(df.sparkSession, f"{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


# A parquet row group is the unit of a split; writers roll row groups at about this size.
ROW_GROUP_BYTES = 128 * 1024 * 1024


def ensure_parallelism(df, min_partitions: int | None = None):
    """Spread CPU-heavy per-row work over the cluster when the input has too few splits.

    Decided from metadata only, never by running the plan (building ``df.rdd``
    of a plan with a shuffle would execute that shuffle under AQE): an input of
    at least as many files as cores already has a split per file and this is a
    no-op; otherwise the files' sizes give the splits (one per row group,
    about ``ROW_GROUP_BYTES``), and a small input is dealt round-robin over
    ``min_partitions`` (default: the cluster's cores) partitions.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    want = min_partitions or sc.defaultParallelism
    files = df.inputFiles()
    if not files or len(files) >= want:
        return df
    jvm = sc._jvm
    conf = sc._jsc.hadoopConfiguration()
    splits = 0
    for f in files:
        path = jvm.org.apache.hadoop.fs.Path(f)
        size = path.getFileSystem(conf).getFileStatus(path).getLen()
        splits += max(1, -(-size // ROW_GROUP_BYTES))
        if splits >= want:
            return df
    return df.repartition(want)
