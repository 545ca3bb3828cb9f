"""Spark session construction and cluster-safe scratch settings."""

from __future__ import annotations

import hashlib
import io
import os
import uuid
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # One BLAS thread per Python worker: Spark already runs one worker per core.
    "spark.executorEnv.OMP_NUM_THREADS": "1",
    "spark.executorEnv.OPENBLAS_NUM_THREADS": "1",
    "spark.executorEnv.MKL_NUM_THREADS": "1",
    # Reliable checkpoints (dense codes, sweep inputs, evaluation counts)
    # are removed from the shared folder once nothing references them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Vectors go to the Python workers in batches of a few MB (bound_batches).
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 * 1024 * 1024),
    # Parquet splits sized so one task's input fits comfortably in memory.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "boutique", extra: dict | None = None) -> SparkSession:
    """Create (or get) a session with the engine's defaults.

    On a cluster ``master`` is left to spark-submit; locally it defaults to
    ``local[$BENCH_CPUS or 8]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is None and not os.environ.get("SPARK_MASTER"):
        master = f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most the default's bytes in a session built elsewhere. Spark's
    own bound (64 MB) is held several times over: per task in the JVM, outside its heap, and in the
    Python worker."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    held = spark.conf.get(key, None)
    if held is None or size(held) > int(DEFAULT_CONF[key]):
        spark.conf.set(key, DEFAULT_CONF[key])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure reliable checkpoints have a home.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that is
    used as is. Only a local session without one gets a fresh scratch
    folder, since a machine-local folder is useless to a real cluster.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster needs a shared folder for checkpoints")
    # One machine runs everything, so its working folder is shared by all.
    sc.setCheckpointDir(os.path.join(os.getcwd(), "spark-warehouse", "checkpoints"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name below the cluster's shared checkpoint folder; what is
    written there is deleted when the application ends."""
    sc = spark.sparkContext
    base = sc._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark), f"scratch-{sc.applicationId}")
    fs = base.getFileSystem(sc._jsc.hadoopConfiguration())
    if fs.mkdirs(base):  # only a folder that exists is deleted at the end
        fs.deleteOnExit(base)
    return f"{base.toString()}/{label}-{uuid.uuid4().hex}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors (once per application), so that
    functions run there wherever the driver was started. The archive is
    written through Hadoop's file system to the shared checkpoint folder."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.relpath(full, os.path.dirname(root)))
    data = buffer.getvalue()
    name = f"{os.path.basename(root)}_{hashlib.sha256(data).hexdigest()[:12]}.zip"
    path = sc._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark), name)
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
    out.write(bytearray(data))
    out.close()
    sc.addPyFile(path.toString())
    _SHIPPED.add(sc.applicationId)
