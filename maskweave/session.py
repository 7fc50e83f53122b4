"""Session set-up and lineage cutting through the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

BATCH_BYTES = 1 << 20  # of an Arrow batch of id lists
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "maskweave", source_partitions: int | None = None) -> SparkSession:
    """A session with AQE on.  On a cluster pass nothing: master and sizes
    come from the submit configuration.  ``source_partitions`` deals the rows
    of small source files to more tasks (benchmarks on one file)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          .config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false"))
    if source_partitions:
        b = b.config("maskweave.sourcePartitions", str(source_partitions))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        b = b.config("spark.driver.memory", os.environ.get("MASKWEAVE_DRIVER_MEMORY", "8g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Everything a query needs from a session it did not create: the
    shared checkpoint folder and this package on the Python workers."""
    checkpoint_root(spark)
    ship_code(spark)
    return spark


def ship_code(spark: SparkSession) -> None:
    """Zip this package and register it with ``addPyFile`` so Python
    workers (local or on executors) import the same code; once per
    context."""
    sc = spark.sparkContext
    if getattr(sc, "_maskweave_shipped", False):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.TemporaryDirectory(prefix="maskweave-code-")
    path = os.path.join(out.name, "maskweave_code.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(path)
    sc._maskweave_shipped = out  # the folder lives as long as the context


def small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Arrow batches of the session take ``most`` bytes at most; a lower
    setting of its own stays.  A batch is held several times over on its way
    to a Python worker, so where every row is an id list its size decides on
    the executors' memory."""
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH_SETTING))
    if not 0 < now <= most:
        spark.conf.set(_BATCH_SETTING, f"{most}b")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session.  Only a local master, where the driver is the
    only executor, gets a folder of its own when the setting is unset; on a
    cluster that is an error, because executors do not share local disks.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        master = sc.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir is unset and the master is {master!r}: "
                             "name a folder that the driver and all executors share")
        root = os.environ.get("MASKWEAVE_LOCAL_CHECKPOINT") or tempfile.mkdtemp(
            prefix="maskweave-checkpoints-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/maskweave/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it
    back.  Cuts lineage, fixes non-deterministic columns (ids, draws) once,
    and survives executor loss because the files live on shared storage."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.parquet(path)
    out._maskweave_path = path
    return out


def discard(*dfs: DataFrame) -> None:
    """Deletes the files of materialised tables that nothing reads any more,
    and their entry in the catalog if they have one."""
    for df in dfs:
        known = getattr(df, "_maskweave_table", None)
        if known:
            df.sparkSession.sql(f"drop table if exists {known}")
        path = getattr(df, "_maskweave_path", None)
        if path:
            spark = df.sparkSession
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
