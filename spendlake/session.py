"""Session construction and the few settings every job relies on.

On a cluster the session is normally created by the platform; ``configure`` only fills in
settings that are unset, so cluster-wide values (checkpoint dir, partition counts) win.
"""
from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings applied when a session is built here (tests, bench). Values chosen for scale:
# AQE re-plans joins at runtime from measured sizes (broadcast only below the threshold,
# sort-merge beyond it), splits skewed shuffle partitions and coalesces small ones.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # checkpoint files of DataFrames that are no longer referenced are removed by Spark
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "spendlake",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Checkpoint folder plus the package shipped to the Python workers (once per context)."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make ``spendlake`` importable in Python workers (pandas UDFs pickle module references).

    The package is zipped on the driver and added with ``addPyFile``, which distributes it
    to every executor; done once per SparkContext.
    """
    sc = spark.sparkContext
    if getattr(sc, "_spendlake_shipped", False):
        return
    import shutil
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="spendlake-pkg-")
    archive = shutil.make_archive(os.path.join(out, "spendlake"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir="spendlake")
    sc.addPyFile(archive)
    sc._spendlake_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names it; only a local session without one (tests) gets a fresh scratch folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir is not set; on {master} it must name a shared folder")
        d = tempfile.mkdtemp(prefix="spendlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


@contextmanager
def shuffles_removed(spark: SparkSession):
    """What is written in here leaves no shuffle files behind: its readers have the written table. (Otherwise they
    stay until the driver happens to collect garbage, so that the disk holds the shuffles of a whole session.)"""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder (compressed Parquet) and read back: for frames that
    several steps read and that are dear to build again."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more, so that its disk is free before the session ends."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its filesystem (any Hadoop-supported scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def make_folder(spark: SparkSession, path: str) -> None:
    """Make ``path`` on its filesystem where it is missing."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)
