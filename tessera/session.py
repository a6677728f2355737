"""Spark session construction and cluster-safe scratch locations.

On a cluster the session is built by the platform; we only read its settings.
`get_session` is the convenience used by tests, the bench and the entry point.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # AQE re-plans a sort-merge join as broadcast only when the *measured* side is below this.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "tessera") -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.appName(app).master(master or f"local[{cpus}]")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions",
                             str(shuffle_partitions or int(cpus)))
    builder = builder.config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEM", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The cluster names it in ``spark.checkpoint.dir``; we only set our own when
    it is unset and the session runs in one process (tests); a cluster session without it is
    an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per context, whatever their
    working folder and installation: Spark hands the archive to every executor."""
    sc = spark.sparkContext
    if getattr(sc, "_tessera_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    at = os.path.join(tempfile.mkdtemp(prefix="tessera-"), "tessera_package")
    sc.addPyFile(shutil.make_archive(at, "zip", root, "tessera"))
    sc._tessera_shipped = True


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Shuffle files of what is run inside are removed when it ends, not when the driver happens to
    collect its garbage: for steps whose rows nothing reads again through their lineage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def cut_lineage(df):
    """Materialise an iterative state frame to the shared checkpoint folder.

    Reliable checkpoint (not localCheckpoint): survives executor loss.
    """
    ensure_checkpoint_dir(df.sparkSession)
    with shuffles_removed(df.sparkSession):
        return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder the cluster names in ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df, name: str, partition_by: tuple[str, ...] = ()):
    """``df`` as a table in the shared folder: a cut of the lineage that columns can be pruned
    from. ``forget`` deletes it."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)
    out = df.sparkSession.read.parquet(path)
    out._scratch_path = path
    return out


def forget(*tables) -> None:
    """Delete tables of ``written`` that nothing lazy reads any more."""
    for t in tables:
        path = getattr(t, "_scratch_path", None)
        if path:
            spark = t.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
