"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import gc
import re
import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Settings that the operators are written for. The adaptive ones let Spark
# broadcast a side only after its real size is known, and split skewed
# partitions of the joins that are not salted by hand.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

#: Spark's setting by which the shuffle files of a query go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "tablewright", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = SETTINGS | {k.replace("__", "."): str(v) for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def hadoop_path(spark: SparkSession, path: str):
    """Return ``(file system, path)`` of Hadoop for a folder or file."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage, as the cluster names it.

    Only where the driver and the executors are one process may it be unset;
    then it is a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tablewright-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


_left_behind: set[str] = set()
_recorders: list[list[str]] = []


@contextmanager
def recorded():
    """A list of the scratch paths that are made inside the block."""
    paths: list[str] = []
    _recorders.append(paths)
    try:
        yield paths
    finally:
        _recorders[:] = [r for r in _recorders if r is not paths]


def drop(spark: SparkSession, paths: list[str]) -> None:
    """Remove scratch paths that no frame reads any more."""
    for path in paths:
        fs, target = hadoop_path(spark, path)
        fs.delete(target, True)


def release(spark: SparkSession) -> None:
    """Let the driver give back what no frame refers to any more.

    Spark frees broadcasts and the state of shuffles only when the driver's JVM collects
    its garbage; under a small heap that would be late, and the heap would grow until then.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    spark.sparkContext._jvm.System.gc()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in this application's part of the shared folder, which goes when the driver ends."""
    own = f"{scratch_dir(spark)}/tablewright-{spark.sparkContext.applicationId}"
    if own not in _left_behind:
        _left_behind.add(own)
        atexit.register(_remove, *hadoop_path(spark, own))
    path = f"{own}/{name}-{uuid.uuid4().hex[:12]}"
    for paths in _recorders:
        paths.append(path)
    return path


def _remove(fs, path) -> None:
    try:
        fs.delete(path, True)
    except Exception:  # the JVM is gone already; the folder is named after the application
        pass


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage like a checkpoint, computes the frame once, keeps it
    columnar, and survives the loss of executors. Spark removes the shuffle files
    of the write when it is done, not only when the driver collects its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
