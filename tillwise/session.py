"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Skewed joins are split at run time and small shuffle partitions are merged, so the
# partition count only has to be large enough for the biggest stage.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def shuffle_partitions_for(input_bytes: int, cores: int, target_bytes: int = 128 << 20) -> int:
    """Partition count that keeps a full shuffle of the input near ``target_bytes`` per task."""
    return max(cores, -(-input_bytes // target_bytes))


@contextmanager
def shuffle_tasks(spark: SparkSession, tasks: int) -> Iterator[None]:
    """Shuffles planned inside have so many partitions at least, before small ones are merged: a
    fixed number of partitions that grow with the input would spill from some size on."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(int(before), tasks)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what runs inside are deleted as each execution ends; otherwise they stay
    until the driver happens to collect its garbage, and those of all steps add up."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def build_session(app_name: str = "tillwise", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; on a cluster it needs ``spark.checkpoint.dir``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    Only a local session (tests, one machine) without that setting gets a folder of its own; a
    cluster without one is an error, as its executors share no other folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    own = getattr(context, "_tillwise_shared_dir", None)
    if own is None:
        own = tempfile.mkdtemp(prefix="run-tillwise-")
        context.setCheckpointDir(own)
        context._tillwise_shared_dir = own
    return own


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme that Spark resolves it to, so that tasks open the same place."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def run_dir(spark: SparkSession, *parts: str) -> str:
    """A path below the shared folder that belongs to this application only and goes with it: the
    driver's file system deletes the application's folder when it ends."""
    context = spark.sparkContext
    own = f"{shared_dir(spark)}/tillwise/{context.applicationId}"
    if getattr(context, "_tillwise_own_dir", None) != own:
        place = spark._jvm.org.apache.hadoop.fs.Path(own)
        store = place.getFileSystem(spark._jsc.hadoopConfiguration())
        store.mkdirs(place)  # only a folder that exists can be marked
        store.deleteOnExit(place)
        context._tillwise_own_dir = own
    return "/".join([own, *parts])


def cut_lineage(df):
    """Checkpoint into the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
