"""Session settings the operators assume, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import threading
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Whether ``base64()`` breaks its output into lines.
CHUNKED_BASE64 = "spark.sql.chunkBase64String.enabled"

# Settings every job in this package is written for. Dynamic partition
# overwrite is what makes the partition upsert safe: a static overwrite of the
# table root would silently drop partitions the update does not touch.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",  # operators on long texts set less
    CHUNKED_BASE64: "false",
    # The JVM never compiles methods of more than 8,000 bytes. The typing of the
    # staged rows makes larger ones unless Spark generates code by operator there.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A job's shuffle files go when it ends; else they lie on the disks until the
    # driver collects garbage, beside those of the jobs that follow. (A frame that
    # is executed a second time makes them again.)
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "kassa",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with ``RECOMMENDED_CONF`` applied.

    ``master`` is only set when given: on a cluster the launcher decides it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(RECOMMENDED_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if spark.conf.isModifiable(k):  # the rest is fixed once a session runs
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment has to set it (a shared file system that every
    executor can reach); without it this raises. Only a local master, where
    driver and executors are one process, gets a scratch folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on master {master!r}")
        configured = tempfile.mkdtemp(prefix="kassa-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if not spark.sparkContext.getCheckpointDir():  # each call makes a folder
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def run_folder(spark: SparkSession) -> str:
    """The application's own folder in the checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), f"run-{spark.sparkContext.applicationId}")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the run folder for materialised tables."""
    return os.path.join(run_folder(spark), f"{name}-{os.urandom(6).hex()}")


def cleanup(spark: SparkSession) -> None:
    """Delete the run folder, once the results that read it have been used."""
    delete(spark, run_folder(spark))


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """``key`` set to ``value`` for the jobs that run inside the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


#: Output files that a task keeps open, one for each partition value, instead of
#: sorting its rows by that value first.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"

_made = threading.local()


@contextmanager
def short_lived():
    """The scratch tables that the block's own thread writes are deleted at its
    end. Yields their frames; the block takes out those that stay."""
    outer, frames = getattr(_made, "frames", None), []
    _made.frames = frames
    try:
        yield frames
    finally:
        _made.frames = outer
        for frame in frames:
            discard(frame)


def materialize(df, name: str, compression: str | None = None, by: str | None = None):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: cuts the lineage (a lost executor recomputes from the written files,
    not from the sources) and stops the optimizer from re-evaluating costly
    expressions that a later filter would otherwise be pushed through.
    ``compression``: a Parquet codec other than the session's, for wide texts.
    ``by``: a column of few values, each of which gets a folder."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.mode("overwrite")
    writer = writer.option("compression", compression) if compression else writer
    if by:
        with setting(df.sparkSession, OPEN_FILES, "16"):
            writer.partitionBy(by).parquet(path)
    else:
        writer.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path  # for ``discard``
    if getattr(_made, "frames", None) is not None:
        _made.frames.append(out)
    return out


def discard(df) -> None:
    """Delete the folder behind a frame that ``materialize`` returned, once
    nothing reads it any more."""
    delete(df.sparkSession, df.scratch)


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bytes_on_disk(spark: SparkSession, folder: str) -> int:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
