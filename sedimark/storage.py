"""Intermediate tables in the folder all executors share.

An operator that has to cut its lineage writes a Parquet table below the
cluster's ``spark.checkpoint.dir`` and reads it back.  Compared with
``Dataset.checkpoint()`` the result is computed once, is compressed and column
pruned, and survives the loss of any executor.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_folder: dict[str, str] = {}
_written: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only under a local master without one."""
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _own_folder:
        _own_folder[app] = "file://" + tempfile.mkdtemp(prefix="sedimark-")
    return _own_folder[app]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the table read back from there."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tables/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession | None = None) -> None:
    """Delete the intermediate tables written so far; DataFrames built on them must not be used afterwards."""
    for session, path in list(_written):
        if spark is not None and session is not spark:
            continue
        try:
            context = session.sparkContext
            target = context._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # noqa: BLE001 - the session may be gone; its folder goes with it
            pass
        _written.remove((session, path))


atexit.register(release)


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file of any file system Spark knows: a receipt, a manifest, a configuration."""
    fs, target = _file_system(spark, path)
    stream = fs.open(target)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that readers find all of it or nothing: to a draft, flushed to the disks, which then takes its name."""
    fs, target = _file_system(spark, path)
    fs.mkdirs(target.getParent())
    draft = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.draft")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
        stream.hsync()
    finally:
        stream.close()
    if fs.exists(target):
        fs.delete(target, False)
    if not fs.rename(draft, target):
        fs.delete(draft, False)
        raise OSError(f"cannot publish {path}")


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, old = _file_system(spark, source)
    new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"cannot move {source} to {target}")


def publish(spark: SparkSession, staging: str, target: str, check=None) -> None:
    """Put a staged folder in the place of ``target``: all of it, or what was there before.

    ``check`` is called with the path of the new folder once it is in place; if it raises, the old one comes back.
    """
    old = f"{target}.{uuid.uuid4().hex}.old"
    had = exists(spark, target)
    if had:
        move(spark, target, old)
    try:
        move(spark, staging, target)
        if check is not None:
            check(target)
    except Exception:
        remove(spark, target)
        if had:
            move(spark, old, target)
        raise
    if had:
        remove(spark, old)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the Parquet tables of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
