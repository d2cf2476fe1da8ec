"""Places that every executor sees: the checkpoint folder of the session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a session on one machine (tests) gets a folder of its own; on a cluster that is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="tideline-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _file(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file(spark, path)
    return fs.exists(p)


def found(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, by name, in one listing."""
    fs, p = _file(spark, pattern)
    return sorted(str(x.getPath()) for x in fs.globStatus(p) or [])


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    fs, p = _file(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _file(spark, path)
    fs.mkdirs(p)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder to a path that must not exist; its parents are made."""
    fs, p = _file(spark, target)
    if fs.exists(p):
        raise FileExistsError(target)
    fs.mkdirs(p.getParent())
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(source), p):
        raise OSError(f"{source} could not become {target}")


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files in a folder."""
    fs, p = _file(spark, path)
    return fs.getContentSummary(p).getLength()


def is_file(spark: SparkSession, path: str) -> bool:
    fs, p = _file(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isFile()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _file(spark, path)
    fs.delete(p, True)
