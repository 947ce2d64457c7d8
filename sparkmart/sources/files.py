"""The few calls to the session's file system that DataFrames do not cover."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def make_dir(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.mkdirs(p)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, src = _path(spark, source)
    _, dst = _path(spark, target)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"could not rename {source} to {target}")


def size(spark: SparkSession, path: str) -> int:
    """The bytes of a file, or of all files below a folder; 0 if there is none."""
    fs, p = _path(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _path(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(p)]
