"""File-system questions answered through Hadoop's FileSystem, so local
paths and cluster paths (hdfs://, s3a://, ...) behave the same."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of its file system."""
    fs, p = _fs_path(spark, path)
    return fs.makeQualified(p).toString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def is_dir(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p) and fs.getFileStatus(p).isDirectory())


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs_path(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p))


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files that a path, folder or glob stands for (one folder level)."""
    fs, p = _fs_path(spark, path)
    found = fs.globStatus(p)
    out = []
    for st in found or []:
        out += [x.getPath().getName() for x in fs.listStatus(st.getPath())] if st.isDirectory() else [st.getPath().getName()]
    return sorted(out)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that the caller has written."""
    fs, p = _fs_path(spark, path)
    fs.delete(p, True)
