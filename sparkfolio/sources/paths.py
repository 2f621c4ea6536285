"""Folders in the session's file systems, asked for by name (never by listing a tree)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder with all it holds; False where there is none."""
    p, fs = _path(spark, path)
    return fs.delete(p, True)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Remove a folder when the driver's JVM ends."""
    p, fs = _path(spark, path)
    fs.mkdirs(p)
    fs.deleteOnExit(p)


def folders(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, time of last change in ms) of the folders directly under ``path``."""
    p, fs = _path(spark, path)
    return [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []


def partition_folder(spark: SparkSession, column: str, value: str) -> str:
    """``column=value`` as Spark's writers name the folder of a partition value."""
    return f"{column}={spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)}"
