"""Driver-side path checks through Hadoop's file systems, so lake paths may be local, HDFS or object storage."""

from __future__ import annotations

from pyspark.sql import SparkSession


def glob(spark: SparkSession, pattern: str) -> list[str]:
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [] if found is None else sorted(status.getPath().toString() for status in found)


def exists(spark: SparkSession, path: str) -> bool:
    return bool(glob(spark, path))


def touch(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True).close()


def move(spark: SparkSession, source: str, target: str) -> None:
    """A folder under a new name, where nothing may be yet: one step on HDFS and local disks."""
    old, new = spark._jvm.org.apache.hadoop.fs.Path(source), spark._jvm.org.apache.hadoop.fs.Path(target)
    files = new.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(new.getParent())
    if files.exists(new) or not files.rename(old, new):
        raise OSError(f"cannot move {source} to {target}")


def make_dir(spark: SparkSession, path: str) -> str:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)
    return path
