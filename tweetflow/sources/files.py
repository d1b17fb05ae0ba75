"""Paths on whatever file system Spark writes to (never the driver's disk)."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tweetflow.session import with_scan_tasks


def _path_and_fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _path_and_fs(spark, path)
    return fs.exists(hadoop_path)


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a directory tree; False where there was none."""
    hadoop_path, fs = _path_and_fs(spark, path)
    return fs.delete(hadoop_path, True)


class AlreadyPublished(FileExistsError):
    """Something else has been published under the name."""


def publish(spark: SparkSession, draft: str, path: str) -> None:
    """Give a directory that has been written its name, in one step.

    A name is given once; the draft of a second one is removed.
    """
    source, fs = _path_and_fs(spark, draft)
    target, _ = _path_and_fs(spark, path)
    # A rename onto a directory that exists would move the draft into it.
    if fs.exists(target) or not fs.rename(source, target):
        fs.delete(source, True)
        raise AlreadyPublished(path)


def move_into(spark: SparkSession, path: str, directory: str, name: str) -> None:
    """Move a file into a directory under a new name; nothing where it is there already."""
    source, fs = _path_and_fs(spark, path)
    target, _ = _path_and_fs(spark, f"{directory}/{name}")
    fs.mkdirs(target.getParent())
    if not fs.exists(target) and not fs.rename(source, target):
        raise OSError(f"{path} could not be moved to {target}")


def hand_into(spark: SparkSession, path: str, directory: str, name: str) -> None:
    """Move a file into a directory as if it had been written now."""
    source, fs = _path_and_fs(spark, path)
    now = spark._jvm.java.lang.System.currentTimeMillis()
    fs.setTimes(source, now, -1)
    move_into(spark, path, directory, name)


def copy_into(spark: SparkSession, paths: list[str], directory: str) -> str:
    """Copy files into a new directory."""
    target, fs = _path_and_fs(spark, directory)
    fs.mkdirs(target)
    for path in paths:
        source, source_fs = _path_and_fs(spark, path)
        spark._jvm.org.apache.hadoop.fs.FileUtil.copy(
            source_fs, source, fs, target, False, spark._jsc.hadoopConfiguration()
        )
    return directory


def make_dir(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _path_and_fs(spark, path)
    fs.mkdirs(hadoop_path)


def make_scratch(spark: SparkSession, path: str) -> str:
    """Make a directory that is removed when the driver's JVM ends."""
    hadoop_path, fs = _path_and_fs(spark, path)
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)  # does nothing for a path that does not exist
    return path


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a directory; empty where there is none."""
    hadoop_path, fs = _path_and_fs(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return [status.getPath().getName() for status in fs.listStatus(hadoop_path)]


def ends_with(path: Column, *suffixes: str) -> Column:
    """Whether a path ends with any of the suffixes."""
    return reduce(or_, (path.endswith(suffix) for suffix in suffixes))


def list_files(spark: SparkSession, path: str, *suffixes: str) -> DataFrame:
    """``(path, modificationTime, length)`` of the files; contents are not read.

    Of a table written by a stream only committed files are listed. Scan tasks
    are sized by the bytes they would read; as nothing is read here, the files
    are shared out over about one task per core instead.
    """
    cores = spark.sparkContext.defaultParallelism
    listed = with_scan_tasks(spark, 1 << 60, cores).read.format("binaryFile").load(path)
    return listed.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_modification_time").alias("modificationTime"),
        F.col("_metadata.file_size").alias("length"),
    ).filter(ends_with(F.col("path"), *suffixes))


def file_sizes(spark: SparkSession, path: str, *suffixes: str) -> DataFrame:
    """``(n_files, n_bytes)`` of a directory, one row."""
    return list_files(spark, path, *suffixes).agg(
        F.count("*").alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("n_bytes")
    )
