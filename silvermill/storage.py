"""The few file-system calls Spark's readers and writers do not cover, through Spark's own Hadoop client."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme and store that Spark takes for it, also where it names none."""
    fs, target = _open(spark, path)
    return str(target.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString())


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def make_until_exit(spark: SparkSession, path: str) -> str:
    """Create a folder that is deleted when the driver's JVM ends."""
    fs, target = _open(spark, path)
    fs.mkdirs(target)
    fs.deleteOnExit(target)
    return path


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    fs, target = _open(spark, path)
    return fs.getContentSummary(target).getLength()


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Move a file or folder; the parent of ``to`` is created."""
    fs, target = _open(spark, path)
    _, end = _open(spark, to)
    fs.mkdirs(end.getParent())
    if not fs.rename(target, end):
        raise OSError(f"could not move {path} to {to}")


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Matching paths, sorted; none when the folder is missing."""
    fs, target = _open(spark, pattern)
    return sorted(str(s.getPath().toString()) for s in fs.globStatus(target) or [])


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _open(spark, path)
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; fails when the path is already taken, also by a writer at the same time.
    Until it is closed a reader may see only part of it."""
    fs, target = _open(spark, path)
    try:
        stream = fs.create(target, False)
    except Py4JJavaError as problem:
        if fs.exists(target):
            raise FileExistsError(f"{path} was written by another job; rerun on the new state.") from problem
        raise
    stream.write(bytearray(text.encode()))
    stream.close()
