"""Paths on any Hadoop file system, and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    """The path and its file system, as the JVM sees them."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    target, fs = hadoop_path(spark, path)
    return fs.makeQualified(target).toString().rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = hadoop_path(spark, path)
    return fs.exists(target)


def sub_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct sub-folders, hidden ones left out."""
    target, fs = hadoop_path(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()]
    return sorted(n for n in names if not n.startswith((".", "_")))


def files_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly in a folder, hidden ones left out; none if it is not there."""
    target, fs = hadoop_path(spark, path)
    if not fs.exists(target):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(target) if s.isFile()) if not n.startswith((".", "_")))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file as a whole: readers find all of it or none."""
    target, fs = hadoop_path(spark, path)
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    stream = hadoop_path(spark, part)[1].create(hadoop_path(spark, part)[0])
    stream.write(bytearray(text.encode()))
    stream.close()
    fs.rename(hadoop_path(spark, part)[0], target)


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.option("wholetext", True).text(path).first()[0]


def first_line(spark: SparkSession, path: str, longest: int = 1 << 16) -> bytes:
    """The first line of a file, unpacked where its name says that it is packed; a longer one is cut."""
    jvm = spark._jvm
    target, fs = hadoop_path(spark, path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(target)
    stream = fs.open(target)
    try:
        unpacked = stream if codec is None else codec.createInputStream(stream)
        line = jvm.org.apache.hadoop.io.Text()
        reader = jvm.org.apache.hadoop.util.LineReader(unpacked)
        reader.readLine(line, longest)
        return bytes(line.copyBytes())
    finally:
        stream.close()


def has_visible(spark: SparkSession, path: str) -> bool:
    """Does the folder exist and hold anything that Spark would read?"""
    target, fs = hadoop_path(spark, path)
    if not fs.exists(target):
        return False
    return any(not s.getPath().getName().startswith((".", "_")) for s in fs.listStatus(target))


def make_folder(spark: SparkSession, path: str) -> None:
    target, fs = hadoop_path(spark, path)
    fs.mkdirs(target)


def delete(spark: SparkSession, path: str) -> None:
    target, fs = hadoop_path(spark, path)
    fs.delete(target, True)


def delete_visible(spark: SparkSession, path: str) -> None:
    """Delete what Spark would read from a folder, but not the hidden entries."""
    target, fs = hadoop_path(spark, path)
    for status in fs.listStatus(target):
        if not status.getPath().getName().startswith((".", "_")):
            fs.delete(status.getPath(), True)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared area the cluster names in ``spark.checkpoint.dir``.

    A temporary folder of this machine is used only where that is unset and
    Spark runs on this machine alone.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        return tempfile.mkdtemp(prefix=f"quayside-{name}-")
    return f"{shared.rstrip('/')}/quayside-{name}-{uuid.uuid4().hex}"
