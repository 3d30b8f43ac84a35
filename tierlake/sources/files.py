"""Folders and small files of a lake, through the file system that holds them."""

from __future__ import annotations

import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Schemes of file systems where renaming a folder only changes its name.
RENAMING = frozenset({"file", "hdfs", "webhdfs"})


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def qualified(spark: SparkSession, path: str) -> str:
    """The path as Spark's file sources spell it, without a slash at its end."""
    files, folder = _file_system(spark, path)
    return files.makeQualified(folder).toString().rstrip("/")


def renames_folders(spark: SparkSession, path: str) -> bool:
    """Whether moving a folder here is known to change its name only; elsewhere it may copy, or stop half way."""
    return _file_system(spark, path)[0].getUri().getScheme() in RENAMING


def exists(spark: SparkSession, path: str) -> bool:
    files, found = _file_system(spark, path)
    return files.exists(found)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds, in order; a missing folder holds nothing."""
    files, folder = _file_system(spark, path)
    if not files.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(folder))


def age(spark: SparkSession, path: str) -> float:
    """Seconds since a file or folder was last changed; 0 if it is gone."""
    files, found = _file_system(spark, path)
    try:
        return max(0.0, time.time() - files.getFileStatus(found).getModificationTime() / 1000)
    except Py4JJavaError:
        return 0.0


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all it holds; a missing one is fine."""
    files, folder = _file_system(spark, path)
    files.delete(folder, True)


def create(spark: SparkSession, path: str, content: str) -> bool:
    """Make a small file that isn't there; False if it is. Of several that try at once, one succeeds."""
    files, target = _file_system(spark, path)
    files.mkdirs(target.getParent())
    local = files.getUri().getScheme() == "file"
    if local and not spark._jvm.java.io.File(target.toUri().getPath()).createNewFile():
        return False
    try:
        out = files.create(target, local)
    except Py4JJavaError as error:
        if files.exists(target):
            return False
        raise OSError(f"{path} could not be made") from error
    out.write(content.encode("utf8"))
    out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's content; empty if it is gone."""
    files, source = _file_system(spark, path)
    try:
        stream = files.open(source)
        try:
            return bytes(stream.readAllBytes()).decode("utf8")
        finally:
            stream.close()
    except Py4JJavaError:
        return ""


def move(spark: SparkSession, source: str, target: str) -> None:
    """Move a file or folder to a path that must be free."""
    files, old = _file_system(spark, source)
    new = spark._jvm.org.apache.hadoop.fs.Path(target)
    files.mkdirs(new.getParent())
    if files.exists(new):
        raise OSError(f"{target} is there already")
    try:
        done = files.rename(old, new)
    except Py4JJavaError as error:
        raise OSError(f"{source} could not be moved to {target}") from error
    if not done:
        raise OSError(f"{source} could not be moved to {target}")
