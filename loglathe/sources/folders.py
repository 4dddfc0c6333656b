"""Folders and small files on any storage that Spark reaches."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def _of(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    filesystem, target = _of(spark, path)
    return filesystem.exists(target)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names right below a folder, in order; none if there is no such folder."""
    filesystem, target = _of(spark, path)
    if not filesystem.exists(target):
        return []
    return sorted(status.getPath().getName() for status in filesystem.listStatus(target))


def contents(spark: SparkSession, path: str) -> list[list]:
    """Name, bytes and time of change of every file below a folder, in order."""
    filesystem, target = _of(spark, path)
    if not filesystem.exists(target):
        return []
    files, found = filesystem.listFiles(target, True), []
    while files.hasNext():
        status = files.next()
        found.append([status.getPath().toUri().getPath(), status.getLen(), status.getModificationTime()])
    return sorted(found)


def delete(spark: SparkSession, path: str) -> None:
    filesystem, target = _of(spark, path)
    filesystem.delete(target, True)


def move(spark: SparkSession, source: str, path: str) -> None:
    """Put a folder in the place of another one."""
    filesystem, target = _of(spark, path)
    filesystem.delete(target, True)
    filesystem.mkdirs(target.getParent())
    if not filesystem.rename(_of(spark, source)[1], target):
        raise OSError(f"cannot move {source} to {path}")


def write_json(spark: SparkSession, path: str, content: dict) -> None:
    """A whole file or none: written beside its place and then renamed."""
    filesystem, target = _of(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{target.getName()}.new")
    stream = filesystem.create(beside, True)
    stream.write(json.dumps(content).encode())
    stream.close()
    filesystem.delete(target, False)
    if not filesystem.rename(beside, target):
        raise OSError(f"cannot write {path}")


def read_json(spark: SparkSession, path: str) -> dict:
    filesystem, target = _of(spark, path)
    stream = filesystem.open(target)
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()
