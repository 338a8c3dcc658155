"""Small-file helpers on Spark's Hadoop file system, so paths work on any storage Spark can reach.

Only names and small text files pass through here; table rows never do.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    file_system, hadoop_path = _resolve(spark, path)
    return file_system.exists(hadoop_path)


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, sorted by name."""
    file_system, hadoop_path = _resolve(spark, pattern)
    found = file_system.globStatus(hadoop_path)
    return sorted(status.getPath().toString() for status in found) if found else []


def delete(spark: SparkSession, path: str) -> None:
    file_system, hadoop_path = _resolve(spark, path)
    file_system.delete(hadoop_path, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder where there is none; readers that list folders see it as a whole. A move that
    another process has made meanwhile is as good."""
    file_system, hadoop_path = _resolve(spark, source)
    _, place = _resolve(spark, target)
    file_system.mkdirs(place.getParent())
    try:
        moved = file_system.rename(hadoop_path, place)
    except Py4JJavaError:
        moved = False
    if not moved and not (file_system.exists(place) and not file_system.exists(hadoop_path)):
        raise OSError(f"{source} can't be moved to {target}")


def rename(spark: SparkSession, path: str, name: str) -> None:
    """Another name for a file in its folder."""
    file_system, hadoop_path = _resolve(spark, path)
    _, place = _resolve(spark, f"{path.rsplit('/', 1)[0]}/{name}")
    if not file_system.rename(hadoop_path, place):
        raise OSError(f"{path} can't be renamed")


def make_folder(spark: SparkSession, path: str) -> None:
    file_system, hadoop_path = _resolve(spark, path)
    file_system.mkdirs(hadoop_path)


def read_json(spark: SparkSession, path: str):
    file_system, hadoop_path = _resolve(spark, path)
    stream = file_system.open(hadoop_path)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
    finally:
        stream.close()


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file; false if there is one already."""
    file_system, hadoop_path = _resolve(spark, path)
    try:
        file_system.create(hadoop_path, False).close()
    except Py4JJavaError:
        if not file_system.exists(hadoop_path):
            raise
        return False
    return True


def publish_json(spark: SparkSession, path: str, value) -> bool:
    """Write a file that must be new, in one step; false if there is one already, which stays."""
    _, target = _resolve(spark, path)
    staged = _staged_json(spark, path, value)
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri(), spark._jsparkSession.sessionState().newHadoopConf()
    )
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(staged, target, options)
    except Py4JJavaError:
        file_system, _ = _resolve(spark, path)
        if not file_system.exists(target):
            raise
        file_system.delete(staged, False)
        return False
    return True


def _staged_json(spark: SparkSession, path: str, value):
    folder, name = path.rsplit("/", 1)
    file_system, staged = _resolve(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    stream = file_system.create(staged)
    try:
        stream.write(json.dumps(value).encode("utf-8"))
    finally:
        stream.close()
    return staged


def write_json(spark: SparkSession, path: str, value) -> None:
    """Write a new file in one step: readers see all of it or nothing."""
    file_system, target = _resolve(spark, path)
    staged = _staged_json(spark, path, value)
    if not file_system.rename(staged, target):
        file_system.delete(staged, False)
        raise FileExistsError(path)
