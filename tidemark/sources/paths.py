"""Existence, listing and removal of paths on whatever file system Spark is configured for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _locate(spark: SparkSession, path: str):
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    system, location = _locate(spark, path)
    return system.exists(location)


def remove(spark: SparkSession, path: str) -> None:
    system, location = _locate(spark, path)
    system.delete(location, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file or folder; an existing target is an error."""
    system, location = _locate(spark, path)
    goal = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to)
    if goal.getParent() is not None:
        system.mkdirs(goal.getParent())
    if system.exists(goal) or not system.rename(location, goal):
        raise FileExistsError(to)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below a path; none if it does not exist."""
    system, location = _locate(spark, path)
    if not system.exists(location):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(location) if s.isDirectory())


def files_below(spark: SparkSession, path: str) -> list[str]:
    """All data files below a path, at any depth; none if it does not exist."""
    system, location = _locate(spark, path)
    if not system.exists(location):
        return []
    found, listed = [], system.listFiles(location, True)
    while listed.hasNext():
        file = listed.next().getPath()
        if not file.getName().startswith(("_", ".")):
            found.append(file.toString())
    return sorted(found)
