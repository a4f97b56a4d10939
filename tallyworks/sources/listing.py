"""Partition folders by name, without opening or listing the files inside."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import SparkSession


def folders(spark: SparkSession, root: str, *columns: str) -> list[tuple[str, ...]]:
    """The values of nested ``column=value`` folders below ``root``; none if it does not exist.

    One entry per folder (a day or a workbook of a sheet), the same list the
    file index of a scan keeps on the driver, a level shallower.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path("/".join([root.rstrip("/"), *[f"{c}=*" for c in columns]]))
    statuses = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    found = []
    for status in statuses:
        names = status.getPath().toUri().getPath().rstrip("/").split("/")[-len(columns):]
        found.append(tuple(unquote(name.split("=", 1)[1]) for name in names))
    return found


def folder_paths(spark: SparkSession, root: str, column: str) -> dict[str, str]:
    """Path of each ``column=value`` folder directly below ``root``, by value."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{column}=*")
    statuses = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    found = [status.getPath().toString() for status in statuses]
    return {unquote(p.rstrip("/").rsplit("/", 1)[1].split("=", 1)[1]): p for p in found}


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Put a written folder in another's place."""
    source_path, target_path = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    system = target_path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.delete(target_path, True)
    if not system.rename(source_path, target_path):
        raise OSError(f"{source} could not be moved to {target}")


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
