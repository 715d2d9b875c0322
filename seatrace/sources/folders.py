"""Folders of any store that Spark can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _store(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    store, place = _store(spark, path)
    return store.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder with what is in it; nothing happens if there is none."""
    store, place = _store(spark, path)
    store.delete(place, True)


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match a glob pattern, sorted."""
    store, place = _store(spark, pattern)
    found = store.globStatus(place) or []
    return sorted(x.getPath().toString() for x in found if x.isDirectory())
