"""Small files and folders on whatever store holds the tables, through Spark's own file system access."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    store, place = _at(spark, path)
    return store.exists(place)


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; a folder that is not there is empty."""
    store, place = _at(spark, folder)
    if not store.exists(place):
        return []
    return sorted(status.getPath().getName() for status in store.listStatus(place))


def make_folder(spark: SparkSession, path: str) -> None:
    store, place = _at(spark, path)
    store.mkdirs(place)


def delete(spark: SparkSession, path: str) -> None:
    store, place = _at(spark, path)
    store.delete(place, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that it is there whole or not at all."""
    store, place = _at(spark, path)
    _, draft = _at(spark, f"{path}.draft")
    out = store.create(draft, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    if store.exists(place):
        store.delete(place, False)
    if not store.rename(draft, place):
        raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]
