"""Helpers that several corpus operators share."""

from __future__ import annotations

import gc
from collections.abc import Sequence
from typing import ClassVar
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendmill import files
from spendmill.session import shared_dir

# ASCII white space between words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE_CLASS = "[\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_name(df: DataFrame, wanted: str) -> str:
    """`wanted`, or a variant of it that no column of `df` has."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def rows_where(df: DataFrame, keep: Column, columns: list[Column]) -> DataFrame:
    """`columns` of the rows for which `keep` holds, with `keep` computed once and where it stands.

    A plain filter is moved below the projections that `keep` is made of, with their expressions put into it, even into the
    functions of arrays, where they would be computed for every element. Generated rows are not moved.
    """
    kept = F.explode_outer(F.when(keep, F.array(F.struct(*columns)))).alias("row")
    return df.select(kept).where("row is not null").select("row.*")


class Workspace:
    """A folder of this run in the shared folder, for tables between the steps of an operator.

    A written table cuts the lineage and survives lost executors. After each one the shuffle files of the step that made
    it are of no more use; collecting the driver's garbage lets Spark delete them at once instead of at some later time.
    """

    # Folders opened in this process, oldest first.
    opened: ClassVar[list[Workspace]] = []

    def __init__(self, spark: SparkSession, operator: str):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/llm/{operator}-{uuid4().hex}"
        Workspace.opened.append(self)

    def write(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        path = f"{self.path}/{name}"
        writer = df.write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        schema = df.schema
        del df, writer
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()
        return self.spark.read.schema(schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Deletes tables of this run that no later step reads."""
        for name in names:
            files.delete(self.spark, f"{self.path}/{name}")

    @staticmethod
    def release(works: list[Workspace], *read: DataFrame) -> list[Workspace]:
        """Deletes the given folders, but for those from which a given frame still reads; returns these."""
        files_read = [path for df in read for path in df.inputFiles()] if works else []
        in_use = [work for work in works if any(f"/{work.path.rsplit('/', 1)[1]}/" in path for path in files_read)]
        for work in works:
            if work not in in_use:
                files.delete(work.spark, work.path)
        return in_use


def ascii_words(text: Column) -> Column:
    """Words between ASCII white space, in order; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), "")


def lower_for_ascii(text: Column) -> Column:
    """Lower case, for comparison with ASCII words: A-Z becomes a-z and no other character becomes an ASCII one.

    `lower` does that for every character but two, the Kelvin sign and the dotted capital I; only texts that hold one of
    them take the slow way, character by character.
    """
    odd = F.contains(text, F.lit("\u212a")) | F.contains(text, F.lit("\u0130"))
    return F.when(odd, F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def text_key(text: Column) -> list[Column]:
    """128 bits that stand for a text: two 64-bit hashes with different seeds."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text), F.xxhash64(F.lit(7919), text, F.length(text))]
