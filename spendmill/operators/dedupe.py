"""Keep-first deduplication with a stated order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(rows: DataFrame, keys: list[str] | tuple[str, ...], order: list[Column | str]) -> DataFrame:
    """First row per key in the given order; null keys count as equal.

    The `= 1` filter lets Spark apply a group limit before the exchange, so every task ships at most one row per key
    and a key that holds a large share of the rows does not end up in one task.
    """
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Bag union by column name."""
    return reduce(DataFrame.unionByName, frames)
