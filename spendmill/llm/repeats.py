"""Common steps of the exact substring operators: which documents hold a gram that repeats, and where."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendmill.llm.common import Workspace, text_key
from spendmill.llm.windows import Prefix, owners

_PLACE = ["k1", "place"]


def keyed(docs: DataFrame) -> DataFrame:
    """`doc_id`, `text` (null as empty) and the text's key `k1`, `k2`."""
    k1, k2 = text_key(F.col("text"))
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), k1.alias("k1"), k2.alias("k2"))


def repeated(rows: DataFrame, keys: list[str], place: list[str]) -> DataFrame:
    """The distinct `keys` that occur at two places or more. Copies of a text count as one place.

    A place is told by a hash of its columns, so the aggregation keeps two longs per key and combines before the shuffle:
    a key that a third of all rows share sends one row per task.
    """
    there = F.xxhash64(*place)
    return rows.groupBy(*keys).agg(F.min(there).alias("a"), F.max(there).alias("b")).where("a <> b").select(*keys)


def _anchors(units_of: Callable[[bytes], np.ndarray], gram: int, half: int, window: int):
    def of(batch: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for k1, text in zip(batch["k1"], batch["text"]):
            units = units_of(text.encode("utf-8", "surrogatepass"))
            if len(units) < window:
                continue
            sums = Prefix(units)
            for place, hashes, _, _ in owners(units, gram, window):
                # Beyond an end of the text there is no extension; zero stands for it and is never counted.
                right = np.where(place + half <= len(units), sums.of(place, np.minimum(place + half, len(units))), 0)
                low = place + gram - half
                left = np.where(low >= 0, sums.of(np.maximum(low, 0), place + gram), 0)
                parts.append((k1, place, hashes, right, left))
        columns = [np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, np.int64) for c in range(1, 5)]
        return pd.DataFrame(
            {
                "k1": np.repeat(np.array([p[0] for p in parts], np.int64), [len(p[1]) for p in parts]),
                "place": columns[0].astype(np.int32),
                **{n: c.astype(np.uint64).view(np.int64) for n, c in zip(("gram", "right", "left"), columns[1:])},
            }
        )

    return of


def repeated_anchors(
    rows: DataFrame,
    units_of: Callable[[bytes], np.ndarray],
    gram: int,
    half: int,
    window: int,
    work: Workspace,
) -> DataFrame:
    """`k1` and `places` of all anchors whose window may repeat: their gram does, and so does its extension to one side.

    `rows` is `keyed`; a window of `window` units holds, around its anchor of `gram` units, the `half` units that begin with
    the anchor or the `half` units that end with it.
    """
    found = work.write(
        rows.select("k1", "text").mapInPandas(
            per_batch(_anchors(units_of, gram, half, window)), "k1 long, place int, gram long, right long, left long"
        ),
        "anchors",
    )
    # Written first: joins of two plain exchanges let AQE split an anchor that a third of all rows share.
    grams = work.write(repeated(found, ["gram"], _PLACE), "grams")
    first = work.write(found.join(grams, "gram", "left_semi").drop("gram"), "level1")
    work.drop("anchors", "grams")
    sides = F.array(
        F.struct(F.lit(1).alias("side"), F.col("right").alias("part")),
        F.struct(F.lit(2).alias("side"), F.col("left").alias("part")),
    )
    halves = first.select("k1", "place", F.explode(sides).alias("s")).select("k1", "place", "s.*").where("part <> 0")
    parts = work.write(repeated(halves, ["side", "part"], _PLACE), "parts")
    again = halves.join(parts, ["side", "part"], "left_semi")
    places = work.write(again.groupBy("k1").agg(F.collect_set("place").alias("places")), "places")
    work.drop("level1", "parts")
    return places


def candidates(docs: DataFrame, anchors: DataFrame) -> DataFrame:
    """All rows of `docs` (`keyed`) with `copies` (rows of the same text), `leader` and the repeated `anchors` of their text.

    `anchors` has `k1` and `places`. One row (or a few equal ones) of each text leads: only leaders need be searched further.
    One shuffle of the texts.
    """
    texts = docs.groupBy("k1", "k2").agg(F.count("*").alias("copies"), F.min("doc_id").alias("leader_id"))
    facts = texts.join(anchors, "k1", "left")
    joined = docs.join(facts, ["k1", "k2"])
    return joined.withColumn("leader", F.col("doc_id").eqNullSafe(F.col("leader_id"))).drop("leader_id")


def per_batch(frame_of: Callable[[pd.DataFrame], pd.DataFrame], rows: int = 512) -> Callable:
    """A `mapInPandas` function that hands on at most `rows` rows at a time, to bound the memory of their results."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), rows):
                yield frame_of(batch.iloc[at : at + rows])

    return run
