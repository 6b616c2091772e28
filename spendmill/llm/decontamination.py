"""Benchmark passages in documents by greedy string tiling.

The test items are tokenized once, in blocks of bounded size, and a block travels to the executors as a broadcast: a stated
query set against all rows. In each text, the Karp-Rabin values of all windows of `SEED` tokens are looked up among those of
the items; shared seeds on one diagonal join to runs, checked token by token. The longest run is marked first, what it
covers in item and text is cut from the others, and so on until no run of `SEED` tokens is left. Because tiles may come in any
order, a reordered passage covers its item as well as a straight copy does.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEED = 5
COVERAGE = 0.5
BLOCK_BYTES = 8_000_000
# Pairs of seeds that are looked at together.
_PAIRS_AT_ONCE = 1_000_000
# Scripts that are written without spaces: each character is a token.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_TOKENS = re.compile(rf"(?=[^\W_])[{_UNSPACED}]|(?:(?![{_UNSPACED}])[^\W_])+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: str | None) -> list[str]:
    """Runs of letters and digits, lower-cased; in scripts without spaces, every letter for itself."""
    return _TOKENS.findall(text.lower()) if text else []


def rolling(ids: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin value modulo 2^64 of every window of `size` ids."""
    if len(ids) < size:
        return np.zeros(0, np.uint64)
    value = np.zeros(len(ids) - size + 1, np.uint64)
    for j in range(size):
        value = value * _MULTIPLIER + ids[j : len(ids) - size + 1 + j]
    return value


@dataclass
class TestBlock:
    """Items of one block: their token ids and the seeds' places, sorted by Karp-Rabin value.

    `short` are the items of fewer than `SEED` tokens, by their tokens.
    """

    __test__ = False

    names: list
    items: list[np.ndarray]
    vocabulary: dict[str, int]
    seeds: np.ndarray
    seed_item: np.ndarray
    seed_at: np.ndarray
    flat: np.ndarray
    offsets: np.ndarray
    short: dict[tuple[str, ...], list[int]]

    @classmethod
    def of(cls, rows: list[tuple]) -> TestBlock:
        vocabulary: dict[str, int] = {}
        names, items, short = [], [], defaultdict(list)
        for name, text in rows:
            found = tokens(text)
            if found:
                if len(found) < SEED:
                    short[tuple(found)].append(len(names))
                names.append(name)
                items.append(np.array([vocabulary.setdefault(t, len(vocabulary) + 1) for t in found], np.uint64))
        values = [rolling(ids, SEED) for ids in items]
        flat = np.concatenate([*values, np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(items)), [len(v) for v in values])
        at = np.concatenate([*(np.arange(len(v)) for v in values), np.zeros(0, np.int64)]).astype(np.int64)
        order = np.argsort(flat, kind="stable")
        ids = np.concatenate([*items, np.zeros(0, np.uint64)])
        offsets = np.cumsum([0, *map(len, items)])
        return cls(names, items, vocabulary, flat[order], item[order], at[order], ids, offsets, dict(short))

    def matches(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item, covered tokens, tiles, longest tile) for every item that shares a seed with the text or, if it is too short
        for one, equals it token by token."""
        if not text:
            return []
        found = tokens(text)
        if len(found) < SEED:
            return [(item, len(found), 1, len(found)) for item in self.short.get(tuple(found), ())]
        if not len(self.seeds):
            return []
        known = self.vocabulary.get
        ids = np.array([known(t, 0) for t in found], np.uint64)
        pairs: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for places, items, ats in self._run_starts(ids):
            for place, item, at in zip(places.tolist(), items.tolist(), ats.tolist()):
                pairs[item].append((place, at))
        return [(item, *tile(ids, self.items[item], seeds)) for item, seeds in sorted(pairs.items())]

    def _run_starts(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(place in text, item, place in item) of seeds that begin a run: the tokens before them differ, or there are none.

        Where a text repeats a token of an item, all other pairs lie inside runs; they are passed over without being kept.
        """
        values = rolling(ids, SEED)
        first = np.searchsorted(self.seeds, values, side="left")
        hit = np.flatnonzero(self.seeds[np.minimum(first, len(self.seeds) - 1)] == values)
        first = first[hit]
        counts = np.searchsorted(self.seeds, values[hit], side="right") - first
        ends = np.cumsum(counts)
        low = 0
        while low < len(hit):
            done = ends[low] - counts[low]
            high = max(low + 1, int(np.searchsorted(ends, done + _PAIRS_AT_ONCE, side="right")))
            some = counts[low:high]
            seed = np.arange(some.sum()) + np.repeat(first[low:high] - (ends[low:high] - some - done), some)
            place, item, at = np.repeat(hit[low:high], some), self.seed_item[seed], self.seed_at[seed]
            begins = (place == 0) | (at == 0)
            begins |= ids[place - 1] != self.flat[self.offsets[item] + at - 1]
            yield place[begins], item[begins], at[begins]
            low = high


def tile(text: np.ndarray, item: np.ndarray, seeds: list[tuple[int, int]]) -> tuple[int, int, int]:
    """Covered item tokens, number of tiles and longest tile; `seeds` are (place in text, place in item)."""
    runs: list[tuple[int, int, int]] = []  # (-length, place in item, place in text)
    ends: dict[int, int] = {}  # diagonal -> end in the text of its latest run
    for place, at in sorted(seeds):
        diagonal = place - at
        if ends.get(diagonal, -1) >= place + SEED:
            continue
        # Token by token: equal Karp-Rabin values are only a hint.
        length = 0
        while place + length < len(text) and at + length < len(item) and text[place + length] == item[at + length]:
            length += 1
        if length >= SEED:
            runs.append((-length, at, place))
            ends[diagonal] = place + length
    heapq.heapify(runs)
    in_item, in_text = np.zeros(len(item), bool), set()
    count = longest = 0
    while runs:
        negative, at, place = heapq.heappop(runs)
        length = -negative
        free = [not in_item[at + j] and place + j not in in_text for j in range(length)]
        if all(free):
            in_item[at : at + length] = True
            in_text.update(range(place, place + length))
            count += 1
            longest = max(longest, length)
            continue
        start = None
        for j in range(length + 1):
            if j < length and free[j]:
                start = j if start is None else start
            elif start is not None:
                if j - start >= SEED:
                    heapq.heappush(runs, (start - j, at + start, place + start))
                start = None
    return int(in_item.sum()), count, longest


def test_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """Items (`item_id`, `text`) in blocks of about `block_bytes` of text, one block at a time on the driver."""
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, ceil(size / block_bytes))
    for block in range(blocks):
        own = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield [tuple(row) for row in own.toLocalIterator()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """One row per (row of `docs`, item) whose tiles cover `coverage` of the item's tokens or more.

    Columns: `doc_id`, `item_id`, `coverage`, `n_tiles`, `longest`. Null and empty texts match nothing; an item of
    fewer than `SEED` tokens, which stands in many texts by chance, matches texts that hold nothing else; repeated rows give
    repeated results; further columns are not read. An empty benchmark or table gives no rows.
    """
    spark = docs.sparkSession
    doc_type, item_type = (df.schema[c].dataType.simpleString() for df, c in ((docs, "doc_id"), (benchmark, "item_id")))
    ddl = f"doc_id {doc_type}, item_id {item_type}, coverage double, n_tiles long, longest long"
    found = None
    for rows in test_blocks(benchmark):
        shared = spark.sparkContext.broadcast(TestBlock.of(rows))

        def search(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            block = shared.value
            for batch in batches:
                hits = []
                for doc, text in zip(batch["doc_id"], batch["text"]):
                    for item, covered, tiles, longest in block.matches(text):
                        share = covered / len(block.items[item])
                        if share >= coverage:
                            hits.append((doc, block.names[item], share, tiles, longest))
                yield pd.DataFrame(hits, columns=["doc_id", "item_id", "coverage", "n_tiles", "longest"])

        part = docs.select("doc_id", "text").mapInPandas(search, ddl)
        found = part if found is None else found.unionByName(part)
    return found


def drop_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of `docs`, all columns, in which no item is covered to `coverage` or more."""
    spark = docs.sparkSession
    for rows in test_blocks(benchmark):
        shared = spark.sparkContext.broadcast(TestBlock.of(rows))

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for batch in batches:
                keep = [
                    all(covered < coverage * len(block.items[item]) for item, covered, _, _ in block.matches(text))
                    for text in batch.column("text").to_pylist()
                ]
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
