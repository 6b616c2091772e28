"""Near-duplicates by SimHash fingerprints, found through an inverted index over byte positions.

A fingerprint has eight bytes. Two that differ in at most `MAX_BITS` = 4 bits have at least four equal bytes in equal
positions: that is the guaranteed minimum of the count filter. The index therefore lists every distinct fingerprint under
each choice of four of its positional bytes (70 lists); two fingerprints meet in a list exactly if their tally of shared
positional bytes reaches four, and every meeting is verified bit by bit.

A list links its members to the smallest one they reach inside it, so a group of copies gives as many links as members, not
as pairs. A list longer than `LIST_BOUND` is never held: its members are listed again by four of the eight half-bytes that the
first choice left open. Those lists fix 48 bits and hold at most 65,536 fingerprints.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from spendmill.llm.common import Workspace, fresh_name
from spendmill.llm.components import connected_components

MAX_BITS = 4
SHINGLE = 4
SEED = 42
LIST_BOUND = 4096
CHOICES = list(combinations(range(8), 4))
_U = np.uint64


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 values (big-endian) of all word shingles in order, A-Z lower-cased; too few words give one shingle of all."""
    import xxhash

    # bytes.lower and bytes.split know ASCII letters and ASCII white space only.
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, ">u8")
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())], ">u8")


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bits set in over half of the XXH64 values of all word shingles, A-Z lower-cased; no words: zero."""
    return majority_bits(shingle_hashes(text, shingle))


def majority_bits(hashes: np.ndarray) -> int:
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        bits = np.unpackbits(hashes[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """`doc_id` and `fp` (the fingerprint's 64 bits as a signed long) of every row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def computed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "fp": [signed(fingerprint(text, shingle)) for text in batch["text"]]}
            )

    return docs.select("doc_id", "text").mapInPandas(computed, f"doc_id {id_type}, fp long")


def gathered(values: np.ndarray, positions: tuple[int, ...], width: int) -> np.ndarray:
    """The fields of `width` bits at `positions` (from the low end), side by side."""
    out = np.zeros(len(values), _U)
    mask = _U((1 << width) - 1)
    for position in positions:
        out = (out << _U(width)) | ((values >> _U(position * width)) & mask)
    return out


def positional_lists(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and members of the 70 lists of each fingerprint: which bytes were chosen, and their values."""
    keys = [(_U(choice) << _U(32)) | gathered(values, positions, 8) for choice, positions in enumerate(CHOICES)]
    return np.concatenate(keys), np.tile(values, len(CHOICES))


def refined_lists(key: int, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The second index of a long list: four of the eight half-bytes outside the chosen bytes.

    Its keys are hashes of both choices and the first key, with the four half-bytes in the low bits. Lists that share a key by
    chance do no harm, because links are verified.
    """
    choice = key >> 32
    rest = tuple(b for b in range(8) if b not in CHOICES[choice])
    open_bits = gathered(values, rest, 8)
    keys = [
        _U(((key * 71 + second) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFF0000) | gathered(open_bits, half, 4)
        for second, half in enumerate(CHOICES)
    ]
    return np.concatenate(keys), np.tile(values, len(CHOICES))


def reached(values: np.ndarray, block: int = 1024) -> np.ndarray:
    """For each of the sorted, distinct fingerprints of a list the smallest one it reaches through verified links.

    Every member is compared with those not reached yet, so a dense group of copies costs little more than its size.
    """
    roots, left = values.copy(), values
    while len(left):
        start, left = left[0], left[1:]
        frontier = np.array([start], _U)
        while len(frontier) and len(left):
            near = np.zeros(len(left), bool)
            for at in range(0, len(frontier), block):
                part = frontier[at : at + block]
                for low in range(0, len(left), block):
                    differing = np.bitwise_count(part[:, None] ^ left[None, low : low + block])
                    near[low : low + block] |= (differing <= MAX_BITS).any(axis=0)
            frontier, left = left[near], left[~near]
            roots[np.searchsorted(values, frontier)] = start
    return roots


def verified(keep_long: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Over rows sorted by `key`: links of every list, and, if `keep_long` is false, members of long lists by refined key."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held_key, held = None, np.zeros(0, _U)
        too_long = False

        def long_rows(values: np.ndarray) -> pd.DataFrame:
            keys, members = refined_lists(held_key, values)
            return pd.DataFrame({"key": keys.view(np.int64), "a": members.view(np.int64), "b": None}, copy=False)

        def close() -> Iterator[pd.DataFrame]:
            values = np.unique(held)
            if too_long:
                yield long_rows(values)
            elif len(values) > 1:
                roots = reached(values)
                other = roots != values
                yield pd.DataFrame({"key": None, "a": values[other].view(np.int64), "b": roots[other].view(np.int64)})

        for batch in batches:
            keys = batch["key"].to_numpy()
            members = batch["fp"].to_numpy().view(_U)
            if not len(keys):
                continue
            cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            ends = np.append(cuts[1:], len(keys))
            # Lists of one member link nothing; only the first and last of a batch can continue elsewhere.
            worth = np.flatnonzero(ends - cuts > 1)
            for run in np.unique(np.concatenate([[0], worth, [len(cuts) - 1]])).tolist():
                start, end = int(cuts[run]), int(ends[run])
                if held_key is None or keys[start] != held_key:
                    if held_key is not None:
                        yield from close()
                    held_key, held, too_long = int(keys[start]), members[start:end], False
                else:
                    held = np.concatenate([held, members[start:end]])
                if len(held) > LIST_BOUND and not keep_long:
                    too_long = True
                    yield long_rows(np.unique(held))
                    held = held[:0]
        if held_key is not None:
            yield from close()

    def typed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in scan(batches):
            yield pd.DataFrame({c: pd.array(frame[c], dtype="Int64") for c in ("key", "a", "b")})

    return typed


def fingerprint_links(distinct: DataFrame, work: Workspace) -> DataFrame:
    """Links (`a`, `b`) that connect all fingerprints (`fp`, distinct) within `MAX_BITS` of each other."""

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch["fp"].to_numpy().view(_U)
            for at in range(0, len(values), 10_000):
                keys, members = positional_lists(values[at : at + 10_000])
                yield pd.DataFrame({"key": keys.view(np.int64), "fp": members.view(np.int64)})

    lists = distinct.mapInPandas(listed, "key long, fp long").repartition("key").sortWithinPartitions("key")
    first = work.write(lists.mapInPandas(verified(False), "key long, a long, b long"), "first")
    again = first.where("key is not null").select("key", F.col("a").alias("fp")).distinct()
    second = again.repartition("key").sortWithinPartitions("key").mapInPandas(verified(True), "key long, a long, b long")
    return first.where("key is null").select("a", "b").unionByName(second.select("a", "b"))


def components_of(prints: DataFrame, work: Workspace) -> DataFrame:
    """`fp`, its component's `root` and `component_id`, the smallest document id of all its rows (null if it has no other)."""
    distinct = work.write(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = connected_components(fingerprint_links(distinct.select("fp"), work), work)
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = work.write(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fp", "component_id", "root")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `fingerprint` (16 hex digits), `component_id`.

    Null and empty texts have fingerprint zero and are linked like any other; texts shorter than a shingle have one shingle of
    all their words. Repeated rows share a fingerprint. A null document id never becomes the id of a component that has
    others. Further columns are not read; an empty table gives none.
    """
    work = Workspace(docs.sparkSession, "simhash")
    prints = work.write(fingerprints(docs, shingle), "prints")
    members = work.write(components_of(prints, work), "members")
    return prints.join(members, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def rows_to_drop(prints: DataFrame, work: Workspace) -> DataFrame:
    """`row` of all rows of `prints` (`doc_id`, `fp`, `row`) but the first of each component: the one with the smallest document id."""
    members = work.write(components_of(prints.select("doc_id", "fp"), work), "members")
    # The component's id is its smallest document id, so only rows that have it compete; null only if there is no other.
    first = (
        prints.join(members, "fp")
        .where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min("row").alias("row"))
    )
    keep = work.write(first.select("row"), "keep")
    return prints.select("row").join(keep, "row", "left_anti")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The rows of `docs`, all columns, of which one stays per component: the one with the smallest document id.

    Nulls come last; of rows with that id, one stays. The rows are written once with their fingerprint and a row number, so
    that the number of a row to drop means the same row when they are read again. The numbers of dropped rows are joined, not
    those of kept ones: they are fewer, and while they fit into a broadcast no text is shuffled.
    """
    work = Workspace(docs.sparkSession, "simhash")
    fp, number = fresh_name(docs, "fp"), fresh_name(docs, "row_number")

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            prints = pa.array([signed(fingerprint(text, shingle)) for text in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, prints], names=[*batch.schema.names, fp])

    schema = StructType([*docs.schema.fields, StructField(fp, LongType())])
    numbered = docs.mapInArrow(marked, schema).withColumn(number, F.monotonically_increasing_id())
    rows = work.write(numbered, "rows")
    prints = rows.select(F.col("doc_id"), F.col(fp).alias("fp"), F.col(number).alias("row"))
    drop = work.write(rows_to_drop(prints, work).withColumnRenamed("row", number), "drop")
    return rows.join(drop, number, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
