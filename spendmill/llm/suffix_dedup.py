"""Removal of byte strings that repeat anywhere in the corpus, by column-wise suffix sorting of many short documents.

A string of `WINDOW` bytes can only repeat where its anchor (see `windows`) does, and then at the same distance from it. So the
collection to sort consists of the contexts of repeated anchors: the bytes of all windows that an anchor owns. Contexts with
the same anchor are lined up at it, and suffixes that begin in the same column are sorted together. Columns are taken from the
right to the left: every round puts one symbol in front of each document's suffix, carries the order of the collection
(its Burrows-Wheeler order) over by a stable sort on that symbol, and takes the common prefixes of neighbours from those of
the round before. A window repeats if its suffix shares `WINDOW` bytes with a neighbour.

The rounds read and write two arrays in sequence. Between the steps the collection lies in files that Spark sorts and streams:
a task holds one batch of contexts at a time, never a whole bucket. Equal contexts are one document with two places; an
anchor with more than `GROUP_BOUND` different contexts is not held at all, and its windows are counted by hash in Spark instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendmill.llm.common import Workspace
from spendmill.llm.repeats import candidates, keyed, per_batch, repeated, repeated_anchors
from spendmill.llm.windows import Prefix, byte_units, owners

WINDOW = 200
GROUP_BOUND = 50_000
BATCH_CONTEXTS = 8192
ABSENT = 256


def lengths(window: int) -> tuple[int, int]:
    """Bytes of an anchor, and of its extension to one side."""
    return max(1, window * 4 // 25), (window + 1) // 2


def _contexts(window: int):
    gram, _ = lengths(window)

    def of(batch: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for k1, k2, text, places in zip(batch["k1"], batch["k2"], batch["text"], batch["places"]):
            text = text.encode("utf-8", "surrogatepass")
            alive = set(places.tolist())
            for place, hashes, first, last in owners(byte_units(text), gram, window):
                for p, h, f, e in zip(place.tolist(), hashes.view(np.int64).tolist(), first.tolist(), last.tolist()):
                    if p in alive:
                        rows.append((k1, k2, f, h, p - f, text[f : e + window]))
        return pd.DataFrame(rows, columns=["k1", "k2", "first", "gram", "before", "context"])

    return of


def common_prefixes(contexts: list[bytes], before: np.ndarray, groups: np.ndarray, window: int) -> np.ndarray:
    """For every context and offset from its anchor (columns 0 .. before) whether the window there repeats in its group.

    `before` is the anchor's place in each context, `groups` (ascending) tells which contexts stand together.
    """
    n, reach = len(contexts), int(before.max())
    sizes = np.fromiter(map(len, contexts), np.int64, n)
    width = int((sizes - before).max()) + reach
    # Aligned columns: the anchor starts in column `reach`.
    symbols = np.full((n, width), ABSENT, np.int16)
    flat = np.frombuffer(b"".join(contexts), np.uint8)
    row = np.repeat(np.arange(n), sizes)
    inside = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    symbols[row, inside + np.repeat(reach - before, sizes)] = flat
    symbols = np.ascontiguousarray(symbols.T)
    order, common = np.arange(n), np.zeros(n + 1, np.int64)
    scaled = groups.astype(np.int64) * (ABSENT + 1)
    found = np.zeros((n, reach + 1), bool)
    for column in range(width - 1, -1, -1):
        symbol = symbols[column]
        keys = (scaled + symbol)[order]
        step = np.argsort(keys, kind="stable")
        keys = keys[step]
        # Neighbours that start alike share one symbol more than the least of what lies between their old places.
        alike = np.concatenate([[False], (keys[1:] == keys[:-1]) & (keys[1:] % (ABSENT + 1) != ABSENT)])
        new = np.zeros(n + 1, np.int64)
        at = np.flatnonzero(alike)
        if len(at):
            bounds = np.empty(2 * len(at), np.int64)
            bounds[::2], bounds[1::2] = step[at - 1] + 1, step[at] + 1
            new[at] = 1 + np.minimum.reduceat(common, bounds)[::2]
        order, common = order[step], new
        if column <= reach:
            again = np.maximum(common[:-1], common[1:]) >= window
            found[order[again], reach - column] = True
    return found


def covered_spans(found: np.ndarray, before: int, window: int) -> list[tuple[int, int]]:
    """(start, length) in a context of what its repeated windows cover; `found` by offset from the anchor."""
    starts = np.flatnonzero(found[: before + 1][::-1])
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > window)
    low, high = starts[np.concatenate([[0], cut + 1])], starts[np.append(cut, len(starts) - 1)]
    return [(int(a), int(b - a) + window) for a, b in zip(low, high)]


def _windows_of(frame: pd.DataFrame, window: int) -> Iterator[pd.DataFrame]:
    """All windows of the contexts of a large group, as hashes of 128 bits."""
    for at in range(0, len(frame), 256):
        parts = []
        for c1, c2, before, context in frame.iloc[at : at + 256][["c1", "c2", "before", "context"]].itertuples(index=False):
            hashes = [Prefix(byte_units(context, i), i).grams(window).view(np.int64) for i in (0, 1)]
            parts.append(
                pd.DataFrame({"c1": c1, "c2": c2, "w1": hashes[0], "w2": hashes[1], "at": np.arange(len(hashes[0]), dtype=np.int32)})
            )
        yield pd.concat(parts, ignore_index=True)


def _sorted_groups(window: int, bound: int):
    """Over contexts sorted by `gram`: covered spans of each context, or the windows of groups that are too large."""

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        groups = np.cumsum(np.concatenate([[0], (frame["gram"].to_numpy()[1:] != frame["gram"].to_numpy()[:-1]).astype(int)]))
        before = frame["before"].to_numpy(np.int64)
        contexts = [bytes(c) for c in frame["context"]]
        found = common_prefixes(contexts, before, groups, window)
        rows = [
            (c1, c2, spans)
            for i, (c1, c2, many) in enumerate(frame[["c1", "c2", "many"]].itertuples(index=False))
            if not many and (spans := covered_spans(found[i], int(before[i]), window))
        ]
        return pd.DataFrame(
            {
                "c1": [r[0] for r in rows],
                "c2": [r[1] for r in rows],
                "spans": [[{"start": a, "len": b} for a, b in r[2]] for r in rows],
                "w1": None,
                "w2": None,
                "at": None,
            }
        )

    def typed(frame: pd.DataFrame) -> pd.DataFrame:
        if "spans" not in frame:
            frame["spans"] = [None] * len(frame)
        return frame.astype({"c1": "Int64", "c2": "Int64", "spans": object, "w1": "Int64", "w2": "Int64", "at": "Int32"})[
            ["c1", "c2", "spans", "w1", "w2", "at"]
        ]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        rows, oversize = 0, None
        for batch in batches:
            for at in range(0, len(batch), BATCH_CONTEXTS):
                part = batch.iloc[at : at + BATCH_CONTEXTS]
                if oversize is not None:
                    same = part["gram"].to_numpy() == oversize
                    if same.any():
                        yield from map(typed, _windows_of(part[same], window))
                    part = part[~same]
                    if len(part):
                        oversize = None
                if not len(part):
                    continue
                held.append(part)
                rows += len(part)
                if rows < BATCH_CONTEXTS:
                    continue
                # The last group may go on; all others are complete.
                frame = pd.concat(held, ignore_index=True)
                last = frame["gram"].iloc[-1]
                done = frame["gram"].to_numpy() != last
                if done.any():
                    yield typed(solve(frame[done]))
                frame = frame[~done]
                if len(frame) > bound:
                    yield from map(typed, _windows_of(frame, window))
                    oversize, frame = last, frame.iloc[:0]
                held, rows = [frame], len(frame)
        frame = pd.concat(held, ignore_index=True) if held else None
        if frame is not None and len(frame):
            yield typed(solve(frame))

    return run


def repeated_spans(leaders: DataFrame, work: Workspace, window: int, bound: int) -> DataFrame:
    """`k1`, `k2` and `spans` (start, length; they may overlap) of the bytes that repeated windows cover."""
    contexts = leaders.mapInPandas(
        per_batch(_contexts(window), 128), "k1 long, k2 long, first long, gram long, before int, context binary"
    )
    contexts = contexts.withColumns(
        {
            "c1": F.xxhash64("gram", "before", "context"),
            "c2": F.xxhash64(F.lit(104729), "context", "before", F.octet_length("context")),
        }
    )
    contexts = work.write(contexts, "contexts")
    there = F.xxhash64("k1", "k2", "first")
    distinct = contexts.groupBy("gram", "before", "context", "c1", "c2").agg((F.min(there) < F.max(there)).alias("many"))
    distinct = work.write(distinct, "distinct")
    # Equal contexts at two places: all of their windows repeat.
    whole = F.array(F.struct(F.lit(0).alias("start"), F.octet_length("context").alias("len")))
    twice = distinct.where("many").select("c1", "c2", whole.alias("spans"))
    solved = work.write(
        distinct.repartition("gram")
        .sortWithinPartitions("gram")
        .mapInPandas(
            _sorted_groups(window, bound), "c1 long, c2 long, spans array<struct<start: int, len: int>>, w1 long, w2 long, at int"
        ),
        "solved",
    )
    large = solved.where("w1 is not null").select("c1", "c2", "w1", "w2", "at")
    counted = (
        large.join(work.write(repeated(large, ["w1", "w2"], ["c1", "c2", "at"]), "large"), ["w1", "w2"], "left_semi")
        .groupBy("c1", "c2")
        .agg(F.collect_set(F.struct(F.col("at").alias("start"), F.lit(window).alias("len"))).alias("spans"))
    )
    spans = twice.unionByName(solved.where("w1 is null").select("c1", "c2", "spans")).unionByName(counted)
    placed = contexts.select("k1", "k2", "first", "c1", "c2").join(spans, ["c1", "c2"])
    moved = F.transform("spans", lambda s: F.struct((s.start + F.col("first")).alias("start"), s.len.cast("long").alias("len")))
    return placed.groupBy("k1", "k2").agg(F.flatten(F.collect_set(moved)).alias("spans"))


def _settle(window: int):
    def of(batch: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for doc, k1, k2, text, copies, leader, places in zip(
            *(batch[c] for c in ("doc_id", "k1", "k2", "text", "copies", "leader", "places"))
        ):
            data = text.encode("utf-8", "surrogatepass")
            alive = places is not None and len(places) > 0
            if copies > 1 and len(data) >= window:
                # Every window has a copy. The leader's windows still count for other texts.
                settled = (len(data), 1, hashlib.sha256(b"").hexdigest())
            elif not alive:
                settled = (0, 0, hashlib.sha256(data).hexdigest())
            else:
                settled = (None, None, None)
            keep = alive and (leader or settled[0] is None)
            rows.append((doc, k1, k2, len(data), *settled, text if keep else None, bool(leader), places if keep else None))
        names = ["doc_id", "k1", "k2", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text", "leader", "places"]
        return pd.DataFrame(rows, columns=names).astype({"n_removed": "Int64", "n_spans": "Int64"})

    return of


def _cut(batch: pd.DataFrame) -> pd.DataFrame:
    rows = []
    for doc, text, spans in zip(batch["doc_id"], batch["text"], batch["spans"]):
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        edge = np.zeros(len(data) + 1, np.int32)
        for span in spans if spans is not None else ():
            edge[span["start"]] += 1
            edge[span["start"] + span["len"]] -= 1
        gone = np.cumsum(edge[:-1]) > 0
        kept = data[~gone].tobytes()
        runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
        rows.append((doc, len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(), kept))
    return pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeated_bytes(docs: DataFrame, window: int = WINDOW, group_bound: int = GROUP_BOUND) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `n_bytes`, `n_removed`, `n_spans`, `kept_sha256`, `kept` (bytes).

    `kept` is null where all or nothing was removed, since the caller then has it; cut bytes need not be valid UTF-8. Null and
    empty texts have no bytes. Texts shorter than the window keep all. Repeated rows are copies of each other. Further columns
    are not read; an empty table gives none.
    """
    work = Workspace(docs.sparkSession, "suffixes")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = keyed(docs)
    places = repeated_anchors(rows, byte_units, *lengths(window), window, work)
    settled = candidates(rows, places).mapInPandas(
        per_batch(_settle(window)),
        f"doc_id {id_type}, k1 long, k2 long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string,"
        " leader boolean, places array<int>",
    )
    settled = work.write(settled, "settled")
    work.drop("places")
    leaders = settled.where("leader and text is not null").select("k1", "k2", "text", "places")
    spans = work.write(repeated_spans(leaders, work, window, group_bound), "spans")
    open_rows = settled.where("n_removed is null").select("doc_id", "k1", "k2", "text")
    digest = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    cut = open_rows.join(spans, ["k1", "k2"], "left").mapInPandas(per_batch(_cut), f"doc_id {id_type}, {digest}, kept binary")
    done = settled.where("n_removed is not null").select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.lit(None).cast("binary").alias("kept")
    )
    return done.unionByName(cut)
