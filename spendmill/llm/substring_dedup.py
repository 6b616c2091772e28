"""Removal of word sequences that repeat anywhere in the corpus, found level by level with doubling lengths.

Level 1 looks at grams of a quarter of the window: one in every window, its anchor (see `windows`). Level 2 extends the grams
that repeat, and only those, to twice their length, to the right and to the left: a window that repeats holds its anchor's
extension to one side or the other. Level 3 extends what still repeats to the whole window, now at every place; those windows
that repeat here cover the words to remove. A level without survivors ends the search.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendmill.llm.common import Workspace
from spendmill.llm.repeats import candidates, keyed, per_batch, repeated, repeated_anchors
from spendmill.llm.windows import Prefix, owners, word_spans, word_units

WINDOW = 35


def lengths(window: int) -> tuple[int, int]:
    """Words of the first and the second level."""
    gram = (window + 3) // 4
    return gram, min(2 * gram, (window + 1) // 2)


def _full_windows(window: int):
    gram, _ = lengths(window)

    def of(batch: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for k1, k2, text, places in zip(batch["k1"], batch["k2"], batch["text"], batch["places"]):
            text = text.encode("utf-8", "surrogatepass")
            units = word_units(text)
            alive = set(places.tolist())
            for place, _, first, last in owners(units, gram, window):
                spans = [(f, e) for p, f, e in zip(place.tolist(), first.tolist(), last.tolist()) if p in alive]
                if spans:
                    parts.append((k1, k2, np.concatenate([np.arange(f, e + 1) for f, e in spans]), text, units))
        frames = []
        for k1, k2, starts, text, units in parts:
            one, two = Prefix(units), Prefix(word_units(text, 1), 1)
            frames.append(
                pd.DataFrame(
                    {
                        "w1": one.of(starts, starts + window).view(np.int64),
                        "w2": two.of(starts, starts + window).view(np.int64),
                        "k1": k1,
                        "k2": k2,
                        "place": starts.astype(np.int32),
                    }
                )
            )
        empty = {c: np.zeros(0, np.int64) for c in ("w1", "w2", "k1", "k2")} | {"place": np.zeros(0, np.int32)}
        return pd.concat(frames, ignore_index=True) if frames else pd.DataFrame(empty)

    return of


def _settle(window: int):
    """Counts of texts that need no more search; the others keep their text."""

    def of(batch: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for doc, k1, k2, text, copies, leader, places in zip(
            *(batch[c] for c in ("doc_id", "k1", "k2", "text", "copies", "leader", "places"))
        ):
            words = text.encode("utf-8", "surrogatepass").split()
            alive = places is not None and len(places) > 0
            if copies > 1 and len(words) >= window:
                # Every window has a copy. The leader's windows still count for other texts.
                settled = (len(words), hashlib.sha256(b"").hexdigest())
            elif not alive:
                settled = (0, hashlib.sha256(b" ".join(words)).hexdigest())
            else:
                settled = (None, None)
            keep = alive and (leader or settled[0] is None)
            rows.append(
                (doc, k1, k2, len(words), *settled, text if keep else None, bool(leader), places if keep else None)
            )
        frame = pd.DataFrame(
            rows, columns=["doc_id", "k1", "k2", "n_words", "n_removed", "kept_sha256", "text", "leader", "places"]
        )
        frame["n_removed"] = frame["n_removed"].astype("Int64")
        return frame

    return of


def _cut(window: int):
    def of(batch: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for doc, n_words, text, starts in zip(*(batch[c] for c in ("doc_id", "n_words", "text", "starts"))):
            text = text.encode("utf-8", "surrogatepass")
            gone = np.zeros(n_words + 1, np.int32)
            if starts is not None and len(starts):
                at = np.asarray(starts, np.int64)
                np.add.at(gone, at, 1)
                np.add.at(gone, at + window, -1)
            gone = np.cumsum(gone[:-1]) > 0
            kept = b" ".join([word for word, lost in zip(text.split(), gone.tolist()) if not lost])
            rows.append((doc, n_words, int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "surrogatepass")))
        return pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return of


def remove_repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `n_words`, `n_removed`, `kept_sha256`, `kept`.

    `kept` is the text that is left, its words joined by one space; it is null where all or nothing was removed, since the
    caller then has it. Null and empty texts have no words. Texts shorter than the window keep all. Repeated rows are copies
    of each other. Further columns are not read; an empty table gives none.
    """
    work = Workspace(docs.sparkSession, "substrings")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = keyed(docs)
    places = repeated_anchors(rows, word_units, *lengths(window), window, work)
    settled = candidates(rows, places).mapInPandas(
        per_batch(_settle(window)),
        f"doc_id {id_type}, k1 long, k2 long, n_words long, n_removed long, kept_sha256 string, text string,"
        " leader boolean, places array<int>",
    )
    settled = work.write(settled, "settled")
    # The whole window, at every place that is left.
    leaders = settled.where("leader and text is not null").select("k1", "k2", "text", "places")
    full = work.write(
        leaders.mapInPandas(per_batch(_full_windows(window), 64), "w1 long, w2 long, k1 long, k2 long, place int"), "level3"
    )
    twice = work.write(repeated(full, ["w1", "w2"], ["k1", "k2", "place"]), "twice")
    again = full.join(twice, ["w1", "w2"], "left_semi")
    starts = work.write(again.groupBy("k1", "k2").agg(F.collect_set("place").alias("starts")), "starts")
    work.drop("places", "level3", "twice")
    open_rows = settled.where("n_removed is null").select("doc_id", "k1", "k2", "n_words", "text")
    cut = open_rows.join(starts, ["k1", "k2"], "left").mapInPandas(
        per_batch(_cut(window)), f"doc_id {id_type}, n_words long, n_removed long, kept_sha256 string, kept string"
    )
    done = settled.where("n_removed is not null").select(
        "doc_id", "n_words", "n_removed", "kept_sha256", F.lit(None).cast("string").alias("kept")
    )
    return done.unionByName(cut)
