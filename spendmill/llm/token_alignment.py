"""Alignment of two tokenizers' tokens by byte range, with counts of linked ids over the whole corpus.

The ends of a document's A tokens and those of its B tokens are two sorted lists. Merging them is divided along its path: a
diagonal of the merge grid fixes how many items have been taken in all, a binary search on it finds how many come from each
list, and so equal shares of work are known before anything is merged. Every share emits the overlaps of its part of the
path; ends that meet across a border between shares are stitched. All documents of a batch are merged in one path, because a
document ends where both of its lists end.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendmill.llm.common import Workspace

# Steps of the merge path per share.
SHARE_STEPS = 65_536
# Characters per batch; one longer document is a batch of its own. A batch shares one list of linked id pairs.
BATCH_CHARS = 1_000_000
MARK = "▁"
_B_BITS = 32
_SEPARATORS = (",", "|", ";")
MEMO_WORDS = 400_000
# Characters whose kind (letter, number, other) is the same in all releases of Unicode that the libraries may follow.
_SETTLED = re.compile(
    "[^\u0000-\u052f\u0591-\u05f4\u0600-\u06ff\u0900-\u0963\u0e00-\u0e5b\u1e00-\u1eff\u2000-\u2064\u20a0-\u20b9\u2100-\u2188"
    "\u2190-\u23f3\u2500-\u26ff\u3000-\u3029\u3041-\u3096\u30a0-\u30ff\u4e00-\u9fcb\uac00-\ud7a3\uff00-\uff60]"
)


def byte_characters() -> dict[str, int]:
    """Characters by which byte-level vocabularies write bytes: printable ones stand for themselves, others from 256 up."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers, and the bytes that each of their tokens stands for."""

    def __init__(self, a_file: str, b_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
        import public_tokenizers
        import regex
        import sentencepiece
        from tokenizers import Tokenizer

        self.words = regex.compile(public_tokenizers.PATTERN).findall
        self._forget()
        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        byte_of = byte_characters()
        vocabulary = self.a.get_vocab()
        self.a_bytes: list[bytes] = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in byte_of for c in token)
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if known else token.encode()
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_sizes = np.array([len(t) for t in self.a_bytes], dtype=np.int64)
        self.b_sizes = np.array([len(t) for t in self.b_bytes], dtype=np.int64)
        # Ids as text, with what follows them: a token of the same side, the other side, the next group.
        self.id_range = max(len(self.a_bytes), len(self.b_bytes))
        self.written = np.array([f"{i}{mark}" for mark in _SEPARATORS for i in range(self.id_range)], dtype=object)

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(MARK, " ").encode()

    def _forget(self) -> None:
        """Empties the memo: words by number; by number, where their ids stand in `ids`, how many, and how many bytes they give back.

        A word whose ids do not give its bytes back has -1 bytes.
        """
        self.memo: dict[str, int] = {}
        self.ids, self.starts, self.counts, self.lengths = (np.zeros(0, np.int64) for _ in range(4))

    def _learn(self, words: set[str]) -> None:
        """Puts words into the memo; a full memo is emptied first."""
        new = words - self.memo.keys()
        if len(self.memo) + len(new) > MEMO_WORDS:
            self._forget()
            new = words
        asked = list(new)
        encoded = [e.ids for e in self.a.encode_batch_fast(asked, add_special_tokens=False)]
        self.memo.update(zip(asked, range(len(self.memo), len(self.memo) + len(asked))))
        counts = np.fromiter(map(len, encoded), np.int64, len(encoded))
        data = [word.encode("utf-8", "surrogatepass") for word in asked]
        lengths = [len(d) if _bytes_of(self.a_bytes, ids) == d else -1 for ids, d in zip(encoded, data)]
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.lengths = np.concatenate([self.lengths, np.array(lengths, np.int64)])
        self.ids = np.concatenate([self.ids, _flat(encoded)])

    def _arrays_a(self, texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        """A's ids of every text, and how many bytes they are known to give back, word by word (-1: not known).

        No merge crosses a word of the pre-tokenizer, so the library encodes every new word once. Texts with characters on which
        the libraries' tables might differ are encoded whole.
        """
        whole = [i for i, text in enumerate(texts) if _SETTLED.search(text)]
        apart = set(whole)
        split = [[] if i in apart else self.words(text) for i, text in enumerate(texts)]
        self._learn(set(chain.from_iterable(split)))
        stops = np.cumsum([len(words) for words in split])
        words = np.fromiter(map(self.memo.__getitem__, chain.from_iterable(split)), np.int64, stops[-1] if len(stops) else 0)
        counts = self.counts[words]
        ends = np.cumsum(counts)
        ids = self.ids[np.repeat(self.starts[words] - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)]
        # Sums up to each text's last word; a text may have none.
        up_to = lambda values: np.concatenate([[0], np.cumsum(values)])[stops]
        arrays = np.split(ids, up_to(counts)[:-1])
        given = np.diff(up_to(self.lengths[words]), prepend=0)
        given[np.diff(up_to(self.lengths[words] < 0), prepend=0) > 0] = -1
        for i, encoded in zip(whole, self.a.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False)):
            arrays[i], given[i] = np.array(encoded.ids, np.int64), -1
        return arrays, given

    def _encode_a(self, texts: list[str]) -> list[list[int]]:
        return [ids.tolist() for ids in self._arrays_a(texts)[0]]

    def encode(self, texts: list[str]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Ids of either side, all texts in a row, and their number per text.

        A text that one of the two does not give back byte by byte behind a space has none. Words of A that give their bytes back
        stand for their text if they have as many bytes as it.
        """
        spaced = [" " + text for text in texts]
        a, given = self._arrays_a(spaced)
        b = self.b.encode(texts, num_threads=1)
        for i, text in enumerate(spaced):
            data = text.encode("utf-8", "surrogatepass")
            if (
                not texts[i]
                or (given[i] != len(data) and _bytes_of(self.a_bytes, a[i].tolist()) != data)
                or _bytes_of(self.b_bytes, b[i]) != data
            ):
                a[i], b[i] = a[i][:0], []
        n_a, n_b = (np.array([len(ids) for ids in side], dtype=np.int64) for side in (a, b))
        return (np.concatenate(a), n_a), (_flat(b), n_b)


def _bytes_of(token_bytes: list[bytes], ids: list[int]) -> bytes:
    return b"".join(map(token_bytes.__getitem__, ids))


_LOADED: dict[tuple[str, str], Tokenizers] = {}


def tokenizers_for(a_file: str, b_file: str) -> Tokenizers:
    """Both tokenizers, loaded once per Python worker."""
    if (a_file, b_file) not in _LOADED:
        _LOADED[a_file, b_file] = Tokenizers(a_file, b_file)
    return _LOADED[a_file, b_file]


def path_borders(a_ends: np.ndarray, b_ends: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Items taken from either list after every `steps` steps of their merge (equal ends: A first), without merging.

    On diagonal d the path passes where i items of A and d - i of B are taken; i is the smallest for which the next A item is
    greater than the last B item. All diagonals are searched at once.
    """
    a_count, b_count = len(a_ends), len(b_ends)
    total = a_count + b_count
    diagonals = np.append(np.arange(0, total, steps), total)
    low, high = np.maximum(0, diagonals - b_count), np.minimum(diagonals, a_count)
    while (open_ := low < high).any():
        middle = (low[open_] + high[open_]) // 2
        right = a_ends[middle] <= b_ends[diagonals[open_] - middle - 1]
        low[open_] = np.where(right, middle + 1, low[open_])
        high[open_] = np.where(right, high[open_], middle)
    return low, diagonals - low


def merge_share(a_ends: np.ndarray, b_ends: np.ndarray, share: tuple[int, int, int, int]) -> tuple[np.ndarray, ...]:
    """Overlaps of one share: where each ends, its A and B token, and whether an A and whether a B token ends there."""
    a_from, a_to, b_from, b_to = share
    own_a, own_b = a_ends[a_from:a_to], b_ends[b_from:b_to]
    ends = np.concatenate([own_a, own_b])
    ends.sort(kind="stable")  # two sorted runs
    ends = ends[np.concatenate([[True], ends[1:] != ends[:-1]])] if len(ends) else ends
    a_at, b_at = np.searchsorted(own_a, ends), np.searchsorted(own_b, ends)
    is_a, is_b = (
        (own[np.minimum(at, len(own) - 1)] == ends) & (at < len(own)) if len(own) else np.zeros(len(ends), dtype=bool)
        for own, at in ((own_a, a_at), (own_b, b_at))
    )
    return ends, a_from + a_at, b_from + b_at, is_a, is_b


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray, steps: int = SHARE_STEPS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs of overlapping tokens in order: A token, B token, and whether both end at the pair's end.

    Both lists have to end at the same place. Tokens of no bytes overlap nothing.
    """
    a_border, b_border = path_borders(a_ends, b_ends, steps)
    borders = zip(a_border[:-1], a_border[1:], b_border[:-1], b_border[1:])
    shares = [merge_share(a_ends, b_ends, share) for share in borders]
    if not shares:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    ends, a_at, b_at, is_a, is_b = (np.concatenate(parts) for parts in zip(*shares))
    # An end of A as the last step of a share and the same end of B as the first step of the next are one.
    again = np.concatenate([[False], ends[1:] == ends[:-1]])
    places = np.flatnonzero(again)
    is_a[places - 1] |= is_a[places]
    is_b[places - 1] |= is_b[places]
    return a_at[~again], b_at[~again], (is_a & is_b)[~again]


def _written_groups(loaded: Tokenizers, a: np.ndarray, b: np.ndarray, a_at, b_at, shared) -> list[str]:
    """Every token's id with what follows it, group by group, A before B."""
    group_of_link = np.cumsum(shared) - shared
    group_a, group_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    # The last link of a token is the one in which it ends; a token lies in one group only.
    group_a[a_at], group_b[b_at] = group_of_link, group_of_link
    last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    last_a[a_at[shared]], last_b[b_at[shared]] = 1, 2
    codes = np.concatenate([a + loaded.id_range * last_a, b + loaded.id_range * last_b])
    order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
    return loaded.written[codes[order]].tolist()


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=sum(map(len, lists)))


def _lists(values: np.ndarray, counts: np.ndarray, kind) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


ALIGNED_DDL = (
    "batch long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<int>, times array<int>, "
    "known array<long>, known_times array<long>"
)


def _align_batch(loaded: Tokenizers, texts: list[str], batch: int) -> list[pa.Array]:
    (a, n_a), (b, n_b) = loaded.encode(texts)
    a_at, b_at, shared = overlaps(np.cumsum(loaded.a_sizes[a]), np.cumsum(loaded.b_sizes[b]))
    written = _written_groups(loaded, a, b, a_at, b_at, shared)
    stops = np.cumsum(n_a + n_b).tolist()
    groups = ["".join(written[start:stop])[:-1] for start, stop in zip([0, *stops], stops)]

    documents = len(texts)
    doc = np.repeat(np.arange(documents), n_a)[a_at]
    known, pair, known_times = np.unique((a[a_at] << _B_BITS) | b[b_at], return_inverse=True, return_counts=True)
    own, times = np.unique(doc * max(1, len(known)) + pair, return_counts=True)
    own_doc, own_pair = own // max(1, len(known)), own % max(1, len(known))
    own_counts = np.bincount(own_doc, minlength=documents)
    # The batch's list of pairs goes with its first document.
    first = [len(known)] + [0] * (documents - 1)
    is_first = pa.array([False] + [True] * (documents - 1))

    def with_first(values: np.ndarray) -> pa.Array:
        offsets = np.concatenate([[0], np.cumsum(first)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=pa.int64()), mask=is_first)

    return [
        pa.array([batch] * documents, type=pa.int64()),
        pa.array(n_a),
        pa.array(n_b),
        pa.array(np.bincount(doc[shared], minlength=documents).astype(np.int64)),
        pa.array(np.bincount(doc, minlength=documents).astype(np.int64)),
        pa.array(groups, type=pa.string()),
        _lists(own_pair, own_counts, pa.int32()),
        _lists(times, own_counts, pa.int32()),
        with_first(known),
        with_first(known_times),
    ]


def align_tokens(docs: DataFrame, a_file: str, b_file: str, batch_chars: int = BATCH_CHARS) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `n_a`, `n_b`, `n_groups`, `n_links` and `groups`, and columns for `count_links`.

    A encodes a space and the text, B the text; both without special tokens, whose strings are plain text. `groups` lists the ids
    between places where tokens of both end: `a1,a2|b1;a3|b2`. A null or empty text, and one whose tokens do not put together to
    its bytes behind a space on either side, has no tokens: counts of zero and empty `groups`. Repeated rows are aligned each
    for itself; further columns are not read. Both files exist on every executor.

    `batch` numbers the documents that were aligned together. `pairs` and `times` list a document's linked id pairs and how
    often each is linked, by place in the batch's list `known` (`a << 32 | b`, with `known_times`), which stands in the
    first row of the batch.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", *(part.strip().split(" ")[0] for part in ALIGNED_DDL.split(","))]

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = tokenizers_for(a_file, b_file)
        # The same in every attempt of a task, and of no other task.
        number = TaskContext.get().partitionId() << 40
        for rows in batches:
            texts = [text or "" for text in rows.column("text").to_pylist()]
            start = 0
            while start < len(texts):
                stop, held = start + 1, len(texts[start])
                while stop < len(texts) and held + len(texts[stop]) <= batch_chars:
                    held += len(texts[stop])
                    stop += 1
                columns = _align_batch(loaded, texts[start:stop], number)
                yield pa.RecordBatch.from_arrays([rows.column("doc_id").slice(start, stop - start), *columns], names)
                number, start = number + 1, stop

    return docs.select("doc_id", "text").mapInArrow(align, f"doc_id {id_type}, {ALIGNED_DDL}")


def count_links(aligned: DataFrame) -> DataFrame:
    """Rows of `align_tokens` with `n_best` and `count_sum` in place of the columns that describe links.

    The count of an id pair is the number of links of the corpus that hold it. `n_best` counts a document's links whose pair has
    the highest count of all pairs with its B id (ties included), `count_sum` adds up the counts over its links. Columns that were
    added to `aligned` stay.

    Pairs are counted by batch before they are shuffled: each batch sends every pair once, however hot it is, and its documents
    stay together. A batch holds a bounded number of characters, or one document.
    """
    work = Workspace(aligned.sparkSession, "token_alignment")
    aligned = work.write(aligned, "aligned")
    entry = F.posexplode(F.arrays_zip("known", "known_times")).alias("place", "entry")
    listed = aligned.where("known IS NOT NULL").select("batch", entry)
    listed = listed.select("batch", "place", F.col("entry.known").alias("pair"), F.col("entry.known_times").alias("n"))
    totals = listed.groupBy("pair").agg(F.sum("n").alias("total"))
    totals = work.write(totals.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << _B_BITS) - 1))), "totals")
    highest = totals.groupBy("b").agg(F.max("total").alias("highest"))
    judged = totals.join(highest, "b").select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))
    figures = listed.join(judged, "pair").select(F.col("batch").alias("of_batch"), "place", "total", "best")

    carried = [c for c in aligned.columns if c not in ("batch", "pairs", "times", "known", "known_times")]
    fields = {f.name: f.dataType.simpleString() for f in aligned.schema}
    schema = ", ".join(f"`{c}` {fields[c]}" for c in carried) + ", n_best long, count_sum long"

    def score(documents: pa.Table, pairs: pa.Table) -> pa.Table:
        size = pairs.num_rows
        total, best = np.zeros(size + 1, np.int64), np.zeros(size + 1, np.int64)
        place = pairs.column("place").to_numpy()
        total[place] = pairs.column("total").to_numpy()
        best[place] = pairs.column("best").to_numpy().astype(np.int64)
        lists = documents.column("pairs").combine_chunks()
        counts = np.diff(lists.offsets.to_numpy())
        own = lists.flatten().to_numpy()
        times = documents.column("times").combine_chunks().flatten().to_numpy().astype(np.int64)
        row = np.repeat(np.arange(len(counts)), counts)
        n_best, count_sum = np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64)
        np.add.at(n_best, row, times * best[own])
        np.add.at(count_sum, row, times * total[own])
        kept = documents.select(carried)
        return kept.append_column("n_best", pa.array(n_best)).append_column("count_sum", pa.array(count_sum))

    per_batch = aligned.select("batch", "pairs", "times", *carried).groupBy("batch")
    return per_batch.cogroup(figures.groupBy("of_batch")).applyInArrow(score, schema)
