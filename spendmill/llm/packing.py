"""Best-two-fit packing of tokenized documents into sequences of bounded length.

Long documents are cut; every piece is an item. Items are dealt evenly into groups of bounded size, and every group is
packed on its own: a bin takes the longest item that fits until none does, then its smallest item is exchanged for two
unpacked ones that together fit the widened gap more tightly. A group wastes about one bin in thousands.
"""

from __future__ import annotations

import os
import string
import zlib
from collections.abc import Iterator
from itertools import chain
from math import ceil
from unicodedata import normalize

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendmill.llm.common import Workspace

MEMO_WORDS = 500_000
LINE_PARTS = 100
GROUP_ITEMS = 8192
GROUPS_PER_TASK = 64
# Characters that the tokenizer's own pattern treats as white space, without those that only Python does.
PYTHON_ONLY_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")
# ASCII punctuation but the apostrophe, which can begin a token with letters.
TAIL = string.punctuation.replace("'", "")


class Numbered(dict):
    """Numbers in order of first sight; `new` holds the keys numbered since it was last taken."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self.new.append(key)
        number = self[key] = len(self)
        return number

    def take_new(self) -> list[str]:
        new, self.new = self.new, []
        return new


class WordIds:
    """Ids of texts by way of the parts of their words, each tokenized once and kept in a bounded memo.

    The tokenizer drops white space and no token spans it, so a text's ids are those of its words one after another. Nor
    does a token span the border between letters and the punctuation after them, so such a word has two parts.
    """

    def __init__(self, model_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(model_file)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._empty()

    def _empty(self) -> None:
        self.words_seen, self.parts_seen = Numbered(), Numbered()
        self.parts_of = np.zeros((0, 2), np.int32)
        # Of each part: where its ids start in `ids`, and how many they are.
        self.ids, self.starts, self.lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def words(self, text: str) -> list[str]:
        if any(c in text for c in PYTHON_ONLY_SPACE):
            held = text.translate({ord(c): 0xF0000 + i for i, c in enumerate(PYTHON_ONLY_SPACE)})
            back = {0xF0000 + i: c for i, c in enumerate(PYTHON_ONLY_SPACE)}
            if not any(chr(c) in text for c in back):
                return [w.translate(back) for w in held.split()]
            return [text]
        return text.split()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.words_seen) > MEMO_WORDS:
            self._empty()
        number = self.words_seen.__getitem__
        numbers = [np.fromiter(map(number, words), np.int64, len(words)) for words in map(self.words, texts)]
        self._learn(self.words_seen.take_new())
        return [self._joined(at) for at in numbers]

    def _learn(self, words: list[str]) -> None:
        part = self.parts_seen.__getitem__
        known = len(self.starts)
        parts_of = np.full((len(words), 2), -1, np.int32)
        whole: list[int] = []
        for at, word in enumerate(words):
            letters = word.rstrip(TAIL)
            # The tokenizer composes and lower-cases first; both can turn a letter into a letter and a mark.
            plain = letters.lower() if letters.isascii() else normalize("NFC", letters).lower()
            if plain.isalpha():
                parts_of[at, 0] = part(plain if letters.isascii() else letters)
                if len(letters) < len(word):
                    parts_of[at, 1] = part(word[len(letters) :])
            else:
                parts_of[at, 0] = part(word)
                whole.append(parts_of[at, 0])
        self.parts_of = np.concatenate([self.parts_of, parts_of])
        new = self.parts_seen.take_new()
        alone = np.zeros(len(new), bool)
        alone[[n - known for n in whole if n >= known]] = True
        self.starts, self.lengths = (np.append(c, np.zeros(len(new), np.int64)) for c in (self.starts, self.lengths))
        for own, tokenized in ((np.flatnonzero(~alone), self._of_plain), (np.flatnonzero(alone), self._of_each)):
            ids, lengths = tokenized([new[i] for i in own])
            self.starts[known + own] = len(self.ids) + np.cumsum(lengths) - lengths
            self.lengths[known + own] = lengths
            self.ids = np.concatenate([self.ids, ids])

    def _of_each(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the parts one after another, and how many each has."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum())), lengths

    def _of_plain(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for parts that are one word to the tokenizer, many of them in a line: each ends with a token that says so."""
        ids, _ = self._of_each([" ".join(parts[at : at + LINE_PARTS]) for at in range(0, len(parts), LINE_PARTS)])
        ends = np.flatnonzero(self.ends_word[ids])
        return (ids, np.diff(ends, prepend=-1)) if len(ends) == len(parts) else self._of_each(parts)

    def _joined(self, words: np.ndarray) -> np.ndarray:
        at = self.parts_of[words].ravel()
        at = at[at >= 0]
        first = self.starts[at]
        lengths = self.lengths[at]
        ends = np.cumsum(lengths)
        steps = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - lengths), lengths)
        return self.ids[steps]


_WORD_IDS: dict[str, WordIds] = {}


def word_ids(model_file: str) -> WordIds:
    if model_file not in _WORD_IDS:
        _WORD_IDS[model_file] = WordIds(model_file)
    return _WORD_IDS[model_file]


def tokenized_pieces(docs: DataFrame, model_file: str, limit: int, end_id: int = 0) -> DataFrame:
    """Pieces of every document: its ids, then `end_id`, cut only where it is longer than `limit`."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = word_ids(model_file)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                rows = []
                for doc, ids in zip(part["doc_id"], encoder.encode([t or "" for t in part["text"]])):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for piece, start in enumerate(range(0, len(ids), limit)):
                        own = ids[start : start + limit]
                        rows.append((doc, piece, start, len(own), zlib.crc32(own.tobytes())))
                yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    ddl = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long"
    return docs.select("doc_id", "text").mapInPandas(cut, ddl)


def best_two_fit(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every item; all lengths lie between 1 and `limit`."""
    order = np.argsort(lengths, kind="stable")
    waiting = np.bincount(lengths, minlength=limit + 1)
    # Items of a length lie together in `order`; `top` is the end of those not yet packed.
    top = np.cumsum(waiting)
    sizes = np.flatnonzero(waiting)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    left, bin_id = len(lengths), 0

    def take(size: int) -> None:
        nonlocal sizes
        waiting[size] -= 1
        if waiting[size] == 0:
            sizes = sizes[sizes != size]

    while left:
        content: list[int] = []
        gap = limit
        while (fits := int(np.searchsorted(sizes, gap, side="right"))) > 0:
            size = int(sizes[fits - 1])
            take(size)
            content.append(size)
            gap -= size
        if gap and len(content) > 1:
            smallest = content[-1]
            pair = best_pair(sizes, waiting, smallest + gap)
            if pair and sum(pair) > smallest:
                content.pop()
                if waiting[smallest] == 0:
                    sizes = np.sort(np.append(sizes, smallest))
                waiting[smallest] += 1
                for size in pair:
                    take(size)
                    content.append(size)
        place = 0
        for size in content:
            top[size] -= 1
            item = order[top[size]]
            bins[item], offsets[item] = bin_id, place
            place += size
        left -= len(content)
        bin_id += 1
    return bins, offsets


def best_pair(sizes: np.ndarray, waiting: np.ndarray, room: int) -> tuple[int, int] | None:
    """Two unpacked lengths with the largest sum within `room`."""
    first = sizes[sizes < room]
    if not len(first):
        return None
    at = np.searchsorted(sizes, room - first, side="right") - 1
    usable = at >= 0
    first, at = first[usable], at[usable]
    second = sizes[at]
    # A length can only stand twice if two items have it; the next smaller one is tried instead.
    alone = (second == first) & (waiting[first] < 2)
    at = at - alone
    first, second = first[at >= 0], sizes[np.maximum(at, 0)][at >= 0]
    if not len(first):
        return None
    best = int(np.argmax(first + second))
    return int(first[best]), int(second[best])


def even_groups(batches: Iterator[pd.DataFrame], items: int) -> Iterator[pd.DataFrame]:
    """The rows of a task in groups of `items`; the last has between half and one and a half times as many, if there are as many.

    Fewer than two groups and a batch are held.
    """
    held, rows = [], 0
    for batch in batches:
        if len(batch):
            held.append(batch)
            rows += len(batch)
        if rows >= 2 * items:
            frame = pd.concat(held, ignore_index=True)
            while len(frame) >= 2 * items:
                yield frame.iloc[:items].reset_index(drop=True)
                frame = frame.iloc[items:]
            held, rows = [frame], len(frame)
    if rows:
        frame = pd.concat(held, ignore_index=True)
        cut = rows if 2 * rows <= 3 * items else items
        yield frame.iloc[:cut]
        if cut < rows:
            yield frame.iloc[cut:].reset_index(drop=True)


def pack_documents(docs: DataFrame, model_file: str, limit: int = 2048, end_id: int = 0) -> DataFrame:
    """One row per piece of `docs` (`doc_id`, `text`) with its sequence and its place there.

    Columns: `doc_id`, `piece`, `start`, `length`, `ids_crc32`, `sequence_id`, `offset`. A null or empty text is a document
    of `end_id` alone. Repeated rows are packed each for itself; further columns are not read; an empty table gives none.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "packing")
    pieces = work.write(tokenized_pieces(docs, model_file, limit, end_id), "pieces")
    groups = max(1, ceil(pieces.count() / GROUP_ITEMS))
    # A task packs many groups one after the other: tasks multiply far more slowly than the data.
    tasks = min(groups, max(ceil(groups / GROUPS_PER_TASK), int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sequence = TaskContext.get().partitionId() << 32
        for group in even_groups(batches, GROUP_ITEMS):
            bins, offsets = best_two_fit(group["length"].to_numpy(), limit)
            yield group.assign(sequence_id=bins + sequence, offset=offsets)
            sequence += int(bins.max()) + 1

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return pieces.repartition(tasks).mapInPandas(pack, f"{schema}, sequence_id long, offset long")
