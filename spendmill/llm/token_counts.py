"""Token counts by byte-pair merging with a heap over a linked list; no token id is ever made.

A text is counted piece by piece: no entry of the vocabulary holds a word mark behind another character (checked when the
model is loaded), so no merge crosses the start of a word, and equal words have equal counts. Counts of words are kept per
Python worker in a bounded memo; a full memo is emptied, which costs time and never changes a count.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

MARK = "▁"
MEMO_WORDS = 600_000
_SEGMENTS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class Memo(dict):
    """Count of a segment behind `prefix`, computed when first asked for."""

    def __init__(self, counter: PieceCounter, prefix: str):
        super().__init__()
        self.counter, self.prefix = counter, prefix

    def __missing__(self, word: str) -> int:
        count = self.counter.merge(self.prefix + word)
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = count
        return count


class PieceCounter:
    """Counts as the given byte-pair model (byte fallback, dummy word mark in front) would split a text."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        plain = [
            i
            for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        # Lowest rank merges first; equal scores keep equal ranks, and the leftmost pair goes first.
        self.rank = {model.id_to_piece(i): -model.get_score(i) for i in plain}
        if any(MARK in piece.lstrip(MARK) for piece in self.rank):
            raise ValueError("pieces that span words are not supported")
        self.marked, self.bare = Memo(self, MARK), Memo(self, "")

    def weight(self, symbol: str) -> int:
        """Tokens of an unmerged character: one, or its bytes where the vocabulary lacks it."""
        return 1 if symbol in self.rank else len(symbol.encode("utf-8", "surrogatepass"))

    def merge(self, segment: str) -> int:
        """Initial symbols minus merges."""
        rank = self.rank
        symbols = list(segment)
        n = len(symbols)
        count = sum(map(self.weight, symbols))
        heap = []
        for i in range(n - 1):
            r = rank.get(symbols[i] + symbols[i + 1])
            if r is not None:
                heap.append((r, i, symbols[i] + symbols[i + 1]))
        if not heap:
            return count
        heapq.heapify(heap)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        while heap:
            _, i, piece = heapq.heappop(heap)
            first = symbols[i]
            j = right[i]
            # Stale: one of the two was merged into something else meanwhile.
            if not first or j >= n or len(first) + len(symbols[j]) != len(piece) or first + symbols[j] != piece:
                continue
            symbols[i], symbols[j] = piece, ""
            count -= 1
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                r = rank.get(piece + symbols[k])
                if r is not None:
                    heapq.heappush(heap, (r, i, piece + symbols[k]))
            h = left[i]
            if h >= 0:
                r = rank.get(symbols[h] + piece)
                if r is not None:
                    heapq.heappush(heap, (r, h, symbols[h] + piece))
        return count

    def count(self, text: str) -> int:
        if not text:
            return 0
        total = 0
        # Line feeds are in no piece: each is one byte token and separates segments.
        lines = (MARK + text.replace(" ", MARK)).split("\n")
        if "\n" in self.rank:
            lines = ["\n".join(lines)]
        for line in lines:
            if MARK + MARK in line:
                total += sum(map(self.bare.__getitem__, _SEGMENTS.findall(line)))
            elif line:
                head, *words = line.split(MARK)
                total += sum(map(self.marked.__getitem__, words))
                if head:
                    total += self.bare[head]
        return total + len(lines) - 1


_COUNTERS: dict[str, PieceCounter] = {}


def counter_for(model_file: str) -> PieceCounter:
    """The model's counter, loaded once per Python worker."""
    if model_file not in _COUNTERS:
        _COUNTERS[model_file] = PieceCounter(model_file)
    return _COUNTERS[model_file]


def count_tokens(docs: DataFrame, model_file: str) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `n_bytes` (UTF-8) and `n_tokens` of the whole text, without special tokens.

    A null text is an empty text: no bytes, no tokens. Repeated rows count each for itself; further columns are not read.
    `model_file` is a path that exists on every executor.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = counter_for(model_file)
        for batch in batches:
            texts = [text or "" for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "n_bytes": [len(t.encode("utf-8", "surrogatepass")) for t in texts],
                    "n_tokens": [counter.count(t) for t in texts],
                }
            )

    return docs.select("doc_id", "text").mapInPandas(counted, f"doc_id {id_type}, n_bytes long, n_tokens long")
