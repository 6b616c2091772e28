"""Byte-level byte-pair encoding and decoding of whole texts by a table of ranks.

Long texts are cut into chunks that overlap. Each chunk is split into pre-tokens by itself, from a start that may lie inside one.
The pattern never looks back, so two chunks that have a boundary at the same place agree on everything behind it: at the first
such place in their overlap they are stitched, and every chunk encodes its pre-tokens between its two stitches. Where an
overlap has no common boundary (one pre-token longer than the overlap), the text is split from its start in one piece.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendmill.llm.common import Workspace, fresh_name

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 2_048
# What a match may look at behind its start, for alternatives that are shorter than their text (contractions).
LOOKAHEAD = 3
MEMO_WORDS = 400_000


class RankEncoder(dict):
    """Ids of pre-tokens, as little-endian unsigned 32-bit integers; filled when asked, emptied when full."""

    def __init__(self, ranks_file: str):
        import public_tokenizers
        import regex

        super().__init__()
        with open(ranks_file, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        if not all(bytes([b]) in self.ranks for b in range(256)):
            raise ValueError(f"{ranks_file}: single bytes are missing, texts could not be encoded")
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.split = self.pattern.findall

    def __missing__(self, word: str) -> bytes:
        ids = self.merge(word.encode("utf-8", "surrogatepass"))
        packed = np.array(ids, dtype="<u4").tobytes()
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = packed
        return packed

    def merge(self, data: bytes) -> list[int]:
        """Ids of one pre-token: the adjacent pair of the lowest rank is merged first, the leftmost of equal ones."""
        ranks = self.ranks
        if data in ranks:
            return [ranks[data]]
        parts: list[bytes | None] = [data[i : i + 1] for i in range(len(data))]
        end = len(parts)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        heap = [
            (ranks[pair], i, pair) for i in range(end - 1) if (pair := data[i : i + 2]) in ranks
        ]
        heapq.heapify(heap)
        while heap:
            _, i, merged = heapq.heappop(heap)
            j = after[i]
            # Either side may have become part of another token since.
            if parts[i] is None or j >= end or len(parts[i]) + len(parts[j]) != len(merged) or parts[i] + parts[j] != merged:
                continue
            parts[i], parts[j] = merged, None
            after[i] = k = after[j]
            if k < end:
                before[k] = i
                if (pair := merged + parts[k]) in ranks:
                    heapq.heappush(heap, (ranks[pair], i, pair))
            h = before[i]
            if h >= 0 and (pair := parts[h] + merged) in ranks:
                heapq.heappush(heap, (ranks[pair], h, pair))
        return [ranks[part] for part in parts if part is not None]

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.split(text)))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, dtype="<u4").tolist()))

    def spans(self, chunk: str, is_last: bool) -> tuple[list[str], np.ndarray, int]:
        """Pre-tokens of a chunk, where each begins, and how many of them do not depend on what follows the chunk."""
        words = self.split(chunk)
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))
        starts = np.concatenate([np.zeros(1, dtype=np.int64), ends])
        if is_last:
            return words, starts, len(words)
        sure = (ends < len(chunk)) & (starts[:-1] + LOOKAHEAD <= len(chunk))
        return words, starts, int(np.argmin(sure)) if not sure.all() else len(words)


_ENCODERS: dict[str, RankEncoder] = {}


def encoder_for(ranks_file: str) -> RankEncoder:
    """The table's encoder, loaded once per Python worker."""
    if ranks_file not in _ENCODERS:
        _ENCODERS[ranks_file] = RankEncoder(ranks_file)
    return _ENCODERS[ranks_file]


def encode_texts(
    docs: DataFrame, ranks_file: str, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS
) -> DataFrame:
    """One row per row of `docs`: `doc_id` and `ids`, the whole text's token ids as little-endian unsigned 32-bit integers.

    A null text is empty and has no ids. Repeated rows, and rows with the same or no id, are encoded each for itself; further
    columns are not read, whatever their names. `ranks_file` is a path that exists on every executor. Texts up to `chunk_chars`
    are encoded where they are read; chunks of longer ones are dealt over all tasks and their ids put together per text.
    """
    if not 0 < overlap_chars <= chunk_chars:
        raise ValueError("overlap_chars has to be between 1 and chunk_chars")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def encode_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(ranks_file)
        for batch in batches:
            ids = pa.array([encoder.encode(text) for text in batch.column("text").to_pylist()], type=pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    short = rows.where(F.length("text") <= chunk_chars).mapInArrow(encode_whole, f"doc_id {id_type}, ids binary")
    return short.unionByName(_encode_long(rows, id_type, ranks_file, chunk_chars, overlap_chars))


def _encode_long(rows: DataFrame, id_type: str, ranks_file: str, size: int, overlap: int) -> DataFrame:
    work = Workspace(rows.sparkSession, "byte_bpe")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column("text")[i].as_py()
                starts = range(0, len(text), size)
                chunks = [text[s : s + size + overlap] for s in starts]
                count = len(chunks)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column("row_id")[i].as_py()] * count, type=pa.int64()),
                        pa.array(range(count), type=pa.int32()),
                        pa.array([s + size >= len(text) for s in starts], type=pa.bool_()),
                        pa.array(chunks, type=pa.string()),
                    ],
                    ["row_id", "chunk", "is_last", "text"],
                )

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sure boundaries in the overlap with the chunk before and in the one with the chunk behind."""
        encoder = encoder_for(ranks_file)
        for batch in batches:
            heads, tails = [], []
            chunks = zip(batch.column("chunk").to_pylist(), batch.column("is_last").to_pylist(), batch.column("text").to_pylist())
            for chunk, is_last, text in chunks:
                _, starts, sure = encoder.spans(text, is_last)
                places = starts[: sure + 1]
                heads.append((places[places < overlap] + chunk * size).tolist())
                tails.append((places[places >= size] + chunk * size).tolist())
            arrays = [batch.column("row_id"), batch.column("chunk")]
            arrays += [pa.array(side, type=pa.list_(pa.int64())) for side in (heads, tails)]
            yield pa.RecordBatch.from_arrays(arrays, ["row_id", "chunk", "head", "tail"])

    def encode_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ids between the stitches; a text that could not be stitched sends the chunk's own characters on."""
        encoder = encoder_for(ranks_file)
        for batch in batches:
            ids, texts = [], []
            for row in batch.to_pylist():
                if row["lost"]:
                    ids.append(None)
                    texts.append(row["text"] if row["is_last"] else row["text"][:size])
                    continue
                words, starts, _ = encoder.spans(row["text"], row["is_last"])
                offset = row["chunk"] * size
                first = int(np.searchsorted(starts, row["begins"] - offset))
                behind = len(words) if row["ends"] is None else int(np.searchsorted(starts, row["ends"] - offset))
                ids.append(b"".join(map(encoder.__getitem__, words[first:behind])))
                texts.append(None)
            arrays = [batch.column("row_id"), batch.column("chunk"), pa.array(ids, type=pa.binary()), pa.array(texts, type=pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["row_id", "chunk", "ids", "part"])

    def put_together(pieces: pa.Table) -> pa.Table:
        """One text: its pieces in order, or its characters in order, encoded from the start."""
        pieces = pieces.sort_by("chunk")
        if pieces.column("part")[0].is_valid:
            ids = encoder_for(ranks_file).encode("".join(pieces.column("part").to_pylist()))
        else:
            ids = b"".join(pieces.column("ids").to_pylist())
        row_id = pieces.column("row_id")[0].as_py()
        return pa.table({"row_id": pa.array([row_id], type=pa.int64()), "ids": pa.array([ids], type=pa.binary())})

    # Ids of rows are fixed before anything is shuffled, and stored with the chunks.
    numbered = rows.where(F.length("text") > size).select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "text")
    numbered = work.write(numbered, "long")
    chunks = numbered.select("row_id", "text").mapInArrow(cut, "row_id long, chunk int, is_last boolean, text string")
    chunks = work.write(chunks.repartition("row_id", "chunk"), "chunks")
    # Only boundaries of overlaps are ordered per text: a few numbers per chunk.
    in_order = Window.partitionBy("row_id").orderBy("chunk")
    places = chunks.mapInArrow(bounds, "row_id long, chunk int, head array<long>, tail array<long>")
    met = F.array_min(F.array_intersect("head", F.lag("tail").over(in_order)))
    stitched = places.select("row_id", "chunk", F.when(F.col("chunk") == 0, F.lit(0)).otherwise(met).alias("begins"))
    stitched = stitched.select("*", F.lead("begins").over(in_order).alias("ends"))
    stitched = work.write(stitched, "stitches")
    lost = stitched.where("begins IS NULL").select("row_id").distinct().withColumn("lost", F.lit(True))
    stitched = stitched.join(lost, "row_id", "left").withColumn("lost", F.coalesce("lost", F.lit(False)))
    pieces = chunks.join(stitched, ["row_id", "chunk"]).mapInArrow(
        encode_pieces, "row_id long, chunk int, ids binary, part string"
    )
    whole = pieces.groupBy("row_id").applyInArrow(put_together, "row_id long, ids binary")
    return numbered.select("row_id", "doc_id").join(whole, "row_id").select("doc_id", "ids")


def decode_ids(encoded: DataFrame, ranks_file: str) -> DataFrame:
    """`encoded` with the column `decoded`: the bytes of all its tokens, put together. A null `ids` decodes to null.

    The bytes need not be UTF-8 when ids were cut; those of `encode_texts` give back the text exactly. Columns of other names
    stay as they are; a column `decoded` that is already there keeps its place, and the new one gets a free name.
    """
    name = fresh_name(encoded, "decoded")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema) + f", `{name}` binary"

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(ranks_file)
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            decoded = pa.array([None if i is None else encoder.decode(i) for i in ids], type=pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], [*batch.schema.names, name])

    return encoded.mapInArrow(decode, schema)
