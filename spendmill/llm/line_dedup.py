"""Removal of line blocks that the corpus repeats (built-in functions only).

A text is cut into chunks of lines at places that its content chooses: a rolling hash over the hashes of two neighbouring
lines stands for the place between them, and a place is a boundary if its value is smaller than those beside it. A line
inserted anywhere therefore moves no boundary beyond its own neighbourhood, and a chunk has two lines or more. A second
chunking takes the largest values instead, so that a block whose ends fall badly in one is cut differently in the other. In a
run of equal lines, which has no smallest value, every second place is a boundary. Chunks of one line exist only in texts of
one line and at the ends of such runs; they are never removed.

Chunks with equal hashes are compared byte by byte, in groups of (hash, chunk text). Of each group of equal chunks the first
stays: the one of the smallest document id (null last), then text key, then place; all others are removed. Chunks of the two
chunkings may overlap; every removed line then has an equal line before it in that order, so one copy of each line stays.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendmill.llm.common import Workspace, fresh_name, text_key

BASE = 1_000_003
PRIME = 2_147_483_647
KEY = ["d", "k1", "k2"]


def chunks_of(lines: str, line_hashes: str) -> Column:
    """Array of (start, len): the chunks of both chunkings, each of which covers all lines. Both arguments name columns.

    The end of the text closes a chunk; a boundary one line after the start or before the end does not count, which keeps the
    first and the last chunk long.
    """
    n = f"size({lines})"
    values = (
        f"zip_with(slice({line_hashes}, 1, {n} - 1), slice({line_hashes}, 2, {n} - 1), (a, b) -> (a * {BASE}L + b) % {PRIME}L)"
    )

    def chunking(less: str) -> str:
        here, before, after = "get(values, i)", "get(values, i - 1)", "get(values, i + 1)"
        ends = (
            f"filter(sequence(0, {n} - 1), i -> i = {n} - 1 or (i >= 1 and i <= {n} - 3 and"
            f" (({here} {less} {before} and {here} {less}= {after}) or ({here} = {before} and i % 2 = 1))))"
        )
        return (
            f"transform(array({ends}), ends -> transform(ends, (e, k) -> named_struct('start', if(k = 0, 0, get(ends, k - 1) + 1),"
            " 'len', e - if(k = 0, -1, get(ends, k - 1)))))[0]"
        )

    return F.expr(f"transform(array({values}), values -> array_union({chunking('<')}, {chunking('>')}))[0]")


def chunked(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Per row: its key (document id and text key), the multi-line chunks with their hashes, and the columns to `carry`."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return (
        docs.select(F.col("doc_id").alias("d"), text.alias("text"), *carry)
        .withColumns(dict(zip(("k1", "k2"), text_key(F.col("text")))))
        .withColumn("lines", F.split("text", "\n", -1))
        .withColumn(
            "hashes", F.expr("transform(lines, l -> cast(conv(substring(md5(l), 1, 7), 16, 10) as bigint))")
        )
        .withColumn("chunks", chunks_of("lines", "hashes"))
    )


def _chunk_text() -> Column:
    return F.array_join(F.slice("lines", F.col("c.start") + 1, F.col("c.len")), "\n")


def _first(columns: list[str]) -> Column:
    """Order of copies: document id with null last, then the rest."""
    return F.struct(F.col("d").isNull(), *columns)


def repeated_chunks(docs: DataFrame, work: Workspace) -> DataFrame:
    """(key, chunks to remove) of all documents that lose a chunk."""
    place = [*KEY, "start"]
    # explode_outer: for explode, the optimizer would add a filter on the whole chunking expression and compute it twice.
    split = chunked(docs).select(*KEY, "lines", F.explode_outer("chunks").alias("c")).where("c.len > 1")
    hashed = work.write(split.select(*KEY, "c.start", F.md5(_chunk_text()).alias("hash")), "chunks")
    # Copies of one hash: map-side combining meets every hot chunk before the shuffle.
    twice = (
        hashed.groupBy("hash")
        .agg(F.min(_first(place)).alias("a"), F.max(_first(place)).alias("b"))
        .where(~F.col("a").eqNullSafe(F.col("b")))
        .select("hash")
    )
    # Written first, as `kept` below: joins of two plain exchanges let AQE split a hot chunk.
    twice = work.write(twice, "twice")
    starts = hashed.join(twice, "hash", "left_semi").groupBy(*KEY).agg(F.collect_set("start").alias("starts"))
    # The plain texts are shuffled and split into lines again behind the join: lines and chunks take several times their room.
    # Merge joins at any size: what is joined grows with the corpus.
    keyed = docs.select(F.col("doc_id").alias("d"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = keyed.withColumns(dict(zip(("k1", "k2"), text_key(F.col("text")))))
    joined = _by_key(keyed, starts.hint("merge"), "inner")
    candidates = work.write(
        chunked(joined.withColumnRenamed("d", "doc_id").drop("k1", "k2"), ["starts"])
        .select(*KEY, "lines", F.explode_outer(F.filter("chunks", lambda c: F.array_contains("starts", c.start))).alias("c"))
        .select(*KEY, F.col("c.start").alias("start"), F.col("c.len").alias("len"), _chunk_text().alias("chunk"))
        .withColumn("hash", F.md5("chunk")),
        "candidates",
    )
    # Equal bytes, not only equal hashes.
    kept = (
        candidates.groupBy("hash", "chunk")
        .agg(F.min(_first(place)).alias("first"), F.max(_first(place)).alias("last"))
        .where(~F.col("first").eqNullSafe(F.col("last")))
        .select("hash", "chunk", "first")
    )
    removed = candidates.join(work.write(kept, "kept"), ["hash", "chunk"]).where(~_first(place).eqNullSafe(F.col("first")))
    work.drop("chunks", "twice")
    return _spans(removed).groupBy(*KEY).agg(F.collect_set(F.struct("start", "len")).alias("removed"))


def _spans(removed: DataFrame) -> DataFrame:
    """(key, start, len) of the maximal runs of lines that the given chunks cover. A window holds the chunks of one document."""
    end = F.col("start") + F.col("len")
    document = Window.partitionBy(*KEY).orderBy("start", "len")
    reached = F.max(end).over(document.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("start") > F.col("reached"), F.lit(True)).cast("int")
    runs = removed.select(*KEY, "start", "len").withColumn("reached", reached)
    runs = runs.withColumn("run", F.sum(opens).over(document.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*KEY, "run").agg(F.min("start").alias("start"), (F.max(end) - F.min("start")).alias("len"))


def _by_key(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on the document key; null document ids match each other. The key has one row on the right."""
    names = {name: f"r_{name}" for name in KEY}
    right = right.withColumnsRenamed(names)
    same = F.lit(True)
    for name, other in names.items():
        same = same & F.col(name).eqNullSafe(F.col(other))
    return left.join(right, same, how).drop(*names.values())


def remove_repeated_lines(docs: DataFrame) -> DataFrame:
    """Adds to every row of `docs` its kept text and counts, in a struct column `line_dedup`.

    Struct: `text`, `n_lines`, `n_removed` and `removed` (start and length of each removed run of lines, by start). A null or empty
    text has one empty line and stays empty. Rows that agree in document id and text are one document and get the same
    result. Other columns are passed on untouched, whatever their names.
    """
    work = Workspace(docs.sparkSession, "lines")
    spans = work.write(repeated_chunks(docs.select("doc_id", "text"), work), "removed")
    work.drop("candidates", "kept")
    out = fresh_name(docs, "line_dedup")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text")
    keyed = row.withColumns(dict(zip(KEY, [F.col("doc_id"), *text_key(F.col("text"))]))).drop("doc_id")
    joined = _by_key(keyed, spans.hint("merge"), "left").withColumn("lines", F.split(F.coalesce("text", F.lit("")), "\n", -1))
    joined = joined.withColumn("gone", F.array_sort(F.coalesce("removed", F.expr("cast(array() as array<struct<start: int, len: int>>)"))))
    n_removed = F.aggregate("gone", F.lit(0), lambda a, s: a + s["len"])
    # The kept stretches lie between the removed ones.
    kept = F.expr(
        "flatten(transform(sequence(0, size(gone)), k -> slice(lines,"
        " if(k = 0, 0, gone[k - 1].start + gone[k - 1].len) + 1,"
        " if(k = size(gone), size(lines), gone[k].start) - if(k = 0, 0, gone[k - 1].start + gone[k - 1].len))))"
    )
    result = F.struct(
        F.when(F.size("gone") > 0, F.array_join(kept, "\n")).otherwise(F.coalesce("text", F.lit(""))).alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        n_removed.cast("long").alias("n_removed"),
        F.col("gone").alias("removed"),
    )
    return joined.select("row.*", result.alias(out))
