"""From raw documents to packed training sequences: five stages, each one corpus operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's `docs`. All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from public_tokenizers import path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendmill.llm.common import Workspace, fresh_name, rows_where, table
from spendmill.llm.decontamination import drop_leaks
from spendmill.llm.line_dedup import remove_repeated_lines
from spendmill.llm.near_copies import drop_near_copies
from spendmill.llm.packing import pack_documents
from spendmill.llm.quality_rules import keep_documents

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# The stages hash and rank with functions that SQL engines do not share; tests hold run() against brute force.
ORACLE_SQL = None


# Folders that stages have opened and that are still there.
_held: list[Workspace] = []


def stage(function: Stage) -> Stage:
    """A stage that first deletes the tables by which earlier stages made their results, which are written by then.

    Tables that `docs` still reads from stay, for a caller that did not write it. Other operators' tables are not touched.
    """

    @wraps(function)
    def staged(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _held[:] = Workspace.release(_held, docs)
        before = len(Workspace.opened)
        try:
            return function(spark, docs, sf_dir)
        finally:
            _held.extend(Workspace.opened[before:])

    return staged


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the certified cutoffs."""
    return keep_documents(docs, table(spark, sf_dir, "labels"))


@stage
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated line chunks; `n_chars` follows the text. A document that loses all its words goes."""
    out = fresh_name(docs, "line_dedup")
    after = remove_repeated_lines(docs)
    text = F.col(out)["text"]
    lost_all = (F.col(out)["n_removed"] > 0) & ~text.rlike("[^\\x20\\x09-\\x0D]")
    columns = {"text": F.when(F.col("text").isNotNull(), text), "n_chars": F.length(text).cast("long")}
    return rows_where(after, ~lost_all, [columns.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: texts whose fingerprints of five-word shingles differ in 4 bits or fewer, then texts whose sets
    of five-word shingles have a similarity of 0.8 or more, which a 64-bit fingerprint mostly misses. The smallest id stays.
    """
    return drop_near_copies(docs, shingle=5, fingerprints=True)


@stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


@stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenized documents, packed into training sequences of 2048 tokens."""
    return pack_documents(docs, path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`."""
    docs = table(spark, sf_dir, "documents")
    outputs: list[Workspace] = []
    for name, function in STAGES:
        output = Workspace(spark, f"pipeline-{name}")
        docs = output.write(function(spark, docs, sf_dir), name)
        Workspace.release(outputs)
        outputs = [output]
    return docs
