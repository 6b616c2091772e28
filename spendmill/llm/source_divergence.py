"""How far the sources of a language differ in their words: exact distances between smoothed term distributions.

Identical texts of a language are collapsed first: each is tokenized once, and its counts are weighted by the number of its
copies in every source. Distances are then evaluated sparsely. A term that a source lacks has one and the same smoothed
probability there, so a pair's distance over all kept terms is that of two empty sources, corrected by what either source holds
(from a histogram of its probabilities) and by the terms that both hold.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendmill.llm.common import Workspace, text_key

MIN_DOCUMENTS = 30
TOP_TERMS = 50
SCALE = 1_000_000_000
SMOOTHING = 5
# Terms a task holds before it hands its counts on; a full table is emptied, which changes no count.
HELD_TERMS = 400_000
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    """Runs of ASCII letters and of all characters beyond ASCII, with A-Z in lower case, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_LETTERS).split()


def _count_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Occurrences and documents per language, source and term; a text that arrives for several sources is tokenized once."""
    held: dict[tuple[str, str], dict[bytes, list[int]]] = {}
    size = 0
    last, counts = None, Counter()

    def emit() -> pd.DataFrame:
        rows = [
            (lang, source, term.decode("utf-8", "replace"), n, d)
            for (lang, source), terms in held.items()
            for term, (n, d) in terms.items()
        ]
        return pd.DataFrame(rows, columns=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for lang, source, copies, text in zip(batch["lang"], batch["source"], batch["copies"], batch["text"]):
            if text != last:
                last, counts = text, Counter(terms_of(text))
            terms = held.setdefault((lang, source), {})
            size -= len(terms)
            for term, times in counts.items():
                entry = terms.get(term)
                if entry is None:
                    terms[term] = [times * copies, copies]
                else:
                    entry[0] += times * copies
                    entry[1] += copies
            size += len(terms)
            if size >= HELD_TERMS:
                yield emit()
                held, size = {}, 0
    if size:
        yield emit()


def _smoothed(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + SMOOTHING) / (total + SMOOTHING * terms)), in integers of 38 digits."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (n + SMOOTHING).cast("decimal(20,0)")
    below = (total + F.lit(SMOOTHING) * terms).cast("decimal(20,0)")
    return F.call_function("div", above, below) + 1


def audit_sources(docs: DataFrame) -> DataFrame:
    """Distances between the sources of each language, and each source's terms above its language's level.

    Returns `lang`, `source`, `part`, `item`, `value`, `rank`. Part `pair`: every other source of the language, with the sum of
    absolute differences over all kept terms. Part `term`: the 50 terms in which the source exceeds its language most. A
    term is kept in a language if at least 30 of its documents hold it; every row is a document, copies included. Ranks go by
    value, then by the item's UTF-8 bytes, and have no ties.

    A null text, language or source is empty, and an empty one is a language or source like any other. Sources without terms
    are paired as well; a language without kept terms has distance 0 everywhere. Identity of texts is judged by 128 bits. Rows
    are counted as often as they are repeated; document ids and further columns are not read. An empty table gives no row.
    """
    work = Workspace(docs.sparkSession, "source_divergence")
    empty = F.lit("")
    k1, k2 = text_key(F.col("text"))
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), empty).alias(c) for c in ("lang", "source", "text")])
    rows = rows.withColumns({"k1": k1, "k2": k2})

    # One text per language and key, and how often each source has it: a group of copies never meets in one task.
    copies = work.write(rows.groupBy("lang", "k1", "k2", "source").agg(F.count(F.lit(1)).alias("copies")), "copies")
    texts = rows.groupBy("lang", "k1", "k2").agg(F.first("text").alias("text"))
    weighted = copies.join(texts, ["lang", "k1", "k2"]).select("lang", "source", "copies", "text")
    counted = weighted.mapInPandas(_count_terms, "lang string, source string, term string, n long, docs long")
    summed = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # A term has one row per source here, so its language figures are sums over few rows beside each other.
    of_term = Window.partitionBy("lang", "term")
    held = summed.withColumns({"n_lang": F.sum("n").over(of_term), "docs": F.sum("docs").over(of_term)})
    held = work.write(held.where(F.col("docs") >= MIN_DOCUMENTS).drop("docs"), "held")
    # Every kept term occurs in some group, so language figures follow from the group figures of its terms.
    languages = (
        held.groupBy("lang", "term").agg(F.max("n_lang").alias("n"))
        .groupBy("lang").agg(F.sum("n").alias("total_lang"), F.count(F.lit(1)).alias("terms"))
    )
    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    groups = work.write(
        copies.select("lang", "source")
        .distinct()
        .join(languages, "lang", "left")
        .join(totals, ["lang", "source"], "left")
        .select(
            "lang",
            "source",
            F.coalesce("terms", zero).alias("terms"),
            F.coalesce("total_lang", zero).alias("total_lang"),
            F.coalesce("total", zero).alias("total"),
        )
        # Probability of a term that the source does not hold.
        .withColumn("absent", F.when(F.col("terms") > 0, _smoothed(zero, F.col("total"), F.col("terms")))),
        "groups",
    )
    terms = held.join(groups, ["lang", "source"]).select(
        "lang",
        "source",
        "term",
        "absent",
        _smoothed(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
        _smoothed(F.col("n_lang"), F.col("total_lang"), F.col("terms")).alias("q"),
    )
    terms = work.write(terms, "terms")
    work.drop("copies", "held")
    return _top_terms(terms).unionByName(_pairs(terms, groups))


def _top_terms(terms: DataFrame) -> DataFrame:
    above = terms.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    # Spark keeps the first ranks of every task before it shuffles.
    ranked = above.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= TOP_TERMS)
    return ranked.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")


def _pairs(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """Distances of all pairs of sources: the report itself holds that many rows, and no other step holds more per term.

    Pairs are evaluated once, with the smaller name first. For p(t) and q(t) of two sources, and p0 and q0 where they lack t, the
    sum of |p - q| over all V terms is V |p0 - q0|, plus |p - q0| - |p0 - q0| for the terms of the one source, plus the like for
    the other, plus |p - q| - |p - q0| - |p0 - q| + |p0 - q0| for the terms of both.
    """
    one = groups.select("lang", F.col("source").alias("a"), "terms", F.col("absent").alias("a0"))
    two = groups.select("lang", F.col("source").alias("b"), F.col("absent").alias("b0"))
    pairs = one.join(two, "lang").where("a <> b")
    gap = F.abs(F.col("a0") - F.col("b0"))

    # Sources repeat few probabilities: their terms are counted by probability before they meet other sources.
    histogram = terms.groupBy("lang", F.col("source").alias("a"), "p").agg(F.count(F.lit(1)).alias("held"))
    own = (
        pairs.join(histogram, ["lang", "a"])
        .groupBy("lang", "a", "b")
        .agg(F.sum(F.col("held") * (F.abs(F.col("p") - F.col("b0")) - gap)).alias("part"))
    )
    both_ways = own.unionByName(own.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "part"))
    both_ways = both_ways.where("a < b").groupBy("lang", "a", "b").agg(F.sum("part").alias("part"))

    left = terms.select("lang", "term", F.col("source").alias("a"), F.col("p"), F.col("absent").alias("a0"))
    right = terms.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("q"), F.col("absent").alias("b0"))
    p, q, a0, b0 = (F.col(c) for c in ("p", "q", "a0", "b0"))
    shared = (
        left.join(right, ["lang", "term"])
        .where("a < b")
        .groupBy("lang", "a", "b")
        .agg(F.sum(F.abs(p - q) - F.abs(p - b0) - F.abs(a0 - q) + F.abs(a0 - b0)).alias("part"))
    )
    corrections = both_ways.unionByName(shared)
    base = pairs.where("a < b").select("lang", "a", "b", F.coalesce(F.col("terms") * gap, F.lit(0)).alias("part"))
    value = base.unionByName(corrections).groupBy("lang", "a", "b").agg(F.sum("part").alias("value"))
    both = value.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        value.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value")
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = both.withColumn("rank", F.row_number().over(by_value))
    return ranked.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
