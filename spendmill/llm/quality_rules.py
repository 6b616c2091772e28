"""Quality rules whose cutoffs carry a guarantee (built-in functions only).

Each rule rejects a document whose statistic lies above a cutoff. The cutoffs of a rule form a fixed ladder from loose to
strict. On the labelled holdout, every stratum (language) and rule walks down its ladder and stops at the first cutoff for
which the exact binomial test can no longer exclude a false rejection rate of `alpha` or more; the last cutoff passed is
used. A fixed order needs no correction along the ladder; over strata and rules the error `delta` is divided (Bonferroni).
`alpha` is divided over the rules as well: with probability 1 - delta, in no stratum do all rules together reject more than
`alpha` of the good documents.

The trials are the distinct texts of labelled documents: a document that is listed often, or copies of one text, is one trial.

A stratum with too few good labels to prove anything keeps every document that the fixed base rule keeps.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendmill.llm.common import Workspace, ascii_words, rows_where, text_key

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Loose to strict, fixed before any label is seen.
LADDERS: dict[str, list[float]] = {
    "symbols_per_word": [1.0, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1],
    "chars_per_word": [20.0, 15.0, 12.0, 10.0, 9.0, 8.0, 7.5, 7.0],
    "repeated_lines": [0.8, 0.6, 0.5, 0.4, 0.3],
    "repeated_words": [0.45, 0.4, 0.35, 0.3, 0.25, 0.2],
}
# 128 bits that stand for a text.
TEXT_KEY = ("text_k1", "text_k2")


@dataclass(frozen=True)
class Risk:
    alpha: float = 0.02
    delta: float = 0.1


def _rows_of(columns: dict[str, Column], df: DataFrame) -> DataFrame:
    for name, column in columns.items():
        df = df.withColumn(name, column)
    return df


def features(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Counts of one text per row: `doc_id`, `lang`, the statistics and the columns to `carry`. Null texts have no words.

    Words of repeated 3-word windows: only texts with fewer distinct windows than windows are looked into; there the
    windows are sorted by hash, and equal neighbours repeat. No text costs more than n log n.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select("doc_id", "lang", text.alias("text"), *carry).withColumn("words", ascii_words(F.col("text")))
    df = _rows_of(
        {
            "n_words": F.size("words").cast("long"),
            "lines": F.filter(F.split("text", "\n", -1), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")),
            "grams": F.expr(
                "if(n_words < 3, cast(array() as array<bigint>), transform(sequence(0, int(n_words) - 3),"
                " i -> xxhash64(words[i], words[i + 1], words[i + 2])))"
            ),
        },
        df,
    )
    df = df.withColumn("repeats", F.size(F.array_distinct("grams")) < F.size("grams"))
    # (hash, place) sorted: a window repeats if it equals its neighbour on either side.
    df = df.withColumn(
        "places",
        F.expr(
            "if(repeats, sort_array(transform(grams, (g, i) -> named_struct('g', g, 'i', i))),"
            " cast(array() as array<struct<g: bigint, i: int>>))"
        ),
    )
    df = df.withColumn(
        "again",
        F.expr(
            "filter(places, (p, k) -> (k > 0 and places[k - 1].g = p.g)"
            " or (k + 1 < size(places) and places[k + 1].g = p.g))"
        ),
    )
    return df.select(
        "doc_id",
        "lang",
        "n_words",
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr("cast(size(array_distinct(flatten(transform(again, p -> array(p.i, p.i + 1, p.i + 2))))) as bigint)").alias(
            "n_repeat_words"
        ),
        F.size("lines").cast("long").alias("n_lines"),
        *[key.alias(name) for name, key in zip(TEXT_KEY, text_key(F.col("text")))],
        *carry,
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def statistics() -> dict[str, Column]:
    """Statistic of each rule over the columns of `features`."""
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    return {
        "symbols_per_word": F.col("n_symbols") / words,
        "chars_per_word": F.col("word_chars") / words,
        "repeated_lines": F.col("n_dup_lines") / lines,
        "repeated_words": F.col("n_repeat_words") / words,
    }


def _log_factorial(name: str) -> str:
    """ln(x!) of a whole number: exact up to 20, then Stirling's series (error below 1e-13)."""
    return (
        f"if({name} <= 20, ln(factorial(int(least({name}, 20)))), {name} * ln(double(greatest({name}, 1))) - {name}"
        f" + 0.5 * ln({2 * math.pi} * greatest({name}, 1)) + 1 / (12.0D * greatest({name}, 1))"
        f" - 1 / (360.0D * pow(double(greatest({name}, 1)), 3)))"
    )


def binomial_tail(n: str, k: str, alpha: float) -> Column:
    """P(Binomial(n, alpha) <= k), for whole-number columns.

    Summed downward from the term at k, where each term is the one above times i / (n - i + 1) * (1 - alpha) / alpha. From
    n * alpha on, the answer is only known to be large and 1 is returned. Terms beyond 40 standard deviations are replaced
    by an upper bound (their number times the last term), so the result never understates the probability.
    """
    steps = f"int(least({k}, 200 + 40 * sqrt({n} * {alpha})))"
    top = (
        f"exp({_log_factorial(n)} - {_log_factorial(k)} - {_log_factorial(f'({n} - {k})')}"
        f" + {k} * ln({alpha}D) + ({n} - {k}) * ln({1 - alpha}D))"
    )
    total = (
        f"aggregate(sequence(0, {steps}), named_struct('term', {top}, 'sum', 0.0D), (a, j) -> named_struct("
        f"'term', a.term * ({k} - j) / ({n} - {k} + j + 1.0D) * {(1 - alpha) / alpha}D, 'sum', a.sum + a.term),"
        f" a -> a.sum + a.term * greatest({k} - {steps}, 0))"
    )
    return F.expr(f"if({k} >= {n} * {alpha}D, 1.0D, {total})")


def certified_cutoffs(
    measured: DataFrame, labels: DataFrame, risk: Risk = Risk(), ladders: dict[str, list[float]] | None = None
) -> DataFrame:
    """One row per stratum: `lang` and a column per rule with its cutoff (null: the rule rejects nothing there).

    `measured` holds the `features`; `labels` has `doc_id` and `quality`. A document is good if all its labels say 1;
    labels without document or quality are ignored, and so are good documents that the base rule rejects anyway. Equal texts of a
    stratum are one trial, however many rows and documents hold them.
    """
    ladders = ladders or LADDERS
    good = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("good"))
        .where("good = 1")
        .select("doc_id")
    )
    def loose(rule: str, rungs: list[float]) -> Column:
        value = statistics()[rule]
        return F.size(F.filter(F.array(*map(F.lit, rungs)), lambda cutoff: value <= cutoff))

    steps = F.array(
        *[
            F.struct(
                F.lit(rule).alias("rule"),
                # The first (loosest) rung that rejects the document; one past the end if none does.
                loose(rule, rungs).alias("rung"),
            )
            for rule, rungs in ladders.items()
        ]
    )
    hits = (
        measured.where(~base_failed())
        .join(good, "doc_id")
        .select("lang", *TEXT_KEY, steps.alias("steps"))
        .dropDuplicates(["lang", *TEXT_KEY])
        .select("lang", F.explode("steps").alias("step"))
        .groupBy("lang", "step.rule", "step.rung")
        .agg(F.count("*").alias("hits"))
    )
    per_rule = hits.groupBy("lang", "rule").agg(
        F.sum("hits").alias("n"), F.map_from_entries(F.collect_list(F.struct("rung", "hits"))).alias("at")
    )
    strata = hits.select("lang").distinct().agg(F.count("*").alias("strata"))
    rungs = F.array(
        *[
            F.struct(F.lit(rule).alias("rule"), F.array(*map(F.lit, values)).alias("cutoffs"))
            for rule, values in ladders.items()
        ]
    )
    ladder_rows = strata.select("strata", F.explode(rungs).alias("l")).select(
        "strata", F.col("l.rule").alias("rule"), F.posexplode("l.cutoffs").alias("rung", "cutoff")
    )
    tested = (
        per_rule.join(ladder_rows, "rule")
        .withColumn(
            "k",
            F.expr("aggregate(sequence(0, rung), 0L, (a, r) -> a + coalesce(at[r], 0L))"),
        )
        .withColumn("p", binomial_tail("n", "k", risk.alpha / len(ladders)))
        .withColumn("passes", F.col("p") <= F.lit(risk.delta) / (F.col("strata") * len(ladders)))
    )
    down = Window.partitionBy("lang", "rule").orderBy("rung").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kept = tested.withColumn("passes", F.min("passes").over(down)).where("passes")
    return kept.groupBy("lang").agg(
        *[F.min(F.when(F.col("rule") == rule, F.col("cutoff"))).alias(f"max_{rule}") for rule in ladders]
    )


def apply_cutoffs(measured: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Adds `base_failed` and `kept`. A document of a stratum without cutoffs passes the rules."""
    spare = [name for name in cutoffs.columns if name != "lang"]
    limits = cutoffs.select(F.col("lang").alias("stratum"), *spare)
    joined = measured.join(limits, F.col("lang").eqNullSafe(F.col("stratum")), "left").drop("stratum")
    passes = F.lit(True)
    for rule, value in statistics().items():
        if f"max_{rule}" in spare:
            passes = passes & F.coalesce(value <= F.col(f"max_{rule}"), F.lit(True))
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & passes)


def score_documents(docs: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """Features, cutoffs and verdict per document: one row per row of `docs` (`doc_id`, `text`, `lang`).

    The features are written once to the shared folder, because both the cutoffs and the verdict read them. Null `lang` is a
    stratum of its own; repeated rows are judged each for itself; other columns of `docs` and `labels` are not read. Empty
    tables give an empty result, empty labels a result without rule rejections.
    """
    work = Workspace(docs.sparkSession, "quality")
    measured = work.write(features(docs), "features")
    cutoffs = work.write(certified_cutoffs(measured, labels, risk), "cutoffs")
    return apply_cutoffs(measured, cutoffs)


def keep_documents(docs: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """The rows of `docs` that the base rule and the certified cutoffs keep, with all their columns.

    The statistics are computed twice, first without the texts to find the cutoffs, then beside each row: that is cheaper
    than to join the verdicts to the texts, and needs no unique document id.
    """
    work = Workspace(docs.sparkSession, "quality")
    measured = work.write(features(docs.select("doc_id", "text", "lang")), "features")
    cutoffs = work.write(certified_cutoffs(measured, labels, risk), "cutoffs")
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    judged = apply_cutoffs(features(docs.select("doc_id", "text", "lang", row), carry=["row"]), cutoffs)
    return rows_where(judged, F.col("kept"), [F.col("row")[name].alias(name) for name in docs.columns])
