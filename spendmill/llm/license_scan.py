"""Licence statements found by a positional index of rare words (built-in functions only).

The licence templates are indexed by word and position. The voters of a template are the rarest words of its mandatory key
phrase (document frequency over the whole corpus), as many as give `MIN_VOTES` places. Each occurrence of a voter votes for
its template standing at (place in text - place in template); a start with `MIN_VOTES` votes is a candidate, and counts if
the key phrase stands there word for word. So no statement depends on what else a text holds. The index is small and fixed by
the templates, so it travels inside the expressions: no shuffle and no join takes part in the scan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendmill.llm.common import lower_for_ascii

NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
MIN_VOTES = 2
# Phrases whose places are counted, and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


@dataclass(frozen=True)
class Template:
    """Words of a statement in lower case, and the phrase in it that has to be there word for word."""

    text: str
    key: str

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_start(self) -> int:
        words, key = self.words, self.key.split()
        return next(i for i in range(len(words)) if words[i : i + len(key)] == key)


TEMPLATES: dict[str, Template] = {
    "agpl-3.0": Template("licensed under the gnu affero general public license version 3", "affero general public license"),
    "apache-2.0": Template("licensed under the apache license version 2 0", "apache license version 2 0"),
    "bsd": Template(
        "redistribution and use in source and binary forms with or without modification are permitted",
        "redistribution and use in source and binary forms",
    ),
    "cc-by-4.0": Template("licensed under cc by 4 0", "cc by 4 0"),
    "cc-by-nc-4.0": Template("licensed under cc by nc 4 0", "cc by nc 4 0"),
    "cc-by-sa-4.0": Template("licensed under cc by sa 4 0", "cc by sa 4 0"),
    "gpl-2.0": Template("licensed under the gnu general public license version 2", "gnu general public license version 2"),
    "gpl-3.0": Template("licensed under the gnu general public license version 3", "gnu general public license version 3"),
    "lgpl": Template("licensed under the gnu lesser general public license", "gnu lesser general public license"),
    "mit": Template("released under the mit license", "mit license"),
    "mit-text": Template(
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
        "permission is hereby granted free of charge",
    ),
    "mpl-2.0": Template("subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    "unlicense": Template("this is free and unencumbered software released into the public domain", "free and unencumbered software"),
}


def licence_words(text: Column) -> Column:
    """Words of a text in order: runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased."""
    return F.array_remove(F.split(lower_for_ascii(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def _quoted(word: str) -> str:
    return "'" + word.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _array(words) -> str:
    return f"array({', '.join(_quoted(w) for w in words)})"


def phrase_places(words: str, phrase: str) -> Column:
    """Starts (from 0) of a phrase in the array column `words`, in order."""
    parts = phrase.split()
    same = " and ".join(f"get({words}, i + {j}) = {_quoted(p)}" for j, p in enumerate(parts))
    return F.expr(
        f"if(array_contains({words}, {_quoted(parts[-1])}) and array_contains({words}, {_quoted(parts[0])}),"
        f" filter(sequence(0, size({words}) - 1), i -> {same}), cast(array() as array<int>))"
    )


def _labelled(label: str) -> Callable[[Column], Column]:
    return lambda place: F.struct(place.cast("long").alias("start"), F.lit(label).alias("label"))


def rarest_first(words: DataFrame, templates: Mapping[str, Template]) -> list[str]:
    """Template words by rising document frequency in the corpus, ties by name. `words` has an array column `words`.

    The result has one entry per word of the templates, however large the corpus is.
    """
    vocabulary = sorted({w for t in templates.values() for w in t.words})
    counts = (
        words.select(F.explode_outer(F.array_intersect(F.array(*map(F.lit, vocabulary)), "words")).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("docs"))
    )
    found = {row["word"]: row["docs"] for row in counts.collect() if row["word"] is not None}
    return sorted(vocabulary, key=lambda w: (found.get(w, 0), w))


def voters(template: Template, order: list[str]) -> set[str]:
    """The rarest words of the key phrase with `MIN_VOTES` places in it; if it has fewer places, all words of the template."""
    key, chosen = template.key.split(), set()
    for word in sorted(set(key), key=order.index):
        chosen.add(word)
        if sum(w in chosen for w in key) >= MIN_VOTES:
            return chosen
    return set(template.words)


def scan_licences(
    docs: DataFrame, templates: Mapping[str, Template] | None = None, base: Mapping[str, str] | None = None
) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `n_words`, `base_places` (phrase label and start of each place), `found`
    (template, start and matched share of its words for each statement).

    A null or empty text has no words and no places. Repeated rows are scanned each for itself; further columns of `docs`
    are not read. Places are ordered by start, then label or template.
    """
    templates = TEMPLATES if templates is None else templates
    base = BASE_PHRASES if base is None else base
    words = docs.select("doc_id", licence_words(F.col("text")).alias("words"))
    order = rarest_first(words, templates)
    voting = {name: voters(t, order) for name, t in templates.items()}
    postings = ", ".join(
        f"named_struct('word', {_quoted(w)}, 'template', {_quoted(name)}, 'at', {at})"
        for name, t in templates.items()
        for at, w in enumerate(t.words)
        if w in voting[name]
    )
    details = ", ".join(
        f"named_struct('template', {_quoted(name)}, 'words', {_array(t.words)}, 'key', {_array(t.key.split())},"
        f" 'key_start', {t.key_start})"
        for name, t in templates.items()
    )
    keys = sorted({t.key.split()[0] for t in templates.values()})
    df = words.withColumn("n_words", F.size("words").cast("long"))
    df = df.withColumn(
        "base_places",
        F.array_sort(
            F.flatten(
                F.array(
                    *[
                        F.transform(phrase_places("words", phrase), _labelled(label))
                        for phrase, label in base.items()
                    ]
                )
            )
        ),
    )
    # Voters in the text; texts without the first word of any key phrase are done here.
    every = sorted(set().union(*voting.values()))
    df = df.withColumn(
        "rare",
        F.expr(
            f"if(arrays_overlap(words, {_array(keys)}), array_intersect({_array(every)}, words),"
            " cast(array() as array<string>))"
        ),
    )
    df = df.withColumn(
        "hits",
        F.expr(
            "if(size(rare) = 0, cast(array() as array<struct<word: string, at: int>>), filter(transform(words,"
            " (w, i) -> named_struct('word', w, 'at', i)), h -> array_contains(rare, h.word)))"
        ),
    )
    df = df.withColumn(
        "votes",
        F.expr(
            f"sort_array(flatten(transform(hits, h -> transform(filter(array({postings}), p -> p.word = h.word),"
            " p -> named_struct('template', p.template, 'start', h.at - p.at)))))"
        ),
    )
    # Sorted votes: the one MIN_VOTES - 1 places before is the same for a start with enough of them.
    df = df.withColumn(
        "starts",
        F.expr(f"array_distinct(filter(votes, (v, i) -> i >= {MIN_VOTES - 1} and votes[i - {MIN_VOTES - 1}] = v))"),
    )
    df = df.withColumn(
        "found",
        F.expr(
            f"filter(transform(starts, s -> transform(filter(array({details}), d -> d.template = s.template), d ->"
            " named_struct('start', bigint(s.start), 'template', s.template,"
            " 'share', size(filter(sequence(0, size(d.words) - 1), j -> get(words, s.start + j) <=> d.words[j]))"
            " / size(d.words),"
            " 'key_there', s.start + d.key_start >= 0 and slice(words, greatest(s.start + d.key_start, 0) + 1,"
            " size(d.key)) = d.key))[0]), f -> f.key_there)"
        ),
    )
    df = df.withColumn(
        "found", F.expr("array_sort(transform(found, f -> named_struct('start', f.start, 'template', f.template, 'share', f.share)))")
    )
    return df.select("doc_id", "n_words", "base_places", "found")


def summarise(scanned: DataFrame) -> DataFrame:
    """The digest per document: counts, first and last place, labels and the best share of a statement (or 1 for a base phrase)."""
    places, found = F.col("base_places"), F.col("found")
    base = F.array_distinct(F.transform(places, lambda p: p["label"]))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(F.transform(places, lambda p: p["start"])).alias("first_word"),
        F.array_max(F.transform(places, lambda p: p["start"])).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(
            F.array_sort(F.array_union(base, F.transform(found, lambda f: f["template"]))), ","
        ).alias("labels"),
        F.round(
            F.when(F.size(found) > 0, F.array_max(F.transform(found, lambda f: f["share"])))
            .when(F.size(places) > 0, F.lit(1.0))
            .otherwise(F.lit(0.0)),
            6,
        ).alias("score"),
        F.size(found).cast("long").alias("n_found"),
    )
