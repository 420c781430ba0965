"""License scan by diagonal voting.

All rolling word k-grams of every text are joined with the positions of the same k-grams in the
license templates. A hit at word ``pos`` of a text and word ``t_pos`` of a template votes for the
diagonal ``pos - t_pos``: words that stand as in the template all vote for one diagonal, and a
missing or added word moves the rest to a neighbouring one. Diagonals are counted, those that lie
close together merged, and the merged span is verified. The k-grams themselves are compared, not
only their hashes, so a vote is never an accident.

Short templates stand at a place if all their k-grams voted for its diagonal. A longer one may have
``n // SPREAD_OF`` words added or missing in all, so diagonals are merged within windows of twice
that many, each beginning where the one before is half over. A span runs from its first to its last
matched word. It is a finding if the words it shares with the template are ``MIN_COVERAGE`` of the
template and of the span, whichever is longer: pairs of words strewn over a text are not.

Defined cases: a null text is an empty text; texts of fewer than k words have no hit; every row is
judged by its own text, whether its ``doc_id`` repeats or is null; extra columns of the input are not
looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of a k-gram of short templates and of long ones, which have so many words at least.
SHORT_K, LONG_K, LONG = 2, 3, 8

#: One word in so many of a long template may be added or missing.
SPREAD_OF = 4

#: The share of a long template, and of the span, that the span's matched words make up.
MIN_COVERAGE = 0.75

#: What stands between words: all of ASCII but letters and digits (fixed by the contract).
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """Words of a license text in lower case; ``base`` ones are those that the contract fixes."""

    label: str
    words: str
    base: bool = False

    @property
    def n(self) -> int:
        return len(self.words.split())

    @property
    def k(self) -> int:
        return LONG_K if self.n >= LONG and not self.base else SHORT_K

    @property
    def spread(self) -> int:
        """Words that may be added or missing in all; 0 if the template counts only word for word."""
        return self.n // SPREAD_OF if self.k == LONG_K else 0

    def grams(self) -> list[tuple[int, str]]:
        words = self.words.split()
        if len(words) < self.k:
            raise ValueError(f"a template needs {self.k} words or more: {self.words!r}")
        return [(i, " ".join(words[i : i + self.k])) for i in range(len(words) - self.k + 1)]


#: The four phrases and labels that the contract fixes.
BASE = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
)

#: Names and sentences of well-known licenses; the long ones are found with a few words added, missing or replaced.
FUZZY = (
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of"),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Template("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    Template("apache", "you may not use this file except in compliance with the license"),
    Template("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    Template("gpl", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license"),
    Template("cc", "this work is licensed under a creative commons attribution"),
    Template("reserved", "all rights reserved"),
)


def words_of(text: Column) -> Column:
    """The words of a text, ASCII letters in lower case.

    ``lower`` changes letters beyond ASCII too. That can't matter, as templates are ASCII and such
    letters stay beyond ASCII, but for the Kelvin sign, which is replaced before.
    """
    lowered = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("é")))
    return F.array_remove(F.split(lowered, NOT_WORD), "")


#: The gram of the row that stands for a text itself; no word holds a blank.
ITSELF = " "


def template_grams(templates: tuple[Template, ...]) -> Column:
    """The k-grams of the templates as rows ``template, label, base, n, k, spread, n_grams, t_pos, gram, hash``."""
    rows = [(-1, "", False, 0, 0, 0, 0, 0, ITSELF)]
    for number, t in enumerate(templates):
        grams = t.grams()
        rows += [(number, t.label, t.base, t.n, t.k, t.spread, len(grams), i, gram) for i, gram in grams]
    names = ("template", "label", "base", "n", "k", "spread", "n_grams", "t_pos", "gram")
    structs = [
        F.struct(*[F.lit(v).alias(c) for c, v in zip(names, row, strict=True)], F.xxhash64(F.lit(row[-1])).alias("hash"))
        for row in rows
    ]
    return F.inline(F.array(*structs))


def scan(docs: DataFrame, templates: tuple[Template, ...] = BASE + FUZZY) -> DataFrame:
    """License findings of every document of ``docs (doc_id, text)``.

    Gives ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``: the number
    of places of base phrases and the first and last word one starts at, labels of base phrases and
    of all templates, and the best share of a template. The templates are a parameter of the
    program, a few rows each, so they are broadcast; texts are not shuffled, only votes are. Each
    row has an id of its own, and one vote more that stands for itself.
    """
    grams = docs.sparkSession.range(1).select(template_grams(templates))
    words = docs.select(
        F.monotonically_increasing_id().alias("_row"), "doc_id", words_of(F.col("text")).alias("_words")
    )
    listed = words.select("_row", "doc_id", F.size("_words").cast("bigint").alias("n_words"), _grams("_words").alias("_grams"))
    hits = (
        # The outer form, as the optimizer would compute the array twice for the other.
        listed.select("_row", "doc_id", "n_words", F.posexplode_outer("_grams").alias("pos", "at"))
        .select("_row", "doc_id", "n_words", "pos", F.explode(F.array("at.two", "at.three")).alias("gram"))
        .withColumn("hash", F.xxhash64("gram"))
        .join(F.broadcast(grams), ["hash", "gram"])
    )
    of = ["_row", "doc_id", "n_words", "template", "label", "base", "n", "k", "spread", "n_grams"]
    votes = (
        hits.withColumn("diagonal", F.when(F.col("template") < 0, F.lit(0)).otherwise(F.col("pos") - F.col("t_pos")))
        .groupBy(*of, "diagonal")
        .agg(F.collect_set("t_pos").alias("held"))
    )
    # Exact templates have one window per diagonal, long ones two that overlap.
    step = F.floor(F.col("diagonal") / F.col("spread"))
    windows = F.when(F.col("spread") == 0, F.array(F.col("diagonal").cast("bigint"))).otherwise(F.array(step, step - 1))
    matched = F.array_distinct(F.flatten(F.transform("held", lambda t: F.sequence(t, t + F.col("k") - 1))))
    here = F.transform(matched, lambda t: t + F.col("diagonal"))
    spans = (
        votes.select(*of, "diagonal", F.size("held").alias("votes"), matched.alias("words"), here.alias("here"), F.explode(windows).alias("window"))
        .groupBy(*of, "window")
        .agg(
            F.max("votes").alias("votes"),
            F.size(F.array_distinct(F.flatten(F.collect_list("words")))).alias("n_matched"),
            F.size(F.array_distinct(F.flatten(F.collect_list("here")))).alias("n_here"),
            F.min(F.array_min("here")).alias("first"),
            F.max(F.array_max("here")).alias("last"),
        )
    )
    length = F.greatest("n", F.col("last") - F.col("first") + 1)
    share = F.least("n_matched", "n_here") / length
    exact = F.col("spread") == 0
    score = F.when(exact, F.when(F.col("votes") == F.col("n_grams"), F.lit(1.0))).otherwise(F.when(share >= MIN_COVERAGE, share))
    judged = spans.withColumn("_score", F.when(F.col("template") >= 0, score))
    verified = F.col("_score").isNotNull()
    place = F.when(F.col("base") & verified, F.col("window"))
    found = judged.groupBy("_row", "doc_id", "n_words").agg(
        F.count(place).alias("n_base"),
        F.min(place).alias("first_word"),
        F.max(place).alias("last_word"),
        _joined(F.when(F.col("base") & verified, F.col("label"))).alias("base_labels"),
        _joined(F.when(verified, F.col("label"))).alias("labels"),
        F.coalesce(F.max("_score"), F.lit(0.0)).alias("score"),
    )
    return found.drop("_row")


def _grams(words: str) -> Column:
    """At each word the gram of two and that of three words that begin there, null where words are missing.

    One place more at the end has the gram that stands for the text.
    """
    w = F.col(words)
    behind = [F.slice(w, F.lit(i + 1), F.greatest(F.size(w) - i, F.lit(0))).alias(f"w{i}") for i in range(LONG_K)]
    rolled = F.transform(
        F.arrays_zip(*behind),
        lambda at: F.struct(
            F.concat(at["w0"], F.lit(" "), at["w1"]).alias("two"),
            F.concat(at["w0"], F.lit(" "), at["w1"], F.lit(" "), at["w2"]).alias("three"),
        ),
    )
    itself = F.array(F.struct(F.lit(ITSELF).alias("two"), F.lit(None).cast("string").alias("three")))
    return F.concat(rolled, itself)


def _joined(label: Column) -> Column:
    return F.array_join(F.sort_array(F.collect_set(label)), ",")
