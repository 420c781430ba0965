"""Column expressions on one text: no joins, no shuffles, no Python workers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions import patterns

#: Up to this many keywords a plain ``contains`` per keyword is faster than one pattern.
FEW_KEYWORDS = 128


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.transform(F.array(value), body)[0]


def no_strings() -> Column:
    """An empty ``array<string>``."""
    return F.array().cast("array<string>")


def contains_both(text: Column, first: str, second: str) -> Column:
    """True where both keywords occur in the text."""
    return F.contains(text, F.lit(first)) & F.contains(text, F.lit(second))


def contained_keywords(text: Column, keywords: Sequence[str]) -> Column:
    """The distinct keywords that occur anywhere in the text, overlaps included.

    The array has one fixed order for a given set of keywords, so it can serve as a group key.
    """
    if not keywords:
        return no_strings()
    if len(keywords) <= FEW_KEYWORDS:
        found = [F.when(F.contains(text, F.lit(kw)), F.lit(kw)) for kw in sorted(keywords)]
        return F.array_compact(F.array(*found))
    longest = F.array_distinct(_overlapping(text, patterns.longest_first(keywords)))
    longest = F.filter(longest, lambda word: word != "")
    layers = patterns.prefix_layers(keywords)
    if len(layers) > 1:
        # What begins at a position is a prefix of the longest keyword there: look for the
        # shorter ones in the few distinct longest ones instead of the whole text.
        joined = F.array_join(longest, patterns.separator(keywords))
        longest = let(
            joined,
            lambda words: F.array_distinct(
                F.flatten(
                    F.array(*[_overlapping(words, patterns.longest_first(la)) for la in layers])
                )
            ),
        )
    return F.sort_array(longest)


def _overlapping(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?=({pattern}))"), F.lit(1))


def dictionary_tokens(text: Column, keywords: Sequence[str]) -> Column:
    """Cut the text into dictionary terms, left to right and without overlaps.

    The leftmost keyword is taken next; of several at one position the one latest in the
    dictionary.
    """
    if not keywords:
        return F.when(text.isNotNull(), no_strings())
    return F.regexp_extract_all(text, F.lit(patterns.last_wins(keywords)), F.lit(0))


def occurrences(text: Column, keyword: Column | str) -> Column:
    """How often the keyword occurs in the text without overlap."""
    keyword = F.lit(keyword) if isinstance(keyword, str) else keyword
    removed = F.length(text) - F.length(F.replace(text, keyword))
    return (removed / F.length(keyword)).cast("bigint")


def keyword_counts(text: Column, keywords: Sequence[str]) -> Column:
    """``array<struct<kw, n>>``: how often each contained keyword occurs, without overlap."""

    def counted(kw: Column, n: Column) -> Column:
        return F.struct(kw.alias("kw"), n.alias("n"))

    if len(keywords) <= FEW_KEYWORDS:
        found = contained_keywords(text, keywords)
        return F.transform(found, lambda kw: counted(kw, occurrences(text, kw)))
    longest = _overlapping(text, patterns.longest_first(keywords))
    starts = term_counts(F.filter(longest, lambda word: word != ""))
    layers = [f"^(?:{patterns.longest_first(layer)})" for layer in patterns.prefix_layers(keywords)]
    if len(layers) > 1:
        # What begins at a position is a prefix of the longest keyword there: one pass over the
        # text counts the longest ones, and their counts are handed to the shorter ones.
        begun = let(starts, lambda s: F.concat(*[_counted_prefixes(s, at) for at in layers]))
        starts = _summed(F.filter(begun, lambda c: c["term"] != ""))
    # Starts overlap only where a keyword ends as it begins; only then is it counted by itself.
    return F.transform(
        starts,
        lambda c: counted(
            c["term"],
            F.when(
                (c["n"] > 1) & _ends_as_it_begins(c["term"]), occurrences(text, c["term"])
            ).otherwise(c["n"]),
        ),
    )


def _counted_prefixes(counts: Column, pattern: str) -> Column:
    """The beginning of each ``term`` that matches, empty if none does, with the same count."""
    return F.transform(
        counts,
        lambda c: F.struct(
            F.regexp_extract(c["term"], pattern, 0).alias("term"), c["n"].alias("n")
        ),
    )


def _summed(counts: Column) -> Column:
    """``array<struct<term, n>>``: the counts of each term added up, ordered by term."""

    def runs(ordered: Column) -> Column:
        firsts = F.filter(
            F.transform(ordered, lambda c, i: i),
            lambda i: (i == 0) | (F.get(ordered, i)["term"] != F.get(ordered, i - 1)["term"]),
        )
        return let(firsts, lambda at: F.transform(at, lambda first, k: total(ordered, at, first, k)))

    def total(ordered: Column, at: Column, first: Column, k: Column) -> Column:
        end = F.coalesce(F.get(at, k + 1), F.size(ordered))
        n = F.aggregate(
            F.slice(ordered, first + 1, end - first),
            F.lit(0).cast("bigint"),
            lambda so_far, c: so_far + c["n"],
        )
        return F.struct(F.get(ordered, first)["term"].alias("term"), n.alias("n"))

    return let(F.sort_array(counts), runs)


def _ends_as_it_begins(word: Column) -> Column:
    sizes = F.sequence(F.lit(1), F.length(word) - 1)
    same = F.exists(sizes, lambda i: F.left(word, i) == F.right(word, i))
    return (F.length(word) > 1) & same


def term_counts(terms: Column) -> Column:
    """``array<struct<term, n>>``: each distinct term with its count, ordered by term."""

    def runs(ordered: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1),
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )
        return let(
            starts,
            lambda at: F.transform(
                at,
                lambda start, k: F.struct(
                    F.get(ordered, start).alias("term"),
                    (F.coalesce(F.get(at, k + 1), F.size(ordered)) - start)
                    .cast("bigint")
                    .alias("n"),
                ),
            ),
        )

    empty = F.array().cast("array<struct<term:string,n:bigint>>")
    # Sorted before it is tested, so that a computed array is not computed twice.
    return let(
        F.sort_array(terms), lambda t: F.when(F.size(t) > 0, let(t, runs)).otherwise(empty)
    )
