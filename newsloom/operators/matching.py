"""Finding dictionary keywords in documents.

A dictionary of a few keywords is matched by column expressions, one that fits a pattern by a trie that
every task holds (:mod:`newsloom.operators.spotting`): no join and no shuffle. A larger one is found
through the rarest grams of its keywords (:mod:`newsloom.operators.grams`), without a join too if what is
left of it fits one slice.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions import text as T
from newsloom.lineage import materialize
from newsloom.operators import grams, spotting
from newsloom.operators.lexicon import Lexicon

#: The id that rows get while they are joined with a large dictionary.
ROW = "_row_id"

Key = Sequence[str]


def matcher_of(docs: DataFrame, lexicon: Lexicon, *, text: str = "text") -> tuple[DataFrame, spotting.Words | None]:
    """What finds the keywords in a task, if that holds them all; and the dictionary that is joined if not."""
    if lexicon.words is None:
        return grams.whole_matcher(docs, lexicon.table, text=text)
    rows = lexicon.table.toArrow()  # as many as lexicon.words
    return lexicon.table, spotting.Trie(rows.column("kw_id").to_numpy(), rows.column("kw").to_pylist())


def with_keywords(
    docs: DataFrame, lexicon: Lexicon, *, text: str = "text", key: Key = ("doc_id",)
) -> DataFrame:
    """Add ``keywords``: the distinct keywords contained in the text, in a fixed order.

    Rows that repeat a key or have none are rows like any others, for dictionaries of any size.
    """
    if lexicon.has_few:
        found = T.contained_keywords(F.col(text), lexicon.words)
        return docs.withColumn("keywords", F.coalesce(found, T.no_strings()))
    dictionary, matcher = matcher_of(docs, lexicon, text=text)
    if matcher:
        return docs.withColumn("keywords", spotting.keywords_of(F.col(text), docs, matcher))
    docs = identified(docs)
    found = keyword_positions(docs, dictionary, text=text, key=(ROW,), once=True)
    # All rows of a text come from one task, where most repeats go.
    per_doc = found.groupBy(ROW).agg(F.sort_array(F.collect_set("kw")).alias("keywords"))
    return _attach(docs, per_doc, "keywords")


def with_terms(
    docs: DataFrame, lexicon: Lexicon, *, text: str = "text", key: Key = ("doc_id",)
) -> DataFrame:
    """Add ``terms``: the text cut into dictionary terms, leftmost first, without overlaps.

    Of several keywords at one position the one latest in the dictionary is taken.
    """
    if lexicon.has_few:
        found = T.dictionary_tokens(F.col(text), lexicon.words)
        return docs.withColumn("terms", F.coalesce(found, T.no_strings()))
    dictionary, matcher = matcher_of(docs, lexicon, text=text)
    if matcher:
        return docs.withColumn("terms", spotting.terms_of(F.col(text), docs, matcher))
    docs = identified(docs)
    found = keyword_positions(docs, dictionary, text=text, key=(ROW,))
    cut = without_overlaps(found, [ROW]).groupBy(ROW).agg(
        F.sort_array(F.collect_list(F.struct("pos", "kw"))).alias("_cut")
    )
    per_doc = cut.select(ROW, F.col("_cut.kw").alias("terms"))
    return _attach(docs, per_doc, "terms")


def exploded(df: DataFrame, array: str, name: str, *keep: str) -> DataFrame:
    """One row per element of a computed array column.

    A plain ``explode`` makes the optimizer filter empty arrays first, which would compute the
    array a second time; the outer form does not, and its null rows are dropped afterwards.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())


def keyword_positions(
    docs: DataFrame, dictionary: DataFrame, *, text: str = "text", key: Key = ("doc_id",), once: bool = False
) -> DataFrame:
    """Every occurrence of every keyword of a filed dictionary, overlaps included: ``key, pos, kw_id, kw``.

    With ``once`` further occurrences of a keyword in the same text may be left out.
    """
    return grams.occurrences(docs, dictionary, text=text, key=key, once=once, dictionary=dictionary)


def without_overlaps(matches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Of the matches ``by, pos, kw`` of a text those that start after the last one that was taken.

    Of several at one place that with the highest ``kw_id`` is taken, if there is one. Matches are
    sorted by place and gone through in order, with nothing held but where the last one ends: work
    and memory are linear however long a text is, and whole texts are cut apart from one another.
    """
    columns, by = matches.columns, list(by)
    best_first = [F.desc("kw_id")] if "kw_id" in columns else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, after = None, 0
        for batch in batches:
            keys = [batch.column(c).to_pylist() for c in by]
            keys = keys[0] if len(keys) == 1 else list(zip(*keys, strict=True))
            taken = []
            for key, pos, end in zip(keys, batch.column("pos").to_pylist(), batch.column("_end").to_pylist(), strict=True):
                free = pos >= after or key != text
                if free:
                    text, after = key, end
                taken.append(free)
            yield batch.filter(pa.array(taken, pa.bool_())).select(columns)

    dealt = matches.withColumn("_end", F.col("pos") + F.length("kw")).repartition(*by)
    return dealt.sortWithinPartitions(*by, "pos", *best_first).mapInArrow(run, matches.schema)


def identified(docs: DataFrame) -> DataFrame:
    """The rows with an id of their own, written once, as keys of the caller may repeat or be null."""
    return materialize(docs.withColumn(ROW, F.monotonically_increasing_id()), "identified")


def _attach(docs: DataFrame, per_doc: DataFrame, name: str) -> DataFrame:
    columns = [c for c in docs.columns if c not in (ROW, name)]
    return docs.join(per_doc, ROW, "left").select(
        *[docs[c] for c in columns], F.coalesce(per_doc[name], T.no_strings()).alias(name)
    )
