import random

import pytest
from pyspark.sql import functions as F

import naive
from newsloom.functions import patterns
from newsloom.functions import text as T
from newsloom.operators import matching
from newsloom.operators.lexicon import Lexicon
from newsloom.plans.queries import KEYWORDS

#: Keywords overlap in it, and two of them begin at one place.
LINE = "山海風山海風雨雲7x山風"


def token_lists(texts, lexicon):
    rows = matching.with_terms(texts, lexicon).collect()
    return {row["doc_id"]: row["terms"] for row in rows}


def by_join(lexicon):
    """The same dictionary, treated as too large for a pattern."""
    return Lexicon(lexicon.table, None)


@pytest.mark.parametrize(
    ("keywords", "expected"),
    [
        (["山海", "海風", "山海風", "雨雲", "風雨", "山風"], ["山海風", "山海風", "雨雲", "山風"]),
        (["山海風", "海風", "山海", "雨雲", "風雨"], ["山海", "山海", "風雨"]),
    ],
)
def test_tokens_of_the_sample_line(spark, texts, keywords, expected):
    lexicon = Lexicon.from_words(spark, keywords)
    assert token_lists(texts(LINE), lexicon) == {0: expected}
    assert token_lists(texts(LINE), by_join(lexicon)) == {0: expected}


def random_case(rng, alphabet):
    word = lambda most: "".join(rng.choices(alphabet, k=rng.randint(1, most)))
    keywords = list(dict.fromkeys(word(4) for _ in range(rng.randint(1, 40))))
    return keywords, ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(8)]


@pytest.mark.parametrize("alphabet", ["ab", "abcdefghij", ".*[](^$\\|?", "aé上𝒳\n \t-", "x'\"{}#&~"])
def test_patterns_against_loops(spark, texts, alphabet, monkeypatch):
    rng = random.Random(alphabet)
    monkeypatch.setattr(T, "FEW_KEYWORDS", 0)
    for _ in range(6):
        keywords, strings = random_case(rng, alphabet)
        df = texts(*strings)
        found = df.select(
            "doc_id",
            T.dictionary_tokens(F.col("text"), keywords).alias("tokens"),
            T.contained_keywords(F.col("text"), keywords).alias("contained"),
        ).collect()
        for row in found:
            text = strings[row["doc_id"]]
            assert row["tokens"] == naive.tokens(text, keywords)
            assert sorted(row["contained"]) == naive.contained(text, keywords)


@pytest.mark.parametrize("alphabet", ["ab", "aé上𝒳\n .*"])
def test_join_against_loops(spark, texts, alphabet):
    rng = random.Random(alphabet)
    keywords, strings = random_case(rng, alphabet)
    keywords.append(strings[0][:5] or "a")
    keywords = list(dict.fromkeys(keywords))
    lexicon = by_join(Lexicon.from_words(spark, keywords))
    df = texts(*strings)
    for doc_id, terms in token_lists(df, lexicon).items():
        assert terms == naive.tokens(strings[doc_id], keywords)
    for row in matching.with_keywords(df, lexicon).collect():
        assert sorted(row["keywords"]) == naive.contained(strings[row["doc_id"]], keywords)


def test_both_ways_agree_on_documents(spark, documents):
    words = [*KEYWORDS, "e", "tion", "entin", "a" * 200]
    lexicon = Lexicon.from_words(spark, words)
    assert lexicon.words is not None
    for operator, column in ((matching.with_terms, "terms"), (matching.with_keywords, "keywords")):
        here = operator(documents, lexicon)
        there = operator(documents, by_join(lexicon))
        assert here.columns == there.columns
        wrong = here.join(there.withColumnRenamed(column, "other"), "doc_id").where(
            F.sort_array(column) != F.sort_array("other")
            if column == "keywords"
            else F.col(column) != F.col("other")
        )
        assert wrong.count() == 0


def test_keywords_longer_than_the_window(spark, texts):
    long = "ab" * 100
    lexicon = Lexicon.from_words(spark, [long, long[:-1] + "x", "ab"])
    df = texts("z" + long, long[:-2])
    for lex in (lexicon, by_join(lexicon)):
        assert {
            row["doc_id"]: set(row["keywords"]) for row in matching.with_keywords(df, lex).collect()
        } == {0: {long, "ab"}, 1: {"ab"}}


def test_empty_and_missing_texts(spark, texts):
    lexicon = Lexicon.from_words(spark, ["a"])
    df = texts("", None, "b", "a")
    for lex in (lexicon, by_join(lexicon)):
        assert token_lists(df, lex) == {0: [], 1: [], 2: [], 3: ["a"]}
        rows = matching.with_keywords(df, lex).collect()
        assert {row["doc_id"]: row["keywords"] for row in rows} == {0: [], 1: [], 2: [], 3: ["a"]}


def test_contains_and_pattern_give_the_same_group_key(documents, monkeypatch):
    few = documents.select(T.contained_keywords(F.col("text"), KEYWORDS).alias("k")).collect()
    monkeypatch.setattr(T, "FEW_KEYWORDS", 0)
    many = documents.select(T.contained_keywords(F.col("text"), KEYWORDS).alias("k")).collect()
    assert few == many


def test_occurrences_do_not_overlap(texts):
    df = texts("aaaaa", "abab", "", "b.b.b")
    counted = df.select(
        T.occurrences(F.col("text"), "aa").alias("aa"), T.occurrences(F.col("text"), ".").alias("p")
    ).collect()
    assert [(row["aa"], row["p"]) for row in counted] == [(2, 0), (0, 0), (0, 0), (0, 2)]


@pytest.mark.parametrize("alphabet", ["ab", "abcd", "a.上𝒳"])
def test_keyword_counts_against_loops(texts, alphabet, monkeypatch):
    rng = random.Random(alphabet)
    for _ in range(4):
        keywords, strings = random_case(rng, alphabet)
        df = texts(*strings)
        for few in (0, 1000):
            monkeypatch.setattr(T, "FEW_KEYWORDS", few)
            counts = T.keyword_counts(F.col("text"), keywords)
            for row in df.select("doc_id", counts.alias("c")).collect():
                text = strings[row["doc_id"]]
                assert {c["kw"]: c["n"] for c in row["c"]} == {
                    kw: text.count(kw) for kw in keywords if kw in text
                }


def test_term_counts(spark):
    df = spark.createDataFrame([(["b", "a", "b"],), ([],), (["c"],)], "t array<string>")
    rows = df.select(T.term_counts(F.col("t")).alias("c")).collect()
    assert [[tuple(c) for c in row["c"]] for row in rows] == [
        [("a", 1), ("b", 2)],
        [],
        [("c", 1)],
    ]


def test_alternation_shares_prefixes_and_drops_what_cannot_match():
    assert patterns.alternation(["then", "the"]) == "the(?:n|)"
    assert patterns.alternation(["the", "then"]) == "the"
    assert patterns.nesting(patterns.alternation(["ab", "ac"])) == 1
    assert patterns.prefix_layers(["the", "a", "then", "there"]) == [["a", "the"], ["then", "there"]]


def test_deeply_nested_dictionaries_are_joined(spark):
    chain = ["a" * n for n in range(1, 2000)]
    assert Lexicon.from_words(spark, chain).words is None
