"""Keywords found in tasks: tries, filed keywords, and the pairs of what was found."""

import random

import numpy as np
import pytest
from newsloom.operators import cooccurrence, grams, keywords, matching, spotting
from newsloom.operators.lexicon import Lexicon

import naive


def random_case(seed, alphabet):
    rng = random.Random(seed)
    words = list(dict.fromkeys("".join(rng.choices(alphabet, k=rng.randint(1, 6))) for _ in range(40)))
    strings = ["".join(rng.choices(alphabet + "z", k=rng.randint(0, 90))) for _ in range(8)] + ["", None, "".join(words)]
    return words, strings


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("alphabet", ["ab", "abcdefghij", "aé上𝒳\n .*"])
@pytest.mark.parametrize(("steps", "chains", "cells"), [(8, 0, 0), (1 << 23, 32, 1 << 22)])
def test_places_of_a_trie_equal_a_loop(monkeypatch, alphabet, steps, chains, cells):
    for name, value in (("STEPS", steps), ("FEW_CHAINS", chains), ("CELLS", cells)):
        monkeypatch.setattr(spotting, name, value)
    for seed in range(8):
        words, strings = random_case(seed, alphabet)
        trie, texts = spotting.Trie(np.arange(len(words)), words), spotting.Texts(strings)
        rows, found, n = trie.counts(texts)
        counted = {(int(r), words[w]): int(c) for r, w, c in zip(rows, found, n, strict=True)}
        assert counted == {(i, w): s.count(w) for i, s in enumerate(strings) if s for w in words if w in s}
        rows, found = trie.cut(texts)
        for i, s in enumerate(strings):
            assert [words[w] for r, w in zip(rows, found, strict=True) if r == i] == naive.tokens(s or "", words)


@pytest.mark.parametrize("large", [False, True])
@pytest.mark.parametrize("slice_bytes", [grams.SLICE_BYTES, 600])
def test_dictionaries_in_tasks_and_in_slices(spark, texts, monkeypatch, large, slice_bytes):
    monkeypatch.setattr("newsloom.functions.text.FEW_KEYWORDS", 3)
    monkeypatch.setattr(grams, "SLICE_BYTES", slice_bytes)
    words, strings = random_case(3, "abc")
    lexicon = Lexicon.from_words(spark, words)
    lexicon = Lexicon(lexicon.table, None) if large else lexicon
    docs = texts(*strings)
    held = [s or "" for s in strings]
    counts = {(r["doc_id"], r["kw"]): r["n"] for r in keywords.keyword_occurrences(docs, lexicon).collect()}
    assert counts == {(i, w): s.count(w) for i, s in enumerate(held) for w in words if w in s}
    assert {r["kw"]: r["n"] for r in keywords.document_frequency(docs, lexicon).collect()} == {
        w: sum(w in s for s in held) for w in words if any(w in s for s in held)
    }
    assert {r["doc_id"]: r["terms"] for r in matching.with_terms(docs, lexicon).collect()} == {i: naive.tokens(s, words) for i, s in enumerate(held)}
    assert {r["doc_id"]: r["keywords"] for r in matching.with_keywords(docs, lexicon).collect()} == {
        i: sorted(naive.contained(s, words), key=str.encode) for i, s in enumerate(held)
    }
    pairs = {(r["kw"], r["other_kw"]): r["n"] for r in cooccurrence.edges(docs, lexicon).collect()}
    assert pairs == {
        (a, b): n for a in words for b in words if a != b and (n := sum(a in s and b in s for s in held))
    }


def test_matches_of_a_dictionary_that_fits_a_slice_are_not_shuffled(spark, texts):
    lexicon = Lexicon(Lexicon.from_words(spark, ["ab", "ba", "abc"]).table, None)
    docs = texts("abcab", "ba")
    for found in (keywords.keyword_occurrences(docs, lexicon), matching.with_terms(docs, lexicon)):
        assert "Exchange" not in plan(found) and "Join" not in plan(found)


def test_large_ids_and_frequent_ones_make_the_same_pairs(spark):
    sets = [[1, 5, 2**40], [1, 5], [5, 2**33, 2**40]] * 7
    table = spark.createDataFrame([(s,) for s in sets], "ids array<bigint>")
    for dense in ([], [5], [1, 5, 2**33, 2**40]):
        found = cooccurrence.pair_sums(table, np.array(dense, np.int64), heavy=2).collect()
        assert {(r["kw_id"], r["other_id"]): r["n"] for r in found} == {
            (1, 5): 14, (1, 2**40): 7, (5, 2**40): 14, (5, 2**33): 7, (2**33, 2**40): 7
        }
