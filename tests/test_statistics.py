import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from newsloom.operators import bayes, cooccurrence, embeddings, keywords, terms
from newsloom.operators.lexicon import Lexicon
from newsloom.operators.matching import with_terms
from newsloom.plans.queries import KEYWORDS


def pairs(df, *columns):
    return sorted(tuple(row[c] for c in columns) for row in df.collect())


@pytest.fixture(scope="module")
def starter(spark):
    return Lexicon.from_words(spark, KEYWORDS)


@pytest.fixture(scope="module")
def tokenized(documents, starter):
    return with_terms(documents.withColumnRenamed("lang", "label"), starter)


def test_document_frequency_counts_documents_and_sorts(spark, texts):
    lex = Lexicon.from_words(spark, ["a", "b", "never", "ab"])
    found = keywords.document_frequency(texts("a a a", "ab", "c"), lex).collect()
    assert [tuple(row) for row in found] == [(1, "ab"), (1, "b"), (2, "a")]


@pytest.fixture
def sample(spark, texts):
    """Documents with six sets of twelve keywords: empty, single, and three that share none."""
    lex = Lexicon.from_words(spark, [f"<{i}>" for i in range(12)])
    sets = [(1, 4), (0, 5, 7, 11), (3,), (), (2, 6, 8), (9, 10)]
    return lex, ["".join(f"<{i}>" for i in s) for s in sets]


def test_adjacency_of_the_sets(sample, texts):
    lex, strings = sample
    rows = cooccurrence.adjacency(cooccurrence.upper_edges(texts(*strings), lex)).collect()
    assert {row["kw_id"]: sorted(row["neighbours"]) for row in rows} == {
        0: [5, 7, 11], 1: [4], 2: [6, 8], 5: [7, 11], 6: [8], 7: [11], 9: [10],
    }
    doubled = cooccurrence.upper_edges(texts(*strings, *strings), lex)
    assert {row["n"] for row in doubled.collect()} == {2}
    wide = {row["kw_id"]: row for row in cooccurrence.adjacency(doubled).collect()}
    assert wide[2]["n_pairs"] == 4
    sparse = {row["kw_id"]: row for row in cooccurrence.adjacency_rows(doubled).collect()}
    assert (sparse[5]["indices"], sparse[5]["counts"]) == ([7, 11], [2, 2])


def test_partners(spark, sample, texts):
    lex, strings = sample
    edges = cooccurrence.edges(texts(*strings, strings[4]), lex)
    assert [tuple(r) for r in cooccurrence.partners_of(edges, "<0>").limit(2).collect()] == [
        ("<11>", 1),
        ("<5>", 1),
    ]
    assert cooccurrence.partners_of(edges, "unknown").collect() == []
    top = cooccurrence.partners_of(edges, "<2>", ascending=False).first()
    assert tuple(top) == ("<8>", 2)
    assert pairs(cooccurrence.partner_ids(edges, 2), "other_id", "n") == [(6, 2), (8, 2)]
    asked = spark.createDataFrame([("<0>",), ("<3>",), ("unknown",)], "kw string")
    counts = cooccurrence.partner_count(edges, lex, asked)
    assert dict(pairs(counts, "kw", "n_partners")) == {"<0>": 3, "<3>": 0, "unknown": -1}
    report = {r["kw"]: r for r in cooccurrence.keyword_report(edges, lex).collect()}
    assert len(report) == 12
    assert report["<3>"]["n_partners"] == 0 and report["<3>"]["partners"] == ""
    assert report["<6>"]["partners"] == "<2>:2,<8>:2"


@pytest.mark.parametrize("kw", [*KEYWORDS[:6], "ing", "zzzqq", "not in the dictionary"])
def test_partners_in_documents_are_those_of_the_edges(documents, starter, kw):
    edges = cooccurrence.edges(documents, starter)
    found = cooccurrence.partners_in(documents, starter, kw)
    expected = pairs(edges.where(F.col("kw") == kw), "other_id", "other_kw", "n")
    assert pairs(found, "other_id", "other_kw", "n") == expected


def test_partners_in_documents_form_no_pairs(documents, starter):
    found = cooccurrence.partners_in(documents, starter, "the")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "other_id" not in plan.split("Exchange", 1)[1] and "posexplode" not in plan


def test_cooccurrence_is_symmetric_and_bounded(documents, starter):
    edges = cooccurrence.edges(documents, starter).collect()
    n = {(e["kw"], e["other_kw"]): e["n"] for e in edges}
    df = {r["kw"]: r["n"] for r in keywords.document_frequency(documents, starter).collect()}
    assert n and all(n[a, b] == n[b, a] <= min(df[a], df[b]) for a, b in n)
    asked = [("the", "and"), ("the", "zzzqq")]
    counted = keywords.pair_count(documents, asked)
    assert pairs(counted, "kw", "other_kw", "n") == [
        ("the", "and", n["the", "and"]),
        ("the", "zzzqq", 0),
    ]


def test_large_dictionary_gives_the_same_edges(documents, starter):
    columns = ("kw_id", "other_id", "kw", "other_kw", "n")
    joined = cooccurrence.edges(documents, Lexicon(starter.table, None))
    assert pairs(joined, *columns) == pairs(cooccurrence.edges(documents, starter), *columns)


def test_idf_divides_documents_by_occurrences(spark, texts):
    lex = Lexicon.from_words(spark, ["x", "y"])
    idf = terms.custom_idf(with_terms(texts("x x", "x", "", "y"), lex))
    assert dict(pairs(idf, "term", "idf")) == {"x": 4 / 3, "y": 4.0}
    assert 13870 / 3 == 4623.333333333333


def test_shares_sum_to_one_and_both_weightings_agree(tokenized):
    idf = terms.custom_idf(tokenized)
    ones = idf.withColumn("idf", F.lit(1.0))
    sums = terms.tfidf(tokenized, ones, small=True).groupBy("doc_id").agg(F.sum("weight").alias("s"))
    assert all(math.isclose(row["s"], 1.0) for row in sums.collect())
    same = terms.tfidf(tokenized, idf, small=True).collect()
    vocabulary = [r["term"] for r in idf.collect()]
    in_row = terms.tfidf(tokenized, idf, small=True, vocabulary=vocabulary).collect()
    assert sorted(in_row) == sorted(same)
    assert sorted(same) == sorted(terms.tfidf_in_corpus(tokenized, idf, small=True).collect())
    shuffled = terms.tfidf(tokenized, idf, small=False).collect()
    assert sorted(shuffled) == sorted(same)


def test_unknown_terms_leave_the_denominator(spark, texts):
    lex = Lexicon.from_words(spark, ["x", "y", "z"])
    idf = terms.custom_idf(with_terms(texts("x", "y"), lex))
    assert sorted(terms.small_vocabulary(idf, lex)) == ["x", "y"]
    assert terms.small_vocabulary(idf, Lexicon(lex.table, None)) is None
    for vocabulary in (None, ["x", "y"]):
        tok = with_terms(texts("x z z z y", "z"), lex)
        weights = terms.tfidf(tok, idf, vocabulary=vocabulary)
        assert pairs(weights, "term", "weight") == [("x", 1.0), ("y", 1.0)]


def test_term_and_label_numbers(spark, tokenized):
    found = terms.term_dictionary(tokenized).orderBy("term_id").collect()
    assert [r["term_id"] for r in found] == list(range(len(found)))
    assert [r["term"] for r in found] == sorted(r["term"] for r in found)
    labels = spark.createDataFrame([(3, "a"), (1, "b"), (2, "a")], "doc_id int, label string")
    assert pairs(terms.label_dictionary(labels), "label_id", "label") == [(0, "b"), (1, "a")]


def test_document_ratio_counts_a_document_once(spark, texts):
    lex = Lexicon.from_words(spark, ["x", "y"])
    ratio = terms.document_ratio(with_terms(texts("x x", "y", "", "xy"), lex))
    assert pairs(ratio, "term", "n_docs", "ratio") == [("x", 2, 0.5), ("y", 2, 0.5)]


def test_model_equals_the_library_trained_on_all_documents(tokenized):
    model = bayes.train(tokenized)
    vocabulary = [r["term"] for r in model.terms.orderBy("term_id").collect()]
    idf = [r["idf"] for r in model.terms.orderBy("term_id").collect()]
    labelled = tokenized.join(model.labels.select("label_id", "label"), "label").withColumn(
        "target", F.col("label_id").cast("double")
    )
    for stage in (
        CountVectorizerModel.from_vocabulary(vocabulary, inputCol="terms", outputCol="c"),
        Normalizer(p=1.0, inputCol="c", outputCol="tf"),
        ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="tf", outputCol="w"),
    ):
        labelled = stage.transform(labelled)
    library = NaiveBayes(featuresCol="w", labelCol="target", predictionCol="p").fit(labelled)
    ours = model.weights.collect()
    for row in ours:
        theta = library.theta[row["label_id"], vocabulary.index(row["term"])]
        assert math.isclose(row["theta"], theta, abs_tol=1e-9)
    for row in model.labels.collect():
        assert math.isclose(row["prior"], library.pi[row["label_id"]], abs_tol=1e-12)
    fitted = bayes.pipeline_of(model).stages[1]
    for label in range(len(library.pi)):
        for term in range(len(vocabulary)):
            assert math.isclose(fitted.theta[label, term], library.theta[label, term], abs_tol=1e-9)
    predicted = library.transform(labelled).select("doc_id", "p")
    names = {r["label_id"]: r["label"] for r in model.labels.collect()}
    expected = {r["doc_id"]: names[int(r["p"])] for r in predicted.collect()}
    pipeline = bayes.pipeline_of(model).transform(tokenized.select("doc_id", "terms"))
    assert dict(pairs(pipeline, "doc_id", "label")) == expected
    for small in (True, False):
        assert dict(pairs(bayes.predict(tokenized, model, small=small), "doc_id", "label")) == expected


def test_prediction_of_unknown_texts_is_the_prior(spark, texts, tokenized, starter, monkeypatch):
    model = bayes.train(tokenized)
    prior = model.labels.orderBy(F.desc("prior"), "label_id").first()["label"]
    strange = texts("", "!!!", None)
    assert {r["label"] for r in bayes.classify(strange, starter, model).collect()} == {prior}
    monkeypatch.setattr(bayes, "MAX_CELLS", 3)
    assert bayes.pipeline_of(model) is None
    found = bayes.classify(strange, starter, model).collect()
    assert [r["label"] for r in found] == [prior] * 3


def test_saved_models_predict_the_same(spark, tokenized, documents, starter, tmp_path):
    model = bayes.train(tokenized, smoothing=0.5)
    model.save(str(tmp_path / "m"))
    loaded = bayes.BayesModel.load(spark, str(tmp_path / "m"))
    assert loaded.smoothing == 0.5
    before = bayes.classify(documents, starter, model)
    after = bayes.classify(documents, starter, loaded)
    assert pairs(before, "doc_id", "label") == pairs(after, "doc_id", "label")
    histogram = bayes.label_histogram(after).collect()
    assert sum(r["n"] for r in histogram) == documents.count()
    with pytest.raises(Exception, match="already exists"):
        model.save(str(tmp_path / "m"))
    bayes.pipeline_of(model).save(str(tmp_path / "p"))
    pipeline = PipelineModel.load(str(tmp_path / "p"))
    again = pipeline.transform(tokenized.select("doc_id", "terms"))
    assert pairs(again, "doc_id", "label") == pairs(before, "doc_id", "label")


def test_vectors_are_sparse_and_empty_without_known_terms(spark, texts, tokenized, starter):
    model = bayes.train(tokenized)
    found = bayes.tfidf_vectors(with_terms(texts("the the and", "?"), starter), model).collect()
    size = model.terms.count()
    assert [(row["weights"].size, len(row["weights"].indices)) for row in found] == [
        (size, 2),
        (size, 0),
    ]


def test_hashed_weights_use_the_smoothed_log(spark, texts):
    lex = Lexicon.from_words(spark, ["x", "y"])
    tok = with_terms(texts("x x y", "y", ""), lex)
    found = embeddings.hashed_weights(embeddings.fit_hashing_tfidf(tok), tok, lex)
    expected = [(0, "x", 2 * math.log(4 / 2)), (0, "y", math.log(4 / 3)), (1, "y", math.log(4 / 3))]
    got = pairs(found, "doc_id", "term", "weight")
    assert [g[:2] for g in got] == [e[:2] for e in expected]
    assert all(math.isclose(g[2], e[2]) for g, e in zip(got, expected, strict=True))


def test_hashed_weights_of_a_large_dictionary(spark, texts, monkeypatch):
    small = Lexicon.from_words(spark, ["x", "y", "z"])
    tok = with_terms(texts("x x y", "y", "z z"), small)
    model = embeddings.fit_hashing_tfidf(tok, num_features=2)
    large = Lexicon(small.table)
    assert large.words is None
    expected = pairs(embeddings.hashed_weights(model, tok, small), "doc_id", "term", "weight")
    assert expected and any("|" in e[1] for e in expected)
    assert pairs(embeddings.hashed_weights(model, tok, large), "doc_id", "term", "weight") == expected


def test_vectors_of_an_empty_vocabulary_are_empty(spark, texts, starter):
    tokenized = with_terms(texts("?", "!").withColumn("label", F.lit("a")), starter)
    found = bayes.tfidf_vectors(tokenized, bayes.train(tokenized)).collect()
    assert [len(row["weights"]) for row in found] == [0, 0]


@pytest.mark.parametrize(
    "words",
    [
        [f"same beginning {i:04d}" for i in range(300)],
        [chr(0x4E00 + i) for i in range(300)],
        ["\U0001d4b3", "\uff5e", "a", ""],
        [],
    ],
)
def test_numbers_follow_the_order_whatever_the_beginnings(spark, words):
    df = spark.createDataFrame([(w,) for w in reversed(words)], "term string")
    found = terms.numbered_by_range(df, ["term"], "term_id").collect()
    ordered = sorted(words, key=str.encode)
    assert {row["term"]: row["term_id"] for row in found} == {w: i for i, w in enumerate(ordered)}
