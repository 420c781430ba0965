"""The five jobs, from files to results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators import bayes, cooccurrence, embeddings, keywords, matrix, skipgram
from newsloom.operators.lexicon import Lexicon
from newsloom.operators.matching import with_terms
from newsloom.sources import files, sinks


def keyword_frequency(spark: SparkSession, docs: str, dictionary: str, out: str) -> None:
    """Write ``(count,keyword)`` lines: in how many documents each keyword occurs."""
    lexicon = Lexicon.from_table(files.read_dictionary(spark, dictionary))
    counts = keywords.document_frequency(files.read_documents(spark, docs), lexicon)
    sinks.write_counts(counts, out)


def keyword_partners(spark: SparkSession, docs: str, dictionary: str) -> DataFrame:
    """For every keyword, with how many and with which others it shares documents."""
    lexicon = Lexicon.from_table(files.read_dictionary(spark, dictionary))
    edges = cooccurrence.edges(files.read_documents(spark, docs), lexicon)
    return cooccurrence.keyword_report(edges, lexicon).orderBy("kw_id")


def train_classifier(
    spark: SparkSession, training: str, dictionary: str, model_path: str
) -> bayes.BayesModel:
    """Train on ``id, label, text`` lines and save the model."""
    lexicon = Lexicon.from_table(files.read_dictionary(spark, dictionary))
    docs = files.read_labelled(spark, training)
    model = bayes.train(with_terms(docs, lexicon, key=("line",)), key="line")
    model.save(model_path)
    return model


def classify_documents(
    spark: SparkSession, docs: str, dictionary: str, model_path: str
) -> DataFrame:
    """``doc_id, label`` for every line of a file."""
    lexicon = Lexicon.from_table(files.read_dictionary(spark, dictionary))
    model = bayes.BayesModel.load(spark, model_path)
    return bayes.classify(files.read_documents(spark, docs), lexicon, model)


def classify_first(spark: SparkSession, docs: str, dictionary: str, model_path: str) -> DataFrame:
    """``doc_id, label`` for the first line of a file."""
    lexicon = Lexicon.from_table(files.read_dictionary(spark, dictionary))
    model = bayes.BayesModel.load(spark, model_path)
    first = files.read_documents(spark, docs).orderBy("doc_id").limit(1)
    return bayes.classify(first, lexicon, model)


def classify_histogram(
    spark: SparkSession, docs: str, dictionary: str, model_path: str
) -> DataFrame:
    """Documents by predicted label."""
    return bayes.label_histogram(classify_documents(spark, docs, dictionary, model_path))


def word_synonyms(spark: SparkSession, segmented: str, word: str, k: int = 10) -> DataFrame:
    """The words nearest to a word, by vectors trained on segmented text."""
    vectors = skipgram.fit(files.read_segmented(spark, segmented))
    asked = spark.createDataFrame([(word,)], "word string")
    found = embeddings.nearest(vectors, asked, k)
    return found.orderBy("rank").select(F.col("neighbour").alias("word"), "similarity")


def matrix_product(spark: SparkSession, left: str, right: str) -> DataFrame:
    """The rows of the left matrix times the right matrix."""
    return matrix.multiply_rows(
        files.read_sparse_rows(spark, left), files.read_matrix(spark, right)
    )
