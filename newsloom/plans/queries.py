"""Every operator as a query over the given Parquet tables.

``documents`` is the news content, its ``lang`` the label of the classification job. The
embeddings table holds word vectors and, read as rows of numbers, a matrix.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import text as T
from newsloom.functions.vectors import sparse_entries
from newsloom.lineage import fresh_path, materialize
from newsloom.operators import (
    artifacts,
    bayes,
    cooccurrence,
    embeddings,
    keywords,
    matrix,
    neighbours,
    skipgram,
    terms,
    tiles,
)
from newsloom.operators.lexicon import Lexicon
from newsloom.operators.matching import with_terms
from newsloom.plans import jobs
from newsloom.sources import files, sinks
from newsloom.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

#: The keyword list of the small dictionary, in order (fixed values).
KEYWORDS = [
    "the",
    "then",
    "there",
    "for",
    "worthless",
    "and",
    "with",
    "les",
    "les des",
    "der",
    "und",
    "que",
    "para",
    "pathetic",
    "ing",
    "inge",
    "zzzqq",
]

#: Keyword pairs asked for by ``pair_count`` (fixed values).
PAIRS = [("the", "and"), ("les", "que"), ("worthless", "pathetic"), ("the", "zzzqq")]

#: The keyword asked for by ``partners_of`` and the position asked for by ``partner_ids``.
ASKED_KEYWORD = "les"
ASKED_POSITION = 9

#: The month, and the beginning of the months, that are read by name (fixed values).
MONTH, LAST_MONTHS = "200812", "20081"

#: The word looked up by ``word2vec_synonyms``.
ASKED_WORD = "the"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/documents.parquet", spread_by="doc_id").select(
        "doc_id", "text", F.col("lang").alias("label")
    )


def _corpora(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The texts to classify: name -> ``corpus, id, part, text``."""

    def corpus(name: str, key: str, part: Column, text: str) -> DataFrame:
        table = read_table(spark, f"{sf_dir}/{name}.parquet", spread_by=key)
        return table.select(
            F.lit(name).alias("corpus"), F.col(key).alias("id"), part.alias("part"),
            F.col(text).alias("text"),
        )

    no_part = F.lit(0).cast("bigint")
    return {
        "documents": corpus("documents", "doc_id", no_part, "text"),
        "pages": corpus("pages", "page_id", no_part, "html"),
        "conversations": corpus("conversations", "conv_id", F.col("turn"), "text"),
        "benchmark": corpus("benchmark", "item_id", no_part, "text"),
    }


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``item_id, kw``: the words of the benchmark table."""
    items = read_table(spark, f"{sf_dir}/benchmark.parquet")
    return items.select("item_id", F.explode(F.split("text", r"[^\p{L}]+")).alias("kw")).where(
        F.col("kw") != ""
    )


def _keywords(spark: SparkSession, sf_dir: str) -> Lexicon:
    return Lexicon.from_words(spark, KEYWORDS)


def _lexicon(spark: SparkSession, sf_dir: str) -> Lexicon:
    """A dictionary that grows with the data: all benchmark words, by first item and spelling."""
    first = _words(spark, sf_dir).groupBy("kw").agg(F.min("item_id").alias("first"))
    numbered = terms.numbered(first, F.col("first"), ["kw"], "kw_id")
    return Lexicon.from_table(numbered.select("kw_id", "kw"))


def _joined(spark: SparkSession, sf_dir: str) -> Lexicon:
    """The same dictionary, treated as too large for a pattern."""
    return Lexicon(_lexicon(spark, sf_dir).table, None)


Dictionary = Callable[[SparkSession, str], Lexicon]


def _tokenized(spark: SparkSession, sf_dir: str, lexicon: Lexicon) -> DataFrame:
    return with_terms(_documents(spark, sf_dir), lexicon)


def _model(spark: SparkSession, sf_dir: str, lexicon: Lexicon) -> bayes.BayesModel:
    return bayes.train(_tokenized(spark, sf_dir, lexicon))


# Keyword statistics


def keyword_doc_freq(dictionary: Dictionary) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return keywords.document_frequency(_documents(spark, sf_dir), dictionary(spark, sf_dir))

    return query


def keyword_occurrences(dictionary: Dictionary) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return keywords.keyword_occurrences(_documents(spark, sf_dir), dictionary(spark, sf_dir))

    return query


def pair_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords.pair_count(_documents(spark, sf_dir), PAIRS)


def docs_with_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return docs.where(T.contains_both(F.col("text"), *PAIRS[0])).select("doc_id")


# Co-occurrence


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cooccurrence.edges(_documents(spark, sf_dir), _keywords(spark, sf_dir))


def _upper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cooccurrence.upper_edges(_documents(spark, sf_dir), _keywords(spark, sf_dir))


def cooccurrence_all(dictionary: Dictionary) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return cooccurrence.edges(_documents(spark, sf_dir), dictionary(spark, sf_dir))

    return query


def cooccurrence_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cooccurrence.adjacency(_upper(spark, sf_dir))
    pairs = F.transform(
        F.map_entries("neighbours"), lambda e: F.concat_ws(":", e["key"], e["value"])
    )
    return rows.select("kw_id", "n_pairs", F.array_join(pairs, ",").alias("neighbours"))


def adjacency_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cooccurrence.adjacency_rows(_upper(spark, sf_dir))
    return rows.select(
        "kw_id",
        F.array_join(F.col("indices").cast("array<string>"), ",").alias("indices"),
        F.array_join(F.col("counts").cast("array<string>"), ",").alias("counts"),
    )


def partner_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = _words(spark, sf_dir).select("kw").distinct()
    return cooccurrence.partner_count(_edges(spark, sf_dir), _keywords(spark, sf_dir), asked)


def partners_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cooccurrence.partners_in(
        _documents(spark, sf_dir), _keywords(spark, sf_dir), ASKED_KEYWORD
    )
    return found.select("other_kw", "n").orderBy("n", "other_kw")


def partner_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    lexicon = _keywords(spark, sf_dir)
    asked = spark.createDataFrame([(ASKED_POSITION,)], "kw_id int")
    kw = lexicon.keyword_at(asked).first()["kw"]
    return cooccurrence.partners_in(_documents(spark, sf_dir), lexicon, kw).select("other_id", "n")


def keyword_report(dictionary: Dictionary) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        lexicon = dictionary(spark, sf_dir)
        edges = cooccurrence.edges(_documents(spark, sf_dir), lexicon)
        return cooccurrence.keyword_report(edges, lexicon)

    return query


# Dictionary and terms


def dictionary_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = _words(spark, sf_dir).select("kw").distinct()
    return _keywords(spark, sf_dir).index_of(asked)


def dictionary_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, f"{sf_dir}/embeddings.parquet")
    asked = vectors.select(F.col("vec_id").cast("int").alias("kw_id"))
    return _keywords(spark, sf_dir).keyword_at(asked).select("kw_id", "kw")


def dictionary_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lexicon(spark, sf_dir).size()


def dict_tokens(dictionary: Dictionary) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tokenized = _tokenized(spark, sf_dir, dictionary(spark, sf_dir))
        return tokenized.select(
            "doc_id",
            F.size("terms").cast("bigint").alias("n_terms"),
            F.array_join("terms", "|").alias("terms"),
        )

    return query


def term_dictionary(dictionary: Dictionary) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return terms.term_dictionary(_tokenized(spark, sf_dir, dictionary(spark, sf_dir)))

    return query


def label_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.label_dictionary(_documents(spark, sf_dir))


def custom_idf(dictionary: Dictionary) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        idf = terms.custom_idf(_tokenized(spark, sf_dir, dictionary(spark, sf_dir)))
        return idf.withColumn("idf", F.round("idf", 9))

    return query


def token_doc_ratio(dictionary: Dictionary) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ratio = terms.document_ratio(_tokenized(spark, sf_dir, dictionary(spark, sf_dir)))
        return ratio.withColumn("ratio", F.round("ratio", 9))

    return query


def tfidf(dictionary: Dictionary) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        lexicon = dictionary(spark, sf_dir)
        tokenized = _tokenized(spark, sf_dir, lexicon)
        weights = terms.tfidf_in_corpus(
            tokenized, terms.custom_idf(tokenized), small=lexicon.is_small
        )
        return weights.withColumn("weight", F.round("weight", 9))

    return query


def tfidf_new_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations weighted with the idf of the documents: unknown terms drop out first."""
    lexicon = _lexicon(spark, sf_dir)
    idf = materialize(terms.custom_idf(_tokenized(spark, sf_dir, lexicon)), "idf")
    turns = with_terms(_corpora(spark, sf_dir)["conversations"], lexicon, key=("id", "part"))
    weights = terms.tfidf(
        turns,
        idf,
        key=("id", "part"),
        small=lexicon.is_small,
        vocabulary=terms.small_vocabulary(idf, lexicon),
    )
    return weights.withColumn("weight", F.round("weight", 9))


def tfidf_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weights as sparse vectors, listed as ``doc_id, term_id, weight``."""
    tokenized = _tokenized(spark, sf_dir, _keywords(spark, sf_dir))
    vectors = bayes.tfidf_vectors(tokenized, bayes.train(tokenized))
    listed = vectors.select("doc_id", F.inline(sparse_entries("weights", "term_id", "weight")))
    return listed.where(F.col("weight") != 0).withColumn("weight", F.round("weight", 9))


# Classification


def nb_model(dictionary: Dictionary) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        model = _model(spark, sf_dir, dictionary(spark, sf_dir))
        return model.weights.select("label_id", "label", "term", F.round("theta", 9).alias("theta"))

    return query


def nb_priors(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _model(spark, sf_dir, _keywords(spark, sf_dir))
    return model.labels.select("label_id", "label", "n_docs", F.round("prior", 9).alias("prior"))


def nb_predict(dictionary: Dictionary, corpus: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        lexicon = dictionary(spark, sf_dir)
        model = _model(spark, sf_dir, lexicon)
        texts = _corpora(spark, sf_dir)[corpus]
        return bayes.classify(texts, lexicon, model, key=("id", "part"))

    return query


def nb_predict_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same prediction by joins alone, as for models too large for the pipeline."""
    lexicon = _lexicon(spark, sf_dir)
    model = _model(spark, sf_dir, lexicon)
    # Written, as the joins read the terms more than once.
    texts = with_terms(_corpora(spark, sf_dir)["conversations"], lexicon, key=("id", "part"))
    texts = materialize(texts.select("id", "part", "terms"), "turn-terms")
    return bayes.predict(texts, model, key=("id", "part"), small=lexicon.is_small)


def nb_label_hist(dictionary: Dictionary) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        lexicon = dictionary(spark, sf_dir)
        model = _model(spark, sf_dir, lexicon)
        texts = reduce(DataFrame.unionByName, _corpora(spark, sf_dir).values())
        predicted = bayes.classify(texts, lexicon, model, key=("corpus", "id", "part"))
        return predicted.groupBy("corpus", "label").agg(F.count(F.lit(1)).alias("n"))

    return query


def nb_predict_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    lexicon = _lexicon(spark, sf_dir)
    model = _model(spark, sf_dir, lexicon)
    pages = _corpora(spark, sf_dir)["pages"]
    return bayes.classify(pages.orderBy("id").limit(1), lexicon, model, key=("id",))


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Save the trained model, load it again and classify with it."""
    lexicon = _keywords(spark, sf_dir)
    path = fresh_path(spark, "bayes-model")
    _model(spark, sf_dir, lexicon).save(path)
    texts = _corpora(spark, sf_dir)["documents"]
    return bayes.classify(texts, lexicon, bayes.BayesModel.load(spark, path), key=("id", "part"))


def hashing_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    lexicon = _keywords(spark, sf_dir)
    tokenized = _tokenized(spark, sf_dir, lexicon)
    model = embeddings.fit_hashing_tfidf(tokenized)
    weights = embeddings.hashed_weights(model, tokenized, lexicon)
    return weights.withColumn("weight", F.round("weight", 9))


# Vectors and matrices


def _matrix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The embeddings as sparse rows, and the sum of each label's vectors as a small matrix."""
    vectors = read_table(spark, f"{sf_dir}/embeddings.parquet", spread_by="vec_id")
    rows = vectors.select(
        F.col("vec_id").alias("row"), matrix.sparse_entries(F.col("embedding")).alias("entries")
    )
    sums = (
        vectors.select(F.col("label").alias("col"), F.posexplode("embedding").alias("row", "v"))
        .groupBy("row", "col")
        .agg(F.sum(F.col("v").cast("double")).alias("value"))
    )
    return rows, materialize(sums, "label-sums")


def matmul(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, sums = _matrix(spark, sf_dir)
    product = matrix.matmul(matrix.cells(rows), sums)
    return product.withColumn("value", F.round("value", 6))


def row_matrix_multiply(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, sums = _matrix(spark, sf_dir)
    product = matrix.multiply_rows(rows, sums)
    return product.select("row", F.posexplode("values").alias("col", "v")).select(
        "row", "col", F.round("v", 6).alias("value")
    )


def transpose(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.transpose(matrix.cells(_matrix(spark, sf_dir)[0]))


def matrix_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, f"{sf_dir}/embeddings.parquet", spread_by="vec_id")
    return matrix.dense_shape(vectors, "embedding")


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of the first vector of every label."""
    vectors = read_table(spark, f"{sf_dir}/embeddings.parquet", spread_by="vec_id")
    asked = vectors.groupBy("label").agg(F.min("vec_id").alias("vec_id")).select("vec_id")
    found = embeddings.nearest(vectors, asked, 10, word="vec_id", vector="embedding")
    return found.withColumn("similarity", F.round("similarity", 9))


def nearest_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every vector, each group of vectors left out that can't hold one."""
    vectors = read_table(spark, f"{sf_dir}/embeddings.parquet", spread_by="vec_id")
    found = neighbours.nearest_many(vectors, vectors.select("vec_id"), 10, word="vec_id", vector="embedding")
    return found.withColumn("similarity", F.round("similarity", 9))


def gram_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transposed matrix of all vectors times the matrix itself, by tiles."""
    cells = materialize(matrix.cells(_matrix(spark, sf_dir)[0]), "vector-cells")
    return tiles.product(matrix.transpose(cells), cells).withColumn("value", F.round("value", 6))


def _segmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return docs.select(F.split(sinks.one_line(F.col("text")), " ").alias("tokens"))


def word2vec_synonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten words nearest to a word, by vectors trained on the documents."""
    vectors = skipgram.fit(_segmented(spark, sf_dir))
    asked = vectors.where(F.col("word") == ASKED_WORD).select("word")
    found = embeddings.nearest(vectors, asked, 10).orderBy("rank")
    return found.select(F.col("neighbour").alias("word"), "similarity")


def word2vec_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that vectors are trained for, with their numbers and occurrences."""
    return skipgram.vocabulary(_segmented(spark, sf_dir))


def word2vec_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the training counts: for every word the different words near it, and their weight."""
    segmented = _segmented(spark, sf_dir)
    words = skipgram.vocabulary(segmented)
    pairs = skipgram.pair_weights(segmented, words)
    per_word = pairs.groupBy("center").agg(
        F.count(F.lit(1)).alias("n_contexts"), F.round(F.sum("weight"), 6).alias("weight")
    )
    return words.join(per_word, F.col("id") == F.col("center")).select("word", "n_contexts", "weight")


# Files


def labelled_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as tab-separated lines and read back."""
    path = fresh_path(spark, "labelled")
    sinks.write_labelled(_documents(spark, sf_dir), path)
    return files.read_labelled(spark, path).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "label", "text"
    )


def document_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword counts of documents read from a text file, one line each."""
    path = fresh_path(spark, "documents")
    docs = _documents(spark, sf_dir)
    docs.select(sinks.one_line(F.col("text")).alias("value")).write.text(path)
    lexicon = _keywords(spark, sf_dir)
    return keywords.document_frequency(files.read_documents(spark, path), lexicon)


def dictionary_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark words as a dictionary file, read back with line positions."""
    path = fresh_path(spark, "dictionary")
    lexicon = _lexicon(spark, sf_dir)
    lines = lexicon.table.orderBy("kw_id").select(
        F.concat("kw", F.lit(" n"), F.col("kw_id").cast("string")).alias("value")
    )
    lines.coalesce(1).write.text(path)
    return files.read_dictionary(spark, path)


def segmented_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word frequencies of documents read as pre-segmented lines."""
    path = fresh_path(spark, "segmented")
    docs = _documents(spark, sf_dir)
    docs.select(sinks.one_line(F.col("text")).alias("value")).write.text(path)
    tokens = files.read_segmented(spark, path).select(F.explode("tokens").alias("token"))
    return tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def _monthly(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A folder with a folder of tab-separated documents for each month; a document's month follows its id."""
    path = fresh_path(spark, name)
    docs = _documents(spark, sf_dir)
    month = F.concat(F.lit("2008"), F.lpad((F.pmod("doc_id", F.lit(12)) + 1).cast("string"), 2, "0"))
    line = F.concat_ws("\t", F.col("doc_id").cast("string"), "label", sinks.one_line(F.col("text")))
    docs.select(line.alias("value"), month.alias("month")).write.option(
        "maxRecordsPerFile", 1000
    ).partitionBy("month").text(path)
    return path


def path_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and characters of the folders whose name holds ``20081``: the last three months of the year."""
    path = _monthly(spark, sf_dir, "by-month")
    lines = files.read_lines_with_path(spark, path, name_contains=LAST_MONTHS)
    return (
        lines.groupBy(F.regexp_extract("path", "month=([^/]*)/", 1).alias("month"))
        .agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("text")).alias("n_chars"))
    )


def whole_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of every label's folder, read whole: lines and characters."""
    path = fresh_path(spark, "whole")
    docs = _documents(spark, sf_dir)
    docs.select(sinks.one_line(F.col("text")).alias("value"), "label").write.option(
        "maxRecordsPerFile", 1000
    ).partitionBy("label").text(path)
    contents = files.read_whole_files(spark, path, name_contains="label=")
    breaks = F.length("content") - F.length(F.replace("content", F.lit("\n")))
    return (
        contents.groupBy(F.regexp_extract("path", "label=([^/]*)/", 1).alias("label"))
        .agg(
            F.sum(breaks).cast("bigint").alias("n_lines"),
            F.sum(F.length("content")).alias("n_chars"),
        )
    )


def month_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In how many documents of one month each keyword occurs, in the third field of the month's files."""
    path = _monthly(spark, sf_dir, "month")
    lines = files.read_lines_with_path(spark, path, name_contains=MONTH)
    bodies = lines.select(files.tab_field(F.col("text"), 2).alias("text"))
    return keywords.document_frequency(bodies, _keywords(spark, sf_dir))


def classification_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classification from files to histogram: training lines, dictionary and texts are written and read."""
    paths = {name: fresh_path(spark, f"news-{name}") for name in ("training", "dictionary", "texts", "model")}
    sinks.write_labelled(_documents(spark, sf_dir), paths["training"])
    words = _keywords(spark, sf_dir).table.orderBy("kw_id").select(F.col("kw").alias("value"))
    # The file format ends a keyword at its first blank.
    words.where(~F.contains("value", F.lit(" "))).coalesce(1).write.text(paths["dictionary"])
    turns = read_table(spark, f"{sf_dir}/conversations.parquet", spread_by="conv_id")
    turns.select(sinks.one_line(F.col("text")).alias("value")).write.text(paths["texts"])
    jobs.train_classifier(spark, paths["training"], paths["dictionary"], paths["model"])
    return jobs.classify_histogram(spark, paths["texts"], paths["dictionary"], paths["model"])


# What is kept between runs


def edge_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of all documents from batches by language, one of them added twice, half of them compacted."""
    lexicon = _keywords(spark, sf_dir)
    store = artifacts.EdgeStore(spark, fresh_path(spark, "edge-store"))
    docs = _documents(spark, sf_dir)
    english = F.col("label").eqNullSafe("en")
    for name, part in (("en", english), ("de", F.col("label").eqNullSafe("de")), ("en", english)):
        store.add(name, cooccurrence.edge_counts(docs.where(part), lexicon), lexicon.table)
    store.compact()
    others = ~english & ~F.col("label").eqNullSafe("de")
    store.add("others", cooccurrence.edge_counts(docs.where(others), lexicon), lexicon.table)
    return cooccurrence.both_directions(cooccurrence.named_edges(store.counts(), lexicon))


def _saved(spark: SparkSession, sf_dir: str) -> artifacts.Artifact:
    """Dictionary, idf, classifier, edges and vectors, saved as one artifact and loaded."""
    lexicon = _keywords(spark, sf_dir)
    tokenized = _tokenized(spark, sf_dir, lexicon)
    model = bayes.train(tokenized)
    vectors = read_table(spark, f"{sf_dir}/embeddings.parquet").select(
        F.col("vec_id").alias("word"), F.col("embedding").alias("vector")
    )
    path = fresh_path(spark, "news-model")
    artifacts.save(
        path,
        {
            "dictionary": lexicon.table,
            "idf": terms.custom_idf(tokenized),
            **model.tables(),
            "edges": cooccurrence.edge_counts(_documents(spark, sf_dir), lexicon),
            "vectors": vectors,
        },
        smoothing=model.smoothing,
    )
    return artifacts.load(spark, path)


def saved_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations classified with a dictionary and a model that were saved and loaded."""
    saved = _saved(spark, sf_dir)
    texts = _corpora(spark, sf_dir)["conversations"]
    lexicon = Lexicon.from_table(saved["dictionary"])
    return bayes.classify(texts, lexicon, bayes.BayesModel.of(saved), key=("id", "part"))


def saved_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations weighted with a dictionary and an idf that were saved and loaded."""
    saved = _saved(spark, sf_dir)
    lexicon = Lexicon.from_table(saved["dictionary"])
    turns = with_terms(_corpora(spark, sf_dir)["conversations"], lexicon, key=("id", "part"))
    weights = terms.tfidf(turns, saved["idf"], key=("id", "part"), small=lexicon.is_small)
    return weights.withColumn("weight", F.round("weight", 9))


def saved_partners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partners of every keyword from saved edges."""
    saved = _saved(spark, sf_dir)
    lexicon = Lexicon.from_table(saved["dictionary"])
    edges = cooccurrence.both_directions(cooccurrence.named_edges(saved["edges"], lexicon))
    return cooccurrence.keyword_report(edges, lexicon)


def saved_synonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest words of every third word from saved vectors."""
    vectors = _saved(spark, sf_dir)["vectors"]
    asked = vectors.where(F.col("word") % 3 == 0).select("word")
    return neighbours.nearest_many(vectors, asked, 10).withColumn("similarity", F.round("similarity", 9))


def counts_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword counts written as ``(count,keyword)`` lines and read back."""
    path = fresh_path(spark, "counts")
    counts = keywords.document_frequency(_documents(spark, sf_dir), _keywords(spark, sf_dir))
    sinks.write_counts(counts, path)
    return sinks.read_counts(spark, path)


def matrix_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both matrices written as lines of numbers, read back and multiplied.

    The lines of the left matrix have no ids of their own; the product is summed by column.
    """
    rows, sums = _matrix(spark, sf_dir)
    left, right = fresh_path(spark, "left"), fresh_path(spark, "right")
    vectors = read_table(spark, f"{sf_dir}/embeddings.parquet")
    numbers = F.transform("embedding", lambda v: v.cast("double").cast("string"))
    vectors.select(F.array_join(numbers, " ").alias("value")).write.text(left)
    lines = sums.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("col", F.col("value").cast("string").alias("v"))))
        .alias("cells")
    )
    lines.orderBy("row").select(F.array_join("cells.v", " ").alias("value")).coalesce(
        1
    ).write.text(right)
    product = matrix.multiply_rows(
        files.read_sparse_rows(spark, left), files.read_matrix(spark, right)
    )
    return (
        product.select(F.posexplode("values").alias("col", "v"))
        .groupBy("col")
        .agg(F.round(F.sum("v"), 4).alias("total"))
    )


def all_queries() -> dict[str, Query]:
    return {
        "keyword_doc_freq": keyword_doc_freq(_keywords),
        "lexicon_doc_freq": keyword_doc_freq(_lexicon),
        "joined_doc_freq": keyword_doc_freq(_joined),
        "keyword_occurrences": keyword_occurrences(_keywords),
        "lexicon_occurrences": keyword_occurrences(_lexicon),
        "joined_occurrences": keyword_occurrences(_joined),
        "pair_count": pair_count,
        "docs_with_both": docs_with_both,
        "cooccurrence": cooccurrence_all(_keywords),
        "lexicon_cooccurrence": cooccurrence_all(_lexicon),
        "joined_cooccurrence": cooccurrence_all(_joined),
        "cooccurrence_upper": _upper,
        "cooccurrence_lists": cooccurrence_lists,
        "adjacency_rows": adjacency_rows,
        "partner_count": partner_count,
        "partners_of": partners_of,
        "partner_ids": partner_ids,
        "keyword_report": keyword_report(_keywords),
        "dictionary_index": dictionary_index,
        "dictionary_keyword": dictionary_keyword,
        "dictionary_size": dictionary_size,
        "dict_tokens": dict_tokens(_keywords),
        "lexicon_tokens": dict_tokens(_lexicon),
        "joined_tokens": dict_tokens(_joined),
        "term_dictionary": term_dictionary(_keywords),
        "lexicon_term_dictionary": term_dictionary(_lexicon),
        "label_dictionary": label_dictionary,
        "custom_idf": custom_idf(_keywords),
        "lexicon_idf": custom_idf(_lexicon),
        "token_doc_ratio": token_doc_ratio(_keywords),
        "tfidf": tfidf(_keywords),
        "lexicon_tfidf": tfidf(_lexicon),
        "tfidf_new_texts": tfidf_new_texts,
        "tfidf_vectors": tfidf_vectors,
        "nb_model": nb_model(_keywords),
        "lexicon_nb_model": nb_model(_lexicon),
        "nb_priors": nb_priors,
        "nb_predict": nb_predict(_keywords, "documents"),
        "lexicon_nb_predict": nb_predict(_lexicon, "conversations"),
        "nb_predict_joined": nb_predict_joined,
        "nb_label_hist": nb_label_hist(_lexicon),
        "nb_predict_first": nb_predict_first,
        "model_roundtrip": model_roundtrip,
        "hashing_tfidf": hashing_tfidf,
        "matmul": matmul,
        "row_matrix_multiply": row_matrix_multiply,
        "transpose": transpose,
        "matrix_shape": matrix_shape,
        "nearest_vectors": nearest_vectors,
        "nearest_many": nearest_many,
        "gram_matrix": gram_matrix,
        "word2vec_synonyms": word2vec_synonyms,
        "word2vec_vocabulary": word2vec_vocabulary,
        "word2vec_pairs": word2vec_pairs,
        "labelled_file": labelled_file,
        "document_file": document_file,
        "dictionary_file": dictionary_file,
        "segmented_file": segmented_file,
        "path_scan": path_scan,
        "whole_file_scan": whole_file_scan,
        "month_keywords": month_keywords,
        "classification_files": classification_files,
        "edge_store": edge_store,
        "saved_classifier": saved_classifier,
        "saved_weights": saved_weights,
        "saved_partners": saved_partners,
        "saved_synonyms": saved_synonyms,
        "counts_sink": counts_sink,
        "matrix_files": matrix_files,
    }
