"""Multinomial naive Bayes on term weights.

Training needs one number per label and term: how much of its documents' term lists the term
makes up, summed over the documents of the label. The inverse frequency of a term is one factor
of that sum, so a single aggregation over the corpus yields occurrences, document counts and
class sums together. Everything after it works on that small table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, IndexToString, Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.functions import text as T
from newsloom.lineage import materialize
from newsloom.operators.artifacts import Artifact, load, save
from newsloom.operators.joins import lookup
from newsloom.operators.lexicon import Lexicon
from newsloom.operators.matching import ROW, Key, identified, with_terms
from newsloom.operators.terms import numbered_by_range, tfidf

#: Models up to this many label-term cells are held by the ML pipeline; larger ones are joined.
MAX_CELLS = 2_000_000

_TABLES = ("labels", "terms", "cells")


def class_term_stats(
    tokenized: DataFrame, *, label: str = "label", key: str = "doc_id"
) -> DataFrame:
    """``label, term, n, share, first``: one row per label and term of the corpus.

    ``n`` counts occurrences, ``share`` sums n / length over the documents. A row without term
    counts the documents of the label; its ``first`` is the lowest key, for the label order.
    """
    no_term = F.struct(F.lit(None).cast("string").alias("term"), F.lit(1).cast("bigint").alias("n"))
    entries = F.concat(T.term_counts(F.col("terms")), F.array(no_term))
    return (
        tokenized.select(
            F.col(label).alias("label"),
            F.col(key).alias("_key"),
            F.size("terms").alias("_total"),
            F.inline(entries),
        )
        .groupBy("label", "term")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.when(F.col("_total") > 0, F.col("n") / F.col("_total"))).alias("share"),
            F.min("_key").alias("first"),
        )
    )


@dataclass(frozen=True)
class BayesModel:
    """A trained model as tables.

    ``labels``: label_id, label, n_docs, prior, base. ``terms``: term_id, term, idf. ``cells``:
    label_id, label, term, weight_sum, theta, gain for the terms that a label was seen with. Every
    other term has the log-likelihood ``base`` of the label, and ``gain`` is what theta has above it,
    so the model has as many cells as were seen, whatever the number of labels.
    """

    labels: DataFrame
    terms: DataFrame
    cells: DataFrame
    smoothing: float = 1.0

    @property
    def weights(self) -> DataFrame:
        """label_id, label, term, weight_sum, theta for every label and term."""
        every = self.labels.agg(F.sort_array(F.collect_list(F.struct("label_id", "label", "base")))).scalar()
        grid = self.terms.select("term", F.inline(every))
        seen = self.cells.select("label_id", "term", "weight_sum", "theta")
        return grid.join(seen, ["label_id", "term"], "left").select(
            "label_id",
            "label",
            "term",
            F.coalesce("weight_sum", F.lit(0.0)).alias("weight_sum"),
            F.coalesce("theta", "base").alias("theta"),
        )

    def tables(self) -> dict[str, DataFrame]:
        """The model's tables, under the names they are saved by."""
        return {name: getattr(self, name) for name in _TABLES}

    @classmethod
    def of(cls, saved: Artifact) -> BayesModel:
        """The model in a loaded artifact."""
        return cls(*[saved[name] for name in _TABLES], smoothing=saved.constants["smoothing"])

    def save(self, path: str) -> None:
        """Save as an artifact of its own; it is an error if there is one."""
        try:
            load(self.labels.sparkSession, path)
        except FileNotFoundError:
            save(path, self.tables(), smoothing=self.smoothing)
        else:
            raise FileExistsError(f"{path} already exists")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BayesModel:
        return cls.of(load(spark, path))


def train(
    tokenized: DataFrame, *, label: str = "label", key: str = "doc_id", smoothing: float = 1.0
) -> BayesModel:
    """Train on documents with ``terms`` and a label; reads the corpus once.

    Documents whose label is null are not trained on.
    """
    labelled = tokenized.where(F.col(label).isNotNull())
    stats = materialize(class_term_stats(labelled, label=label, key=key), "class-terms")
    return model_of(stats, smoothing=smoothing)


def model_of(stats: DataFrame, *, smoothing: float = 1.0) -> BayesModel:
    """The model that belongs to the output of :func:`class_term_stats`.

    Its tables are derived from ``stats``, which should be written rather than lazy.
    """
    if smoothing <= 0:
        raise ValueError("smoothing must be above zero")
    no_term = F.col("term").isNull()
    counted = stats.where(no_term)
    n_docs = counted.agg(F.sum("n")).scalar()
    n_labels = counted.agg(F.count(F.lit(1))).scalar()
    numbered = numbered_by_range(counted.select("label", "n", "first"), ["first", "label"], "label_id")
    per_term = stats.where(~no_term).groupBy("term").agg((n_docs / F.sum("n")).alias("idf"))
    terms = numbered_by_range(per_term, ["term"], "term_id").select("term_id", "term", "idf")
    seen = stats.where(~no_term).join(terms.select("term", "idf"), "term").select(
        "label", "term", (F.col("idf") * F.col("share")).alias("weight_sum")
    )
    sums = seen.groupBy("label").agg(F.sum("weight_sum").alias("_seen"))
    n_terms = terms.agg(F.count(F.lit(1))).scalar()
    log_total = F.ln(F.coalesce("_seen", F.lit(0.0)) + F.lit(smoothing) * n_terms)
    labels = materialize(
        numbered.join(sums, "label", "left").select(
            "label_id",
            "label",
            F.col("n").alias("n_docs"),
            (F.ln(F.col("n") + smoothing) - F.ln(n_docs + n_labels * F.lit(smoothing))).alias("prior"),
            (F.lit(math.log(smoothing)) - F.when(n_terms > 0, log_total)).alias("base"),
        ),
        "labels",
    )
    theta = F.ln(F.col("weight_sum") + smoothing) + F.col("base") - F.lit(math.log(smoothing))
    cells = seen.join(labels.select("label_id", "label", "base"), "label").select(
        "label_id", "label", "term", "weight_sum", theta.alias("theta"), (theta - F.col("base")).alias("gain")
    )
    return BayesModel(labels, terms, cells, smoothing)


def best_without_terms(labels: DataFrame) -> DataFrame:
    """The labels that can win by prior and base alone, whatever the weight of a text.

    A label drops out if another one has no smaller prior and base; of equal ones the lowest id stays.
    """
    above = Window.orderBy(F.desc("prior"), "label_id").rowsBetween(Window.unboundedPreceding, -1)  # one row per label
    most = F.max("base").over(above)
    return labels.withColumn("_most", most).where(F.col("_most").isNull() | (F.col("base") > F.col("_most"))).drop("_most")


def predict(
    tokenized: DataFrame, model: BayesModel, *, key: Key = ("doc_id",), small: bool | None = None
) -> DataFrame:
    """``key, label``: the most likely label by joins alone, for models of any size.

    The score of a label is its prior, its base times the weight of the text, and the gains of the
    terms that were seen with it; only those are joined. Terms the training never saw are dropped
    before shares are taken. A document without known terms gets the label with the highest prior;
    of equal scores the lowest label id wins.
    """
    gains = model.cells.groupBy("term").agg(F.collect_list(F.struct("label_id", "gain")).alias("gains"))
    per_term = model.terms.select("term", "idf").join(gains, "term", "left")
    counts = tokenized.select(*key, F.inline(T.term_counts(F.col("terms"))))
    # One more entry per term counts the text itself.
    itself = F.array(F.struct(F.lit(None).cast("int").alias("label_id"), F.lit(1.0).alias("gain")))
    entries = F.when(F.col("gains").isNull(), itself).otherwise(F.concat(itself, "gains"))
    scores = (
        lookup(counts, per_term, "term", small=small)
        .select(*key, "n", (F.col("n") * F.col("idf")).alias("_weight"), F.inline(entries))
        .groupBy(*key, "label_id")
        .agg(F.sum(F.col("_weight") * F.col("gain")).alias("_sum"), F.sum("n").alias("_n"))
        .groupBy(*key)
        .agg(
            F.max(F.when(F.col("label_id").isNull(), F.col("_sum"))).alias("_weight"),
            F.max(F.when(F.col("label_id").isNull(), F.col("_n"))).alias("_total"),
            F.collect_list(F.when(F.col("label_id").isNotNull(), F.struct("label_id", "_sum"))).alias("_gains"),
        )
    )
    listed = F.sort_array(F.collect_list(F.struct("label_id", "label", "prior", "base")))
    every = model.labels.agg(listed).scalar()
    alone = best_without_terms(model.labels).agg(listed).scalar()
    weight = F.coalesce(F.col("_weight") / F.col("_total"), F.lit(0.0))

    def scored(label: Column, gain: Column) -> Column:
        return F.struct(
            (label["prior"] + F.coalesce(label["base"], F.lit(0.0)) * weight + gain).alias("score"),
            (-label["label_id"]).alias("order"),
            label["label"].alias("label"),
        )

    # Label ids are places in the sorted list.
    touched = F.transform(
        F.coalesce("_gains", F.array().cast("array<struct<label_id:int,_sum:double>>")),
        lambda g: scored(F.get(F.col("_every"), g["label_id"]), g["_sum"] / F.col("_total")),
    )
    ranked = F.concat(touched, F.transform("_alone", lambda label: scored(label, F.lit(0.0))))
    return (
        tokenized.select(*key)
        .join(scores, list(key), "left")
        .withColumn("_every", every)
        .withColumn("_alone", alone)
        .select(*key, F.array_max(ranked)["label"].alias("label"))
    )


def vectorizer(vocabulary: Sequence[Row], terms: str, output: str) -> PipelineModel:
    """Term lists to sparse weight vectors: ``vocabulary`` has term and idf, in id order.

    Unknown terms are not counted; a text without known terms gives an empty vector.
    """
    return PipelineModel(
        [
            CountVectorizerModel.from_vocabulary(
                [row["term"] for row in vocabulary], inputCol=terms, outputCol="_counts"
            ),
            Normalizer(p=1.0, inputCol="_counts", outputCol="_shares"),
            ElementwiseProduct(
                scalingVec=Vectors.dense([row["idf"] for row in vocabulary]),
                inputCol="_shares",
                outputCol=output,
            ),
        ]
    )


def tfidf_vectors(tokenized: DataFrame, model: BayesModel, *, output: str = "weights") -> DataFrame:
    """Add the weights of each text as a sparse vector in the order of ``model.terms``.

    Without any terms the vectors are empty.
    """
    vocabulary = model.terms.limit(MAX_CELLS + 1).collect()
    if not vocabulary:
        return tokenized.withColumn(output, array_to_vector(F.array().cast("array<double>")))
    if len(vocabulary) > MAX_CELLS:
        return _joined_vectors(tokenized, model, output)
    vocabulary.sort(key=lambda row: row["term_id"])
    vectors = vectorizer(vocabulary, "terms", output).transform(tokenized)
    return vectors.drop("_counts", "_shares")


def _joined_vectors(tokenized: DataFrame, model: BayesModel, output: str) -> DataFrame:
    """The same vectors from a joined table of weights, for vocabularies that no task holds."""
    size = model.terms.count()
    vector = F.udf(lambda at, values: Vectors.sparse(size, at or [], values or []), VectorUDT())
    rows = identified(tokenized)
    weights = tfidf(rows, model.terms, key=(ROW,), small=False)
    named = lookup(weights, model.terms.select("term", "term_id"), "term", small=False)
    entries = named.where(F.col("weight") != 0).groupBy(ROW).agg(
        F.sort_array(F.collect_list(F.struct("term_id", "weight"))).alias("_entries")
    )
    joined = rows.join(entries, ROW, "left")
    columns = [joined[c] for c in tokenized.columns if c != output]
    return joined.select(*columns, vector("_entries.term_id", "_entries.weight").alias(output))


def pipeline_of(
    model: BayesModel, *, terms: str = "terms", label: str = "label"
) -> PipelineModel | None:
    """The model as an ML pipeline, which scores every row in place: no join and no shuffle.

    None if the model is empty or above ``MAX_CELLS``; :func:`predict` handles those.

    ML's own naive Bayes is fitted on one row per label: the mean weights of its documents, with
    their number as row weight. Its class sums are then those of the whole corpus.
    """
    names = [row["label"] for row in model.labels.orderBy("label_id").collect()]
    most = MAX_CELLS // max(len(names), 1)
    vocabulary = model.terms.select("term", "idf").limit(most + 1).collect()
    if not vocabulary or len(vocabulary) > most:
        return None
    vocabulary.sort(key=lambda row: row["term"].encode())  # the order of term ids
    sums = model.weights.groupBy("label_id").agg(
        F.sort_array(F.collect_list(F.struct("term", "weight_sum"))).alias("_row")
    )
    means = sums.join(model.labels, "label_id").select(
        F.col("label_id").cast("double").alias("label"),
        F.col("n_docs").cast("double").alias("weight"),
        array_to_vector(
            F.transform("_row", lambda cell: cell["weight_sum"] / F.col("n_docs"))
        ).alias("features"),
    )
    means = materialize(means, "label-means")
    bayes = NaiveBayes(
        smoothing=model.smoothing, featuresCol="features", labelCol="label", weightCol="weight"
    ).fit(means)
    bayes.setFeaturesCol("_weights").setPredictionCol("_label_id")
    bayes.setRawPredictionCol("").setProbabilityCol("")
    decode = IndexToString(inputCol="_label_id", outputCol=label, labels=names)
    return PipelineModel([vectorizer(vocabulary, terms, "_weights"), bayes, decode])


def classify(
    docs: DataFrame,
    lexicon: Lexicon,
    model: BayesModel,
    *,
    text: str = "text",
    key: Key = ("doc_id",),
) -> DataFrame:
    """``key, label``: the most likely label of each text."""
    tokenized = with_terms(docs, lexicon, text=text, key=key)
    pipeline = pipeline_of(model)
    if pipeline is None:
        return predict(tokenized, model, key=key, small=False)
    return pipeline.transform(tokenized.select(*key, "terms")).select(*key, "label")


def label_histogram(predicted: DataFrame) -> DataFrame:
    """``label, n``: documents by predicted label; labels never predicted are left out."""
    return predicted.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
