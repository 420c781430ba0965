"""Cases that gave wrong answers: repeated keys, zero rows, several files, null labels."""

import pytest
from newsloom.operators import bayes, keywords, matching, matrix
from newsloom.operators.lexicon import Lexicon
from newsloom.sources import files, sinks
from pyspark.sql import functions as F


@pytest.mark.parametrize("large", [False, True])
def test_repeated_and_null_keys(spark, large):
    docs = spark.createDataFrame([(1, "ab c"), (1, "ab ab"), (None, "ab")], "doc_id bigint, text string")
    lexicon = Lexicon.from_words(spark, ["ab", "c"])
    lexicon = Lexicon(lexicon.table) if large else lexicon
    counts = keywords.document_frequency(docs, lexicon).collect()
    assert {(r["kw"], r["n"]) for r in counts} == {("ab", 3), ("c", 1)}
    terms = [r["terms"] for r in matching.with_terms(docs, lexicon).collect()]
    assert sorted(terms) == [["ab"], ["ab", "ab"], ["ab", "c"]]


def test_shape_with_zero_rows_and_columns(spark):
    rows = spark.createDataFrame([(0, [1.0, 2.0, 0.0]), (1, [3.0, 4.0, 0.0]), (2, [0.0] * 3)], "row int, v array<double>")
    assert tuple(matrix.dense_shape(rows, "v").first()) == (3, 3)
    assert tuple(matrix.dense_shape(rows.limit(0), "v").first()) == (0, 0)


def test_product_of_mismatched_and_empty_matrices(spark):
    rows = spark.createDataFrame([(0, [1.0, 2.0, 5.0])], "row int, v array<double>").select(
        "row", matrix.sparse_entries(F.col("v")).alias("entries")
    )
    b = spark.createDataFrame([(0, 0, 2.0)], "row int, col int, value double")
    with pytest.raises(ValueError, match="columns or more"):
        matrix.multiply_rows(rows, b)
    assert matrix.multiply_rows(rows, b, b_shape=(3, 2)).first()["values"] == [2.0, 0.0]
    assert matrix.multiply_rows(rows, b.limit(0), b_shape=(3, 0)).first()["values"] == []


def test_line_order_over_files_of_unequal_size(spark, tmp_path):
    (tmp_path / "b.txt").write_text("".join(f"b{i}\n" for i in range(5000)))
    (tmp_path / "a.txt").write_text("a0\na1\n")
    rows = files.read_documents(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [r["text"] for r in rows] == ["a0", "a1"] + [f"b{i}" for i in range(5000)]


def test_labelled_rows_come_back_or_are_rejected(spark, tmp_path):
    rows = [(1, "x", "one"), (2, None, "two"), (3, "y", ""), (4, None, None)]
    path = str(tmp_path / "out")
    sinks.write_labelled(spark.createDataFrame(rows, "doc_id bigint, label string, text string"), path)
    back = files.read_labelled(spark, path)
    assert {tuple(r)[:3] for r in back.collect()} == {("1", "x", "one"), ("2", None, "two")}
    assert sorted(r["value"] for r in files.rejected_lines(spark, path).collect()) == ["3\ty\t", "4\t\t"]


def test_training_without_null_labels(spark):
    docs = spark.createDataFrame([(1, "x", ["a"]), (2, None, ["b"]), (3, "y", ["c"])], "doc_id bigint, label string, terms array<string>")
    model = bayes.train(docs)
    assert {r["label"] for r in model.labels.collect()} == {"x", "y"}
