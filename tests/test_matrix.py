import math

import pytest
from pyspark.sql import functions as F

from newsloom.operators import embeddings, matrix
from newsloom.sources import files

LEFT = "1 0 -2\n5 3 4\n"
RIGHT = "2 2\n-1 -3\n4 1\n"


@pytest.fixture
def sample(spark, tmp_path):
    (tmp_path / "left.txt").write_text(LEFT)
    (tmp_path / "right.txt").write_text(RIGHT)
    return (
        files.read_sparse_rows(spark, str(tmp_path / "left.txt")),
        files.read_matrix(spark, str(tmp_path / "right.txt")),
    )


def cells(df):
    return {(r["row"], r["col"]): r["value"] for r in df.collect()}


def test_product_of_the_sample(sample, monkeypatch):
    rows, right = sample
    expected = {0: [-6.0, 0.0], 1: [23.0, 5.0]}
    assert {r["row"]: r["values"] for r in matrix.multiply_rows(rows, right).collect()} == expected
    product = matrix.matmul(matrix.cells(rows), right)
    assert cells(product) == {(r, c): expected[r][c] for r in (0, 1) for c in (0, 1)}
    assert cells(matrix.matmul(matrix.cells(rows), right, small=False)) == cells(product)
    monkeypatch.setattr(matrix, "MAX_LOCAL_CELLS", 1)
    assert {r["row"]: r["values"] for r in matrix.multiply_rows(rows, right).collect()} == expected


def test_zeros_are_dropped_from_the_left_and_kept_on_the_right(sample):
    rows, right = sample
    assert matrix.cells(rows).count() == 5
    assert right.count() == 6
    assert tuple(matrix.shape(right).first()) == (3, 2)


def test_transpose(sample):
    right = sample[1]
    assert cells(matrix.transpose(right)) == {(c, r): v for (r, c), v in cells(right).items()}


def test_bad_numbers_are_errors(spark, tmp_path):
    (tmp_path / "bad.txt").write_text("1 x\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        files.read_matrix(spark, str(tmp_path / "bad.txt")).collect()


def test_one_hot_inner_index(spark):
    left = spark.range(500).select(
        F.col("id").alias("row"), F.lit(0).alias("col"), F.lit(1.0).alias("value")
    )
    right = spark.createDataFrame([(0, 0, 2.0), (0, 1, 3.0)], "row int, col int, value double")
    product = matrix.matmul(left, right, small=False)
    assert product.count() == 1000
    assert product.agg(F.sum("value")).first()[0] == 2500.0


def vectors(spark):
    rows = [("a", [1.0, 0.0]), ("b", [2.0, 0.1]), ("c", [0.0, 1.0]), ("z", [0.0, 0.0])]
    return spark.createDataFrame(rows, "word string, vector array<float>")


@pytest.mark.parametrize("per_pass", [500, 1])
def test_nearest(spark, monkeypatch, per_pass):
    monkeypatch.setattr(embeddings, "ASKED_PER_PASS", per_pass)
    asked = spark.createDataFrame([("a",), ("c",)], "word string")
    found = embeddings.nearest(vectors(spark), asked, 2).orderBy("word", "rank").collect()
    assert [(r["word"], r["rank"], r["neighbour"]) for r in found] == [
        ("a", 1, "b"), ("a", 2, "c"), ("c", 1, "b"), ("c", 2, "a"),
    ]
    assert math.isclose(found[0]["similarity"], 2 / math.sqrt(4.01), rel_tol=1e-6)


def test_unknown_word_is_an_error(spark):
    asked = spark.createDataFrame([("nope",)], "word string")
    with pytest.raises(Exception, match="nope not in vocabulary"):
        embeddings.nearest(vectors(spark), asked, 2).collect()


def test_word2vec(spark):
    lines = ["king queen crown palace"] * 20 + ["tea cup milk spoon"] * 20
    df = spark.createDataFrame([(line.split(" "),) for line in lines], "tokens array<string>")
    model = embeddings.fit_word2vec(df, num_partitions=2, vectorSize=8)
    found = embeddings.synonyms(model, "king", 3).collect()
    assert len(found) == 3 and "king" not in [r["word"] for r in found]
    assert [r["similarity"] for r in found] == sorted((r["similarity"] for r in found), reverse=True)
    with pytest.raises(Exception, match="not in vocabulary"):
        embeddings.synonyms(model, "absent", 3)
    with pytest.raises(ValueError, match="min_count"):
        embeddings.fit_word2vec(df, max_vocabulary=3)
