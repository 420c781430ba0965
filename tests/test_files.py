import pytest
from pyspark.sql import functions as F

from newsloom import __main__ as command
from newsloom.operators.lexicon import Lexicon
from newsloom.plans import jobs
from newsloom.sources import files, sinks
from newsloom.sources.tables import read_table


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_dictionary(spark, tmp_path):
    path = write(tmp_path / "d.txt", "﻿山路 n\n河口 v x\n\n長橋\n河口\n")
    rows = sorted(map(tuple, files.read_dictionary(spark, path).collect()))
    assert rows == [(0, "山路"), (1, "河口"), (3, "長橋"), (4, "河口")]
    assert Lexicon.from_table(files.read_dictionary(spark, path)).words == ("山路", "長橋", "河口")


def test_dictionary_positions_over_many_splits(spark, tmp_path):
    words = [f"w{i}" for i in range(5000)]
    path = write(tmp_path / "d.txt", "\n".join(words))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 4
        rows = files.read_dictionary(spark, path).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(map(tuple, rows)) == list(enumerate(words))


def test_labelled(spark, tmp_path):
    path = write(tmp_path / "t.tsv", 'a\tx\tone "two\tmore\tagain\nb\ty\nc\tz\t\nd\tx\t three\n')
    rows = files.read_labelled(spark, path).orderBy("line").collect()
    assert [tuple(r)[:3] for r in rows] == [("a", "x", 'one "two'), ("d", "x", " three")]


def test_documents_follow_line_order(spark, tmp_path):
    path = write(tmp_path / "a.txt", "one\n\nthree\n")
    rows = files.read_documents(spark, path).orderBy("doc_id").collect()
    assert [r["text"] for r in rows] == ["one", "", "three"]
    write(tmp_path / "b.txt", "four\n")
    assert files.read_documents(spark, str(tmp_path / "*.txt")).count() == 4


def test_segmented(spark, tmp_path):
    path = write(tmp_path / "s.txt", "a  b \n\nc\n")
    rows = files.read_segmented(spark, path).collect()
    assert [r["tokens"] for r in rows] == [["a", "", "b"], [""], ["c"]]


def test_whole_files_by_name(spark, tmp_path):
    write(tmp_path / "200812.txt", "1\tx\tbody of december\tz\n")
    write(tmp_path / "200901.txt", "2\ty\tbody of january\n")
    df = files.read_whole_files(spark, str(tmp_path), name_contains="200812")
    assert [r[0] for r in df.select(files.tab_field(F.col("content"), 2)).collect()] == [
        "body of december"
    ]
    lines = files.read_lines_with_path(spark, str(tmp_path), name_contains="2009")
    assert [r["text"] for r in lines.collect()] == ["2\ty\tbody of january"]


def test_counts_sink(spark, tmp_path):
    counts = spark.createDataFrame([(1, "a,b)"), (12, "c")], "n bigint, kw string")
    out = str(tmp_path / "out")
    sinks.write_counts(counts.orderBy("n"), out)
    parts = list((tmp_path / "out").glob("part-*"))
    assert len(parts) == 1 and parts[0].read_text() == "(1,a,b))\n(12,c)\n"
    assert sorted(map(tuple, sinks.read_counts(spark, out).collect())) == [(1, "a,b)"), (12, "c")]
    with pytest.raises(Exception, match="already exists"):
        sinks.write_counts(counts, out)


def test_small_tables_are_spread(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    assert read_table(spark, path).rdd.getNumPartitions() < 8
    assert read_table(spark, path, spread_by="doc_id").rdd.getNumPartitions() == 8


@pytest.fixture
def news(tmp_path):
    return {
        "dictionary": write(tmp_path / "words.txt", "goal n\nmatch n\nvote n\nlaw n\n"),
        "docs": write(tmp_path / "docs.txt", "vote law vote\ngoal match\nnothing\nlaw\n"),
        "training": write(
            tmp_path / "train.tsv",
            "1\tsport\tgoal match goal\n2\tpolitics\tvote law\n3\tpolitics\tlaw vote vote\n",
        ),
    }


def test_jobs(spark, news, tmp_path, capsys):
    jobs.keyword_frequency(spark, news["docs"], news["dictionary"], str(tmp_path / "df"))
    lines = sorted(r["value"] for r in spark.read.text(str(tmp_path / "df")).collect())
    assert lines == ["(1,goal)", "(1,match)", "(1,vote)", "(2,law)"]
    partners = jobs.keyword_partners(spark, news["docs"], news["dictionary"]).collect()
    assert [r["partners"] for r in partners] == ["match:1", "goal:1", "law:1", "vote:1"]
    model = str(tmp_path / "model")
    jobs.train_classifier(spark, news["training"], news["dictionary"], model)
    arguments = (spark, news["docs"], news["dictionary"], model)
    found = jobs.classify_documents(*arguments).orderBy("doc_id").collect()
    assert [r["label"] for r in found] == ["politics", "sport", "politics", "politics"]
    assert [r["label"] for r in jobs.classify_first(*arguments).collect()] == ["politics"]
    histogram = jobs.classify_histogram(*arguments).collect()
    assert sorted(map(tuple, histogram)) == [("politics", 3), ("sport", 1)]
    given = ["--docs", news["docs"], "--dictionary", news["dictionary"], "--model-path", model]
    command.main(["label-histogram", *given])
    assert "|politics|3  |" in capsys.readouterr().out
    command.main(["classify", *given, "--write-to", str(tmp_path / "labels")])
    assert spark.read.parquet(str(tmp_path / "labels")).count() == 4


def test_synonym_and_matrix_jobs(spark, tmp_path):
    text = write(tmp_path / "seg.txt", "a b c d\n" * 30)
    assert jobs.word_synonyms(spark, text, "a", 2).count() == 2
    left, right = write(tmp_path / "l.txt", "0 -1 2\n4 11 2\n"), write(tmp_path / "r.txt", "3\n1\n6\n")
    product = jobs.matrix_product(spark, left, right).orderBy("row").collect()
    assert [r["values"] for r in product] == [[11.0], [35.0]]
