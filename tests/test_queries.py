"""Every query against its SQL, and the plans that matter at scale."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from newsloom.plans.queries import all_queries
from oracle_queries import all_oracles

SF_DIR = "/root/testdata/sf0.001"
QUERIES = all_queries()
ORACLE = all_oracles()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, ORACLE[name]) == []


def test_every_query_but_the_trained_vectors_has_sql(spark):
    assert set(QUERIES) - set(ORACLE) == {"word2vec_synonyms"}
    assert QUERIES["word2vec_synonyms"](spark, SF_DIR).count() == 10


def test_entry(spark):
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert entry.entry(spark).columns == ["n", "kw"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return [line for line in text.splitlines() if "Exchange" in line and "BY_NUM" not in line]


def test_scoring_is_one_scan_without_shuffle(spark):
    text = plan(QUERIES["nb_predict"](spark, SF_DIR))
    assert shuffles(text) == []
    assert "Python" not in text and text.count("Scan parquet") == 1


def test_keyword_arrays_are_computed_after_the_scan_only_once(spark):
    for name, most in [("keyword_doc_freq", 2), ("cooccurrence", 5)]:
        text = plan(QUERIES[name](spark, SF_DIR))
        assert text.count("Contains(text") == 17, name
        assert len(shuffles(text)) <= most
        assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
        assert "NestedLoop" not in text and "Cartesian" not in text


def test_no_query_plans_a_cross_join_or_python(spark):
    for name in ("tfidf", "nb_model", "nb_predict_joined", "matmul", "nearest_vectors", "custom_idf"):
        text = plan(QUERIES[name](spark, SF_DIR))
        assert "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text, name


def test_nearest_limits_before_the_shuffle(spark):
    text = plan(QUERIES["nearest_vectors"](spark, SF_DIR))
    assert "row_number(), 10, Partial" in text


def test_whole_files_of_all_documents_are_scanned(spark):
    found = QUERIES["whole_file_scan"](spark, SF_DIR).collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert sum(r["n_lines"] for r in found) == docs.count()
    assert {r["label"] for r in found} == {r["lang"] for r in docs.select("lang").distinct().collect()}
