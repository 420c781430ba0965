import pytest

from newsloom import lineage
from newsloom.operators import joins, lexicon
from newsloom.operators.lexicon import Lexicon


def test_last_position_of_a_repeated_keyword_counts(spark):
    lex = Lexicon.from_words(spark, ["a", "", "b", "a"])
    assert [tuple(r) for r in lex.table.orderBy("kw_id").collect()] == [(2, "b"), (3, "a")]
    assert lex.words == ("b", "a")
    assert lex.size().first()["n"] == 2


def test_from_table_equals_from_words(spark):
    rows = [(0, "a"), (1, ""), (2, "b"), (3, "a")]
    lex = Lexicon.from_table(spark.createDataFrame(rows, "kw_id int, kw string"))
    assert lex.words == ("b", "a")
    assert sorted(map(tuple, lex.table.collect())) == [(2, "b"), (3, "a")]


def test_large_dictionaries_stay_on_the_cluster(spark, monkeypatch):
    monkeypatch.setattr(lexicon, "MAX_WORDS", 1)
    table = spark.createDataFrame([(0, "a"), (1, "b")], "kw_id int, kw string")
    assert Lexicon.from_table(table).words is None
    assert Lexicon.from_words(spark, ["a", "b"]).words is None


def test_unknown_lookups(spark):
    lex = Lexicon.from_words(spark, ["a", "b"])
    for either in (lex, Lexicon(lex.table, None)):
        asked = spark.createDataFrame([("b",), ("x",)], "kw string")
        assert dict(map(tuple, either.index_of(asked).select("kw", "kw_id").collect())) == {
            "b": 1,
            "x": -1,
        }
        positions = spark.createDataFrame([(0,), (7,)], "kw_id int")
        found = either.keyword_at(positions).select("kw_id", "kw").collect()
        assert dict(map(tuple, found)) == {0: "a", 7: "oops"}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_join(spark, how):
    big = spark.createDataFrame(
        [(i, "hot" if i % 3 else f"k{i % 7}") for i in range(300)] + [(999, None)],
        "i int, k string",
    )
    side = spark.createDataFrame([("hot", 1), ("hot", 2), ("k0", 3), ("none", 4)], "k string, v int")
    key = lambda rows: sorted(map(repr, rows))
    expected = big.join(side, "k", how).select("i", "k", "v").collect()
    spread = joins.spread_join(big, side, "k", how, hot_rows=10).select("i", "k", "v")
    assert key(spread.collect()) == key(expected)
    looked_up = joins.lookup(big, side, "k", how).select("i", "k", "v").collect()
    assert key(looked_up) == key(expected)


def test_broadcast_only_below_the_limit(spark, monkeypatch):
    big = spark.range(100).selectExpr("id", "cast(id % 5 as string) k")
    side = big.selectExpr("k", "id v").where("id < 50")

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(joins.lookup(big, side, "k"))
    monkeypatch.setattr("newsloom.sizes.BROADCAST_BYTES", 10)
    assert "strategy=broadcast" not in plan(joins.lookup(big, side, "k"))


def test_shared_folder(spark):
    assert lineage.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Cluster:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(RuntimeError):
        lineage.shared_folder(Cluster())


def test_a_local_session_without_the_setting_gets_a_folder(tmp_path, monkeypatch):
    monkeypatch.setattr(lineage.tempfile, "mkdtemp", lambda prefix: str(tmp_path))

    class Context:
        master, folder = "local[2]", None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, path):
            self.folder = f"{path}/of-this-session"

    class Local:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default):
                return default

    assert lineage.shared_folder(Local()) == f"{tmp_path}/of-this-session"
    assert lineage.shared_folder(Local()) == f"{tmp_path}/of-this-session"


def test_materialize_reads_back_the_same_rows(spark):
    df = spark.range(5).selectExpr("id", "array(id) a")
    copy = lineage.materialize(df, "copy")
    assert copy.schema.simpleString() == df.schema.simpleString()
    assert sorted(copy.collect()) == sorted(df.collect())
    assert "parquet" in copy._jdf.queryExecution().executedPlan().toString().lower()
