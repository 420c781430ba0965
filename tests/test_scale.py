"""Mechanisms for large input: rarest grams, linear cutting, blocks of pairs, sparse models, tiles, bounds, artifacts."""

import json
import math
import random
import time

import numpy as np
import pytest
from newsloom import lineage
from newsloom.operators import (
    artifacts,
    bayes,
    cooccurrence,
    embeddings,
    grams,
    joins,
    keywords,
    matching,
    neighbours,
    skipgram,
    tiles,
)
from newsloom.operators.lexicon import Lexicon
from newsloom.sources import files
from pyspark.sql import functions as F

import naive


def by_grams(spark, words):
    return Lexicon(Lexicon.from_words(spark, words).table, None)


def random_words(rng, n, alphabet="abcde"):
    return list(dict.fromkeys("".join(rng.choices(alphabet, k=rng.randint(1, 9))) for _ in range(n)))


# Rarest grams


def test_every_keyword_is_filed_once_under_its_rarest_gram(spark, texts):
    docs = texts("abcdabcdabcdx", "xbcdq", None, "")
    found = {r["kw"]: r for r in grams.filed(docs, Lexicon.from_words(spark, ["abcdab", "bcdq", "ab", "zz", "abcdz"]).table).collect()}
    assert set(found) == {"abcdab", "bcdq", "ab"}  # the others have a gram that the texts don't hold
    assert found["abcdab"]["back"] == 1 and found["ab"]["back"] == 0


@pytest.mark.parametrize("slice_bytes", [grams.SLICE_BYTES, 600])
def test_occurrences_equal_a_loop_in_slices_too(spark, texts, monkeypatch, slice_bytes):
    rng = random.Random(5)
    monkeypatch.setattr(grams, "SLICE_BYTES", slice_bytes)
    words = [*random_words(rng, 300), "𝒳a", "é上𝒳", "abc" * 60, "abcde" * 80]
    strings = ["".join(rng.choices("abcde", k=300)) for _ in range(8)] + ["x𝒳aé上𝒳", "abc" * 200, "z" + "abcde" * 90, ""]
    found = grams.occurrences(texts(*strings, None), Lexicon.from_words(spark, words).table, key=("doc_id",))
    expected = sorted(
        (i, at, kw) for i, s in enumerate(strings) for kw in words for at in range(len(s)) if s.startswith(kw, at)
    )
    assert sorted((r["doc_id"], r["pos"], r["kw"]) for r in found.collect()) == expected
    once = grams.occurrences(texts(*strings), Lexicon.from_words(spark, words).table, key=("doc_id",), once=True)
    assert {(r["doc_id"], r["kw"]) for r in once.collect()} == {(i, kw) for i, _, kw in expected}


def test_only_places_of_filed_grams_become_rows(spark, texts):
    docs = texts("the quick brown fox " * 500 + "needle")
    lexicon = by_grams(spark, ["needles", "needle", "quicker"])
    dictionary = grams.filed(docs, lexicon.table)
    held = dictionary.groupBy("gram", "size").agg(F.max("back").alias("back"), F.max(F.length("kw") - F.col("back")).alias("ahead")).toArrow()
    columns = [held.column(c).to_numpy() for c in ("gram", "size", "back", "ahead")]
    own = grams.FiledGrams(columns[0].view(np.uint64), *columns[1:])
    assert grams.candidates(docs, own, text="text", key=("doc_id",), once=False).count() == 1


def test_counts_of_a_large_dictionary_do_not_overlap(spark, texts):
    words = ["aa", "aba", "b", "abab"]
    strings = ["aaaaa", "ababab", "", "abaaba", "bb"]
    found = keywords.keyword_occurrences(texts(*strings), by_grams(spark, words)).collect()
    expected = {(i, w): s.count(w) for i, s in enumerate(strings) for w in words if w in s}
    assert {(r["doc_id"], r["kw"]): r["n"] for r in found} == expected


# Cutting


def test_cutting_equals_a_loop_and_takes_linear_time(spark, texts):
    rng = random.Random(2)
    words = random_words(rng, 60, "ab")
    strings = ["".join(rng.choices("abx", k=400)) for _ in range(6)]
    rows = matching.with_terms(texts(*strings), by_grams(spark, words)).collect()
    assert {r["doc_id"]: r["terms"] for r in rows} == {i: naive.tokens(s, words) for i, s in enumerate(strings)}
    lexicon = by_grams(spark, ["ab", "ba", "aba"])

    def seconds(n):
        start = time.perf_counter()
        row = matching.with_terms(texts("ab" * n), lexicon).select(F.size("terms").alias("n")).first()
        assert row["n"] >= n // 2
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(100_000) < 20 * max(seconds(10_000), 0.5)


# Pairs


def plain_pairs(sets):
    found = {}
    for ids in sets:
        for k, a in enumerate(ids):
            for b in ids[k + 1 :]:
                found[a, b] = found.get((a, b), 0) + 1
    return found


@pytest.mark.parametrize(("dense", "heavy"), [(0, 5), (12, 5), (1000, 5), (12, 0), (3, 1000)])
def test_pairs_equal_a_loop(spark, dense, heavy):
    rng = random.Random(dense + heavy)
    sets = [sorted(rng.sample(range(40), rng.randint(0, 18))) for _ in range(60)] + [[], [3], [2**40, 2**41]]
    table = spark.createDataFrame([(s,) for s in sets], "ids array<bigint>")
    found = cooccurrence.pair_sums(table, np.arange(dense), heavy=heavy).collect()
    assert {(r["kw_id"], r["other_id"]): r["n"] for r in found} == plain_pairs(sets)


def test_a_heavy_set_spreads_over_tasks(spark):
    table = spark.createDataFrame([(list(range(20_000)),)], "ids array<bigint>")
    rows = cooccurrence.block_pairs(table, cooccurrence.HEAVY)
    found = rows.select(F.spark_partition_id().alias("p"), F.size("left").alias("n"), "right").collect()
    blocks = -(-20_000 // cooccurrence.HEAVY)
    assert len(found) == blocks * (blocks + 1) // 2 and len({r["p"] for r in found}) == 4
    assert max(r["n"] for r in found) <= cooccurrence.HEAVY
    pairs = sum(r["n"] * (r["n"] - 1) // 2 if r["right"] is None else r["n"] * len(r["right"]) for r in found)
    assert pairs == 20_000 * 19_999 // 2


# Bayes


def test_the_model_holds_only_cells_that_were_seen(spark):
    rows = [(i, f"label{i}", [f"term{i % 7}", f"own{i}"]) for i in range(10_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, label string, terms array<string>")
    model = bayes.train(docs)
    assert model.cells.count() == 20_000
    asked = spark.createDataFrame([(i, [f"own{i}", "term0"]) for i in range(0, 50)] + [(99, []), (100, ["never"])], "doc_id bigint, terms array<string>")
    found = {r["doc_id"]: r["label"] for r in bayes.predict(asked, model).collect()}
    assert found == {i: f"label{i}" for i in range(50)} | {99: "label0", 100: "label0"}


def test_labels_that_were_not_seen_with_a_term_can_win(spark):
    rows = [(i, "few", ["x", "y"]) for i in range(3)] + [(10 + i, "many", ["y"] * 9) for i in range(40)] + [(90, "none", [])]
    model = bayes.train(spark.createDataFrame(rows, "doc_id bigint, label string, terms array<string>"))
    asked = [(0, ["x"]), (1, ["y"]), (2, ["x", "y", "y"]), (3, []), (4, ["x"] * 50)]
    docs = spark.createDataFrame(asked, "doc_id bigint, terms array<string>")
    idf = {r["term"]: r["idf"] for r in model.terms.collect()}
    theta = {(r["label"], r["term"]): r["theta"] for r in model.weights.collect()}
    for row in bayes.predict(docs, model).collect():
        terms = dict(asked)[row["doc_id"]]
        score = {
            r["label"]: r["prior"] + sum(idf[t] * theta[r["label"], t] for t in terms) / max(len(terms), 1)
            for r in model.labels.collect()
        }
        assert row["label"] == max(score, key=score.get)


def test_vectors_of_a_vocabulary_that_no_task_holds(spark, texts, monkeypatch):
    lexicon = Lexicon.from_words(spark, ["x", "y", "z"])
    tokenized = matching.with_terms(texts("x y y", "z", "?", None).withColumn("label", F.lit("a")), lexicon)
    model = bayes.train(tokenized)
    expected = {r["doc_id"]: r["weights"] for r in bayes.tfidf_vectors(tokenized, model).collect()}
    monkeypatch.setattr(bayes, "MAX_CELLS", 2)
    found = {r["doc_id"]: r["weights"] for r in bayes.tfidf_vectors(tokenized, model).collect()}
    assert found.keys() == expected.keys()
    for doc_id, vector in found.items():
        assert vector.size == expected[doc_id].size and np.allclose(vector.toArray(), expected[doc_id].toArray())


def test_hashed_idf_is_a_table_of_slots_that_occur(spark, texts):
    tokenized = matching.with_terms(texts("x x y", "y", ""), Lexicon.from_words(spark, ["x", "y"]))
    model = embeddings.fit_hashing_tfidf(tokenized)
    assert sorted(r["n_docs"] for r in model.slots.collect()) == [1, 2]
    assert sorted(r["idf"] for r in model.slots.collect()) == sorted([math.log(4 / 2), math.log(4 / 3)])


# Nearest words


@pytest.mark.parametrize(("n", "centres", "part"), [(2000, 40, 100), (300, 1, 10_000), (12, 1024, 3), (1, 4, 4)])
def test_nearest_of_many_words_are_exact(spark, n, centres, part):
    rng = np.random.default_rng(n)
    middle = rng.standard_normal((7, 16))
    rows = middle[rng.integers(0, 7, n)] + 0.2 * rng.standard_normal((n, 16))
    rows[: n // 4] = rows[0]  # copies, more than a part holds
    rows[n // 2 : n // 2 + 2] = 0
    if n > 100:
        rows[5] *= 1e200
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "word bigint, vector array<double>")
    found = neighbours.nearest_many(vectors, vectors.select("word"), 5, centres=centres, part=part).collect()
    scaled = rows / np.maximum(np.abs(rows).max(axis=1, keepdims=True), 1e-300)
    norms = np.linalg.norm(scaled, axis=1, keepdims=True)
    unit = np.divide(scaled, norms, out=np.zeros_like(scaled), where=norms > 0)
    cosines = np.einsum("ij,kj->ik", unit, unit)
    np.fill_diagonal(cosines, -9)
    expected = {}
    for i in range(n):
        order = np.argsort(-cosines[i], kind="stable")[: min(5, n - 1)]
        expected[i] = cosines[i][order]
    got = {}
    for r in sorted(found, key=lambda r: (r["word"], r["rank"])):
        got.setdefault(r["word"], []).append(r)
        assert math.isclose(r["similarity"], cosines[r["word"], r["neighbour"]], abs_tol=1e-12)
    assert n == 1 or got.keys() == expected.keys()
    for word, rows_of in got.items():
        assert np.allclose([r["similarity"] for r in rows_of], expected[word], atol=1e-12)
        assert [r["rank"] for r in rows_of] == list(range(1, len(rows_of) + 1))


def test_whole_groups_are_left_out(spark):
    rng = np.random.default_rng(1)
    middle = 5 * rng.standard_normal((30, 32))
    rows = np.repeat(middle, 40, axis=0) + 0.05 * rng.standard_normal((1200, 32))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "word bigint, vector array<double>")
    units = neighbours.normalised(vectors, "word", "vector")
    members = neighbours.filed(units, np.array([r / np.linalg.norm(r) for r in middle]), 1000)
    assert members.groupBy("grp").count().count() == 30
    found = neighbours.nearest_many(vectors, vectors.select("word"), 3, centres=200)
    assert all(r["word"] // 40 == r["neighbour"] // 40 for r in found.collect())


def test_nearest_of_a_word_without_a_vector_and_of_an_empty_table(spark):
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 1.0])], "word bigint, vector array<double>")
    with pytest.raises(ValueError, match="not in vocabulary"):
        neighbours.nearest_many(vectors, vectors.select("word"))
    assert neighbours.nearest_many(vectors.limit(0), vectors.limit(0).select("word")).collect() == []


# Tiles


@pytest.mark.parametrize(("shape", "share"), [((70, 50, 90), 0.3), ((9, 200, 3), 1.0), ((64, 64, 64), 0.01)])
def test_product_by_tiles(spark, shape, share):
    rng = np.random.default_rng(3)
    a = rng.standard_normal(shape[:2]) * (rng.random(shape[:2]) < share)
    b = rng.standard_normal(shape[1:]) * (rng.random(shape[1:]) < share)

    def table(x):
        i, j = np.nonzero(x)
        return spark.createDataFrame([(int(r), int(c), float(x[r, c])) for r, c in zip(i, j, strict=True)], "row int, col int, value double")

    found = np.zeros((shape[0], shape[2]))
    for r in tiles.product(table(a), table(b), tile=16).collect():
        found[r["row"], r["col"]] += r["value"]
    assert np.allclose(found, a @ b)
    assert tiles.tiled(table(a), 16).count() <= -(-shape[0] // 16) * -(-shape[1] // 16)


# Artifacts


def test_a_version_without_a_manifest_is_not_loaded(spark, tmp_path):
    path = str(tmp_path / "model")
    words = spark.createDataFrame([(0, "a"), (1, "b")], "kw_id int, kw string")
    with pytest.raises(FileNotFoundError):
        artifacts.load(spark, path)
    assert artifacts.save(path, {"dictionary": words, "idf": words}, smoothing=0.5) == 1
    words.write.parquet(f"{path}/tables/dictionary-halfway")  # a version that was never finished
    (tmp_path / "model" / "manifests" / "halfway").mkdir()
    loaded = artifacts.load(spark, path)
    assert loaded.version == 1 and loaded.constants == {"smoothing": 0.5} and sorted(map(tuple, loaded["idf"].collect())) == [(0, "a"), (1, "b")]
    assert artifacts.save(path, {"dictionary": words.limit(1)}) == 2
    assert artifacts.load(spark, path)["dictionary"].count() == 1 and artifacts.load(spark, path, 1)["dictionary"].count() == 2
    with pytest.raises(FileNotFoundError):
        artifacts.load(spark, path, 7)


def test_changed_rows_and_columns_are_noticed(spark, tmp_path):
    path = str(tmp_path / "model")
    words = spark.createDataFrame([(0, "a")], "kw_id int, kw string")
    artifacts.save(path, {"dictionary": words})
    line = json.loads(spark.read.text(f"{path}/manifests/*").first()["value"])
    words.write.mode("append").parquet(line["tables"]["dictionary"]["folder"])
    with pytest.raises(ValueError, match="other rows"):
        artifacts.load(spark, path)
    words.select("kw").write.mode("overwrite").parquet(line["tables"]["dictionary"]["folder"])
    with pytest.raises(ValueError, match="other columns"):
        artifacts.load(spark, path)


def test_edges_grow_by_batches_that_count_once(spark, tmp_path):
    store = artifacts.EdgeStore(spark, str(tmp_path / "edges"))
    words = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "kw_id int, kw string")
    batch = lambda *rows: spark.createDataFrame(list(rows), "kw_id bigint, other_id bigint, n bigint")
    counts = lambda: sorted(map(tuple, store.counts().collect()))
    assert counts() == [] and store.batches() == []
    assert store.add("200811", batch((0, 1, 2), (1, 2, 1)), words)
    assert store.add("200812", batch((0, 1, 5)), words)
    assert not store.add("200811", batch((0, 1, 2)), words)
    assert counts() == [(0, 1, 7), (1, 2, 1)] and store.batches() == ["200811", "200812"]
    store.compact()
    store.compact()
    assert counts() == [(0, 1, 7), (1, 2, 1)] and not store.add("200812", batch((0, 1, 5)), words)
    assert store.add("200901", batch((1, 2, 1)), words) and counts() == [(0, 1, 7), (1, 2, 2)]
    with pytest.raises(ValueError, match="another dictionary"):
        store.add("200902", batch((0, 1, 1)), words.limit(2))


# Files


def test_names_are_chosen_when_files_are_listed(spark, tmp_path):
    for name in ("news200811.txt", "news200812.txt", "{odd}[name].txt"):
        (tmp_path / name).write_text(f"1\tx\tbody of {name}\n")
    lines = files.read_lines_with_path(spark, str(tmp_path), name_contains="200812")
    assert [r["text"] for r in lines.collect()] == ["1\tx\tbody of news200812.txt"]
    assert lines.inputFiles() == [f"file://{tmp_path}/news200812.txt"]
    odd = files.read_whole_files(spark, str(tmp_path), name_contains="{odd}[")
    assert odd.select(files.tab_field(F.col("content"), 2)).first()[0] == "body of {odd}[name].txt\n"


# Word vectors


def planted(seed, n_topics=40):
    """Sentences in which two words of a topic, never together, stand among the same others."""
    rng = random.Random(seed)
    own = [[f"c{t}_{i}" for i in range(6)] for t in range(n_topics)]
    lines = []
    for _ in range(6000):
        t = rng.randrange(n_topics)
        words = rng.sample(own[t], 4)
        words.insert(rng.randrange(5), f"{rng.choice('ab')}{t}")
        lines.append((words,))
    return lines


@pytest.fixture(scope="module")
def trained(spark):
    lines = spark.createDataFrame(planted(1), "tokens array<string>")
    return skipgram.fit(lines, size=24, epochs=6, part_words=100)


def test_planted_synonyms_are_among_the_nearest(spark, trained):
    words = {r["word"] for r in trained.collect()}
    asked = [f"a{t}" for t in range(40) if f"a{t}" in words and f"b{t}" in words]
    found = embeddings.nearest(trained, spark.createDataFrame([(w,) for w in asked], "word string"), 10).collect()
    hits = {r["word"] for r in found if r["neighbour"] == "b" + r["word"][1:]}
    assert len(asked) == 40 and len(hits) >= 0.9 * len(asked)


def test_the_same_seed_gives_the_same_vectors_in_any_order(spark, trained):
    lines = planted(1)
    again = skipgram.fit(spark.createDataFrame(lines[::-1], "tokens array<string>").repartition(7), size=24, epochs=6, part_words=100)
    one, two = ({r["word"]: r["vector"] for r in x.collect()} for x in (trained, again))
    assert one.keys() == two.keys() and all(np.allclose(one[w], two[w]) for w in one)


def test_block_pairs_of_a_step_share_no_vectors(spark):
    words = spark.createDataFrame([(i, f"w{i}", 5) for i in range(50)], "id int, word string, n bigint")
    vectors = skipgram._initial(words, 4, 8, 1)
    assert vectors.count() == 8
    pairs = spark.createDataFrame([(i, j, 1.0) for i in range(50) for j in range(50) if i != j], "center bigint, context bigint, weight double")
    blocks = skipgram._blocks(pairs, 4)
    assert blocks.count() == 16
    one = {(r["kind"], r["part"]): r["matrix"] for r in skipgram._stepped(vectors, blocks, 4, 1, 8, [1]).collect()}
    assert len(one) == 8 and all(np.isfinite(np.frombuffer(m)).all() for m in one.values())


def test_vectors_of_no_words(spark):
    empty = spark.createDataFrame([], "tokens array<string>")
    assert skipgram.fit(empty).collect() == []
    assert skipgram.fit(spark.createDataFrame([(["a", "b"],), (None,), ([],)], "tokens array<string>")).collect() == []


def test_written_tables_can_be_deleted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lineage, "shared_folder", lambda _: str(tmp_path))
    table = lineage.materialize(spark.range(5).toDF("x"), "some")
    assert table.count() == 5 and any(tmp_path.rglob("part-*"))
    lineage.clean(spark)
    assert not any(tmp_path.rglob("part-*"))


@pytest.mark.parametrize("costly", [False, True])
def test_a_hot_key_is_spread_and_costly_rows_are_read_back(spark, costly):
    big = spark.range(1000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), "id")
    side = spark.createDataFrame([(7, "hot"), (3, "three")], "k bigint, v string")
    found = joins.spread_join(big, side, "k", hot_rows=100, costly=costly)
    assert {(r["v"], r["count"]) for r in found.groupBy("v").count().collect()} == {("hot", 666), ("three", 1)}
    parts = found.withColumn("p", F.spark_partition_id()).where("k = 7").select("p").distinct().count()
    assert parts > 1
