"""Nearest vectors where no bound leaves groups out."""

import numpy as np
from newsloom.operators import neighbours


def test_vectors_are_copied_once_per_bin_where_no_bound_helps(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = rng.standard_normal((400, 32))
    rows[100:200] = rows[0]
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "word bigint, vector array<double>")
    sides = []
    searched = neighbours._searched
    monkeypatch.setattr(neighbours, "_searched", lambda words, members, *a: sides.append((words, members)) or searched(words, members, *a))
    found = neighbours.nearest_many(vectors, vectors.select("word"), 4, centres=50, part=100).collect()
    # 50 groups, but some 4 bins: a word goes to its own bin and to the others.
    assert sum(words.count() for words, _ in sides) <= 6 * 400
    got = {}
    for r in sorted(found, key=lambda r: (r["word"], r["rank"])):
        got.setdefault(r["word"], []).append(r["neighbour"])
    assert got[0] == [100, 101, 102, 103] and got[101] == [0, 100, 102, 103]
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    cosines = unit @ unit.T
    np.fill_diagonal(cosines, -9)
    assert all(np.allclose(cosines[i, got[i]], np.sort(cosines[i])[::-1][:4]) for i in range(400))
