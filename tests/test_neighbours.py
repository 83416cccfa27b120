"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from conftest import rows

from callgrid.operators import modeling as m, neighbours as nb


def truth(train, query, k):
    """Places in `train`, nearest first; equal distances by vector, then by place."""
    d2 = nb.squared_distances(np.array([query]), train)[0]
    return sorted(range(len(train)), key=lambda i: (d2[i], *train[i], i))[:k]


@pytest.mark.parametrize("k", [1, 4, 30, 500])
def test_neighbours_are_exact(spark, monkeypatch, k):
    """Clusters, a vector that a third of all rows share, ties on a lattice; blocks of a few rows."""
    monkeypatch.setattr(nb, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(k)
    centres = rng.normal(size=(6, 3)) * 50
    train = np.concatenate([centres[rng.integers(0, 6, 120)] + rng.normal(size=(120, 3)), np.tile(centres[0], (100, 1)), rng.integers(-2, 3, (80, 3))])
    asked = np.concatenate([train[::17], rng.normal(size=(20, 3)) * 60, [[0.5, 0.5, 0.5]]])
    t = spark.createDataFrame([(v.tolist(), i, i * 2) for i, v in enumerate(train)], "v array<double>, key int, twice int").repartition(5)
    q = spark.createDataFrame([(v.tolist(),) for v in asked], "q array<double>")
    got = {}
    for r in nb.nearest_neighbours(t, q, k).collect():
        assert r["twice"] == 2 * r["key"]
        got.setdefault(tuple(r["q"]), {})[r["rank"]] = r["key"]
    assert set(got) == {tuple(v) for v in asked.tolist()}
    for v, found in got.items():
        assert [found[i] for i in sorted(found)] == truth(train, v, k)


def test_far_cells_are_not_visited():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 4)) * 100
    train = centres[rng.integers(0, 40, 2000)] + rng.normal(size=(2000, 4))
    pivots = train[:44]
    home = nb.squared_distances(train, pivots).argmin(axis=1)
    far = np.sqrt(nb.squared_distances(train, pivots)[np.arange(2000), home])
    cells = nb.Cells(pivots, np.bincount(home, minlength=44), np.array([far[home == c].max(initial=0) for c in range(44)]))
    first = cells.first(train, 5)
    assert (first.sum(axis=1) >= 1).all() and (first @ cells.count >= 5).all()
    d2 = nb.squared_distances(train, train)
    fifth = np.sqrt(np.sort(d2, axis=1)[:, 4])
    near = cells.within(train, fifth)
    for i in range(0, 2000, 50):  # every cell with one of the five is visited
        assert near[i, home[np.argsort(d2[i], kind="stable")[:5]]].all()
    assert near.sum(axis=1).mean() < 8, "of 44 cells"


def test_neighbour_scores(spark):
    train = spark.createDataFrame([(1, 0, 0.0), (2, 1, 1.0), (3, 1, 3.0), (4, 0, 3.0)], "id int, y int, a double")
    test = spark.createDataFrame([(7, 0, 0.0), (8, 1, 2.0)], "id int, y int, a double")
    got = lambda **p: {(r["split"], r["id"]): r["score"] for r in m.fit_score(train, test, "y", "id", ["a"], "KNN", **p).collect()}
    one = got(n_neighbors=1)
    assert one["test", 7] == 0.0 and one["test", 8] == 1.0 and one["train", 3] == one["train", 4] == 1.0  # equal vectors: the first key
    weighted = got(n_neighbors=3, weights="distance")
    assert weighted["test", 7] == 0.0 and weighted["test", 8] == pytest.approx(2 / 3) and weighted["train", 3] == 0.5
    assert got(n_neighbors=9)["test", 8] == 0.5
    with pytest.raises(ValueError):
        m.fit_score(train, test, "y", "id", ["a"], "KNN", weights="none")
    none = m.fit_score(train.limit(0), test, "y", "id", ["a"], "KNN", n_neighbors=1)
    assert rows(none, "id", "score") == [(7, None), (8, None)]
    holes = test.union(spark.createDataFrame([(9, 0, None)], test.schema))
    with pytest.raises(Exception, match="missing"):
        m.fit_score(train, holes, "y", "id", ["a"], "KNN", n_neighbors=1).collect()
