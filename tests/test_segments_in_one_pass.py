"""k-means of many models in one pass, agglomerative merges, isotonic pooling."""

import random

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from lendscope.operators import isotonic as I
from lendscope.operators import kmeans as K
from lendscope.operators import segments as G


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(c, 0.6, size=(60, 3)) for c in ([0, 0, 0], [5, 0, 1], [0, 6, 2], [4, 5, 9])])
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "row_id long, v array<double>")
    return df.select("row_id", array_to_vector("v").alias("features")).repartition(3).persist(), x


def lloyd(x, centers, tol=1e-4):
    while True:
        d = ((x[:, None] - centers[None]) ** 2).sum(2)
        near = d.argmin(1)
        new = np.array([x[near == j].mean(0) if (near == j).any() else centers[j] for j in range(len(centers))])
        if np.sqrt(((new - centers) ** 2).sum(1)).max() <= tol:
            return centers, d.min(1).sum()
        centers = new


def test_all_models_equal_plain_lloyd(points):
    df, x = points
    fits = K.fit_many(df, [2, 4, 5], restarts=3, seed=7)
    assert [(f.k, f.restart) for f in fits] == [(k, r) for k in (2, 4, 5) for r in range(3)]
    sample = np.array([r.v for r in df.select(vector_to_array("features").alias("v"))
                       .orderBy(F.xxhash64("v"), "v").collect()])
    for f in fits:
        centers, cost = lloyd(x, K.seeds(sample, f.k, np.random.default_rng([7, f.k, f.restart])))
        assert np.allclose(f.centers, centers) and abs(f.inertia - cost) < 1e-6 * cost
    best = K.best_of(fits)
    ml = min(KMeans(k=4, seed=s, tol=1e-4).fit(df).summary.trainingCost for s in range(3))
    assert best[4].inertia <= ml * (1 + 1e-6)


def test_model_and_sweep(points, tmp_path):
    df, x = points
    model, inertia = G.fit_kmeans(df, 4, restarts=3)
    lab = {r.row_id: r.cluster for r in model.transform(df).collect()}
    near = ((x[:, None] - np.array(model.clusterCenters())[None]) ** 2).sum(2)
    assert all(near[i].argmin() == c for i, c in lab.items()) and abs(near.min(1).sum() - inertia) < 1e-6 * inertia
    model.write().save(str(tmp_path / "m"))
    assert np.allclose(KMeansModel.load(str(tmp_path / "m")).clusterCenters(), model.clusterCenters())
    table = G.evaluate_optimal_k(df, [2, 3, 4, 5], restarts=2)
    assert [r.k for r in table.orderBy("k").collect()] == [2, 3, 4, 5]
    assert G.recommend_optimal_k(table).first().recommended_k == 4
    with pytest.raises(ValueError):
        K.fit_many(df.limit(0), [2])
    same = df.limit(1).crossJoin(df.sparkSession.range(20)).select("features")
    assert K.fit_many(same, [3], 1)[0].inertia < 1e-9


def brute_merges(points, weights, linkage):
    groups = [([i], weights[i]) for i in range(len(points))]
    out = []
    dist = lambda a, b: np.sqrt(((points[a] - points[b]) ** 2).sum())

    def height(g, h):
        if linkage == "complete":
            return max(dist(a, b) for a in g[0] for b in h[0])
        if linkage == "average":
            return sum(weights[a] * weights[b] * dist(a, b) for a in g[0] for b in h[0]) / (g[1] * h[1])
        mean = lambda g: sum(weights[a] * points[a] for a in g[0]) / g[1]
        return np.sqrt(2 * g[1] * h[1] / (g[1] + h[1]) * ((mean(g) - mean(h)) ** 2).sum())

    while len(groups) > 1:
        h, i, j = min((height(groups[i], groups[j]), i, j) for i in range(len(groups)) for j in range(i))
        out.append(h)
        groups[j] = (groups[j][0] + groups[i][0], groups[j][1] + groups[i][1])
        del groups[i]
    return out


@pytest.mark.parametrize("linkage", G.LINKAGES)
def test_merge_heights_equal_brute_force(linkage):
    rng = np.random.default_rng(3)
    for m in (1, 2, 17):
        x, w = rng.normal(size=(m, 4)), rng.integers(1, 6, size=m).astype(float)
        merges = G.merge_tree(x, w, linkage)
        assert np.allclose([t[2] for t in merges], brute_merges(x, w, linkage))
        assert not merges or abs(merges[-1][3] - w.sum()) < 1e-9
        labels = G.cut_tree(merges, m, min(3, m))
        assert len(set(labels)) == min(3, m)
    with pytest.raises(ValueError):
        G.merge_tree(x, w, "median")


def test_hierarchical_exact_and_micro(points):
    df, x = points
    for micro in (1000, 40):
        for linkage in G.LINKAGES:
            lab, merges = G.fit_hierarchical(df, 4, micro=micro, linkage=linkage)
            got = {r.row_id: r.cluster for r in lab.select("row_id", "cluster").collect()}
            truth = {}
            assert all(truth.setdefault(i // 60, c) == c for i, c in got.items()) and len(set(truth.values())) == 4
            assert len(got) == 240 and len(merges) == (239 if micro == 1000 else 39)


def plain_isotonic(rows):
    blocks = []
    for s in sorted({s for s, _ in rows}):
        ys = [y for t, y in rows if t == s]
        blocks.append([[s], len(ys), sum(ys)])
        while len(blocks) > 1 and blocks[-2][2] / blocks[-2][1] >= blocks[-1][2] / blocks[-1][1]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2] + last[2]]
    return {s: b[2] / b[1] for b in blocks for s in b[0]}


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_isotonic_equals_plain_pooling(spark, parts):
    rng = random.Random(parts)
    for shape in (lambda s: s, lambda s: 1 - s, lambda s: 0.5, lambda s: (s * 7) % 1):
        rows = [(s := rng.randrange(300) / 300, int(rng.random() < shape(s))) for _ in range(1500)]
        rows += [(0.25, 1)] * 700                                   # a score that a third of the rows hold
        df = spark.createDataFrame(rows + [(None, 1), (0.5, None), (float("nan"), 0)], "s double, y int")
        curve = I.fit_isotonic(df, "s", "y", parts)
        got = {r.s: r.c for r in df.select("s", curve.apply(F.col("s")).alias("c")).distinct().collect()
               if r.s is not None and r.s == r.s}
        want = plain_isotonic(rows)
        assert all(abs(got[s] - v) < 1e-12 for s, v in want.items())
        assert curve.values == sorted(curve.values)


def test_isotonic_edges(spark):
    df = spark.createDataFrame([(0.2, 0), (0.4, 1), (None, 1)], "s double, y int")
    curve = I.fit_isotonic(df, "s", "y")
    ask = spark.createDataFrame([(v,) for v in (-1.0, 0.2, 0.3, 0.4, 9.0, None, float("nan"))], "s double")
    got = [r.c for r in ask.select(curve.apply(F.col("s")).alias("c")).collect()]
    assert [g if g is None else round(g, 9) for g in got] == [0.0, 0.0, 0.5, 1.0, 1.0, None, None]
    none = I.fit_isotonic(df.limit(0), "s", "y")
    assert [r.c for r in ask.select(none.apply(F.col("s")).alias("c")).collect()] == [None] * 7
