"""Tree-model internals as tables: split statistics (X3) and path-dependent
tree attribution (X6).

The fitted MLlib ensemble is written with its standard writer into the shared
checkpoint folder and its node table (``data/`` parquet: treeID, id,
prediction, impurityStats, rawCount, gain, leftChild, rightChild, split) is
read back with Spark.  X3 is a grouped aggregation of that table.  For X6 the
nodes (bounded by the model size, not the data) are packed into flat arrays,
broadcast, and every partition of the scored rows runs path-dependent
TreeSHAP vectorised over its Arrow batch (``mapInPandas``); output is the
long ``(row_id, feature, contribution)`` table plus the base value, in
margin space for boosted trees and probability space for forests.
"""

from __future__ import annotations

import uuid
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.session import checkpoint_dir


def node_table(model, spark) -> DataFrame:
    """The ensemble's node rows (treeID, nodeData.*) read back from its saved form."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/tree-models/{uuid.uuid4().hex}"
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    return nodes.select("treeID", "nodeData.*")


# X3
def split_statistics(model, feature_names: Sequence[str], spark) -> DataFrame:
    """Per feature: mean gain per split, number of splits (weight), mean rows
    reaching the split (cover); unused features get zeros."""
    nodes = node_table(model, spark)
    splits = nodes.filter(F.col("leftChild") >= 0).select(
        F.col("split.featureIndex").alias("j"), "gain", F.col("rawCount").cast("double").alias("cover"))
    st = splits.groupBy("j").agg(F.avg("gain").alias("gain"), F.count(F.lit(1)).alias("weight"),
                                 F.avg("cover").alias("cover"))
    names = spark.createDataFrame(list(enumerate(feature_names)), "j int, feature string")
    return (names.join(st, "j", "left").fillna(0, ["gain", "weight", "cover"])
            .select("feature", "gain", F.col("weight").cast("long"), "cover").orderBy(F.desc("gain")))


def _pack(model, spark):
    """Flat arrays per tree: children, feature, threshold, left categories, cover, value."""
    nodes = node_table(model, spark).select(
        "treeID", "id", "leftChild", "rightChild", F.col("split.featureIndex").alias("feat"),
        F.col("split.leftCategoriesOrThreshold").alias("lct"), F.col("split.numCategories").alias("ncat"),
        F.col("rawCount").cast("double").alias("cover"), "impurityStats", "prediction")
    rows = nodes.collect()  # model size: #trees x #nodes
    forest = isinstance(model, RandomForestClassificationModel)
    trees = {}
    for r in rows:
        trees.setdefault(r["treeID"], []).append(r)
    packed = []
    for tid in sorted(trees):
        ns = sorted(trees[tid], key=lambda r: r["id"])
        n = max(r["id"] for r in ns) + 1
        left = np.full(n, -1, np.int64)
        right = np.full(n, -1, np.int64)
        feat = np.full(n, -1, np.int64)
        thr = np.zeros(n)
        cat = [None] * n
        cover = np.zeros(n)
        value = np.zeros(n)
        for r in ns:
            i = r["id"]
            left[i], right[i], cover[i] = r["leftChild"], r["rightChild"], max(r["cover"], 1e-12)
            if r["leftChild"] >= 0:
                feat[i] = r["feat"]
                if r["ncat"] is not None and r["ncat"] >= 0:
                    cat[i] = set(float(v) for v in r["lct"])
                else:
                    thr[i] = float(r["lct"][0])
            if forest:
                s = np.asarray(r["impurityStats"], dtype=float)
                value[i] = s[1] / s.sum() if s.sum() > 0 else 0.0
            else:
                value[i] = float(r["prediction"])
        packed.append((left, right, feat, thr, cat, cover, value))
    if forest:
        weights = np.full(len(packed), 1.0 / len(packed))
    else:
        weights = np.asarray(model.treeWeights, dtype=float)
    root = 0
    return packed, weights, root


def _expected(tree, node=0):
    left, right, feat, thr, cat, cover, value = tree
    if left[node] < 0:
        return value[node]
    l, r = left[node], right[node]
    return (cover[l] * _expected(tree, l) + cover[r] * _expected(tree, r)) / cover[node]


def _tree_shap(tree, X: np.ndarray, phi: np.ndarray, scale: float):
    """Path-dependent TreeSHAP for one tree, vectorised over the rows of X.
    Path elements carry scalar feature index and zero fraction, and per-row
    one fraction and weight vectors."""
    left, right, feat, thr, cat, cover, value = tree
    n = X.shape[0]

    def extend(path, pz, po, pi):
        ds, zs, os_, ws = path
        l = len(ds)
        ds, zs, os_, ws = ds + [pi], zs + [pz], os_ + [po], [w.copy() for w in ws] + [
            np.ones(n) if l == 0 else np.zeros(n)]
        for i in range(l - 1, -1, -1):
            ws[i + 1] = ws[i + 1] + po * ws[i] * (i + 1) / (l + 1)
            ws[i] = pz * ws[i] * (l - i) / (l + 1)
        return ds, zs, os_, ws

    def unwound_sum(path, i):
        ds, zs, os_, ws = path
        l = len(ds) - 1
        o, z = os_[i], zs[i]
        total = np.zeros(n)
        nxt = ws[l].copy()
        nz = o != 0
        safe_o = np.where(nz, o, 1.0)
        for j in range(l - 1, -1, -1):
            tmp_hot = nxt * (l + 1) / ((j + 1) * safe_o)
            cold = ws[j] * (l + 1) / (z * (l - j)) if z != 0 else np.zeros(n)
            total += np.where(nz, tmp_hot, cold)
            nxt = np.where(nz, ws[j] - tmp_hot * z * (l - j) / (l + 1), nxt)
        return total

    def unwind(path, i):
        ds, zs, os_, ws = path
        l = len(ds) - 1
        o, z = os_[i], zs[i]
        nz = o != 0
        safe_o = np.where(nz, o, 1.0)
        nxt = ws[l].copy()
        ws = [w.copy() for w in ws[:l]]
        for j in range(l - 1, -1, -1):
            hot = nxt * (l + 1) / ((j + 1) * safe_o)
            cold = ws[j] * (l + 1) / (z * (l - j)) if z != 0 else np.zeros(n)
            newj = np.where(nz, hot, cold)
            nxt = np.where(nz, ws[j] - hot * z * (l - j) / (l + 1), nxt)
            ws[j] = newj
        ds2 = ds[:i] + ds[i + 1:]
        zs2 = zs[:i] + zs[i + 1:]
        os2 = os_[:i] + os_[i + 1:]
        return ds2, zs2, os2, ws

    def recurse(j, path, pz, po, pi):
        path = extend(path, pz, po, pi)
        if left[j] < 0:
            ds, zs, os_, ws = path
            for i in range(1, len(ds)):
                w = unwound_sum(path, i)
                phi[:, ds[i]] += scale * w * (os_[i] - zs[i]) * value[j]
            return
        d = feat[j]
        if cat[j] is not None:
            goes_left = np.isin(X[:, d], list(cat[j]))
        else:
            goes_left = X[:, d] <= thr[j]
        iz, io = 1.0, np.ones(n)
        ds = path[0]
        if d in ds[1:]:
            k = ds.index(d, 1)
            iz, io = path[1][k], path[2][k]
            path = unwind(path, k)
        l_, r_ = left[j], right[j]
        recurse(l_, path, iz * cover[l_] / cover[j], io * goes_left, d)
        recurse(r_, path, iz * cover[r_] / cover[j], io * (~goes_left), d)

    recurse(0, ([], [], [], []), 1.0, np.ones(n), -1)


def tree_attribution(model: PipelineModel, df: DataFrame, feature_names: Sequence[str],
                     id_col: str = "id") -> tuple:
    """Per-row, per-feature contributions of the final tree ensemble.

    Returns (long DataFrame (row_id, feature, contribution), base value).
    Additivity: base + sum of a row's contributions equals its margin
    (boosted trees) or positive-class probability (forest)."""
    clf = model.stages[-1]
    if not isinstance(clf, (GBTClassificationModel, RandomForestClassificationModel)):
        raise TypeError("tree attribution needs a boosted-tree or forest model")
    spark = df.sparkSession
    packed, weights, _ = _pack(clf, spark)
    base = float(sum(w * _expected(t) for t, w in zip(packed, weights)))
    bc = spark.sparkContext.broadcast((packed, weights))  # model-sized
    names = list(feature_names)
    prep = PipelineModel(stages=model.stages[:-1])
    x = prep.transform(df).select(F.col(id_col).cast("long").alias("row_id"),
                                  vector_to_array("features").alias("v"))

    def run(it):
        trees, ws = bc.value
        for pdf in it:
            if len(pdf) == 0:
                continue
            X = np.vstack(pdf["v"].to_numpy()).astype(float)
            phi = np.zeros_like(X)
            for t, w in zip(trees, ws):
                _tree_shap(t, X, phi, w)
            out = pd.DataFrame({"row_id": np.repeat(pdf["row_id"].to_numpy(), len(names)),
                                "feature": np.tile(names, len(pdf)),
                                "contribution": phi.reshape(-1)})
            yield out

    long = x.mapInPandas(run, "row_id long, feature string, contribution double")
    return long, base


def margin_of(model: PipelineModel, df: DataFrame, id_col: str = "id") -> DataFrame:
    """The quantity tree attributions add up to: margin (boosted) or p (forest)."""
    clf = model.stages[-1]
    t = model.transform(df)
    if isinstance(clf, GBTClassificationModel):
        return t.select(F.col(id_col).alias("row_id"), vector_to_array("rawPrediction")[1].alias("target"))
    return t.select(F.col(id_col).alias("row_id"), vector_to_array("probability")[1].alias("target"))
