import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendscope.operators import models as M
from lendscope.operators import prep as FP
from lendscope.operators import trees as TR
from tests.test_prep_models_segments import _planted


def _cond_value(tree, x, S, node=0):
    left, right, feat, thr, cat, cover, value = tree
    if left[node] < 0:
        return value[node]
    d = feat[node]
    l, r = left[node], right[node]
    if d in S:
        go_left = (x[d] in cat[node]) if cat[node] is not None else x[d] <= thr[node]
        return _cond_value(tree, x, S, l if go_left else r)
    return (cover[l] * _cond_value(tree, x, S, l) + cover[r] * _cond_value(tree, x, S, r)) / cover[node]


def _brute_shapley(tree, x):
    used = sorted({int(f) for f in tree[2] if f >= 0})
    m = len(used)
    phi = {}
    for i in used:
        others = [f for f in used if f != i]
        s = 0.0
        for k in range(len(others) + 1):
            for sub in itertools.combinations(others, k):
                w = math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m)
                s += w * (_cond_value(tree, x, set(sub) | {i}) - _cond_value(tree, x, set(sub)))
        phi[i] = s
    return phi


@pytest.fixture(scope="module")
def fitted(spark):
    df = FP.stratified_split(_planted(spark, 400), test_size=0.2, validation_size=0.2)
    tr = M.with_label(df.filter(F.col("split") == "train"))
    gbt = M.make_estimator("gradient_boosting", {"n_estimators": 8, "max_depth": 3}, 1).fit(tr)
    rf = M.make_estimator("random_forest", {"n_estimators": 6, "max_depth": 3}, 1).fit(tr)
    return df, gbt, rf


@pytest.mark.parametrize("which", ["gbt", "rf"])
def test_tree_attribution_is_additive(spark, fitted, which):
    df, gbt, rf = fitted
    model = gbt if which == "gbt" else rf
    test = df.filter(F.col("split") == "test")
    contrib, base = TR.tree_attribution(model, test, FP.feature_names(model))
    tot = contrib.groupBy("row_id").agg(F.sum("contribution").alias("s"))
    j = tot.join(TR.margin_of(model, test), "row_id").collect()
    assert len(j) == test.count()
    for r in j:
        assert r.s + base == pytest.approx(r.target, abs=1e-6)


def test_tree_shap_matches_brute_force(spark, fitted):
    df, gbt, _ = fitted
    packed, weights, _ = TR._pack(gbt.stages[-1], spark)
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array
    X = np.array([r[0] for r in PipelineModel(stages=gbt.stages[:-1]).transform(df.limit(5))
                  .select(vector_to_array("features")).collect()])
    tree = packed[0]
    phi = np.zeros_like(X)
    TR._tree_shap(tree, X, phi, 1.0)
    for row in range(X.shape[0]):
        exact = _brute_shapley(tree, X[row])
        for f, v in exact.items():
            assert phi[row, f] == pytest.approx(v, abs=1e-9)
