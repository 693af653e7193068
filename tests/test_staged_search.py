"""Staged scores: prefixes of one ensemble against fits and models of their own."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lendscope.operators import models as M
from lendscope.operators import prep as FP
from lendscope.operators.staged import segment, staged_scores, tree_groups
from lendscope.plans.inputs import loans
from tests.conftest import SF


@pytest.fixture(scope="module")
def ready(spark):
    df = M.with_label(loans(spark, SF))
    return FP.build_preprocessing_pipeline().fit(df).transform(df).select("id", "features", M.LABEL).coalesce(2).persist()


def scores(model, rows):
    return {r.id: r.p for r in model.transform(rows).select("id", vector_to_array("probability")[1].alias("p")).collect()}


def test_boosted_prefixes_equal_separate_fits(ready):
    make = lambda n: M.boosted_classifier(n_estimators=n, max_depth=3, learning_rate=0.2, subsample=0.7,
                                          colsample_bytree=0.6).fit(ready)
    whole = make(9)
    got = {(r.id, r.n_trees): r.p for r in staged_scores(whole, ready, [2, 5, 9], keep=["id"]).collect()}
    for n in (2, 5, 9):
        own = scores(make(n), ready)
        assert own.keys() == {i for i, k in got if k == n}
        assert all(abs(got[i, n] - p) < 1e-9 for i, p in own.items())


def test_forest_prefixes_equal_forests_of_the_first_trees(ready):
    forest = M.forest_classifier(n_estimators=8, max_depth=5).fit(ready)
    got = {(r.id, r.n_trees): r.p for r in staged_scores(forest, ready, [8, 3, 3], keep=["id"]).collect()}
    assert {k for _, k in got} == {3, 8}
    for n, model in ((8, forest), (3, segment(forest, 0, 3))):
        assert all(abs(got[i, n] - p) < 1e-9 for i, p in scores(model, ready).items())
    trees = [{r.id: r.p for r in t.transform(ready).select("id", vector_to_array("probability")[1].alias("p")).collect()}
             for t in forest.trees[:3]]
    assert all(abs(got[i, 3] - sum(t[i] for t in trees) / 3) < 1e-9 for i in trees[0])
    with pytest.raises(ValueError):
        staged_scores(forest, ready, [9])


def test_groups_and_search(spark):
    space = [{"n_estimators": n, "max_depth": d} for d in (2, 3) for n in (4, 2, 4)]
    groups = tree_groups(space)
    assert [(g[0], g[1]) for g in groups] == [({"max_depth": 2, "n_estimators": 4}, {4: [0, 2], 2: [1]}),
                                              ({"max_depth": 3, "n_estimators": 4}, {4: [3, 5], 2: [4]})]
    df = FP.stratified_folds(FP.stratified_split(loans(spark, SF)), 3).filter("split = 'train'")
    folds, summ = M.cross_validate(df, "gradient_boosting", space, k=3)
    auc = {(r.candidate, r.fold): r.roc_auc for r in folds.collect()}
    assert len(auc) == 18 and summ.count() == 6
    assert all(auc[0, f] == auc[2, f] and auc[3, f] == auc[5, f] for f in range(3))
    single, _ = M.cross_validate(df, "gradient_boosting", [space[1]], k=3)
    assert {r.fold: round(r.roc_auc, 9) for r in single.collect()} == {f: round(auc[1, f], 9) for f in range(3)}


def test_draws_cover_the_spaces():
    draws = M.random_draws(M.FOREST_SPACE, M.FOREST_N_ITER)
    assert len(draws) == 20 and all(d[k] in M.FOREST_SPACE[k] for d in draws for k in M.FOREST_SPACE)
    assert M.random_draws(M.FOREST_SPACE, 20) == draws
