"""Folds of a search and models of a comparison run side by side."""

import threading

from lendscope.operators import models as M
from lendscope.plans import catalog_ml as C
from tests.conftest import SF


def test_models_are_trained_side_by_side(monkeypatch):
    meet = threading.Barrier(3, timeout=20)                   # breaks unless all three are under way at once

    def train(df, key, candidates=None, **_):
        meet.wait()
        return key, candidates

    monkeypatch.setattr(M, "train_and_evaluate", train)
    assert M.train_all(None, ["x", "y", "z"], {"y": [1]}) == [("x", None), ("y", [1]), ("z", None)]


def test_folds_are_scored_side_by_side(spark, monkeypatch):
    meet, build = threading.Barrier(3, timeout=60), M.build_preprocessing_pipeline

    def wait():
        meet.wait()
        return build()

    monkeypatch.setattr(M, "build_preprocessing_pipeline", wait)
    df = C.split_loans(spark, SF).withColumn("fold", C.F.col("fold") % 3)
    folds, _ = M.cross_validate(df, "logistic_regression", [{"C": 1.0}], k=3)
    assert sorted(r.fold for r in folds.collect()) == [0, 1, 2]
