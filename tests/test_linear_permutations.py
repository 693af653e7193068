"""Permutation importance of a linear model on packed arrays against the path that transforms every permuted row."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendscope import roles as R
from lendscope.operators import explain as X
from lendscope.operators import models as M
from lendscope.plans import catalog_ml as C
from tests.conftest import SF


@pytest.fixture(scope="module")
def fitted(spark):
    df = C.split_only(spark, SF)
    model, _ = C._fit_eval(df, "logistic_regression", {"C": 1.0, "penalty": "l2"})
    return model, df


def aucs(df):
    return {(r["_feature"], r["_repeat"]): r.roc_auc for r in df.collect()}


def test_equal_to_the_general_path_with_repeated_and_null_ids(spark, fitted):
    model, df = fitted
    test = df.filter(F.col("split") != "train")
    odd = (test.unionByName(test.filter(F.col("id") % 3 == 0).withColumn("annual_inc", F.col("annual_inc") + 5000.0))
           .unionByName(test.limit(2).withColumn("id", F.lit(None).cast(dict(test.dtypes)["id"]))).persist())
    cols = R.LOAN_ROLES.features
    rows = odd.select("id", R.TARGET_COLUMN, *cols)
    a = aucs(X._linear_permutations(model, rows, cols, X._slots(model, cols), 2, 42, "id", R.TARGET_COLUMN))
    b = aucs(X._shuffled_permutations(model, rows, cols, 2, 42, "id", R.TARGET_COLUMN))
    assert a.keys() == b.keys() and len(a) == 2 * len(cols)
    assert all(a[k] == pytest.approx(b[k], abs=1e-9) for k in a)


def test_linear_models_are_not_scored_row_by_row(fitted, monkeypatch):
    def no(*_, **__):
        raise AssertionError("every permuted row was transformed")

    monkeypatch.setattr(X, "_shuffled_permutations", no)
    model, df = fitted
    out = X.permutation_importance(model, df.filter("split = 'test'"), R.LOAN_ROLES.features, repeats=1)
    assert out.count() == len(R.LOAN_ROLES.features)


def test_hash_of_one_more_column_is_spark_s(spark):
    rows = (spark.range(-3, 40).select(F.xxhash64("id", F.lit(42), F.lit("a")).alias("h"),
                                       *[F.xxhash64("id", F.lit(42), F.lit("a"), F.lit(r)).alias(f"r{r}") for r in (0, 7)])
            .collect())
    for r in (0, 7):
        assert X._hashed_int(np.array([x.h for x in rows]), r).tolist() == [x[f"r{r}"] for x in rows]


def test_exact_auc():
    y = np.array([1, 0, 1, 0, 2])
    assert X._exact_auc(np.array([0.9, 0.1, 0.5, 0.5, 0.0]), y) == 0.875
    assert X._exact_auc(np.full(5, np.nan), y) == 0.5
    assert X._exact_auc(np.ones(3), np.ones(3)) is None
