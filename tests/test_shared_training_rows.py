"""Models of a comparison share one look at the training rows; what each gets equals fits of its own."""

import pytest
from pyspark.sql import functions as F

from lendscope import roles as R
from lendscope.operators import models as M
from lendscope.operators import prep as FP
from lendscope.plans import catalog_ml as C
from tests.conftest import SF

ONE = {"logistic_regression": [{"C": 1.0, "class_weight": "balanced"}], "random_forest": [{"n_estimators": 3, "max_depth": 2}]}


@pytest.fixture(scope="module")
def split(spark):
    return C.split_loans(spark, SF).persist()


def features(df):
    return sorted(tuple(round(x, 9) for x in r.features.toArray()) for r in df.select("features").collect())


def test_sets_equal_pipelines_of_their_own(split):
    train = split.filter("split = 'train'")
    with M.TrainingRows(lambda: train) as rows:
        assert rows.names() == [0, 1, 2, 3, 4]
        for fold in (None, 2):
            mine = train if fold is None else train.filter(F.col("fold") != fold)
            prep = FP.build_preprocessing_pipeline().fit(mine)
            ready, n = rows.train(fold, "balanced")
            assert n == mine.count() and features(ready) == features(prep.transform(mine))
            want = FP.class_weights(mine).groupBy(R.TARGET_COLUMN, "weight").count().collect()
            assert sorted(ready.groupBy(R.TARGET_COLUMN, "weight").count().collect()) == sorted(want)
            assert FP.feature_names(rows.prep(fold)) == FP.feature_names(prep)
        assert features(rows.held(2)) == features(prep.transform(train.filter("fold = 2")))


def test_one_look_for_all_models(split, monkeypatch):
    looks, fit = [], M.fit_preprocessing_of_sets
    monkeypatch.setattr(M, "fit_preprocessing_of_sets", lambda *a, **k: looks.append(1) or fit(*a, **k))
    results = M.train_all(split, list(ONE), ONE)
    assert len(looks) == 1 and [r["key"] for r in results] == list(ONE)
    assert all(r["scores"].count() == split.count() for r in results)


def test_no_folds_raise(split):
    with pytest.raises(ValueError, match="folds"):
        M.cross_validate(split.withColumn("fold", F.lit(None).cast("int")), "logistic_regression", [{"C": 1.0}])
