import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lendscope.operators import models as M
from lendscope.operators import policy as P
from lendscope.operators import prep as FP
from tests.test_prep_models_segments import _planted


@pytest.fixture(scope="module")
def model(spark):
    df = _planted(spark, 300)
    tr = M.with_label(df)
    return M.make_estimator("logistic_regression", {"C": 1.0, "penalty": "l2"}, 300).fit(tr), df


def _one(df):
    return df.limit(1).drop("default_flag", "_u")


def test_nulls_are_imputed(model):
    m, df = model
    row = _one(df).withColumn("annual_inc", F.lit(None).cast("double")).withColumn("dti", F.lit(None).cast("double"))
    p = M.predict_probability(m, row).first().p
    assert 0.0 <= p <= 1.0


def test_unknown_category_and_grade_tolerated(model):
    m, df = model
    row = _one(df).withColumn("purpose", F.lit("space_travel")).withColumn("grade", F.lit("Z"))
    assert 0.0 <= M.predict_probability(m, row).first().p <= 1.0


def test_extra_columns_ignored_and_missing_column_raises(model):
    m, df = model
    row = _one(df).withColumn("unrelated", F.lit("x"))
    assert M.predict_probability(m, row).count() == 1
    with pytest.raises(AnalysisException):
        M.predict_probability(m, _one(df).drop("dti")).collect()


def test_negative_values_and_empty_input(model):
    m, df = model
    row = _one(df).withColumn("annual_inc", F.lit(-5000.0)).withColumn("loan_amnt", F.lit(-1.0))
    assert 0.0 <= M.predict_probability(m, row).first().p <= 1.0
    assert P.score_loans(M.predict_probability(m, df.limit(0))).count() == 0


def test_feature_vector_matches_names(model):
    m, df = model
    from pyspark.ml import PipelineModel
    v = PipelineModel(stages=m.stages[:-1]).transform(df.limit(1)).select("features").first()[0]
    assert v.size == len(FP.feature_names(m))
