"""A calibration that fails ends the training; raw scores never pass for calibrated ones."""

import pytest
from pyspark.sql import functions as F

from lendscope.operators import models as M
from lendscope.plans import catalog_ml as C
from tests.conftest import SF

ONE = {"logistic_regression": [{"C": 1.0, "penalty": "l2"}]}


@pytest.fixture(scope="module")
def split(spark):
    return C.split_loans(spark, SF)


def test_failed_calibration_raises(split, monkeypatch):
    def lost(*_, **__):
        raise RuntimeError("lost executor")

    monkeypatch.setattr(M, "platt_calibrator", lost)
    with pytest.raises(RuntimeError, match="lost executor"):
        M.train_all(split, list(ONE), ONE)


def test_no_validation_rows_raise(split):
    with pytest.raises(ValueError, match="validation rows"):
        M.train_all(split.filter(F.col("split") != "val"), list(ONE), ONE)
