"""Order statistics cut into many partitions; results must equal brute force
whatever the partition count."""

import math

import numpy as np
import pytest

from lendscope.operators import evaluate as E
from lendscope.operators import ordered
from lendscope.operators import prep as FP
from lendscope.plans.inputs import loans
from tests.conftest import SF
from tests.test_evaluate_tests_policy import _ap_brute, _auc_brute, _yp


@pytest.fixture(params=["1", "5", "23"])
def parts(spark, request):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", old)


def test_rank_metrics(spark, parts):
    rng = np.random.default_rng(11)
    ys = [int(v) for v in rng.integers(0, 2, 500)]
    ps = [float(v) for v in np.round(rng.random(500), 2)]
    ps[:150] = [0.5] * 150  # a hot score holding 30% of rows
    r = E.rank_metrics(_yp(spark, ys, ps), "y", "p").first()
    assert math.isclose(r.roc_auc, _auc_brute(ys, ps), rel_tol=1e-12)
    assert math.isclose(r.average_precision, _ap_brute(ys, ps), rel_tol=1e-12)


def test_quantiles(spark, parts):
    rng = np.random.default_rng(2)
    vals = [float(v) for v in rng.normal(0, 1, 400)] + [1.0] * 200
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = {round(r["prob"], 6): r["value"] for r in ordered.exact_quantiles(df, ["x"], [0.1, 0.5, 0.9]).collect()}
    for p in (0.1, 0.5, 0.9):
        assert math.isclose(got[p], float(np.quantile(vals, p)), rel_tol=1e-12)


def test_null_keys_and_totals(spark, parts):
    rows = [(None, 1.0), (None, 1.0), (None, 3.0), ("a", 2.0), ("a", 2.0), ("a", 5.0), ("b", 7.0)]
    out = ordered.ordered_counts(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", totals=True).collect()
    assert sorted((str(r.k), r.v, r.c, r.c_before, r.c_total) for r in out) == [
        ("None", 1.0, 2, 0, 3), ("None", 3.0, 1, 2, 3), ("a", 2.0, 2, 0, 3), ("a", 5.0, 1, 2, 3), ("b", 7.0, 1, 0, 1)]


def test_split_and_folds(spark, parts):
    df = loans(spark, SF)
    counts = {r[0]: r[1] for r in df.groupBy("default_flag").count().collect()}
    s = FP.stratified_split(df)
    got = {(r.split, r.default_flag): r["count"] for r in s.groupBy("split", "default_flag").count().collect()}
    for k, (t, v, tr) in FP.split_quotas(counts).items():
        assert (got.get(("test", k), 0), got.get(("val", k), 0), got.get(("train", k), 0)) == (t, v, tr)
    assert s.select("id").distinct().count() == s.count() == df.count()      # every row in exactly one split
    f = FP.stratified_folds(df, 5).groupBy("fold", "default_flag").count().collect()
    per = {}
    for r in f:
        per.setdefault(r.default_flag, []).append(r["count"])
    assert all(max(v) - min(v) <= 1 for v in per.values())


def test_folds_of_repeated_ids_do_not_depend_on_partitions(spark):
    rows = [(i % 13, i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, default_flag int")
    seen = set()
    for n in (1, 3, 8):
        folds = FP.stratified_folds(df.repartition(n), 4).collect()
        assert len(folds) == len(rows)
        seen.add(tuple(sorted((r.id, r.default_flag, r.fold) for r in folds)))
        by_id = {}
        for r in folds:
            by_id.setdefault((r.id, r.default_flag), set()).add(r.fold)
        assert all(len(v) == 1 for v in by_id.values())
    assert len(seen) == 1
