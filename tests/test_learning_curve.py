"""The learning curve: preprocessing of all training sets from one look, exact AUCs in one shuffle."""

import random

import pytest
from pyspark.sql import functions as F

from lendscope import roles as R
from lendscope.operators import evaluate as E
from lendscope.operators import models as M
from lendscope.operators import ordered as O
from lendscope.operators import prep as FP

ROLES = R.ColumnRoles(numeric=("a", "b", "flat"), nominal=("kind", "far"), ordinal=("grade",))


def rows(spark, n=900):
    rng, out = random.Random(3), []
    for i in range(n):
        a = rng.gauss(0, 1)
        out.append((i if i % 7 else i // 2, i % 4 if i % 50 else None, int(a + rng.gauss(0, 1) > 0.4),
                    None if i % 9 == 0 else round(a, 2), float(i % 3), 0.1, rng.choice("xyz"),
                    "rare" if i == 5 else rng.choice(["p", "q", None]), rng.choice(["A", "B", "Z", None])))
    return spark.createDataFrame(out, f"id long, fold int, {R.TARGET_COLUMN} int, a double, b double, flat double, "
                                      "kind string, far string, grade string")


def test_curve_equals_one_fit_after_another(spark, monkeypatch):
    df, sizes, k = rows(spark).persist(), (0.3, 1.0), 2                  # folds 2 and 3 only train, no fold: in no set
    base = M.with_label(df).withColumn("_u", (F.abs(F.xxhash64("id", F.lit(R.RANDOM_STATE))) % 1000000) / 1000000.0)
    want = {}
    for f in sizes:
        aucs = {"train": [], "validation": []}
        for fold in range(k):
            tr, te = base.filter((F.col("fold") != fold) & (F.col("_u") < f)), base.filter(F.col("fold") == fold)
            m = M.model_pipeline(M.logistic_classifier(1.0, "l2", tr.count()), ROLES).fit(tr.coalesce(1))
            for part, d in (("train", tr), ("validation", te)):
                s = M.predict_probability(m, d).withColumn("y", F.col(M.LABEL).cast("int"))
                aucs[part].append(E.rank_metrics(s).first().roc_auc)
        want |= {(f, part): sum(v) / k for part, v in aucs.items()}

    def fit(self, df):
        raise AssertionError("medians are ranked set by set")

    monkeypatch.setattr(FP.ExactMedianImputer, "_fit", fit)
    got = {(r.size, r.part): r.mean_roc_auc
           for r in M.learning_curve(df, "logistic_regression", {"C": 1.0}, sizes, k=k, roles=ROLES).collect()}
    assert got == {at: pytest.approx(v, abs=1e-9) for at, v in want.items()}


@pytest.mark.parametrize("value", ["id * 7919 % 20011 * 0.1", "id % 3", "if(id % 2 = 0, null, id)", "if(id % 3 = 0, double('nan'), id)",
                                   "if(c = 1, id, id + 100000)", "cast(null as double)"])
def test_medians_of_sets(spark, value):
    df = spark.range(20000).withColumn("c", (F.xxhash64("id") % 4)).withColumn("c", F.abs("c")).withColumn("v", F.expr(value))
    sets = {"one": [1], "some": [0, 2], "all": [0, 1, 2, 3], "none": []}    # the fifth: a set far from the others
    got = O.set_medians(df, ["v"], "c", sets)
    for name, cells in sets.items():
        want = df.filter(F.col("c").isin(cells) & ~F.isnan(F.col("v").cast("double"))).agg(F.median("v")).first()[0] if cells else None
        assert got.get((name, "v")) == want


def test_auc_of_many_keys_with_ties_and_one_class(spark):
    rng = random.Random(5)
    data = [(key, int(rng.random() < 0.3) if key else 1, 0.5 if key == 2 else round(rng.random(), 1 + key))
            for key in range(5) for _ in range(400)]
    df = spark.createDataFrame(data, "key int, y int, p double").repartition(4)
    want = {r.key: r.roc_auc for r in E.rank_metrics(df, keys=["key"]).collect()}
    got = {r.key: r.roc_auc for r in E.auc_of_many(E.tied_scores(df, "key"), "key", len(data)).collect()}
    assert got == {k: v if v is None else pytest.approx(v, abs=1e-12) for k, v in want.items()} and got[0] is None
