"""Steps that many queries share: how often they read, shuffle and send."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from lendscope.operators import explain as X
from lendscope.operators import kmeans as K
from lendscope.operators import segments as G
from lendscope.plans import catalog_ml as C
from lendscope.session import right_size
from lendscope.sources.tables import loan_book
from tests.conftest import SF


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_line_items_are_shuffled_once(spark):
    text = plan(loan_book(spark, SF))
    assert "l_partkey" not in "".join(p.split("[plan_id")[0] for p in text.split("hashpartitioning(")[1:] for p in [p.split(")")[0]])


def test_split_reads_the_written_loans(spark):
    split = C.split_only(spark, SF)
    assert all("/loans-" in f for f in split.inputFiles())


def test_tasks_of_iterative_fits_do_not_grow_with_the_rows(spark):
    df = spark.range(0, 1000, 1, 200)
    assert right_size(df, 10 ** 9).rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.7, size=(40, 3)) for c in ([0, 0, 0], [4, 0, 1], [0, 5, 2])])
    rows = [(i % 115, i // 40, [float(v) for v in r]) for i, r in enumerate(x)]      # ids that repeat
    return spark.createDataFrame(rows, "row_id long, cluster int, v array<double>").select(
        "row_id", "cluster", array_to_vector("v").alias("features")).persist()


def test_indices_of_whole_vectors_equal_the_long_tables(labelled):
    ch, db = G.validity_indices(labelled, "features", "cluster", "row_id")
    long = G.to_long(labelled, "features")
    assert ch == pytest.approx(G.calinski_harabasz(long).first()[0])
    assert db == pytest.approx(G.davies_bouldin(long).first()[0])


def test_rows_are_packed_into_matrices(spark):
    v = spark.range(0, 5000, 1, 1).select(F.array(F.col("id").cast("double"), F.lit(1.0)).alias("v"))
    blocks = [np.frombuffer(r.x).reshape(-1, 2) for r in K.packed(v, 2).collect()]
    assert sorted(np.concatenate(blocks)[:, 0]) == list(range(5000)) and max(map(len, blocks)) <= K.ROWS_AT_ONCE


def test_row_ranks_of_a_permutation_are_taken_once(spark, monkeypatch):
    seen, counts = [], X.ordered_counts
    monkeypatch.setattr(X, "ordered_counts", lambda d, keys, value, **kw: seen.append((tuple(keys), value)) or counts(d, keys, value, **kw))

    class Model:
        def transform(self, df):
            z = F.col("a") + F.when(F.col("b") == "x", 1.0).otherwise(0.0)
            return df.withColumn("probability", array_to_vector(F.array(1 - z / 100, z / 100)))

    df = spark.createDataFrame([(i, i % 2, float(i % 7), "xy"[i % 2], "unused") for i in range(60)],
                               "id long, t int, a double, b string, other string")
    out = {r.feature: r for r in X.permutation_importance(Model(), df, ["a", "b"], repeats=3, target="t").collect()}
    assert seen[:2] == [((), "_src"), (("_feature", "_repeat"), "_ph")]
    assert set(out) == {"a", "b"} and out["b"].importance_mean < 0
