import os

import pytest
from pyspark.sql import functions as F

from lendscope.operators import policy as P
from lendscope.plans.inputs import loans
from lendscope.plans.segmentation import SegmentationEngine
from lendscope.sources import files as IO
from lendscope.sources.tables import loan_book
from tests.conftest import SF


def test_raw_csv_guards(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        IO.load_raw_data(spark, str(tmp_path / "missing.csv"))
    empty = tmp_path / "empty.csv"
    empty.write_text(",".join(f.name for f in IO.RAW_LOAN_SCHEMA.fields) + "\n")
    with pytest.raises(ValueError):
        IO.load_raw_data(spark, str(empty))
    ok = tmp_path / "ok.csv"
    ok.write_text(",".join(f.name for f in IO.RAW_LOAN_SCHEMA.fields) + "\n" +
                  ",".join(["1", "2", "1000", " 36 months", "13.5%"] + [""] * (len(IO.RAW_LOAN_SCHEMA.fields) - 5)) + "\n")
    df = IO.load_raw_data(spark, str(ok))
    assert df.count() == 1 and df.first().int_rate == "13.5%"


def test_split_roundtrip_prunes_partitions(spark, tmp_path):
    from lendscope.operators.prep import stratified_split
    df = stratified_split(loans(spark, SF))
    IO.save_splits(df, str(tmp_path / "splits"))
    test = IO.load_split(spark, str(tmp_path / "splits"), "test")
    assert test.count() == df.filter(F.col("split") == "test").count()
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "split" in plan


def test_streaming_scoring_matches_batch(spark, tmp_path):
    from lendscope.streaming.scoring import score_stream
    raw = loan_book(spark, SF)
    src = str(tmp_path / "src")
    raw.write.parquet(src)

    def score(d):
        return d.withColumn("p", ((F.col("id") * 48271) % 1000) / 1000.0 * 0.6 + F.col("default_flag") * 0.2)
    score_stream(spark, src, raw.schema, str(tmp_path / "sink"), score, name="t-stream")
    got = spark.read.parquet(str(tmp_path / "sink"))
    batch = P.score_loans(score(loans(spark, SF)))
    assert got.count() == batch.count()
    assert got.select("id", "risk_tier").exceptAll(batch.select("id", "risk_tier")).count() == 0


def test_winsorize_job_roundtrip(spark, tmp_path):
    from lendscope.operators.clean import fit_bounds
    src, dst = str(tmp_path / "clean"), str(tmp_path / "wins")
    loans(spark, SF).write.parquet(src)
    IO.winsorize_job(spark, src, dst, ["annual_inc", "revol_bal"], k=1.5)
    out = spark.read.parquet(dst)
    b = fit_bounds(spark.read.parquet(src), ["annual_inc", "revol_bal"], 1.5).bounds
    r = out.agg(F.min("revol_bal"), F.max("revol_bal")).first()
    assert b["revol_bal"][0] <= r[0] and r[1] <= b["revol_bal"][1]
    assert out.count() == spark.read.parquet(src).count()


def test_training_job_writes_artifacts(spark, tmp_path):
    from lendscope.plans.training import run_training
    out = run_training(loan_book(spark, SF), out_dir=str(tmp_path / "run"), models=("logistic_regression",),
                       candidates={"logistic_regression": [{"C": 1.0, "penalty": "l2"}]})
    assert out["comparison"].count() == 1 and out["production_model"] in ("logistic_regression", "gradient_boosting")
    version = out["version"]
    assert version.table("comparison", "logistic_regression").count() == 1
    assert version.notes["models"]["logistic_regression"]["params"] == {"C": 1.0, "penalty": "l2"}
    assert {"metrics", "cv_folds", "cv_summary", "scores", "importances", "splits"} <= set(version.tables)
    assert version.table("scores").count() == out["data"].count()
    model = version.model("logistic_regression")
    from lendscope.operators.models import predict_probability
    assert predict_probability(model, out["data"].limit(3)).count() == 3


def test_single_row_scoring_guard(spark):
    two = spark.createDataFrame([(1, 0.1), (2, 0.2)], "id long, p double")
    with pytest.raises(ValueError):
        P.score_single(two)
    assert P.score_single(two.limit(1)).count() == 1


def test_segmentation_engine(spark, tmp_path):
    df = loans(spark, SF)
    eng = SegmentationEngine(n_clusters=3, restarts=2).fit(df)
    a = eng.assign_segment(df)
    assert a.count() == df.count() and a.filter(F.col("segment_name").isNull()).count() == 0
    assert eng.predict_cluster(df.limit(5)).count() == 5
    eng.save(str(tmp_path / "seg"))
    back = SegmentationEngine.load(spark, str(tmp_path / "seg"))
    assert back.state["profile"].count() == 3 and back.state["k"] == 3 and back.algorithm == "kmeans"
    rows = lambda d: sorted(map(tuple, d.select("id", "cluster").collect()))
    assert rows(back.predict_cluster(df)) == rows(eng.predict_cluster(df))
    named = lambda d: sorted(map(tuple, d.select("id", "cluster_id", "segment_name").collect()))
    assert named(back.assign_segment(df)) == named(a)
    with pytest.raises(RuntimeError):
        SegmentationEngine().save(str(tmp_path / "seg"))
    with pytest.raises(RuntimeError):
        SegmentationEngine().predict_cluster(df)
    h = SegmentationEngine(n_clusters=3, algorithm="hierarchical").fit(df)
    with pytest.raises(NotImplementedError):
        h.predict_cluster(df)
    assert h.assign_segment(df.limit(5)).count() == 5


def test_restored_engines_of_every_algorithm(spark, tmp_path):
    df = loans(spark, SF)
    for algorithm in ("gmm", "bisecting", "hierarchical"):
        eng = SegmentationEngine(n_clusters=3, algorithm=algorithm).fit(df)
        root = str(tmp_path / algorithm)
        assert eng.save(root) == 1 and eng.save(root) == 2
        back = SegmentationEngine.load(spark, root, version=1)
        assert (back.algorithm, back.n_clusters) == (algorithm, 3)
        rows = lambda d: sorted(map(tuple, d.select("id", "cluster_id").collect()))
        assert rows(back.assign_segment(df)) == rows(eng.assign_segment(df))
        if algorithm == "hierarchical":
            with pytest.raises(NotImplementedError):
                back.predict_cluster(df)
        else:
            same = lambda d: sorted(map(tuple, d.select("id", "cluster").collect()))
            assert same(back.predict_cluster(df)) == same(eng.predict_cluster(df))


def test_artifact_store_versions(spark, tmp_path):
    from lendscope.sources.artifacts import ArtifactStore
    store = ArtifactStore(spark, str(tmp_path / "store"))
    with pytest.raises(FileNotFoundError):
        store.latest()
    make = lambda n: spark.createDataFrame([(m, i) for m in ("a", "b") for i in range(n)], "model string, x int")
    with store.draft() as d:
        d.table("metrics", make(3))
        d.table("plain", spark.range(4))
        d.notes = {"k": 1}
    first = store.latest()
    assert first.number == 1 and first.notes == {"k": 1}
    assert sorted(map(tuple, first.table("metrics").collect())) == sorted(map(tuple, make(3).collect()))
    one = first.table("metrics", "a")
    assert one.count() == 3 and "PartitionFilters: [isnotnull(model" in one._jdf.queryExecution().toString()
    with pytest.raises(Exception):                       # the write dies half-way: the old version stays
        with store.draft() as d:
            d.table("metrics", make(9))
            d.table("plain", spark.range(4).selectExpr("raise_error('disk full') AS id"))
    assert store.versions() == [1] and store.latest().table("metrics").count() == 6
    with store.draft() as d:
        d.table("metrics", make(5))
    assert store.versions() == [1, 2] and store.latest().table("metrics").count() == 10
    assert first.table("metrics").count() == 6 and store.version(1).table("plain").count() == 4
    with pytest.raises(KeyError):
        store.latest().table("plain")
    with pytest.raises(KeyError):
        store.latest().model("none")
    with pytest.raises(FileNotFoundError):
        store.version(7)
