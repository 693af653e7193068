"""Default models, tuning, calibration and model comparison.

Models are MLlib estimators inside a ``Pipeline`` with the preprocessing of
``prep`` (refit inside every CV fold).  Cross-validation is our own loop so
that every fold's predictions are kept: each fold's are written once, with
``(candidate, fold)`` keys, and scored by ONE distributed job with the
exact ROC-AUC of ``evaluate.rank_metrics`` (MLlib's evaluator bins scores and
only reports fold averages).
"""

from __future__ import annotations

import math
import random
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from threading import BoundedSemaphore, Lock
from typing import Callable, Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope import roles as R
from lendscope.operators import evaluate as E
from lendscope.operators.isotonic import IsotonicCurve, fit_isotonic
from lendscope.operators.prep import (build_preprocessing_pipeline, class_weights, fit_preprocessing_of_sets,
                                      scale_pos_weight)
from lendscope.operators.staged import staged_scores, tree_groups
from lendscope.session import ROWS_PER_TASK, TASKS_PER_SLOT, right_size, written

LABEL = "_label"

# ---------------------------------------------------------------------------
# Fixed values (search spaces; must stay exactly as listed)
# ---------------------------------------------------------------------------
LOGISTIC_GRID = {"C": [0.001, 0.01, 0.1, 1.0, 10.0, 100.0], "penalty": ["l1", "l2"],
                 "class_weight": [None, "balanced"]}
FOREST_SPACE = {"n_estimators": [200, 300, 400, 500], "max_depth": [4, 6, 8, 10, 12, 16, None],
                "min_samples_split": [2, 5, 10, 20], "min_samples_leaf": [1, 2, 4, 8],
                "max_features": ["sqrt", "log2", 0.5], "class_weight": [None, "balanced", "balanced_subsample"]}
FOREST_N_ITER = 20
BOOST_SPACE = {"n_estimators": [150, 250, 350, 450, 600], "max_depth": [3, 4, 5, 6, 8],
               "learning_rate": [0.01, 0.03, 0.05, 0.1, 0.2], "subsample": [0.6, 0.7, 0.8, 0.9, 1.0],
               "colsample_bytree": [0.6, 0.7, 0.8, 0.9, 1.0], "min_child_weight": [1, 3, 5, 7],
               "gamma": [0, 0.1, 0.3, 0.5]}
BOOST_N_ITER = 30
MODEL_ATTRIBUTES = {
    "logistic_regression": ("High", "Low"),
    "random_forest": ("Medium", "Medium"),
    "gradient_boosting": ("Low", "High"),
}
MODEL_KEY_OF_NAME = {"Logistic Regression": "logistic_regression", "Random Forest": "random_forest",
                     "XGBoost": "gradient_boosting", "Gradient Boosting": "gradient_boosting",
                     "xgboost": "gradient_boosting"}
MAX_TREE_DEPTH = 30  # MLlib's limit stands in for "unlimited"
# ---------------------------------------------------------------------------


def with_label(df: DataFrame, target: str = R.TARGET_COLUMN) -> DataFrame:
    return df.withColumn(LABEL, F.col(target).cast("double"))


# M1 / M2 / M3 ---------------------------------------------------------------
def logistic_classifier(C: float = 1.0, penalty: str = "l2", n_rows: int = 1, weighted: bool = False,
                        max_iter: int = 2000) -> LogisticRegression:
    """sklearn's C maps to regParam = 1 / (C n); L1 -> elasticNet 1, L2 -> 0."""
    lr = LogisticRegression(featuresCol="features", labelCol=LABEL, regParam=1.0 / (C * max(n_rows, 1)),
                            elasticNetParam=1.0 if penalty == "l1" else 0.0, standardization=False,
                            maxIter=max_iter, tol=1e-4)  # liblinear's default tolerance
    if weighted:
        lr.setWeightCol("weight")
    return lr


def forest_classifier(n_estimators=300, max_depth=None, min_samples_leaf=1, max_features="sqrt",
                      min_samples_split=2, weighted=False, seed=R.RANDOM_STATE) -> RandomForestClassifier:
    """MLlib has no bound on the rows of a node that is split; a node of fewer
    than ``min_samples_split`` rows cannot give two children of half as many,
    so that half, rounded up, raises the bound on a child's rows."""
    fs = {"sqrt": "sqrt", "log2": "log2"}.get(max_features, str(max_features))
    rf = RandomForestClassifier(featuresCol="features", labelCol=LABEL, numTrees=int(n_estimators),
                                maxDepth=min(int(max_depth), MAX_TREE_DEPTH) if max_depth else MAX_TREE_DEPTH,
                                minInstancesPerNode=max(int(min_samples_leaf), -(-int(min_samples_split) // 2)),
                                featureSubsetStrategy=fs, seed=seed)
    if weighted:
        rf.setWeightCol("weight")
    return rf


def boosted_classifier(n_estimators=250, max_depth=4, learning_rate=0.1, subsample=1.0, colsample_bytree=1.0,
                       min_child_weight=1, gamma=0.0, weighted=False, seed=R.RANDOM_STATE, **_) -> GBTClassifier:
    gb = GBTClassifier(featuresCol="features", labelCol=LABEL, maxIter=int(n_estimators), maxDepth=int(max_depth),
                       stepSize=float(learning_rate), subsamplingRate=float(subsample),
                       featureSubsetStrategy=str(float(colsample_bytree)) if colsample_bytree < 1 else "all",
                       minInstancesPerNode=int(min_child_weight), minInfoGain=float(gamma), seed=seed)
    if weighted:
        gb.setWeightCol("weight")
    return gb


def model_pipeline(classifier, roles: R.ColumnRoles = R.LOAN_ROLES) -> Pipeline:
    prep = build_preprocessing_pipeline(roles)
    return Pipeline(stages=list(prep.getStages()) + [classifier])


def make_estimator(key: str, params: dict, n_rows: int) -> Pipeline:
    """Preprocessing + classifier pipeline for one model key and parameter map."""
    return model_pipeline(make_classifier(key, params, n_rows))


def make_classifier(key: str, params: dict, n_rows: int):
    """M7 dispatch; unknown key raises."""
    weighted = params.get("class_weight") in ("balanced", "balanced_subsample")
    if key == "logistic_regression":
        clf = logistic_classifier(params.get("C", 1.0), params.get("penalty", "l2"), n_rows, weighted)
    elif key == "random_forest":
        clf = forest_classifier(weighted=weighted, **{k: v for k, v in params.items() if k != "class_weight"})
    elif key in ("gradient_boosting", "xgboost"):
        clf = boosted_classifier(weighted=weighted, **{k: v for k, v in params.items() if k != "scale_pos_weight"})
        if params.get("scale_pos_weight", 1) != 1:
            clf.setWeightCol("weight")
    else:
        raise ValueError(f"Unknown model key '{key}'.")
    return clf


# P1
def positive_probability(scored: DataFrame, out: str = "p") -> DataFrame:
    return scored.withColumn(out, vector_to_array("probability")[1])


def predict_probability(model: PipelineModel, df: DataFrame, out: str = "p") -> DataFrame:
    """Empty in -> empty out; NULLs imputed; unknown categories -> zeros; extra
    columns ignored; a missing input column raises (Spark analysis error)."""
    return positive_probability(model.transform(df), out)


# M4 / M5 / M8 ---------------------------------------------------------------
def grid(space: dict) -> list:
    maps = [{}]
    for k, vals in space.items():
        maps = [dict(m, **{k: v}) for m in maps for v in vals]
    return maps


def random_draws(space: dict, n_iter: int, seed: int = R.RANDOM_STATE) -> list:
    rng = random.Random(seed)
    return [{k: rng.choice(v) for k, v in space.items()} for _ in range(n_iter)]


def weight_mode(params: dict) -> str | None:
    """How a candidate weighs its training rows (see ``prep.class_weights``)."""
    if params.get("scale_pos_weight", 1) != 1:
        return "scale_pos"
    return "balanced" if params.get("class_weight") else None


def _score_logistic(models: dict, rows: DataFrame) -> DataFrame:
    """(candidate, y, p) of every row under all logistic models in one pass:
    the coefficient vectors ride along as literals (#candidates x #features)."""
    each = F.explode(F.array(*[F.struct(F.lit(ci).alias("candidate"), F.lit(float(m.intercept)).alias("b"),
                                        F.lit(m.coefficients.toArray().tolist()).alias("w")) for ci, m in models.items()]))
    flat = rows.select(F.col(LABEL).cast("int").alias("y"), vector_to_array("features").alias("x"), each.alias("m"))
    dot = F.aggregate(F.zip_with("x", "m.w", lambda a, w: a * w), F.lit(0.0), lambda s, v: s + v)
    return flat.select("m.candidate", "y", (1.0 / (1.0 + F.exp(-(dot + F.col("m.b"))))).alias("p"))


def _places(sizes: dict):
    """The candidates with a row's number of trees."""
    return F.create_map(*[x for n, at in sizes.items()
                          for x in (F.lit(n), F.array(*[F.lit(i) for i in at]))])[F.col("n_trees")]


class TrainingRows:
    """The rows that models are trained on, with the preprocessing of every fold's
    training set (all rows but the fold's) and of the whole (fold None).  All sets
    are fitted from one look at the folds, at first use, and a set's features are
    made and kept once, whatever the number of models that share them."""

    def __init__(self, rows: Callable[[], DataFrame], fold_col: str = "fold", target: str = R.TARGET_COLUMN):
        self._rows, self._fold, self._target = rows, fold_col, target
        self._lock, self._base, self._kept = Lock(), None, {}

    def _look(self) -> None:
        with self._lock:
            if self._base is not None:
                return
            cell = F.coalesce(F.col(self._fold).cast("long"), F.lit(-1)).alias("_cell")     # -1: in no fold
            base = (with_label(self._rows(), self._target).select(*R.LOAN_ROLES.features, LABEL, self._target, cell)
                    .persist(StorageLevel.MEMORY_AND_DISK))
            self.counts = {(r[0], r[1]): r[2] for r in base.groupBy("_cell", self._target).count().collect()}
            cells = {c for c, _ in self.counts}
            self.folds = sorted(c for c in cells if c >= 0)
            self.preps, _ = fit_preprocessing_of_sets(base, "_cell", {
                None: cells, **{f: [c for c in self.folds if c != f] for f in self.folds}})
            self._base = base

    def __enter__(self) -> "TrainingRows":
        return self

    def __exit__(self, *_) -> None:
        with self._lock:
            for df in [*self._kept.values(), *([self._base] if self._base is not None else [])]:
                df.unpersist()
            self._base, self._kept = None, {}

    def names(self) -> list:
        """The folds that hold rows."""
        self._look()
        return self.folds

    def prep(self, fold=None) -> PipelineModel:
        self._look()
        return self.preps[fold]

    def _ready(self, fold) -> DataFrame:
        self._look()
        with self._lock:
            if fold not in self._kept:
                self._kept[fold] = (self.preps[fold].transform(self._base).select("features", LABEL, self._target, "_cell")
                                    .persist(StorageLevel.MEMORY_AND_DISK))
            return self._kept[fold]

    def train(self, fold=None, mode: str | None = None) -> tuple[DataFrame, int]:
        """(features, label and weight of a training set's rows, their number)."""
        ready, counts = self._ready(fold), {}
        for (cell, y), n in self.counts.items():
            if fold is None or cell not in (fold, -1):
                counts[y] = counts.get(y, 0) + n
        if fold is not None:
            ready = ready.filter((F.col("_cell") != fold) & (F.col("_cell") >= 0))
        n = sum(counts.values())
        return right_size(class_weights(ready.drop("_cell"), self._target, mode or "none", counts=counts), n), n

    def held(self, fold) -> DataFrame:
        """Features and label of the fold's own rows."""
        n = sum(n for (cell, _), n in self.counts.items() if cell == fold)
        return right_size(self._ready(fold).filter(F.col("_cell") == fold).select("features", LABEL), n)


def cross_validate(df: DataFrame, key: str, candidates: Sequence[dict], fold_col: str = "fold",
                   k: int = R.CV_FOLDS, parallelism: int | None = None, target: str = R.TARGET_COLUMN,
                   shared: TrainingRows | None = None) -> tuple:
    """Score every (candidate, fold) pair.  Preprocessing and class weights are
    refit on each fold's training rows (weights by the candidate's own mode);
    tree candidates that differ only in ``n_estimators`` share one fit, whose
    prefixes they are; a fold's held-out scores are written once for all its
    candidates.  ``shared``: the rows of ``df``, where other models use them too.
    Returns (per-fold table, summary table sorted by mean AUC)."""
    if shared is None:
        with TrainingRows(lambda: df, fold_col, target) as own:
            return cross_validate(df, key, candidates, fold_col, k, parallelism, target, own)
    # candidates that differ only in their number of trees are prefixes of one fit
    groups = [(c, None) for c in candidates] if key == "logistic_regression" else tree_groups(candidates)
    workers = parallelism or max(4, min(16, df.sparkSession.sparkContext.defaultParallelism))
    slots = BoundedSemaphore(workers)      # fits at a time, of all folds together
    if not shared.names():
        raise ValueError("cross-validation needs rows in folds")

    def score(fold) -> DataFrame:
        def fit(params):
            train, n = shared.train(fold, weight_mode(params))
            with slots:
                return make_classifier(key, params, n).fit(train)

        with ThreadPoolExecutor(max_workers=workers) as ex:  # concurrent MLlib fits, as CrossValidator
            fits = list(ex.map(fit, [params for params, _ in groups]))
        held = shared.held(fold)
        if key == "logistic_regression":
            rows = _score_logistic(dict(enumerate(fits)), held)
        else:
            truth = held.withColumn("y", F.col(LABEL).cast("int"))
            rows = reduce(DataFrame.unionByName, [
                staged_scores(m, truth, list(sizes), keep=["y"])
                .withColumn("candidate", F.explode(_places(sizes))).select("candidate", "y", "p")
                for m, (_, sizes) in zip(fits, groups)])
        return written(rows.withColumn("fold", F.lit(fold).cast("int")), "cv-scores")

    with ThreadPoolExecutor(max_workers=workers) as ex:  # a fold's small jobs leave most of the cluster to the others
        scored = reduce(DataFrame.unionByName, ex.map(score, shared.names()))
    folds = written(E.rank_metrics(scored, "y", "p", keys=["candidate", "fold"]).select("candidate", "fold", "roc_auc"),
                    "cv-folds")
    summ = (folds.groupBy("candidate").agg(F.avg("roc_auc").alias("cv_roc_auc_mean"),
                                           F.stddev_pop("roc_auc").alias("cv_roc_auc_std"))
            .orderBy(F.desc("cv_roc_auc_mean"), "candidate"))
    return folds, summ


def boost_space(df: DataFrame, target: str = R.TARGET_COLUMN) -> dict:
    """``BOOST_SPACE`` with the axis that depends on the labels: the positive
    class weighted 1 or by the ratio of the classes."""
    ratio = scale_pos_weight(df, target).first()["scale_pos_weight"]
    return {**BOOST_SPACE, "scale_pos_weight": [1.0, float(ratio)]}


def tune_model(df: DataFrame, key: str, fold_col: str = "fold", search: str = "grid", n_iter: int | None = None,
               parallelism: int | None = None, seed: int = R.RANDOM_STATE, candidates: Sequence[dict] | None = None,
               shared: TrainingRows | None = None) -> dict:
    """M7 dispatch of the reference searches: exhaustive logistic grid,
    randomised forest / boosting draws.  Returns best params + tables."""
    if candidates is None:
        if key == "logistic_regression":
            candidates = grid(LOGISTIC_GRID)
        elif key == "random_forest":
            candidates = random_draws(FOREST_SPACE, n_iter or FOREST_N_ITER, seed)
        elif key in ("gradient_boosting", "xgboost"):
            candidates = random_draws(boost_space(df), n_iter or BOOST_N_ITER, seed)
        else:
            raise ValueError(f"Unknown model key '{key}'.")
    folds, summ = cross_validate(df, key, candidates, fold_col, parallelism=parallelism, shared=shared)
    best = summ.first()
    return {"key": key, "best_index": best["candidate"], "best_params": candidates[best["candidate"]],
            "cv_mean": best["cv_roc_auc_mean"], "cv_std": best["cv_roc_auc_std"],
            "folds": folds.filter(F.col("candidate") == best["candidate"]), "summary": summ,
            "candidates": candidates}


# M9 -------------------------------------------------------------------------
def platt_calibrator(val_scored: DataFrame, score: str = "raw_score", y: str = "y"):
    """Platt scaling with smoothed targets (n+ + 1)/(n+ + 2) and 1/(n- + 2):
    every row enters twice (label 1 and 0) with the target and its complement
    as weights, so MLlib's logistic regression fits the soft targets.  No rows raise."""
    c = {r[0]: r[1] for r in val_scored.groupBy(y).count().collect()}
    if not c:
        raise ValueError("Platt scaling needs validation rows")
    npos, nneg = c.get(1, 0), c.get(0, 0)
    tp, tn = (npos + 1.0) / (npos + 2.0), 1.0 / (nneg + 2.0)
    t = F.when(F.col(y) == 1, F.lit(tp)).otherwise(F.lit(tn))
    rows = val_scored.select(F.col(score).cast("double").alias("_s"), t.alias("_t"))
    soft = rows.select("_s", F.explode(F.array(F.struct(F.lit(1.0).alias(LABEL), F.col("_t").alias("w")),
                                               F.struct(F.lit(0.0).alias(LABEL), (1 - F.col("_t")).alias("w"))))
                       .alias("r")).select("_s", "r.*")
    va = VectorAssembler(inputCols=["_s"], outputCol="features")
    lr = LogisticRegression(featuresCol="features", labelCol=LABEL, weightCol="w", regParam=0.0,
                            standardization=False, maxIter=200)
    m = lr.fit(va.transform(soft))
    return float(m.coefficients[0]), float(m.intercept)


def apply_platt(df: DataFrame, a: float, b: float, score: str = "raw_score", out: str = "p") -> DataFrame:
    return df.withColumn(out, 1.0 / (1.0 + F.exp(-(F.lit(a) * F.col(score) + F.lit(b)))))


def isotonic_calibrator(val_scored: DataFrame, score: str = "raw_score", y: str = "y") -> IsotonicCurve:
    return fit_isotonic(val_scored, score, y)


def raw_score(model: PipelineModel, df: DataFrame, key: str) -> DataFrame:
    """Calibration input: the margin for logistic models, probability for trees."""
    t = model.transform(df)
    if key == "logistic_regression":
        return t.withColumn("raw_score", vector_to_array("rawPrediction")[1])
    return t.withColumn("raw_score", vector_to_array("probability")[1])


# M10 / M11 / M12 / M13 / M16 -----------------------------------------------
def evaluate_splits(scored: DataFrame, y: str = "y", p: str = "p", split: str = "split",
                    threshold: float = 0.5) -> DataFrame:
    """Metric suite at 0.5 for every split in one job (keys = split)."""
    return E.classification_metrics(scored, y, p, threshold, keys=[split])


def train_and_evaluate(df_split: DataFrame, key: str, fold_col: str = "fold", calibrate: str | None = "sigmoid",
                       parallelism: int | None = None, candidates: Sequence[dict] | None = None, n_iter: int | None = None,
                       shared: TrainingRows | None = None) -> dict:
    """Tune on train (CV) -> refit on train -> threshold on val -> calibrate
    on val (frozen base) -> metrics on every split.  Test never tunes anything.
    A calibration that fails raises: raw scores never stand in for calibrated ones.
    ``shared``: the training rows of ``df_split``, where other models use them too."""
    train = df_split.filter(F.col("split") == "train")
    if shared is None:
        with TrainingRows(lambda: train, fold_col) as own:
            return train_and_evaluate(df_split, key, fold_col, calibrate, parallelism, candidates, n_iter, own)
    tuned = tune_model(train, key, fold_col, n_iter=n_iter, parallelism=parallelism, candidates=candidates, shared=shared)
    params = tuned["best_params"]
    ready, n_train = shared.train(None, weight_mode(params))
    model = PipelineModel([*shared.prep().stages, make_classifier(key, params, n_train).fit(ready)])
    scored = raw_score(model, with_label(df_split), key).withColumn("y", F.col(LABEL).cast("int"))
    # the model scores every row once: calibration, threshold and metrics read what is written
    scored = written(positive_probability(scored, "p_raw").select("id", "split", "y", "raw_score", "p_raw"), "raw-scores")
    cal = None
    if calibrate == "sigmoid":
        a, b = platt_calibrator(scored.filter(F.col("split") == "val"))
        scored = apply_platt(scored, a, b)
        cal = ("sigmoid", a, b)
    elif calibrate == "isotonic":
        iso = isotonic_calibrator(scored.filter(F.col("split") == "val"))
        scored = scored.withColumn("p", iso.apply(F.col("raw_score")))
        cal = ("isotonic", iso.scores, iso.values)
    else:
        scored = scored.withColumn("p", F.col("p_raw"))
    keep = scored.select("id", "split", "y", "p", "p_raw")
    thr = E.recommend_threshold(E.threshold_metrics_table(keep.filter(F.col("split") == "val"), "y", "p")).first()
    metrics = written(evaluate_splits(keep, "y", "p"), "split-metrics")       # one row per split, read by several tables
    return {"key": key, "model": model, "params": params, "tuning": tuned, "calibration": cal,
            "scores": keep, "threshold": thr["threshold"], "metrics": metrics}


def train_all(df_split: DataFrame, keys: Sequence[str], candidates: dict, fold_col: str = "fold", **options) -> list:
    """``train_and_evaluate`` of several model keys at a time, in their order, on
    the same training rows."""
    with TrainingRows(lambda: df_split.filter(F.col("split") == "train"), fold_col) as rows, \
            ThreadPoolExecutor(max_workers=max(1, len(keys))) as ex:
        return list(ex.map(lambda key: train_and_evaluate(df_split, key, fold_col=fold_col, candidates=candidates.get(key),
                                                          shared=rows, **options), keys))


def comparison_table(results: Sequence[dict]) -> DataFrame:
    """Test metrics + CV mean/std + attributes per model, ranked by ROC-AUC."""
    spark = results[0]["metrics"].sparkSession
    rows = None
    for r in results:
        m = r["metrics"].filter(F.col("split") == "test").drop("split")
        interp, complexity = MODEL_ATTRIBUTES.get(r["key"], ("", ""))
        m = m.select(F.lit(r["key"]).alias("model"), "*", F.lit(float(r["tuning"]["cv_mean"])).alias("cv_roc_auc_mean"),
                     F.lit(float(r["tuning"]["cv_std"] or 0.0)).alias("cv_roc_auc_std"),
                     F.lit(interp).alias("interpretability"), F.lit(complexity).alias("complexity"))
        rows = m if rows is None else rows.unionByName(m)
    # one row per model: the ranking window spans #models rows
    from pyspark.sql import Window
    return rows.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("roc_auc"), "model")))


def resolve_production_model_key(table: DataFrame | None, default_key: str = "gradient_boosting") -> str:
    """Key of the model of highest numeric roc_auc (first row on ties); display
    names map back to keys.  No table, a missing column, no number or an
    unknown name gives the default."""
    if table is None or not {"model", "roc_auc"} <= set(table.columns):
        return default_key
    rows = table.select("model", F.col("roc_auc").try_cast("double").alias("auc")).collect()  # #models rows
    best, best_auc = None, None
    for r in rows:
        a = r["auc"]
        if a is None or (isinstance(a, float) and math.isnan(a)):
            continue
        if best_auc is None or a > best_auc:
            best, best_auc = r["model"], a
    return {**{k: k for k in MODEL_ATTRIBUTES}, **MODEL_KEY_OF_NAME}.get(best, default_key)


def robustness_table(metrics: DataFrame, model: str | None = None) -> DataFrame:
    """train / val / test AUC side by side with the train-test gap."""
    p = metrics.groupBy(*([model] if model else [])).pivot("split", ["train", "val", "test"]).agg(F.first("roc_auc"))
    return p.withColumn("train_test_gap", F.col("train") - F.col("test"))


# M14 / M15 ------------------------------------------------------------------
def learning_curve(df: DataFrame, key: str, params: dict, sizes: Sequence[float] = (0.1, 0.25, 0.4, 0.55, 0.7, 0.85, 1.0),
                   fold_col: str = "fold", k: int = R.CV_FOLDS, seed: int = R.RANDOM_STATE,
                   roles: R.ColumnRoles = R.LOAN_ROLES) -> DataFrame:
    """Train on nested hash-fractions of the training folds, score the held-out
    fold; mean/std AUC per size (train and validation).

    A training set is a union of (fold, band between two sizes) cells, so the
    preprocessing of all #sizes x k sets comes from one look at the cells."""
    fracs = sorted({float(f) for f in sizes})
    u = (F.abs(F.xxhash64("id", F.lit(seed))) % 1000000) / 1000000.0
    band = reduce(lambda a, b: a + b, [F.when(F.col("_u") < f, 0).otherwise(1) for f in fracs])
    # the smallest size that holds a row; NULL: in no training set
    cell = F.when(F.col("_band") < len(fracs), F.col(fold_col).cast("long") * len(fracs) + F.col("_band"))
    base = (with_label(df).withColumn("_u", u).withColumn("_band", band).withColumn("_cell", cell)
            .select(*roles.features, LABEL, F.col(fold_col).alias("_fold"), "_band", "_cell",
                    *[c for c in df.columns if c == "weight"])
            .persist(StorageLevel.MEMORY_AND_DISK))
    in_fold = {r[0]: r[1] for r in base.groupBy("_fold").count().collect() if r[0] is not None}
    points = [(i, fold) for i in reversed(range(len(fracs))) for fold in range(k)]      # the longest fits first
    preps, rows = fit_preprocessing_of_sets(base, "_cell", {
        (i, fold): [f * len(fracs) + b for f in in_fold if f != fold for b in range(i + 1)] for i, fold in points}, roles)

    def point(at):
        i, fold = at
        n_tr = max(rows[at], 1)
        held = F.col("_fold") == fold
        ready = (preps[at].transform(base.filter(held | ((F.col("_fold") != fold) & (F.col("_band") <= i))))
                 .select("features", LABEL, held.alias("_held"), *[c for c in base.columns if c == "weight"]))
        m = make_classifier(key, params, n_tr).fit(right_size(ready.filter(~F.col("_held")), n_tr))
        scored = positive_probability(m.transform(right_size(ready, n_tr + in_fold.get(fold, 0))))
        curve = 2 * points.index(at) + F.col("_held").cast("int")
        return written(E.tied_scores(scored.withColumn("curve", curve), "curve", LABEL), "curve-scores")

    # independent fits, as in cross-validation; as many at a time as keep every slot at work
    slots = base.sparkSession.sparkContext.defaultParallelism
    each = max(1, sum(rows.values()) // max(1, len(rows)))
    workers = max(3, min(16, max(4, slots), 4 * TASKS_PER_SLOT * slots * ROWS_PER_TASK // each))
    with ThreadPoolExecutor(max_workers=workers) as ex:
        scores = reduce(DataFrame.unionByName, ex.map(point, points))
    base.unpersist()
    n_scores = sum(rows[i, fold] + in_fold.get(fold, 0) for i, fold in points)
    names = base.sparkSession.createDataFrame(
        [(2 * j + held, fracs[i], ("train", "validation")[held]) for j, (i, _) in enumerate(points) for held in (0, 1)],
        "curve int, size double, part string")                                           # two rows per fit
    a = E.auc_of_many(scores, "curve", n_scores).join(F.broadcast(names), "curve")
    return a.groupBy("size", "part").agg(F.avg("roc_auc").alias("mean_roc_auc"), F.stddev_pop("roc_auc").alias("std_roc_auc"))


def validation_curve(df: DataFrame, key: str, base_params: dict, param: str, values: Sequence,
                     fold_col: str = "fold") -> DataFrame:
    cands = [dict(base_params, **{param: v}) for v in values]
    _, summ = cross_validate(df, key, cands, fold_col)
    spark = df.sparkSession
    vals = spark.createDataFrame([(i, str(v)) for i, v in enumerate(values)], "candidate int, value string")
    return summ.join(vals, "candidate").withColumn("param", F.lit(param))
