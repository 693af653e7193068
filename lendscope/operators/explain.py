"""Importance and attribution.

Linear attribution is a column expression per row (coefficient x deviation
from the background mean, margin space) emitted as a long
``(row_id, feature, contribution)`` table; local and global explanations are
grouped windows/aggregations over it.  Permutation importance of a linear model
exchanges a column's part of the margin on packed arrays; of any other model it
unions every (feature, repeat) permutation under keys and scores them in one AUC job.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendscope import roles as R
from lendscope.functions.text import humanize_feature_name, research_question
from lendscope.operators import evaluate as E
from lendscope.operators.ordered import ordered_counts
from lendscope.operators.prep import feature_names


def _classifier(model: PipelineModel):
    return model.stages[-1]


# X1
def coefficient_table(model: PipelineModel, roles: R.ColumnRoles = R.LOAN_ROLES) -> DataFrame:
    clf = _classifier(model)
    names = feature_names(model, roles)
    coefs = list(clf.coefficients.toArray())
    rows = [(n, float(c), math.exp(c)) for n, c in zip(names, coefs)]
    from pyspark.sql import SparkSession
    s = SparkSession.getActiveSession()
    df = s.createDataFrame(rows, "feature string, coefficient double, odds_ratio double")
    return df.withColumn("abs_coefficient", F.abs("coefficient")).orderBy(F.desc("abs_coefficient"))


# X2
def impurity_importance(model: PipelineModel, roles: R.ColumnRoles = R.LOAN_ROLES) -> DataFrame:
    clf = _classifier(model)
    names = feature_names(model, roles)
    imp = list(clf.featureImportances.toArray())
    from pyspark.sql import SparkSession
    s = SparkSession.getActiveSession()
    return s.createDataFrame([(n, float(v)) for n, v in zip(names, imp)], "feature string, importance double") \
        .orderBy(F.desc("importance"))


# X4
def permutation_importance(model: PipelineModel, df: DataFrame, columns: Sequence[str], repeats: int = 10,
                           seed: int = R.RANDOM_STATE, id_col: str = "id", target: str = R.TARGET_COLUMN) -> DataFrame:
    """AUC drop when one raw column is permuted (mean and std over repeats).

    A permutation of column c: rank rows by xxhash64(id, seed) and by
    xxhash64(id, seed, c, r); row at hash-rank i receives the value of the row
    at permutation-rank i (exact ranks).  Rows that share an id share a rank and
    a donor.  The work is #rows x #columns x repeats scorings: of a linear model
    column by column on packed arrays, of any other by its own transform."""
    rows = df.select(id_col, target, *[c for c in columns if c not in (id_col, target)])
    slots = _slots(model, columns) if id_col not in columns and target not in columns else None
    if slots and rows.count() <= ROWS_OF_A_COLUMN:
        perm_auc = _linear_permutations(model, rows, columns, slots, repeats, seed, id_col, target)
    else:
        perm_auc = _shuffled_permutations(model, rows, columns, repeats, seed, id_col, target)
    preds = vector_to_array(F.col("probability"))[1]
    base_auc = E.rank_metrics(model.transform(df).select(F.col(target).cast("int").alias("y"), preds.alias("p")))
    j = perm_auc.crossJoin(base_auc.select(F.col("roc_auc").alias("_base")))  # one-row side
    return (j.withColumn("drop", F.col("_base") - F.col("roc_auc"))
            .groupBy(F.col("_feature").alias("feature"))
            .agg(F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std"))
            .orderBy(F.desc("importance_mean")))


ROWS_OF_A_COLUMN = 6_000_000    # rows whose five numbers a task holds (33 bytes a row, some 80 at its peak)


def _slots(model: PipelineModel, columns: Sequence[str], roles: R.ColumnRoles = R.LOAN_ROLES) -> dict | None:
    """The slots of the assembled vector that each raw column fills, for a binary
    linear model on the loan preprocessing; None for any other."""
    stages = list(getattr(model, "stages", []))
    clf = stages[-1] if stages else None
    if not isinstance(clf, LogisticRegressionModel) or clf.coefficientMatrix.numRows != 1 or set(columns) != set(roles.features):
        return None
    levels = [labels for s in stages if isinstance(s, StringIndexerModel) for labels in s.labelsArray]
    if len(levels) != len(roles.nominal):
        return None
    widths = [(c, 1) for c in roles.numeric] + [(c, len(v)) for c, v in zip(roles.nominal, levels)] + [(c, 1) for c in roles.ordinal]
    ends = np.cumsum([w for _, w in widths])
    if ends[-1] != clf.coefficients.size:
        return None
    return {c: slice(int(end) - w, int(end)) for (c, w), end in zip(widths, ends)}


def _linear_permutations(model: PipelineModel, rows: DataFrame, columns: Sequence[str], slots: dict, repeats: int,
                         seed: int, id_col: str, target: str) -> DataFrame:
    """(_feature, _repeat, roc_auc) of a linear model.  A column's part of the
    margin is all that a permutation exchanges, so a task that holds, for one
    column, every row's two hashes, outcome, margin without the column and
    donor's part ranks and scores all its repeats; 33 bytes a row and column
    are shuffled once."""
    prep, clf = PipelineModel(stages=model.stages[:-1]), _classifier(model)
    coef, intercept = clf.coefficients.toArray(), float(clf.intercept)
    cuts = [slots[c] for c in columns]
    src = rows.withColumn("_src", F.xxhash64(F.col(id_col), F.lit(seed)))
    donors = src.groupBy("_src").agg(F.min(F.struct(*columns)).alias("_donor"))
    yy = F.col(target).cast("int")
    y = F.when(yy == 1, F.lit(1)).when(yy == 0, F.lit(0)).otherwise(F.lit(2)).alias("_y")
    hashes = F.array(*[F.xxhash64(F.col(id_col), F.lit(seed), F.lit(c)) for c in columns]).alias("_hashes")
    kept = ["_src", "_y", "_hashes", "_own"]
    own = (prep.transform(src.join(donors, "_src").select("_src", y, hashes, "_donor", *columns))
           .select("_src", "_y", "_hashes", vector_to_array("features").alias("_own"), "_donor"))
    both = prep.transform(own.select(*kept, "_donor.*")).select(*kept, vector_to_array("features").alias("_given"))

    def parts(vectors: pa.Array, n: int) -> np.ndarray:
        x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) * coef
        return np.stack([x[:, c].sum(1) for c in cuts])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            at, outcome = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            hashed = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(n, -1).T
            mine, given = parts(b.column(3), n), parts(b.column(4), n)
            rest = [mine[[i for i in range(len(cuts)) if i != j]].sum(0) + intercept for j in range(len(cuts))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(cuts)), pa.int32()), pa.array([at.astype(np.int64).tobytes()] * len(cuts), pa.binary()),
                 pa.array([outcome.astype(np.int8).tobytes()] * len(cuts), pa.binary()),
                 *[pa.array([np.ascontiguousarray(x).tobytes() for x in v], pa.binary()) for v in (hashed, rest, given)]],
                names=["c", "src", "y", "hash", "rest", "given"])

    def score(key: tuple, held: pa.Table) -> pa.Table:
        c = key[0].as_py()
        at, outcome, hashed, rest, given = (
            np.concatenate([np.frombuffer(v.as_buffer(), dtype=t) for v in held.column(name)])
            for name, t in (("src", np.int64), ("y", np.int8), ("hash", np.int64), ("rest", float), ("given", float)))
        del held
        _, first, rank = np.unique(at, return_index=True, return_inverse=True)
        hashed, given = hashed[first], given[first]                  # one donor per id
        aucs = []
        for r in range(repeats):
            order = np.argsort(_hashed_int(hashed, r), kind="stable")
            with np.errstate(over="ignore"):
                p = 1.0 / (1.0 + np.exp(-(rest + given[order][rank])))
            aucs.append(_exact_auc(p, outcome))
        return pa.table({"_feature": pa.array([columns[c]] * repeats, pa.string()), "_repeat": pa.array(range(repeats), pa.int32()),
                         "roc_auc": pa.array(aucs, pa.float64())})

    packed = both.mapInArrow(pack, "c int, src binary, y binary, hash binary, rest binary, given binary")
    return packed.groupBy("c").applyInArrow(score, "_feature string, _repeat int, roc_auc double")


def _hashed_int(seeds: np.ndarray, value: int) -> np.ndarray:
    """Spark's xxhash64 of one more int column, from the hashes of those before it."""
    def turned(h, by):
        return (h << np.uint64(by)) | (h >> np.uint64(64 - by))

    p1, p2, p3, p5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))
    h = seeds.astype(np.int64).view(np.uint64) + (p5 + np.uint64(4))
    h = turned(h ^ (np.array([value & 0xFFFFFFFF], np.uint64) * p1), 23) * p2 + p3
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    return (h ^ (h >> np.uint64(32))).view(np.int64)


def _exact_auc(p: np.ndarray, y: np.ndarray) -> float | None:
    """ROC-AUC, ties one half (NaN scores tie above all others); None for one class."""
    order = np.argsort(p)
    p, pos, neg = p[order], (y[order] == 1), (y[order] == 0)
    n_pos, n_neg = int(pos.sum()), int(neg.sum())
    if not n_pos or not n_neg:
        return None
    starts = np.flatnonzero(np.r_[True, ~((p[1:] == p[:-1]) | (np.isnan(p[1:]) & np.isnan(p[:-1])))])
    pos, neg = (np.add.reduceat(v, starts, dtype=np.int64) for v in (pos, neg))
    return float((pos * (np.cumsum(neg) - 0.5 * neg)).sum() / (n_pos * n_neg))


def _shuffled_permutations(model: PipelineModel, rows: DataFrame, columns: Sequence[str], repeats: int, seed: int,
                           id_col: str, target: str) -> DataFrame:
    """(_feature, _repeat, roc_auc) of any model.  The first rank is the same in
    every permutation and taken once (prefix counts); only the permuted values
    travel, gathered per rank (#columns x repeats of them), and a row is repeated
    where it is scored, not before.  One ROC-AUC job scores all permutations."""
    keys = F.explode(F.array(*[F.struct(F.lit(c).alias("_feature"), F.lit(r).alias("_repeat"))
                               for c in columns for r in range(repeats)])).alias("_key")
    k2 = ["_feature", "_repeat"]
    # ranks of distinct hashes: rows that share an id share a rank and a donor
    src = rows.withColumn("_src", F.xxhash64(F.col(id_col), F.lit(seed)))
    rs = ordered_counts(src.select("_src").distinct(), [], "_src").select("_src", F.col("c_before").alias("_rank"))
    ranked = src.join(rs, "_src").drop("_src")
    # a donor holds one value, in the field of its column's type
    types = {t: f"_v{i}" for i, t in enumerate(dict.fromkeys(t for c, t in rows.dtypes if c in columns))}
    kind = dict(rows.dtypes)

    def value(name: str):
        e = F.lit(None).cast(name)
        for c in columns:
            if kind[c] == name:
                e = F.when(F.col("_feature") == c, F.col(f"_donor.{c}")).otherwise(e)
        return e.alias(types[name])

    given = (rows.groupBy(id_col).agg(F.min(F.struct(*columns)).alias("_donor")).select(id_col, "_donor", keys)
             .select(id_col, "_donor", "_key.*")
             .select(*k2, F.xxhash64(F.col(id_col), F.lit(seed), F.col("_feature"), F.col("_repeat")).alias("_ph"),
                     F.struct(*[value(t) for t in types]).alias("_value"))
             .groupBy(*k2, "_ph").agg(F.min("_value").alias("_value")))
    rp = ordered_counts(given.select(*k2, "_ph"), k2, "_ph").select(*k2, "_ph", F.col("c_before").alias("_rank"))
    donors = (given.join(rp, k2 + ["_ph"]).groupBy("_rank")
              .agg(F.collect_list(F.struct(*k2, "_value")).alias("_given")))
    sh = ranked.join(donors, "_rank").select(*rows.columns, F.explode("_given").alias("_g")).select(*rows.columns, "_g.*")
    allp = sh.select(*[F.when(F.col("_feature") == c, F.col(f"_value.{types[kind[c]]}")).otherwise(F.col(c)).alias(c)
                       if c in columns else F.col(c) for c in rows.columns], *k2)
    preds = vector_to_array(F.col("probability"))[1]
    sp = model.transform(allp).select("_feature", "_repeat", F.col(target).cast("int").alias("y"), preds.alias("p"))
    return E.rank_metrics(sp, "y", "p", keys=["_feature", "_repeat"])


# X5
def linear_attribution(model: PipelineModel, df: DataFrame, background: DataFrame,
                       roles: R.ColumnRoles = R.LOAN_ROLES, id_col: str = "id") -> tuple:
    """Exact linear attributions in margin space: coef_j * (x_j - mean_bg_j).
    Returns (long table (row_id, feature, value, contribution), base value)."""
    clf = _classifier(model)
    if not isinstance(clf, LogisticRegressionModel):
        raise TypeError("linear attribution needs a logistic model")
    names = feature_names(model, roles)
    coef = [float(c) for c in clf.coefficients.toArray()]
    prep = PipelineModel(stages=model.stages[:-1])
    bg = prep.transform(background).select(vector_to_array("features").alias("v"))
    means = bg.select(F.posexplode("v").alias("j", "x")).groupBy("j").agg(F.avg("x").alias("m")).collect()  # d rows
    mu = [0.0] * len(names)
    for r in means:
        mu[r["j"]] = float(r["m"])
    base_value = float(clf.intercept) + sum(c * m for c, m in zip(coef, mu))
    x = prep.transform(df).select(F.col(id_col).alias("row_id"), vector_to_array("features").alias("v"))
    lit = F.array(*[F.struct(F.lit(n).alias("feature"), F.lit(c).alias("c"), F.lit(m).alias("m"))
                    for n, c, m in zip(names, coef, mu)])
    long = x.select("row_id", F.inline(F.arrays_zip(lit.alias("s"), F.col("v").alias("xv"))))
    out = long.select("row_id", F.col("s.feature").alias("feature"), F.col("xv").alias("value"),
                      (F.col("s.c") * (F.col("xv") - F.col("s.m"))).alias("contribution"))
    return out, base_value


# X7
def local_explanations(contrib: DataFrame, top_n: int = 5) -> DataFrame:
    """Per row: top-n risk-increasing (> 0) and protective (< 0) features by
    |contribution| (labels), as arrays.  Window per (row, sign): #features rows."""
    lab = contrib.withColumn("label", humanize_feature_name(F.col("feature")))
    sign = F.when(F.col("contribution") > 0, "risk").when(F.col("contribution") < 0, "protective")
    w = Window.partitionBy("row_id", "_sign").orderBy(F.desc(F.abs("contribution")), "feature")
    ranked = lab.withColumn("_sign", sign).filter(F.col("_sign").isNotNull()) \
        .withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= top_n)
    g = ranked.groupBy("row_id").agg(
        F.transform(F.sort_array(F.collect_list(F.when(F.col("_sign") == "risk", F.struct("_rn", "label")))),
                    lambda s: s["label"]).alias("risk_factors"),
        F.transform(F.sort_array(F.collect_list(F.when(F.col("_sign") == "protective", F.struct("_rn", "label")))),
                    lambda s: s["label"]).alias("protective_factors"))
    return g


# X8 / X9 / X10
def global_importance(contrib: DataFrame, native: DataFrame | None = None,
                      permutation: DataFrame | None = None) -> DataFrame:
    g = contrib.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs_contribution"),
                                       F.avg("contribution").alias("mean_contribution"))
    g = g.withColumn("feature_label", humanize_feature_name(F.col("feature"))) \
         .withColumn("research_question", research_question(F.col("feature")))
    if native is not None:
        g = g.join(native, "feature", "left")
    if permutation is not None:
        g = g.join(permutation.withColumnRenamed("feature", "raw_feature"),
                   F.regexp_replace("feature", "^(numeric__|ordinal_categorical__)", "") == F.col("raw_feature"),
                   "left").drop("raw_feature")
    return g.orderBy(F.desc("mean_abs_contribution"))


def global_direction(glob: DataFrame, n: int = 8) -> DataFrame:
    """Top / least important and most positive / negative mean contributions (n each)."""
    w_top = Window.orderBy(F.desc("mean_abs_contribution"), "feature")  # over #features rows
    w_low = Window.orderBy(F.asc("mean_abs_contribution"), "feature")
    w_pos = Window.orderBy(F.desc("mean_contribution"), "feature")
    w_neg = Window.orderBy(F.asc("mean_contribution"), "feature")
    t = glob.select("feature", "mean_abs_contribution", "mean_contribution",
                    F.row_number().over(w_top).alias("r_top"), F.row_number().over(w_low).alias("r_low"),
                    F.row_number().over(w_pos).alias("r_pos"), F.row_number().over(w_neg).alias("r_neg"))
    parts = [t.filter(F.col("r_top") <= n).withColumn("list", F.lit("top")),
             t.filter(F.col("r_low") <= n).withColumn("list", F.lit("least")),
             t.filter((F.col("r_pos") <= n) & (F.col("mean_contribution") > 0)).withColumn("list", F.lit("positive")),
             t.filter((F.col("r_neg") <= n) & (F.col("mean_contribution") < 0)).withColumn("list", F.lit("negative"))]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.drop("r_top", "r_low", "r_pos", "r_neg")


def importance_merge(native: DataFrame, permutation: DataFrame) -> DataFrame:
    """Impurity vs permutation importance, full outer join on the raw name."""
    n = native.withColumn("feature", F.regexp_replace("feature", "^(numeric__|ordinal_categorical__)", ""))
    return n.join(permutation, "feature", "full_outer")


# X11 (decision path data)
def decision_paths(contrib: DataFrame, glob: DataFrame, base_value: float) -> DataFrame:
    """Cumulative margin per row with features ordered by global importance
    (window per row over #features entries)."""
    order = glob.select("feature", F.row_number().over(Window.orderBy(F.desc("mean_abs_contribution"), "feature"))
                        .alias("order"))
    j = contrib.join(F.broadcast(order), "feature")  # #features rows
    w = Window.partitionBy("row_id").orderBy("order").rowsBetween(Window.unboundedPreceding, 0)
    return j.withColumn("cumulative_margin", F.lit(base_value) + F.sum("contribution").over(w))


# X12
def dependence_data(contrib: DataFrame, feature: str, interacting: str | None = None) -> DataFrame:
    """(row_id, value, contribution, interaction_value) for one model input;
    a one-hot slot name raises (dependence needs a single numeric input)."""
    if feature.startswith("onehot_categorical__"):
        raise ValueError("dependence data needs a numeric or ordinal feature, not a one-hot slot")
    f = contrib.filter(F.col("feature") == feature).select("row_id", "value", "contribution")
    if interacting is None:
        return f
    g = contrib.filter(F.col("feature") == interacting).select("row_id", F.col("value").alias("interaction_value"))
    return f.join(g, "row_id", "left")


# X13
# Fixed values (must stay exactly as listed): default (primary, interacting) pairs
DEFAULT_INTERACTION_PAIRS = [
    ("annual_inc", "dti"),
    ("grade", "int_rate"),
    ("emp_length_years", "annual_inc"),
    ("purpose", "grade"),
    ("home_ownership", "dti"),
]
INTERACTION_NUMERIC = ["annual_inc", "dti", "int_rate", "emp_length_years"]


def interaction_table(df: DataFrame, a: str, b: str, p: str = "p", numeric: Sequence[str] = (),
                      q: int = 4) -> DataFrame:
    """Mean score by (a, b); numeric sides quartile-binned; NULL keys dropped."""
    from lendscope.operators.bands import bin_into_quantiles
    out = df
    ka, kb = a, b
    if a in numeric:
        out = bin_into_quantiles(out, a, q, out=f"{a}_bin")
        ka = f"{a}_bin"
    if b in numeric:
        out = bin_into_quantiles(out, b, q, out=f"{b}_bin")
        kb = f"{b}_bin"
    return (out.filter(F.col(ka).isNotNull() & F.col(kb).isNotNull())
            .groupBy(F.col(ka).cast("string").alias("a_value"), F.col(kb).cast("string").alias("b_value"))
            .agg(F.avg(p).alias("mean_score"), F.count(F.lit(1)).alias("n"))
            .withColumn("feature_a", F.lit(a)).withColumn("feature_b", F.lit(b)))


# X14
def linear_curves(df: DataFrame, margin, value, coefficient: float, grid: Sequence[tuple], id_col: str = "id") -> DataFrame:
    """ICE of a linear model in closed form: (id, grid_value, p) for every row
    and every (grid value, model input) of ``grid``.  A row stays one row: its
    margin moves by ``coefficient`` times the change of the input, evaluated
    against the grid as an array."""
    at = F.array(*[F.struct(F.lit(float(g)).alias("grid_value"), F.lit(float(z)).alias("z")) for g, z in grid])
    curve = F.transform(at, lambda g: F.struct(
        g["grid_value"].alias("grid_value"),
        (1.0 / (1.0 + F.exp(-(margin + F.lit(float(coefficient)) * (g["z"] - value))))).alias("p")))
    return df.select(F.col(id_col), F.inline(curve))


def partial_dependence(model: PipelineModel, sample: DataFrame, feature: str, grid_points: int = 100,
                       ice: bool = False, id_col: str = "id") -> DataFrame:
    """PD (mean p per grid value) or ICE (every row x grid value) for a numeric
    feature; grid = distinct values if fewer than ``grid_points``, else an
    even grid between the 5th and 95th percentile."""
    from lendscope.operators.ordered import exact_quantiles
    t = dict(sample.dtypes).get(feature)
    if t not in ("double", "float", "int", "bigint", "long", "smallint"):
        raise TypeError(f"{feature} is not numeric")
    nd = sample.select(feature).distinct().limit(grid_points + 1).collect()
    if len(nd) <= grid_points:
        grid = sorted(float(r[0]) for r in nd if r[0] is not None)
    else:
        qs = {round(r["prob"], 4): r["value"] for r in exact_quantiles(sample, [feature], [0.05, 0.95]).collect()}
        lo, hi = qs[0.05], qs[0.95]
        grid = [lo + (hi - lo) * i / (grid_points - 1) for i in range(grid_points)]
    clf = _classifier(model)
    slot = f"numeric__{feature}"
    names = feature_names(model)
    if isinstance(clf, LogisticRegressionModel) and slot in names:
        sc = _linear_ice(model, sample, feature, grid, names.index(slot), id_col)
        return sc if ice else sc.groupBy("grid_value").agg(F.avg("p").alias("mean_p")).withColumn("feature", F.lit(feature))
    g = F.explode(F.array(*[F.lit(v) for v in grid])).alias("_grid")  # bounded grid
    rep = sample.select("*", g).withColumn(feature, F.col("_grid"))
    sc = model.transform(rep).select(id_col, F.col("_grid").alias("grid_value"),
                                     vector_to_array("probability")[1].alias("p"))
    if ice:
        return sc
    return sc.groupBy("grid_value").agg(F.avg("p").alias("mean_p")).withColumn("feature", F.lit(feature))


def _linear_ice(model: PipelineModel, sample: DataFrame, feature: str, grid: Sequence[float], slot: int, id_col: str) -> DataFrame:
    """``linear_curves`` of a fitted pipeline: the rows go through it once, and
    one row per grid value tells what the model's input is there."""
    one = sample.limit(1).drop(feature).withColumn(feature, F.explode(F.array(*[F.lit(float(v)) for v in grid])))
    prep = PipelineModel(stages=model.stages[:-1])
    inputs = {r[0]: r[1] for r in prep.transform(one).select(
        feature, vector_to_array("features")[slot].alias("z")).collect()}            # one row per grid value
    scored = model.transform(sample)
    return linear_curves(scored, vector_to_array("rawPrediction")[1], vector_to_array("features")[slot],
                         _classifier(model).coefficients[slot], [(g, inputs[g]) for g in grid if g in inputs], id_col)
