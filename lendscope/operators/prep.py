"""Feature preparation, stratified splits and class weights.

Custom ``pyspark.ml`` stages (persistable with the standard ML writers):

* ``ExactMedianImputer`` -- exact linear-interpolated medians (MLlib's Imputer
  is approximate), fitted with the distributed rank selection of
  ``ordered.exact_quantiles``;
* ``ModeImputer`` -- most frequent value, smallest on ties;
* ``PopulationScaler`` -- (x - mean) / population std, zero spread -> 0;
* ``OrdinalEncoder`` -- fixed order lookup, unknown -> -1.

Splits and folds rank rows by ``xxhash64(id, seed)`` inside each class with
exact per-class quotas; the quota cut points are found by rank selection on
distributed prefix counts, so assigning a split is a narrow projection.
"""

from __future__ import annotations

import json
import math

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope import roles as R
from pyspark.sql import Window

from lendscope.operators.ordered import exact_quantiles, ordered_counts, set_medians


class _HasValues(Params):
    values = Param(Params._dummy(), "values", "JSON map column -> fitted value(s)",
                   typeConverter=TypeConverters.toString)

    def _vals(self) -> dict:
        return json.loads(self.getOrDefault(self.values))


def _out_cols(stage) -> list:
    ins = stage.getOrDefault(stage.inputCols)
    if stage.isDefined(stage.outputCols) and stage.getOrDefault(stage.outputCols):
        return stage.getOrDefault(stage.outputCols)
    return ins


class FillValuesModel(Model, HasInputCols, HasOutputCols, _HasValues,
                      DefaultParamsReadable, DefaultParamsWritable):
    """coalesce(column, fitted value)."""

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, values=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        vals = self._vals()
        return df.withColumns({o: F.coalesce(F.col(i), F.lit(vals[i])) if vals.get(i) is not None else F.col(i)
                               for i, o in zip(self.getInputCols(), _out_cols(self))})


class ExactMedianImputer(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> FillValuesModel:
        cols = self.getInputCols()
        rows = exact_quantiles(df, cols, [0.5]).collect()  # one row per column
        vals = {r["column"]: r["value"] for r in rows}
        m = FillValuesModel(inputCols=cols, values=json.dumps(vals))
        if self.isDefined(self.outputCols):
            m.set(m.outputCols, self.getOrDefault(self.outputCols))
        return m


class ModeImputer(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> FillValuesModel:
        from lendscope.operators.describe import mode_table
        cols = self.getInputCols()
        rows = mode_table(df, cols).collect()  # one row per column
        vals = {r["column"]: r["mode"] for r in rows}
        m = FillValuesModel(inputCols=cols, values=json.dumps(vals))
        if self.isDefined(self.outputCols):
            m.set(m.outputCols, self.getOrDefault(self.outputCols))
        return m


class AffineModel(Model, HasInputCols, HasOutputCols, _HasValues, DefaultParamsReadable, DefaultParamsWritable):
    """(x - mean) / scale with stored [mean, scale] per column."""

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, values=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        vals = self._vals()
        return df.withColumns({o: (F.col(i).cast("double") - F.lit(vals[i][0])) / F.lit(vals[i][1])
                               for i, o in zip(self.getInputCols(), _out_cols(self))})


class PopulationScaler(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """sklearn-style standardisation (ddof 0; zero variance -> scale 1)."""

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> AffineModel:
        cols = self.getInputCols()
        row = df.agg(*[x for c in cols for x in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))]).first()
        vals = {}
        for c in cols:
            m, s = row[f"m_{c}"], row[f"s_{c}"]
            vals[c] = [m if m is not None else 0.0, s if s and s > 0 else 1.0]
        mdl = AffineModel(inputCols=cols, values=json.dumps(vals))
        if self.isDefined(self.outputCols):
            mdl.set(mdl.outputCols, self.getOrDefault(self.outputCols))
        return mdl


class OrdinalEncoder(Transformer, HasInputCols, HasOutputCols, _HasValues,
                     DefaultParamsReadable, DefaultParamsWritable):
    """Position in a fixed order (0-based); unknown or NULL -> -1."""

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, values=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        orders = self._vals()
        out = df
        for i, o in zip(self.getInputCols(), _out_cols(self)):
            pos = F.array_position(F.array(*[F.lit(v) for v in orders[i]]), F.col(i))
            out = out.withColumn(o, F.coalesce(pos - 1, F.lit(-1)).cast("double"))
        return out


# F6
def build_preprocessing_pipeline(roles: R.ColumnRoles = R.LOAN_ROLES, features_col: str = "features",
                                 scale_ordinal: bool = False, onehot: bool = True) -> Pipeline:
    """14 numeric (median impute + scale), one-hot nominal (mode impute,
    alphabetical levels, unknown -> all zeros, no level dropped) and ordinal
    (mode impute, fixed order); assembled into one vector."""
    num = list(roles.numeric)
    nom = list(roles.nominal) if onehot else []
    ordc = list(roles.ordinal)
    stages = [
        ExactMedianImputer(inputCols=num, outputCols=[f"{c}__imp" for c in num]),
        PopulationScaler(inputCols=[f"{c}__imp" for c in num], outputCols=[f"numeric__{c}" for c in num]),
        ModeImputer(inputCols=nom + ordc, outputCols=[f"{c}__imp" for c in nom + ordc]),
        OrdinalEncoder(inputCols=[f"{c}__imp" for c in ordc], outputCols=[f"{c}__ord" for c in ordc],
                       values=json.dumps({f"{c}__imp": roles.ordinal_orders[c] for c in ordc})),
    ]
    ord_out = [f"{c}__ord" for c in ordc]
    if scale_ordinal:
        stages.append(PopulationScaler(inputCols=ord_out, outputCols=[f"ordinal_categorical__{c}" for c in ordc]))
    else:
        stages.append(_Rename(inputCols=ord_out, outputCols=[f"ordinal_categorical__{c}" for c in ordc]))
    assembled = [f"numeric__{c}" for c in num]
    if nom:
        stages.append(StringIndexer(inputCols=[f"{c}__imp" for c in nom], outputCols=[f"{c}__idx" for c in nom],
                                    stringOrderType="alphabetAsc", handleInvalid="keep"))
        # the indexer's "keep" slot (unknown/NULL) is the last category and
        # dropLast removes it: unknown -> all zeros, every real level kept
        stages.append(OneHotEncoder(inputCols=[f"{c}__idx" for c in nom], outputCols=[f"{c}__oh" for c in nom],
                                    dropLast=True))
        assembled += [f"{c}__oh" for c in nom]
    assembled += [f"ordinal_categorical__{c}" for c in ordc]
    stages.append(VectorAssembler(inputCols=assembled, outputCol=features_col, handleInvalid="keep"))
    return Pipeline(stages=stages)


def fit_preprocessing_of_sets(df: DataFrame, cell: str, sets: dict, roles: R.ColumnRoles = R.LOAN_ROLES) -> tuple:
    """``build_preprocessing_pipeline().fit`` of many overlapping training sets
    at once.  Every row lies in one cell (NULL: in no set) and ``sets`` maps a
    set's key to its cells; counts and moments are taken per cell and merged.

    Returns ({key: fitted pipeline}, {key: rows}).  The driver holds #cells x
    #columns moments and the category counts that the indexers keep anyway."""
    num, cat = list(roles.numeric), [*roles.nominal, *roles.ordinal]
    df = df.filter(F.col(cell).isNotNull())
    value = {c: F.col(c).cast("double") for c in num}
    measures = {"count": F.count, "avg": F.avg, "var": F.var_pop, "min": F.min, "max": F.max}
    moments = {r[cell]: r for r in df.groupBy(cell).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[f(v).alias(f"{c}__{m}") for c, v in value.items() for m, f in measures.items()]).collect()}
    seen = {}                              # column -> cell -> category -> rows
    for r in (df.select(cell, F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                                                 for c in cat])))
              .filter(F.col("value").isNotNull()).groupBy("column", cell, "value").count().collect()):
        seen.setdefault(r["column"], {}).setdefault(r[cell], {})[r["value"]] = r["count"]
    sets = {k: [x for x in cells if x in moments] for k, cells in sets.items()}
    medians = set_medians(df, num, cell, sets)
    models, last = {}, None
    for key, cells in sets.items():
        fill, scale = {}, {}
        for c in num:
            med = medians.get((key, c))
            if med is not None:
                fill[c] = med
            scale[f"{c}__imp"] = _merged_moments([moments[x] for x in cells], c, med)
        totals = {c: {} for c in cat}
        for c in cat:
            for x in cells:
                for v, n in seen.get(c, {}).get(x, {}).items():
                    totals[c][v] = totals[c].get(v, 0) + n
        mode = {c: min(t, key=lambda v, t=t: (-t[v], v)) for c, t in totals.items() if t}
        stages = []
        for stage in build_preprocessing_pipeline(roles).getStages():
            if isinstance(stage, ExactMedianImputer):
                stage = FillValuesModel(inputCols=num, outputCols=_out_cols(stage), values=json.dumps(fill))
            elif isinstance(stage, PopulationScaler):
                stage = AffineModel(inputCols=stage.getInputCols(), outputCols=_out_cols(stage), values=json.dumps(scale))
            elif isinstance(stage, ModeImputer):
                stage = FillValuesModel(inputCols=cat, outputCols=_out_cols(stage), values=json.dumps(mode))
            elif isinstance(stage, StringIndexer):
                # one model per column: pyspark pads label arrays of unequal length with nulls
                indexers = [StringIndexerModel.from_labels(sorted(totals[c], key=lambda v: v.encode("utf-16-be")), i, o,
                                                           handleInvalid="keep")
                            for c, i, o in zip(roles.nominal, stage.getInputCols(), stage.getOutputCols())]
                stages += indexers
                continue
            elif isinstance(stage, OneHotEncoder):     # reads the sizes off the indexers' column metadata, no rows
                stage = stage.fit(PipelineModel(indexers).transform(df.select(
                    *[F.lit("").alias(x.getInputCol()) for x in indexers])))
            stages.append(stage)
        models[key] = PipelineModel(stages)
    return models, {k: sum(moments[x]["_rows"] for x in cells) for k, cells in sets.items()}


def _merged_moments(rows: list, c: str, fill: float | None) -> list:
    """[mean, population std (1.0 for no spread)] of a column over several
    cells, its missing values filled."""
    parts = [(r[f"{c}__count"], r[f"{c}__avg"], r[f"{c}__var"], r[f"{c}__min"], r[f"{c}__max"])
             for r in rows if r[f"{c}__count"]]
    if fill is not None:
        missing = sum(r["_rows"] - r[f"{c}__count"] for r in rows)
        parts += [(missing, fill, 0.0, fill, fill)] if missing else []
    n = sum(x[0] for x in parts)
    if not n:
        return [0.0, 1.0]
    mean = math.fsum(x[0] * x[1] for x in parts) / n
    spread = math.fsum(x[0] * (x[2] + (x[1] - mean) ** 2) for x in parts) / n
    lo, hi = min(x[3] for x in parts), max(x[4] for x in parts)
    return [mean, math.sqrt(spread) if spread > 0 and lo != hi else 1.0]


class _Rename(Transformer, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df):
        out = df
        for i, o in zip(self.getInputCols(), self.getOutputCols()):
            out = out.withColumn(o, F.col(i))
        return out


# F8
def build_clustering_preprocessor(roles: R.ColumnRoles = R.LOAN_ROLES, features_col: str = "features") -> Pipeline:
    """Numeric + scaled ordinal grade, no one-hot (15 dimensions for the loan roles)."""
    return build_preprocessing_pipeline(roles, features_col, scale_ordinal=True, onehot=False)


# F7
def feature_names(fitted, roles: R.ColumnRoles = R.LOAN_ROLES) -> list:
    """Names of the assembled vector slots: ``numeric__c``,
    ``onehot_categorical__c_<level>``, ``ordinal_categorical__c``."""
    from pyspark.ml.feature import StringIndexerModel
    names = [f"numeric__{c}" for c in roles.numeric]
    idx = [s for s in fitted.stages if isinstance(s, StringIndexerModel)]
    if idx:
        labels = [labels for s in idx for labels in s.labelsArray]      # one indexer of all columns, or one each
        for c, labs in zip(roles.nominal, labels):
            names += [f"onehot_categorical__{c}_{v}" for v in labs]  # keep slot dropped: unknown -> zeros
    names += [f"ordinal_categorical__{c}" for c in roles.ordinal]
    return names


# F9 / F10 -------------------------------------------------------------------
def approximate_mode(class_counts: dict, n_draws: int) -> dict:
    """Allocate ``n_draws`` across classes proportionally: floor, then the
    largest remainders (ties -> smallest class key)."""
    total = sum(class_counts.values())
    cont = {k: v / total * n_draws for k, v in class_counts.items()}
    floored = {k: math.floor(v) for k, v in cont.items()}
    need = int(n_draws - sum(floored.values()))
    for k in sorted(class_counts, key=lambda k: (-(cont[k] - floored[k]), k)):
        if need <= 0:
            break
        floored[k] += 1
        need -= 1
    return floored


def split_quotas(class_counts: dict, test_size: float = R.TEST_SIZE,
                 validation_size: float = R.VALIDATION_SIZE) -> dict:
    """Per-class (test, val, train) counts of a stratified two-step split."""
    n = sum(class_counts.values())
    n_test = math.ceil(test_size * n)
    train1 = approximate_mode(class_counts, n - n_test)
    test = {k: class_counts[k] - train1[k] for k in class_counts}
    rel = validation_size / (1 - test_size)
    pool = sum(train1.values())
    n_val = math.ceil(rel * pool)
    train = approximate_mode(train1, pool - n_val)
    val = {k: train1[k] - train[k] for k in class_counts}
    return {k: (test[k], val[k], train[k]) for k in class_counts}


def _hash_rank_cuts(df: DataFrame, target: str, hcol: str, cuts: dict) -> DataFrame:
    """For each class and rank r in ``cuts[class]``, the hash value at 0-based
    rank r (exact rank selection; absent when r >= class size)."""
    cnt = ordered_counts(df.select(F.col(target).alias("_cls"), F.col(hcol).alias("_h")), ["_cls"], "_h")
    want = df.sparkSession.createDataFrame([(int(k), int(i), int(r)) for k, rs in cuts.items() for i, r in enumerate(rs)],
                                           "_k int, _which int, _r long")   # two rows per class
    j = cnt.join(F.broadcast(want), (cnt["_cls"] == want["_k"]) & (want["_r"] >= cnt["c_before"]) &
                 (want["_r"] < cnt["c_before"] + cnt["c"]))
    return j.select(F.col("_k").alias("_cls"), "_which", F.col("_h").alias("_cut"))


def stratified_split(df: DataFrame, target: str = R.TARGET_COLUMN, id_col: str = "id",
                     seed: int = R.RANDOM_STATE, test_size: float = R.TEST_SIZE,
                     validation_size: float = R.VALIDATION_SIZE, out: str = "split") -> DataFrame:
    """Adds ``split`` in {train, val, test}: per-class counts equal the
    stratified two-step allocation exactly; within a class rows are ordered
    by ``xxhash64(id, seed)``."""
    h = F.xxhash64(F.col(id_col), F.lit(seed))
    d = df.withColumn("_h", h)
    counts = {int(r[0]): int(r[1]) for r in d.groupBy(target).count().collect()}  # #classes rows
    q = split_quotas(counts, test_size, validation_size)
    cuts = {k: [t, t + v] for k, (t, v, _) in q.items()}
    cut = _hash_rank_cuts(d, target, "_h", cuts).collect()  # <= 2 per class
    c1 = {int(r["_cls"]): r["_cut"] for r in cut if r["_which"] == 0}
    c2 = {int(r["_cls"]): r["_cut"] for r in cut if r["_which"] == 1}

    def lim(m):
        e = None
        for k, v in m.items():
            cond = F.col(target) == k
            e = F.when(cond, F.lit(v)) if e is None else e.when(cond, F.lit(v))
        return e if e is not None else F.lit(None).cast("long")
    a, b = lim(c1), lim(c2)
    s = (F.when(a.isNotNull() & (F.col("_h") < a), "test")
         .when(a.isNull(), "test")
         .when(b.isNotNull() & (F.col("_h") < b), "val")
         .when(b.isNull(), "val")
         .otherwise("train"))
    return d.withColumn(out, s).drop("_h")


def stratified_folds(df: DataFrame, k: int = R.CV_FOLDS, target: str = R.TARGET_COLUMN, id_col: str = "id",
                     seed: int = R.RANDOM_STATE, out: str = "fold") -> DataFrame:
    """Fold id = (rank of xxhash64(id, seed) within the class) mod k: balanced
    folds per class.  The rank counts the rows of smaller hash, so rows that
    share an id share a fold, whatever the partitioning."""
    d = df.withColumn("_h", F.xxhash64(F.col(id_col), F.lit(seed + 1)))
    cnt = ordered_counts(d.select(F.col(target).alias("_cls"), F.col("_h")), ["_cls"], "_h")
    ranks = cnt.select(F.col("_cls").alias("_rank_cls"), F.col("_h").alias("_rank_h"), F.col("c_before").alias("_rank"))
    out_cols = [*df.columns, (F.col("_rank") % k).cast("int").alias(out)]
    return d.join(ranks, d[target].eqNullSafe(ranks["_rank_cls"]) & (d["_h"] == ranks["_rank_h"])).select(*out_cols)


# M6
def class_weights(df: DataFrame, target: str = R.TARGET_COLUMN, mode: str = "balanced",
                  out: str = "weight", counts: dict | None = None) -> DataFrame:
    """``balanced``: n / (2 n_c); ``scale_pos``: positives weighted neg/pos
    (rounded to 2, 1.0 when there are no positives); ``none``: 1.  ``counts``:
    the rows per class, where they are known."""
    if counts is None:
        counts = {int(r[0]): int(r[1]) for r in df.groupBy(target).count().collect()}
    n = sum(counts.values())
    if mode == "balanced":
        w = {k: n / (len(counts) * v) for k, v in counts.items()}
    elif mode == "scale_pos":
        pos, neg = counts.get(1, 0), counts.get(0, 0)
        w = {0: 1.0, 1: round(neg / pos, 2) if pos > 0 else 1.0}
    else:
        w = {k: 1.0 for k in counts}
    e = F.lit(1.0)
    for k, v in w.items():
        e = F.when(F.col(target) == k, F.lit(float(v))).otherwise(e)
    return df.withColumn(out, e)


def scale_pos_weight(df: DataFrame, target: str = R.TARGET_COLUMN) -> DataFrame:
    """Single-row table: positives, negatives and the neg/pos ratio (2 dp)."""
    g = df.agg(F.count(F.when(F.col(target) == 1, 1)).alias("n_pos"),
               F.count(F.when(F.col(target) == 0, 1)).alias("n_neg"))
    return g.withColumn("scale_pos_weight", F.when(F.col("n_pos") > 0,
                                                   F.bround(F.col("n_neg") / F.col("n_pos"), 2)).otherwise(1.0))
