"""Classifier evaluation on any ``(y, p)`` table, optionally per group.

All metrics accept ``keys`` (e.g. ``model``, or ``(group_column,
group_value)`` for fairness) and compute every group in one job.  Rank
metrics (ROC-AUC, average precision, ROC/PR points) use the exact prefix
counts of ``ordered.ordered_counts`` -- no single-partition window and no
1000-bin approximation.  Threshold sweeps bucket each score once and take
suffix sums over at most #thresholds rows per group.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendscope import roles as R
from lendscope.operators.ordered import join_null_safe, ordered_counts
from lendscope.session import written

EPS = 2.220446049250313e-16  # float64 machine epsilon, the probability clip


def _keys(df: DataFrame, keys: Sequence[str]):
    keys = list(keys)
    if keys:
        return df, keys
    return df.withColumn("_all", F.lit(0)), ["_all"]


def _drop_all(df: DataFrame, keys):
    return df.drop("_all") if keys == ["_all"] else df


def _div(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b)


# E1
def confusion_counts(df: DataFrame, y: str = "y", p: str = "p", threshold: float = 0.5,
                     keys: Sequence[str] = ()) -> DataFrame:
    """tp, fp, tn, fn and n at one cutoff (p >= t is positive); all four always present."""
    d, k = _keys(df, keys)
    yy, pp = F.col(y).cast("int"), F.col(p).cast("double")
    pred = pp >= threshold
    out = d.groupBy(*k).agg(
        F.count(F.when(pred & (yy == 1), 1)).alias("tp"),
        F.count(F.when(pred & (yy == 0), 1)).alias("fp"),
        F.count(F.when(~pred & (yy == 0), 1)).alias("tn"),
        F.count(F.when(~pred & (yy == 1), 1)).alias("fn"),
        F.count(F.lit(1)).alias("n"))
    return _drop_all(out, k)


# E2
def threshold_metrics(tp: Column, fp: Column, tn: Column, fn: Column) -> dict:
    n = tp + fp + tn + fn
    precision = F.coalesce(_div(tp, tp + fp), F.lit(0.0))
    recall = F.coalesce(_div(tp, tp + fn), F.lit(0.0))
    spec = _div(tn, tn + fp)
    f1 = F.when((precision + recall) > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    tnr0 = F.coalesce(spec, F.lit(0.0))
    n_cls = F.when((tp + fn) > 0, 1).otherwise(0) + F.when((tn + fp) > 0, 1).otherwise(0)
    bal = (F.when((tp + fn) > 0, recall).otherwise(0.0) + F.when((tn + fp) > 0, tnr0).otherwise(0.0)) / n_cls
    den = F.sqrt((tp + fp).cast("double") * (tp + fn) * (tn + fp) * (tn + fn))
    mcc = F.when(den > 0, (tp.cast("double") * tn - fp.cast("double") * fn) / den).otherwise(0.0)
    return {"accuracy": (tp + tn) / n, "precision": precision, "recall": recall,
            "specificity": spec, "f1_score": f1, "balanced_accuracy": bal, "matthews_corrcoef": mcc}


def classification_metrics(df: DataFrame, y: str = "y", p: str = "p", threshold: float = 0.5,
                           keys: Sequence[str] = (), n_bins: int = R.CALIBRATION_BINS) -> DataFrame:
    """The full metric suite at one cutoff: E2 + ROC-AUC, AP, log loss, Brier, ECE.

    The input is evaluated once: keys, outcome and score are written and every
    metric family reads those."""
    keys = list(keys)
    df = written(df.select(*keys, y, p), "metrics")
    pm = point_metrics(df, y, p, threshold, keys)  # confusion + log loss + Brier: one pass
    m = threshold_metrics(F.col("tp"), F.col("fp"), F.col("tn"), F.col("fn"))
    base = pm.select(*keys, "tp", "fp", "tn", "fn", "n", *[v.alias(k) for k, v in m.items()],
                     "log_loss", "brier_score", "mean_probability")
    rank = rank_metrics(df, y, p, keys)
    ece = expected_calibration_error(df, y, p, n_bins, keys)
    out = base
    for t in (rank, ece):
        out = join_null_safe(out, t, keys) if keys else out.crossJoin(F.broadcast(t))      # one row each
    return out


def point_metrics(df: DataFrame, y: str = "y", p: str = "p", threshold: float = 0.5,
                  keys: Sequence[str] = ()) -> DataFrame:
    """Confusion counts at the cutoff together with log loss, Brier score and
    mean probability, in a single grouped aggregation."""
    d, k = _keys(df, keys)
    yi, yd, pp = F.col(y).cast("int"), F.col(y).cast("double"), F.col(p).cast("double")
    pred = pp >= threshold
    pc = F.least(F.greatest(pp, F.lit(EPS)), F.lit(1 - EPS))
    out = d.groupBy(*k).agg(
        F.count(F.when(pred & (yi == 1), 1)).alias("tp"),
        F.count(F.when(pred & (yi == 0), 1)).alias("fp"),
        F.count(F.when(~pred & (yi == 0), 1)).alias("tn"),
        F.count(F.when(~pred & (yi == 1), 1)).alias("fn"),
        F.count(F.lit(1)).alias("n"),
        F.avg(-(yd * F.log(pc) + (1 - yd) * F.log(1 - pc))).alias("log_loss"),
        F.avg(F.pow(pp - yd, 2)).alias("brier_score"),
        F.avg(pp).alias("mean_probability"))
    return _drop_all(out, k)


# E3 / E4
def rank_metrics(df: DataFrame, y: str = "y", p: str = "p", keys: Sequence[str] = ()) -> DataFrame:
    """Exact ROC-AUC (ties count one half) and average precision per group.

    One-class groups get NULL AUC/AP instead of an error.
    """
    d, k = _keys(df, keys)
    yy = F.col(y).cast("int")
    cnt = ordered_counts(d.select(*k, F.col(p).cast("double").alias("_s"), yy.alias("_y")), k, "_s",
                         sums={"pos": F.col("_y"), "neg": 1 - F.col("_y")}, totals=True)
    j = cnt.withColumnsRenamed({"pos_total": "_P", "neg_total": "_N", "c_total": "_T"})
    auc_term = F.col("pos") * (F.col("neg_before") + 0.5 * F.col("neg"))
    ap_term = F.col("pos") * ((F.col("_P") - F.col("pos_before")) / (F.col("_T") - F.col("c_before")))
    g = j.groupBy(*k).agg(F.sum(auc_term).alias("_auc"), F.sum(ap_term).alias("_ap"),
                          F.first("_P").alias("_P"), F.first("_N").alias("_N"))
    out = g.select(*k, F.when((F.col("_P") > 0) & (F.col("_N") > 0),
                              F.col("_auc") / (F.col("_P") * F.col("_N"))).alias("roc_auc"),
                   F.when(F.col("_P") > 0, F.col("_ap") / F.col("_P")).alias("average_precision"))
    return _drop_all(out, k)


def tied_scores(df: DataFrame, key: str, y: str = "y", p: str = "p") -> DataFrame:
    """``(key, p, pos, neg)``: equal scores of a key counted together within an
    Arrow batch, so that a score of many rows is few rows wherever it goes."""
    def count(batches):
        import pyarrow as pa
        for b in batches:
            yield from _tied(pa.Table.from_batches([b]), key).to_batches()

    yy = F.col(y).cast("int")
    return (df.select(F.col(key).cast("int").alias(key), F.col(p).cast("double").alias("p"),
                      F.coalesce((yy == 1).cast("long"), F.lit(0)).alias("pos"),
                      F.coalesce((yy == 0).cast("long"), F.lit(0)).alias("neg"))
            .mapInArrow(count, f"{key} int, p double, pos long, neg long"))


def _tied(table, key: str):
    return table.group_by([key, "p"]).aggregate([("pos", "sum"), ("neg", "sum")]) \
        .select([key, "p", "pos_sum", "neg_sum"]).rename_columns([key, "p", "pos", "neg"])


ROWS_PER_RANGE = 500_000


def auc_of_many(scores: DataFrame, key: str, n_rows: int) -> DataFrame:
    """Exact ROC-AUC (ties count one half; one class: NULL) per integer key of
    ``tied_scores`` rows that are written: one shuffle to ranges of (key, score)
    of about ``ROWS_PER_RANGE`` rows, each counted in its task, and a window
    over the ranges of a key (a few rows each)."""
    parts = max(scores.sparkSession.sparkContext.defaultParallelism, -(-n_rows // ROWS_PER_RANGE))

    def count(batches):
        import numpy as np
        import pyarrow as pa
        tables = [_tied(pa.Table.from_batches([b]), key) for b in batches]
        if not tables:
            return
        t = _tied(pa.concat_tables(tables), key).sort_by([(key, "ascending"), ("p", "ascending")])
        k, p, pos, neg = (t[c].to_numpy() for c in (key, "p", "pos", "neg"))
        starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.array([], int)
        rows = []
        for a, b in zip(starts, [*starts[1:], len(k)]):
            ahead = np.cumsum(neg[a:b]) - neg[a:b]
            rows.append((int(k[a]), float(p[a]), int(pos[a:b].sum()), int(neg[a:b].sum()),
                         float((pos[a:b] * (ahead + 0.5 * neg[a:b])).sum())))
        yield pa.RecordBatch.from_arrays([pa.array(c, ty) for c, ty in zip(
            zip(*rows) if rows else [[]] * 5, (pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.float64()))],
            names=[key, "p", "pos", "neg", "inside"])

    ranges = written(scores.repartitionByRange(parts, key, "p")
                     .mapInArrow(count, f"{key} int, p double, pos long, neg long, inside double"), "auc-ranges")
    earlier = Window.partitionBy(key).orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    g = (ranges.withColumn("_before", F.coalesce(F.sum("neg").over(earlier), F.lit(0)))
         .groupBy(key).agg(F.sum(F.col("inside") + F.col("pos") * F.col("_before")).alias("_auc"),
                           F.sum("pos").alias("_P"), F.sum("neg").alias("_N")))
    return g.select(key, F.when((F.col("_P") > 0) & (F.col("_N") > 0),
                                F.col("_auc") / (F.col("_P") * F.col("_N"))).alias("roc_auc"))


# E5 / E6
def probability_scores(df: DataFrame, y: str = "y", p: str = "p", keys: Sequence[str] = ()) -> DataFrame:
    d, k = _keys(df, keys)
    yy, pp = F.col(y).cast("double"), F.col(p).cast("double")
    pc = F.least(F.greatest(pp, F.lit(EPS)), F.lit(1 - EPS))
    out = d.groupBy(*k).agg(
        F.avg(-(yy * F.log(pc) + (1 - yy) * F.log(1 - pc))).alias("log_loss"),
        F.avg(F.pow(pp - yy, 2)).alias("brier_score"),
        F.avg(pp).alias("mean_probability"))
    return _drop_all(out, k)


# E7 / E8
def calibration_bin(p: Column, n_bins: int = R.CALIBRATION_BINS) -> Column:
    """Bin k covers (e[k-1], e[k]], first bin closed at 0, e = linspace(0, 1)."""
    step = 1.0 / n_bins
    inner = [i * step for i in range(1, n_bins)]
    b = F.lit(1)
    for e in inner:
        b = b + F.when(p > F.lit(e), 1).otherwise(0)
    return F.when((p >= 0) & (p <= 1), b)


def reliability_curve(df: DataFrame, y: str = "y", p: str = "p", n_bins: int = R.CALIBRATION_BINS,
                      keys: Sequence[str] = ()) -> DataFrame:
    """Per non-empty bin: count, mean predicted p, observed rate."""
    keys = list(keys)
    pp = F.col(p).cast("double")
    return (df.withColumn("bin", calibration_bin(pp, n_bins)).filter(F.col("bin").isNotNull())
            .groupBy(*keys, "bin")
            .agg(F.count(F.lit(1)).alias("n"), F.avg(pp).alias("mean_predicted"),
                 F.avg(F.col(y).cast("double")).alias("observed_rate")))


def expected_calibration_error(df: DataFrame, y: str = "y", p: str = "p",
                               n_bins: int = R.CALIBRATION_BINS, keys: Sequence[str] = ()) -> DataFrame:
    d, k = _keys(df, keys)
    rel = reliability_curve(d, y, p, n_bins, k)
    tot = d.groupBy(*k).agg(F.count(F.lit(1)).alias("_n"))
    j = join_null_safe(rel, tot, k)
    out = j.groupBy(*k).agg(F.sum(F.col("n") / F.col("_n") *
                                  F.abs(F.col("mean_predicted") - F.col("observed_rate")))
                            .alias("calibration_error"))
    return _drop_all(out, k)


# E9 / E10
def roc_points(df: DataFrame, y: str = "y", p: str = "p", keys: Sequence[str] = ()) -> DataFrame:
    """(threshold, fpr, tpr, precision, recall) for every distinct score."""
    d, k = _keys(df, keys)
    yy = F.col(y).cast("int")
    cnt = ordered_counts(d.select(*k, F.col(p).cast("double").alias("threshold"), yy.alias("_y")), k,
                         "threshold", sums={"pos": F.col("_y"), "neg": 1 - F.col("_y")}, totals=True)
    j = cnt.withColumnsRenamed({"pos_total": "_P", "neg_total": "_N"})
    tp = F.col("_P") - F.col("pos_before")
    fp = F.col("_N") - F.col("neg_before")
    out = j.select(*k, "threshold",
                   _div(fp, F.col("_N")).alias("fpr"), _div(tp, F.col("_P")).alias("tpr"),
                   _div(tp, tp + fp).alias("precision"), _div(tp, F.col("_P")).alias("recall"),
                   (F.col("_P") / (F.col("_P") + F.col("_N"))).alias("prevalence"))
    return _drop_all(out, k)


# E11 / E12
def threshold_metrics_table(df: DataFrame, y: str = "y", p: str = "p",
                            thresholds: Sequence[float] = R.THRESHOLD_GRID,
                            cost_fn: float = R.COST_FALSE_NEGATIVE, cost_fp: float = R.COST_FALSE_POSITIVE,
                            keys: Sequence[str] = (), expanded: bool = True) -> DataFrame:
    """One row per cutoff with precision/recall/specificity/f1/accuracy,
    expected cost ``(FN*cost_fn + FP*cost_fp)/n`` and flagged count; with
    ``expanded`` also approval rate, FPR and FNR.

    One pass: each row is bucketed to the number of cutoffs <= p, so the data
    is aggregated to <= #cutoffs+1 rows per group before any window.
    """
    d, k = _keys(df, keys)
    ts = sorted(float(t) for t in thresholds)
    pp, yy = F.col(p).cast("double"), F.col(y).cast("int")
    bucket = F.lit(0)
    for t in ts:
        bucket = bucket + F.when(pp >= F.lit(t), 1).otherwise(0)
    g = d.groupBy(*k, bucket.alias("_b")).agg(F.sum(yy).alias("_pos"), F.sum(1 - yy).alias("_neg"))
    # every aggregated row (<= #cutoffs+1 per group) meets every cutoff j:
    # rows flagged at cutoff j are those with bucket >= j
    grid = F.explode(F.array(*[F.struct(F.lit(i + 1).alias("_j"), F.lit(t).alias("threshold"))
                               for i, t in enumerate(ts)])).alias("_g")
    per = (g.select(*k, "_b", "_pos", "_neg", grid).select(*k, "_b", "_pos", "_neg", "_g.*")
           .groupBy(*k, "_j", "threshold")
           .agg(F.sum(F.when(F.col("_b") >= F.col("_j"), F.col("_pos")).otherwise(0)).alias("tp"),
                F.sum(F.when(F.col("_b") >= F.col("_j"), F.col("_neg")).otherwise(0)).alias("fp"),
                F.sum(F.when(F.col("_b") < F.col("_j"), F.col("_neg")).otherwise(0)).alias("tn"),
                F.sum(F.when(F.col("_b") < F.col("_j"), F.col("_pos")).otherwise(0)).alias("fn")))
    tp, fp, tn, fn = (F.col(c).cast("long") for c in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    precision = _div(tp, tp + fp)
    recall = _div(tp, tp + fn)
    f1 = F.when(precision.isNotNull() & recall.isNotNull() & (precision > 0) & (recall > 0),
                2 * precision * recall / (precision + recall)).otherwise(0.0)
    cols = [*k, "threshold", precision.alias("precision"), recall.alias("recall"),
            _div(tn, tn + fp).alias("specificity"), f1.alias("f1_score"),
            ((tp + tn) / n).alias("accuracy"),
            ((fn * cost_fn + fp * cost_fp) / n).alias("expected_cost_per_loan"),
            (tp + fp).alias("n_flagged_as_risky")]
    if expanded:
        cols += [((tn + fn) / n).alias("approval_rate"), _div(fp, fp + tn).alias("false_positive_rate"),
                 _div(fn, fn + tp).alias("false_negative_rate")]
    return _drop_all(per.select(*cols), k)


# E13
def recommend_threshold(table: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Row with the lowest expected cost; ties -> lowest cutoff."""
    keys = list(keys)
    cols = [c for c in table.columns if c not in keys]
    best = table.groupBy(*keys).agg(F.min_by(F.struct(*cols), F.struct("expected_cost_per_loan", "threshold"))
                                    .alias("_r"))
    return best.select(*keys, "_r.*")


# E14
def calibration_report(df: DataFrame, y: str = "y", p: str = "p", keys: Sequence[str] = ("model",),
                       n_bins: int = R.CALIBRATION_BINS) -> DataFrame:
    keys = list(keys)
    a = probability_scores(df, y, p, keys).select(*keys, "mean_probability", "brier_score")
    b = expected_calibration_error(df, y, p, n_bins, keys)
    return join_null_safe(a, b, keys) if keys else a.crossJoin(b)
