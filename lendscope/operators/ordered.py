"""Exact order statistics at scale: prefix counts, ranks and quantiles.

Spark's exact ``percentile`` aggregate keeps every distinct value of a group
in one buffer, and a window ``orderBy`` without ``partitionBy`` runs in one
task.  One path serves every size here:

1. rows collapse to distinct ``(key, value)`` with counts (partial aggregation
   before the shuffle, so a value holding a third of all rows is one row);
2. these are range-partitioned by ``(key, value)`` and written with their
   partition number, so the cut stays the same if a task is run again;
3. a window per ``(partition, key)`` gives the running totals inside a
   partition; a window per key over the partition totals (at most one row per
   partition and key) gives each partition's offset and the key's total.

Result: for every distinct value, the exact number (and weight) of rows with
a strictly smaller value.  Exact quantiles, average ranks, ROC-AUC, average
precision and ROC/PR curves are all read off that table.
"""

from __future__ import annotations

import math
from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendscope.session import written


def unpivot_numeric(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (),
                    name_col: str = "column", value_col: str = "value",
                    drop_nulls: bool = True) -> DataFrame:
    """Long form ``(keep..., column, value double)``; NaN becomes NULL."""
    vals = [F.struct(F.lit(c).alias(name_col),
                     F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
                     .alias(value_col)) for c in cols]
    out = df.select(*keep, F.inline(F.array(*vals)))
    if drop_nulls:
        out = out.filter(F.col(value_col).isNotNull())
    return out


def ordered_counts(long_df: DataFrame, keys: Sequence[str], value: str, sums: dict | None = None,
                   totals: bool = False) -> DataFrame:
    """Distinct ``(keys, value)`` rows with ``c`` (row count), optional weight
    sums, and ``c_before`` / ``<sum>_before``: totals over strictly smaller
    values within the same key; with ``totals`` also ``c_total`` /
    ``<sum>_total`` of the key.

    ``sums`` maps output name -> Column evaluated on ``long_df`` rows.
    """
    keys = list(keys)
    sums = dict(sums or {})
    measures = ["c"] + list(sums)
    d = long_df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("c"), *[F.sum(e).alias(n) for n, e in sums.items()])
    parts = int(long_df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = written(d.repartitionByRange(parts, *keys, value).withColumn("_part", F.spark_partition_id()), "ordered")
    inside = Window.partitionBy("_part", *keys).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.select(*keys, value, "_part", *measures,
                          *[F.coalesce(F.sum(m).over(inside), F.lit(0)).alias(f"_{m}_local") for m in measures])
    part_sums = placed.groupBy("_part", *keys).agg(*[F.sum(m).alias(f"_{m}_part") for m in measures])
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = part_sums.select("_part", *keys,
                               *[F.coalesce(F.sum(f"_{m}_part").over(earlier), F.lit(0)).alias(f"_{m}_off") for m in measures],
                               *[F.sum(f"_{m}_part").over(whole).alias(f"{m}_total") for m in measures])
    out = join_null_safe(local, offsets, ["_part", *keys])
    return out.select(*keys, value, *measures,
                      *[(F.col(f"_{m}_off") + F.col(f"_{m}_local")).alias(f"{m}_before") for m in measures],
                      *([f"{m}_total" for m in measures] if totals else []))


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "inner") -> DataFrame:
    """Join on ``keys`` treating NULL = NULL (group keys may be NULL)."""
    keys = list(keys)
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys]
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    group_cols: Sequence[str] = (), long_df: DataFrame | None = None) -> DataFrame:
    """Linear-interpolated quantiles (numpy/pandas default), exact.

    Returns ``(group_cols..., column, prob, value)``; NULL/NaN skipped.  The
    order statistics on either side of a quantile are the values whose ranks
    cover its position, so no join is needed.
    """
    keys = list(group_cols) + ["column"]
    long = long_df if long_df is not None else unpivot_numeric(df, cols, keep=list(group_cols))
    cnt = ordered_counts(long, keys, "value", totals=True)

    def covers(rank):
        return (rank >= F.col("c_before")) & (rank < F.col("c_before") + F.col("c"))

    h = {float(p): (F.col("c_total") - 1) * F.lit(float(p)) for p in probs}
    near = reduce(lambda a, b: a | b, [covers(F.floor(x)) | covers(F.ceil(x)) for x in h.values()])
    hit = (cnt.filter(near)
           .select("*", F.explode(F.array(*[F.struct(F.lit(p).alias("prob"), x.alias("h")) for p, x in h.items()])).alias("q"))
           .select(*keys, "value", "c", "c_before", "q.*"))
    res = hit.groupBy(*keys, "prob").agg(
        F.max(F.col("h") - F.floor("h")).alias("part"),
        F.max(F.when(covers(F.floor("h")), F.col("value"))).alias("v_lo"),
        F.max(F.when(covers(F.ceil("h")), F.col("value"))).alias("v_hi"))
    return res.select(*keys, "prob", (F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * F.col("part")).alias("value"))


def set_medians(df: DataFrame, cols: Sequence[str], cell: str, sets: dict) -> dict:
    """Exact medians ``{(set, column): value}`` of many overlapping sets of rows,
    NULL/NaN skipped.  A row lies in one cell; ``sets`` maps a set to its cells.

    Sets drawn from one table have medians close to its own, so only the values
    between two cuts near it are ranked for every set; the rows below are
    counted per cell.  The cuts set the cost alone: where a set's middle ranks
    lie outside (which the counts tell), the whole column is ranked."""
    cols, keys = list(cols), list(sets)
    v = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in cols}
    n = {r[cell]: r for r in df.groupBy(cell).agg(*[F.count(x).alias(c) for c, x in v.items()]).collect()}
    size = {(k, c): sum(n[x][c] for x in cells if x in n) for k, cells in sets.items() for c in cols}
    # six standard errors of the rank of a median, and the error of the sketch
    least = {c: min([size[k, c] for k in keys if size[k, c]], default=0) for c in cols}
    half = {c: 3.0 / math.sqrt(m) + 0.001 for c, m in least.items() if m and 3.0 / math.sqrt(m) + 0.001 < 0.5}
    cuts = {}
    if half:
        near = df.agg(*[F.percentile_approx(v[c], [0.5 - w, 0.5 + w], 10000).alias(c) for c, w in half.items()]).first()
        cuts = {c: near[c] for c in half if near[c]}
        below = {r[cell]: r for r in df.groupBy(cell).agg(*[x for c, (lo, hi) in cuts.items() for x in (
            F.count(F.when(v[c] < lo, 1)).alias(f"{c}__lo"), F.count(F.when(v[c] <= hi, 1)).alias(f"{c}__hi"))]).collect()} if cuts else {}

    def passed(k, c, end):
        return sum(below[x][f"{c}__{end}"] for x in sets[k] if x in below)

    cuts = {c: cut for c, cut in cuts.items()
            if all(not size[k, c] or (passed(k, c, "lo") <= (size[k, c] - 1) // 2 and size[k, c] // 2 < passed(k, c, "hi"))
                   for k in keys)}
    want = [(i, c, *(r - (passed(k, c, "lo") if c in cuts else 0) for r in ((size[k, c] - 1) // 2, size[k, c] // 2)))
            for i, k in enumerate(keys) for c in cols if size[k, c]]
    if not want:
        return {}
    kept = [F.when(v[c].between(*cuts[c]), v[c]) if c in cuts else v[c] for c in cols]
    long = df.select(cell, F.inline(F.array(*[F.struct(F.lit(c).alias("column"), x.alias("value")) for c, x in zip(cols, kept)])))
    long = long.filter(F.col("value").isNotNull()).groupBy(cell, "column", "value").agg(F.count(F.lit(1)).alias("_rows"))
    spark = df.sparkSession
    in_sets = spark.createDataFrame([(x, [i for i, k in enumerate(keys) if x in sets[k]]) for x in n],
                                    f"{cell} {df.schema[cell].dataType.simpleString()}, _sets array<int>")    # #cells rows
    long = long.join(F.broadcast(in_sets), cell).select(F.explode("_sets").alias("_set"), "column", "value", "_rows")
    cnt = ordered_counts(long, ["_set", "column"], "value", sums={"n": F.col("_rows")})
    ranks = spark.createDataFrame(want, "_set int, column string, _lo long, _hi long")            # #sets x #columns rows

    def value_at(rank):
        return F.max(F.when((rank >= F.col("n_before")) & (rank < F.col("n_before") + F.col("n")), F.col("value")))

    hit = (cnt.join(F.broadcast(ranks), ["_set", "column"])
           .filter((F.col("_hi") >= F.col("n_before")) & (F.col("_lo") < F.col("n_before") + F.col("n")))
           .groupBy("_set", "column").agg(value_at(F.col("_lo")).alias("lo"), value_at(F.col("_hi")).alias("hi")))
    return {(keys[r["_set"]], r["column"]): r["lo"] + (r["hi"] - r["lo"]) * 0.5 if r["lo"] != r["hi"] else r["lo"]
            for r in hit.collect()}


def quantile_table_wide(q: DataFrame, keys: Sequence[str], probs: Sequence[float],
                        names: Sequence[str]) -> DataFrame:
    """Pivot ``exact_quantiles`` output to one column per probability."""
    keys = list(keys)
    return q.groupBy(*keys).agg(*[
        F.max(F.when(F.col("prob") == float(p), F.col("value"))).alias(nm)
        for p, nm in zip(probs, names)])


def average_ranks(long_df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """``(keys, value, rank)`` with tied values sharing their average 1-based rank."""
    cnt = ordered_counts(long_df, keys, value)
    return cnt.select(*keys, value, (F.col("c_before") + (F.col("c") + 1) / 2.0).alias("rank"))


def collect_small(df: DataFrame, limit: int = 100000) -> list:
    """Collect a table whose size is bounded by design (#columns, #clusters,
    #thresholds, #policy bands); raises if the bound is violated."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"expected a small table (<= {limit} rows)")
    return rows
