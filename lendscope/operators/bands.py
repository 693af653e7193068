"""Banding: quantile bins, fixed bands, half-open policy bands.

Bins are ``CASE`` expressions over edges that are either fixed or fitted
(exact quantiles, ``q + 1`` numbers per column), so assigning a band is a
narrow projection with no shuffle.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.operators.ordered import exact_quantiles


def cut_expr(c: Column, edges: Sequence[float], labels: Sequence[str], include_lowest: bool = True) -> Column:
    """``pd.cut`` semantics: bins (lo, hi], lowest edge inclusive, outside -> NULL."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need len(edges) - 1 labels")
    v = c.cast("double")
    expr = None
    for i, lab in enumerate(labels):
        lo, hi = float(edges[i]), float(edges[i + 1])
        lower_ok = (v >= lo) if (i == 0 and include_lowest) else (v > lo)
        cond = lower_ok & (v <= hi)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit(None).cast("string"))


# B2
def bin_into_bands(df: DataFrame, column: str, edges: Sequence[float], labels: Sequence[str],
                   out: str | None = None) -> DataFrame:
    return df.withColumn(out or f"{column}_band", cut_expr(F.col(column), edges, labels))


def quantile_edges(df: DataFrame, column: str, q: int = 4) -> list:
    """Exact linear-interpolated edges at 0, 1/q, ..., 1 (q + 1 numbers)."""
    probs = [i / q for i in range(q + 1)]
    rows = exact_quantiles(df, [column], probs).collect()
    by_p = {round(r["prob"], 12): r["value"] for r in rows}
    return [by_p[round(p, 12)] for p in probs]


# B1
def bin_into_quantiles(df: DataFrame, column: str, q: int = 4, labels: Sequence[str] | None = None,
                       out: str | None = None, edges: Sequence[float] | None = None) -> DataFrame:
    """``pd.qcut``: ties stay in one bin; duplicate edges collapse and the
    surviving bins are labelled Q1..Qm (or the first m given labels)."""
    e = list(edges) if edges is not None else quantile_edges(df, column, q)
    uniq = []
    for x in e:
        if x is None:
            continue
        if not uniq or x != uniq[-1]:
            uniq.append(x)
    name = out or f"{column}_q"
    if len(uniq) < 2:
        return df.withColumn(name, F.lit(None).cast("string"))
    m = len(uniq) - 1
    labs = list(labels)[:m] if labels is not None and len(uniq) == len(e) else [f"Q{i + 1}" for i in range(m)]
    return df.withColumn(name, cut_expr(F.col(column), uniq, labs))


# B3
def band_lookup_expr(p: Column, bands: Sequence[tuple]) -> Column:
    """Half-open ``[min, max)`` lookup over ordered bands ``(name, min, max, ...)``;
    anything unmatched (p < 0, NaN, >= last max) falls to the last band."""
    expr = None
    for b in bands:
        name, lo, hi = b[0], float(b[1]), float(b[2])
        cond = (p >= lo) & (p < hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(bands[-1][0]))


def band_lookup_join(df: DataFrame, p: str, bands: DataFrame, name_col: str, out: str) -> DataFrame:
    """Same lookup against a band *table* (e.g. loaded policy): a broadcast
    range join -- the policy table is bounded by #bands -- with the last
    band as fall-through."""
    b = bands.select(F.col(name_col).alias("_band"), F.col("min_probability").alias("_lo"),
                     F.col("max_probability").alias("_hi"))
    last = b.orderBy(F.desc("_lo")).limit(1).select(F.col("_band").alias("_last"))
    j = df.join(F.broadcast(b), (F.col(p) >= F.col("_lo")) & (F.col(p) < F.col("_hi")), "left")
    j = j.crossJoin(F.broadcast(last))  # one row
    return j.withColumn(out, F.coalesce("_band", "_last")).drop("_band", "_lo", "_hi", "_last")
