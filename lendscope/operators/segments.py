"""Borrower segmentation.

Clustering runs on MLlib (k-means, bisecting k-means, Gaussian mixture,
PCA).  Everything after the labels is grouped aggregation over the row
table plus small per-cluster tables (k rows): profile, names, tiers,
actions, comparison.  Cluster-validity indices are computed from per-cluster
sufficient statistics -- no pairwise distances between rows.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from typing import Sequence

import numpy as np
from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendscope import roles as R
from lendscope.operators.describe import mode_table
from lendscope.operators.hypothesis import safe_corr
from lendscope.operators.kmeans import as_model, best_of, fit_many
from lendscope.operators.ordered import join_null_safe

# ---------------------------------------------------------------------------
# Fixed values (must stay exactly as listed)
# ---------------------------------------------------------------------------
SEGMENT_NAMES = ["High Risk Borrowers", "Prime Borrowers", "High Debt Borrowers", "Credit Rebuilders",
                 "Young Professionals", "Moderate Risk Borrowers"]
RECOMMENDATION_FIELDS = ["lending_recommendation", "interest_rate_strategy", "underwriting_strategy",
                         "manual_review_requirement", "marketing_strategy", "portfolio_management_notes"]
RECOMMENDATIONS = {
    "Low Risk": [
        "Approve readily under standard terms; strong candidate for pre-approved offers.",
        "Offer at or below the base rate to remain competitive for this low-risk, high-value segment.",
        "Streamlined/automated underwriting; minimal additional documentation required.",
        "Not required except for loans above standard size limits.",
        "Prioritize for loyalty offers, rate-reduction refinancing, and referral programs.",
        "Low expected loss contribution; a larger share of this segment improves overall portfolio quality.",
    ],
    "Moderate Risk": [
        "Approve with standard conditions; monitor for early delinquency signals post-origination.",
        "Price at or slightly above the base rate to reflect moderate risk.",
        "Standard underwriting with routine income/employment verification.",
        "Spot-check a sample of applications; full review not required for most.",
        "Target with rate-competitive offers conditioned on maintaining/improving credit standing.",
        "Represents the core of the portfolio; track default-rate trend over time as an early-warning signal.",
    ],
    "High Risk": [
        "Approve selectively, typically with reduced principal or added conditions.",
        "Apply a meaningful rate markup to price in elevated risk.",
        "Enhanced underwriting: verify income and debt obligations directly rather than relying on self-reported figures.",
        "Recommend manual credit-analyst review before approval.",
        "Avoid broad promotional offers; consider secured or co-signed loan products instead.",
        "Cap this segment's share of total originations to manage aggregate expected loss.",
    ],
    "Very High Risk": [
        "Decline under standard policy; require an exception process for any approval.",
        "If approved via exception, price well above standard rates to reflect very high expected loss.",
        "Full manual underwriting with independent verification of every major input.",
        "Mandatory senior credit-analyst review for any exception approval.",
        "Do not target with acquisition marketing; consider credit-building/secured-product referrals instead.",
        "Minimize origination volume; concentration in this segment materially raises expected portfolio loss.",
    ],
    "Unknown": [
        "Insufficient outcome data to recommend a lending policy for this segment; treat as Moderate Risk pending more data.",
        "Price at the base rate until sufficient outcome data accumulates.",
        "Standard underwriting pending further validation.",
        "Recommend manual review until this segment's risk profile is validated with outcome data.",
        "Limit promotional targeting until risk profile is confirmed.",
        "Monitor closely as outcome data accumulates before setting portfolio limits.",
    ],
}
# ---------------------------------------------------------------------------


# G1
def fit_kmeans(df: DataFrame, k: int, features: str = "features", restarts: int = 10,
               seed: int = R.RANDOM_STATE, max_iter: int = 300):
    """(model, inertia) of the best of ``restarts`` k-means fits, all fitted in
    one pass over the rows per step (``operators/kmeans.py``)."""
    best = best_of(fit_many(df, [k], restarts, features, seed, max_iter))[k]
    return as_model(best.centers, features), best.inertia


# G2 (re-aimed: Lance-Williams merges over weighted micro-clusters)
LINKAGES = ("ward", "average", "complete")


def merge_tree(points: np.ndarray, weights: np.ndarray, linkage: str = "ward") -> list[tuple[int, int, float, float]]:
    """(a, b, height, weight) of the agglomerative merges of weighted points,
    lowest first; merge i makes cluster len(points) + i.  Nearest-neighbour
    chain with Lance-Williams updates: m^2 work and memory for m points.
    Heights are distances, for Ward sqrt(2 wa wb / (wa + wb)) times the
    distance of the centroids."""
    if linkage not in LINKAGES:
        raise ValueError(f"unknown linkage '{linkage}'")
    m = len(points)
    w = np.asarray(weights, dtype=float).copy()
    sq = (points * points).sum(1)
    d = np.maximum(0.0, sq[:, None] + sq[None, :] - 2 * points @ points.T)
    d = d * (2 * w[:, None] * w[None, :] / (w[:, None] + w[None, :])) if linkage == "ward" else np.sqrt(d)
    np.fill_diagonal(d, np.inf)
    alive, chain, merges = np.ones(m, dtype=bool), [], []
    while len(merges) < m - 1:
        if not chain:
            chain.append(int(np.flatnonzero(alive)[0]))
        a = chain[-1]
        b = int(d[a].argmin())
        if len(chain) > 1 and d[a, chain[-2]] <= d[a, b]:
            b = chain[-2]
        if len(chain) < 2 or b != chain[-2]:
            chain.append(b)
            continue
        del chain[-2:]
        a, b = min(a, b), max(a, b)
        merges.append((a, b, float(np.sqrt(d[a, b]) if linkage == "ward" else d[a, b]), w[a] + w[b]))
        if linkage == "ward":
            total = w[a] + w[b] + w
            with np.errstate(invalid="ignore"):
                new = ((w[a] + w) * d[a] + (w[b] + w) * d[b] - w * d[a, b]) / total
        elif linkage == "average":
            new = (w[a] * d[a] + w[b] * d[b]) / (w[a] + w[b])
        else:
            new = np.maximum(d[a], d[b])
        alive[b] = False
        new[~alive] = np.inf
        new[a] = np.inf
        d[a], d[:, a] = new, new
        d[b], d[:, b] = np.inf, np.inf
        w[a] += w[b]
    # the chain finds merges out of order; by height, with the ids of the clusters they join
    name, out = list(range(m)), []
    for i, (a, b, height, weight) in enumerate(sorted(merges, key=lambda t: t[2])):
        out.append((name[a], name[b], height, weight))
        name[a] = m + i
    return out


def cut_tree(merges: Sequence[tuple], m: int, k: int) -> list[int]:
    """Cluster 0 .. k - 1 of each of ``m`` points, numbered by their first point."""
    parent = {}
    for i, (a, b, *_) in enumerate(merges[:max(0, m - k)]):
        parent[a] = parent[b] = m + i
    roots = []
    for p in range(m):
        while p in parent:
            p = parent[p]
        roots.append(p)
    number = {r: i for i, r in enumerate(dict.fromkeys(roots))}
    return [number[r] for r in roots]


def fit_hierarchical(df: DataFrame, k: int, features: str = "features", micro: int = 256,
                     seed: int = R.RANDOM_STATE, linkage: str = "ward"):
    """Agglomerative clustering (Ward, average or complete) without a distance
    matrix of the rows: where the table has at most ``micro`` different rows
    these are merged themselves (the exact result), else k-means makes
    ``micro`` weighted micro-clusters on Spark, whose centroids are merged on
    the driver (micro x micro); labels are mapped back per row.
    Returns (labelled DataFrame, [(a, b, height, weight)])."""
    vec = vector_to_array(features)
    few = df.groupBy(vec.alias("_v")).agg(F.count(F.lit(1)).alias("n")).orderBy("_v").limit(micro + 1).collect()
    if len(few) <= micro:
        points, weights = np.array([r["_v"] for r in few], dtype=float), np.array([r["n"] for r in few], dtype=float)
        labels = df.sparkSession.createDataFrame(
            [(r["_v"], i) for i, r in enumerate(few)], "_v array<double>, _micro int")
        lab = df.withColumn("_v", vec).join(F.broadcast(labels), "_v").drop("_v")         # at most micro rows
    else:
        fitted = fit_many(df, [micro], 1, features, seed, max_iter=50)[0]
        lab = as_model(fitted.centers, features, "_micro").transform(df)
        sizes = {r["_micro"]: r["count"] for r in lab.groupBy("_micro").count().collect()}
        points = fitted.centers
        weights = np.array([sizes.get(i, 0) for i in range(micro)], dtype=float)
    held = np.flatnonzero(weights)
    merges = merge_tree(points[held], weights[held], linkage)
    number = dict(zip(held.tolist(), cut_tree(merges, len(held), k)))
    m = F.create_map(*[x for a, b in number.items() for x in (F.lit(a), F.lit(b))])
    return lab.withColumn("cluster", m[F.col("_micro")]).drop("_micro"), merges


# G3
def fit_gmm(df: DataFrame, k: int, features: str = "features", seed: int = R.RANDOM_STATE):
    from lendscope.session import right_size
    rows = right_size(df.select(features)).persist()      # read again by every iteration
    m = GaussianMixture(k=k, featuresCol=features, predictionCol="cluster", probabilityCol="membership",
                        seed=seed).fit(rows)
    rows.unpersist()
    return m


# G5
def pca_coordinates(df: DataFrame, features: str = "features", k: int = 2):
    """Centred PCA (MLlib PCA does not centre): returns (model, coords DF, explained variance)."""
    sc = StandardScaler(inputCol=features, outputCol="_centred", withMean=True, withStd=False).fit(df)
    c = sc.transform(df)
    pca = PCA(k=k, inputCol="_centred", outputCol="_pc").fit(c)
    out = pca.transform(c).withColumn("_arr", vector_to_array("_pc"))
    out = out.select("*", *[F.col("_arr")[i].alias(f"pc{i + 1}") for i in range(k)]).drop("_arr", "_pc", "_centred")
    return pca, out, list(pca.explainedVariance.toArray())


# G6
def silhouette_squared_euclidean(df: DataFrame, features: str = "features", cluster: str = "cluster") -> float:
    """MLlib silhouette (squared Euclidean, O(n k)); not comparable with the
    Euclidean silhouette of a pairwise implementation."""
    return ClusteringEvaluator(featuresCol=features, predictionCol=cluster, metricName="silhouette",
                               distanceMeasure="squaredEuclidean").evaluate(df)


def to_long(df: DataFrame, features: str, cluster: str = "cluster", id_col: str = "row_id",
            is_vector: bool = True) -> DataFrame:
    arr = vector_to_array(features) if is_vector else F.col(features)
    return df.select(F.col(id_col).alias("row_id"), F.col(cluster).alias("cluster"),
                     F.posexplode(arr).alias("pos", "x")).withColumn("x", F.col("x").cast("double"))


# G16
def centroids_long(long: DataFrame) -> DataFrame:
    return long.groupBy("cluster", "pos").agg(F.avg("x").alias("c"), F.count(F.lit(1)).alias("n"))


def centroids(long: DataFrame) -> DataFrame:
    """(cluster, center array) -- d values per cluster."""
    cl = centroids_long(long)
    return (cl.groupBy("cluster")
            .agg(F.sort_array(F.collect_list(F.struct("pos", "c"))).alias("_s"))
            .select("cluster", F.transform("_s", lambda s: s["c"]).alias("center")))


# G7
def calinski_harabasz(long: DataFrame) -> DataFrame:
    cl = centroids_long(long)
    overall = long.groupBy("pos").agg(F.avg("x").alias("g"))
    sizes = long.groupBy("cluster").agg(F.countDistinct("row_id").alias("nc"))
    b = (cl.join(overall, "pos").join(sizes, "cluster")
         .agg(F.sum(F.col("nc") * F.pow(F.col("c") - F.col("g"), 2)).alias("B")))
    w = long.join(F.broadcast(cl.select("cluster", "pos", "c")), ["cluster", "pos"]) \
        .agg(F.sum(F.pow(F.col("x") - F.col("c"), 2)).alias("W"))  # centroid table: k x d
    kn = sizes.agg(F.count(F.lit(1)).alias("k"), F.sum("nc").alias("n"))
    j = b.crossJoin(w).crossJoin(kn)  # three one-row tables
    return j.select(F.when((F.col("k") > 1) & (F.col("W") > 0),
                           (F.col("B") / (F.col("k") - 1)) / (F.col("W") / (F.col("n") - F.col("k"))))
                    .alias("calinski_harabasz"))


# G8
def davies_bouldin(long: DataFrame) -> DataFrame:
    cl = centroids_long(long).select("cluster", "pos", "c")
    d = (long.join(F.broadcast(cl), ["cluster", "pos"])
         .groupBy("cluster", "row_id").agg(F.sqrt(F.sum(F.pow(F.col("x") - F.col("c"), 2))).alias("dist")))
    s = d.groupBy("cluster").agg(F.avg("dist").alias("s"))
    a, b = cl.alias("a"), cl.alias("b")
    pair = (a.join(b, (F.col("a.pos") == F.col("b.pos")) & (F.col("a.cluster") != F.col("b.cluster")))
            .groupBy(F.col("a.cluster").alias("ci"), F.col("b.cluster").alias("cj"))
            .agg(F.sqrt(F.sum(F.pow(F.col("a.c") - F.col("b.c"), 2))).alias("dij")))  # k x k rows
    si, sj = s.select(F.col("cluster").alias("ci"), F.col("s").alias("si")), \
        s.select(F.col("cluster").alias("cj"), F.col("s").alias("sj"))
    r = pair.join(si, "ci").join(sj, "cj").withColumn(
        "rij", F.when(F.col("dij") > 0, (F.col("si") + F.col("sj")) / F.col("dij")))
    return r.groupBy("ci").agg(F.max("rij").alias("m")).agg(F.avg("m").alias("davies_bouldin"))


# G9
def evaluate_clustering(df: DataFrame, features: str = "features", cluster: str = "cluster",
                        id_col: str = "row_id", noise_label: int = -1) -> DataFrame:
    """silhouette (squared Euclidean), Calinski-Harabasz, Davies-Bouldin;
    noise rows dropped; fewer than 2 clusters -> NULLs."""
    d = df.filter(F.col(cluster) != noise_label)
    k = d.select(cluster).distinct().count()  # #clusters
    spark = df.sparkSession
    if k < 2:
        return spark.createDataFrame([(int(k), None, None, None)],
                                     "n_clusters long, silhouette double, calinski_harabasz double, davies_bouldin double")
    sil = silhouette_squared_euclidean(d, features, cluster)
    ch, db = validity_indices(d, features, cluster, id_col)
    return spark.createDataFrame([(int(k), float(sil), ch, db)],
                                 "n_clusters long, silhouette double, calinski_harabasz double, davies_bouldin double")


def validity_indices(df: DataFrame, features: str, cluster: str, id_col: str) -> tuple[float | None, float | None]:
    """(Calinski-Harabasz, Davies-Bouldin) as of the long tables above, from the
    whole vectors: one pass for the centroids, one for the rows' distances to
    them (a row per id is shuffled, not one per value); k rows are collected."""
    v = df.select(F.col(id_col).alias("row_id"), F.col(cluster).alias("cluster"), vector_to_array(features).alias("v"))
    dims = v.select(F.size("v")).first()[0]
    cents = v.groupBy("cluster").agg(F.array(*[F.avg(F.col("v")[i]) for i in range(dims)]).alias("c"),
                                     F.count(F.lit(1)).alias("rows"))
    far = F.aggregate(F.zip_with("v", "c", lambda x, c: (x - c) * (x - c)), F.lit(0.0), lambda s, x: s + x)
    each = (v.join(F.broadcast(cents), "cluster").groupBy("cluster", "row_id")              # centroid table: k x d
            .agg(F.sum(far).alias("sq"), F.first("c").alias("c"), F.first("rows").alias("rows")))
    per = each.groupBy("cluster").agg(F.count("row_id").alias("n"), F.sum("sq").alias("w"), F.avg(F.sqrt("sq")).alias("s"),
                                      F.first("c").alias("c"), F.first("rows").alias("rows")).collect()  # k rows
    c, rows, n, s = (np.array([r[x] for r in per], dtype=float) for x in ("c", "rows", "n", "s"))
    w, k = float(sum(r["w"] for r in per)), len(per)
    mean = rows @ c / rows.sum()
    ch = None
    if not w <= 0 and n.sum() > k:
        ch = float((n[:, None] * (c - mean) ** 2).sum() / (k - 1) / (w / (n.sum() - k)))
    apart = np.sqrt(((c[:, None] - c[None]) ** 2).sum(2))
    worst = [max(((s[i] + s[j]) / apart[i, j] for j in range(k) if not apart[i, j] <= 0), default=None) for i in range(k)]
    seen = [x for x in worst if x is not None]
    return ch, float(np.mean(seen)) if seen else None


# G10 / G11
def evaluate_optimal_k(df: DataFrame, k_values: Sequence[int] = R.K_CANDIDATES, features: str = "features",
                       id_col: str = "row_id", restarts: int = 10, seed: int = R.RANDOM_STATE) -> DataFrame:
    """k-means per candidate k (all k and restarts in one pass per step):
    inertia + validity indices, one row per k."""
    best = sorted(best_of(fit_many(df, k_values, restarts, features, seed)).items())

    def row(at):
        k, fitted = at
        r = evaluate_clustering(as_model(fitted.centers, features).transform(df), features, "cluster", id_col).first()
        return int(k), float(fitted.inertia), r["silhouette"], r["calinski_harabasz"], r["davies_bouldin"]

    with ThreadPoolExecutor(max_workers=4) as ex:                       # independent passes over the rows
        rows = list(ex.map(row, best))
    return df.sparkSession.createDataFrame(
        rows, "k int, inertia double, silhouette double, calinski_harabasz double, davies_bouldin double").coalesce(1)


def recommend_optimal_k(table: DataFrame) -> DataFrame:
    """Average of the silhouette (desc), CH (desc) and DB (asc) ranks, ties
    averaged; smallest average wins, ties -> smallest k.  Table has one row per k."""
    def avg_rank(col, desc):
        o = F.desc(col) if desc else F.asc(col)
        w = Window.orderBy(o)  # over the <= #candidates rows of the sweep table
        peers = Window.partitionBy(col)
        return F.rank().over(w) + (F.count(F.lit(1)).over(peers) - 1) / 2.0
    t = (table.withColumn("r_sil", avg_rank("silhouette", True))
         .withColumn("r_ch", avg_rank("calinski_harabasz", True))
         .withColumn("r_db", avg_rank("davies_bouldin", False))
         .withColumn("avg_rank", (F.col("r_sil") + F.col("r_ch") + F.col("r_db")) / 3))
    return t.agg(F.min_by("k", F.struct("avg_rank", "k")).alias("recommended_k"))


# G15
def assign_nearest(df: DataFrame, vec: Column, centers: dict, out: str = "cluster") -> DataFrame:
    """Nearest centroid by squared Euclidean distance, ties -> lowest id.
    ``centers`` (cluster -> list) is bounded by #clusters x #dims and inlined."""
    ids = sorted(centers)
    cands = F.array(*[F.struct(F.lit(int(c)).alias("id"),
                               F.array(*[F.lit(float(v)) for v in centers[c]]).alias("ctr")) for c in ids])
    dist = F.transform(cands, lambda s: F.struct(
        F.aggregate(F.zip_with(s["ctr"], vec, lambda a, b: F.pow(a - b, 2)), F.lit(0.0), lambda acc, x: acc + x)
        .alias("d"), s["id"].alias("id")))
    return df.withColumn(out, F.array_min(dist)["id"])


# G17
def cluster_profile(df: DataFrame, cluster: str = "cluster", target: str | None = R.TARGET_COLUMN,
                    numeric: Sequence[str] = R.PROFILE_NUMERIC_COLUMNS,
                    categorical: Sequence[str] = R.PROFILE_CATEGORICAL_COLUMNS) -> DataFrame:
    """n, share, mean of numerics, mode of categoricals (smallest on ties),
    default rate (NULL without an outcome column)."""
    num = [c for c in numeric if c in df.columns]
    cat = [c for c in categorical if c in df.columns]
    g = df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n_borrowers"), *[F.avg(c).alias(c) for c in num],
        (F.avg(F.col(target).cast("double")) if target and target in df.columns
         else F.lit(None).cast("double")).alias("average_default_rate"))
    tot = g.agg(F.sum("n_borrowers").alias("_t"))
    g = g.crossJoin(F.broadcast(tot)).withColumn("pct_of_portfolio", F.col("n_borrowers") / F.col("_t")).drop("_t")
    if cat:
        modes = mode_table(df, cat, group=cluster).groupBy(cluster).pivot("column", cat).agg(F.first("mode"))
        g = join_null_safe(g, modes, [cluster], "left")
    return g.withColumnRenamed(cluster, "cluster_id")


# G18
def assign_segment_names(profile: DataFrame) -> DataFrame:
    """Data-driven names from population z-scores across clusters (k rows,
    collected): risk, prime, high debt, credit rebuilders, young
    professionals, then moderate risk numbered by risk."""
    rows = [r.asDict() for r in profile.collect()]  # one row per cluster
    ids = sorted(r["cluster_id"] for r in rows)
    by = {r["cluster_id"]: r for r in rows}

    def z(col):
        vals = [by[i].get(col) for i in ids]
        if all(v is None for v in vals):
            return {i: 0.0 for i in ids}
        xs = [v for v in vals if v is not None]
        mu = sum(xs) / len(xs)
        sd = math.sqrt(sum((x - mu) ** 2 for x in xs) / len(xs))
        if sd == 0:
            return {i: 0.0 for i in ids}
        return {i: ((by[i].get(col) - mu) / sd if by[i].get(col) is not None else float("nan")) for i in ids}

    if any(by[i].get("average_default_rate") is not None for i in ids):
        risk = z("average_default_rate")
    else:
        zi, zd = z("int_rate"), z("dti")
        risk = {i: (zi[i] + zd[i]) / 2 for i in ids}
    inc, dti, emp, util = z("annual_inc"), z("dti"), z("emp_length_years"), z("revol_util")
    remaining = list(ids)
    names = {}

    def pick(score, cond, name):
        if not remaining:
            return
        cand = max(remaining, key=lambda i: (score[i], -i))
        if cond(cand):
            names[cand] = name
            remaining.remove(cand)

    pick(risk, lambda c: risk[c] > 0.5, SEGMENT_NAMES[0])
    pick({i: -risk[i] + inc[i] for i in ids}, lambda c: risk[c] < 0 and inc[c] > 0, SEGMENT_NAMES[1])
    pick(dti, lambda c: dti[c] > 0.5, SEGMENT_NAMES[2])
    pick({i: -util[i] for i in ids}, lambda c: util[c] < -0.3 and risk[c] <= 0.5, SEGMENT_NAMES[3])
    pick({i: -emp[i] + inc[i] for i in ids}, lambda c: emp[c] < 0 and inc[c] > 0, SEGMENT_NAMES[4])
    rest = sorted(remaining, key=lambda c: (risk[c], c))
    for n, c in enumerate(rest):
        names[c] = SEGMENT_NAMES[5] + (f" ({n + 1})" if len(rest) > 1 else "")
    spark = profile.sparkSession
    return spark.createDataFrame([(int(c), names[c]) for c in ids], "cluster_id int, segment_name string")


# G19
def risk_tier_lookup(mean_p: DataFrame | None, profile: DataFrame, policy=None) -> DataFrame:
    """Tier of the cluster's mean predicted probability (policy bands); else
    of its default rate; else 'Unknown'."""
    from lendscope.operators.policy import RiskPolicy
    pol = policy or RiskPolicy()
    base = profile.select("cluster_id", "average_default_rate")
    if mean_p is not None:
        base = join_null_safe(base, mean_p.select("cluster_id", "mean_predicted_probability"), ["cluster_id"], "left")
    else:
        base = base.withColumn("mean_predicted_probability", F.lit(None).cast("double"))
    tier = F.when(F.col("mean_predicted_probability").isNotNull(), pol.tier_expr(F.col("mean_predicted_probability"))) \
        .when(F.col("average_default_rate").isNotNull(), pol.tier_expr(F.col("average_default_rate"))) \
        .otherwise(F.lit("Unknown"))
    return base.withColumn("risk_tier", tier)


# G20
def segment_actions(tiers: DataFrame) -> DataFrame:
    """Six recommendation texts per cluster keyed on its tier ('Unknown' default)."""
    out = tiers
    for i, f in enumerate(RECOMMENDATION_FIELDS):
        m = F.create_map(*[x for t, texts in RECOMMENDATIONS.items() for x in (F.lit(t), F.lit(texts[i]))])
        out = out.withColumn(f, F.coalesce(m[F.col("risk_tier")], F.lit(RECOMMENDATIONS["Unknown"][i])))
    return out


# G21 / G22
def segment_comparison_table(profile: DataFrame, names: DataFrame, tiers: DataFrame) -> DataFrame:
    j = profile.join(names, "cluster_id", "left").join(tiers.select("cluster_id", "risk_tier"), "cluster_id", "left")
    t = j.select("cluster_id",
                 F.coalesce("segment_name", F.concat(F.lit("Cluster "), F.col("cluster_id").cast("string"))).alias("segment_name"),
                 "n_borrowers", "pct_of_portfolio", F.col("annual_inc").alias("typical_income"),
                 F.col("int_rate").alias("typical_interest_rate"), F.col("grade").alias("typical_loan_grade"),
                 F.col("dti").alias("typical_dti"), F.col("emp_length_years").alias("typical_employment_length"),
                 "average_default_rate", "risk_tier",
                 F.col("loan_amnt").alias("typical_loan_amount"), F.col("home_ownership").alias("typical_home_ownership"),
                 F.col("purpose").alias("typical_loan_purpose"))
    # by default rate; when no segment has one, the interest rate decides
    return t.orderBy(F.desc_nulls_last("average_default_rate"), F.desc_nulls_last("typical_interest_rate"))


def segment_description(t: DataFrame) -> DataFrame:
    rate = F.when(F.col("average_default_rate").isNotNull(),
                  F.concat(F.lit("an average default rate of "),
                           F.format_string("%.1f%%", F.col("average_default_rate") * 100))) \
        .otherwise(F.lit("an unknown default rate (no outcome data available)"))
    txt = F.concat(
        F.col("segment_name"), F.lit(" ("), F.format_number(F.col("n_borrowers"), 0), F.lit(" borrowers, "),
        F.format_string("%.1f%%", F.col("pct_of_portfolio") * 100), F.lit(" of the portfolio) typically have $"),
        F.format_number(F.col("typical_income"), 0), F.lit(" in annual income, a "),
        F.format_string("%.1f", F.col("typical_dti")), F.lit("% debt-to-income ratio, and take $"),
        F.format_number(F.col("typical_loan_amount"), 0), F.lit(" loans at a "),
        F.format_string("%.1f", F.col("typical_interest_rate")), F.lit("% interest rate (typical grade: "),
        F.col("typical_loan_grade"), F.lit("). Most are "), F.lower("typical_home_ownership"),
        F.lit(" homeowners/renters seeking loans for "), F.replace("typical_loan_purpose", F.lit("_"), F.lit(" ")),
        F.lit(", with "), F.format_string("%.1f", F.col("typical_employment_length")),
        F.lit(" years of typical employment tenure. This segment shows "), rate,
        F.lit(" and is classified as "), F.col("risk_tier"), F.lit("."))
    return t.withColumn("description", txt)


def riskiest_and_safest(t: DataFrame) -> DataFrame:
    key = F.coalesce("average_default_rate", "typical_interest_rate")
    return t.agg(F.max_by("segment_name", F.struct(key, -F.col("cluster_id"))).alias("riskiest_segment"),
                 F.min_by("segment_name", F.struct(key, F.col("cluster_id"))).alias("safest_segment"))


# G23 / G24
def compare_with_supervised(scored: DataFrame, comparison: DataFrame, cluster: str = "cluster",
                            p: str = "p") -> DataFrame:
    mp = scored.groupBy(F.col(cluster).alias("cluster_id")).agg(F.avg(p).alias("mean_predicted_probability"))
    return (comparison.select("cluster_id", "segment_name", "average_default_rate")
            .join(mp, "cluster_id", "left").orderBy(F.desc_nulls_last("mean_predicted_probability")))


def probability_by_cluster(scores_long: DataFrame, cluster: str = "cluster", model: str = "model",
                           p: str = "p", target: str = R.TARGET_COLUMN) -> DataFrame:
    """Per cluster: mean and sample std of p for each model next to the default rate."""
    stats = scores_long.groupBy(cluster, model).agg(F.avg(p).alias("mean_p"), F.stddev_samp(p).alias("std_p"))
    rate = scores_long.groupBy(cluster, model).agg(F.avg(F.col(target).cast("double")).alias("default_rate"))
    return stats.join(rate, [cluster, model])


def probability_rate_correlation(by_cluster: DataFrame, model: str = "model") -> DataFrame:
    return by_cluster.groupBy(model).agg(safe_corr(F.col("mean_p"), F.col("default_rate")).alias("corr_with_default_rate"))
