"""Nearest neighbours by inner product with an adaptive dimension scan.

Vectors get one more coordinate that makes nearest in distance the same as
largest in inner product, are rotated at random and dealt to inverted lists.
A query probes its nearest lists.  Within a list, candidates are read in
column blocks of the rotated coordinates: after each block a hypothesis test
on the partial distance abandons the candidates that are unlikely to come
within the distance of the k-th best so far.  What is left is scored exactly
on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendscope.llm.common import materialize

K = 20
SAMPLE_ROWS = 20_000      # bound of the sample that centroids are fitted on
MAX_LISTS = 4096
LIST_ROWS = 4096          # a longer list is cut into blocks of about so many vectors
QUERY_ROWS = 1024         # queries that meet a block in one task
TUNE_QUERIES = 64         # queries whose true neighbours set the number of probed lists
TARGET = 0.97             # share of those neighbours that the probed lists must hold
COLUMNS = 16
EPSILON = 2.1             # strictness of the test; the usual value of adaptive sampling
PAIRS = 200_000           # candidate pairs held at once


@dataclass
class Index:
    """What every task needs: bounded by MAX_LISTS and the dimension."""

    centroids: np.ndarray     # of augmented vectors
    rotation: np.ndarray
    top_norm: float           # largest squared norm of any vector


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v) of the vectors that take part: with id, not null or empty,
    no null or non-finite component, not zero, of the table's most frequent
    length (the smaller one in a tie).  Of rows that share an id the smallest
    vector counts."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"), F.size(v).alias("n"), fine.alias("fine"))
            .filter("vec_id is not null and v is not null and n > 0 and fine")
            .filter(F.exists("v", lambda x: x != 0)))
    length = rows.groupBy("n").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").first()
    return rows.filter(F.col("n") == (length.n if length else 0)).groupBy("vec_id").agg(F.min("v").alias("v"))


def augment(x: np.ndarray, top_norm: float) -> np.ndarray:
    rest = np.maximum(0.0, top_norm - (x * x).sum(1))
    return np.hstack([x, np.sqrt(rest)[:, None]])


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T)


def fit_index(vectors: DataFrame, n: int, sample_rows: int = SAMPLE_ROWS, rounds: int = 8) -> Index:
    """Centroids by k-means on a sample of at most ``sample_rows`` vectors
    taken by the hash of their id; about sqrt(n) lists."""
    top = vectors.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()[0]
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("v").toPandas()["v"]
    x = augment(np.array(sample.tolist(), dtype=float), top)
    lists = int(min(MAX_LISTS, max(1, round(n ** 0.5)), max(1, len(x) // 4)))
    rng = np.random.default_rng(0)
    centroids = x[rng.choice(len(x), lists, replace=False)].copy()
    for _ in range(rounds):
        near = np.concatenate([squared(x[i:i + 2048], centroids).argmin(1) for i in range(0, len(x), 2048)])
        count = np.bincount(near, minlength=lists)
        total = np.zeros_like(centroids)
        np.add.at(total, near, x)
        centroids[count > 0] = total[count > 0] / count[count > 0, None]
    rotation, _ = np.linalg.qr(rng.standard_normal((x.shape[1], x.shape[1])))
    return Index(centroids, rotation, float(top))


def assign(vectors: DataFrame, index: Index) -> DataFrame:
    """(vec_id, v, list): every vector with its nearest list."""

    def nearest(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if len(part):
                x = augment(np.array(part["v"].tolist(), dtype=float), index.top_norm)
                part["list"] = np.concatenate([squared(x[i:i + 1024], index.centroids).argmin(1)
                                               for i in range(0, len(x), 1024)])
                yield part

    return vectors.mapInPandas(nearest, "vec_id long, v array<double>, list long")


def query_lists(q: np.ndarray, index: Index) -> np.ndarray:
    """Lists of each query, nearest first."""
    zero = np.hstack([q, np.zeros((len(q), 1))])
    return np.argsort(squared(zero, index.centroids), axis=1, kind="stable")


def best(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of each row's k highest scores, ties to the smaller id."""
    order = np.lexsort((ids, -scores, rows))
    r = rows[order]
    start = np.concatenate(([0], np.flatnonzero(r[1:] != r[:-1]) + 1)) if len(r) else np.zeros(0, dtype=int)
    rank = np.arange(len(r)) - np.repeat(start, np.diff(np.concatenate((start, [len(r)]))))
    return order[rank < k]


def tune(vectors: DataFrame, queries: DataFrame, index: Index, k: int, target: float = TARGET) -> int:
    """Lists to probe so that ``target`` of the true neighbours of a few
    queries, found by brute force over all vectors, lie in them."""
    rows = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(TUNE_QUERIES).toPandas()
    q_ids, q = rows["vec_id"].to_numpy(), np.array(rows["v"].tolist(), dtype=float)
    place = np.argsort(query_lists(q, index), axis=1)       # rank of each list for each query

    def scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if not len(part):
                continue
            ids, lists = part["vec_id"].to_numpy(), part["list"].to_numpy()
            score = q @ np.array(part["v"].tolist(), dtype=float).T
            r, c = np.nonzero(q_ids[:, None] != ids[None, :])
            top = best(r, ids[c], score[r, c], k)
            yield pd.DataFrame({"q": r[top], "vec_id": ids[c[top]], "score": score[r[top], c[top]],
                                "place": place[r[top], lists[c[top]]]})

    near = W.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    found = (vectors.mapInPandas(scan, "q long, vec_id long, score double, place long")
             .withColumn("rank", F.row_number().over(near)).filter(F.col("rank") <= k).select("place").toPandas()["place"])
    return int(np.sort(found.to_numpy())[max(0, int(np.ceil(target * len(found))) - 1)]) + 1 if len(found) else 1


def scan_block(q_ids: np.ndarray, q: np.ndarray, limit: np.ndarray, ids: np.ndarray, x: np.ndarray, index: Index,
               k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, vector row, score) of each query's k best in one block.

    ``limit``: squared distance of the query's k-th best so far (infinite if
    unknown).  A partial distance over d of D coordinates rejects a candidate
    beyond limit * d/D * (1 + EPSILON / sqrt(d))^2.
    """
    qr = np.hstack([q, np.zeros((len(q), 1))]) @ index.rotation
    xr = augment(x, index.top_norm) @ index.rotation
    dim = xr.shape[1]
    out = []
    step = max(1, PAIRS // max(1, len(x)))
    for a in range(0, len(q), step):
        rows, cols = np.nonzero(q_ids[a:a + step, None] != ids[None, :])
        rows += a
        partial = np.zeros(len(rows))
        for d in range(0, dim, COLUMNS):
            end = min(dim, d + COLUMNS)
            if d == 0:                                      # the first block is dense
                partial = squared(qr[a:a + step, :end], xr[:, :end])[rows - a, cols]
            else:
                partial += ((qr[rows, d:end] - xr[cols, d:end]) ** 2).sum(1)
            share = end / dim
            slack = 1.0 if end == dim else (1 + EPSILON / end ** 0.5) ** 2
            stay = partial <= limit[rows] * share * slack * (1 + 1e-9) + 1e-9
            rows, cols, partial = rows[stay], cols[stay], partial[stay]
        score = (q[rows] * x[cols]).sum(1)
        top = best(rows, ids[cols], score, k)
        out.append((rows[top], cols[top], score[top]))
    r, c, s = (np.concatenate(z) for z in zip(*out))
    return r, c, s


def _scan(vectors: DataFrame, probes: DataFrame, index: Index, k: int, list_rows: dict[int, int]) -> DataFrame:
    """(query_id, vec_id, score): each query's best k per block of the lists
    in ``probes`` (query_id, q, limit, list)."""
    asked = {r["list"]: r["n"] for r in probes.groupBy("list").agg(F.count("*").alias("n")).collect()}
    cuts = [(key, -(-n // LIST_ROWS), -(-asked[key] // QUERY_ROWS)) for key, n in list_rows.items() if key in asked]
    if not cuts:
        return probes.select("query_id", F.lit(0).cast("long").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    spark = vectors.sparkSession
    plan = F.broadcast(spark.createDataFrame(cuts, "list long, blocks long, sides long"))   # a row per list

    def part(key: str, many: str) -> Column:
        return F.pmod(F.xxhash64(key), F.col(many))

    def every(many: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(many) - 1))

    keys = ["list", "block", "side"]
    left = vectors.join(plan, "list").withColumn("block", part("vec_id", "blocks")).withColumn("side", every("sides"))
    right = probes.join(plan, "list").withColumn("side", part("query_id", "sides")).withColumn("block", every("blocks"))

    def meet(rows: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(asks):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        q_ids, ids = asks["query_id"].to_numpy(), rows["vec_id"].to_numpy()
        r, c, s = scan_block(q_ids, np.array(asks["q"].tolist(), dtype=float), asks["limit"].to_numpy(dtype=float),
                             ids, np.array(rows["v"].tolist(), dtype=float), index, k)
        return pd.DataFrame({"query_id": q_ids[r], "vec_id": ids[c], "score": s})

    return (left.select("vec_id", "v", *keys).groupBy(*keys)
            .cogroup(right.select("query_id", "q", "limit", *keys).groupBy(*keys))
            .applyInPandas(meet, "query_id long, vec_id long, score double"))


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding",
           probes: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every vector
    for which ``is_query`` (over the column vec_id) holds, by inner product in
    double precision, nearest first, ties to the smaller id; all candidates,
    if there are fewer.  A query's own id is never its candidate.

    See ``usable`` for null, zero, odd and repeated vectors.  An empty table,
    one without usable vectors and one without a query give an empty result.  Columns other than
    the id and the vector are not read.
    """
    clean = materialize(usable(vectors, id_col, vector_col), "vectors")
    queries = clean.filter(is_query)
    n = clean.count()
    if not n or queries.isEmpty():
        return clean.limit(0).select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
    index = fit_index(clean, n)
    placed = materialize(assign(clean, index), "lists")
    list_rows = {r["list"]: r["n"] for r in placed.groupBy("list").agg(F.count("*").alias("n")).collect()}
    wide = probes if probes is not None else tune(placed, queries, index, k)
    rows_of = np.array([list_rows.get(i, 0) for i in range(len(index.centroids))])

    def spread(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if not len(part):
                continue
            order = query_lists(np.array(part["v"].tolist(), dtype=float), index)
            # The nearest lists that hold k others come first and set the limit.
            enough = (np.cumsum(rows_of[order], axis=1) > k).argmax(1) + 1
            enough[rows_of.sum() <= k] = order.shape[1]
            for i in range(0, len(part), 512):
                some, lead = order[i:i + 512], enough[i:i + 512]
                r, c = np.nonzero(np.arange(order.shape[1])[None, :] < np.maximum(lead, wide)[:, None])
                yield pd.DataFrame({"query_id": part["vec_id"].to_numpy()[i + r], "q": part["v"].to_numpy()[i + r],
                                    "list": some[r, c], "first": c < lead[r]})

    asks = materialize(queries.mapInPandas(spread, "query_id long, q array<double>, list long, first boolean"), "probes")
    lead = materialize(_scan(placed, asks.filter("first").withColumn("limit", F.lit(float("inf"))), index, k, list_rows),
                       "first-found")
    square = F.aggregate("q", F.lit(0.0), lambda s, x: s + x * x)
    kth = ranked(lead, k).filter(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
    more = (asks.filter("not first").join(kth, "query_id", "left")
            .withColumn("limit", F.coalesce(F.greatest(F.lit(0.0), square + index.top_norm - 2 * F.col("kth")),
                                            F.lit(float("inf")))))
    rest = _scan(placed, more.select("query_id", "q", "limit", "list"), index, k, list_rows)
    return ranked(lead.unionByName(rest), k).select("query_id", "rank", "vec_id", "score")
