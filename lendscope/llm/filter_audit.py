"""How filters interact: contingency tensors contracted over every order.

Every document gets one bit per filter (fails or not).  Spark counts the bit
patterns of each part; a part's counts, reshaped to 2x2x2x2x2, hold all that
any order of the filters can ask for.  A step of an order is a contraction
that takes pass, fail or all along each axis, and one einsum evaluates the
steps of all 120 orders for a batch of parts.  The documents are read once
and only patterns are counted, whatever the number of orders.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LETTERS = "ABCDE"
BLANK = r"[\x20\x09-\x0D]+"
MEASURES = ("all_docs", "good", "toxic")
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
PARTS_AT_ONCE = 256


def text_filters(text: Column) -> list[Column]:
    """Failure conditions A to D of one text (E needs the whole table)."""
    words = F.array_remove(F.split(text, BLANK), "")
    return [F.size(words) < 200,
            100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
            100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.length(text),
            text.rlike(r"[#$%&*|]")]


def patterns(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, pattern, all_docs, good, toxic): documents by failure bits.

    Bits A to D depend on the text alone; E is set where the text occurs under
    a smaller id.  Texts are compared by SHA-256.  Equal rows are merged
    before any shuffle and a text's copies are counted per (part, label)
    before its smallest id is looked for, so a text held by a third of all
    documents is never gathered in one task.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    bits = sum(f.cast("int") * (1 << i) for i, f in enumerate(text_filters(F.col("_text"))))
    rows = (docs.select(F.col("doc_id").cast("long").alias("_id"), text.alias("_text"),
                        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"))
            .select("_id", "part", F.unhex(F.sha2("_text", 256)).alias("digest"), bits.alias("bits"))
            .groupBy("digest", "_id", "part", "bits").agg(F.count(F.lit(1)).alias("n")))
    marks = (labels.select(F.col("doc_id").cast("long").alias("_mark"), (F.col("quality") == 1).alias("good"),
                           (F.col("toxic") == 1).alias("toxic")).filter("_mark is not null")
             .groupBy("_mark").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic")))
    # rows without an id carry no label; a salt keeps them from meeting in one task
    rows = rows.withColumn("_salt", F.when(F.col("_id").isNull(), 1 + F.pmod(F.xxhash64("digest"), F.lit(1 << 20)))
                           .otherwise(F.lit(0)))
    marked = rows.join(marks.withColumn("_none", F.lit(0).cast("long")),
                       (F.coalesce("_id", F.lit(0)) == F.col("_mark")) & (F.col("_salt") == F.col("_none")), "left")
    no = F.lit(False)
    held = (marked.groupBy("digest", "part", "bits", F.coalesce("good", no).alias("good"),
                           F.coalesce("toxic", no).alias("toxic"))
            .agg(F.sum("n").alias("n"), F.min("_id").alias("first"),
                 F.sum(F.when(F.col("_id").isNull(), F.col("n"))).alias("no_id"),
                 F.min(F.when(F.col("_id").isNotNull(), F.struct("_id", "n"))).alias("least")))
    firsts = held.groupBy("digest").agg(F.min("first").alias("smallest"))
    at_first = F.when(F.col("first") == F.col("smallest"), F.col("least.n")).otherwise(F.lit(0))
    split = (held.join(firsts, "digest")
             .withColumn("kept", F.coalesce(at_first, F.lit(0)) + F.coalesce("no_id", F.lit(0)))
             .select("part", "good", "toxic", F.inline(F.array(
                 F.struct(F.col("bits").alias("pattern"), F.col("kept").alias("n")),
                 F.struct((F.col("bits") + 16).alias("pattern"), (F.col("n") - F.col("kept")).alias("n"))))))
    return (split.groupBy("part", "pattern")
            .agg(F.sum("n").alias("all_docs"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
                 F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic")))


def selectors(steps: list[tuple[tuple[int, ...], int]], how) -> list[np.ndarray]:
    """Per axis, one (pass, fail) selector for every step."""
    return [np.array([how(order, k, axis) for order, k in steps], dtype=np.int64) for axis in range(len(LETTERS))]


def contract(tensors: np.ndarray, chosen: list[np.ndarray]) -> np.ndarray:
    """(parts, steps) totals of (parts, 2, 2, 2, 2, 2) counts."""
    return np.einsum("pabcde,sa,sb,sc,sd,se->ps", tensors, *chosen, optimize=True)


STEPS = [(order, k) for order in permutations(range(len(LETTERS))) for k in range(len(LETTERS))]
KEPT = selectors(STEPS, lambda order, k, axis: PASS if axis in order[:k + 1] else ALL)
REMOVED = selectors(STEPS, lambda order, k, axis: FAIL if axis == order[k] else PASS if axis in order[:k] else ALL)
FAILING = selectors(STEPS, lambda order, k, axis: FAIL if axis == order[k] else ALL)
UNIQUE = selectors(STEPS, lambda order, k, axis: FAIL if axis == order[k] else PASS)
LETTER_OF = np.array([order[k] for order, k in STEPS])


def audit_tensors(counts: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The (parts, steps) columns of the audit from tensors of each measure."""
    docs = counts["all_docs"]
    removed = contract(docs, REMOVED)
    by_letter = np.stack([removed[:, LETTER_OF == i].sum(axis=1) for i in range(len(LETTERS))], axis=1)
    return {"kept": contract(docs, KEPT), "removed": removed, "redundant": contract(docs, FAILING) - removed,
            "unique_fails": contract(docs, UNIQUE), "good_lost": contract(counts["good"], REMOVED),
            "toxic_lost": contract(counts["toxic"], REMOVED), "shapley": by_letter[:, LETTER_OF]}


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step: kept, removed, redundant,
    unique_fails, good_lost, toxic_lost and shapley (longs, zeros included).

    Null texts are empty, null sources are the part of the empty string.  A
    row without an id is no copy (it has no smaller id), never makes another
    one a copy and has no label; rows that repeat an id and its text count
    each, and none is a copy of the other.  An id marked more than once is
    good or toxic if any mark says so.  An empty table has no parts and gives
    no rows; other columns are not read.
    """
    cells = patterns(docs, labels)
    wide = cells.groupBy("part").agg(*[
        F.array(*[F.coalesce(F.sum(F.when(F.col("pattern") == p, F.col(m))), F.lit(0)) for p in range(32)]).alias(m)
        for m in MEASURES])
    n = len(STEPS)
    orders = np.array(["".join(LETTERS[i] for i in order) for order, _ in STEPS])
    step = np.array([k + 1 for _, k in STEPS], dtype=np.int32)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), PARTS_AT_ONCE):
                some = batch.iloc[at:at + PARTS_AT_ONCE]
                # bit i of a pattern is filter i, so the last axis of a plain reshape is filter A
                counts = {m: np.stack(some[m].to_numpy()).astype(np.int64).reshape(-1, 2, 2, 2, 2, 2)
                          .transpose(0, 5, 4, 3, 2, 1) for m in MEASURES}
                cols = audit_tensors(counts)
                yield pd.DataFrame({"part": np.repeat(some["part"].to_numpy(), n),
                                    "filter_order": np.tile(orders, len(some)), "step": np.tile(step, len(some)),
                                    **{c: v.ravel() for c, v in cols.items()}})

    return wide.mapInPandas(run, "part string, filter_order string, step int, kept long, removed long, "
                                 "redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long")
