"""Line dedup by distinct-site spread.

A HyperLogLog sketch of the sites per line hash, merged by aggregation, gives
every line's spread; lines close to the threshold get an exact distinct count.
A line on enough sites is boilerplate: it stays in the document of smallest id
that holds it and goes everywhere else, so no content is lost altogether.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lendscope.llm.common import free_name, materialize

MIN_SITES = 10
LG_K = 12                 # 4,096 registers: 1.6 % standard error
BAND = 0.08               # five standard errors on either side get an exact count
SALTS = 16                # a hot line's rows are spread over so many keys


def _lines(docs: DataFrame) -> DataFrame:
    """(doc, text_key, site, pos, h1, h2, salt) of every line that is not blank.

    Lines are compared without the blanks around them, by 128 bits of hash.
    """
    text = F.col("text")
    exploded = docs.filter(text.isNotNull()).select(
        F.col("doc_id").alias("doc"), F.xxhash64(text).alias("text_key"), F.col("source").alias("site"),
        F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    line = F.trim("line")
    return exploded.filter(line != "").select(
        "doc", "text_key", "site", "pos", F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2"),
        F.pmod(F.xxhash64("text_key", "doc", "pos"), F.lit(SALTS)).alias("salt"))


def _salted(lines: DataFrame) -> DataFrame:
    return lines.withColumn("salt", F.explode(F.array(*[F.lit(i).cast("long") for i in range(SALTS)])))


def boilerplate_lines(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(h1, h2, keeper) of the lines on at least ``min_sites`` distinct sites.

    ``keeper`` is the smallest id of a document that holds the line.
    """
    lines = _lines(docs)
    width = max(1.0, BAND * min_sites)
    sketched = materialize(
        lines.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"),
                                      F.min("doc").alias("keeper"))
        .select("h1", "h2", "keeper", F.hll_sketch_estimate("sketch").alias("sites"))
        .filter(F.col("sites") >= min_sites - width), "line-spread")
    near = sketched.filter(F.col("sites") <= min_sites + width)
    exact = (lines.join(_salted(near.select("h1", "h2", "keeper")), ["h1", "h2", "salt"])
             .filter("site is not null")
             .groupBy("h1", "h2", "keeper", "site").agg(F.lit(1).alias("one"))
             .groupBy("h1", "h2", "keeper").agg(F.count("one").alias("sites"))
             .filter(F.col("sites") >= min_sites))
    sure = sketched.filter(F.col("sites") > min_sites + width)
    return sure.select("h1", "h2", "keeper").unionByName(exact.select("h1", "h2", "keeper"))


@F.pandas_udf(StringType())
def _without(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for texts, positions in parts:
        out = []
        for text, gone in zip(texts, positions):
            if text is None or gone is None:
                out.append(None)
                continue
            gone = set(gone.tolist())
            out.append("\n".join([x for i, x in enumerate(text.split("\n")) if i not in gone]))
        yield pd.Series(out, dtype=object)


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` (any columns, with doc_id, source and text) with boilerplate
    lines taken out of ``text``; ``n_chars``, where present, follows.  One more
    column, the last, has the number of removed lines: ``_n_gone``, with one
    more leading underscore for as long as a column has that name.

    Blank lines are neither counted nor removed.  A null source is no site.
    Null text stays null.  A row without id never keeps a line in another's
    stead; a line that only rows without id hold stays.  Repeated rows are
    treated alike (all copies of the keeper keep the line).  An empty table
    gives an empty table.
    """
    return _remove(docs, min_sites)[0]


def _remove(docs: DataFrame, min_sites: int) -> tuple[DataFrame, str]:
    """The result and the name of its column with the number of removed lines."""
    found = materialize(boilerplate_lines(docs, min_sites), "boilerplate")
    mine = free_name(docs.columns, "_n_gone")       # the one helper column, whatever docs' columns are called
    gone = (_lines(docs).join(_salted(found), ["h1", "h2", "salt"])
            .filter(F.col("keeper").isNotNull() & ~F.col("doc").eqNullSafe(F.col("keeper")))
            .groupBy("doc", "text_key").agg(F.collect_set("pos").alias("pos"))
            .select(F.struct("doc", "text_key", "pos").alias(mine)))
    marked = docs.join(gone, docs["doc_id"].eqNullSafe(gone[mine]["doc"])
                       & (F.xxhash64(docs["text"]) == gone[mine]["text_key"]), "left")
    hit = F.col(mine).isNotNull()
    new = F.when(hit, _without(F.when(hit, docs["text"]), F.col(mine)["pos"])).otherwise(docs["text"])
    columns = [new.alias(c) if c == "text" else docs[c] for c in docs.columns]
    out = marked.select(*columns, F.coalesce(F.size(F.col(mine)["pos"]), F.lit(0)).cast("long").alias(mine))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(mine) > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
                             .otherwise(F.col("n_chars")))
    return out, mine


def dedup_lines(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``remove_boilerplate`` with the columns of ``docs`` alone."""
    out, mine = _remove(docs, min_sites)
    return out.drop(mine)
