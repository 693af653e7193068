"""Token counts of whole texts by rank-synchronous array merging.

Each worker cuts its texts into pre-tokens, holds the ones it has not met
before as one ragged numpy array, applies every sequence's lowest-rank pair
at the same time until none is left, and adds up the surviving symbols.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.bpe import PieceCounter

CHARS_AT_ONCE = 4_000_000


def batches(texts: list[str], chars: int) -> Iterator[list[str]]:
    """Runs of texts of about ``chars`` characters; a longer text is a run of its own."""
    run, size = [], 0
    for t in texts:
        if run and size + len(t) > chars:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield run


def token_counter(vocab_path: str, pattern: str):
    """Column function: text -> number of tokens (null counts as empty)."""

    @F.pandas_udf("long")
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = PieceCounter(vocab_path, pattern)
        for texts in parts:
            out: list[int] = []
            for run in batches([t or "" for t in texts], CHARS_AT_ONCE):
                out.extend(counter.counts(run))
            yield pd.Series(out, dtype="int64")

    return count


def count_tokens(docs: DataFrame, vocab_path: str, pattern: str, limit: int = 512,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_bytes`` (UTF-8), ``n_tokens``,
    ``over_limit`` (``n_tokens > limit``).

    Null text counts as empty: 0 bytes, 0 tokens.  Null ids and repeated rows
    are kept, one result each; an empty table gives an empty result; other
    columns are not read.  A text of any length is counted whole.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    n = token_counter(vocab_path, pattern)(text)
    return docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"),
                       n.alias("n_tokens")).withColumn("over_limit", F.col("n_tokens") > limit)
