"""Streaming application of the stateless operators.

Cleaning (C1, C3-C6), band lookups (B3) and policy scoring (P2-P8) are
row-wise, so the same functions apply to a streaming DataFrame unchanged.
``score_stream`` wires them into a Structured Streaming query: file source
-> clean -> score -> parquet sink, with the checkpoint in the shared
checkpoint folder so a restarted query resumes exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lendscope.operators.clean import (clean_percentage_columns, create_target_variable, cast_numeric,
                                       parse_emp_length)
from lendscope.operators.policy import RiskPolicy, score_loans
from lendscope.session import checkpoint_dir


def clean_stream(df: DataFrame) -> DataFrame:
    """Row-wise part of C7 (de-duplication needs state and is left to batch)."""
    out = clean_percentage_columns(df)
    out = parse_emp_length(out)
    out = create_target_variable(out)
    return cast_numeric(out)


def score_stream(spark: SparkSession, source_dir: str, schema, sink_dir: str, score_fn,
                 policy: RiskPolicy | None = None, name: str = "loan_scoring", available_now: bool = True):
    """Start (and with ``available_now`` drain) a scoring stream.

    ``score_fn`` maps the cleaned stream to one with a probability column
    ``p`` (a fitted model's ``transform`` + ``positive_probability``, or any
    expression)."""
    src = spark.readStream.schema(schema).parquet(source_dir)
    scored = score_loans(score_fn(clean_stream(src)), policy=policy or RiskPolicy())
    ck = f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    w = (scored.writeStream.format("parquet").option("path", sink_dir).option("checkpointLocation", ck)
         .outputMode("append"))
    q = (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")).start()
    if available_now:
        q.awaitTermination()
    return q
