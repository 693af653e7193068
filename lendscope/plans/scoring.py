"""Batch scoring job: stored model + policy -> one scored row per loan.

The cutoff defaults to the recommended (cost-minimising) threshold from the
validation table when given, else 0.5.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from lendscope.operators.models import predict_probability
from lendscope.operators.policy import RiskPolicy, load_policy, score_loans
from lendscope.sources.files import load_model, save_table


def score_batch(loans: DataFrame, model_path: str, policy_path: str | None = None,
                threshold: float | None = None, out_path: str | None = None) -> DataFrame:
    model = load_model(model_path)
    policy = load_policy(policy_path) if policy_path else RiskPolicy()
    scored = score_loans(predict_probability(model, loans), policy=policy,
                         threshold=0.5 if threshold is None else threshold)
    if out_path:
        save_table(scored, out_path)
    return scored
