"""Explainability job (IO8): attributions of a fitted linear model, their
summaries, fairness and interactions, published as a version of an artefact
store."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope import roles as R
from lendscope.operators import explain as X
from lendscope.operators import fairness as N
from lendscope.operators import models as M
from lendscope.sources.artifacts import ArtifactStore, Version

FAIRNESS_COLUMNS = ("home_ownership", "purpose", "grade")


def write_explainability(model: PipelineModel, split: DataFrame, root: str, repeats: int = 2,
                         fairness_columns=FAIRNESS_COLUMNS) -> Version:
    """``split``: cleaned rows with id, target and ``split``.  Attributions are of
    the test rows against the training rows; the published tables are
    contributions, global_importance, directions, importance_merge, fairness
    and interactions."""
    test, background = split.filter(F.col("split") == "test"), split.filter(F.col("split") == "train")
    contrib, base = X.linear_attribution(model, test, background)
    contrib = contrib.persist()                            # read by the table and its summaries
    scored = M.predict_probability(model, test).withColumn("y", F.col(R.TARGET_COLUMN)).persist()
    native = X.coefficient_table(model).select("feature", F.col("abs_coefficient").alias("importance"))
    permuted = X.permutation_importance(model, test, R.LOAN_ROLES.features, repeats=repeats)
    store = ArtifactStore(split.sparkSession, root)
    with store.draft() as d:
        d.table("contributions", contrib)
        d.table("global_importance", X.global_importance(contrib, native))
        d.table("directions", X.global_direction(X.global_importance(contrib)))
        d.table("importance_merge", X.importance_merge(native, permuted))
        d.table("fairness", N.fairness_report(scored, list(fairness_columns)))
        pairs = [X.interaction_table(scored, a, b, numeric=X.INTERACTION_NUMERIC) for a, b in X.DEFAULT_INTERACTION_PAIRS]
        table = pairs[0]
        for p in pairs[1:]:
            table = table.unionByName(p)
        d.table("interactions", table)
        d.notes = {"base_value": base, "attributed_rows": "test", "background_rows": "train", "repeats": repeats}
    contrib.unpersist()
    scored.unpersist()
    return store.latest()
