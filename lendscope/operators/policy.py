"""Policy-driven risk scoring (P2-P12) and the policy tables (IO10).

A policy is four small dimension tables (tiers, actions, rate adjustments,
grade bands).  Scoring a loan is one narrow projection: band lookups are
generated ``CASE`` expressions over the (bounded) band lists, or broadcast
joins against the policy tables -- no shuffle of the loan table.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from lendscope import roles as R
from lendscope.operators.bands import band_lookup_expr


@dataclass
class RiskPolicy:
    """Tiers ``(name, min, max, description)``, actions ``(tier, action,
    rationale)``, rate bps per tier, grade bands ``(grade, min, max)``."""

    risk_tiers: list = field(default_factory=lambda: [tuple(t) for t in R.RISK_TIERS])
    lending_actions: list = field(default_factory=lambda: [tuple(a) for a in R.LENDING_ACTIONS])
    rate_bps: dict = field(default_factory=lambda: dict(R.RATE_ADJUSTMENT_BPS))
    grade_bands: list = field(default_factory=lambda: [tuple(g) for g in R.LOAN_GRADE_BANDS])
    base_rate: float = R.BASE_INTEREST_RATE

    # IO10 -------------------------------------------------------------
    def to_dict(self) -> dict:
        return {
            "risk_tiers": [{"name": n, "min_probability": lo, "max_probability": hi, "description": d}
                           for n, lo, hi, d in self.risk_tiers],
            "lending_actions": [{"tier": t, "action": a, "description": d} for t, a, d in self.lending_actions],
            "interest_rate_adjustment_bps": dict(self.rate_bps),
            "loan_grade_bands": [{"grade": g, "min_probability": lo, "max_probability": hi}
                                 for g, lo, hi in self.grade_bands],
        }

    @classmethod
    def from_dict(cls, d: dict) -> "RiskPolicy":
        return cls(
            risk_tiers=[(t["name"], float(t["min_probability"]), float(t["max_probability"]),
                         t.get("description", "")) for t in d["risk_tiers"]],
            lending_actions=[(a["tier"], a["action"], a.get("description", "")) for a in d["lending_actions"]],
            rate_bps={k: float(v) for k, v in d["interest_rate_adjustment_bps"].items()},
            grade_bands=[(g["grade"], float(g["min_probability"]), float(g["max_probability"]))
                         for g in d["loan_grade_bands"]],
        )

    def tier_of(self, name: str) -> tuple:
        for t in self.risk_tiers:
            if t[0] == name:
                return t
        raise ValueError(f"Unknown risk tier '{name}'.")

    # column expressions ------------------------------------------------
    def tier_expr(self, p: Column) -> Column:
        return band_lookup_expr(p, self.risk_tiers)

    def grade_expr(self, p: Column) -> Column:
        return band_lookup_expr(p, self.grade_bands)

    def _lookup(self, key: Column, pairs) -> Column:
        """The value of ``key``; NULL stays NULL, an unknown key raises."""
        m = F.create_map(*[x for k, v in pairs for x in (F.lit(k), F.lit(v))])
        unknown = F.raise_error(F.concat(F.lit("Unknown risk tier '"), key, F.lit("'.")))
        return F.when(key.isNull() | F.array_contains(F.map_keys(m), key), F.try_element_at(m, key)).otherwise(unknown)

    def tier_description_expr(self, tier: Column) -> Column:
        return self._lookup(tier, [(t[0], t[3]) for t in self.risk_tiers])

    def action_expr(self, tier: Column) -> Column:
        return self._lookup(tier, [(a[0], a[1]) for a in self.lending_actions])

    def rationale_expr(self, tier: Column) -> Column:
        return self._lookup(tier, [(a[0], a[2]) for a in self.lending_actions])

    def rate_expr(self, tier: Column) -> Column:
        bps = self._lookup(tier, list(self.rate_bps.items())).cast("double")
        return F.bround(F.lit(self.base_rate) + bps / 100.0, 2)

    # tables ------------------------------------------------------------
    def tables(self, spark: SparkSession, policy_id: str = "default") -> dict:
        return {
            "risk_tiers": spark.createDataFrame(
                [(policy_id, n, lo, hi, d) for n, lo, hi, d in self.risk_tiers],
                "policy_id string, name string, min_probability double, max_probability double, description string"),
            "lending_actions": spark.createDataFrame(
                [(policy_id, t, a, d) for t, a, d in self.lending_actions],
                "policy_id string, tier string, action string, description string"),
            "rate_adjustments": spark.createDataFrame(
                [(policy_id, t, float(b)) for t, b in self.rate_bps.items()],
                "policy_id string, tier string, bps double"),
            "loan_grade_bands": spark.createDataFrame(
                [(policy_id, g, lo, hi) for g, lo, hi in self.grade_bands],
                "policy_id string, grade string, min_probability double, max_probability double"),
        }


def save_policy(policy: RiskPolicy, path: str) -> None:
    """Write the policy as one JSON document to a folder that Spark can write."""
    spark = SparkSession.active()
    doc = spark.createDataFrame([(json.dumps(policy.to_dict(), indent=2),)], "value string")
    doc.coalesce(1).write.mode("overwrite").text(path)


def load_policy(path: str | None) -> RiskPolicy:
    """Read a policy JSON (file or folder, any store that Spark reads); a
    missing one bootstraps (writes) the defaults."""
    if path is None:
        return RiskPolicy()
    try:
        text = SparkSession.active().read.text(path, wholetext=True).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        text = None
    if text is None:
        p = RiskPolicy()
        save_policy(p, path)
        return p
    return RiskPolicy.from_dict(json.loads(text[0]))


def read_policy_tables(spark: SparkSession, path: str, policy_id_col: str | None = None) -> dict:
    """Policy JSON files (one policy per file, any number of files) read by
    Spark and exploded into the four dimension tables keyed by ``policy_id``."""
    raw = spark.read.option("multiLine", True).json(path)
    pid = F.col(policy_id_col) if policy_id_col else F.input_file_name()
    raw = raw.withColumn("policy_id", pid)
    tiers = raw.select("policy_id", F.inline("risk_tiers"))
    actions = raw.select("policy_id", F.inline("lending_actions"))
    bps = raw.select("policy_id", F.explode(F.from_json(F.to_json("interest_rate_adjustment_bps"),
                                                        "map<string,double>")).alias("tier", "bps"))
    grades = raw.select("policy_id", F.inline("loan_grade_bands"))
    return {"risk_tiers": tiers, "lending_actions": actions, "rate_adjustments": bps,
            "loan_grade_bands": grades}


def policy_band_join(df: DataFrame, p: str, policy: str, bands: DataFrame, name_col: str = "name",
                     out: str = "risk_tier") -> DataFrame:
    """Each row's band under its own policy (``policy`` column), for any number
    of policies: a policy's bands become one sorted array, an equi-join brings
    it to the policy's rows, and the row finds its half-open ``[min, max)``
    band in it; without one (below 0, NaN, null, beyond the last) the last
    band stands in.  A row of an unknown or null policy gets null.  Catalyst
    broadcasts the arrays where they are small; no range join, no row copies."""
    held = (bands.groupBy(F.col("policy_id").cast("string").alias("_policy"))
            .agg(F.sort_array(F.collect_list(F.struct(F.col("min_probability").alias("lo"), F.col("max_probability").alias("hi"),
                                                      F.col(name_col).alias("name")))).alias("_bands")))
    v = F.col(p).cast("double")
    hit = F.get(F.filter("_bands", lambda b: (v >= b["lo"]) & (v < b["hi"])), F.lit(0))
    found = F.coalesce(hit["name"], F.element_at("_bands", -1)["name"])
    return df.join(held, F.col(policy).cast("string") == F.col("_policy"), "left").withColumn(out, found).drop("_policy", "_bands")


# P2
def predict_label(df: DataFrame, p: str = "p", threshold: float = 0.5, out: str = "predicted_default") -> DataFrame:
    return df.withColumn(out, (F.col(p) >= F.lit(threshold)).cast("int"))


# P3
def round_tenth(x: Column) -> Column:
    """``x`` (not negative) to one decimal, by the exact binary value; a true
    half goes to the even digit.

    With k tenths below, h is the double next to (2k + 1) / 20.  ``x`` differs
    from h: its side decides.  ``x`` is h: the sign of 20 h - (2k + 1) does,
    taken exactly as the rounding error of 16 h + 4 h (both exact products).
    """
    k = F.floor(x * 10)
    odd = (2 * k + 1).cast("double")
    h = odd / 20.0
    a, b = h * 16.0, h * 4.0
    total = a + b
    second = total - a
    rest = (total - odd) + ((a - (total - second)) + (b - second))
    up = F.when(x != h, x > h).when(rest != 0, rest > 0).otherwise(k % 2 == 1)
    return F.when(x.isNotNull(), (k + F.when(up, 1).otherwise(0)).cast("double") / 10.0)


def risk_score_expr(p: Column) -> Column:
    return round_tenth(p * 100)


def confidence_expr(p: Column) -> Column:
    return round_tenth(F.abs(p - 0.5) * 200)


# P8
def score_loans(df: DataFrame, p: str = "p", policy: RiskPolicy | None = None,
                threshold: float = 0.5, keep: Sequence[str] = ("id",)) -> DataFrame:
    """One row per loan: probability, label, score, confidence, tier,
    tier description, action, rationale, recommended rate, model grade."""
    pol = policy or RiskPolicy()
    pp = F.col(p).cast("double")
    tier = pol.tier_expr(pp)
    base = df.select(*[c for c in keep if c in df.columns], pp.alias("default_probability"))
    t = F.col("risk_tier")
    return (base.withColumn("predicted_default", (F.col("default_probability") >= threshold).cast("int"))
            .withColumn("risk_score", risk_score_expr(F.col("default_probability")))
            .withColumn("confidence", confidence_expr(F.col("default_probability")))
            .withColumn("risk_tier", pol.tier_expr(F.col("default_probability")))
            .withColumn("tier_description", pol.tier_description_expr(t))
            .withColumn("lending_action", pol.action_expr(t))
            .withColumn("action_rationale", pol.rationale_expr(t))
            .withColumn("recommended_rate", pol.rate_expr(t))
            .withColumn("model_loan_grade", pol.grade_expr(F.col("default_probability"))))


# P9
def score_single(df: DataFrame, **kw) -> DataFrame:
    """P8 for exactly one row; any other row count raises (one cheap count)."""
    n = df.limit(2).count()
    if n != 1:
        raise ValueError("expected exactly one row")
    return score_loans(df, **kw)


# P10
def tier_distribution(scored: DataFrame, tier_col: str = "risk_tier", policy: RiskPolicy | None = None) -> DataFrame:
    """Counts and shares per tier, empty tiers included (tier dim left join)."""
    pol = policy or RiskPolicy()
    spark = scored.sparkSession
    dim = spark.createDataFrame([(i, t[0]) for i, t in enumerate(pol.risk_tiers)], "tier_order int, risk_tier string")
    cnt = scored.groupBy(F.col(tier_col).alias("risk_tier")).agg(F.count(F.lit(1)).alias("n_loans"))
    j = dim.join(cnt, "risk_tier", "left").withColumn("n_loans", F.coalesce("n_loans", F.lit(0)).cast("long"))
    tot = j.agg(F.sum("n_loans").alias("_t"))
    return (j.crossJoin(F.broadcast(tot))  # one row
            .withColumn("share", F.when(F.col("_t") > 0, F.col("n_loans") / F.col("_t")))
            .drop("_t"))


# P11
def policy_violations(tables: dict) -> DataFrame:
    """Checks every policy (keyed by ``policy_id``): tiers start at 0, cover 1,
    no gap or overlap between consecutive tiers, every tier has an action
    and a rate and vice versa.  Returns ``(policy_id, check, detail)``."""
    tiers = tables["risk_tiers"].select("policy_id", "name", "min_probability", "max_probability")
    w = Window.partitionBy("policy_id").orderBy("min_probability")  # rows = #tiers per policy
    t = tiers.withColumn("_prev_max", F.lag("max_probability").over(w))
    gaps = (t.filter(F.col("_prev_max").isNotNull() & (F.col("_prev_max") != F.col("min_probability")))
            .select("policy_id", F.when(F.col("_prev_max") < F.col("min_probability"), "gap")
                    .otherwise("overlap").alias("check"),
                    F.concat(F.lit("before "), F.col("name")).alias("detail")))
    ends = tiers.groupBy("policy_id").agg(F.min("min_probability").alias("_lo"), F.max("max_probability").alias("_hi"))
    start = ends.filter(F.col("_lo") != 0).select("policy_id", F.lit("does_not_start_at_0").alias("check"),
                                                  F.col("_lo").cast("string").alias("detail"))
    cover = ends.filter(F.col("_hi") < 1).select("policy_id", F.lit("does_not_cover_1").alias("check"),
                                                 F.col("_hi").cast("string").alias("detail"))
    act = tables["lending_actions"].select("policy_id", F.col("tier").alias("name"))
    rate = tables["rate_adjustments"].select("policy_id", F.col("tier").alias("name"))
    names = tiers.select("policy_id", "name")
    no_act = names.join(act, ["policy_id", "name"], "left_anti").select(
        "policy_id", F.lit("tier_without_action").alias("check"), F.col("name").alias("detail"))
    no_rate = names.join(rate, ["policy_id", "name"], "left_anti").select(
        "policy_id", F.lit("tier_without_rate").alias("check"), F.col("name").alias("detail"))
    act_extra = act.join(names, ["policy_id", "name"], "left_anti").select(
        "policy_id", F.lit("action_for_unknown_tier").alias("check"), F.col("name").alias("detail"))
    rate_extra = rate.join(names, ["policy_id", "name"], "left_anti").select(
        "policy_id", F.lit("rate_for_unknown_tier").alias("check"), F.col("name").alias("detail"))
    out = gaps
    for x in (start, cover, no_act, no_rate, act_extra, rate_extra):
        out = out.unionByName(x)
    return out


# P12
def borrower_sentence(tier: Column, p: Column, risk_factors: Column, protective: Column,
                      action: Column) -> Column:
    """Plain-language paragraph from tier, whole-percent p (half-even), the
    top 3 risk and top 2 protective factor labels (arrays, strongest first)
    and the recommended action; labels are lower-cased at the first letter
    for mid-sentence use unless they start with an acronym or brand name."""
    pct = F.bround(p * 100, 0).cast("int").cast("string")
    risks = _join_with_and(F.transform(F.slice(risk_factors, 1, 3), _factor_phrase))
    prot = _join_with_and(F.transform(F.slice(protective, 1, 2), _factor_phrase))
    return F.concat_ws(" ",
                       F.concat(F.lit("This borrower is classified as "), tier, F.lit(" (estimated "), pct,
                                F.lit("% likelihood of default).")),
                       F.when(F.size(risk_factors) > 0,
                              F.concat(F.lit("This is primarily driven by "), risks, F.lit("."))),
                       F.when(F.size(protective) > 0,
                              F.concat(F.lit("On the positive side, "), prot,
                                       F.lit(" help offset some of this risk."))),
                       F.concat(F.lit("Recommended action: "), action, F.lit(".")))


def _factor_phrase(c: Column) -> Column:
    head = F.substring(c, 1, 2)
    acronym = (F.upper(head) == head) & (F.lower(head) != head)  # first two chars upper-case
    keep = acronym | c.startswith("LendingClub")
    return F.when(keep, c).otherwise(F.concat(F.lower(F.substring(c, 1, 1)), F.substring(c, 2, 1 << 30)))


def _join_with_and(arr: Column) -> Column:
    """'a', 'a and b', 'a, b, and c'."""
    n = F.size(arr)
    return (F.when(n == 1, arr[0])
            .when(n == 2, F.concat(arr[0], F.lit(" and "), arr[1]))
            .when(n >= 3, F.concat(F.array_join(F.slice(arr, 1, n - 1), ", "), F.lit(", and "),
                                   F.element_at(arr, -1))))
