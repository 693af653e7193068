"""Readers for the parquet tables and the ``loan_book`` stand-in input.

``loan_book`` only reshapes the order tables into rows with the raw loan
schema (one row per order that has line items); it does none of the
analytics.  Every operator downstream works on any table of that schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one table; Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pct_string(c):
    return F.concat(F.round(c).cast("int").cast("string"), F.lit("%"))


def loan_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw loan rows derived from orders, line items and customers.

    Plan: ``lineitem`` is shuffled once, by order key, which serves the
    distinct parts, the aggregate and the join; ``orders`` meets ``customer``
    (and ``nation``/``region``, which Catalyst broadcasts when their measured
    size is under ``spark.sql.autoBroadcastJoinThreshold``) while its rows are
    narrow, and the aggregated lines last.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus").repartition("l_orderkey")
    lines = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.max("l_discount").alias("max_disc"),
        F.max("l_tax").alias("max_tax"),
        F.max("l_quantity").alias("max_qty"),
        F.max("l_extendedprice").alias("max_ext"),
        F.count(F.when(F.col("l_linestatus") == "F", 1)).alias("n_f"),
        F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("n_r"),
        F.countDistinct("l_partkey").alias("n_parts"),
    )
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")

    j = (o.join(c, o.o_custkey == c.c_custkey)
         .join(n, F.col("c_nationkey") == n.n_nationkey)
         .join(r, F.col("n_regionkey") == r.r_regionkey)
         .join(lines, o.o_orderkey == lines.l_orderkey))

    ok = F.col("o_orderkey")
    ck = F.col("o_custkey")
    emp_k = ck % 12
    return j.select(
        ok.alias("id"),
        ck.alias("member_id"),
        (F.col("o_totalprice") / 10).alias("loan_amnt"),
        F.when(F.col("n_lines") > 4, " 60 months").otherwise(" 36 months").alias("term"),
        _pct_string(F.col("max_disc") * 100).alias("int_rate"),
        (F.col("o_totalprice") / 360).alias("installment"),
        F.element_at(F.array(*[F.lit(g) for g in "ABCDE"]),
                     F.substring("o_orderpriority", 1, 1).cast("int")).alias("grade"),
        F.when(emp_k == 0, "< 1 year").when(emp_k == 1, "1 year")
         .when(emp_k == 10, "10+ years").when(emp_k == 11, F.lit(None).cast("string"))
         .otherwise(F.concat(emp_k.cast("string"), F.lit(" years"))).alias("emp_length"),
        F.col("r_name").alias("home_ownership"),
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("double"))
         .otherwise(F.col("c_acctbal") * 10).alias("annual_inc"),
        F.when(F.col("n_f") == F.col("n_lines"), "Verified")
         .when(F.col("n_f") == 0, "Not Verified")
         .otherwise("Source Verified").alias("verification_status"),
        F.when(F.col("o_orderstatus") == "F", "Fully Paid")
         .when((F.col("o_orderstatus") == "P") & (ok % 3 == 0), "Charged Off")
         .when(F.col("o_orderstatus") == "P", "Fully Paid")
         .when(F.col("o_orderstatus") == "O", "Current").alias("loan_status"),
        F.col("c_mktsegment").alias("purpose"),
        F.col("n_name").alias("addr_state"),
        F.col("max_qty").alias("dti"),
        F.col("n_r").alias("delinq_2yrs"),
        F.col("n_lines").alias("open_acc"),
        (F.col("n_nationkey") % 3).cast("long").alias("pub_rec"),
        F.col("max_ext").alias("revol_bal"),
        _pct_string(F.col("max_tax") * 1000).alias("revol_util"),
        F.col("n_parts").alias("total_acc"),
        (ok % 8).alias("mort_acc"),
        (ck % 2).alias("pub_rec_bankruptcies"),
        F.when(ok % 2 == 0, "f").otherwise("w").alias("initial_list_status"),
        F.when(ok % 13 == 0, "Joint App").otherwise("Individual").alias("application_type"),
    )


def scored_loans(loans: DataFrame, id_col: str = "id", target: str = "default_flag",
                 score_col: str = "p") -> DataFrame:
    """Attach the deterministic stand-in score used before any model exists.

    ``((id*48271) % 1000) / 1000 * 0.6 + default_flag * 0.2`` -- an
    expression of the data, so evaluation/policy operators can be checked
    against SQL without a fitted model.
    """
    return loans.withColumn(
        score_col,
        ((F.col(id_col) * 48271) % 1000) / 1000.0 * 0.6 + F.col(target) * 0.2)
