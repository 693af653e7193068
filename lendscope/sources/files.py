"""Readers and writers (IO1-IO9).

Raw loans are CSV read with an explicit schema (no inference pass); processed
tables, splits and evaluation artefacts are parquet; fitted pipelines use the
MLlib writers.  Paths may be any Hadoop-compatible URI.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Raw loan file schema (strings where the file carries text such as "13.5%")
RAW_LOAN_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("member_id", T.LongType()),
    T.StructField("loan_amnt", T.DoubleType()), T.StructField("term", T.StringType()),
    T.StructField("int_rate", T.StringType()), T.StructField("installment", T.DoubleType()),
    T.StructField("grade", T.StringType()), T.StructField("sub_grade", T.StringType()),
    T.StructField("emp_title", T.StringType()), T.StructField("emp_length", T.StringType()),
    T.StructField("home_ownership", T.StringType()), T.StructField("annual_inc", T.DoubleType()),
    T.StructField("verification_status", T.StringType()), T.StructField("issue_d", T.StringType()),
    T.StructField("loan_status", T.StringType()), T.StructField("purpose", T.StringType()),
    T.StructField("title", T.StringType()), T.StructField("zip_code", T.StringType()),
    T.StructField("addr_state", T.StringType()), T.StructField("dti", T.DoubleType()),
    T.StructField("delinq_2yrs", T.DoubleType()), T.StructField("earliest_cr_line", T.StringType()),
    T.StructField("open_acc", T.DoubleType()), T.StructField("pub_rec", T.DoubleType()),
    T.StructField("revol_bal", T.DoubleType()), T.StructField("revol_util", T.StringType()),
    T.StructField("total_acc", T.DoubleType()), T.StructField("initial_list_status", T.StringType()),
    T.StructField("application_type", T.StringType()), T.StructField("mort_acc", T.DoubleType()),
    T.StructField("pub_rec_bankruptcies", T.DoubleType()), T.StructField("desc", T.StringType()),
    T.StructField("url", T.StringType()),
])


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


# IO1
def load_raw_data(spark: SparkSession, path: str, schema: T.StructType = RAW_LOAN_SCHEMA,
                  header: bool = True) -> DataFrame:
    """CSV scan with a declared schema; missing path -> FileNotFoundError,
    no rows -> ValueError (one ``isEmpty`` probe, which reads one row)."""
    if not _exists(spark, path):
        raise FileNotFoundError(path)
    df = spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE").csv(path)
    if df.isEmpty():
        raise ValueError(f"no rows in {path}")
    return df


# IO2 / IO3
def load_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    if not _exists(spark, path):
        raise FileNotFoundError(path)
    return spark.read.format(fmt).option("header", True).load(path)


def save_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None) -> None:
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


# IO4
def save_splits(df_with_split: DataFrame, path: str) -> None:
    """One table partitioned by ``split``; reading a split prunes partitions."""
    save_table(df_with_split, path, partition_by=["split"])


def load_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("split") == split)


# IO5
def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# IO6-IO8: artefacts are long result tables keyed by model / cluster
def save_artifacts(tables: dict, root: str) -> None:
    for name, df in tables.items():
        save_table(df, f"{root.rstrip('/')}/{name}")


# IO9
def winsorize_job(spark: SparkSession, src: str, dst: str, columns, k: float = 3.0) -> None:
    """Read the cleaned table, clip with bounds fitted on it, write it back out."""
    from lendscope.operators.clean import winsorize_columns
    save_table(winsorize_columns(load_table(spark, src), columns, k), dst)
