"""Reading and writing account tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.clean import find_target
from riskloom.schema import TARGET, TARGET_SPELLINGS, account_schema

PATH_CONF = "riskloom.accounts.path"
PATH_VARIABLE = "CREDIT_RISK_RAW_PATH"


def resolve_path(spark: SparkSession, path: str | None = None, default: str | None = None) -> str:
    """Argument, then session setting, then environment, then default."""
    chosen = path or spark.conf.get(PATH_CONF, None) or os.environ.get(PATH_VARIABLE) or default
    if not chosen:
        raise ValueError(f"no account table given: pass a path, set {PATH_CONF} or {PATH_VARIABLE}")
    return chosen


def _must_exist(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.globStatus(target):
        raise FileNotFoundError(
            f"no account table at {path}; place the raw file there or set {PATH_VARIABLE}")


def _csv_schema(spark: SparkSession, path: str) -> T.StructType:
    """Types by column name, in the order of the file's own header."""
    names = spark.read.option("header", True).csv(path).columns
    known = {f.name: f.dataType for f in account_schema().fields}
    known |= {spelling: T.IntegerType() for spelling in TARGET_SPELLINGS}
    return T.StructType([T.StructField(n, known.get(n, T.StringType())) for n in names])


def _json_schema(spark: SparkSession, path: str) -> T.StructType:
    """The account columns, and the outcome under the spelling that the records have."""
    names = spark.read.option("primitivesAsString", True).json(path).columns
    outcome = [T.StructField(c, T.IntegerType()) for c in [TARGET, *TARGET_SPELLINGS] if c in names]
    return T.StructType([*account_schema(target=None).fields, *outcome])


def read_accounts(spark: SparkSession, path: str | None = None, default: str | None = None) -> DataFrame:
    """Raw accounts from CSV (with header), JSON lines or Parquet, explicit types."""
    source = resolve_path(spark, path, default)
    _must_exist(spark, source)
    lowered = source.rstrip("/").lower()
    if lowered.endswith((".csv", ".csv.gz")):
        return spark.read.schema(_csv_schema(spark, source)).option("header", True).option(
            "enforceSchema", False).csv(source)
    if lowered.endswith((".json", ".jsonl")):
        return spark.read.schema(_json_schema(spark, source)).json(source)
    return spark.read.parquet(source)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Scoring requests: one JSON record per line, or arrays of records."""
    return spark.read.schema(account_schema(target=None)).json(path)


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> str:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return path


def publish(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a SQL table, or register a view over the data when no path is given."""
    if path is None:
        df.createOrReplaceTempView(name)
    else:
        df.write.mode("overwrite").option("path", path).saveAsTable(name)


def write_results(sections: DataFrame, path: str) -> str:
    """Result bundle as JSON lines."""
    sections.write.mode("overwrite").json(path)
    return path


def with_target_name(df: DataFrame) -> DataFrame:
    name = find_target(df)
    return df if name == TARGET else df.withColumnRenamed(name, TARGET)


def as_json(df: DataFrame, name: str = "json") -> DataFrame:
    """Each row as one JSON document."""
    return df.select(F.to_json(F.struct("*")).alias(name))
