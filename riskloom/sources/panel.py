"""Six-month account panel built from orders and their lines.

Month i is calendar year 2001-i (1 = newest, 6 = oldest); 2001 is the outcome
window. Lines are summed per order before they meet the orders, so the join is
one row to one row however many lines an order has, and the per-account sums
are partial aggregates on both sides of the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.schema import BILLS, MONTHS, PAYMENTS, STATUS, TARGET

OUTCOME_YEAR = 2001


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole(x: Column) -> Column:
    """The nearest whole number, halves away from zero, as `round` gives it but without its decimal objects."""
    size = F.abs(x)
    low = F.floor(size)
    return F.when(x < 0, -low - (size - low >= 0.5).cast("long")).otherwise(low + (size - low >= 0.5).cast("long"))


def _order_money(lines: DataFrame) -> DataFrame:
    """Sums in whole cents: exact in any order of addition, and plain long adds."""
    price = whole(F.col("l_extendedprice") * 100.0)
    return lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(F.when(F.col("l_returnflag") == "R", -price).otherwise(price)).alias("bill"),
        F.sum(F.when(F.col("l_linestatus") == "F", price)).alias("paid"),
    )


def _per_account(orders: DataFrame) -> DataFrame:
    measures = ["CAST(sum(CAST(month = 0 AND o_orderstatus = 'O' AS INT)) AS INT) AS open_0"]
    for i in MONTHS:
        measures += [
            f"CAST(sum(CAST(month = {i} AS INT)) AS INT) AS orders_{i}",
            f"CAST(sum(CAST(month = {i} AND o_orderstatus = 'O' AS INT)) AS INT) AS open_{i}",
            f"CAST(sum(CAST(month = {i} AND o_orderstatus = 'P' AS INT)) AS INT) AS part_{i}",
            f"sum(CASE WHEN month = {i} THEN bill END) AS bill_{i}",
            f"sum(CASE WHEN month = {i} THEN paid END) AS paid_{i}",
        ]
    return orders.groupBy("o_custkey").agg(*[F.expr(m) for m in measures])


def _status(i: int) -> str:
    return (f"CASE WHEN coalesce(orders_{i}, 0) = 0 THEN -2 "
            f"WHEN open_{i} = 0 AND part_{i} = 0 THEN -1 ELSE least(open_{i}, 8) END")


def _amount(name: str) -> str:
    return f"CAST(coalesce({name}, 0) AS DOUBLE) / 100D"


# an open order in the outcome year, or one in the newest month for every third
# account, or three in the two months before it for every second account
_DEFAULTED = """coalesce(open_0, 0) >= 1 OR (coalesce(open_1, 0) >= 1 AND c_custkey % 3 = 0)
    OR (coalesce(open_2, 0) + coalesce(open_3, 0) >= 3 AND c_custkey % 2 = 0)"""


def account_panel(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer in the raw account schema, outcome included."""
    first, after = f"{OUTCOME_YEAR - 6}-01-01", f"{OUTCOME_YEAR + 1}-01-01"
    orders = (
        read_table(spark, folder, "orders")
        .filter((F.col("o_orderdate") >= F.lit(first).cast("timestamp_ntz"))
                & (F.col("o_orderdate") < F.lit(after).cast("timestamp_ntz")))
        .select("o_orderkey", "o_custkey", "o_orderstatus",
                (F.lit(OUTCOME_YEAR) - F.year("o_orderdate")).alias("month"))
    )
    money = _order_money(read_table(spark, folder, "lineitem"))
    history = _per_account(orders.join(money, "o_orderkey", "left"))
    customer = read_table(spark, folder, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    joined = customer.join(history, customer.c_custkey == history.o_custkey, "left")

    return joined.selectExpr(
        "c_custkey + 1 AS ID",
        "CAST(10000D + 10000D * floor(greatest(c_acctbal, 0D) / 100D) AS DOUBLE) AS LIMIT_BAL",
        "CAST(1 + c_custkey % 2 AS INT) AS SEX",
        "CAST(c_nationkey % 7 AS INT) AS EDUCATION",
        "CASE c_mktsegment WHEN 'BUILDING' THEN 0 WHEN 'AUTOMOBILE' THEN 1 WHEN 'MACHINERY' THEN 2 "
        "ELSE 3 END AS MARRIAGE",
        "CAST(21 + (c_custkey * 7) % 59 AS INT) AS AGE",
        *[f"{_status(i)} AS {name}" for i, name in zip(MONTHS, STATUS)],
        *[f"{_amount(f'bill_{i}')} AS {name}" for i, name in zip(MONTHS, BILLS)],
        *[f"{_amount(f'paid_{i}')} AS {name}" for i, name in zip(MONTHS, PAYMENTS)],
        f"CAST({_DEFAULTED} AS INT) AS {TARGET}",
    )
