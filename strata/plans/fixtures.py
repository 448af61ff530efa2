"""Reference-shaped inputs derived from the driver tables by Spark.

The original jobs read a bank-transactions workbook. These frames give the
same shape from ``orders`` (one transaction per order, account = customer),
so every job runs over the whole ``orders`` table and grows with it. The
DuckDB oracle builds the same rows with the SQL in ``strata.plans.oracle``.

Expressions (the same in both engines):

* ``AccountNo``   customer key as text
* ``Date``        order date; NULL when ``o_orderkey % 97 = 0`` (undated rows)
* ``TransactionDetails`` order priority
* ``CHQNo``       ``o_orderkey % 1000`` as text; NULL when ``o_orderkey % 3 = 0``
* ``ValueDate``   order date + 2 days
* ``WithdrawalAMT`` total when status F, ``DepositAMT`` total when status O,
  ``BalanceAMT`` total; all ``decimal(18,2)``
* ``TxnNo``       order key (tie-break for "latest" questions)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import ntz_literal

MONEY = T.DecimalType(18, 2)

# Source headers of the bank workbook and their column names.
SOURCE_HEADERS = {
    "Account No": "AccountNo",
    "DATE": "Date",
    "TRANSACTION DETAILS": "TransactionDetails",
    "CHQ.NO.": "CHQNo",
    "VALUE DATE": "ValueDate",
    "WITHDRAWAL AMT": "WithdrawalAMT",
    "DEPOSIT AMT": "DepositAMT",
    "BALANCE AMT": "BalanceAMT",
}

TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("AccountNo", T.StringType()),
        T.StructField("Date", T.DateType()),
        T.StructField("TransactionDetails", T.StringType()),
        T.StructField("CHQNo", T.StringType()),
        T.StructField("ValueDate", T.DateType()),
        T.StructField("WithdrawalAMT", MONEY),
        T.StructField("DepositAMT", MONEY),
        T.StructField("BalanceAMT", MONEY),
    ]
)

# Fixed load times of the two bronze batches (UTC wall clock).
FIRST_LOAD = "2024-01-01 08:00:00"
SECOND_LOAD = "2024-01-02 08:00:00"
# Priority whose orders are delivered a second time in the second batch.
REDELIVERED_PRIORITY = "1-URGENT"
# The largest amount that decimal(18,2) holds.
LARGEST_AMOUNT = "9999999999999999.99"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _order_date() -> F.Column:
    return F.to_date("o_orderdate")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    total = F.col("o_totalprice").cast(MONEY)
    return o.select(
        F.col("o_custkey").cast("string").alias("AccountNo"),
        F.when(F.col("o_orderkey") % 97 == 0, F.lit(None).cast("date"))
        .otherwise(_order_date())
        .alias("Date"),
        F.col("o_orderpriority").alias("TransactionDetails"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(None).cast("string"))
        .otherwise((F.col("o_orderkey") % 1000).cast("string"))
        .alias("CHQNo"),
        F.date_add(_order_date(), 2).alias("ValueDate"),
        F.when(F.col("o_orderstatus") == "F", total).alias("WithdrawalAMT"),
        F.when(F.col("o_orderstatus") == "O", total).alias("DepositAMT"),
        total.alias("BalanceAMT"),
        F.col("o_orderkey").alias("TxnNo"),
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze as after two loads: every transaction at ``FIRST_LOAD``, and the
    urgent ones delivered again at ``SECOND_LOAD``."""
    t = transactions(spark, sf_dir)
    first = t.withColumn("IngestionTime", ntz_literal(FIRST_LOAD))
    again = t.filter(F.col("TransactionDetails") == REDELIVERED_PRIORITY).withColumn(
        "IngestionTime", ntz_literal(SECOND_LOAD)
    )
    return first.unionByName(again)


def _date_text(day: F.Column) -> F.Column:
    """A day as the workbook reader or a bank export writes it: with or without
    a time, ISO, day-month or month/day."""
    form = F.col("o_orderkey") % 5
    return (
        F.when(form == 1, F.concat(day.cast("string"), F.lit(" 10:30:00")))
        .when(form == 2, F.concat(day.cast("string"), F.lit("T00:00:00")))
        .when(form == 3, F.date_format(day, "dd-MMM-yy"))
        .when(form == 4, F.date_format(day, "MM/dd/yyyy"))
        .otherwise(day.cast("string"))
    )


def raw_text(spark: SparkSession, sf_dir: str, large_amounts: bool = False) -> DataFrame:
    """The workbook as read: source headers, every cell text, apostrophes on
    account numbers, dates in several forms and some unparsable ones, ``NaN``,
    infinite and oversized amounts and a ``.`` column. With ``large_amounts``
    some balances are the largest the target type holds."""
    o = table(spark, sf_dir, "orders")
    total_text = F.col("o_totalprice").cast(MONEY).cast("string")
    odd = F.floor(F.col("o_orderkey") / 89) % 3
    balance = F.when(F.col("o_orderkey") % 101 == 0, F.lit(LARGEST_AMOUNT)).otherwise(total_text) if large_amounts else total_text
    return o.select(
        F.concat(F.col("o_custkey").cast("string"), F.lit("'")).alias("Account No"),
        F.when(F.col("o_orderkey") % 97 == 0, F.lit("not a date")).otherwise(_date_text(_order_date())).alias("DATE"),
        F.col("o_orderpriority").alias("TRANSACTION DETAILS"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(None).cast("string"))
        .otherwise((F.col("o_orderkey") % 1000).cast("string"))
        .alias("CHQ.NO."),
        F.date_add(_order_date(), 2).cast("string").alias("VALUE DATE"),
        F.when(F.col("o_orderstatus") == "F", total_text)
        .when((F.col("o_orderkey") % 89 == 0) & (odd == 0), F.lit("NaN"))
        .when((F.col("o_orderkey") % 89 == 0) & (odd == 1), F.lit("1e20"))
        .when(F.col("o_orderkey") % 89 == 0, F.lit("Infinity"))
        .alias("WITHDRAWAL AMT"),
        F.when(F.col("o_orderstatus") == "O", total_text).alias("DEPOSIT AMT"),
        balance.alias("BALANCE AMT"),
        F.lit(".").alias("."),
    )
