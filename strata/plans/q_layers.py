"""Driver queries for the projection and layer operators (P*, N1, A1-A3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.operators.aggregate import account_summary
from strata.operators.dedup import latest_per_key
from strata.plans import fixtures as fx
from strata.plans import oracle as O
from strata.plans.jobs import clean_transactions_frame, prepared_transactions, transaction_key
from strata.plans.registry import query

# Fixed values used by the queries below.
FIXED_NOW = "2024-05-01 20:30:00"  # UTC wall clock of a load
MISSING_DATE_DEFAULT = "1900-01-01"


@query(
    "gold_account_summary",
    "WITH " + O.TRANSACTIONS + ", src AS (SELECT * FROM transactions)" + O.ACCOUNT_SUMMARY,
)
def gold_account_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return account_summary(fx.transactions(spark, sf_dir))


@query(
    "clean_transactions",
    "WITH "
    + O.RAW_TEXT
    + """
SELECT replace("Account No", '''', '') AS AccountNo,
       """
    + O.typed_date("DATE")
    + """ AS Date,
       "TRANSACTION DETAILS" AS TransactionDetails,
       "CHQ.NO." AS CHQNo,
       """
    + O.typed_date("VALUE DATE")
    + " AS ValueDate, "
    + O.typed_money("WITHDRAWAL AMT")
    + " AS WithdrawalAMT, "
    + O.typed_money("DEPOSIT AMT")
    + " AS DepositAMT, "
    + O.typed_money("LARGE BALANCE AMT")
    + " AS BalanceAMT FROM raw_text",
)
def clean_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_transactions_frame(fx.raw_text(spark, sf_dir, large_amounts=True))


def _failures_sql(name: str, column: str, typed: str) -> str:
    lost = f'"{column}" IS NOT NULL AND lower("{column}") <> \'nan\' AND {typed} IS NULL'
    return f"SELECT '{name}' AS column_name, count(*) FILTER (WHERE {lost}) AS failures FROM raw_text"


@query(
    "cast_failures",
    "WITH "
    + O.RAW_TEXT
    + " UNION ALL ".join(
        [
            _failures_sql("Date", "DATE", O.typed_date("DATE")),
            _failures_sql("ValueDate", "VALUE DATE", O.typed_date("VALUE DATE")),
            _failures_sql("WithdrawalAMT", "WITHDRAWAL AMT", O.typed_money("WITHDRAWAL AMT")),
            _failures_sql("DepositAMT", "DEPOSIT AMT", O.typed_money("DEPOSIT AMT")),
            _failures_sql("BalanceAMT", "LARGE BALANCE AMT", O.typed_money("LARGE BALANCE AMT")),
        ]
    ),
)
def cast_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: cells of the workbook that typing turns into NULL, per typed column."""
    prepared = prepared_transactions(fx.raw_text(spark, sf_dir, large_amounts=True))
    counts = C.cast_failures(prepared, fx.TRANSACTION_SCHEMA)
    names = [f.name for f in fx.TRANSACTION_SCHEMA.fields if f.dataType.typeName() != "string"]
    one = prepared.agg(*[counts[n].alias(n) for n in names])
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).alias("failures")) for n in names]))
    return one.select(pairs.alias("p")).select("p.column_name", "p.failures")


@query(
    "ingestion_stamp",
    "WITH "
    + O.TRANSACTIONS
    + f"""
SELECT *, TIMESTAMP '{FIXED_NOW}' + INTERVAL 7 HOUR AS IngestionTime FROM transactions""",
)
def ingestion_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.stamp_ingestion(fx.transactions(spark, sf_dir), "IngestionTime", "Asia/Jakarta", FIXED_NOW)


@query(
    "fill_missing_date",
    "WITH "
    + O.TRANSACTIONS
    + f"""
SELECT TxnNo, coalesce(Date, DATE '{MISSING_DATE_DEFAULT}') AS Date,
       CAST(BalanceAMT AS DOUBLE) AS BalanceFloat
FROM transactions""",
)
def fill_missing_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fx.transactions(spark, sf_dir)
    return t.select(
        "TxnNo",
        C.fill_missing_date("Date", MISSING_DATE_DEFAULT).alias("Date"),
        C.to_float("BalanceAMT").alias("BalanceFloat"),
    )


@query(
    "surrogate_key",
    "WITH "
    + O.TRANSACTIONS
    + f"""
SELECT TxnNo, {O.SURROGATE_KEY} AS Id, sha256(AccountNo) AS AccountHash FROM transactions""",
)
def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fx.transactions(spark, sf_dir)
    return t.select("TxnNo", transaction_key().alias("Id"), C.sha256_hex("AccountNo").alias("AccountHash"))


@query(
    "partition_date",
    "WITH "
    + O.TRANSACTIONS
    + """
SELECT TxnNo, coalesce(Date, ValueDate) AS Date_Partition FROM transactions""",
)
def partition_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fx.transactions(spark, sf_dir)
    return t.select("TxnNo", C.partition_date("Date", "ValueDate").alias("Date_Partition"))


@query(
    "file_stem",
    """
SELECT page_id,
       CASE WHEN url IS NULL OR url = '' THEN 'unknown'
            ELSE split_part(lower(regexp_extract(rtrim(url, '/'), '[^/]*$')), '.', 1) END AS file_name
FROM pages""",
)
def file_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fx.table(spark, sf_dir, "pages")
    return p.select("page_id", C.file_stem("url").alias("file_name"))


@query(
    "latest_per_key_raw",
    "WITH "
    + O.RAW
    + f""",
keyed AS (SELECT *, {O.SURROGATE_KEY} AS Id FROM raw),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY Id
            ORDER BY Date DESC NULLS LAST, IngestionTime DESC NULLS LAST, TxnNo DESC NULLS LAST) AS rn
  FROM keyed)
SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1""",
)
def latest_per_key_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = fx.raw(spark, sf_dir).withColumn("Id", transaction_key())
    return latest_per_key(keyed, ["Id"], ["Date", "IngestionTime"], tie_break=["TxnNo"])


LINEITEM_ORDER = (
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
)


@query(
    "latest_lineitem",
    """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY """
    + ", ".join(f"{c} DESC NULLS LAST" for c in LINEITEM_ORDER)
    + """) AS rn
  FROM lineitem) WHERE rn = 1""",
)
def latest_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = fx.table(spark, sf_dir, "lineitem")
    return latest_per_key(li, ["l_orderkey", "l_linenumber"], LINEITEM_ORDER[:1], tie_break=LINEITEM_ORDER[1:])
