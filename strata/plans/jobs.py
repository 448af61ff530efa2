"""Layer jobs (B1-B3): workbook -> bronze -> silver -> gold.

Each job is one lazy plan ending in one write; the DQ step after each hop is
in ``strata.operators.quality``.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.operators.aggregate import account_summary
from strata.plans import fixtures as fx
from strata.sinks.tables import LoadResult, load_partitioned, load_table, observe, observed, table_exists

# Fixed values of the silver key: seven columns joined without separator;
# the last four default to '' when NULL.
KEY_COLUMNS = (
    "AccountNo",
    "Date",
    "TransactionDetails",
    "CHQNo",
    "WithdrawalAMT",
    "DepositAMT",
    "BalanceAMT",
)
KEY_NULLS_AS_EMPTY = ("CHQNo", "WithdrawalAMT", "DepositAMT", "BalanceAMT")
SILVER_ORDER = ("Date", "IngestionTime")


def transaction_key() -> F.Column:
    return C.surrogate_key(KEY_COLUMNS, sep="", null_as={c: "" for c in KEY_NULLS_AS_EMPTY})


def prepared_transactions(raw_text: DataFrame) -> DataFrame:
    """Source headers renamed, apostrophes stripped, the ``.`` column dropped;
    cells are still text."""
    df = C.rename_columns(raw_text, fx.SOURCE_HEADERS)
    df = df.withColumn("AccountNo", C.strip_chars("AccountNo", "'"))
    return C.clean_columns(df, ["."])


def clean_transactions_frame(raw_text: DataFrame) -> DataFrame:
    """B1 body: rename, strip apostrophes, type, drop the ``.`` column."""
    return C.conform(prepared_transactions(raw_text), fx.TRANSACTION_SCHEMA)


def job_time(now: _dt.datetime | str | None) -> _dt.datetime | str:
    """The load time of a job, taken once: a lazy clock would give another time
    each time a plan runs again."""
    return now if now is not None else _dt.datetime.now(_dt.UTC).replace(tzinfo=None)


def bronze_transactions(
    spark: SparkSession,
    raw_text: DataFrame,
    table: str,
    now: _dt.datetime | str | None = None,
    tz: str = "Asia/Jakarta",
) -> tuple[LoadResult, DataFrame]:
    """B1: clean a workbook frame, stamp the load time and append to bronze.

    Returns the load result, with the cells per column that typing had to drop,
    and the loaded batch as bronze holds it (for the DQ step)."""
    now = job_time(now)
    prepared = prepared_transactions(raw_text)
    typed, counts = C.conform_counted(prepared, fx.TRANSACTION_SCHEMA)
    counted, seen = observe(typed, *[c.alias(n) for n, c in counts.items()])
    batch = C.stamp_ingestion(counted.select(*fx.TRANSACTION_SCHEMA.names), "IngestionTime", tz, now)
    result = load_table(spark, table, batch)
    failures = {n: int(v) for n, v in (observed(seen) or {}).items() if v}
    loaded = spark.table(table).filter(F.col("IngestionTime") == C.local_time(tz, now))
    return replace(result, failures=failures), loaded


def keyed_bronze(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("Id", transaction_key())


def silver_transactions(
    spark: SparkSession,
    bronze: DataFrame,
    table: str,
    rejects_table: str | None = None,
) -> LoadResult:
    """B2: key, de-duplicate (latest by date then load time) and upsert into
    the date-partitioned silver table. Rows whose key is NULL (no date) would
    all collapse into one group; they go to ``rejects_table`` instead, once per
    load: of every row (load time included) those that the table already holds
    are not added again, so a second load with the same time adds its own."""
    keyed = keyed_bronze(bronze)
    if rejects_table:
        rejects = keyed.filter(F.col("Id").isNull())
        if table_exists(spark, rejects_table):
            held = spark.table(rejects_table)
            names = [F.col(f"`{f.name}`") if f.name in held.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in rejects.schema]
            rejects = rejects.exceptAll(held.select(*names))
        load_table(spark, rejects_table, rejects)
    tie = ["TxnNo"] if "TxnNo" in bronze.columns else []
    return load_partitioned(
        spark,
        table,
        keyed.filter(F.col("Id").isNotNull()),
        keys=["Id"],
        order_by=SILVER_ORDER,
        date_col="Date",
        fallback_date_col="ValueDate",
        tie_break=tie,
    )


def gold_accounts(spark: SparkSession, silver: DataFrame, table: str) -> LoadResult:
    """Per-account aggregate upserted on ``AccountNo``."""
    return load_table(spark, table, account_summary(silver), keys="AccountNo")


# --- DQ after each hop (Q5-Q7) ----------------------------------------------


def bronze_quality(
    batch: DataFrame,
    bronze: DataFrame,
    file_path: str,
    table_name: str = "transactions_raw",
    data_format: str = "xlsx",
    now: _dt.datetime | str | None = None,
    scope: str = "table",
) -> DataFrame:
    """Q5: this load's rows against bronze on ``AccountNo``.

    ``scope="table"`` compares with the whole bronze table, which is
    append-only, so observations FAIL from the second load on (as in the
    original); ``scope="batch"`` compares only the bronze rows that carry
    this batch's ingestion time."""
    from strata.operators.quality import dq_record, reconcile

    if scope == "batch":
        stamps = batch.select("IngestionTime").distinct()
        bronze = bronze.join(stamps, "IngestionTime", "left_semi")
    elif scope != "table":
        raise ValueError(f"unknown scope {scope!r}")
    rec = reconcile(batch, bronze, "AccountNo")
    return dq_record(rec, "integration", "xlsx_to_bronze", data_format, file_path, table_name, now)


def silver_quality(
    bronze: DataFrame,
    silver: DataFrame,
    file_path: str,
    table_name: str = "transactions_clean",
    now: _dt.datetime | str | None = None,
) -> DataFrame:
    """Q6: keyed bronze against silver on ``Id``; duplicates show as an
    observation FAIL while distinct keys PASS."""
    from strata.operators.quality import dq_record, reconcile

    rec = reconcile(keyed_bronze(bronze), silver, "Id")
    return dq_record(rec, "platform", "bronze_to_silver", "parquet", file_path, table_name, now)


def gold_quality(
    silver: DataFrame,
    gold: DataFrame,
    file_path: str,
    table_name: str = "transactions_datamart",
    now: _dt.datetime | str | None = None,
) -> DataFrame:
    """Q7: silver re-aggregated against gold on ``AccountNo``."""
    from strata.operators.quality import dq_record, reconcile

    rec = reconcile(account_summary(silver), gold, "AccountNo")
    return dq_record(rec, "datamart", "silver_to_gold", "parquet", file_path, table_name, now)


def silver_frame(bronze: DataFrame) -> DataFrame:
    """What B2 stores, as a frame: keyed, NULL keys dropped, latest per key,
    partition date added."""
    from strata.operators.dedup import latest_per_key

    keyed = keyed_bronze(bronze).filter(F.col("Id").isNotNull())
    tie = ["TxnNo"] if "TxnNo" in bronze.columns else []
    return latest_per_key(keyed, ["Id"], SILVER_ORDER, tie).withColumn(
        "Date_Partition", C.partition_date("Date", "ValueDate")
    )


# --- the three layers in sequence (B6) -----------------------------------------


def run_medallion(
    spark: SparkSession,
    workbook_paths: str | list[str],
    database: str,
    source_name: str,
    sheet: str = "Sheet1",
    now: _dt.datetime | str | None = None,
    bronze_source: str | None = None,
    silver_source: str | None = None,
) -> DataFrame:
    """B1 -> Q5 -> B2 -> Q6 -> B3 -> Q7 with the monitoring table upserted
    after each hop; returns the monitoring table.

    ``source_name`` is the file name recorded in the DQ record of the first
    hop (the physical paths may be many part files); ``bronze_source`` and
    ``silver_source`` name the sources of the later hops in their records
    (default: the table names)."""
    from strata.operators.quality import dq_report, monitoring
    from strata.sinks.tables import ensure_database
    from strata.sources.xlsx import read_xlsx

    now = job_time(now)
    ensure_database(spark, database)
    bronze_t = f"{database}.transactions_raw"
    silver_t = f"{database}.transactions_clean"
    gold_t = f"{database}.transactions_datamart"
    monitor = f"{database}.quality_monitoring"

    raw_text = read_xlsx(spark, workbook_paths, sheet)
    _, batch = bronze_transactions(spark, raw_text, bronze_t, now=now)
    dq_report(spark, monitor, bronze_quality(batch, spark.table(bronze_t), source_name, now=now))

    bronze = spark.table(bronze_t)
    silver_transactions(spark, bronze, silver_t, rejects_table=f"{database}.transactions_rejects")
    dq_report(spark, monitor, silver_quality(bronze, spark.table(silver_t), bronze_source or bronze_t, now=now))

    silver = spark.table(silver_t)
    gold_accounts(spark, silver, gold_t)
    dq_report(spark, monitor, gold_quality(silver, spark.table(gold_t), silver_source or silver_t, now=now))
    return monitoring(spark, monitor)
