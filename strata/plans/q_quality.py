"""Driver queries for profiling and data quality.

Profile values are doubles computed by different algorithms in Spark and in
DuckDB, so the registered queries print them with seven significant digits
on both sides (see ``_sig``); the operators themselves return doubles.
"""

from __future__ import annotations

import datetime as _dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.aggregate import account_summary
from strata.operators.profile import QUANTILES, TOP_K, _pct_name, compare_profiles, profile
from strata.operators.quality import dq_record, dq_report, monitoring, reconcile
from strata.plans import fixtures as fx
from strata.plans import jobs
from strata.plans import oracle as O
from strata.plans.registry import query
from strata.session import scratch_database
from strata.sinks.tables import load_table

# Fixed values of the DQ scenario.
REPORT_NOW = "2024-05-01 20:30:00"  # UTC; 2024-05-02 03:30 on the UTC+7 clock
NEXT_DAY_NOW = "2024-05-02 20:30:00"
WORKBOOK_PATH = "/landing/bank/Transactions_2024.XLSX"
BRONZE_PATH = "/lake/bronze_data/transactions_raw/"
SILVER_PATH = "/lake/silver_data/transactions_clean"
PROFILE_SPLIT = "1998-06-01 00:00:00"  # orders before / from this date


# Profile values are printed with seven significant digits. The rounding is
# done numerically with the same IEEE steps in both engines (mantissa scaled
# to 7 digits, floor(x + 0.5)), so a value both engines compute bit-identically
# prints identically even on an exact tie, where Java's and C's formatters
# round differently; only float noise between engines (relative ~1e-15) can
# differ, and only if it straddles a rounding boundary. Values within 1e-9 of
# zero print as zero (noise around an exact zero).
SIG = 7


def _sig(v: F.Column) -> F.Column:
    e = F.floor(F.log10(F.abs(v))).cast("double")
    scale = F.pow(F.lit(10.0), e)
    m = v / scale
    r = F.floor(m * F.lit(10.0 ** (SIG - 1)) + F.lit(0.5)).cast("double") / F.lit(10.0 ** (SIG - 1))
    return F.when(F.abs(v) < F.lit(1e-9), F.lit(0.0)).otherwise(r * scale)


def _fmt(col: str) -> F.Column:
    v = F.col(col)
    return F.when(v.isNotNull(), F.format_string(f"%.{SIG - 1}e", _sig(v)))


def _fmt_sql(value: str) -> str:
    e = f"floor(log10(abs({value})))"
    m = f"({value}) / pow(10.0, {e})"
    r = f"floor({m} * {10.0 ** (SIG - 1)} + 0.5) / {10.0 ** (SIG - 1)} * pow(10.0, {e})"
    return (
        f"CASE WHEN {value} IS NULL THEN NULL WHEN abs({value}) < 1e-9 THEN printf('%.{SIG - 1}e', 0.0) "
        f"ELSE printf('%.{SIG - 1}e', {r}) END"
    )


# Metrics that are counts: printed whole.
COUNTS = ("n", "missing", "n_distinct", "zeros", "negatives", "true", "false")


def _formatted(p: DataFrame) -> DataFrame:
    whole = F.col("metric").isin(*COUNTS) | F.col("metric").startswith("top_")
    value = F.when(whole, F.col("value").cast("long").cast("string")).otherwise(_fmt("value"))
    return p.select("column_name", "metric", value.alias("value"), "text")


def _formatted_sql(value: str = "value") -> str:
    names = ", ".join(f"'{c}'" for c in COUNTS)
    return (
        f"CASE WHEN metric IN ({names}) OR starts_with(metric, 'top_') THEN CAST(CAST({value} AS BIGINT) AS VARCHAR) "
        f"ELSE {_fmt_sql(value)} END"
    )


# --- SQL builders for the oracle --------------------------------------------


def _numeric_metrics_sql(c: str) -> list[tuple[str, str]]:
    x = f"CAST({c} AS DOUBLE)"
    m = [
        ("n", "count(*)"),
        ("missing", f"count(*) FILTER (WHERE {c} IS NULL)"),
        ("n_distinct", f"count(DISTINCT {c})"),
        ("min", f"min({x})"),
        ("max", f"max({x})"),
        ("mean", f"avg({x})"),
        ("std", f"stddev_samp({x})"),
        ("variance", f"var_samp({x})"),
        ("sum", f"sum({x})"),
        ("zeros", f"count(*) FILTER (WHERE {x} = 0)"),
        ("negatives", f"count(*) FILTER (WHERE {x} < 0)"),
        ("cv", f"CASE WHEN avg({x}) <> 0 THEN stddev_samp({x}) / avg({x}) END"),
        ("skewness", f"skewness({x})"),
        ("kurtosis", f"kurtosis({x})"),
    ]
    m += [(_pct_name(p), f"quantile_cont({x}, {p})") for p in QUANTILES]
    m.append(("iqr", f"quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25)"))
    return m


def _unpivot_sql(rel: str, metrics: list[tuple[str, str, str]]) -> str:
    """One aggregate over ``rel``; metrics are (column, metric, expr)."""
    cols = ",\n    ".join(f'CAST({e} AS DOUBLE) AS "{c}|{m}"' for c, m, e in metrics)
    return f"""(SELECT split_part(name, '|', 1) AS column_name, split_part(name, '|', 2) AS metric, value
   FROM (UNPIVOT (SELECT {cols} FROM {rel}) ON COLUMNS(*) INTO NAME name VALUE value))"""


def _numeric_profile_sql(rel: str, cols: list[str]) -> str:
    metrics = [(c, m, e) for c in cols for m, e in _numeric_metrics_sql(c)]
    # UNPIVOT drops NULL values; no metric here is NULL for these columns.
    return _unpivot_sql(rel, metrics)


ORDER_NUMERIC = ["o_orderkey", "o_custkey", "o_totalprice"]


@query(
    "profile_orders",
    f"""
SELECT column_name, metric, {_formatted_sql()} AS value, CAST(NULL AS VARCHAR) AS text
FROM {_numeric_profile_sql("orders", ORDER_NUMERIC)}""",
)
def profile_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = fx.table(spark, sf_dir, "orders")
    return _formatted(profile(o, ORDER_NUMERIC))


def _text_profile_sql(rel: str, cols: list[str]) -> str:
    metrics = []
    for c in cols:
        metrics += [
            (c, "n", "count(*)"),
            (c, "missing", f"count(*) FILTER (WHERE {c} IS NULL)"),
            (c, "n_distinct", f"count(DISTINCT {c})"),
            (c, "min_length", f"min(length({c}))"),
            (c, "mean_length", f"avg(length({c}))"),
            (c, "max_length", f"max(length({c}))"),
        ]
    tops = " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, 'top_' || rk AS metric, CAST(cnt AS DOUBLE) AS value, t AS text
   FROM (SELECT {c} AS t, count(*) AS cnt,
                row_number() OVER (ORDER BY count(*) DESC, {c} ASC) AS rk
         FROM {rel} WHERE {c} IS NOT NULL GROUP BY {c}) WHERE rk <= {TOP_K}"""
        for c in cols
    )
    return f"""SELECT column_name, metric, value, CAST(NULL AS VARCHAR) AS text FROM {_unpivot_sql(rel, metrics)}
UNION ALL {tops}"""


TEXT_COLUMNS = ["lang", "source"]


MIXED_SQL = """(SELECT CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_totalprice AS DOUBLE) END AS price, o_orderkey FROM orders)"""


@query(
    "profile_mixed",
    f"""
SELECT column_name, metric, {_formatted_sql()} AS value, CAST(NULL AS VARCHAR) AS text
FROM {_numeric_profile_sql(MIXED_SQL, ["price"])}
UNION ALL SELECT 'parts', 'n', CAST(count(*) AS VARCHAR), NULL FROM orders
UNION ALL SELECT 'parts', 'missing', CAST(count(*) FILTER (WHERE o_orderkey % 5 = 0) AS VARCHAR), NULL FROM orders""",
)
def profile_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN counts as missing, and a column of a type without metrics is
    listed with its rows and missing values."""
    o = fx.table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    mixed = o.select(
        F.when(key % 7 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice").cast("double")).alias("price"),
        F.when(key % 5 != 0, F.array(key, F.col("o_custkey"))).alias("parts"),
    )
    return _formatted(profile(mixed))


@query(
    "profile_text",
    f"""
SELECT column_name, metric, {_formatted_sql()} AS value, text
FROM ({_text_profile_sql("documents", TEXT_COLUMNS)})""",
)
def profile_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = fx.table(spark, sf_dir, "documents")
    return _formatted(profile(d, TEXT_COLUMNS))


@query(
    "profile_date",
    f"""
SELECT column_name, metric, {_formatted_sql()} AS value, text FROM (
  SELECT 'ts' AS column_name, 'n' AS metric, CAST(count(*) AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS text FROM events
  UNION ALL SELECT 'ts', 'missing', CAST(count(*) FILTER (WHERE ts IS NULL) AS DOUBLE), NULL FROM events
  UNION ALL SELECT 'ts', 'n_distinct', CAST(count(DISTINCT ts) AS DOUBLE), NULL FROM events
  UNION ALL SELECT 'ts', 'min', NULL, strftime(min(ts), '%Y-%m-%d %H:%M:%S') FROM events
  UNION ALL SELECT 'ts', 'max', NULL, strftime(max(ts), '%Y-%m-%d %H:%M:%S') FROM events
  UNION ALL SELECT 'ts', 'range_days', CAST(date_diff('day', CAST(min(ts) AS DATE), CAST(max(ts) AS DATE)) AS DOUBLE), NULL
            FROM events)""",
)
def profile_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = fx.table(spark, sf_dir, "events")
    return _formatted(profile(e, ["ts"]))


BOOL_METRICS = [
    (name, metric, expr)
    for name, src in (("is_quality", "quality"), ("is_toxic", "toxic"))
    for metric, expr in (
        ("n", "count(*)"),
        ("missing", f"count(*) FILTER (WHERE {src} IS NULL)"),
        ("n_distinct", f"count(DISTINCT {src} = 1)"),
        ("true", f"count(*) FILTER (WHERE {src} = 1)"),
        ("false", f"count(*) FILTER (WHERE {src} <> 1)"),
    )
]


@query(
    "profile_boolean",
    f"""
SELECT column_name, metric, {_formatted_sql()} AS value, CAST(NULL AS VARCHAR) AS text
FROM {_unpivot_sql("labels", BOOL_METRICS)}""",
)
def profile_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = fx.table(spark, sf_dir, "labels").select(
        (F.col("quality") == 1).alias("is_quality"), (F.col("toxic") == 1).alias("is_toxic")
    )
    return _formatted(profile(lab))


@query(
    "compare_profiles",
    f"""
WITH a AS {_numeric_profile_sql(f"(SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{PROFILE_SPLIT}')", ORDER_NUMERIC)},
b AS {_numeric_profile_sql(f"(SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '{PROFILE_SPLIT}')", ORDER_NUMERIC)}
SELECT coalesce(a.column_name, b.column_name) AS column_name, coalesce(a.metric, b.metric) AS metric,
       {_fmt_sql("a.value")} AS value_1,
       {_fmt_sql("b.value")} AS value_2,
       {_fmt_sql("a.value - b.value")} AS difference,
       CAST(NULL AS VARCHAR) AS text_1, CAST(NULL AS VARCHAR) AS text_2
FROM a FULL OUTER JOIN b ON a.column_name = b.column_name AND a.metric = b.metric""",
)
def compare_profiles_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = fx.table(spark, sf_dir, "orders")
    split = F.lit(PROFILE_SPLIT).cast("timestamp_ntz")
    cmp = compare_profiles(
        profile(o.filter(F.col("o_orderdate") < split), ORDER_NUMERIC),
        profile(o.filter(F.col("o_orderdate") >= split), ORDER_NUMERIC),
    )
    return cmp.select(
        "column_name",
        "metric",
        _fmt("value_1").alias("value_1"),
        _fmt("value_2").alias("value_2"),
        _fmt("difference").alias("difference"),
        "text_1",
        "text_2",
    )


# --- reconciliation -----------------------------------------------------------


def _reconcile_sql(src: str, skey: str, dst: str, dkey: str) -> str:
    def status(a: str, b: str) -> str:
        return f"CASE WHEN {a} = 0 OR {b} = 0 THEN 'UNKNOWN' WHEN {a} = {b} THEN 'PASS' ELSE 'FAIL' END"

    def diff(a: str, b: str) -> str:
        return f"CASE WHEN {a} = 0 OR {b} = 0 THEN NULL ELSE {a} - {b} END"

    return f"""SELECT {status("so", "dn")} AS Status_Observation, so AS Source_Observation,
       dn AS Destination_Observation, {diff("so", "dn")} AS Difference_Observation,
       {status("sr", "dr")} AS Status_Rows, sr AS Source_Rows, dr AS Destination_Rows,
       {diff("sr", "dr")} AS Difference_Rows
FROM (SELECT count(*) AS so, count(DISTINCT {skey}) AS sr FROM {src}) a,
     (SELECT count(*) AS dn, count(DISTINCT {dkey}) AS dr FROM {dst}) b"""


@query(
    "reconcile_pass",
    "WITH " + O.TRANSACTIONS + "\n" + _reconcile_sql("transactions", "AccountNo", "transactions", "AccountNo"),
)
def reconcile_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source frame against the bronze table it was loaded into."""
    db = scratch_database(spark)
    t = fx.transactions(spark, sf_dir)
    load_table(spark, f"{db}.transactions_raw", t)
    return reconcile(t, spark.table(f"{db}.transactions_raw"), "AccountNo")


SILVER_SQL = f""",
keyed AS (SELECT *, {O.SURROGATE_KEY} AS Id FROM raw),
silver AS (
  SELECT * EXCLUDE (rn), coalesce(Date, ValueDate) AS Date_Partition FROM (
    SELECT *, row_number() OVER (PARTITION BY Id
              ORDER BY Date DESC NULLS LAST, IngestionTime DESC NULLS LAST, TxnNo DESC NULLS LAST) AS rn
    FROM keyed WHERE Id IS NOT NULL) WHERE rn = 1)"""


@query(
    "reconcile_fail",
    "WITH " + O.RAW + SILVER_SQL + "\n" + _reconcile_sql("keyed", "Id", "silver", "Id"),
)
def reconcile_fail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw bronze against de-duplicated silver on ``Id``."""
    raw = fx.raw(spark, sf_dir)
    return reconcile(jobs.keyed_bronze(raw), jobs.silver_frame(raw), "Id")


@query(
    "reconcile_unknown",
    "WITH "
    + O.TRANSACTIONS
    + ", early AS (SELECT * FROM transactions WHERE ValueDate < Date)\n"
    + _reconcile_sql("transactions", "AccountNo", "early", "AccountNo"),
)
def reconcile_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty destination (value dates before booking dates) gives
    UNKNOWN with no difference."""
    t = fx.transactions(spark, sf_dir)
    return reconcile(t, t.filter(F.col("ValueDate") < F.col("Date")), "AccountNo")


# --- monitoring records -------------------------------------------------------


def _py_stem(path: str) -> str:
    return path.rstrip("/").split("/")[-1].lower().split(".")[0] if path else "unknown"


def _record_sql(recon_sql: str, now: str, etl_type: str, process: str, fmt: str, path: str, table: str) -> str:
    """Monitoring record with the identity computed independently in Python."""
    local = _dt.datetime.fromisoformat(now) + _dt.timedelta(hours=7)
    ident = f"{local:%Y%m%d}_{_py_stem(path)}_{etl_type}_{process}"
    return f"""SELECT '{hashlib.sha256(ident.encode()).hexdigest()}' AS ID,
       DATE '{local:%Y-%m-%d}' AS Updated_Date, TIMESTAMP '{local:%Y-%m-%d %H:%M:%S}' AS Updated_Timestamp,
       '{etl_type}' AS Type, '{process}' AS Process, '{fmt}' AS Type_File_Sources,
       '{path.lower()}' AS File_Sources, '{table}' AS Table_Name, r.*
FROM ({recon_sql}) r"""


BRONZE_RECORD_SQL = _record_sql(
    _reconcile_sql("transactions", "AccountNo", "raw", "AccountNo"),
    REPORT_NOW, "integration", "xlsx_to_bronze", "xlsx", WORKBOOK_PATH, "transactions_raw",
)
SILVER_RECORD_SQL = _record_sql(
    _reconcile_sql("keyed", "Id", "silver", "Id"),
    REPORT_NOW, "platform", "bronze_to_silver", "parquet", BRONZE_PATH, "transactions_clean",
)
GOLD_SOURCE_SQL = ", gold AS (WITH src AS (SELECT * FROM silver)" + O.ACCOUNT_SUMMARY + ")"
GOLD_RECORD_SQL = _record_sql(
    _reconcile_sql("gold", "AccountNo", "gold", "AccountNo"),
    REPORT_NOW, "datamart", "silver_to_gold", "parquet", SILVER_PATH, "transactions_datamart",
)


@query("bronze_quality", "WITH " + O.RAW + "\n" + BRONZE_RECORD_SQL)
def bronze_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest batch against the whole (twice loaded) bronze."""
    return jobs.bronze_quality(
        fx.transactions(spark, sf_dir), fx.raw(spark, sf_dir), WORKBOOK_PATH, now=REPORT_NOW
    )


@query("silver_quality", "WITH " + O.RAW + SILVER_SQL + "\n" + SILVER_RECORD_SQL)
def silver_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed bronze against silver."""
    raw = fx.raw(spark, sf_dir)
    return jobs.silver_quality(raw, jobs.silver_frame(raw), BRONZE_PATH, now=REPORT_NOW)


@query("gold_quality", "WITH " + O.RAW + SILVER_SQL + GOLD_SOURCE_SQL + "\n" + GOLD_RECORD_SQL)
def gold_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7: silver re-aggregated against the gold table loaded from it."""
    db = scratch_database(spark)
    silver = jobs.silver_frame(fx.raw(spark, sf_dir))
    jobs.gold_accounts(spark, silver, f"{db}.transactions_datamart")
    return jobs.gold_quality(silver, spark.table(f"{db}.transactions_datamart"), SILVER_PATH, now=REPORT_NOW)


NEXT_DAY_BRONZE_SQL = _record_sql(
    _reconcile_sql("transactions", "AccountNo", "raw", "AccountNo"),
    NEXT_DAY_NOW, "integration", "xlsx_to_bronze", "xlsx", WORKBOOK_PATH, "transactions_raw",
)


@query(
    "dq_report",
    "WITH "
    + O.RAW
    + SILVER_SQL
    + GOLD_SOURCE_SQL
    + f"""
{BRONZE_RECORD_SQL}
UNION ALL {SILVER_RECORD_SQL}
UNION ALL {GOLD_RECORD_SQL}
UNION ALL {NEXT_DAY_BRONZE_SQL}""",
)
def dq_report_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hop records upserted into the monitoring table; the
    bronze record is reported twice the same day (an update) and once the
    next day (an insert)."""
    db = scratch_database(spark)
    table = f"{db}.quality_monitoring"
    t, raw = fx.transactions(spark, sf_dir), fx.raw(spark, sf_dir)
    silver = jobs.silver_frame(raw)
    gold = account_summary(silver)
    for rec in (
        jobs.bronze_quality(t, raw, WORKBOOK_PATH, now=REPORT_NOW),
        jobs.silver_quality(raw, silver, BRONZE_PATH, now=REPORT_NOW),
        dq_record(reconcile(gold, gold, "AccountNo"), "datamart", "silver_to_gold", "parquet",
                  SILVER_PATH, "transactions_datamart", REPORT_NOW),
        jobs.bronze_quality(t, raw, WORKBOOK_PATH, now=REPORT_NOW),
        jobs.bronze_quality(t, raw, WORKBOOK_PATH, now=NEXT_DAY_NOW),
    ):
        dq_report(spark, table, rec)
    return monitoring(spark, table)



MEDALLION_SOURCE = "Transactions.xlsx"

# Bronze as B1 stores it: the workbook rows cleaned and typed (as in the
# clean_transactions oracle), then the silver key and the layers' key sets.
MEDALLION_SQL = (
    "WITH "
    + O.RAW_TEXT
    + """,
bronze AS (
  SELECT replace("Account No", chr(39), '') AS AccountNo,
         """
    + O.typed_date("DATE")
    + """ AS Date,
         "TRANSACTION DETAILS" AS TransactionDetails,
         "CHQ.NO." AS CHQNo,
         """
    + O.typed_money("WITHDRAWAL AMT")
    + " AS WithdrawalAMT, "
    + O.typed_money("DEPOSIT AMT")
    + " AS DepositAMT, "
    + O.typed_money("BALANCE AMT")
    + """ AS BalanceAMT
  FROM raw_text),
keyed AS (SELECT *, """
    + O.SURROGATE_KEY
    + """ AS Id FROM bronze),
silver AS (SELECT DISTINCT Id, AccountNo FROM keyed WHERE Id IS NOT NULL),
gold AS (SELECT DISTINCT AccountNo FROM silver)
"""
)


@query(
    "run_medallion",
    MEDALLION_SQL
    + _record_sql(
        _reconcile_sql("bronze", "AccountNo", "bronze", "AccountNo"),
        REPORT_NOW, "integration", "xlsx_to_bronze", "xlsx", MEDALLION_SOURCE, "transactions_raw",
    )
    + "\nUNION ALL "
    + _record_sql(
        _reconcile_sql("keyed", "Id", "silver", "Id"),
        REPORT_NOW, "platform", "bronze_to_silver", "parquet", BRONZE_PATH, "transactions_clean",
    )
    + "\nUNION ALL "
    + _record_sql(
        _reconcile_sql("gold", "AccountNo", "gold", "AccountNo"),
        REPORT_NOW, "datamart", "silver_to_gold", "parquet", SILVER_PATH, "transactions_datamart",
    ),
)
def run_medallion_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bank workbook (as part files) through all three layers with
    DQ after each hop; returns the monitoring table (three records)."""
    from strata.session import scratch_path
    from strata.plans.workbooks import write_xlsx

    db = scratch_database(spark)
    path = scratch_path(spark, "xlsx", "transactions")
    write_xlsx(fx.raw_text(spark, sf_dir), path, rows_per_file=20_000)
    return jobs.run_medallion(
        spark, path, db, MEDALLION_SOURCE, now=REPORT_NOW, bronze_source=BRONZE_PATH, silver_source=SILVER_PATH
    )


@query(
    "medallion_rerun",
    MEDALLION_SQL
    + """, silver_rows AS (SELECT DISTINCT Id, AccountNo, Date, DepositAMT, BalanceAMT FROM keyed WHERE Id IS NOT NULL),
rejects AS (SELECT AccountNo, BalanceAMT FROM keyed WHERE Id IS NULL)
SELECT 'silver' AS layer, Id AS row_key, AccountNo AS account, Date AS day, CAST(BalanceAMT AS DECIMAL(28,2)) AS amount FROM silver_rows
UNION ALL SELECT 'gold', AccountNo, AccountNo, max(Date), CAST(sum(DepositAMT) AS DECIMAL(28,2)) FROM silver_rows GROUP BY AccountNo
UNION ALL SELECT 'rejects', NULL, AccountNo, NULL, CAST(BalanceAMT AS DECIMAL(28,2)) FROM rejects
UNION ALL SELECT 'rejects', NULL, AccountNo, NULL, CAST(BalanceAMT AS DECIMAL(28,2)) FROM rejects""",
)
def medallion_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B6 run twice over the same workbooks, on two days: silver and gold are as after
    one run, and rejects hold the undated rows once per load."""
    from strata.plans.workbooks import write_xlsx
    from strata.session import scratch_path

    db = scratch_database(spark)
    path = scratch_path(spark, "xlsx", "transactions")
    write_xlsx(fx.raw_text(spark, sf_dir), path, rows_per_file=20_000)
    for now in (REPORT_NOW, NEXT_DAY_NOW):
        jobs.run_medallion(spark, path, db, MEDALLION_SOURCE, now=now)
    amount = lambda c: F.col(c).cast("decimal(28,2)").alias("amount")
    silver = spark.table(f"{db}.transactions_clean").select(
        F.lit("silver").alias("layer"), F.col("Id").alias("row_key"), F.col("AccountNo").alias("account"), F.col("Date").alias("day"), amount("BalanceAMT")
    )
    gold = spark.table(f"{db}.transactions_datamart").select(
        F.lit("gold").alias("layer"), F.col("AccountNo").alias("row_key"), F.col("AccountNo").alias("account"),
        F.col("LastTransactionDate").alias("day"), amount("TotalDeposits"),
    )
    rejects = spark.table(f"{db}.transactions_rejects").select(
        F.lit("rejects").alias("layer"), F.col("Id").alias("row_key"), F.col("AccountNo").alias("account"), F.col("Date").alias("day"), amount("BalanceAMT")
    )
    return silver.unionByName(gold).unionByName(rejects)
