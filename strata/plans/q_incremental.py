"""Driver queries for tables by hash bucket, wider types, order-free loads, the key locator, content reconciliation and
the incremental layers (W3, W5, W6, J1, J2, B1-B3, B6, Q1)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.content import reconcile_contents
from strata.plans import fixtures as fx
from strata.operators.profile import QUANTILES, _pct_name, profile
from strata.operators.profile_state import merged_profile, rank_error
from strata.plans import incremental
from strata.plans import oracle as O
from strata.plans.jobs import prepared_transactions
from strata.plans.q_loads import (
    EVENT_COLS,
    EVENTS_SOURCE_FROM,
    EVENTS_TARGET_BEFORE,
    ORDER_COLS,
    ORDERS_SPLIT_SQL,
    SHIFTED_EVENT_TYPE,
    _pick,
    events_source,
    events_target,
    orders_source,
    orders_target,
)
from strata.plans.registry import query
from strata.session import scratch_database
from strata.sinks.bucketed import keyed_table, load_bucketed
from strata.sinks.compaction import compact_small
from strata.sinks.layout import find_clustered, write_clustered
from strata.sinks.ledger import record_changes
from strata.sinks.located import load_located
from strata.sinks.maintained import refresh_profile
from strata.sinks.quarantine import load_mended, load_typed, open_rows
from strata.sinks.tables import append_table, load_partitioned, load_table

# How the copy that contents are compared with differs from the orders.
LOST, CHANGED, EXTRA_OFFSET = 50, 70, 1_000_000_000


@query(
    "upsert_bucketed",
    "WITH "
    + ORDERS_SPLIT_SQL
    + f"""
SELECT {_pick(ORDER_COLS)}
FROM (SELECT *, 1 AS _t FROM t) t FULL OUTER JOIN (SELECT *, 1 AS _s FROM s) s
  ON t.o_orderkey = s.o_orderkey""",
)
def upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3 / J1 on a table by hash bucket."""
    name = f"{scratch_database(spark)}.orders_by_key"
    for batch in (orders_target(spark, sf_dir), orders_source(spark, sf_dir)):
        load_bucketed(spark, name, batch, "o_orderkey", buckets=16)
    return keyed_table(spark, name)


@query(
    "upsert_wider_type",
    "WITH "
    + ORDERS_SPLIT_SQL
    + """,
tw AS (SELECT o_orderkey, CAST(floor(o_totalprice) AS INTEGER) AS units, CAST(o_totalprice AS DECIMAL(12,1)) AS price,
              CAST(o_orderdate AS DATE) AS at, 1 AS _t FROM t),
sw AS (SELECT o_orderkey, o_totalprice / 4 AS units, CAST(o_totalprice AS DECIMAL(14,2)) AS price, o_orderdate AS at, 1 AS _s FROM s)
SELECT CASE WHEN s._s IS NOT NULL THEN s.o_orderkey ELSE t.o_orderkey END AS o_orderkey,
       CASE WHEN s._s IS NOT NULL THEN s.units ELSE CAST(t.units AS DOUBLE) END AS units,
       CASE WHEN s._s IS NOT NULL THEN s.price ELSE CAST(t.price AS DECIMAL(14,2)) END AS price,
       CASE WHEN s._s IS NOT NULL THEN CAST(s.at AS TIMESTAMP) ELSE CAST(t.at AS TIMESTAMP) END AS at
FROM tw t FULL OUTER JOIN sw s ON t.o_orderkey = s.o_orderkey""",
)
def upsert_wider_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch has a double, a decimal of larger scale and a timestamp where the table holds an int, a smaller
    decimal and a date; the table takes the wider types and no value is cut."""
    name = f"{scratch_database(spark)}.orders_widening"
    day = F.to_date("o_orderdate")
    first = orders_target(spark, sf_dir).select(
        "o_orderkey", F.floor("o_totalprice").cast("int").alias("units"), F.col("o_totalprice").cast("decimal(12,1)").alias("price"), day.alias("at")
    )
    batch = orders_source(spark, sf_dir).select(
        "o_orderkey", (F.col("o_totalprice") / 4).alias("units"), F.col("o_totalprice").cast("decimal(14,2)").alias("price"), F.col("o_orderdate").alias("at")
    )
    load_table(spark, name, first, keys="o_orderkey")
    load_table(spark, name, batch, keys="o_orderkey")
    return spark.table(name)


_EVENTS_SQL = f"""
WITH t AS (SELECT *, CAST(ts AS DATE) AS ts_Partition, 1 AS _t FROM events WHERE ts < TIMESTAMP '{EVENTS_TARGET_BEFORE}'),
s0 AS (SELECT event_id, CASE WHEN event_type = '{SHIFTED_EVENT_TYPE}' THEN ts + INTERVAL 1 DAY ELSE ts END AS ts,
              user_id, event_type, value + 1.0 AS value, props
       FROM events WHERE ts >= TIMESTAMP '{EVENTS_SOURCE_FROM}'),
s AS (SELECT *, CAST(ts AS DATE) AS ts_Partition, 1 AS _s FROM s0)
SELECT {_pick(EVENT_COLS)}
FROM t FULL OUTER JOIN s ON t.event_id = s.event_id"""


@query("upsert_move_partition", _EVENTS_SQL)
def upsert_move_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W5 on the key alone: events that arrive a day later leave their old partition."""
    name = f"{scratch_database(spark)}.events_moving"
    for batch in (events_target(spark, sf_dir), events_source(spark, sf_dir)):
        load_located(spark, name, batch, keys=["event_id"], order_by=["ts"], date_col="ts", buckets=8)
    return spark.table(name)


@query(
    "upsert_out_of_order",
    """
SELECT event_id, max(ts) AS ts, max(version) AS version, CAST(min(ts) AS DATE) AS day, CAST(min(ts) AS DATE) AS day_Partition
FROM (SELECT event_id, ts, 1 AS version FROM events
      UNION ALL SELECT event_id, ts + INTERVAL 1 HOUR, 2 FROM events WHERE event_type <> 'view'
      UNION ALL SELECT event_id, ts + INTERVAL 2 HOUR, 3 FROM events WHERE event_type = 'click')
GROUP BY event_id""",
)
def upsert_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries of the events, the latest first; older rows do not replace newer ones."""
    name = f"{scratch_database(spark)}.events_late"
    e = fx.table(spark, sf_dir, "events").select("event_id", "ts", "event_type", F.to_date("ts").alias("day"))
    later = lambda hours, version: (
        e.withColumn("ts", F.col("ts") + F.expr(f"INTERVAL {hours} HOUR")).withColumn("version", F.lit(version)))
    batches = [later(2, 3).filter("event_type = 'click'"), later(0, 1), later(1, 2).filter("event_type <> 'view'")]
    for batch in batches:
        load_partitioned(spark, name, batch.drop("event_type"), ["event_id"], ["ts"], "day", newest_wins=True)
    return spark.table(name)


def altered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders but for some lost ones, some with another total, some under a new key."""
    o = fx.table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % LOST != 0)
    moved = F.col("o_orderkey") % CHANGED == 1
    return o.select(
        F.when(moved, F.col("o_orderkey") + EXTRA_OFFSET).otherwise(F.col("o_orderkey")).alias("o_orderkey"),
        "o_custkey", "o_orderstatus",
        F.when(F.col("o_orderkey") % CHANGED == 2, F.col("o_totalprice") + 1.0).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate", "o_orderpriority",
    )


@query(
    "reconcile_contents",
    f"""
WITH d AS (SELECT CASE WHEN o_orderkey % {CHANGED} = 1 THEN o_orderkey + {EXTRA_OFFSET} ELSE o_orderkey END AS k,
                  CASE WHEN o_orderkey % {CHANGED} = 2 THEN o_totalprice + 1.0 ELSE o_totalprice END AS p
           FROM orders WHERE o_orderkey % {LOST} <> 0)
SELECT coalesce(s.o_orderkey, d.k) AS o_orderkey,
       CASE WHEN d.k IS NULL THEN 'missing' WHEN s.o_orderkey IS NULL THEN 'extra' ELSE 'changed' END AS difference,
       CAST(s.o_orderkey IS NOT NULL AS BIGINT) AS source_rows, CAST(d.k IS NOT NULL AS BIGINT) AS destination_rows
FROM orders s FULL OUTER JOIN d ON s.o_orderkey = d.k
WHERE d.k IS NULL OR s.o_orderkey IS NULL OR s.o_totalprice <> d.p""",
)
def contents_differ(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1: the keys that are missing, extra or changed."""
    return reconcile_contents(fx.table(spark, sf_dir, "orders"), altered_orders(spark, sf_dir), "o_orderkey").differences


@query(
    "reconcile_bags",
    """
WITH s AS (SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL),
d AS (SELECT l_orderkey, l_partkey, count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem) GROUP BY ALL),
c AS (SELECT coalesce(s.l_orderkey, d.l_orderkey) AS k, coalesce(s.n, 0) AS sn, coalesce(d.n, 0) AS dn
      FROM s FULL OUTER JOIN d ON s.l_orderkey = d.l_orderkey AND s.l_partkey = d.l_partkey),
k AS (SELECT k, sum(sn) AS sn, sum(dn) AS dn, bool_or(sn <> dn) AS apart FROM c GROUP BY k)
SELECT CASE WHEN bool_or(apart) THEN 'FAIL' ELSE 'PASS' END AS status,
       CAST(count_if(apart AND dn = 0) AS BIGINT) AS missing, CAST(count_if(apart AND sn = 0) AS BIGINT) AS extra,
       CAST(count_if(apart AND sn > 0 AND dn > 0) AS BIGINT) AS changed,
       CAST(sum(sn) AS BIGINT) AS source_rows, CAST(sum(dn) AS BIGINT) AS destination_rows
FROM k""",
)
def bags_differ(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 on a key with several rows: lineitem against its distinct lines, by order."""
    li = fx.table(spark, sf_dir, "lineitem")
    lines = li.select("l_orderkey", "l_linenumber", "l_partkey").distinct()
    diff = reconcile_contents(li.select("l_orderkey", "l_partkey"), lines.drop("l_linenumber"), "l_orderkey")
    return diff.summary.select("status", "missing", "extra", "changed", "source_rows", "destination_rows")


# The value dates that each load delivers (from, before); some months come twice.
LOADS = (("", "1994-07-01"), ("1994-04-01", "1996-07-01"), ("1996-07-01", "~"))
LOAD_TIMES = ("2024-05-01 20:30:00", "2024-05-02 20:30:00", "2024-05-03 20:30:00")


def _delivered(text: DataFrame, n: int) -> DataFrame:
    day = F.coalesce(F.col("`VALUE DATE`"), F.lit(""))
    return text.filter((day >= LOADS[n][0]) & (day < LOADS[n][1]))


@query(
    "medallion_incremental",
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
    + f""" AS BalanceAMT,
         "VALUE DATE" AS ValueText
  FROM raw_text),
keyed AS (SELECT *, {O.SURROGATE_KEY} AS Id FROM bronze),
silver_rows AS (SELECT DISTINCT Id, AccountNo, Date, DepositAMT, BalanceAMT FROM keyed WHERE Id IS NOT NULL),
rejects AS (SELECT AccountNo, BalanceAMT, ValueText FROM keyed WHERE Id IS NULL)
SELECT 'silver' AS layer, Id AS row_key, AccountNo AS account, Date AS day, CAST(BalanceAMT AS DECIMAL(28,2)) AS amount FROM silver_rows
UNION ALL SELECT 'gold', AccountNo, AccountNo, max(Date), CAST(sum(DepositAMT) AS DECIMAL(28,2)) FROM silver_rows GROUP BY AccountNo
UNION ALL SELECT 'rejects', NULL, AccountNo, NULL, CAST(BalanceAMT AS DECIMAL(28,2)) FROM rejects
UNION ALL SELECT 'rejects', NULL, AccountNo, NULL, CAST(BalanceAMT AS DECIMAL(28,2)) FROM rejects
WHERE ValueText >= '{LOADS[1][0]}' AND ValueText < '{LOADS[0][1]}'""",
)
def medallion_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B6 in three loads, the second landed twice: each run reads the loads and partitions it has not taken, and the
    layers hold what one run over everything gives."""
    db = scratch_database(spark)
    text = fx.raw_text(spark, sf_dir)
    for n in (0, 1, 1, 2):
        incremental.run_increment(spark, _delivered(text, n), db, f"load-{n}", now=LOAD_TIMES[n], buckets=16)
    amount = lambda c: F.col(c).cast("decimal(28,2)").alias("amount")
    silver = spark.table(f"{db}.transactions_clean").select(
        F.lit("silver").alias("layer"), F.col("Id").alias("row_key"), F.col("AccountNo").alias("account"), F.col("Date").alias("day"), amount("BalanceAMT"))
    gold = keyed_table(spark, f"{db}.transactions_datamart").select(
        F.lit("gold").alias("layer"), F.col("AccountNo").alias("row_key"), F.col("AccountNo").alias("account"),
        F.col("LastTransactionDate").alias("day"), amount("TotalDeposits"))
    rejects = spark.table(f"{db}.transactions_rejects").select(
        F.lit("rejects").alias("layer"), F.col("Id").alias("row_key"), F.col("AccountNo").alias("account"), F.col("Date").alias("day"), amount("BalanceAMT"))
    return silver.unionByName(gold).unionByName(rejects)


@query("compact_small_files", "SELECT *, CAST(ts AS DATE) AS ts_Partition FROM events")
def compact_small_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W7 by file size: late events leave small files in some partitions, and only those are rewritten."""
    name = f"{scratch_database(spark)}.events_late_files"
    e = fx.table(spark, sf_dir, "events").withColumn("ts_Partition", F.to_date("ts"))
    late = F.coalesce((F.dayofmonth("ts") % 7 == 0) & (F.col("event_type") == "click"), F.lit(False))
    load_partitioned(spark, name, e.filter(~late).drop("ts_Partition"), ["event_id"], ["ts"], "ts")
    append_table(spark, name, e.filter(late))
    compact_small(spark, name)
    return spark.table(name)


_TYPED = {
    "AccountNo": "replace(\"Account No\", chr(39), '')",
    "Date": O.typed_date("DATE"),
    "ValueDate": O.typed_date("VALUE DATE"),
    "WithdrawalAMT": O.typed_money("WITHDRAWAL AMT"),
    "DepositAMT": O.typed_money("DEPOSIT AMT"),
    "BalanceAMT": O.typed_money("BALANCE AMT"),
}
_CELLS = {"Date": "DATE", "ValueDate": "VALUE DATE", "WithdrawalAMT": "WITHDRAWAL AMT", "DepositAMT": "DEPOSIT AMT", "BalanceAMT": "BALANCE AMT"}


def _lost(name: str) -> str:
    cell = _CELLS[name]
    return f'("{cell}" IS NOT NULL AND lower("{cell}") <> \'nan\' AND {_TYPED[name]} IS NULL)'


@query(
    "quarantine_cells",
    "WITH "
    + O.RAW_TEXT
    + "\nUNION ALL ".join(
        f"SELECT '{name}' AS column_name, \"{cell}\" AS raw, CAST(count(*) AS BIGINT) AS n FROM raw_text WHERE {_lost(name)} GROUP BY ALL" for name, cell in _CELLS.items()
    ),
)
def quarantine_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: the raw cells behind the quarantined rows, by column."""
    name = f"{scratch_database(spark)}.typed"
    load_typed(spark, name, prepared_transactions(fx.raw_text(spark, sf_dir)), fx.TRANSACTION_SCHEMA, "first")
    cells = open_rows(spark, name).select(F.explode("failures").alias("f"))
    return cells.groupBy(F.col("f.column").alias("column_name"), F.col("f.raw").alias("raw")).agg(F.count(F.lit(1)).alias("n"))


# Fixed value: the day put in the place of unreadable dates.
MENDED_DAY = "2024-01-01"


@query(
    "mended_rows",
    "WITH "
    + O.RAW_TEXT
    + f"""
SELECT {_TYPED["AccountNo"]} AS AccountNo,
       CASE WHEN {_lost("Date")} THEN DATE '{MENDED_DAY}' ELSE {_TYPED["Date"]} END AS Date,
       {_TYPED["BalanceAMT"]} AS BalanceAMT,
       CASE WHEN {_lost("Date")} THEN 'mended' ELSE 'first' END AS load_id
FROM raw_text WHERE NOT ({" OR ".join(_lost(n) for n in _CELLS if n != "Date")})""",
)
def mended_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with an unreadable date are mended and loaded again; those with other lost cells stay in quarantine."""
    name = f"{scratch_database(spark)}.typed"
    load_typed(spark, name, prepared_transactions(fx.raw_text(spark, sf_dir)), fx.TRANSACTION_SCHEMA, "first")
    dates = open_rows(spark, name).filter(F.exists("failures", lambda f: f["column"] == "Date"))
    fixes = dates.select("row_id", F.lit("Date").alias("column"), F.lit(MENDED_DAY).alias("value"))
    load_mended(spark, name, fixes, fx.TRANSACTION_SCHEMA, "mended")
    return spark.table(name).select("AccountNo", "Date", "BalanceAMT", "load_id")


@query(
    "profile_maintained",
    """
SELECT c AS column_name, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (WHERE v IS NULL) AS DOUBLE) AS missing,
       min(v) AS low, max(v) AS high, CAST(count(*) FILTER (WHERE v = 0) AS DOUBLE) AS zeros,
       TRUE AS moments_agree, TRUE AS distinct_within, TRUE AS quantiles_within
FROM (SELECT 'value' AS c, CAST(value AS DOUBLE) AS v FROM events UNION ALL SELECT 'user_id', CAST(user_id AS DOUBLE) FROM events)
GROUP BY c""",
)
def profile_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7-A10 by state: the daily events arrive in two loads, the second of which replaces days of the first; the merged profile
    has the exact counts and ends, and moments, distinct numbers and quantiles within the stated errors."""
    db = scratch_database(spark)
    table, state, columns = f"{db}.events_daily", f"{db}.events_profile", ["value", "user_id"]
    e = fx.table(spark, sf_dir, "events")
    first = e.filter(F.dayofmonth("ts") <= 20).withColumn("value", F.when(F.dayofmonth("ts") > 10, F.col("value") + 1).otherwise(F.col("value")))
    for batch in (first, e.filter((F.dayofmonth("ts") > 10) | F.col("ts").isNull())):
        load_partitioned(spark, table, batch, ["event_id"], ["ts"], "ts")
        record_changes(spark, table, batch.select(F.to_date("ts").alias("ts_Partition")))
        refresh_profile(spark, table, state, columns, "profile")
    got = merged_profile(spark.table(state)).groupBy("column_name").pivot("metric", _METRICS).agg(F.first("value"))
    exact = profile(spark.table(table).select(*columns), columns).groupBy("column_name").pivot("metric", _METRICS).agg(F.first("value"))
    exact = exact.select(F.col("column_name").alias("of"), *[F.col(m).alias(f"x_{m}") for m in _METRICS])
    ranked = _ranks(spark.table(table), columns, got)
    close = lambda m, share: F.abs(F.col(m) - F.col(f"x_{m}")) <= share * F.abs(F.col(f"x_{m}"))
    joined = got.join(exact, F.col("column_name") == F.col("of")).join(ranked, "column_name")
    return joined.select(
        "column_name", "n", "missing", F.col("min").alias("low"), F.col("max").alias("high"), "zeros",
        (close("mean", 1e-9) & close("std", 1e-9) & close("sum", 1e-9)).alias("moments_agree"),
        close("n_distinct", 0.05).alias("distinct_within"), "quantiles_within",
    )


_METRICS = ["n", "missing", "n_distinct", "min", "max", "mean", "std", "sum", "zeros", *[_pct_name(p) for p in QUANTILES]]


def _ranks(df: DataFrame, columns: list[str], got: DataFrame) -> DataFrame:
    """(column_name, quantiles_within): whether each quantile's ranks reach its share within the sketch's error."""
    out = None
    for c in columns:
        q = got.filter(F.col("column_name") == c).select(*[F.col(_pct_name(p)).alias(f"q{i}") for i, p in enumerate(QUANTILES)])
        v = F.col(c).cast("double")
        counts = [F.count(v).alias("all")]
        for i in range(len(QUANTILES)):
            counts += [F.count_if(v < F.col(f"q{i}")).alias(f"a{i}"), F.count_if(v <= F.col(f"q{i}")).alias(f"b{i}")]
        # one row of quantiles beside every row of the table: a bounded broadcast
        row = df.select(c).join(F.broadcast(q)).agg(*counts)
        ok = F.lit(True)
        for i, p in enumerate(QUANTILES):
            ok = ok & (F.col(f"a{i}") / F.col("all") <= p + rank_error()) & (F.col(f"b{i}") / F.col("all") >= p - rank_error())
        one = row.select(F.lit(c).alias("column_name"), ok.alias("quantiles_within"))
        out = one if out is None else out.unionByName(one)
    return out


# The box that the clustered look-up asks for.
BOX_FROM, BOX_TO, BOX_LOW, BOX_HIGH = "1995-03-01", "1995-09-30", 50_000.0, 150_000.0


@query(
    "find_clustered",
    f"""
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '{BOX_FROM}' AND o_orderdate <= TIMESTAMP '{BOX_TO}'
  AND o_totalprice >= {BOX_LOW} AND o_totalprice < {BOX_HIGH}
UNION ALL
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders WHERE o_orderkey IN (7, 1001)""",
)
def clustered_look_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2-F4, F9, S9 on a table laid out by date and total: a box of both, and two ids."""
    name = f"{scratch_database(spark)}.orders_clustered"
    write_clustered(spark, name, fx.table(spark, sf_dir, "orders"), ["o_orderdate", "o_totalprice"], ["o_orderkey"], files=32)
    box = {
        "o_orderdate": {"$gte": _dt.datetime.fromisoformat(BOX_FROM), "$lte": _dt.datetime.fromisoformat(BOX_TO)},
        "o_totalprice": {"$gte": BOX_LOW, "$lt": BOX_HIGH},
    }
    wanted = {"o_custkey": 1, "o_totalprice": 1, "o_orderdate": 1}
    rows = find_clustered(spark, name, box, wanted, id_field="o_orderkey")
    return rows.unionByName(find_clustered(spark, name, {"o_orderkey": {"$in": [7, 1001]}}, wanted, id_field="o_orderkey"))
