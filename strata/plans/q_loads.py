"""Driver queries for the sinks: create, append, upserts, metrics, compaction
(W1-W9, J1, J2, K1-K5, A4-A6, B2).

Every query writes into a fresh database under the shared checkpoint folder
and returns a lazy read of the table it built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.dedup import key_stats
from strata.operators.merge import merge_frames
from strata.plans import fixtures as fx
from strata.plans import oracle as O
from strata.plans.jobs import silver_transactions
from strata.plans.registry import query
from strata.session import scratch_database
from strata.sinks.tables import (
    append_table,
    compact_partitions,
    last_load,
    load_partitioned,
    load_table,
)

# The split of each table into a first load and a later batch
# that overlaps it (both parts together cover the whole table).
ORDERS_TARGET_BEFORE = "1998-01-01 00:00:00"
ORDERS_SOURCE_FROM = "1997-01-01 00:00:00"
LINEITEM_TARGET_BEFORE = "1999-01-01 00:00:00"
LINEITEM_SOURCE_FROM = "1998-01-01 00:00:00"
EVENTS_TARGET_BEFORE = "2024-01-20 00:00:00"
EVENTS_SOURCE_FROM = "2024-01-15 00:00:00"
SHIFTED_EVENT_TYPE = "click"  # rows of this type arrive one day later
NULL_KEY_PRIORITY = "1-URGENT"  # orders of this priority have no key


def _ts(text: str) -> F.Column:
    return F.lit(text).cast("timestamp_ntz")


def orders_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = fx.table(spark, sf_dir, "orders")
    return o.filter(F.col("o_orderdate") < _ts(ORDERS_TARGET_BEFORE))


def orders_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later batch: overlapping orders come back with a new total."""
    o = fx.table(spark, sf_dir, "orders")
    return o.filter(F.col("o_orderdate") >= _ts(ORDERS_SOURCE_FROM)).withColumn(
        "o_totalprice", F.col("o_totalprice") + F.lit(1.0)
    )


ORDERS_SPLIT_SQL = f"""
t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{ORDERS_TARGET_BEFORE}'),
s AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0 AS o_totalprice,
             o_orderdate, o_orderpriority
      FROM orders WHERE o_orderdate >= TIMESTAMP '{ORDERS_SOURCE_FROM}')"""

ORDER_COLS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


def _pick(cols, present="s._s") -> str:
    return ",\n       ".join(f"CASE WHEN {present} IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in cols)


@query(
    "upsert_by_key",
    "WITH "
    + ORDERS_SPLIT_SQL
    + f"""
SELECT {_pick(ORDER_COLS)}
FROM (SELECT *, 1 AS _t FROM t) t FULL OUTER JOIN (SELECT *, 1 AS _s FROM s) s
  ON t.o_orderkey = s.o_orderkey""",
)
def upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = scratch_database(spark)
    name = f"{db}.orders_current"
    load_table(spark, name, orders_target(spark, sf_dir), keys="o_orderkey")
    load_table(spark, name, orders_source(spark, sf_dir), keys="o_orderkey")
    return spark.table(name)


@query(
    "load_metrics",
    "WITH "
    + ORDERS_SPLIT_SQL
    + """
SELECT 'merge' AS operation,
       (SELECT count(*) FROM s) AS source_rows,
       (SELECT count(*) FROM s SEMI JOIN t ON s.o_orderkey = t.o_orderkey) AS rows_updated,
       (SELECT count(*) FROM s ANTI JOIN t ON s.o_orderkey = t.o_orderkey) AS rows_inserted""",
)
def load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = scratch_database(spark)
    name = f"{db}.orders_current"
    load_table(spark, name, orders_target(spark, sf_dir), keys="o_orderkey")
    load_table(spark, name, orders_source(spark, sf_dir), keys="o_orderkey")
    return last_load(spark, name).select("operation", "source_rows", "rows_updated", "rows_inserted")


def _null_key(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "k",
        F.when(F.col("o_orderpriority") == NULL_KEY_PRIORITY, F.lit(None).cast("long")).otherwise(
            F.col("o_orderkey")
        ),
    )


@query(
    "upsert_null_keys",
    "WITH "
    + ORDERS_SPLIT_SQL
    + f""",
tk AS (SELECT *, CASE WHEN o_orderpriority = '{NULL_KEY_PRIORITY}' THEN NULL ELSE o_orderkey END AS k,
              1 AS _t FROM t),
sk AS (SELECT *, CASE WHEN o_orderpriority = '{NULL_KEY_PRIORITY}' THEN NULL ELSE o_orderkey END AS k,
              1 AS _s FROM s)
SELECT {_pick((*ORDER_COLS, "k"))},
       CASE WHEN t._t IS NOT NULL AND s._s IS NOT NULL THEN 'updated'
            WHEN s._s IS NOT NULL THEN 'inserted' ELSE 'kept' END AS _op
FROM tk t FULL OUTER JOIN sk s ON t.k = s.k""",
)
def upsert_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: with plain equality a NULL key never matches (pure merge)."""
    target = _null_key(orders_target(spark, sf_dir))
    source = _null_key(orders_source(spark, sf_dir))
    return merge_frames(target, source, ["k"])


EVENT_COLS = ("event_id", "ts", "user_id", "event_type", "value", "props", "ts_Partition")


def events_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = fx.table(spark, sf_dir, "events")
    return e.filter(F.col("ts") < _ts(EVENTS_TARGET_BEFORE))


def events_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later batch: overlapping events come back with a new value, and
    the shifted type arrives one day later (so it lands in a new partition)."""
    e = fx.table(spark, sf_dir, "events")
    return e.filter(F.col("ts") >= _ts(EVENTS_SOURCE_FROM)).select(
        "event_id",
        F.when(F.col("event_type") == SHIFTED_EVENT_TYPE, F.col("ts") + F.expr("INTERVAL 1 DAY"))
        .otherwise(F.col("ts"))
        .alias("ts"),
        "user_id",
        "event_type",
        (F.col("value") + F.lit(1.0)).alias("value"),
        "props",
    )


@query(
    "upsert_by_partition",
    f"""
WITH t AS (SELECT *, CAST(ts AS DATE) AS ts_Partition, 1 AS _t FROM events
           WHERE ts < TIMESTAMP '{EVENTS_TARGET_BEFORE}'),
s0 AS (SELECT event_id,
              CASE WHEN event_type = '{SHIFTED_EVENT_TYPE}' THEN ts + INTERVAL 1 DAY ELSE ts END AS ts,
              user_id, event_type, value + 1.0 AS value, props
       FROM events WHERE ts >= TIMESTAMP '{EVENTS_SOURCE_FROM}'),
s AS (SELECT *, CAST(ts AS DATE) AS ts_Partition, 1 AS _s FROM s0)
SELECT {_pick(EVENT_COLS)}
FROM t FULL OUTER JOIN s ON t.event_id = s.event_id AND t.ts_Partition = s.ts_Partition""",
)
def upsert_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = scratch_database(spark)
    name = f"{db}.events_daily"
    for batch in (events_target(spark, sf_dir), events_source(spark, sf_dir)):
        load_partitioned(spark, name, batch, keys=["event_id"], order_by=["ts"], date_col="ts")
    return spark.table(name)


@query(
    "upsert_new_column",
    "WITH "
    + ORDERS_SPLIT_SQL
    + """
SELECT CASE WHEN s._s IS NOT NULL THEN s.o_orderkey ELSE t.o_orderkey END AS o_orderkey,
       CASE WHEN s._s IS NOT NULL THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
       CASE WHEN s._s IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       CASE WHEN s._s IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       CASE WHEN s._s IS NOT NULL THEN s.o_orderdate ELSE t.o_orderdate END AS o_orderdate,
       t.o_orderpriority AS o_orderpriority,
       s.o_priority_rank AS o_priority_rank
FROM (SELECT *, 1 AS _t FROM t) t
FULL OUTER JOIN (SELECT * EXCLUDE (o_orderpriority),
                        CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS o_priority_rank,
                        1 AS _s FROM s) s
  ON t.o_orderkey = s.o_orderkey""",
)
def upsert_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch drops ``o_orderpriority`` and brings a new
    ``o_priority_rank``; matched rows keep their priority."""
    db = scratch_database(spark)
    name = f"{db}.orders_evolving"
    load_table(spark, name, orders_target(spark, sf_dir), keys="o_orderkey")
    batch = orders_source(spark, sf_dir).withColumn(
        "o_priority_rank", F.substring("o_orderpriority", 1, 1).cast("int")
    ).drop("o_orderpriority")
    load_table(spark, name, batch, keys="o_orderkey")
    return spark.table(name)


@query(
    "append_when_not_unique",
    f"""
SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{LINEITEM_TARGET_BEFORE}'
UNION ALL
SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '{LINEITEM_SOURCE_FROM}'""",
)
def append_when_not_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: ``l_orderkey`` repeats within the batch, so the load appends."""
    db = scratch_database(spark)
    name = f"{db}.lineitem_log"
    li = fx.table(spark, sf_dir, "lineitem")
    load_table(spark, name, li.filter(F.col("l_shipdate") < _ts(LINEITEM_TARGET_BEFORE)), keys="l_orderkey")
    load_table(spark, name, li.filter(F.col("l_shipdate") >= _ts(LINEITEM_SOURCE_FROM)), keys="l_orderkey")
    return spark.table(name)


@query("first_load", "SELECT * FROM lineitem")
def first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: the first load writes every row, duplicates included."""
    db = scratch_database(spark)
    name = f"{db}.lineitem_first"
    load_table(spark, name, fx.table(spark, sf_dir, "lineitem"), keys=["l_orderkey", "l_linenumber"])
    return spark.table(name)


@query("compact_partitions", "SELECT *, CAST(ts AS DATE) AS ts_Partition FROM events")
def compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One append per event type leaves several small files in every
    daily partition; compaction rewrites them and keeps every row."""
    db = scratch_database(spark)
    name = f"{db}.events_compacted"
    e = fx.table(spark, sf_dir, "events").withColumn("ts_Partition", F.to_date("ts"))
    types = ("view", "click", "purchase", "signup", "error")
    first = True
    for t in types:
        batch = e.filter(F.col("event_type") == t)
        if first:
            load_table(spark, name, batch)
            first = False
        else:
            append_table(spark, name, batch)
    rest = e.filter(~F.col("event_type").isin(list(types)) | F.col("event_type").isNull())
    append_table(spark, name, rest)
    compact_partitions(spark, name)
    return spark.table(name)


@query(
    "key_uniqueness",
    f"""
SELECT 'orders.o_orderkey' AS subject, count(*) AS rows,
       (SELECT count(*) FROM (SELECT DISTINCT o_orderkey FROM orders)) AS distinct_keys,
       count(*) FILTER (WHERE o_orderkey IS NULL) AS null_keys
FROM orders
UNION ALL
SELECT 'lineitem.l_orderkey', count(*),
       (SELECT count(*) FROM (SELECT DISTINCT l_orderkey FROM lineitem)),
       count(*) FILTER (WHERE l_orderkey IS NULL)
FROM lineitem
UNION ALL
SELECT 'lineitem.l_orderkey,l_linenumber', count(*),
       (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)),
       count(*) FILTER (WHERE l_orderkey IS NULL OR l_linenumber IS NULL)
FROM lineitem
UNION ALL
SELECT 'orders.k', count(*),
       (SELECT count(*) FROM (SELECT DISTINCT CASE WHEN o_orderpriority = '{NULL_KEY_PRIORITY}'
                                                   THEN NULL ELSE o_orderkey END FROM orders)),
       count(*) FILTER (WHERE o_orderpriority = '{NULL_KEY_PRIORITY}')
FROM orders""",
)
def key_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, distinct keys (NULL counted as a value) and NULL keys."""
    o = fx.table(spark, sf_dir, "orders")
    li = fx.table(spark, sf_dir, "lineitem")
    parts = [
        ("orders.o_orderkey", o, ["o_orderkey"]),
        ("lineitem.l_orderkey", li, ["l_orderkey"]),
        ("lineitem.l_orderkey,l_linenumber", li, ["l_orderkey", "l_linenumber"]),
        ("orders.k", _null_key(o), ["k"]),
    ]
    out = None
    for label, df, keys in parts:
        s = key_stats(df, keys).select(F.lit(label).alias("subject"), "rows", "distinct_keys", "null_keys")
        out = s if out is None else out.unionByName(s)
    return out


@query(
    "silver_transactions",
    "WITH "
    + O.RAW
    + f""",
keyed AS (SELECT *, {O.SURROGATE_KEY} AS Id FROM raw),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY Id
            ORDER BY Date DESC NULLS LAST, IngestionTime DESC NULLS LAST, TxnNo DESC NULLS LAST) AS rn
  FROM keyed WHERE Id IS NOT NULL)
SELECT * EXCLUDE (rn), coalesce(Date, ValueDate) AS Date_Partition FROM ranked WHERE rn = 1""",
)
def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First silver load from bronze (NULL keys rejected)."""
    db = scratch_database(spark)
    silver_transactions(spark, fx.raw(spark, sf_dir), f"{db}.transactions_clean", f"{db}.transactions_rejects")
    return spark.table(f"{db}.transactions_clean")
