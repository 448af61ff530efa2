"""Driver queries for document filters, document loads and file sources
(F2-F11, L1, S1-S3, S7-S11, B4, B5).

Inputs that the original read from files or a document store are first
written by Spark from the driver tables into a fresh scratch folder (JSON
lines, CSV, text, workbooks) and then read back through the source
operators, so the work grows with the tables.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import conform
from strata.operators import find as fd
from strata.plans import fixtures as fx
from strata.plans.registry import query
from strata.session import scratch_database, scratch_path
from strata.sinks.tables import create_table, load_partitioned, load_table, staged_table
from strata.sources.databases import documents_to_df, read_documents
from strata.sources.files import read_csv, read_sql, read_table, read_txt, write_text
from strata.plans.workbooks import write_xlsx
from strata.sources.xlsx import read_xlsx

# Fixed values of the filter examples.
WINDOW_START = _dt.datetime(2024, 1, 10, 0, 0, 0)
WINDOW_END = _dt.datetime(2024, 1, 20, 23, 59, 59)
LOOKUP_ID = 42
LIMIT = 25


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "events")


RANGE_SQL = (
    f"ts BETWEEN TIMESTAMP '{WINDOW_START:%Y-%m-%d %H:%M:%S}' AND TIMESTAMP '{WINDOW_END:%Y-%m-%d %H:%M:%S}'"
)


@query("find_eq_range", f"SELECT * FROM events WHERE event_type = 'click' AND {RANGE_SQL}")
def find_eq_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equality and inclusive range, combined."""
    return fd.find(_events(spark, sf_dir), {"event_type": "click", "ts": {"$gte": WINDOW_START, "$lte": WINDOW_END}})


@query("find_optional", f"SELECT * FROM events WHERE event_type = 'purchase' AND {RANGE_SQL}")
def find_optional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a criterion whose value is None is ignored."""
    criteria = {"event_type": "purchase", "user_id": None, "ts": {"$gte": WINDOW_START, "$lte": WINDOW_END}}
    return fd.find_with_optional_filters(_events(spark, sf_dir), criteria)


@query(
    "find_projection",
    "SELECT event_id, user_id, value FROM events WHERE value > 50",
)
def find_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """include projection; the id field is kept."""
    return fd.find(
        _events(spark, sf_dir), {"value": {"$gt": 50}}, {"user_id": 1, "value": 1}, id_field="event_id"
    )


@query(
    "find_exclude",
    "SELECT event_id, ts, user_id, event_type, value FROM events WHERE event_type <> 'error'",
)
def find_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    """exclude projection with a $ne filter."""
    return fd.find(_events(spark, sf_dir), {"event_type": {"$ne": "error"}}, {"props": 0}, id_field="event_id")


@query(
    "find_limit",
    f"""
SELECT 'limit_{LIMIT}' AS query, least(count(*), {LIMIT}) AS n FROM events WHERE event_type = 'view'
UNION ALL
SELECT 'limit_0', count(*) FROM events WHERE event_type = 'view'""",
)
def find_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: limit n returns n matches (which ones is not defined); 0 = all."""
    e = _events(spark, sf_dir)
    q = {"event_type": "view"}
    a = fd.find(e, q, limit=LIMIT).agg(F.count(F.lit(1)).alias("n")).select(F.lit(f"limit_{LIMIT}").alias("query"), "n")
    b = fd.find(e, q, limit=0).agg(F.count(F.lit(1)).alias("n")).select(F.lit("limit_0").alias("query"), "n")
    return a.unionByName(b)


@query("find_one", "SELECT * FROM events WHERE event_type = 'signup' ORDER BY event_id LIMIT 1")
def find_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: first match by id."""
    return fd.find_one(_events(spark, sf_dir), {"event_type": "signup"}, id_field="event_id")


@query("find_by_id", f"SELECT * FROM events WHERE event_id = {LOOKUP_ID}")
def find_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F9."""
    return fd.find_by_id(_events(spark, sf_dir), LOOKUP_ID, id_field="event_id")


@query("count_documents", "SELECT count(*) AS count FROM events WHERE event_type IN ('click', 'view')")
def count_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F10."""
    return fd.count_documents(_events(spark, sf_dir), {"event_type": {"$in": ["click", "view"]}})


FIND_OPERATORS = {
    "$or": [{"event_type": {"$regex": "^p"}}, {"value": {"$gt": 90}}],
    "user_id": {"$nin": [1, 2, 3], "$ne": 7, "$lte": 140},
    "props": {"$exists": True},
    "event_type": {"$not": {"$eq": "error"}, "$in": ["purchase", "view", "click", "signup"]},
    "$nor": [{"value": {"$lt": 1}}],
}


@query(
    "find_operators",
    """
SELECT * FROM events
WHERE (regexp_matches(event_type, '^p') OR value > 90)
  AND (user_id IS NULL OR user_id NOT IN (1, 2, 3)) AND user_id IS DISTINCT FROM 7 AND user_id <= 140
  AND props IS NOT NULL
  AND NOT coalesce(event_type = 'error', false) AND event_type IN ('purchase', 'view', 'click', 'signup')
  AND NOT coalesce(value < 1, false)""",
)
def find_operators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the rest of the filter language."""
    return fd.find(_events(spark, sf_dir), FIND_OPERATORS)


# --- documents ------------------------------------------------------------------

CONVERSATION_SCHEMA = T.StructType(
    [
        T.StructField("_id", T.StringType()),
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),  # absent from the documents
    ]
)


def _oid(expr: F.Column) -> F.Column:
    return F.lower(F.lpad(F.hex(expr), 24, "0"))


@query(
    "documents_to_df",
    """
SELECT lower(lpad(hex(conv_id * 100000 + turn), 24, '0')) AS _id, conv_id, turn, role, text,
       CAST(NULL AS VARCHAR) AS lang
FROM conversations""",
)
def documents_to_df_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with fields in another order, an object id and an
    extra field are read by name; the missing field is NULL."""
    c = fx.table(spark, sf_dir, "conversations")
    path = scratch_path(spark, "docs", "conversations")
    c.select(
        "text",
        "role",
        F.struct(_oid(F.col("conv_id") * 100000 + F.col("turn")).alias("$oid")).alias("_id"),
        "turn",
        "conv_id",
        F.lit("export-v1").alias("meta"),
    ).write.json(path)
    return documents_to_df(spark.read.text(path), CONVERSATION_SCHEMA)


EVENT_DOC_SCHEMA = T.StructType(
    [
        T.StructField("_id", T.StringType()),
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def _event_docs(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "docs", "events")
    _events(spark, sf_dir).select(
        F.struct(_oid(F.col("event_id")).alias("$oid")).alias("_id"),
        "event_id",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"),
        "user_id",
        "event_type",
        "value",
    ).write.json(path)
    return path


DOC_FILTER = {"event_type": "purchase", "user_id": None, "ts": {"$gte": WINDOW_START, "$lte": WINDOW_END}}


@query(
    "documents_to_table",
    f"""
SELECT lower(lpad(hex(event_id), 24, '0')) AS _id, event_id, ts, user_id, event_type, value
FROM events WHERE event_type = 'purchase' AND {RANGE_SQL}""",
)
def documents_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filtered documents loaded on a key; loading the same batch twice
    updates every row and inserts none."""
    db = scratch_database(spark)
    docs = read_documents(spark, _event_docs(spark, sf_dir), EVENT_DOC_SCHEMA, DOC_FILTER, skip_none=True)
    for _ in range(2):
        load_table(spark, f"{db}.events_docs", docs, keys="event_id")
    return spark.table(f"{db}.events_docs")


@query(
    "documents_to_partitioned",
    """
SELECT * EXCLUDE (rn), CAST(ts AS DATE) AS ts_Partition FROM (
  SELECT lower(lpad(hex(event_id), 24, '0')) AS _id, event_id, ts, user_id, event_type, value,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn
  FROM events)
WHERE rn = 1""",
)
def documents_to_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents staged in a scratch table, then the latest document
    per user loaded into a table partitioned by its date."""
    db = scratch_database(spark)
    docs = read_documents(spark, _event_docs(spark, sf_dir), EVENT_DOC_SCHEMA)
    with staged_table(spark, docs, f"{db}.staged_events") as staged:
        load_partitioned(
            spark,
            f"{db}.latest_event_by_user",
            read_sql(spark, f"SELECT * FROM {staged}"),
            keys=["user_id"],
            order_by=["ts"],
            date_col="ts",
            tie_break=["event_id"],
        )
    return spark.table(f"{db}.latest_event_by_user")


# --- SQL text and tables -----------------------------------------------------------


@query(
    "sql_source",
    """
SELECT o_orderstatus, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total
FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' GROUP BY o_orderstatus""",
)
def sql_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL text over a registered view with a bound parameter."""
    return read_sql(
        spark,
        """SELECT o_orderstatus, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total
           FROM o WHERE o_orderdate >= CAST(:since AS TIMESTAMP_NTZ) GROUP BY o_orderstatus""",
        views={"o": fx.table(spark, sf_dir, "orders")},
        args={"since": "1996-01-01 00:00:00"},
    ).select("o_orderstatus", "n", F.col("total").cast("decimal(28,2)").alias("total"))


@query(
    "read_table",
    """
SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS order_date,
       o_orderstatus = 'F' AS is_closed
FROM orders WHERE o_orderpriority = '2-HIGH'""",
)
def read_table_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table with column pruning, a pushed predicate and
    derived columns."""
    db = scratch_database(spark)
    create_table(spark, f"{db}.orders", fx.table(spark, sf_dir, "orders"))
    t = read_table(
        spark,
        f"{db}.orders",
        ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus"],
        where="o_orderpriority = '2-HIGH'",
    )
    return t.withColumns(
        {"order_date": F.to_date("o_orderdate"), "is_closed": F.col("o_orderstatus") == "F"}
    ).select("o_orderkey", "o_custkey", "o_totalprice", "order_date", "is_closed")


ORDER_FILE_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DecimalType(18, 2)),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)
ORDER_FILE_SQL = """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_orderstatus,
       CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, o_orderpriority
FROM orders"""


def _order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders table in the columns of the file queries; every query writes it
    whole in its format and reads it back."""
    return conform(fx.table(spark, sf_dir, "orders"), ORDER_FILE_SCHEMA)


@query("read_csv", ORDER_FILE_SQL)
def read_csv_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as CSV files, read back with a schema."""
    path = scratch_path(spark, "csv", "orders")
    _order_rows(spark, sf_dir).write.option("header", True).csv(path)
    return read_csv(spark, path, ORDER_FILE_SCHEMA)


@query("read_txt", ORDER_FILE_SQL)
def read_txt_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: orders written as '|'-separated text, split and typed."""
    path = scratch_path(spark, "txt", "orders")
    write_text(_order_rows(spark, sf_dir), path)
    return conform(read_txt(spark, path), ORDER_FILE_SCHEMA)


@query("read_xlsx", ORDER_FILE_SQL)
def read_xlsx_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as workbooks, the second half of the columns first in the
    files of urgent orders; read back by name."""
    path = scratch_path(spark, "xlsx", "orders")
    texts = _order_rows(spark, sf_dir).select(*[F.col(c).cast("string").alias(c) for c in ORDER_FILE_SCHEMA.fieldNames()])
    urgent = F.coalesce(F.col("o_orderpriority") == "1-URGENT", F.lit(False))
    write_xlsx(texts.filter(~urgent), f"{path}/a", rows_per_file=20_000)
    names = ORDER_FILE_SCHEMA.fieldNames()
    write_xlsx(texts.filter(urgent).select(*names[3:], *names[:3]), f"{path}/b", rows_per_file=20_000)
    return conform(read_xlsx(spark, [f"{path}/a", f"{path}/b"], "Sheet1"), ORDER_FILE_SCHEMA)


@query(
    "documents_stream_partitioned",
    """
SELECT lower(lpad(hex(event_id), 24, '0')) AS _id, event_id, ts, user_id, event_type, value,
       CAST(ts AS DATE) AS ts_Partition
FROM events WHERE event_type <> 'error'""",
)
def documents_stream_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B5 as a stream: the event documents (several files) are loaded in
    micro-batches of two files, each upserted into the daily table."""
    from strata.streaming.incremental import stream_documents_partitioned

    db = scratch_database(spark)
    table = f"{db}.events_stream"
    path = scratch_path(spark, "docs", "events_stream")
    _events(spark, sf_dir).repartition(6).select(
        F.struct(_oid(F.col("event_id")).alias("$oid")).alias("_id"),
        "event_id",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"),
        "user_id",
        "event_type",
        "value",
    ).write.json(path)
    stream_documents_partitioned(
        spark,
        path,
        EVENT_DOC_SCHEMA,
        table,
        keys=["event_id"],
        order_by=["ts"],
        date_col="ts",
        query={"event_type": {"$ne": "error"}},
        max_files_per_trigger=2,
    )
    return spark.table(table)
