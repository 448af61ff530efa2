"""Data quality: reconcile two frames and keep a monitoring table (Q1-Q7).

``reconcile`` aggregates the union of both key columns (rows per side and
key, then one small aggregate), so source and destination are scanned once
each, nothing is collected and no join is needed. ``dq_record`` turns its
one row into the 16-column monitoring record and ``dq_report`` upserts it by
``ID``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import count_status, file_stem, local_time, lower_or_unknown, quote
from strata.operators.content import comparable
from strata.session import staged_rows
from strata.sinks.tables import LoadResult, create_table, evolve_schema, merge_partitions, record_load, table_exists

# Fixed value: offset of the monitoring clock (UTC+7).
REPORT_ZONE = "+07:00"

MONITORING_SCHEMA = T.StructType(
    [
        T.StructField("ID", T.StringType()),
        T.StructField("Updated_Date", T.DateType()),
        T.StructField("Updated_Timestamp", T.TimestampNTZType()),
        T.StructField("Type", T.StringType()),
        T.StructField("Process", T.StringType()),
        T.StructField("Type_File_Sources", T.StringType()),
        T.StructField("File_Sources", T.StringType()),
        T.StructField("Table_Name", T.StringType()),
        T.StructField("Status_Observation", T.StringType()),
        T.StructField("Source_Observation", T.LongType()),
        T.StructField("Destination_Observation", T.LongType()),
        T.StructField("Difference_Observation", T.LongType()),
        T.StructField("Status_Rows", T.StringType()),
        T.StructField("Source_Rows", T.LongType()),
        T.StructField("Destination_Rows", T.LongType()),
        T.StructField("Difference_Rows", T.LongType()),
    ]
)

RECONCILE_COLUMNS = [f.name for f in MONITORING_SCHEMA.fields[8:]]


def reconcile(
    source: DataFrame,
    destination: DataFrame,
    key: str,
    destination_key: str | None = None,
    zero_is_unknown: bool = True,
) -> DataFrame:
    """Q1: rows (observations) and distinct non-NULL keys of both frames,
    their differences and PASS / FAIL / UNKNOWN statuses, as one row. Keys of different types are
    compared in the type that holds both, else as text: no value ends the check. Equal counts do not mean
    equal keys; ``content.reconcile_contents`` says which differ."""
    s, d = comparable(
        source.select(F.col(quote(key)).alias("k")), destination.select(F.col(quote(destination_key or key)).alias("k")), ["k"]
    )
    s, d = s.withColumn("src", F.lit(True)), d.withColumn("src", F.lit(False))
    # rows per (side, key) with map-side combine, then one small aggregate:
    # the observations are the sums, the distinct keys the non-NULL groups
    per_key = s.unionByName(d).groupBy("src", "k").agg(F.count(F.lit(1)).alias("n"))
    counts = per_key.agg(
        F.coalesce(F.sum(F.when(F.col("src"), F.col("n"))), F.lit(0)).alias("Source_Observation"),
        F.coalesce(F.sum(F.when(~F.col("src"), F.col("n"))), F.lit(0)).alias("Destination_Observation"),
        F.count_if(F.col("src") & F.col("k").isNotNull()).alias("Source_Rows"),
        F.count_if(~F.col("src") & F.col("k").isNotNull()).alias("Destination_Rows"),
    )
    obs_diff, obs_status = count_status("Source_Observation", "Destination_Observation", zero_is_unknown)
    row_diff, row_status = count_status("Source_Rows", "Destination_Rows", zero_is_unknown)
    return counts.select(
        obs_status.alias("Status_Observation"),
        F.col("Source_Observation").cast("long").alias("Source_Observation"),
        F.col("Destination_Observation").cast("long").alias("Destination_Observation"),
        obs_diff.alias("Difference_Observation"),
        row_status.alias("Status_Rows"),
        F.col("Source_Rows").cast("long").alias("Source_Rows"),
        F.col("Destination_Rows").cast("long").alias("Destination_Rows"),
        row_diff.alias("Difference_Rows"),
    )


def dq_record(
    reconciled: DataFrame,
    etl_type: str | None,
    process: str | None,
    data_format: str | None,
    file_path: str | None,
    table_name: str,
    now: _dt.datetime | str | None = None,
) -> DataFrame:
    """Q2: the monitoring record of one hop.

    ``ID`` = SHA-256 of ``yyyyMMdd_<file>_<type>_<process>`` on the UTC+7
    clock, so the same hop on the same day updates its record and the next
    day inserts a new one. ``now`` is the UTC time (default: query start)."""
    local = local_time(REPORT_ZONE, now)
    path = F.lit(file_path).cast("string")
    typ = lower_or_unknown(F.lit(etl_type).cast("string"))
    proc = lower_or_unknown(F.lit(process).cast("string"))
    ident = F.sha2(F.concat_ws("_", F.date_format(local, "yyyyMMdd"), file_stem(path), typ, proc), 256)
    return reconciled.select(
        ident.alias("ID"),
        F.to_date(local).alias("Updated_Date"),
        local.alias("Updated_Timestamp"),
        typ.alias("Type"),
        proc.alias("Process"),
        lower_or_unknown(F.lit(data_format).cast("string")).alias("Type_File_Sources"),
        lower_or_unknown(path).alias("File_Sources"),
        F.lit(table_name).cast("string").alias("Table_Name"),
        *RECONCILE_COLUMNS,
    )


def ensure_monitoring_table(spark: SparkSession, name: str) -> None:
    """Q3: create the monitoring table (empty, fixed schema, one partition per
    day) if absent."""
    if not table_exists(spark, name):
        create_table(spark, name, spark.createDataFrame([], MONITORING_SCHEMA), partition_by=["Updated_Date"])


def dq_report(spark: SparkSession, name: str, record: DataFrame) -> LoadResult:
    """Q4: upsert monitoring records by ``ID``. The ID holds the day, so only
    the day's partition is read and rewritten."""
    ensure_monitoring_table(spark, name)
    with staged_rows(evolve_schema(spark, name, record)) as rows:
        result = merge_partitions(spark, name, rows, ["ID"], "Updated_Date")
    record_load(spark, result)
    return result


def monitoring(spark: SparkSession, name: str) -> DataFrame:
    """The monitoring records with their columns in the documented order."""
    return spark.table(name).select(*[f.name for f in MONITORING_SCHEMA.fields])


def counts_frame(
    spark: SparkSession,
    source_observation: int | None,
    destination_observation: int | None,
    source_rows: int | None,
    destination_rows: int | None,
    zero_is_unknown: bool = True,
) -> DataFrame:
    """The reconcile row from counts a caller already holds (one row with an
    explicit schema, so missing counts are NULL and give UNKNOWN)."""
    schema = "so long, do long, sr long, dr long"
    row = spark.createDataFrame(
        [(source_observation, destination_observation, source_rows, destination_rows)], schema
    )
    obs_diff, obs_status = count_status("so", "do", zero_is_unknown)
    row_diff, row_status = count_status("sr", "dr", zero_is_unknown)
    return row.select(
        obs_status.alias("Status_Observation"),
        F.col("so").alias("Source_Observation"),
        F.col("do").alias("Destination_Observation"),
        obs_diff.alias("Difference_Observation"),
        row_status.alias("Status_Rows"),
        F.col("sr").alias("Source_Rows"),
        F.col("dr").alias("Destination_Rows"),
        row_diff.alias("Difference_Rows"),
    )


def report_counts(
    spark: SparkSession,
    monitoring_table: str,
    source_observation: int | None,
    destination_observation: int | None,
    source_rows: int | None,
    destination_rows: int | None,
    table_name: str,
    process: str | None,
    etl_type: str | None,
    data_format: str | None,
    file_path: str | None,
    now: _dt.datetime | str | None = None,
) -> LoadResult:
    """Q2-Q4 for callers that pass the four counts directly: build the
    record and upsert it into the monitoring table by ``ID``."""
    rec = counts_frame(spark, source_observation, destination_observation, source_rows, destination_rows)
    record = dq_record(rec, etl_type, process, data_format, file_path, table_name, now)
    return dq_report(spark, monitoring_table, record)
