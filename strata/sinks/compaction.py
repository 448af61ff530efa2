"""Compaction where it is needed (W7): the partitions whose files are small, found by their sizes.

Spark tells the path and size of the file that every row lies in; reduced to one row per file that is a survey of
the table, made by a scan that reads no column. A partition is rewritten when fewer files of the target size would hold
what its small files hold; all others keep their files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import quote
from strata.operators.schema import free_name
from strata.session import conf, staged_rows
from strata.sinks.tables import (
    _dynamic_overwrite,
    _rows,
    _swap_write,
    observe,
    partition_columns,
    touched_partitions,
    write_balanced,
)

TARGET_BYTES = 128 << 20
#: Files under this share of the target are small.
SMALL_SHARE = 0.5


@dataclass(frozen=True)
class Compaction:
    """Partitions rewritten, the files they had, and the rows they hold."""

    partitions: int
    files: int
    rows: int


def file_sizes(spark: SparkSession, name: str) -> DataFrame:
    """(partition columns, path, bytes, rows), one row per data file of a table that holds any row."""
    parts = [F.col(quote(p)) for p in partition_columns(spark, name)]
    rows = spark.table(name).select(*parts, F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"))
    return rows.groupBy(*parts, "path").agg(F.max("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def small_partitions(spark: SparkSession, name: str, target_bytes: int = TARGET_BYTES, small_share: float = SMALL_SHARE) -> DataFrame:
    """(partition columns, files, bytes, wanted) of the partitions worth a rewrite: their small files and bytes, and
    how many files of the target size would hold them."""
    parts = [F.col(quote(p)) for p in partition_columns(spark, name)]
    small = file_sizes(spark, name).filter(F.col("bytes") < int(target_bytes * small_share))
    packed = small.groupBy(*parts).agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
    packed = packed.withColumn("wanted", F.ceil(F.col("bytes") / target_bytes))
    return packed.filter(F.col("files") > F.col("wanted"))


def compact_small(spark: SparkSession, name: str, target_bytes: int = TARGET_BYTES, small_share: float = SMALL_SHARE) -> Compaction:
    """Rewrite the partitions (of an unpartitioned table: the table) whose small files would fit into fewer files; the
    partitions of one partition column, or tables without any. Files come out at about ``target_bytes``."""
    parts = partition_columns(spark, name)
    if len(parts) > 1:
        raise ValueError(f"{name} has several partition columns")
    with staged_rows(small_partitions(spark, name, target_bytes, small_share)) as plan, conf(
        spark, **{"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes)}
    ):
        n = plan.agg(F.count(F.lit(1)), F.coalesce(F.sum("files"), F.lit(0))).first()
        if not n[0]:
            return Compaction(0, 0, 0)
        table = spark.table(name)
        if not parts:
            counted, obs = observe(table, F.count(F.lit(1)).alias("rows"))
            _swap_write(spark, name, write_balanced(counted))
            return Compaction(1, int(n[1]), _rows(obs, table))
        rows = touched_partitions(table, plan, parts[0])
        mark = free_name("rows", rows.columns)
        counted, obs = observe(rows, F.count(F.lit(1)).alias(mark))
        with _dynamic_overwrite(spark):
            write_balanced(counted, *parts).write.insertInto(name, overwrite=True)
        spark.catalog.refreshTable(name)
        return Compaction(int(n[0]), int(n[1]), int(obs.get[mark]))
