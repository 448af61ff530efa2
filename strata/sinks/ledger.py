"""Loads that are taken once (B2, B3): raw tables by load, and a ledger of what each consumer has taken.

``land`` writes a batch as one partition of a raw table, named by the caller's load id, and then publishes it with a row
in ``load_landings``. A retried load replaces its own partition, so nothing is doubled, and a batch whose write broke off
is never seen. ``unseen`` lists the published loads that a consumer has not taken yet; the consumer reads just
their partitions, writes its result in a way that may be repeated (an upsert, or partitions replaced) and enters them
with ``mark_taken``. A crash at any point leaves the loads unseen, and the next run does the same work
again. A load that is landed anew with other rows is seen anew, as the ledger holds its checksum.

In the same way a table's writer publishes the partitions it has changed (``record_changes``), and those who
maintain something from it take them.

The logs are small tables beside the raw table: a row per load and consumer, and per changed partition.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import quote
from strata.session import remove_path
from strata.sinks.tables import (
    HISTORY_FILES,
    LoadResult,
    _declare,
    _dynamic_overwrite,
    _home_for_new_table,
    _split,
    compact_partitions,
    evolve_schema,
    finish_swap,
    observe,
    observed,
    table_exists,
    table_location,
    write_balanced,
)

LOAD_ID = "load_id"
LANDINGS, LEDGER, CHANGES = "load_landings", "load_ledger", "partition_changes"
_LANDED = "table_name string, load_id string, rows long, checksum string, at timestamp_ntz"
_TAKEN = "consumer string, table_name string, load_id string, checksum string, at timestamp_ntz"
_CHANGED = "table_name string, change_id string, part string, at timestamp_ntz"


class Load(NamedTuple):
    load_id: str
    checksum: str


def _log(name: str, kind: str) -> str:
    db, _ = _split(name)
    return f"{db}.{kind}" if db else kind


def _append(spark: SparkSession, log: str, rows: DataFrame, schema: str) -> None:
    finish_swap(spark, log)
    if not table_exists(spark, log):
        kind = T._parse_datatype_string(schema)
        _declare(spark, log, kind, [], f"{_home_for_new_table(spark, log)}/{uuid.uuid4().hex}", {})
    rows.write.insertInto(log)
    spark.catalog.refreshTable(log)
    if len(spark.table(log).inputFiles()) >= HISTORY_FILES:
        compact_partitions(spark, log)


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.UTC).replace(tzinfo=None)


def checksum_of(df: DataFrame) -> list[F.Column]:
    """Aggregates over all rows that do not depend on their order: count, exclusive or and sum of the row hashes."""
    plain = [F.col(quote(f.name)) for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    h = F.xxhash64(*plain)
    return [F.count(F.lit(1)).alias("rows"), F.bit_xor(h).alias("mixed"), F.sum(h.cast("decimal(20,0)")).alias("total")]


# --- landing -------------------------------------------------------------------


def ensure_raw_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """An empty raw table by load, unless there is one."""
    finish_swap(spark, name)
    if not table_exists(spark, name):
        by_load = T.StructType([*schema.fields, T.StructField(LOAD_ID, T.StringType())])
        _declare(spark, name, by_load, [LOAD_ID], f"{_home_for_new_table(spark, name)}/{uuid.uuid4().hex}", {})


def land(spark: SparkSession, name: str, df: DataFrame, load_id: str) -> LoadResult:
    """Write a batch as partition ``load_id`` of a raw table, in place of what an earlier try left there, and
    publish it. The frame must not hold a column ``load_id``."""
    if not load_id:
        raise ValueError("a load needs an id")
    if LOAD_ID in (c.lower() for c in df.columns):
        raise ValueError(f"the batch has a column {LOAD_ID} of its own")
    ensure_raw_table(spark, name, df.schema)
    df = evolve_schema(spark, name, df).drop(LOAD_ID)
    counted, obs = observe(df, *checksum_of(df))
    rows = counted.withColumn(LOAD_ID, F.lit(load_id))
    with _dynamic_overwrite(spark):
        rows.select(*[quote(c) for c in spark.table(name).columns]).write.insertInto(name, overwrite=True)
    m = observed(obs) or {"rows": 0, "mixed": None, "total": None}
    if not m["rows"]:
        clear_partition(spark, name, LOAD_ID, load_id)  # an empty batch overwrites nothing by itself
    spark.catalog.refreshTable(name)
    checksum = f"{m['rows']}:{m['mixed']}:{m['total']}"
    _append(spark, _log(name, LANDINGS), spark.createDataFrame([(name, load_id, int(m["rows"]), checksum, _now())], _LANDED).coalesce(1), _LANDED)
    return LoadResult(name, "land", int(m["rows"]), 0, int(m["rows"]))


def clear_partition(spark: SparkSession, name: str, column: str, value: object) -> None:
    """Drop a partition of an external table and its files (``None``: the partition of NULL)."""
    if value is None:
        spec, folder = "null", "__HIVE_DEFAULT_PARTITION__"
    else:
        spec = "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
        folder = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(str(value))
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({quote(column)} = {spec})")
    remove_path(spark, f"{table_location(spark, name).rstrip('/')}/{column}={folder}")


# --- taking --------------------------------------------------------------------


def _not_taken(spark: SparkSession, consumer: str, name: str, published: DataFrame) -> list[Load]:
    ledger = _log(name, LEDGER)
    if table_exists(spark, ledger):
        taken = spark.table(ledger).filter((F.col("consumer") == consumer) & (F.col("table_name") == name))
        published = published.join(taken.select("load_id", "checksum"), ["load_id", "checksum"], "left_anti")
    return [Load(r[0], r[1]) for r in published.orderBy("load_id").collect()]


def unseen(spark: SparkSession, consumer: str, name: str) -> list[Load]:
    """The published loads of a raw table (the last landing of each) that a consumer has not taken: a list of names,
    no rows."""
    log = _log(name, LANDINGS)
    if not table_exists(spark, log):
        return []
    landed = spark.table(log).filter(F.col("table_name") == name)
    return _not_taken(spark, consumer, name, landed.groupBy("load_id").agg(F.max_by("checksum", "at").alias("checksum")))


def rows_of(spark: SparkSession, name: str, loads: Sequence[Load]) -> DataFrame:
    """The rows of some loads, from their partitions only."""
    return spark.table(name).filter(F.col(LOAD_ID).isin([x.load_id for x in loads]))


def mark_taken(spark: SparkSession, consumer: str, name: str, loads: Sequence[Load]) -> None:
    """Enter loads as taken: the commit of a consumer's run."""
    if loads:
        at = _now()
        rows = spark.createDataFrame([(consumer, name, x.load_id, x.checksum, at) for x in loads], _TAKEN)
        _append(spark, _log(name, LEDGER), rows.coalesce(1), _TAKEN)


# --- changed partitions ----------------------------------------------------------


def record_changes(spark: SparkSession, name: str, parts: DataFrame) -> str:
    """Publish that partitions of a table (one column of values, repeats allowed) were rewritten; returns the id."""
    change = f"{_now():%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    rows = parts.distinct().select(F.lit(name).alias("table_name"), F.lit(change).alias("change_id"), F.col(quote(parts.columns[0])).cast("string").alias("part"), F.lit(_now()).alias("at"))
    _append(spark, _log(name, CHANGES), rows.coalesce(1), _CHANGED)
    return change


def unseen_changes(spark: SparkSession, consumer: str, name: str) -> list[Load]:
    """Published changes of a table's partitions that a consumer has not taken."""
    log = _log(name, CHANGES)
    if not table_exists(spark, log):
        return []
    published = spark.table(log).filter(F.col("table_name") == name).select(F.col("change_id").alias("load_id"), F.lit("").alias("checksum")).distinct()
    return _not_taken(spark, consumer, name, published)


def changed_parts(spark: SparkSession, name: str, changes: Sequence[Load], column: str) -> DataFrame:
    """The distinct partition values of some changes, as column ``column`` with the table's type."""
    kind = spark.table(name).schema[column].dataType
    log = spark.table(_log(name, CHANGES)).filter((F.col("table_name") == name) & F.col("change_id").isin([x.load_id for x in changes]))
    return log.select(F.col("part").cast(kind).alias(column)).distinct()
