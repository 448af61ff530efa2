"""Aggregated tables maintained from the partitions that changed.

``refresh_aggregate`` takes the changes that a partitioned table has published, computes the state of those
partitions again (the scan is limited to them), replaces it in the state table, and upserts the groups
that occur in their old or new state into the aggregated table, which is kept by hash bucket.

Each step may be repeated: state partitions are replaced, the upsert is by key, and the groups to combine are written to a
pending table before the old state goes. The changes count as taken at the very end, so a run that broke off anywhere is
done again by the next one.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import quote
from strata.operators.profile_state import HLL_LG_K, KLL_K, partition_profile
from strata.operators.state import AggregateSpec, combine_state, partial_state
from strata.session import staged_rows
from strata.sinks import ledger
from strata.sinks.bucketed import BUCKETS, load_bucketed, remove_keys
from strata.sinks.tables import (
    LoadResult,
    _declare,
    _dynamic_overwrite,
    _home_for_new_table,
    _swap_write,
    finish_swap,
    partition_columns,
    table_exists,
    touched_partitions,
    write_balanced,
)


def _pending(state: str) -> str:
    return f"{state}_pending"


def _ensure(spark: SparkSession, name: str, schema: T.StructType, parts: list[str]) -> None:
    finish_swap(spark, name)
    if not table_exists(spark, name):
        _declare(spark, name, schema, parts, f"{_home_for_new_table(spark, name)}/{uuid.uuid4().hex}", {})


def refresh_aggregate(
    spark: SparkSession, source: str, state: str, result: str, spec: AggregateSpec, consumer: str, buckets: int = BUCKETS
) -> LoadResult:
    """Bring table ``result`` (the aggregate of table ``source``, one row per group) up to date with the changes of
    ``source`` that ``consumer`` has not taken; ``state`` is the table of partial aggregates."""
    part = partition_columns(spark, source)[0]
    changes = ledger.unseen_changes(spark, consumer, source)
    if not changes:
        return LoadResult(result, "merge", 0, 0, 0)
    keys = [quote(k) for k in spec.keys]
    with staged_rows(ledger.changed_parts(spark, source, changes, part)) as parts:
        rows = touched_partitions(spark.table(source), parts, part)
        fresh = partial_state(rows, spec, part)
        _ensure(spark, state, fresh.schema, [part])
        _ensure(spark, _pending(state), T.StructType([fresh.schema[k] for k in spec.keys]), [])
        with staged_rows(fresh) as new:
            old = touched_partitions(spark.table(state), parts, part)
            old.select(*keys).unionByName(new.select(*keys)).distinct().write.insertInto(_pending(state))
            replace_partitions(spark, state, new, parts, part)
    result_of = _combine_pending(spark, state, result, spec, buckets)
    ledger.mark_taken(spark, consumer, source, changes)
    _swap_write(spark, _pending(state), spark.table(_pending(state)).limit(0))
    return result_of


def replace_partitions(spark: SparkSession, name: str, rows: DataFrame, parts: DataFrame, part: str) -> None:
    """Let ``rows`` be all that the listed partitions of a table hold; those without a row go."""
    p = F.col(quote(part))
    with _dynamic_overwrite(spark):
        write_balanced(rows.select(*[quote(c) for c in spark.table(name).columns]), part).write.insertInto(name, overwrite=True)
    spark.catalog.refreshTable(name)
    emptied = parts.select(p.alias("was")).distinct().join(rows.select(p).distinct(), F.col("was").eqNullSafe(p), "left_anti")
    for r in emptied.collect():  # names of partitions
        ledger.clear_partition(spark, name, part, r[0])
    spark.catalog.refreshTable(name)


def _combine_pending(spark: SparkSession, state: str, result: str, spec: AggregateSpec, buckets: int) -> LoadResult:
    keys = [quote(k) for k in spec.keys]
    with staged_rows(spark.table(_pending(state)).distinct()) as groups:
        same = None
        for k in spec.keys:  # a NULL group is a group
            e = F.col(f"s.{quote(k)}").eqNullSafe(F.col(f"g.{quote(k)}"))
            same = e if same is None else same & e
        held = spark.table(state).alias("s").join(groups.alias("g"), same, "left_semi")
        combined = combine_state(held, spec)
        with staged_rows(combined) as rows:
            gone = groups.alias("g").join(rows.select(*keys).alias("s"), same, "left_anti")
            null = F.lit(False)
            for k in keys:
                null = null | F.col(k).isNull()
            if table_exists(spark, result):  # NULL groups match no key: replace theirs
                remove_keys(spark, result, gone.unionByName(rows.select(*keys).filter(null)).distinct())
            return load_bucketed(spark, result, rows, spec.keys, buckets, history=False)


def refresh_profile(
    spark: SparkSession, source: str, state: str, columns: Sequence[str], consumer: str, k: int = KLL_K, lg_k: int = HLL_LG_K
) -> int:
    """Bring the profile state of a partitioned table (``operators.profile_state``) up to date with the changes that
    ``consumer`` has not taken: only those partitions are scanned. Returns how many changes were taken. Repeating a run that
    broke off gives the same state."""
    part = partition_columns(spark, source)[0]
    changes = ledger.unseen_changes(spark, consumer, source)
    if not changes:
        return 0
    with staged_rows(ledger.changed_parts(spark, source, changes, part)) as parts:
        fresh = partition_profile(touched_partitions(spark.table(source), parts, part), columns, part, k, lg_k)
        _ensure(spark, state, fresh.schema, [part])
        with staged_rows(fresh) as new:
            replace_partitions(spark, state, new, parts, part)
    ledger.mark_taken(spark, consumer, source, changes)
    return len(changes)
