"""Partitioned upserts on the key alone, with a key locator.

A row whose date moves must leave its old partition. A locator, a table by hash bucket beside the partitioned one, says for
every key in which partitions its row may be. A load looks the batch's keys up there (buckets of the batch only), and
rewrites their old and new partitions; no other folder is read or written.

The locator is written twice: before the data with the old and the new place of every key, and after it with the
new place alone. Whatever breaks off in between, the locator names every partition that may hold a key, so the next load
of that key finds its row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import partition_date, quote
from strata.operators.dedup import latest_per_key
from strata.operators.merge import merge_frames, op_counts, op_name
from strata.operators.schema import spelt_like
from strata.session import staged_rows
from strata.sinks.bucketed import BUCKETS, create_bucketed, find_keys, merge_bucketed
from strata.sinks.maintained import replace_partitions
from strata.sinks.tables import (
    LoadResult,
    create_table,
    evolve_schema,
    finish_swap,
    observe,
    partition_columns,
    record_load,
    table_exists,
    touched_partitions,
)

PLACES = "places"


def locator_of(name: str) -> str:
    return f"{name}_locator"


def build_locator(spark: SparkSession, name: str, keys: Sequence[str], buckets: int = BUCKETS) -> None:
    """The locator of an existing table: one pass over its keys and partition column."""
    part = partition_columns(spark, name)[0]
    places = spark.table(name).groupBy(*[F.col(quote(k)).alias(k) for k in keys]).agg(F.sort_array(F.collect_set(_place(part))).alias(PLACES))
    create_bucketed(spark, locator_of(name), places.dropna(subset=list(keys)), keys, buckets)


def _place(part: str) -> F.Column:
    return F.coalesce(F.col(quote(part)).cast("string"), F.lit(""))  # "": the partition of NULL


def load_located(
    spark: SparkSession,
    name: str,
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    date_col: str,
    fallback_date_col: str | None = None,
    tie_break: Sequence[str] = (),
    newest_wins: bool = False,
    buckets: int = BUCKETS,
    history: bool = True,
) -> LoadResult:
    """``load_partitioned`` matching on the keys alone: a row whose date moved leaves its old partition. Only the old and
    new partitions of the batch's keys are rewritten; one that loses its last row is dropped. Keys that hold a NULL match
    nothing and are added. With ``newest_wins`` a row of the table that is greater by the order columns
    stays, in its partition."""
    part = f"{date_col}_Partition"
    fallbacks = [fallback_date_col] if fallback_date_col else []
    src = latest_per_key(df, keys, order_by, tie_break).withColumn(part, partition_date(date_col, *fallbacks))
    finish_swap(spark, name)
    if not table_exists(spark, name):
        res = create_table(spark, name, src, partition_by=[part])
        build_locator(spark, name, spelt_like(spark.table(name), keys), buckets)
    else:
        stored = spelt_like(spark.table(name), keys)
        finish_swap(spark, locator_of(name))
        if not table_exists(spark, locator_of(name)):
            build_locator(spark, name, stored, buckets)
        with staged_rows(evolve_schema(spark, name, src)) as batch:
            res = _merge_located(spark, name, batch, stored, part, [*order_by, *tie_break] if newest_wins else [])
    if history:
        record_load(spark, res)
    return res


def _merge_located(spark: SparkSession, name: str, batch: DataFrame, keys: Sequence[str], part: str, newest_by: Sequence[str]) -> LoadResult:
    if batch.isEmpty():
        return LoadResult(name, "merge", 0, 0, 0)
    locator, cols = locator_of(name), [quote(k) for k in keys]
    kind = spark.table(name).schema[part].dataType
    now = batch.dropna(subset=list(keys)).select(*cols, _place(part).alias("now"))
    with staged_rows(find_keys(spark, locator, batch.select(*cols))) as known:
        both = now.join(known, list(keys), "left").select(*cols, F.array_distinct(F.concat(F.coalesce(PLACES, F.array().cast("array<string>")), F.array("now"))).alias(PLACES))
        merge_bucketed(spark, locator, both, checked=True)
        values = known.select(F.explode(PLACES).alias("p")).union(batch.select(_place(part)))
        values = values.distinct().select(F.when(F.col("p") != "", F.col("p")).cast(kind).alias(part))
        with staged_rows(values) as parts:
            target = spark.table(name)
            state = merge_frames(touched_partitions(target, parts, part), batch, keys, order_by=newest_by)
            state, obs = observe(state, *op_counts(op_name(target, batch)))
            with staged_rows(state.select(*[quote(c) for c in target.columns])) as rows:
                replace_partitions(spark, name, rows, parts, part)
                m = obs.get
                if newest_by:  # an older row of the batch did not move its key
                    place = rows.join(batch.select(*cols), list(keys), "left_semi").groupBy(*cols).agg(F.collect_set(_place(part)).alias(PLACES))
                else:
                    place = now.select(*cols, F.array("now").alias(PLACES))
                merge_bucketed(spark, locator, place, checked=True)
    return LoadResult(name, "merge", int(m["updated"] + m["inserted"]), int(m["updated"]), int(m["inserted"]))
