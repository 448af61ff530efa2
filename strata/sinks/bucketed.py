"""Keyed tables by hash bucket (W3, J1): an upsert that rewrites only the buckets its keys fall into.

A bucketed table is partitioned by ``key_bucket``, a hash of its key modulo the number of buckets, which is kept with
the key in the table's properties. A batch gets the same column from the same key types, so the buckets it touches
are known before the table is read: they are a static partition filter on the table's side of the merge
(other folders are not even listed), the only partitions written (dynamic partition overwrite), and a
condition of the join. Rows whose key holds a NULL match nothing; they are spread by a hash of the
whole row, so many of them do not fill one bucket.

A batch of n keys touches at most n buckets, and the number of buckets bounds what the driver sees of
it. Choose it so that a bucket is a few files (``rebucket`` changes it as the table grows).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import quote
from strata.operators.dedup import key_stats
from strata.operators.merge import merge_frames, op_counts, op_name
from strata.operators.schema import free_name, match_names, merged_type, spelt_like
from strata.session import staged_rows
from strata.sinks.tables import (
    LoadResult,
    _declare,
    _dynamic_overwrite,
    _home_for_new_table,
    _properties,
    _swap_write,
    evolve_schema,
    finish_swap,
    observe,
    observed,
    record_load,
    require_unique,
    table_exists,
    write_balanced,
)

BUCKET = "key_bucket"
BUCKETS = 256
_KEYS, _COLUMN, _COUNT = "strata.bucket.keys", "strata.bucket.column", "strata.buckets"


def bucket_of(df: DataFrame, keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row, from the values and types of its key columns; by the whole row where one is NULL."""
    cols = [F.col(quote(k)) for k in keys]
    no_key = cols[0].isNull()
    for c in cols[1:]:
        no_key = no_key | c.isNull()
    plain = [F.col(quote(f.name)) for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.pmod(F.when(no_key, F.xxhash64(*plain)).otherwise(F.xxhash64(*cols)), F.lit(buckets)).cast("int")


def bucket_layout(spark: SparkSession, name: str) -> tuple[list[str], str, int]:
    """(key columns, bucket column, number of buckets) of a bucketed table."""
    p = _properties(spark, name)
    if _COUNT not in p:
        raise ValueError(f"{name} is not a bucketed table")
    return p[_KEYS].split("\x1f"), p[_COLUMN], int(p[_COUNT])


def create_bucketed(spark: SparkSession, name: str, df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> LoadResult:
    """Create a bucketed table from a frame (its keys are not checked, as in any first load)."""
    keys = spelt_like(df, keys)
    column = free_name(BUCKET, df.columns)
    rows, obs = observe(_dealt(df, keys, column, buckets), F.count(F.lit(1)).alias("rows"))
    # Declared with its layout first: a crash before the rows are in leaves an empty table that the next load fills.
    location = f"{_home_for_new_table(spark, name)}/{uuid.uuid4().hex}"
    _declare(spark, name, rows.schema, [column], location, _layout(keys, column, buckets))
    write_balanced(rows, column).write.insertInto(name)
    n = int((observed(obs) or {"rows": 0})["rows"])
    return LoadResult(name, "create", n, 0, n)


def _layout(keys: Sequence[str], column: str, buckets: int) -> dict[str, str]:
    return {_KEYS: "\x1f".join(keys), _COLUMN: column, _COUNT: str(buckets)}


def keyed_table(spark: SparkSession, name: str) -> DataFrame:
    """The rows of a bucketed table, without the bucket column."""
    return spark.table(name).drop(bucket_layout(spark, name)[1])


def touched_buckets(rows: DataFrame, column: str) -> list[int]:
    """Bucket numbers of a materialised batch: at most as many as the table has."""
    return sorted(r[0] for r in rows.select(F.col(quote(column))).distinct().collect())


def merge_bucketed(
    spark: SparkSession, name: str, source: DataFrame, newest_by: Sequence[str] = (), checked: bool = False
) -> LoadResult:
    """Upsert a frame (one row per key without NULLs, else ValueError) into a bucketed table; only the buckets of its keys are
    read and written. With ``newest_by`` a row of the table that is greater by these columns stays."""
    keys, column, buckets = bucket_layout(spark, name)
    source = match_names(source, spark.table(name).columns)
    _check_keys(spark, name, source, keys)
    rows = evolve_schema(spark, name, source.drop(column))
    if not checked:
        require_unique(source, keys)
    with staged_rows(_dealt(rows, keys, column, buckets)) as batch:
        touched = touched_buckets(batch, column)
        if not touched:
            return LoadResult(name, "merge", 0, 0, 0)
        batch = batch.select(*[F.col(quote(c)) for c in [*source.columns, column] if c in batch.columns])
        target = spark.table(name)
        old = target.filter(F.col(quote(column)).isin(touched))
        state = merge_frames(old, batch, [*keys, column], order_by=newest_by)
        state, obs = observe(state, *op_counts(op_name(old, batch)))
        _overwrite(spark, name, state, column)
    m = obs.get
    return LoadResult(name, "merge", int(m["updated"] + m["inserted"]), int(m["updated"]), int(m["inserted"]))


def _dealt(rows: DataFrame, keys: Sequence[str], column: str, buckets: int) -> DataFrame:
    rows = rows.drop(column)
    return rows.withColumn(column, bucket_of(rows, keys, buckets))


def _overwrite(spark: SparkSession, name: str, state: DataFrame, column: str) -> None:
    ordered = state.select(*[quote(c) for c in spark.table(name).columns])
    with _dynamic_overwrite(spark):
        write_balanced(ordered, column).write.insertInto(name, overwrite=True)
    spark.catalog.refreshTable(name)


def _check_keys(spark: SparkSession, name: str, source: DataFrame, keys: Sequence[str]) -> None:
    """The bucket is a hash of the key as stored: a wider key type would move every row, so that needs ``rebucket``."""
    have = {f.name: f.dataType for f in spark.table(name).schema.fields}
    for f in source.schema.fields:
        if f.name in keys and merged_type(f.name, have[f.name], f.dataType) != have[f.name]:
            raise TypeError(f"{name}: key {f.name} is {have[f.name].simpleString()}, the batch has {f.dataType.simpleString()}; widen it with rebucket first")
    missing = [k for k in keys if k not in source.columns]
    if missing:
        raise ValueError(f"{name}: the batch lacks the key {', '.join(missing)}")


def append_bucketed(spark: SparkSession, name: str, df: DataFrame) -> LoadResult:
    """Add the rows of a frame to their buckets without a match."""
    keys, column, buckets = bucket_layout(spark, name)
    df = match_names(df, spark.table(name).columns)
    _check_keys(spark, name, df, keys)
    rows = evolve_schema(spark, name, df.drop(column))
    counted, obs = observe(_dealt(rows, keys, column, buckets), F.count(F.lit(1)).alias("rows"))
    write_balanced(counted.select(*[quote(c) for c in spark.table(name).columns]), column).write.insertInto(name)
    n = int((observed(obs) or {"rows": 0})["rows"])
    return LoadResult(name, "append", n, 0, n)


def load_bucketed(
    spark: SparkSession,
    name: str,
    df: DataFrame,
    keys: Sequence[str] | str,
    buckets: int = BUCKETS,
    newest_by: Sequence[str] = (),
    history: bool = True,
) -> LoadResult:
    """``load_table`` for a table by hash bucket: absent -> create with every row; the key not unique in the batch
    (NULL counts as a value) -> append; otherwise an upsert that touches the buckets of the batch only."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    finish_swap(spark, name)
    if not table_exists(spark, name):
        res = create_bucketed(spark, name, df, keys, buckets)
    else:
        stored = bucket_layout(spark, name)[0]
        if spelt_like(spark.table(name), keys) != stored:
            raise ValueError(f"{name} is bucketed by {', '.join(stored)}")
        with staged_rows(df) as staged:
            stats = key_stats(staged, spelt_like(staged, keys)).first()
            if not stats["rows"]:
                res = LoadResult(name, "merge", 0, 0, 0)
            elif stats["is_unique"]:
                res = merge_bucketed(spark, name, staged, newest_by, checked=True)
            else:
                res = append_bucketed(spark, name, staged)
    if history:
        record_load(spark, res)
    return res


def find_keys(spark: SparkSession, name: str, wanted: DataFrame) -> DataFrame:
    """Rows of a bucketed table whose key is among ``wanted`` (the key columns), read from their buckets only."""
    keys, column, buckets = bucket_layout(spark, name)
    target = spark.table(name)
    types = {f.name: f.dataType for f in target.schema.fields}
    wanted = match_names(wanted, target.columns).select(*[F.col(quote(k)).cast(types[k]).alias(k) for k in keys]).distinct()
    wanted = wanted.dropna().withColumn(column, bucket_of(wanted, keys, buckets))
    pruned = target.filter(F.col(quote(column)).isin(touched_buckets(wanted, column)))
    return pruned.join(wanted, [*keys, column], "left_semi").drop(column)


def rebucket(spark: SparkSession, name: str, buckets: int, key_types: dict[str, T.DataType] | None = None) -> None:
    """Rewrite a bucketed table with another number of buckets, or wider key types, and switch to it."""
    keys, column, _ = bucket_layout(spark, name)
    rows = spark.table(name).drop(column)
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    for k, kind in (key_types or {}).items():
        rows = rows.withColumn(k, F.col(quote(k)).cast(merged_type(k, kinds[k], kind)))
    state = write_balanced(_dealt(rows, keys, column, buckets), column)
    _swap_write(spark, name, state, partition_by=[column], properties=_layout(keys, column, buckets))


def remove_keys(spark: SparkSession, name: str, gone: DataFrame) -> int:
    """Delete the rows of some keys (here NULL equals NULL); returns how many. Buckets left without a row are dropped."""
    from strata.sinks.ledger import clear_partition

    keys, column, buckets = bucket_layout(spark, name)
    target = spark.table(name)
    types = {f.name: f.dataType for f in target.schema.fields}
    gone = match_names(gone, target.columns).select(*[F.col(quote(k)).cast(types[k]).alias(k) for k in keys]).distinct()
    with staged_rows(gone) as wanted:
        no_key = F.lit(False)
        for k in keys:
            no_key = no_key | F.col(quote(k)).isNull()
        with_null = wanted.filter(no_key).head(1)  # rows with a NULL key may be in any bucket
        dealt = wanted.filter(~no_key)
        touched = touched_buckets(dealt.withColumn(column, bucket_of(dealt, keys, buckets)), column)
        old = target if with_null else target.filter(F.col(quote(column)).isin(touched))
        same = None
        for k in keys:
            e = F.col(f"t.{quote(k)}").eqNullSafe(F.col(f"g.{quote(k)}"))
            same = e if same is None else same & e
        hit = old.alias("t").join(wanted.alias("g"), same, "left_semi").groupBy(quote(column)).count().collect()  # a row per bucket
        if not hit:
            return 0
        rows = old.filter(F.col(quote(column)).isin([r[0] for r in hit]))
        with staged_rows(rows.alias("t").join(wanted.alias("g"), same, "left_anti")) as kept:
            left = touched_buckets(kept, column)
            _overwrite(spark, name, kept, column)
        for b in {r[0] for r in hit} - set(left):
            clear_partition(spark, name, column, b)
        spark.catalog.refreshTable(name)
        return sum(r[1] for r in hit)
