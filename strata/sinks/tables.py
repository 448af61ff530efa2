"""Table sinks (W1-W9, L2): create, append, keyed upsert, partitioned upsert.

Storage is plain Parquet behind catalog tables, so an upsert is computed as a
new state with ``merge_frames`` and then stored in one of two ways:

* **unpartitioned table** - the new state is written to a fresh directory
  next to the current one and the table is re-pointed with
  ``ALTER TABLE ... SET LOCATION``. The old directory is untouched until the
  swap, so a failed or retried job never leaves a half-written table.
* **date-partitioned table** - only the partitions that the source touches
  are read (the batch's date range as a static partition filter, then a semi
  join on its dates), merged, and written back with dynamic partition
  overwrite. Untouched partitions are never rewritten.

Counts come from ``DataFrame.observe`` on the write itself, so no second
job runs to count rows. One writer per table is assumed.
"""

from __future__ import annotations

import contextlib
import datetime as _dt
import logging
import re
import threading
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import partition_date, quote
from strata.operators.dedup import key_stats, latest_per_key
from strata.operators.merge import align_to, merge_frames, op_counts, op_name
from strata.operators.schema import free_name, match_names, merged_type
from strata.session import conf, remove_path, scratch_path, staged_rows, unique_name

log = logging.getLogger("strata")

# ``insertInto`` takes the overwrite mode only from the session conf (a
# writer option is ignored, and a static overwrite would clear every other
# partition), so partition overwrites switch the conf for the write and are
# serialised within this process: two loads in threads cannot interleave
# the switch and restore.
_OVERWRITE_LOCK = threading.Lock()


@contextlib.contextmanager
def _dynamic_overwrite(spark: SparkSession):
    with _OVERWRITE_LOCK, conf(spark, **{"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        yield

HISTORY_TABLE = "load_history"
# A history of this many one-row files is rewritten into one.
HISTORY_FILES = 64
HISTORY_SCHEMA = T.StructType(
    [
        T.StructField("load_id", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("operation", T.StringType()),
        T.StructField("source_rows", T.LongType()),
        T.StructField("rows_updated", T.LongType()),
        T.StructField("rows_inserted", T.LongType()),
        T.StructField("loaded_at", T.TimestampNTZType()),
    ]
)


@dataclass(frozen=True)
class LoadResult:
    table: str
    operation: str  # create | append | merge
    rows: int  # source rows handled by this load
    updated: int = 0
    inserted: int = 0
    failures: dict[str, int] = field(default_factory=dict)  # cells lost to typing, by column


# --- catalog helpers ----------------------------------------------------------


def _split(name: str) -> tuple[str | None, str]:
    parts = name.replace("`", "").split(".")
    return (parts[-2], parts[-1]) if len(parts) > 1 else (None, parts[0])


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{loc}")


def table_location(spark: SparkSession, name: str) -> str:
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect():
        if row[0] == "Location":
            return row[1]
    raise ValueError(f"table {name} has no location")


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def _home_for_new_table(spark: SparkSession, name: str) -> str:
    db, tbl = _split(name)
    db = db or spark.catalog.currentDatabase()
    base = spark.catalog.getDatabase(db).locationUri.rstrip("/")
    return f"{base}/{tbl}"


def observe(df: DataFrame, *aggs) -> tuple[DataFrame, Observation]:
    obs = Observation(unique_name("obs"))
    return df.observe(obs, *aggs), obs


def observed(obs: Observation) -> dict | None:
    """The metrics of a write; None when Catalyst found the plan empty and removed
    it together with the observation (Spark then holds no row to convert)."""
    try:
        return obs.get
    except Py4JJavaError as e:
        if e.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return None


def _rows(obs: Observation, df: DataFrame) -> int:
    """Rows observed in the write; an unobserved (empty) plan is counted."""
    seen = observed(obs)
    return int(df.count()) if seen is None else int(seen["rows"])


# --- schema evolution (W6) ---------------------------------------------------


def evolve_schema(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """Make a table ready for a frame, then return the frame cast and ordered as the table (missing columns NULL).

    New columns are added. A column whose type is too narrow for the frame's takes the narrowest type that holds
    both without loss (``widen_table``); where there is none this raises a TypeError: values are never cut. Names are
    matched as the session resolves them."""
    table_schema = spark.table(name).schema
    df = match_names(df, table_schema.names)
    frame = {f.name: f.dataType for f in df.schema.fields}
    wide = T.StructType([T.StructField(f.name, merged_type(f.name, f.dataType, frame[f.name]) if f.name in frame else f.dataType, f.nullable, f.metadata) for f in table_schema.fields])
    if [f.dataType for f in wide] != [f.dataType for f in table_schema]:
        widen_table(spark, name, wide)
        table_schema = spark.table(name).schema
    new = [f for f in df.schema.fields if f.name not in table_schema.names]
    if new:
        cols = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({cols})")
        spark.catalog.refreshTable(name)
        table_schema = spark.table(name).schema
    return align_to(df, table_schema, keep_extra=False)


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    start = next((i for i, r in enumerate(rows) if r[0].startswith("# Detailed Table")), 0)
    return {r[0]: r[1] for r in rows[start:]}


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return {r[0]: r[1] for r in rows if not r[0].startswith(("transient_", "spark.sql."))}


def widen_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Give columns of a Parquet table wider types without touching its files: Parquet readers widen the stored
    values. A table of the new types on the same folder takes the name (``finish_swap`` mends a crash). Partition
    columns cannot change, and a managed table cannot be replaced without losing its files: both raise."""
    parts, info = partition_columns(spark, name), _described(spark, name)
    old = {f.name: f.dataType for f in spark.table(name).schema.fields}
    changed = [f.name for f in schema.fields if old[f.name] != f.dataType]
    if set(changed) & set(parts):
        raise TypeError(f"{name}: the type of partition column {', '.join(sorted(set(changed) & set(parts)))} cannot change")
    if info.get("Type") == "MANAGED" or info.get("Provider", "parquet").lower() != "parquet":
        raise TypeError(f"{name}: only external Parquet tables can take wider types ({', '.join(changed)})")
    finish_swap(spark, name)
    _declare(spark, name + _NEXT, schema, parts, info["Location"], _properties(spark, name), info.get("Comment"))
    _take_name(spark, name, bool(parts))
    spark.catalog.refreshTable(name)


def _declare(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_by: Sequence[str],
    location: str,
    properties: Mapping[str, str],
    comment: str | None = None,
) -> None:
    """An external Parquet table on a folder, which may hold files already."""
    ddl = spark.sparkContext._jvm.org.apache.spark.sql.types.DataType.fromJson(schema.json()).toDDL()
    by = f" PARTITIONED BY ({', '.join(map(quote, partition_by))})" if partition_by else ""
    with_comment = f" COMMENT '{_sql_text(comment)}'" if comment else ""
    listed = ", ".join(f"'{_sql_text(k)}' = '{_sql_text(v)}'" for k, v in properties.items())
    with_properties = f" TBLPROPERTIES ({listed})" if listed else ""
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet{by} LOCATION '{location}'{with_comment}{with_properties}")


# --- writes ------------------------------------------------------------------


def write_balanced(df: DataFrame, *cols: str) -> DataFrame:
    """Ask AQE for evenly sized output files per partition value
    (``REBALANCE`` splits a hot value over several tasks)."""
    return df.hint("rebalance", *cols) if cols else df.hint("rebalance")


def create_table(
    spark: SparkSession,
    name: str,
    df: DataFrame,
    partition_by: Sequence[str] = (),
    location: str | None = None,
) -> LoadResult:
    """Create an external Parquet table from a frame."""
    home = location or _home_for_new_table(spark, name)
    path = f"{home}/{uuid.uuid4().hex}"
    counted, obs = observe(df, F.count(F.lit(1)).alias("rows"))
    if partition_by:
        counted = write_balanced(counted, *partition_by)  # else a load needs no shuffle
    writer = counted.write.format("parquet").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.mode("errorifexists").saveAsTable(name)
    n = _rows(obs, df)
    return LoadResult(name, "create", n, 0, n)


def append_table(spark: SparkSession, name: str, df: DataFrame) -> LoadResult:
    """Bag union by append, after schema evolution."""
    aligned = evolve_schema(spark, name, df)
    counted, obs = observe(aligned, F.count(F.lit(1)).alias("rows"))
    parts = partition_columns(spark, name)
    if parts:
        counted = write_balanced(counted, *parts)
    counted.write.insertInto(name, overwrite=False)
    n = _rows(obs, aligned)
    return LoadResult(name, "append", n, 0, n)


_NEXT, _PREVIOUS = "__strata_next", "__strata_previous"


def finish_swap(spark: SparkSession, name: str) -> None:
    """Complete or undo a table switch that a crash left half-done.

    A switch registers the new state as ``<name>__strata_next``, renames the
    table to ``<name>__strata_previous`` and the new one to its name. So an
    absent table with a next state takes it, with only a previous one goes back;
    leftovers beside the table are dropped (tables are external: files stay)."""
    if not table_exists(spark, name):
        for suffix in (_NEXT, _PREVIOUS):
            if table_exists(spark, name + suffix):
                spark.sql(f"ALTER TABLE {name}{suffix} RENAME TO {name}")
                break
    if table_exists(spark, name):
        for suffix in (_NEXT, _PREVIOUS):
            spark.sql(f"DROP TABLE IF EXISTS {name}{suffix}")


def _take_name(spark: SparkSession, name: str, partitioned: bool) -> None:
    """Let ``<name>__strata_next``, complete but for its partitions, replace the table."""
    if partitioned:
        spark.sql(f"ALTER TABLE {name}{_NEXT} RECOVER PARTITIONS")
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}{_PREVIOUS}")
    spark.sql(f"ALTER TABLE {name}{_NEXT} RENAME TO {name}")
    finish_swap(spark, name)


def _swap_write(
    spark: SparkSession, name: str, state: DataFrame, partition_by: Sequence[str] = (), properties: Mapping[str, str] | None = None
) -> None:
    """Write a full new state of a table to a fresh folder and re-point the
    table to it; the old folder is untouched until the switch. A partitioned table takes the types of the state,
    and ``properties`` beside its own."""
    current = table_location(spark, name).rstrip("/")
    parent = current.rsplit("/", 1)[0]
    new_path = f"{parent}/{uuid.uuid4().hex}"
    writer = state.write.format("parquet").mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(new_path)
    if partition_by:
        # The catalog keeps one location per partition, so re-pointing the
        # table is not enough: a complete table on the new folder takes its
        # name by two renames, and ``finish_swap`` mends a crash between them.
        finish_swap(spark, name)
        info = _described(spark, name)
        _declare(spark, name + _NEXT, state.schema, partition_by, new_path, _properties(spark, name) | dict(properties or {}), info.get("Comment"))
        _take_name(spark, name, True)
    else:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{new_path}'")
    spark.catalog.refreshTable(name)


def _sql_text(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")


def require_unique(source: DataFrame, keys: Sequence[str], null_safe: bool = False) -> None:
    """Raise when several source rows would update the same target row. NULL
    keys match nothing under plain equality, so they may repeat."""
    keyed = source if null_safe else source.dropna(subset=list(keys))
    twice = keyed.groupBy(*[F.col(quote(k)) for k in keys]).count().filter("count > 1").head(1)
    if twice:
        raise ValueError(f"several source rows for the key {tuple(twice[0])[:-1]}")


def merge_into(
    spark: SparkSession,
    name: str,
    source: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    checked: bool = False,
    newest_by: Sequence[str] = (),
) -> LoadResult:
    """Upsert into an unpartitioned table (matched -> update all columns,
    not matched -> insert, no delete). Raises when the source holds a key twice;
    a caller that has just checked that says so with ``checked``. With ``newest_by`` a row
    of the table that is greater by these columns stays."""
    if not checked:
        require_unique(source, keys, null_safe)
    if partition_columns(spark, name):
        raise ValueError(f"{name} is partitioned: use load_partitioned")
    evolve_schema(spark, name, source)
    target = spark.table(name)
    state = merge_frames(target, source, keys, null_safe, newest_by)
    state, obs = observe(state, *op_counts(op_name(target, source)))
    _swap_write(spark, name, state.select(*[quote(c) for c in target.columns]))
    m = obs.get
    return LoadResult(name, "merge", int(m["updated"] + m["inserted"]), int(m["updated"]), int(m["inserted"]))


def load_table(
    spark: SparkSession,
    name: str,
    df: DataFrame,
    keys: Sequence[str] | str | None = None,
    null_safe: bool = False,
    history: bool = True,
    newest_by: Sequence[str] = (),
) -> LoadResult:
    """Load a frame into a table.

    * table absent: create it with every row (no key check, no de-dup);
    * no key, or the key is not unique in the source (NULL counts as a
      value): append;
    * otherwise: upsert on the key, the batch's row replacing the table's; with ``newest_by``
      only where the table's row is not greater by these columns.

    Only a missing table leads to a create; any other error propagates.
    """
    if isinstance(keys, str):
        keys = [keys]
    finish_swap(spark, name)
    if not table_exists(spark, name):
        res = create_table(spark, name, df)
    elif not keys:
        res = append_table(spark, name, df)
    else:
        with staged_rows(df) as staged:
            stats = key_stats(staged, keys).first()
            if stats["rows"] == 0:
                res = LoadResult(name, "merge", 0, 0, 0)  # nothing to write
            elif stats["is_unique"]:
                res = merge_into(spark, name, staged, keys, null_safe, checked=True, newest_by=newest_by)
            else:
                res = append_table(spark, name, staged)
    if history:
        record_load(spark, res)
    return res


def load_partitioned(
    spark: SparkSession,
    name: str,
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    date_col: str,
    fallback_date_col: str | None = None,
    tie_break: Sequence[str] = (),
    match_partition: bool = True,
    null_safe: bool = False,
    history: bool = True,
    newest_wins: bool = False,
) -> LoadResult:
    """De-duplicate by key, derive ``<date_col>_Partition`` and
    create or upsert a date-partitioned table (K5, K24).

    The match is on the keys **and** the partition date (``match_partition``),
    so a key whose date moved is inserted in its new partition and the old row
    stays, as in the original; this is also what lets the merge read only the
    touched partitions. Rows whose partition date is NULL never match.
    With ``match_partition=False`` the match is on the keys alone (a moved
    row leaves its old partition), which needs the whole table rewritten
    (``sinks.located`` keeps a key locator and rewrites what moves only).
    A batch's row replaces the table's; with ``newest_wins`` only where the table's row is
    not greater by ``order_by`` and ``tie_break``, so batches may arrive in any order.
    """
    part = f"{date_col}_Partition"
    fallbacks = [fallback_date_col] if fallback_date_col else []
    src = latest_per_key(df, keys, order_by, tie_break).withColumn(
        part, partition_date(date_col, *fallbacks)
    )
    finish_swap(spark, name)
    if not table_exists(spark, name):
        res = create_table(spark, name, src, partition_by=[part])
    else:
        with staged_rows(evolve_schema(spark, name, src)) as batch:
            newest_by = [*order_by, *tie_break] if newest_wins else []
            res = merge_partitions(spark, name, batch, keys, part, match_partition, null_safe, newest_by)
    if history:
        record_load(spark, res)
    return res


def touched_partitions(target: DataFrame, batch: DataFrame, part: str) -> DataFrame | None:
    """The target rows in the partitions of a materialised batch; None for an empty one.

    One plan for any number of partitions: the batch's range is a static filter on
    the partition column (so other folders are not even listed), a semi join on its
    values leaves out what lies between, and NULL partitions are a branch of their own.
    """
    p = F.col(quote(part))
    seen = batch.agg(F.min(p), F.max(p), F.count_if(p.isNull()), F.count(F.lit(1))).first()
    if not seen[3]:
        return None
    parts = []
    if seen[0] is not None:
        within = p.between(F.lit(seen[0]), F.lit(seen[1]))
        touched = free_name("__touched", target.columns)
        values = batch.filter(within).select(p.alias(touched)).distinct()
        parts.append(target.filter(within).join(values, p == F.col(touched), "left_semi"))
    if seen[2]:
        parts.append(target.filter(p.isNull()))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def merge_partitions(
    spark: SparkSession,
    name: str,
    batch: DataFrame,
    keys: Sequence[str],
    part: str,
    match_partition: bool = True,
    null_safe: bool = False,
    newest_by: Sequence[str] = (),
) -> LoadResult:
    """Upsert a materialised batch (one row per key) into a partitioned table."""
    target = spark.table(name)
    columns = [quote(c) for c in target.columns]
    old = touched_partitions(target, batch, part)
    if old is None:  # empty batch: nothing to write
        return LoadResult(name, "merge", 0, 0, 0)
    if match_partition:
        state = merge_frames(old, batch, [*keys, part], null_safe, newest_by)
    else:
        state = merge_frames(target, batch, keys, null_safe, newest_by)
    state, obs = observe(state, *op_counts(op_name(target, batch)))
    ordered = write_balanced(state.select(*columns), part)
    if match_partition:
        # only the touched partitions are rewritten
        with _dynamic_overwrite(spark):
            ordered.write.insertInto(name, overwrite=True)
        spark.catalog.refreshTable(name)
    else:
        # a matched row may move to another date, which can leave its old
        # partition empty; dynamic overwrite never clears a partition, so
        # the whole table is rewritten to a new folder and swapped
        _swap_write(spark, name, ordered, partition_by=[part])
    m = obs.get
    return LoadResult(name, "merge", int(m["updated"] + m["inserted"]), int(m["updated"]), int(m["inserted"]))


def compact_partitions(
    spark: SparkSession, name: str, partitions: Sequence | None = None
) -> int:
    """Rewrite a table (or some partitions) into fewer, even files.

    Returns the number of rows rewritten (observed in the write).
    """
    parts = partition_columns(spark, name)
    df = spark.table(name)
    if parts and partitions is not None:
        df = df.filter(F.col(parts[0]).isin(list(partitions)))
    source = df
    df, obs = observe(df, F.count(F.lit(1)).alias("rows"))
    if parts:
        with _dynamic_overwrite(spark):
            write_balanced(df, *parts).write.insertInto(name, overwrite=True)
        spark.catalog.refreshTable(name)
    else:
        _swap_write(spark, name, write_balanced(df))
    return _rows(obs, source)


def vacuum_versions(spark: SparkSession, name: str, keep_previous: int = 1) -> list[str]:
    """Delete old version folders of a table written by this module, keeping
    the current one and the ``keep_previous`` most recent before it (a
    fallback for readers that started before the last swap). Only sibling
    folders named like a version (32 hex characters) are touched. Returns
    what was deleted. Run it when no reader can still be on an old version."""
    current = table_location(spark, name).rstrip("/")
    parent = current.rsplit("/", 1)[0]
    jvm = spark.sparkContext._jvm
    home = jvm.org.apache.hadoop.fs.Path(parent)
    fs = home.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    versions = [
        st
        for st in fs.listStatus(home)
        if st.isDirectory() and re.fullmatch(r"[0-9a-f]{32}", st.getPath().getName())
    ]
    older = sorted(
        (st for st in versions if st.getPath().toString().rstrip("/") != current),
        key=lambda st: st.getModificationTime(),
        reverse=True,
    )
    deleted = []
    for st in older[max(keep_previous, 0):]:
        fs.delete(st.getPath(), True)
        deleted.append(st.getPath().toString())
    return deleted


@contextlib.contextmanager
def staged_table(spark: SparkSession, df: DataFrame, name: str | None = None):
    """Write a frame to a scratch table, yield its name, drop it and its
    files after."""
    name = name or unique_name("staged")
    path = scratch_path(spark, "staged")
    df.write.format("parquet").option("path", path).saveAsTable(name)
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove_path(spark, path)


# --- load history (W9, L2) ---------------------------------------------------


def history_table_for(spark: SparkSession, name: str) -> str:
    db, _ = _split(name)
    return f"{db}.{HISTORY_TABLE}" if db else HISTORY_TABLE


def record_load(spark: SparkSession, res: LoadResult) -> None:
    """Append one row to the table's load history (and log it)."""
    log.info(
        "%s: %s, %d source rows, %d updated, %d inserted",
        res.table, res.operation, res.rows, res.updated, res.inserted,
    )
    hist = history_table_for(spark, res.table)
    row = [
        (
            uuid.uuid4().hex,
            res.table,
            res.operation,
            res.rows,
            res.updated,
            res.inserted,
            _dt.datetime.now(_dt.UTC).replace(tzinfo=None),
        )
    ]
    df = spark.createDataFrame(row, HISTORY_SCHEMA).coalesce(1)
    if table_exists(spark, hist):
        df.write.insertInto(hist)
        if len(spark.table(hist).inputFiles()) >= HISTORY_FILES:
            compact_partitions(spark, hist)
    else:
        home = _home_for_new_table(spark, hist)
        df.write.format("parquet").option("path", f"{home}/{uuid.uuid4().hex}").saveAsTable(hist)


def load_history(spark: SparkSession, name: str) -> DataFrame:
    hist = history_table_for(spark, name)
    return spark.table(hist).filter(F.col("table_name") == name)


def last_load(spark: SparkSession, name: str) -> DataFrame:
    """L2: the latest history entry of a table (one row)."""
    return load_history(spark, name).orderBy(F.col("loaded_at").desc(), F.col("load_id").desc()).limit(1)
