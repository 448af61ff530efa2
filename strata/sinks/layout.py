"""Tables laid out for skipping files.

``write_clustered`` orders the rows by the interleaved bits of two or three filter columns, so that each file covers a small
box of their values, and writes Parquet Bloom filters on id columns. A side table holds the ends of those columns in every
file. ``find_clustered`` compares a document filter with these ends and reads the files whose box it meets and no others:
they are neither opened nor scheduled. Within a file Spark's own pushdown skips row groups by statistics and by
the Bloom filter of an id.

The columns are ranked by quantiles of the data, so skewed values fill the curve evenly; ends are exact. Files that came
after the layout, by appends, are in no index and always read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import quote
from strata.operators.find import _fits, _lit, _project, compile_filter
from strata.operators.schema import free_name, spelt_like
from strata.sinks.tables import (
    LoadResult,
    _declare,
    _home_for_new_table,
    _swap_write,
    finish_swap,
    observe,
    observed,
    partition_columns,
    table_exists,
)

#: Bits of each column in the curve: its values are told apart by 2 ** BITS - 1 quantiles.
BITS = 6
_TEXT_BYTES = 6


def files_of(name: str) -> str:
    return f"{name}_files"


def as_number(c: Column, kind: T.DataType) -> Column:
    """A double that grows with the values of a column (of text: with its first bytes)."""
    if isinstance(kind, T.NumericType):
        x = c.cast("double")
        return F.when(~F.isnan(x), x)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.to_timestamp_ltz(c)).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(c.cast("binary"), 1, _TEXT_BYTES)), 2 * _TEXT_BYTES, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(kind, T.BooleanType):
        return c.cast("int").cast("double")
    raise TypeError(f"rows cannot be laid out by a column of type {kind.simpleString()}")


def _rank(x: Column, cuts: Sequence[float]) -> Column:
    """How many of the ascending cut points lie at or below x, by bisection; a NULL has rank 0."""
    if not cuts:
        return F.lit(0)

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(x >= F.lit(float(cuts[middle])), between(middle + 1, high)).otherwise(between(low, middle))

    return F.when(x.isNull(), F.lit(0)).otherwise(between(0, len(cuts)))


def curve_position(df: DataFrame, by: Sequence[str], bits: int = BITS) -> Column:
    """Interleaved bits of the ranks of some columns, highest first. One aggregate takes the quantiles that rank them: at most
    2 ** bits - 1 numbers a column come to the driver."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    number = {c: as_number(F.col(quote(c)), kinds[c]) for c in by}
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    row = df.agg(*[F.percentile_approx(number[c], shares, 10_000).alias(f"q{i}") for i, c in enumerate(by)]).first()
    ranks = [_rank(number[c], sorted(set(row[f"q{i}"] or []))) for i, c in enumerate(by)]
    z = F.lit(0).cast("long")
    for b in range(bits):
        for i, r in enumerate(ranks):
            bit = F.shiftright(r.cast("long"), b).bitwiseAND(F.lit(1).cast("long"))
            z = z.bitwiseOR(F.shiftleft(bit, b * len(by) + len(by) - 1 - i))
    return z


def write_clustered(
    spark: SparkSession, name: str, df: DataFrame, by: Sequence[str], ids: Sequence[str] = (), files: int | None = None, bits: int = BITS
) -> LoadResult:
    """Write a frame as an unpartitioned table (a new one, or the new state of the old one) in the order of the curve over
    ``by``, with Bloom filters on ``ids``, and index its files. ``files`` (default: as many as shuffle partitions) is their
    number. The frame is read twice, so it should be stored."""
    by, ids = spelt_like(df, by), spelt_like(df, ids)
    mark = free_name("position", df.columns)
    placed = df.withColumn(mark, curve_position(df, by, bits))
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = placed.repartitionByRange(n, mark).sortWithinPartitions(mark).drop(mark)
    counted, obs = observe(ordered, F.count(F.lit(1)).alias("rows"))
    finish_swap(spark, name)
    new = f"{_home_for_new_table(spark, name)}/{uuid.uuid4().hex}"
    writer = counted.write.format("parquet").mode("errorifexists")
    for c in ids:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.save(new)
    if table_exists(spark, name):
        if partition_columns(spark, name):
            raise ValueError(f"{name} is partitioned")
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{new}'")
        spark.catalog.refreshTable(name)
    else:
        _declare(spark, name, df.schema, [], new, {})
    index_files(spark, name, [*by, *[c for c in ids if c not in by]])
    rows = int((observed(obs) or {"rows": 0})["rows"])
    return LoadResult(name, "create", rows, 0, rows)


def index_files(spark: SparkSession, name: str, columns: Sequence[str]) -> None:
    """(path, rows, <column>_low, <column>_high, ...) of every file of a table, kept as ``<name>_files``."""
    ends = [f(F.col(quote(c))).alias(f"{c}_{end}") for c in columns for f, end in ((F.min, "low"), (F.max, "high"))]
    table = spark.table(name)
    path = free_name("path", table.columns)
    found = table.select("*", F.col("_metadata.file_path").alias(path)).groupBy(F.col(path).alias("path")).agg(F.count(F.lit(1)).alias("rows"), *ends)
    side = files_of(name)
    finish_swap(spark, side)
    if table_exists(spark, side) and spark.table(side).schema.simpleString() == found.schema.simpleString():
        _swap_write(spark, side, found)
        return
    spark.sql(f"DROP TABLE IF EXISTS {side}")
    place = f"{_home_for_new_table(spark, side)}/{uuid.uuid4().hex}"
    found.write.parquet(place)
    _declare(spark, side, found.schema, [], place, {})


def _may_match(query: Mapping[str, Any], columns: Mapping[str, T.DataType]) -> Column:
    """Whether a file may hold a match, from the ends of its indexed columns; conditions on anything else say nothing."""
    out = F.lit(True)
    for field, spec in query.items():
        if field == "$and":
            for q in spec:
                out = out & _may_match(q, columns)
        if field not in columns:
            continue
        low, high = F.col(quote(f"{field}_low")), F.col(quote(f"{field}_high"))
        ops = spec if isinstance(spec, Mapping) else {"$eq": spec}
        for op, v in ops.items():
            values = [v] if op != "$in" else list(v)
            if any(x is None for x in values) or op not in ("$eq", "$in", "$gt", "$gte", "$lt", "$lte"):
                continue  # NULLs are not in the ends
            fitting = [_lit(x) for x in values if _fits(x, columns[field])]
            some = F.lit(False)
            for x in fitting:
                some = some | {"$gt": high > x, "$gte": high >= x, "$lt": low < x, "$lte": low <= x}.get(op, (low <= x) & (x <= high))
            out = out & some
    return F.coalesce(out, F.lit(False))


def matching_files(spark: SparkSession, name: str, query: Mapping[str, Any]) -> list[str]:
    """Paths of the files of a table that may hold a match: those whose ends meet the filter, and those in no index."""
    present = {_path(p) for p in spark.table(name).inputFiles()}
    side = files_of(name)
    if not table_exists(spark, side):
        return sorted(present)
    index = spark.table(side)
    kinds = {f.name: f.dataType for f in spark.table(name).schema.fields}
    columns = {c[: -len("_low")]: kinds[c[: -len("_low")]] for c in index.columns if c.endswith("_low") and c[: -len("_low")] in kinds}
    known = index.select("path", _may_match(query, columns).alias("may")).collect()  # a row per file
    out = {_path(r["path"]) for r in known if r["may"]} & present
    return sorted(out | (present - {_path(r["path"]) for r in known}))


def _path(uri: str) -> str:
    """One spelling of a path: Spark writes those without a host with one slash or three."""
    return re.sub(r"^(\w+):/+(?=[^/])", r"\1:/", uri) if re.match(r"^\w+:(/|///)[^/]", uri) else uri


def find_clustered(
    spark: SparkSession, name: str, query: Mapping[str, Any], projection: Mapping[str, Any] | None = None, limit: int = 0, id_field: str = "_id"
) -> DataFrame:
    """``operators.find.find`` on a table of ``write_clustered``, reading only the files that may hold a match."""
    schema = spark.table(name).schema
    paths = matching_files(spark, name, query)
    rows = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    out = _project(rows.filter(compile_filter(query, columns=schema)), projection, id_field)
    return out.limit(limit) if limit and limit > 0 else out
