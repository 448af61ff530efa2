"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import checkpoint_root, conf, scratch_path

#: Words as every contract here counts them: runs of anything but 0x20, 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Frames with at most this many rows may be broadcast (they are counted first).
BROADCAST_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def word_count(c: Column) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def crc_mod(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % n


def cut(df: DataFrame) -> DataFrame:
    """Materialise a frame in the shared checkpoint folder: lineage ends here, and
    a lost executor costs a read instead of a recomputation."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, path: str | None = None, *partition: str) -> DataFrame:
    """Write a table to the shared folder (by default a fresh scratch one) and read it back.
    The shuffle files behind it go when it is written: the table replaces them."""
    spark = df.sparkSession
    path = path or scratch_path(spark, "llm")
    with conf(spark, **{"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        df.write.partitionBy(*partition).option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_memory() -> None:
    """Hand what a task has freed back to the system, at its end: workers are reused, so what their
    allocators keep from one operator's tasks counts against the next one's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def free(stem: str, taken: Iterable[str]) -> str:
    """A column name from ``stem`` that is none of ``taken``, whatever their case."""
    held, name = {c.lower() for c in taken}, stem
    while name in held:
        name = f"_{name}"
    return name


def set_aside(names: Iterable[str]) -> tuple[list[Column], list[Column]]:
    """Columns an operator only carries: under numbered names for the time of its work, so that none is
    taken for one of its own, and back under theirs."""
    names = list(names)
    return [F.col(f"`{c}`").alias(f"_in{i}") for i, c in enumerate(names)], [F.col(f"_in{i}").alias(c) for i, c in enumerate(names)]


def bounded_join(big: DataFrame, small: DataFrame, on: Column, how: str = "inner") -> DataFrame:
    """Join a materialised small frame: broadcast only when its counted rows are few."""
    if small.count() <= BROADCAST_ROWS:
        small = F.broadcast(small)
    return big.join(small, on, how)


def ranked(
    df: DataFrame, groups: Iterable[str], order: Iterable[Column], sum_col: str | None = None, prefix: str = "__rank"
) -> DataFrame:
    """Position of every row in the order of its group, however large the group.

    Rows are range-partitioned by (groups, order), so a group that holds a third of
    the table covers many partitions; a window runs inside each (group, partition)
    and the group's earlier partitions are added as an offset. Adds ``{prefix}_n``
    (1-based row number) and, with ``sum_col``, ``{prefix}_sum``: the sum of that
    column over the rows before this one. ``order`` must be total, or rows that tie
    must be alike.
    """
    groups, order = list(groups), list(order)
    pid, before, before_sum = f"{prefix}_pid", f"{prefix}_before", f"{prefix}_before_sum"
    value = F.col(sum_col) if sum_col else F.lit(0)
    dealt = df.repartitionByRange(*[F.col(g).asc_nulls_last() for g in groups], *order)
    dealt = cut(dealt.withColumn(pid, F.spark_partition_id()))
    each = dealt.groupBy(*groups, pid).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("s"))
    earlier = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    earlier = earlier.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    offsets = each.select(
        *[F.col(g).alias(f"{prefix}_g{i}") for i, g in enumerate(groups)],
        F.col(pid).alias(f"{prefix}_p"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before),
        F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias(before_sum),
    )
    on = F.col(pid) == F.col(f"{prefix}_p")
    for i, g in enumerate(groups):
        on = on & F.col(g).eqNullSafe(F.col(f"{prefix}_g{i}"))
    inside = Window.partitionBy(*groups, pid).orderBy(*order)
    sums = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumn(f"{prefix}_n", F.row_number().over(inside).cast("long"))
    if sum_col:
        local = local.withColumn(f"{prefix}_sum", F.coalesce(F.sum(value).over(sums), F.lit(0)))
    out = local.join(offsets, on).withColumn(f"{prefix}_n", F.col(f"{prefix}_n") + F.col(before))
    if sum_col:
        out = out.withColumn(f"{prefix}_sum", F.col(f"{prefix}_sum") + F.col(before_sum))
    return out.drop(pid, before, before_sum, f"{prefix}_p", *[f"{prefix}_g{i}" for i in range(len(groups))])
