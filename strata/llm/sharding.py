"""Sharding by proportional stratified interleaving.

Within each source the rows are shuffled by a seeded hash and ranked; rank r of n
becomes the fraction (r - t) / n, t a phase in (0, 1) of the source, so that sources of equal
size do not come in clumps. Sorted by fraction, every stretch of the whole holds each
source in its overall share, so cutting the order into equal stretches gives shards that
all match the mixture, with row counts at most one apart. With s sources, a source of share q
stays within 2 + q * s / 2 rows of its share in every shard.

Both rankings are range-partitioned (``common.ranked``): neither one source nor the
whole table is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .registry import query

SEED = 29
SHARDS = 40


def interleave_shards(
    docs: DataFrame, n_shards: int = SHARDS, *, id_col: str = "doc_id", source_col: str = "source", seed: int = SEED, tie: str | None = None
) -> DataFrame:
    """The input rows with ``shard`` (0 to n_shards - 1) and ``slot`` (0-based, gapless).

    ``tie`` names a column that tells rows with the same id apart (say a checksum of
    the text); rows alike in id, source and tie are interchangeable. Defined cases: a
    null source is a stratum of its own; null ids are allowed; with fewer rows than
    shards some shards stay empty; an empty table gives no rows; input columns named
    ``shard`` or ``slot`` are replaced.
    """
    names = [c for c in docs.columns if c not in ("shard", "slot")]
    held, back = common.set_aside(names)
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ([id_col, tie] if tie else [id_col])]
    dealt = docs.select(
        *held,
        F.xxhash64(F.lit(seed), *keys).alias("__hash"),
        F.concat_ws("\x00", *keys).alias("__tie"),
        F.col(source_col).cast("string").alias("__stratum"),
    )
    order = [F.col("__hash").asc(), F.col("__tie").asc()]
    r = common.ranked(dealt, ["__stratum"], order, prefix="__in")
    counts = common.cut(dealt.groupBy(F.col("__stratum").alias("__c_stratum")).agg(F.count(F.lit(1)).alias("__c_rows")))
    total = counts.agg(F.coalesce(F.sum("__c_rows"), F.lit(0))).first()[0]
    r = common.bounded_join(r, counts, F.col("__stratum").eqNullSafe(F.col("__c_stratum")))
    phase = (F.pmod(F.xxhash64(F.lit(seed), "__stratum"), F.lit(1024)) + F.lit(0.5)) / 1024
    r = r.withColumn("__at", (F.col("__in_n") - phase) / F.col("__c_rows"))
    p = common.ranked(r, [], [F.col("__at").asc(), F.col("__hash").asc(), F.col("__tie").asc(), F.col("__stratum").asc_nulls_last()], prefix="__all")
    shard = F.expr(f"(__all_n - 1) * {n_shards} div {max(total, 1)}")
    p = p.withColumn("shard", shard.cast("int"))
    first = F.expr(f"(cast(shard as bigint) * {total} + {n_shards - 1}) div {n_shards}")
    return p.withColumn("slot", (F.col("__all_n") - 1 - first).cast("long")).select(*back, "shard", "slot")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order within each file."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)


@query("op8_stratified_shards")
def op8_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = common.table(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    s = interleave_shards(common.cut(narrow), tie="text_crc32")
    return s.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
