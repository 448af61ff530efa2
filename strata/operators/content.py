"""Reconciling the contents of two frames (Q1, Q5-Q7): which keys are missing, extra or changed.

Counts that agree say little: two tables of other keys have equal counts. Here both sides are cut into buckets by a hash of
the key, and every bucket gets checksums that do not depend on the order of rows (their number, and the sum and the
exclusive or of row hashes). Buckets that agree are done. Only the rows of those that differ are read again, reduced to
a checksum per key and side, and compared: equal tables are read once and never joined, and a few differing
rows cost the buckets they lie in.

A key may hold any number of rows on either side: they are compared as a bag. NULL keys are keys like others.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import quote
from strata.operators.schema import common_type, match_names, spelt_like

BUCKETS = 1024


@dataclass(frozen=True)
class ContentDiff:
    """``summary``: one row (status, buckets, differing_buckets, missing, extra, changed, source_rows, destination_rows).
    ``differences``: the key columns, ``difference`` (missing: only in the source; extra: only in the destination; changed),
    ``source_rows`` and ``destination_rows`` of each key that differs."""

    summary: DataFrame
    differences: DataFrame


def canonical(c: Column, kind: T.DataType) -> Column:
    """The form in which values of a type are hashed: one zero, one NaN, maps by sorted entries."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(c == 0, F.lit(0.0).cast(kind)).when(F.isnan(c), F.lit(float("nan")).cast(kind)).otherwise(c)
    if isinstance(kind, T.MapType):
        return F.array_sort(F.map_entries(c))
    if isinstance(kind, T.VariantType):
        return c.cast("string")
    return c


def comparable(source: DataFrame, destination: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both frames reduced to ``columns`` with the same types: the type that holds both without loss, else text."""
    left = {f.name: f.dataType for f in source.schema.fields}
    right = {f.name: f.dataType for f in destination.schema.fields}
    sides = ([], [])
    for c in columns:
        kind = common_type(left[c], right[c])
        for out, types in zip(sides, (left, right), strict=True):
            value = F.col(quote(c))
            if kind is None:
                value = value.cast("string")
            elif types[c] != kind:
                value = value.cast(kind)
            out.append(canonical(value, kind or T.StringType()).alias(c))
    return source.select(*sides[0]), destination.select(*sides[1])


def _hashes(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """(key columns, h: hash of the row, b: bucket of the key)."""
    rest = [F.col(quote(c)) for c in df.columns]
    bucket = F.pmod(F.xxhash64(*[F.col(quote(k)) for k in keys]), F.lit(buckets)).cast("int")
    return df.select(*[F.col(quote(k)).alias(f"k{i}") for i, k in enumerate(keys)], F.xxhash64(*rest, F.lit(7)).alias("h"), bucket.alias("b"))


def _sums(side: Column) -> list[Column]:
    """Checksums of a side's rows: order-free, and no carry is lost."""
    h = F.when(side, F.col("h"))
    return [F.count(h).alias("n"), F.sum(h.cast("decimal(20,0)")).alias("total"), F.bit_xor(h).alias("mixed")]


def _both(grouped) -> DataFrame:
    src, dst = F.col("src"), ~F.col("src")
    named = [c.alias(f"{p}_{n}") for p, side in (("s", src), ("d", dst)) for c, n in zip(_sums(side), ("n", "total", "mixed"), strict=True)]
    return grouped.agg(*named)


def _differs() -> Column:
    same = F.lit(True)
    for n in ("n", "total", "mixed"):
        same = same & F.col(f"s_{n}").eqNullSafe(F.col(f"d_{n}"))
    return ~same


def reconcile_contents(
    source: DataFrame,
    destination: DataFrame,
    keys: Sequence[str] | str,
    columns: Sequence[str] | None = None,
    buckets: int = BUCKETS,
) -> ContentDiff:
    """Compare the rows of two frames by key. ``columns`` (default: those both have) are compared; names are matched as the
    session resolves them; columns of different types are compared in the type that holds both, else as text.
    One job computes the bucket checksums; ``differences`` reads the rows of the differing buckets, of which at
    most ``buckets`` numbers come to the driver."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    destination = match_names(destination, source.columns)
    keys = spelt_like(source, keys)
    shared = [c for c in (spelt_like(source, columns) if columns else source.columns) if c in destination.columns and c not in keys]
    left, right = comparable(source, destination, [*keys, *shared])
    rows = _hashes(left, keys, buckets).withColumn("src", F.lit(True)).unionByName(_hashes(right, keys, buckets).withColumn("src", F.lit(False)))
    per_bucket = _both(rows.groupBy("b")).collect()  # one row per bucket
    apart = sorted(r["b"] for r in per_bucket if any(r[f"s_{n}"] != r[f"d_{n}"] for n in ("n", "total", "mixed")))
    ks = [f"k{i}" for i in range(len(keys))]
    drilled = _both(rows.filter(F.col("b").isin(apart)).groupBy(*ks)).filter(_differs())
    kind = F.when(F.col("d_n") == 0, "missing").when(F.col("s_n") == 0, "extra").otherwise("changed")
    differences = drilled.select(
        *[F.col(k).alias(name) for k, name in zip(ks, keys, strict=True)],
        kind.alias("difference"), F.col("s_n").alias("source_rows"), F.col("d_n").alias("destination_rows"),
    )
    total = {side: sum(r[f"{side}_n"] for r in per_bucket) for side in "sd"}
    kinds = [F.count_if(F.col("difference") == k).alias(k) for k in ("missing", "extra", "changed")]
    found = differences.agg(*kinds)
    # No row on a side says nothing about the load, as in ``reconcile``.
    status = F.lit("UNKNOWN" if 0 in total.values() else "FAIL" if apart else "PASS")
    summary = found.select(
        status.alias("status"), F.lit(buckets).alias("buckets"), F.lit(len(apart)).alias("differing_buckets"),
        "missing", "extra", "changed",
        F.lit(total["s"]).cast("long").alias("source_rows"), F.lit(total["d"]).cast("long").alias("destination_rows"),
    )
    return ContentDiff(summary, differences)
