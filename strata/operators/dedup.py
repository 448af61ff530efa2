"""Latest row per key (N1, F1) and key uniqueness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import quote

_RN = "__strata_rn"


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Keep the first row per key by ``order_by`` (then ``tie_break``), all
    descending with NULL last.

    Planned as ``row_number() = 1`` so Catalyst inserts a partial
    ``WindowGroupLimit`` before the shuffle: each map task forwards at most
    one row per key, which also bounds a hot key's shuffle volume. Without a
    ``tie_break`` ties are resolved arbitrarily, as in the original.
    """
    order = [F.col(quote(c)).desc_nulls_last() for c in (*order_by, *tie_break)]
    if not order:  # no ordering given: any one row per key
        order = [F.col(quote(k)) for k in keys]
    w = Window.partitionBy(*[F.col(quote(k)) for k in keys]).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def data_bytes(df: DataFrame) -> Column:
    """Aggregate that bounds the in-memory size of a frame: exact byte length
    of every string / binary value plus a fixed width per field and row."""
    from pyspark.sql import types as T

    fixed = 16 + 8 * len(df.columns)
    parts = [F.lit(fixed)]
    for f in df.schema.fields:
        c = F.col(quote(f.name))
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif not isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)))
        elif isinstance(f.dataType, T.DecimalType) and f.dataType.precision > 18:
            parts.append(F.lit(16))
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return F.sum(total.cast("long"))


def key_stats(df: DataFrame, keys: Sequence[str], with_bytes: bool = False) -> DataFrame:
    """One-row frame: ``rows``, ``distinct_keys`` (a NULL key counts as one
    value, like ``distinct()``), ``null_keys`` (rows with any key NULL) and
    ``is_unique``; with ``with_bytes`` also ``bytes``, a bound on the frame's
    in-memory size measured in the same pass. A single aggregate with
    map-side partial aggregation."""
    key = F.struct(*[F.col(quote(k)) for k in keys])
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(quote(k)).isNull()
    aggs = [
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(key).alias("distinct_keys"),
        F.count_if(any_null).alias("null_keys"),
    ]
    if with_bytes:
        aggs.append(F.coalesce(data_bytes(df), F.lit(0)).alias("bytes"))
    agg = df.agg(*aggs)
    return agg.withColumn("is_unique", F.col("rows") == F.col("distinct_keys"))


def is_unique_key(df: DataFrame, keys: Sequence[str]) -> bool:
    """K1: True when no two rows share a key (NULL counted as a value).
    Brings one row of counts to the driver."""
    row = key_stats(df, keys).select("is_unique").first()
    return bool(row[0]) if row is not None else True
