"""Keyed merge of two frames (J1, J2) and schema alignment.

``merge_frames`` is pure: it returns the new state of the target plus a column
with what happened to each row, and the sinks decide how to store it. Parquet tables have no
row-level update, so the state is computed with joins on the keys (see the
function for the plan and its skew handling).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import quote
from strata.operators.schema import free_name, lossless, match_names, merged_type, spelt_like

OP = "_op"


def op_name(target: DataFrame, source: DataFrame) -> str:
    """The column that ``merge_frames`` adds: ``_op``, or a name that neither frame has."""
    return free_name(OP, target.columns, source.columns)


def align_to(df: DataFrame, schema: T.StructType, keep_extra: bool = True) -> DataFrame:
    """``df`` with the types of ``schema`` (by name, as the session resolves names), its missing
    fields as NULL and columns in the order of ``schema``; extra columns of
    ``df`` follow at the end unless ``keep_extra`` is False. TypeError where a type cannot
    take the column's values without loss."""
    df = match_names(df, schema.names)
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        if f.name not in have:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif lossless(have[f.name], f.dataType):
            cols.append(F.col(quote(f.name)).cast(f.dataType).alias(f.name))
        else:
            raise TypeError(f"column {f.name}: {have[f.name].simpleString()} does not fit {f.dataType.simpleString()} without loss; type it first")
    if keep_extra:
        names = set(schema.names)
        cols += [F.col(quote(c)) for c in df.columns if c not in names]
    return df.select(*cols)


def merge_frames(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """New state of ``target`` after upserting ``source`` on ``keys``.

    * matched: the source row replaces the target row; columns the source
      lacks keep the target value (schema auto-merge). With ``order_by`` only if it is not older: where the target's
      row is greater by these columns (NULL lowest) it stays, so batches may arrive in any order;
    * source only: inserted; target-only columns are NULL;
    * target only: kept; source-only columns are NULL.

    With plain equality (default) a NULL key never matches, so such source
    rows are always inserted and such target rows always kept. ``null_safe``
    uses ``<=>``. The source must hold at most one row per non-NULL key (the
    sinks check or guarantee it). Columns are matched as the session resolves names; where types differ the result has the
    narrowest type that holds both without loss (TypeError if there is none). ``_op`` (see ``op_name``) is ``updated``,
    ``inserted`` or ``kept``. Output columns: target columns in order, then new source ones.

    Planned as two joins instead of one full outer join; their strategy is left to Spark:

    * ``target LEFT JOIN source`` gives the kept and updated rows. A left
      join lets AQE split a skewed target partition (a key repeated by
      earlier appends), which it cannot do for a full outer join;
    * ``source LEFT ANTI JOIN distinct(target keys)`` gives the inserts; the
      distinct is pre-aggregated map-side, so a hot key is one row per task.

    Compared with one full outer join this shuffles the target's key columns
    a second time (keys only, usually a small fraction of the row width),
    which is the price of being able to split a hot key.
    """
    source = match_names(source, target.columns)
    keys, order_by = spelt_like(target, keys), spelt_like(target, order_by)
    tcols, scols = target.columns, source.columns
    stypes = {f.name: f.dataType for f in source.schema.fields}
    types = {f.name: merged_type(f.name, f.dataType, stypes[f.name]) if f.name in stypes else f.dataType for f in target.schema.fields}
    target = target.select(*[F.col(quote(c)).cast(types[c]).alias(c) for c in tcols])
    source = source.select(*[F.col(quote(c)).cast(types[c]).alias(c) if c in types else F.col(quote(c)) for c in scols])
    op, mark = op_name(target, source), free_name("__strata_src", tcols, scols)

    def on(left: str, right: str) -> Column:
        cond = None
        for k in keys:
            a, b = F.col(f"{left}." + quote(k)), F.col(f"{right}." + quote(k))
            eq = a.eqNullSafe(b) if null_safe else a == b
            cond = eq if cond is None else cond & eq
        return cond

    def tc(c: str) -> Column:
        return F.col("t." + quote(c))

    def sc(c: str) -> Column:
        return F.col("s." + quote(c))

    s = source.withColumn(mark, F.lit(True)).alias("s")
    taken = F.col("s." + mark).isNotNull()
    if order_by:
        taken = taken & ~(F.struct(*[tc(c) for c in order_by]) > F.struct(*[sc(c) for c in order_by]))
    kept_or_updated = target.alias("t").join(s, on("t", "s"), "left").select(
        *[(F.when(taken, sc(c)).otherwise(tc(c)) if c in scols else tc(c)).alias(c) for c in tcols],
        *[F.when(taken, sc(c)).alias(c) for c in scols if c not in tcols],
        F.when(taken, F.lit("updated")).otherwise(F.lit("kept")).alias(op),
    )
    matched = target.select(*[F.col(quote(k)).alias(k) for k in keys]).distinct()
    inserted = (
        source.alias("s2")
        .join(matched.alias("mk"), on("s2", "mk"), "left_anti")
        .select(
            *[(F.col("s2." + quote(c)) if c in scols else F.lit(None).cast(types[c])).alias(c) for c in tcols],
            *[F.col("s2." + quote(c)).alias(c) for c in scols if c not in tcols],
            F.lit("inserted").alias(op),
        )
    )
    return kept_or_updated.unionByName(inserted)


def op_counts(op: str = OP) -> list[Column]:
    """Aggregates over the column of ``op_name`` for ``DataFrame.observe``."""
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(op) == "updated").alias("updated"),
        F.count_if(F.col(op) == "inserted").alias("inserted"),
    ]
