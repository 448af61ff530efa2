"""Typing that keeps what it could not type.

``type_rows`` gives, in one pass, the typed row and an array of the cells that hold a value which typing had to make
NULL, each with its column and raw text. Rows without such cells go to the table; the others, raw cells and all, to a
quarantine, from where they can be mended cell by cell and loaded again. Nothing is dropped on the way, and every
failure can be traced to its cell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import DATE_FORMATS, _typed, lost_cell, quote
from strata.operators.schema import free_name, match_names

FAILURES, ROW_ID = "failures", "row_id"


def type_rows(
    df: DataFrame, schema: T.StructType, date_formats: Sequence[str] = DATE_FORMATS, failures: str = FAILURES, keep_raw: str | None = None
) -> DataFrame:
    """The schema's fields as ``functions.conform`` gives them, and ``failures``: array of (column, raw) for the cells that
    typing turned into NULL, in the order of the schema. With ``keep_raw`` a column of that name holds the raw cells of the
    schema's fields as one struct of texts."""
    df = match_names(df, schema.names)
    have = {f.name: f.dataType for f in df.schema.fields}
    if {failures.lower(), (keep_raw or failures).lower()} & {n.lower() for n in schema.names}:
        raise ValueError(f"the schema has a field {failures} or {keep_raw} of its own")
    typed, lost, raw = [], [], []
    for f in schema.fields:
        if f.name not in have:
            typed.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        src = F.col(quote(f.name))
        value = _typed(src, have[f.name], f.dataType, date_formats)
        typed.append(value.alias(f.name))
        raw.append(src.cast("string").alias(f.name))
        entry = F.struct(F.lit(f.name).alias("column"), src.cast("string").alias("raw"))
        lost.append(F.when(lost_cell(src, value), entry))
    kind = "array<struct<column:string,raw:string>>"
    found = F.filter(F.array(*lost), lambda e: e.isNotNull()) if lost else F.array()
    extra = [F.struct(*raw).alias(keep_raw)] if keep_raw and raw else []
    return df.select(*typed, found.cast(kind).alias(failures), *extra)


def good_rows(typed: DataFrame, failures: str = FAILURES) -> DataFrame:
    """Rows that typing lost nothing of."""
    return typed.filter(F.size(quote(failures)) == 0).drop(failures, "raw")


def quarantined(typed: DataFrame, failures: str = FAILURES) -> DataFrame:
    """(row_id, raw, failures) of the other rows. ``row_id`` is a digest of the raw cells: equal rows share it."""
    bad = typed.filter(F.size(quote(failures)) > 0)
    return bad.select(F.sha2(F.to_json("raw", {"ignoreNullFields": "false"}), 256).alias(ROW_ID), "raw", F.col(quote(failures)).alias(FAILURES))


def mended(quarantine: DataFrame, fixes: DataFrame) -> DataFrame:
    """(row_id, all raw cells) of the quarantined rows that ``fixes`` names, with its cells in place: (row_id, column, value), a NULL
    value empties the cell; of several fixes of a cell the greatest value counts."""
    fields = quarantine.schema["raw"].dataType.names
    entry = F.struct("column", F.struct(F.col("value").alias("v")).alias("to"))
    last = fixes.groupBy(ROW_ID, "column").agg(F.max("value").alias("value"))
    per_row = last.groupBy(F.col(ROW_ID).alias("of")).agg(F.map_from_entries(F.collect_list(entry)).alias("cells"))
    joined = quarantine.join(per_row, F.col(ROW_ID) == F.col("of"))
    name = free_name(ROW_ID, fields)
    cell = lambda c: F.when(F.map_contains_key("cells", F.lit(c)), F.col("cells")[c]["v"]).otherwise(F.col("raw")[c])
    return joined.select(F.col(ROW_ID).alias(name), *[cell(c).alias(c) for c in fields])
