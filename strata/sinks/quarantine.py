"""Loads with a quarantine (P5, S2): typed rows to the table, rows with cells that did not type to a side table, and mended rows
from there back to the table. Both tables are kept by load, so a load that is tried again replaces its rows."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import DATE_FORMATS
from strata.operators.quarantine import ROW_ID, good_rows, mended, quarantined, type_rows
from strata.session import staged_rows
from strata.sinks import ledger
from strata.sinks.tables import LoadResult


class TypedLoad(NamedTuple):
    table: LoadResult
    quarantine: LoadResult


def quarantine_of(name: str) -> str:
    return f"{name}_quarantine"


def load_typed(
    spark: SparkSession, name: str, df: DataFrame, schema: T.StructType, load_id: str, date_formats: Sequence[str] = DATE_FORMATS
) -> TypedLoad:
    """Type a frame of raw cells and land it as load ``load_id`` of a table; rows that lose a cell go to the table's
    quarantine under the same load. The frame is typed once."""
    with staged_rows(type_rows(df, schema, date_formats, keep_raw="raw")) as typed:
        good = ledger.land(spark, name, good_rows(typed), load_id)
        return TypedLoad(good, ledger.land(spark, quarantine_of(name), quarantined(typed), load_id))


def load_mended(
    spark: SparkSession, name: str, fixes: DataFrame, schema: T.StructType, load_id: str, date_formats: Sequence[str] = DATE_FORMATS
) -> TypedLoad:
    """Put fixes (row_id, column, value) into the quarantined rows and load those rows again as load ``load_id``; rows that still
    lose a cell are quarantined under it, with the mended cells. Loading the same fixes again under the same id changes
    nothing; what was mended stays in the quarantine's older loads, ``open_rows`` lists what is left."""
    side = spark.table(quarantine_of(name)).filter(F.col(ledger.LOAD_ID) != load_id)
    with staged_rows(type_rows(mended(side, fixes).drop(ROW_ID), schema, date_formats, keep_raw="raw")) as typed:
        good = ledger.land(spark, name, good_rows(typed), load_id)
        return TypedLoad(good, ledger.land(spark, quarantine_of(name), quarantined(typed), load_id))


def open_rows(spark: SparkSession, name: str, fixes: DataFrame | None = None) -> DataFrame:
    """Quarantined rows, without those that the given fixes (all that were loaded) name."""
    side = spark.table(quarantine_of(name))
    return side if fixes is None else side.join(fixes.select(ROW_ID).distinct(), ROW_ID, "left_anti")
