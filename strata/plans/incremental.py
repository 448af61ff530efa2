"""Layer jobs that take only what is new (B1-B3, B6): bronze by load, silver and gold by what has changed.

The jobs of ``plans.jobs`` read all of bronze and silver in every run. These read the loads, and the partitions,
that they have not taken yet, and may be repeated after a crash at any step (see ``sinks.ledger``).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from strata.functions import columns as C
from strata.operators.state import account_spec
from strata.plans import fixtures as fx
from strata.plans.jobs import SILVER_ORDER, job_time, keyed_bronze, prepared_transactions
from strata.session import staged_rows
from strata.sinks import ledger
from strata.sinks.bucketed import BUCKETS
from strata.sinks.maintained import refresh_aggregate, replace_partitions
from strata.sinks.tables import LoadResult, ensure_database, evolve_schema, load_partitioned, observe, observed

SILVER, GOLD = "silver", "gold"  # names of the consumers in the ledger


def bronze_load(
    spark: SparkSession, raw_text: DataFrame, table: str, load_id: str, now: _dt.datetime | str | None = None, tz: str = "Asia/Jakarta"
) -> LoadResult:
    """B1: clean a source frame, stamp the load time and land it as load ``load_id`` of bronze. Landing the same load again
    replaces it; the result carries the cells per column that typing had to drop."""
    prepared = prepared_transactions(raw_text)
    typed, counts = C.conform_counted(prepared, fx.TRANSACTION_SCHEMA)
    counted, seen = observe(typed, *[c.alias(n) for n, c in counts.items()])
    batch = C.stamp_ingestion(counted.select(*fx.TRANSACTION_SCHEMA.names), "IngestionTime", tz, job_time(now))
    result = ledger.land(spark, table, batch, load_id)
    return replace(result, failures={n: int(v) for n, v in (observed(seen) or {}).items() if v})


def silver_increment(spark: SparkSession, bronze: str, silver: str, rejects: str | None = None, consumer: str = SILVER) -> LoadResult:
    """B2 over the loads of bronze that were not taken yet: keyed, the latest per key, upserted by key and date unless silver
    holds a later row, so loads may come in any order. Undated rows go to ``rejects``, a partition per load, each
    replaced when its load is taken again."""
    loads = ledger.unseen(spark, consumer, bronze)
    if not loads:
        return LoadResult(silver, "merge", 0, 0, 0)
    with staged_rows(keyed_bronze(ledger.rows_of(spark, bronze, loads))) as rows:
        if rejects:
            _replace_rejects(spark, rejects, rows.filter("Id IS NULL"), loads)
        good = rows.filter("Id IS NOT NULL").drop(ledger.LOAD_ID)
        result = load_partitioned(
            spark, silver, good, keys=["Id"], order_by=SILVER_ORDER, date_col="Date", fallback_date_col="ValueDate",
            tie_break=["TxnNo"] if "TxnNo" in good.columns else [], newest_wins=True,
        )
        ledger.record_changes(spark, silver, good.select(C.partition_date("Date", "ValueDate").alias("Date_Partition")))
    ledger.mark_taken(spark, consumer, bronze, loads)
    return result


def _replace_rejects(spark: SparkSession, name: str, rows: DataFrame, loads: list[ledger.Load]) -> None:
    ledger.ensure_raw_table(spark, name, rows.drop(ledger.LOAD_ID).schema)
    rows = evolve_schema(spark, name, rows)
    parts = spark.createDataFrame([(x.load_id,) for x in loads], f"{ledger.LOAD_ID} string")
    replace_partitions(spark, name, rows, parts, ledger.LOAD_ID)


def gold_increment(spark: SparkSession, silver: str, gold: str, consumer: str = GOLD, buckets: int = BUCKETS) -> LoadResult:
    """The accounts of silver's changed partitions, from the state of those partitions computed anew and the stored state
    of the others."""
    tie = ["TxnNo"] if "TxnNo" in spark.table(silver).columns else []
    return refresh_aggregate(spark, silver, f"{gold}_state", gold, account_spec(tie), consumer, buckets)


def run_increment(
    spark: SparkSession, raw_text: DataFrame, database: str, load_id: str, now: _dt.datetime | str | None = None, buckets: int = BUCKETS
) -> dict[str, LoadResult]:
    """Land one load and bring silver and gold up to date with everything landed so far."""
    ensure_database(spark, database)
    bronze, silver, gold = (f"{database}.{t}" for t in ("transactions_raw", "transactions_clean", "transactions_datamart"))
    return {
        "bronze": bronze_load(spark, raw_text, bronze, load_id, now),
        "silver": silver_increment(spark, bronze, silver, f"{database}.transactions_rejects"),
        "gold": gold_increment(spark, silver, gold, buckets=buckets),
    }
