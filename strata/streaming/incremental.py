"""The partitioned document load (B5) driven by Structured Streaming.

JSON documents arriving in a folder are read with a fixed schema and loaded
in micro-batches: each batch is filtered, de-duplicated and upserted into the
date-partitioned table by ``load_partitioned`` inside ``foreachBatch``. The
file source records which files were taken in the checkpoint folder, and a
replayed batch upserts the same rows again, so a restart after a failure
neither loses nor duplicates rows. ``availableNow`` processes what is there
and stops, which suits scheduled runs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strata.operators.find import compile_filter
from strata.session import scratch_path
from strata.sinks.tables import load_partitioned
from strata.sources.databases import normalise_id


def stream_documents_partitioned(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    table: str,
    keys: Sequence[str],
    order_by: Sequence[str],
    date_col: str,
    fallback_date_col: str | None = None,
    tie_break: Sequence[str] = (),
    query: Mapping | None = None,
    checkpoint: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Load every document now in ``source_dir`` and stop (availableNow)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    docs = normalise_id(reader.json(source_dir))
    docs = docs.filter(compile_filter(query, skip_none=True, columns=docs.schema))

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        load_partitioned(
            batch.sparkSession, table, batch, keys, order_by, date_col, fallback_date_col, tie_break
        )

    q = (
        docs.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint or scratch_path(spark, "stream"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    # micro-batches run in a cloned session: drop this session's cached file
    # listing of the table, whose files the batches may have replaced
    if spark.catalog.tableExists(table):
        spark.catalog.refreshTable(table)
    return q
