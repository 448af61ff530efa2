"""Compaction by file size and loads with a quarantine."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import columns as C
from strata.operators import quarantine as Q
from strata.sinks import compaction as K
from strata.sinks import quarantine as S
from strata.sinks.tables import append_table, create_table, load_table, table_location


def folders(spark, name):
    home = Path(table_location(spark, name).removeprefix("file:"))
    return {d.name: sorted((f.name, f.stat().st_mtime_ns) for f in d.glob("*.parquet")) for d in home.iterdir() if d.is_dir()}


def test_two_of_fifty_partitions_are_rewritten(spark, db):
    name = f"{db}.daily"
    rows = spark.range(5000).select("id", (F.col("id") % 50).cast("int").alias("p"), F.sha2(F.col("id").cast("string"), 512).alias("text"))
    create_table(spark, name, rows, partition_by=["p"])
    for i in range(3):
        append_table(spark, name, rows.filter(F.col("p").isin(7, 31)).withColumn("id", F.col("id") + 10_000 * (i + 1)))
    before, content = folders(spark, name), sorted(map(tuple, spark.table(name).collect()))
    assert {r.p: r.files for r in K.small_partitions(spark, name).collect()} == {7: 4, 31: 4}
    done = K.compact_small(spark, name)
    after = folders(spark, name)
    assert (done.partitions, done.files, done.rows) == (2, 8, 800)
    assert {d for d in after if after[d] != before[d]} == {"p=7", "p=31"} and len(after["p=7"]) == len(after["p=31"]) == 1
    assert sorted(map(tuple, spark.table(name).collect())) == content
    assert K.compact_small(spark, name) == K.Compaction(0, 0, 0) and folders(spark, name) == after
    # files at or above the size do not count as small
    sizes = {r.p: r.bytes for r in K.file_sizes(spark, name).filter("p = 7").collect()}
    assert K.small_partitions(spark, name, target_bytes=sizes[7]).count() == 0


def test_null_partition_unpartitioned_and_empty(spark, db):
    name = f"{db}.nulls"
    rows = spark.createDataFrame([(1, None, "rows"), (2, dt.date(2024, 1, 1), "x")], "k int, d date, rows string")
    create_table(spark, name, rows, partition_by=["d"])
    append_table(spark, name, rows.filter("d IS NULL"))
    assert K.compact_small(spark, name) == K.Compaction(1, 2, 2)
    assert sorted((r.k, str(r.d)) for r in spark.table(name).collect()) == [(1, "None"), (1, "None"), (2, "2024-01-01")]
    flat = f"{db}.flat"
    for _ in range(4):
        append_table(spark, flat, rows.coalesce(1)) if spark.catalog.tableExists(flat) else load_table(spark, flat, rows.coalesce(1))
    done = K.compact_small(spark, flat)
    assert done.rows == 8 and done.files == 4 and len(spark.table(flat).inputFiles()) == 1
    create_table(spark, f"{db}.none", rows.limit(0))
    assert K.compact_small(spark, f"{db}.none") == K.Compaction(0, 0, 0)


SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("day", T.DateType()), T.StructField("amount", T.DecimalType(10, 2)), T.StructField("note", T.StringType())])
RAW = [("1", "2024-01-05", "1.50", "ok"), ("x1", "2024-01-05", "1e99", "bad id and amount"), ("3", "tomorrow", None, "bad day"), ("4", "", "nan", "missing cells"), ("3", "tomorrow", None, "bad day")]


def raw(spark, rows=RAW):
    return spark.createDataFrame([(*r, "extra") for r in rows], "id string, Day string, amount string, note string, other string")


def test_failures_trace_back_to_cells(spark):
    typed = Q.type_rows(raw(spark), SCHEMA, keep_raw="raw")
    got = {(r.note, tuple((f.column, f.raw) for f in r.failures)) for r in typed.collect()}
    assert got == {("ok", ()), ("missing cells", ()), ("bad id and amount", (("id", "x1"), ("amount", "1e99"))), ("bad day", (("day", "tomorrow"),))}
    plain = C.conform(raw(spark).withColumnRenamed("Day", "day"), SCHEMA)
    assert sorted(map(str, typed.select(SCHEMA.names).collect())) == sorted(map(str, plain.collect()))
    counts = {n: c for n, c in C.cast_failures(raw(spark).withColumnRenamed("Day", "day"), SCHEMA).items()}
    totals = raw(spark).withColumnRenamed("Day", "day").agg(*[c.alias(n) for n, c in counts.items()]).first().asDict()
    listed = typed.select(F.explode("failures").alias("f")).groupBy("f.column").count().collect()
    assert {r["column"]: r["count"] for r in listed} == {n: v for n, v in totals.items() if v}
    assert {r.raw.note for r in Q.quarantined(typed).collect()} == {"bad id and amount", "bad day"}
    with pytest.raises(ValueError, match="of its own"):
        Q.type_rows(raw(spark), T.StructType([*SCHEMA.fields, T.StructField("Failures", T.StringType())]))


def test_quarantine_and_mended_rows(spark, db):
    name = f"{db}.typed"
    for _ in range(2):  # a repeated load replaces its rows
        res = S.load_typed(spark, name, raw(spark), SCHEMA, "monday")
        assert (res.table.rows, res.quarantine.rows) == (2, 3)
    left = S.open_rows(spark, name).collect()
    ids = {r.raw.note: r.row_id for r in left}
    assert len(left) == 3 and spark.table(name).count() == 2
    fixes = spark.createDataFrame([(ids["bad day"], "day", "2024-02-01"), (ids["bad id and amount"], "id", "2")], "row_id string, column string, value string")
    for _ in range(2):
        res = S.load_mended(spark, name, fixes, SCHEMA, "monday-fixed")
        assert (res.table.rows, res.quarantine.rows) == (2, 1)  # the equal bad days share a fix; the amount is still bad
    assert sorted((r.id, str(r.day)) for r in spark.table(name).collect()) == [(1, "2024-01-05"), (3, "2024-02-01"), (3, "2024-02-01"), (4, "None")]
    rest = S.open_rows(spark, name, fixes).collect()
    assert [(r.raw.id, [f.column for f in r.failures]) for r in rest] == [("2", ["amount"])]
    empty = fixes.unionByName(spark.createDataFrame([(rest[0].row_id, "amount", None)], fixes.schema))
    S.load_mended(spark, name, empty.filter(F.col("row_id") == rest[0].row_id), SCHEMA, "emptied")
    assert spark.table(name).filter("id = 2 AND amount IS NULL").count() == 1 and S.open_rows(spark, name, empty).count() == 0
    assert S.load_typed(spark, f"{db}.none", raw(spark).limit(0), SCHEMA, "x") == (S.LoadResult(f"{db}.none", "land", 0, 0, 0), S.LoadResult(f"{db}.none_quarantine", "land", 0, 0, 0))
