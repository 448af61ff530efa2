"""Clustered layout: results as of a plain filter, and the share of the files that is read."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators.find import find
from strata.sinks import layout as L
from strata.sinks.tables import append_table


@pytest.fixture()
def table(spark, db):
    name = f"{db}.points"
    rows = spark.range(20_000).select(
        F.col("id"), (F.col("id") * 7919 % 20_000).alias("x"), F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") * 104729 % 365).cast("int")).alias("d"),
        F.concat(F.lit("user"), (F.col("id") * 31 % 997).cast("string")).alias("u"), F.when(F.col("id") % 11 > 0, F.sqrt("id")).alias("v"))
    assert L.write_clustered(spark, name, rows, ["x", "D"], ["id"], files=64).rows == 20_000
    return name


QUERIES = [
    ({"x": {"$gte": 5000, "$lt": 7000}, "d": {"$gte": dt.date(2024, 3, 1), "$lte": dt.date(2024, 4, 15)}}, 0.12),
    ({"x": {"$in": [17, 18_000]}}, 0.45),
    ({"$and": [{"x": {"$gt": 19_000}}, {"d": dt.date(2024, 12, 1)}]}, 0.1),
    ({"id": 12_345}, 1.0),
    ({"x": "5000"}, 0.0),
    ({"x": {"$lt": -1}}, 0.0),
    ({"u": "user5", "x": {"$lt": 2500}}, 0.35),
    ({"$or": [{"x": 1}, {"x": 2}]}, 1.0),
    ({"x": {"$ne": 5}, "d": {"$lt": dt.date(2024, 1, 10)}}, 0.3),
    ({"v": None, "x": {"$lte": 100}}, 0.3),
    ({}, 1.0),
]


@pytest.mark.parametrize("n", range(len(QUERIES)))
def test_same_rows_from_fewer_files(spark, table, n):
    query, share = QUERIES[n]
    want = sorted(map(str, find(spark.table(table), query, id_field="id").collect()))
    got = L.find_clustered(spark, table, query, id_field="id")
    assert sorted(map(str, got.collect())) == want
    files = spark.table(table).inputFiles()
    assert len(files) == 64 and len(L.matching_files(spark, table, query)) <= share * 64
    read = {L._path(r[0]) for r in got.select("_metadata.file_path").distinct().collect()} if L.matching_files(spark, table, query) else set()
    assert read <= set(L.matching_files(spark, table, query))


def test_appended_files_are_read_and_a_new_layout_indexes_them(spark, table):
    append_table(spark, table, spark.createDataFrame([(-1, 6000, dt.date(2024, 3, 5), "late", 1.0)], spark.table(table).schema).coalesce(1))
    query = {"x": {"$gte": 5999, "$lte": 6000}, "u": "late"}
    assert [r.id for r in L.find_clustered(spark, table, query).collect()] == [-1]
    assert L.find_clustered(spark, table, query, {"x": 1, "id": 0}, id_field="id").columns == ["x"]
    rows = spark.table(table)
    L.write_clustered(spark, table, rows, ["x", "d"], ["id"], files=16)
    assert spark.table(table).count() == 20_001 and len(spark.table(table).inputFiles()) == 16
    assert [r.id for r in L.find_clustered(spark, table, query).collect()] == [-1] and len(L.matching_files(spark, table, query)) < 16


def test_bloom_filter_skips_row_groups_of_an_id(spark, db):
    name = f"{db}.ids"
    rows = spark.range(0, 40_000, 2).select(F.col("id"), (F.col("id") * 7919 % 40_000).alias("x"))
    L.write_clustered(spark, name, rows, ["x"], ["id"], files=8)
    df = L.find_clustered(spark, name, {"id": 12_345})  # odd: in every file's range, in none of them
    assert len(L.matching_files(spark, name, {"id": 12_345})) == 8 and df.collect() == []
    plan = df._jdf.queryExecution().executedPlan()
    assert "EqualTo(id,12345)" in plan.toString()
    leaf = plan.collectLeaves().head()
    assert leaf.metrics().apply("numOutputRows").value() == 0  # every row group was left out unread


def test_types_empty_and_partitioned(spark, db):
    name = f"{db}.types"
    rows = spark.createDataFrame([(dt.datetime(2024, 1, i + 1), chr(97 + i), i % 2 == 0, float("nan") if i == 3 else float(i)) for i in range(8)] + [(None, None, None, None)],
                                 "t timestamp_ntz, s string, b boolean, n double")
    for by in (["t", "s"], ["b", "n", "t"]):
        L.write_clustered(spark, name, rows, by, files=4)
        assert spark.table(name).count() == 9
        assert {r.s for r in L.find_clustered(spark, name, {"t": {"$lt": dt.datetime(2024, 1, 3)}, "s": {"$gte": "b"}}).collect()} == {"b"}
    L.write_clustered(spark, f"{db}.none", rows.limit(0), ["t", "s"], files=4)
    assert L.find_clustered(spark, f"{db}.none", {"s": "a"}).count() == 0
    with pytest.raises(TypeError, match="laid out"):
        L.write_clustered(spark, f"{db}.bad", spark.createDataFrame([([1],)], "a array<int>"), ["a"])
