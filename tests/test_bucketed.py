"""Keyed tables by hash bucket: pruning on both sides, model, hot keys, evolution, crash of a first load."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from strata.sinks import bucketed as B
from strata.sinks import tables as T
from strata.sinks.tables import table_location


def folders(spark, name):
    """Files of every bucket folder with their modification times."""
    home = Path(table_location(spark, name).removeprefix("file:"))
    return {d.name: sorted((f.name, f.stat().st_mtime_ns) for f in d.glob("*.parquet")) for d in home.iterdir() if d.is_dir()}


def state(spark, name):
    return {r.k: (r.v, r.t) for r in B.keyed_table(spark, name).collect()}


def test_only_touched_buckets_change(spark, db):
    name = f"{db}.items"
    base = spark.range(2000).select(F.col("id").alias("k"), F.lit("old").alias("v"), F.lit(0).alias("t"))
    assert B.load_bucketed(spark, name, base, "k", buckets=32).operation == "create"
    before = folders(spark, name)
    assert len(before) == 32
    batch = spark.createDataFrame([(5, "new", 1), (77, "new", 1), (5000, "new", 1)], "k long, v string, t int")
    res = B.load_bucketed(spark, name, batch, ["k"])
    assert (res.operation, res.updated, res.inserted) == ("merge", 2, 1)
    after = folders(spark, name)
    touched = {f"{B.BUCKET}={b}" for b in B.touched_buckets(batch.withColumn(B.BUCKET, B.bucket_of(batch, ["k"], 32)), B.BUCKET)}
    changed = {d for d in after if after[d] != before.get(d)}
    assert changed == touched and len(touched) <= 3
    got = state(spark, name)
    assert len(got) == 2001 and got[5] == got[5000] == ("new", 1) and got[6] == ("old", 0)
    # what a merge and a look-up read of the table: the buckets are partition filters
    plan = B.find_keys(spark, name, batch)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and f"{B.BUCKET}" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert sorted(r.k for r in B.find_keys(spark, name, batch).collect()) == [5, 77, 5000]


def test_batches_match_a_dictionary(spark, db):
    rng, name, want = random.Random(6), f"{db}.model", {}
    for step in range(5):
        keys = rng.sample(range(60), 25)
        rows = [(k, f"s{step}", step) for k in keys]
        B.load_bucketed(spark, name, spark.createDataFrame(rows, "k int, v string, t int").repartition(3), "k", buckets=7)
        want |= {k: (v, t) for k, v, t in rows}
        assert state(spark, name) == want
    B.rebucket(spark, name, 3)
    assert state(spark, name) == want and B.bucket_layout(spark, name) == (["k"], B.BUCKET, 3)
    B.load_bucketed(spark, name, spark.createDataFrame([(1, "z", 9), (999, "z", 9)], "k int, v string, t int"), "k")
    assert state(spark, name) == want | {1: ("z", 9), 999: ("z", 9)}


def test_order_of_arrival_does_not_matter(spark, db):
    rows = [[(k, f"{k}@{t}", t) for k in range(t % 3, 12, 2)] for t in range(1, 6)]
    results = []
    for seed in (1, 2):
        order, name = rows[:], f"{db}.ordered{seed}"
        random.Random(seed).shuffle(order)
        for batch in order:
            B.load_bucketed(spark, name, spark.createDataFrame(batch, "k long, v string, t int"), "k", buckets=4, newest_by=["t"])
        results.append(state(spark, name))
    assert results[0] == results[1] == {k: max((t, v) for b in rows for x, v, t in b if x == k)[::-1] for k in {x for b in rows for x, _, _ in b}}


def test_null_keys_spread_and_never_match(spark, db):
    name = f"{db}.nulls"
    rows = spark.range(400).select(F.lit(None).cast("long").alias("k"), F.col("id").cast("string").alias("v"), F.lit(0).alias("t"))
    B.load_bucketed(spark, name, rows, "k", buckets=16)
    assert len(folders(spark, name)) == 16
    res = B.load_bucketed(spark, name, spark.createDataFrame([(None, "x", 1)], "k long, v string, t int"), "k")
    assert (res.updated, res.inserted) == (0, 1) and B.keyed_table(spark, name).count() == 401


def test_repeated_keys_append_and_hot_target_keys_merge(spark, db):
    name = f"{db}.hot"
    rows = spark.range(600).select((F.col("id") % 3).alias("k"), F.lit("a").alias("v"), F.lit(0).alias("t"))
    B.load_bucketed(spark, name, rows, "k", buckets=4)
    assert B.load_bucketed(spark, name, rows, "k").operation == "append"
    res = B.load_bucketed(spark, name, spark.createDataFrame([(1, "b", 1)], "k long, v string, t int"), "k")
    assert res.updated == 400 and B.keyed_table(spark, name).filter("v = 'b'").count() == 400
    with pytest.raises(ValueError, match="several source rows"):
        B.merge_bucketed(spark, name, rows)


def test_evolution_clashes_and_key_types(spark, db):
    name = f"{db}.wide"
    first = spark.createDataFrame([(1, 10, "x", "o"), (2, 20, "y", "o")], f"K int, v int, {B.BUCKET} string, _op string")
    B.load_bucketed(spark, name, first, "k", buckets=5)
    assert B.bucket_layout(spark, name)[:2] == (["K"], f"_{B.BUCKET}")
    B.load_bucketed(spark, name, spark.createDataFrame([(2, 2.75, "n")], "k int, V double, extra string"), "K")
    got = {r.K: tuple(r) for r in B.keyed_table(spark, name).collect()}
    assert got == {1: (1, 10.0, "x", "o", None), 2: (2, 2.75, "y", "o", "n")}
    with pytest.raises(TypeError, match="rebucket"):
        B.load_bucketed(spark, name, spark.createDataFrame([(5_000_000_000, 1.0)], "k long, v double"), "k")
    from pyspark.sql.types import LongType

    B.rebucket(spark, name, 5, {"K": LongType()})
    B.load_bucketed(spark, name, spark.createDataFrame([(2, 3.5), (5_000_000_000, 1.0)], "k long, v double"), "k")
    assert {r.K: r.v for r in B.keyed_table(spark, name).collect()} == {1: 10.0, 2: 3.5, 5_000_000_000: 1.0}


def test_empty_batches_and_a_crashed_first_load(spark, db, monkeypatch):
    name = f"{db}.crash"
    rows = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k long, v string, t int")
    monkeypatch.setattr(B, "write_balanced", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(RuntimeError):
        B.load_bucketed(spark, name, rows, "k", buckets=4)
    monkeypatch.undo()
    assert B.load_bucketed(spark, name, rows, "k", buckets=4).inserted == 2
    assert B.load_bucketed(spark, name, rows.limit(0), "k").rows == 0 and state(spark, name) == {1: ("a", 0), 2: ("b", 0)}
    with pytest.raises(ValueError, match="lacks the key"):
        B.merge_bucketed(spark, name, rows.drop("k"))
    with pytest.raises(ValueError, match="bucketed by"):
        B.load_bucketed(spark, name, rows, "v")


def test_failed_write_leaves_the_table(spark, db):
    name = f"{db}.fails"
    B.load_bucketed(spark, name, spark.range(50).select(F.col("id").alias("k"), F.lit("a").alias("v"), F.lit(0).alias("t")), "k", buckets=4)
    before = state(spark, name)
    bad = spark.range(50).select(F.col("id").alias("k"), F.when(F.col("id") < 40, "b").otherwise(F.raise_error(F.lit("boom"))).alias("v"), F.lit(1).alias("t"))
    with pytest.raises(Exception, match="boom"):
        B.load_bucketed(spark, name, bad, "k")
    assert state(spark, name) == before and T.table_exists(spark, name)
