"""Reconciling contents: a plain comparison of bags, equal tables, types, names, hot keys."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from strata.operators.content import reconcile_contents


def plain(source, destination):
    sides = (defaultdict(Counter), defaultdict(Counter))
    for side, rows in zip(sides, (source, destination), strict=True):
        for k, *rest in rows:
            side[k][tuple(rest)] += 1
    out = {}
    for k in {*sides[0], *sides[1]}:
        a, b = sides[0][k], sides[1][k]
        if a != b:
            out[k] = ("missing" if not b else "extra" if not a else "changed", sum(a.values()), sum(b.values()))
    return out


def check(spark, source, destination, schema="k long, v string, x double", **options):
    s, d = (spark.createDataFrame(rows, schema).repartition(3) for rows in (source, destination))
    diff = reconcile_contents(s, d, "k", **options)
    got = {r.k: (r.difference, r.source_rows, r.destination_rows) for r in diff.differences.collect()}
    want = plain(source, destination)
    assert got == want
    one = diff.summary.first()
    kinds = Counter(x[0] for x in want.values())
    assert (one.missing, one.extra, one.changed) == (kinds["missing"], kinds["extra"], kinds["changed"])
    assert (one.source_rows, one.destination_rows) == (len(source), len(destination))
    return one


@pytest.mark.parametrize("buckets", [1, 16, 1024])
def test_matches_plain_comparison(spark, buckets):
    rng = random.Random(buckets)
    source = [(rng.choice([None, *range(200)]), rng.choice("ab"), rng.choice([0.0, 1.5])) for _ in range(400)]
    destination = [r for r in source if rng.random() > 0.03]
    destination += [(rng.randrange(300), "c", 2.0) for _ in range(10)] + rng.sample(source, 5)
    rng.shuffle(destination)
    assert check(spark, source, destination, buckets=buckets).status == "FAIL"


def test_equal_tables_and_disjoint_keys(spark):
    rows = [(i, "v", 0.5) for i in range(100)]
    one = check(spark, rows, rows[::-1])
    assert one.status == "PASS" and one.differing_buckets == 0
    # equal numbers of rows and keys, none in common: counts alone say PASS
    one = check(spark, rows, [(i + 1000, "v", 0.5) for i in range(100)])
    assert (one.status, one.missing, one.extra) == ("FAIL", 100, 100)
    assert check(spark, rows, []).status == "UNKNOWN" and check(spark, [], []).status == "UNKNOWN"


def test_swapped_values_and_repeats_are_seen(spark):
    # same bag of values over all keys, dealt to other keys; one row twice instead of another
    assert check(spark, [(1, "a", 0.0), (2, "b", 0.0)], [(1, "b", 0.0), (2, "a", 0.0)], buckets=1).changed == 2
    assert check(spark, [(1, "a", 0.0), (1, "b", 0.0)], [(1, "a", 0.0), (1, "a", 0.0)]).changed == 1
    assert check(spark, [(1, "a", 0.0)] * 3, [(1, "a", 0.0)] * 2).changed == 1
    assert check(spark, [(None, None, None)], [(None, None, float("nan"))]).changed == 1


def test_types_names_and_zeros(spark):
    s = spark.createDataFrame([(1, 5, -0.0), (2, 6, float("nan"))], "K int, n int, z double")
    d = spark.createDataFrame([("1", 5, 0.0, "extra column"), ("x", 6, float("nan"), "")], "k string, N long, z double, more string")
    diff = reconcile_contents(s, d, ["k"])
    assert {(r.K, r.difference) for r in diff.differences.collect()} == {("2", "missing"), ("x", "extra")}
    m = spark.sql("SELECT 1 AS k, map('b', 2, 'a', 1) AS m UNION ALL SELECT 2, map('a', 1)")
    w = spark.sql("SELECT 1 AS k, map('a', 1, 'b', 2) AS m UNION ALL SELECT 2, map('a', 2)")
    assert [(r.k, r.difference) for r in reconcile_contents(m, w, "k").differences.collect()] == [(2, "changed")]


def test_only_some_columns_and_two_keys(spark):
    s = spark.createDataFrame([(1, 1, "a", "x"), (1, 2, "b", "y")], "p int, q int, v string, w string")
    d = spark.createDataFrame([(1, 1, "a", "OTHER"), (1, 2, "B", "y")], "p int, q int, v string, w string")
    assert [(r.p, r.q) for r in reconcile_contents(s, d, ["p", "q"], columns=["v"]).differences.collect()] == [(1, 2)]
    assert reconcile_contents(s, d, ["p", "q"]).summary.first().changed == 2


def test_a_hot_key_and_what_is_read_again(spark, tmp_path):
    rows = spark.range(60000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    rows.write.parquet(str(tmp_path / "s"))
    rows.withColumn("v", F.when(F.col("v") == 31, F.lit(-1)).otherwise(F.col("v"))).write.parquet(str(tmp_path / "d"))
    s, d = (spark.read.parquet(str(tmp_path / x)) for x in "sd")
    diff = reconcile_contents(s, d, "k")
    assert [tuple(r) for r in diff.differences.collect()] == [(1, "changed", 20000, 20000)] and diff.summary.first().differing_buckets == 1
    same = reconcile_contents(s, s, "k")
    plan = same.summary._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" not in plan.lower() and same.summary.first().status == "PASS"  # nothing is read a second time
