"""Empty inputs and all-NULL columns through the main operators."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators.merge import OP, merge_frames
from strata.operators.profile import profile
from strata.operators.quality import reconcile
from strata.sinks.tables import load_partitioned, load_table


def test_profile_of_empty_and_all_null_columns(spark):
    empty = spark.createDataFrame([], "x double, t string, d date, b boolean")
    p = {(r.column_name, r.metric): r.value for r in profile(empty).collect()}
    assert p[("x", "n")] == 0 and p[("t", "n")] == 0
    assert ("x", "p50") not in p or p[("x", "p50")] is None
    nulls = spark.createDataFrame([(None, None), (None, None)], "x double, t string")
    q = {(r.column_name, r.metric): r.value for r in profile(nulls).collect()}
    assert q[("x", "missing")] == 2 and q[("x", "n_distinct")] in (0, None)
    assert q[("t", "missing")] == 2


def test_reconcile_of_two_empty_frames(spark):
    e = spark.createDataFrame([], "k string")
    r = reconcile(e, e, "k").first()
    assert (r.Status_Observation, r.Source_Observation, r.Status_Rows) == ("UNKNOWN", 0, "UNKNOWN")


def test_merge_with_empty_sides(spark):
    t = spark.createDataFrame([(1, "a")], "k long, v string")
    e = spark.createDataFrame([], "k long, v string")
    assert [(r.k, r[OP]) for r in merge_frames(t, e, ["k"]).collect()] == [(1, "kept")]
    assert [(r.k, r[OP]) for r in merge_frames(e, t, ["k"]).collect()] == [(1, "inserted")]
    assert merge_frames(e, e, ["k"]).count() == 0


def test_empty_batches_leave_tables_unchanged(spark, db):
    name = f"{db}.e"
    rows = [(1, dt.datetime(2024, 1, 1, 1), 1.0), (2, dt.datetime(2024, 1, 2, 1), 2.0)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, v double")
    load_partitioned(spark, name, df, keys=["id"], order_by=["ts"], date_col="ts")
    res = load_partitioned(spark, name, df.filter(F.lit(False)), keys=["id"], order_by=["ts"], date_col="ts")
    assert (res.updated, res.inserted) == (0, 0)
    assert sorted(r.id for r in spark.table(name).collect()) == [1, 2]
    keyed = f"{db}.k"
    load_table(spark, keyed, df, keys="id")
    res = load_table(spark, keyed, df.filter(F.lit(False)), keys="id")
    assert (res.operation, res.updated, res.inserted) == ("merge", 0, 0)
    assert spark.table(keyed).count() == 2


def test_create_from_an_empty_filtered_frame(spark, db):
    from strata.sinks.tables import compact_partitions, create_table

    df = spark.range(10).filter(F.lit(False))
    res = create_table(spark, f"{db}.empty", df)
    assert (res.operation, res.rows) == ("create", 0)
    assert compact_partitions(spark, f"{db}.empty") == 0


def test_latest_per_key_without_ordering(spark):
    from strata.operators.dedup import latest_per_key

    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    out = latest_per_key(df, ["k"], [])
    assert sorted(r.k for r in out.collect()) == [1, 2]


def test_rejects_of_a_second_load_with_the_same_time(spark, db):
    from strata.plans import fixtures as fx
    from strata.plans.jobs import silver_transactions

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fx.TRANSACTION_SCHEMA) + ", IngestionTime timestamp_ntz"
    now = dt.datetime(2024, 1, 1, 8)
    row = lambda account, day=None: (account, day, "d", None, day, None, None, None, now)
    first = [row("a"), row("b"), row("z", dt.date(2024, 1, 1))]
    second = [*first, row("b"), row("c")]
    for batch in (first, second, second):
        silver_transactions(spark, spark.createDataFrame(batch, columns), f"{db}.clean", f"{db}.rejects")
    assert sorted(r.AccountNo for r in spark.table(f"{db}.rejects").collect()) == ["a", "b", "b", "c"]
