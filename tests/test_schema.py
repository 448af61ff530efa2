"""Wider types without loss, names as the session resolves them, columns called like helpers."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.merge import align_to, merge_frames, op_name
from strata.operators.schema import common_type, free_name, lossless, merged_type
from strata.sinks.tables import append_table, load_partitioned, load_table, table_exists, widen_table

D = T.DecimalType


@pytest.mark.parametrize(
    "a, b, want",
    [
        (T.IntegerType(), T.LongType(), T.LongType()),
        (T.IntegerType(), T.DoubleType(), T.DoubleType()),
        (T.LongType(), T.DoubleType(), None),
        (T.FloatType(), T.DoubleType(), T.DoubleType()),
        (T.IntegerType(), T.FloatType(), T.DoubleType()),
        (T.LongType(), T.FloatType(), None),
        (D(10, 2), D(12, 4), D(12, 4)),
        (D(18, 2), D(10, 6), D(22, 6)),
        (D(38, 0), D(10, 6), None),
        (T.IntegerType(), D(10, 2), D(12, 2)),
        (T.LongType(), D(18, 2), D(21, 2)),
        (D(10, 2), T.DoubleType(), None),
        (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()),
        (T.NullType(), T.IntegerType(), T.IntegerType()),
        (T.IntegerType(), T.StringType(), None),
        (T.BinaryType(), T.StringType(), None),
        (T.BooleanType(), T.IntegerType(), None),
        (T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType()), T.ArrayType(T.LongType())),
    ],
)
def test_common_type(a, b, want):
    assert common_type(a, b) == want or (want is None and common_type(a, b) is None)
    if not isinstance(b, T.StringType):
        assert common_type(b, a) == common_type(a, b)
    if want is not None:
        assert lossless(a, want) and lossless(b, want)


def test_text_tables_take_values_and_typed_tables_take_no_text():
    assert merged_type("v", T.StringType(), T.IntegerType()) == T.StringType()
    with pytest.raises(TypeError, match="column v: string and int"):
        merged_type("v", T.IntegerType(), T.StringType())


def values(spark, name, column="v"):
    return {r["k"]: r[column] for r in spark.table(name).collect()}


def test_keyed_load_widens_instead_of_cutting(spark, db):
    name = f"{db}.keyed"
    load_table(spark, name, spark.createDataFrame([(1, 2), (2, 3)], "k int, v int"), keys="k")
    load_table(spark, name, spark.createDataFrame([(2, 2.75), (3, 0.5)], "k int, v double"), keys="k")
    assert values(spark, name) == {1: 2.0, 2: 2.75, 3: 0.5}
    load_table(spark, name, spark.createDataFrame([(5_000_000_000, 1.0)], "k long, v double"), keys="k")
    assert values(spark, name)[5_000_000_000] == 1.0 and spark.table(name).schema["k"].dataType == T.LongType()


def test_append_and_partitioned_load_widen(spark, db):
    name = f"{db}.money"
    load_table(spark, name, spark.createDataFrame([(1, Decimal("1.25"))], "k int, v decimal(10,2)"))
    append_table(spark, name, spark.createDataFrame([(2, Decimal("1.2567"))], "k int, v decimal(10,4)"))
    assert values(spark, name) == {1: Decimal("1.2500"), 2: Decimal("1.2567")}
    assert spark.table(name).schema["v"].dataType == D(12, 4)
    daily = f"{db}.daily"
    day = dt.date(2024, 1, 1)
    load = lambda rows, kind: load_partitioned(spark, daily, spark.createDataFrame(rows, f"k int, d date, v {kind}"), ["k"], ["d"], "d")
    load([(1, day, 7), (2, dt.date(2024, 1, 2), 8)], "int")
    load([(1, day, 2.75), (3, None, 1.5)], "double")
    assert values(spark, daily) == {1: 2.75, 2: 8.0, 3: 1.5}
    assert {r.d_Partition for r in spark.table(daily).collect()} == {day, dt.date(2024, 1, 2), None}


def test_every_widening_reads_old_files(spark, db):
    old = spark.createDataFrame([(1, 2, 3, 1.5, Decimal("9.99"), dt.date(2024, 2, 29), [1])], "a int, b int, c int, d float, e decimal(10,2), f date, g array<int>")
    name = f"{db}.every"
    load_table(spark, name, old)
    wide = spark.createDataFrame(
        [(5_000_000_000, 0.5, Decimal("0.25"), 2.5, Decimal("0.123456"), dt.datetime(2024, 1, 1, 1), [5_000_000_000])],
        "a long, b double, c decimal(12,2), d double, e decimal(16,6), f timestamp_ntz, g array<long>",
    )
    append_table(spark, name, wide)
    got = sorted(map(tuple, spark.table(name).collect()), key=lambda r: r[0])
    assert got[0] == (1, 2.0, Decimal("3.00"), 1.5, Decimal("9.990000"), dt.datetime(2024, 2, 29), [1])
    assert got[1] == tuple(wide.first())


def test_no_common_type_is_an_error_and_changes_nothing(spark, db):
    name = f"{db}.strict"
    load_table(spark, name, spark.createDataFrame([(1, 2)], "k int, v long"), keys="k")
    for kind, value in (("double", 2.5), ("string", "2.5"), ("boolean", True)):
        with pytest.raises(TypeError, match="without loss"):
            load_table(spark, name, spark.createDataFrame([(1, value)], f"k int, v {kind}"), keys="k")
    assert values(spark, name) == {1: 2}
    text = f"{db}.text"
    load_table(spark, text, spark.createDataFrame([(1, "x")], "k int, v string"), keys="k")
    load_table(spark, text, spark.createDataFrame([(1, 7)], "k int, v int"), keys="k")
    assert values(spark, text) == {1: "7"}


def test_crash_between_renames_of_a_widening(spark, db, monkeypatch):
    import strata.sinks.tables as t

    name = f"{db}.renames"
    load_table(spark, name, spark.createDataFrame([(1, 2)], "k int, v int"), keys="k")
    wide = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.LongType())])
    real = type(spark).sql

    def failing(self, text, *a, **b):
        if text.startswith(f"ALTER TABLE {name}{t._NEXT} RENAME"):
            raise RuntimeError("crash")
        return real(self, text, *a, **b)

    monkeypatch.setattr(type(spark), "sql", failing)
    with pytest.raises(RuntimeError):
        widen_table(spark, name, wide)
    monkeypatch.undo()
    assert not table_exists(spark, name)
    load_table(spark, name, spark.createDataFrame([(2, 5_000_000_000)], "k int, v long"), keys="k")
    assert values(spark, name) == {1: 2, 2: 5_000_000_000}


def test_managed_tables_and_partition_columns_do_not_change(spark, db):
    name = f"{db}.managed"
    spark.createDataFrame([(1, 2)], "k int, v int").write.saveAsTable(name)
    with pytest.raises(TypeError, match="external"):
        append_table(spark, name, spark.createDataFrame([(1, 2.5)], "k int, v double"))
    assert values(spark, name) == {1: 2}


def test_helper_names_and_case(spark, db):
    t = spark.createDataFrame([(1, "a", "x", 1), (2, "b", "y", 2)], "k int, _op string, __strata_src string, _OP_ int")
    s = spark.createDataFrame([(2, "c", "z"), (3, "d", "w")], "K int, _Op string, __strata_src string")
    out = merge_frames(t, s, ["K"])
    op = op_name(t, s)
    assert op == free_name("_op", t.columns) == "__op" and out.columns == [*t.columns, op]
    got = {r.k: (r["_op"], r["__strata_src"], r[op]) for r in out.collect()}
    assert got == {1: ("a", "x", "kept"), 2: ("c", "z", "updated"), 3: ("d", "w", "inserted")}
    name = f"{db}.clash"
    load_table(spark, name, t, keys="k")
    res = load_table(spark, name, s, keys="K")
    assert (res.updated, res.inserted) == (1, 1) and spark.table(name).columns == t.columns
    assert align_to(s, t.schema).columns == t.columns


def test_older_batches_do_not_replace_newer_rows(spark, db):
    day = lambda n: dt.date(2024, 1, n)
    batches = [[(1, day(1), day(3), "b1"), (2, day(1), day(1), "b1")], [(1, day(1), day(2), "b2"), (2, day(1), day(2), "b2")], [(1, day(1), day(1), "b3"), (2, day(1), None, "b3")]]
    for n, order in enumerate(([2, 1, 0], [1, 0, 2])):
        name = f"{db}.late{n}"
        for i in order:
            df = spark.createDataFrame(batches[i], "k int, d date, updated date, v string")
            load_partitioned(spark, name, df, ["k"], ["updated"], "d", newest_wins=True)
        assert values(spark, name) == {1: "b1", 2: "b2"}
    plain = f"{db}.plain"  # without the option the last batch replaces, as ever
    for i in (0, 1, 2):
        load_partitioned(spark, plain, spark.createDataFrame(batches[i], "k int, d date, updated date, v string"), ["k"], ["updated"], "d")
    assert values(spark, plain) == {1: "b3", 2: "b3"}
    keyed = f"{db}.keyed_newest"
    for i in (1, 0, 2):
        load_table(spark, keyed, spark.createDataFrame(batches[i], "k int, d date, updated date, v string"), keys="k", newest_by=["updated"])
    assert values(spark, keyed) == {1: "b1", 2: "b2"}


def test_rows_equal_in_order_are_replaced(spark):
    t = spark.createDataFrame([(1, 5, "old")], "k int, o int, v string")
    s = spark.createDataFrame([(1, 5, "new")], "k int, o int, v string")
    assert merge_frames(t, s, ["k"], order_by=["o"]).first().v == "new"
    assert merge_frames(t, s.withColumn("o", F.lit(4)), ["k"], order_by=["o"]).first()["_op"] == "kept"
