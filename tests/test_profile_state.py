"""Profile state: merges equal the exact profile within the stated errors, and only changed partitions are scanned."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import profile_state as P
from strata.operators.profile import profile
from strata.sinks import ledger
from strata.sinks.maintained import refresh_profile
from strata.sinks.tables import load_partitioned


def values(df):
    return {(r.column_name, r.metric): r.value for r in df.collect()}


def test_merge_of_partitions_is_the_profile(spark):
    df = spark.range(30_000).select(
        (F.col("id") % 7).alias("p"), (1e9 + F.sin("id") * 3).alias("far"), (F.col("id") % 1000 - 300).alias("whole"),
        F.when(F.col("id") % 5 > 0, F.col("id").cast("string")).alias("text"), F.lit(None).cast("double").alias("nothing"),
        F.when(F.col("id") % 9 == 0, float("nan")).otherwise(F.col("id") / 2).alias("some"))
    columns = ["far", "whole", "text", "nothing", "some"]
    got = values(P.merged_profile(P.partition_profile(df, columns, "p")))
    clean = df.withColumn("some", F.when(~F.isnan("some"), F.col("some")))
    want = values(profile(clean.select(*columns), columns))
    for (c, m), v in got.items():
        x = want.get((c, m))
        if c == "text" and m not in ("n", "missing", "n_distinct"):
            assert v is None
        elif m == "n_distinct":
            assert v == pytest.approx(x, rel=0.03)
        elif x is None:
            assert v is None or c == "nothing" and v == 0, (c, m)
        elif m not in ("median", "iqr") and not m.startswith("p"):
            assert v == pytest.approx(x, rel=1e-9), (c, m)
    n = 30_000
    for c in ("far", "whole"):
        for p in (0.25, 0.5, 0.75):
            from strata.operators.profile import _pct_name

            q = got[c, _pct_name(p)]
            below, upto = df.agg(F.count_if(F.col(c) < q), F.count_if(F.col(c) <= q)).first()
            assert below / n <= p + P.rank_error() and upto / n >= p - P.rank_error()


def test_comparison_of_states_and_empty(spark):
    a = P.partition_profile(spark.createDataFrame([(1, 2.0), (1, 4.0)], "p int, v double"), ["v"], "p")
    b = P.partition_profile(spark.createDataFrame([(5, 3.0)], "p int, v double"), ["v"], "p")
    got = {r.metric: (r.value_1, r.value_2, r.difference) for r in P.compare_states(a, b).collect()}
    assert got["n"] == (2.0, 1.0, -1.0) and got["mean"] == (3.0, 3.0, 0.0) and got["std"] == (pytest.approx(2**0.5), None, None) and got["max"] == (4.0, 3.0, -1.0)
    assert P.merged_profile(a.limit(0)).count() == 0


def test_only_changed_partitions_are_scanned(spark, db):
    table, state = f"{db}.t", f"{db}.s"
    day = lambda n: dt.date(2024, 1, n)
    load = lambda rows: (load_partitioned(spark, table, spark.createDataFrame(rows, "k int, d date, v double"), ["k"], ["d"], "d"),
                         ledger.record_changes(spark, table, spark.createDataFrame([(r[1],) for r in rows], "d date")))
    load([(k, day(1 + k % 5), float(k)) for k in range(50)])
    assert refresh_profile(spark, table, state, ["v"], "p") == 1 and refresh_profile(spark, table, state, ["v"], "p") == 0
    before = {r.d_Partition: r["_metadata"].file_path for r in spark.table(state).select("*", "_metadata").collect()}
    load([(3, day(4), 1000.0), (99, None, -5.0)])
    load([(98, day(9), 7.0)])
    assert refresh_profile(spark, table, state, ["v"], "p") == 2
    after = {r.d_Partition: r["_metadata"].file_path for r in spark.table(state).select("*", "_metadata").collect()}
    assert {d for d in after if after[d] != before.get(d)} == {day(4), None, day(9)}
    got = values(P.merged_profile(spark.table(state)))
    assert (got["v", "n"], got["v", "min"], got["v", "max"]) == (52.0, -5.0, 1000.0)
