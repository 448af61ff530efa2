from pyspark.sql import functions as F

from strata.operators.dedup import is_unique_key, key_stats, latest_per_key
from strata.operators.merge import OP, merge_frames


def test_latest_per_key_desc_nulls_last_and_idempotent(spark):
    df = spark.createDataFrame(
        [(1, None, 5), (1, 3, 1), (1, 3, 2), (2, None, 1), (None, 1, 1), (None, 2, 1)], "k int, d int, t int"
    )
    out = latest_per_key(df, ["k"], ["d"], tie_break=["t"])
    rows = sorted((r.k if r.k is not None else -1, r.d, r.t) for r in out.collect())
    assert rows == [(-1, 2, 1), (1, 3, 2), (2, None, 1)]
    again = latest_per_key(out, ["k"], ["d"], tie_break=["t"])
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, out.collect()), key=str)


def test_latest_per_key_plan_limits_before_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    plan = latest_per_key(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_key_uniqueness_counts_null_as_value(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    r = key_stats(df, ["k"]).first()
    assert (r.rows, r.distinct_keys, r.null_keys, r.is_unique) == (3, 3, 1, True)
    assert not is_unique_key(df.unionByName(spark.createDataFrame([(None,)], "k int")), ["k"])


def test_merge_null_keys_never_match(spark):
    t = spark.createDataFrame([(1, "a"), (None, "t")], "k int, v string")
    s = spark.createDataFrame([(1, "b"), (None, "s"), (3, "c")], "k int, v string")
    out = {(r.k, r.v, r[OP]) for r in merge_frames(t, s, ["k"]).collect()}
    assert out == {(1, "b", "updated"), (None, "t", "kept"), (None, "s", "inserted"), (3, "c", "inserted")}
    safe = {(r.k, r.v, r[OP]) for r in merge_frames(t, s, ["k"], null_safe=True).collect()}
    assert (None, "s", "updated") in safe and len(safe) == 3


def test_merge_schema_evolution_semantics(spark):
    t = spark.createDataFrame([(1, "a", "keep"), (2, "b", "old")], "k int, v string, only_t string")
    s = spark.createDataFrame([(1, "A", 10), (3, "C", 30)], "k long, v string, only_s int")
    out = {r.k: r for r in merge_frames(t, s, ["k"]).collect()}
    assert out[1].only_t == "keep" and out[1].only_s == 10 and out[1].v == "A"
    assert out[2].only_s is None and out[2][OP] == "kept"
    assert out[3].only_t is None and out[3][OP] == "inserted"


def test_merge_row_count_property(spark):
    t = spark.range(0, 100).withColumn("v", F.lit("t"))
    s = spark.range(50, 180).withColumn("v", F.lit("s"))
    m = merge_frames(t, s, ["id"])
    c = {r[0]: r[1] for r in m.groupBy(OP).count().collect()}
    assert m.count() == 100 + c["inserted"] and c == {"kept": 50, "updated": 50, "inserted": 80}


def test_merge_splits_a_hot_target_key(spark):
    """A key holding a third of the target (left by earlier appends) is split
    over several tasks by AQE, which a full outer join would not allow."""
    from strata.session import conf

    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    with conf(spark, **settings):
        t = spark.range(30000).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
            F.sha2(F.col("id").cast("string"), 256).alias("v"),
        )
        s = spark.range(0, 100).select(F.col("id").alias("k"), F.lit("s").alias("v"))
        m = merge_frames(t, s, ["k"])
        counts = {r[0]: r[1] for r in m.groupBy(OP).count().collect()}
        rows = m.collect()
        plan = m._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan
    # key 7: the 10,000 multiples of 3 plus id 7 itself, all updated
    assert sum(1 for r in rows if r.k == 7 and r.v == "s") == 10001
    # source keys 0..99 match the 66 non-multiples of 3 (7 among them)
    assert counts == {"updated": 65 + 10001, "kept": 30000 - 10066, "inserted": 100 - 66}


def test_account_summary_latest_balance_is_deterministic(spark):
    import datetime as dt
    from decimal import Decimal

    from strata.operators.aggregate import account_summary

    rows = [
        ("A", dt.date(2024, 1, 1), None, Decimal("1.00"), Decimal("10.00"), 1),
        ("A", dt.date(2024, 1, 3), Decimal("2.00"), None, None, 2),  # latest date: NULL balance kept
        ("A", None, None, None, Decimal("99.00"), 9),  # NULL date is lowest
        ("B", dt.date(2024, 1, 2), None, None, Decimal("5.00"), 1),
        ("B", dt.date(2024, 1, 2), None, None, Decimal("6.00"), 2),  # same date: higher tie-break wins
    ]
    df = spark.createDataFrame(
        rows,
        "AccountNo string, Date date, WithdrawalAMT decimal(18,2), DepositAMT decimal(18,2), "
        "BalanceAMT decimal(18,2), TxnNo long",
    )
    out = {r.AccountNo: r for r in account_summary(df).collect()}
    assert out["A"].NetBalance is None and out["A"].LastTransactionDate == dt.date(2024, 1, 3)
    assert out["A"].TotalDeposits == Decimal("1.00") and out["A"].TotalWithdrawals == Decimal("2.00")
    assert out["B"].NetBalance == Decimal("6.00") and out["B"].TotalDeposits is None
    assert dict(account_summary(df).dtypes)["TotalDeposits"] == "decimal(28,2)"
