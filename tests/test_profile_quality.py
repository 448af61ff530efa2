import hashlib

import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.operators.profile import compare_profiles, exact_quantiles, profile
from strata.operators.quality import dq_record, dq_report, reconcile


def test_numeric_profile_matches_pandas(spark):
    vals = [1.0, 2.0, 3.0, 10.0, None, 0.0, -4.0, 3.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    p = {r.metric: r.value for r in profile(df, ["x"]).collect()}
    s = pd.Series([v for v in vals if v is not None])
    assert p["n"] == 8 and p["missing"] == 1 and p["n_distinct"] == 6
    assert p["zeros"] == 1 and p["negatives"] == 1
    assert p["std"] == pytest.approx(s.std()) and p["variance"] == pytest.approx(s.var())
    assert p["skewness"] == pytest.approx(s.skew()) and p["kurtosis"] == pytest.approx(s.kurt())
    for q in (0.05, 0.25, 0.5, 0.75, 0.95):
        name = "p" + f"{q * 100:g}"
        assert p[name] == pytest.approx(s.quantile(q))
    assert p["iqr"] == pytest.approx(s.quantile(0.75) - s.quantile(0.25))


def test_exact_quantiles_with_a_hot_value(spark):
    # a third of the rows share one value
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("double").alias("x"))
    s = df.toPandas()["x"]
    q = {r.metric: r.value for r in exact_quantiles(df, ["x"], (0.1, 0.5, 0.9)).collect()}
    assert q["p10"] == pytest.approx(s.quantile(0.1)) and q["p50"] == pytest.approx(s.quantile(0.5))
    assert q["p90"] == pytest.approx(s.quantile(0.9))


def test_text_date_boolean_profiles(spark):
    df = spark.createDataFrame(
        [("a", True, "2024-01-01"), ("bb", False, "2024-01-11"), ("a", None, None)], "t string, b boolean, d string"
    ).withColumn("d", F.to_date("d"))
    p = {(r.column_name, r.metric): (r.value, r.text) for r in profile(df).collect()}
    assert p[("t", "top_1")] == (2.0, "a") and p[("t", "max_length")][0] == 2
    assert p[("b", "true")][0] == 1 and p[("b", "false")][0] == 1 and p[("b", "missing")][0] == 1
    assert p[("d", "min")][1] == "2024-01-01" and p[("d", "range_days")][0] == 10


def test_compare_profiles(spark):
    a = profile(spark.createDataFrame([(1.0,), (2.0,)], "x double"), ["x"], quantiles=())
    b = profile(spark.createDataFrame([(1.0,)], "x double"), ["x"], quantiles=())
    d = {r.metric: r.difference for r in compare_profiles(a, b).collect()}
    assert d["n"] == 1 and d["sum"] == 2.0


def test_reconcile_statuses(spark):
    src = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    dst = spark.createDataFrame([(1,), (2,)], "k int")
    r = reconcile(src, dst, "k").first()
    assert (r.Status_Observation, r.Difference_Observation) == ("FAIL", 2)
    assert (r.Status_Rows, r.Source_Rows, r.Destination_Rows) == ("PASS", 2, 2)
    r = reconcile(src, dst.filter("false"), "k").first()
    assert (r.Status_Observation, r.Difference_Observation, r.Status_Rows) == ("UNKNOWN", None, "UNKNOWN")
    assert reconcile(dst, dst, "k").first().Status_Observation == "PASS"


def test_dq_record_identity_and_upsert(spark, db):
    rec = reconcile(spark.range(3), spark.range(3), "id")
    now = "2024-05-01 20:30:00"
    r = dq_record(rec, "Integration", "XLSX_to_Bronze", "XLSX", "/tmp/Example.xlsx", "t", now).first()
    assert r.ID == hashlib.sha256(b"20240502_example_integration_xlsx_to_bronze").hexdigest()
    assert (r.Type, r.Process, r.Type_File_Sources, r.File_Sources) == (
        "integration", "xlsx_to_bronze", "xlsx", "/tmp/example.xlsx"
    )
    none = dq_record(rec, None, None, None, None, "t", now).first()
    assert (none.Type, none.File_Sources) == ("unknown", "unknown")
    table = f"{db}.monitor"
    dq_report(spark, table, dq_record(rec, "a", "b", "c", "/p/f.x", "t", now))
    dq_report(spark, table, dq_record(rec, "a", "b", "c", "/p/f.x", "t", now))
    assert spark.table(table).count() == 1  # same day: update
    dq_report(spark, table, dq_record(rec, "a", "b", "c", "/p/f.x", "t", "2024-05-02 20:30:00"))
    assert spark.table(table).count() == 2  # next day: insert


def test_approximate_quantiles_option(spark):
    df = spark.range(1, 1001).select(F.col("id").cast("double").alias("x"))
    p = {r.metric: r.value for r in profile(df, ["x"], approx_quantile_accuracy=10_000).collect()}
    assert p["p50"] == 500.0 and p["p5"] == 50.0 and p["n_distinct"] == 1000 and p["iqr"] == 500.0


def test_bronze_quality_scopes(spark, db):
    from strata.functions.columns import stamp_ingestion
    from strata.plans.jobs import bronze_quality
    from strata.sinks.tables import load_table

    name = f"{db}.bronze"
    first = stamp_ingestion(spark.createDataFrame([("1",), ("2",)], "AccountNo string"), now="2024-01-01 00:00:00")
    second = stamp_ingestion(spark.createDataFrame([("1",), ("3",)], "AccountNo string"), now="2024-01-02 00:00:00")
    load_table(spark, name, first)
    load_table(spark, name, second)
    table_scope = bronze_quality(second, spark.table(name), "/x/f.xlsx").first()
    batch_scope = bronze_quality(second, spark.table(name), "/x/f.xlsx", scope="batch").first()
    assert (table_scope.Status_Observation, table_scope.Destination_Observation) == ("FAIL", 4)
    assert (batch_scope.Status_Observation, batch_scope.Status_Rows) == ("PASS", "PASS")


def test_approx_distinct_and_decimal_columns(spark):
    from decimal import Decimal

    df = spark.createDataFrame([(Decimal("1.50"), 9007199254740993), (Decimal("2.25"), 9007199254740992)], "m decimal(18,2), big long")
    p = {(r.column_name, r.metric): r.value for r in profile(df).collect()}
    assert p[("m", "sum")] == 3.75 and p[("big", "n_distinct")] == 2  # exact beyond 2^53
    a = {(r.column_name, r.metric): r.value for r in profile(df, approx_distinct=True, quantiles=()).collect()}
    assert a[("m", "n_distinct")] == 2


def test_exact_distinct_for_wide_decimals(spark):
    from decimal import Decimal

    df = spark.createDataFrame(
        [(Decimal("12345678901234567890.1"),), (Decimal("12345678901234567890.2"),), (None,)], "d decimal(30,1)"
    )
    p = {r.metric: r.value for r in profile(df, ["d"]).collect()}
    assert p["n_distinct"] == 2 and p["missing"] == 1


def test_report_from_counts(spark, db):
    from strata.operators.quality import report_counts

    table = f"{db}.monitor_counts"
    now = "2024-05-01 20:30:00"
    report_counts(spark, table, 10, 10, 5, 4, "t", "xlsx_to_bronze", "integration", "xlsx", "/tmp/Example.xlsx", now)
    report_counts(spark, table, 10, None, 5, 0, "t", "bronze_to_silver", "platform", "parquet", "/lake/b", now)
    rows = {r.Process: r for r in spark.table(table).collect()}
    a, b = rows["xlsx_to_bronze"], rows["bronze_to_silver"]
    assert (a.Status_Observation, a.Status_Rows, a.Difference_Rows) == ("PASS", "FAIL", 1)
    assert (b.Status_Observation, b.Difference_Observation, b.Status_Rows) == ("UNKNOWN", None, "UNKNOWN")
    assert a.ID == hashlib.sha256(b"20240502_example_integration_xlsx_to_bronze").hexdigest()


def test_nan_is_missing_in_every_metric(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, [1], b"x"), (nan, None, None), (3.0, [2], b"y"), (None, [3], b"z")], "x double, a array<int>, b binary")
    p = {(r.column_name, r.metric): r.value for r in profile(df).collect()}
    assert (p["x", "n"], p["x", "missing"], p["x", "n_distinct"], p["x", "mean"], p["x", "p50"], p["x", "max"]) == (4, 2, 2, 2.0, 2.0, 3.0)
    assert (p["a", "n"], p["a", "missing"], p["b", "n"], p["b", "missing"]) == (4, 1, 4, 1) and ("a", "n_distinct") not in p
    only = {(r.column_name, r.metric): r.value for r in profile(df.select("a")).collect()}
    assert only == {("a", "n"): 4, ("a", "missing"): 1}
    assert profile(df, []).count() == 0
    empty = {(r.column_name, r.metric): r.value for r in profile(df.select("x").filter("false")).collect()}
    assert empty["x", "n"] == 0 and empty["x", "p50"] is None and empty["x", "n_distinct"] == 0


@pytest.mark.parametrize("shape", ["uniform", "ties", "skewed", "tiny"])
def test_bracketed_quantiles_are_exact(spark, monkeypatch, shape):
    import numpy as np

    from strata.operators import profile as P

    rng = np.random.default_rng(8)
    data = {
        "uniform": rng.random(20_000),
        "ties": rng.integers(0, 9, 20_000).astype(float),
        "skewed": np.exp(rng.normal(size=20_000) * 3),
        "tiny": rng.random(3),
    }[shape]
    df = spark.createDataFrame(pd.DataFrame({"x": data, "y": -data}))
    probs = (0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0)
    for accuracy in (P.BRACKET_ACCURACY, 100):
        monkeypatch.setattr(P, "BRACKET_ACCURACY", accuracy)
        got = {(r.column_name, r.metric): r.value for r in exact_quantiles(df, ["x", "y"], probs).collect()}
        for p in probs:
            assert got["x", P._pct_name(p)] == pytest.approx(np.quantile(data, p), rel=1e-12)
            assert got["y", P._pct_name(p)] == pytest.approx(np.quantile(-data, p), rel=1e-12)
        assert got["x", "iqr"] == pytest.approx(np.quantile(data, 0.75) - np.quantile(data, 0.25), rel=1e-9)
