"""No cut fields, no aborted checks: text files, filters by type, reconcile of odd keys, quantile brackets."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.operators import profile as P
from strata.operators.find import count_documents, find, find_by_id
from strata.operators.quality import reconcile
from strata.sources.files import read_txt


def test_text_fields_beyond_the_header_fail(spark, tmp_path):
    good, bad = tmp_path / "good", tmp_path / "bad"
    good.mkdir(), bad.mkdir()
    (good / "a.txt").write_text("a|b\n1|2\n3\n|\n5|\n")
    (bad / "a.txt").write_text("a|b\n1|2|EXTRA\n3|4\n")
    assert [tuple(r) for r in read_txt(spark, str(good)).collect()] == [("1", "2"), ("3", None), (None, None), ("5", None)]
    for columns in (["a"], ["b"], ["a", "b"]):
        with pytest.raises(Exception, match="more than 2 fields: 1\\|2\\|EXTRA"):
            read_txt(spark, str(bad)).select(*columns).collect()
    with pytest.raises(Exception, match="more than 2 fields"):
        read_txt(spark, str(bad)).count()
    assert read_txt(spark, str(bad / "a.txt"), columns=["x", "y", "z"], header=False).count() == 3


@pytest.fixture(scope="module")
def docs(spark):
    rows = [("x", 1, 1.5, True, dt.datetime(2024, 1, 1), Decimal("2.50"), ("in", 1)), ("5", 5, 5.0, False, dt.datetime(2024, 5, 5), Decimal("5.00"), ("5", 5)), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "s string, n long, d double, b boolean, t timestamp_ntz, m decimal(10,2), o struct<s:string,n:int>")


@pytest.mark.parametrize(
    "query, rows",
    [
        ({"s": 5}, 0), ({"s": {"$gte": 5}}, 0), ({"s": {"$in": [5, "x"]}}, 1), ({"s": {"$nin": [5, "x"]}}, 2), ({"s": {"$ne": 1}}, 3),
        ({"n": "1"}, 0), ({"n": {"$lt": "z"}}, 0), ({"n": {"$ne": "1"}}, 3), ({"n": {"$not": {"$gt": "a"}}}, 3), ({"n": True}, 0), ({"b": 1}, 0),
        ({"b": True}, 1), ({"n": {"$regex": "1"}}, 0), ({"s": {"$regex": "x"}}, 1), ({"t": "2024-01-01"}, 0), ({"t": {"$gt": dt.date(2024, 2, 1)}}, 1),
        ({"m": 2.5}, 1), ({"m": Decimal("5")}, 1), ({"n": 1.0}, 1), ({"d": 5}, 1), ({"o.s": 5}, 0), ({"o.n": 5}, 1), ({"missing": 1}, 0),
        ({"$nor": [{"s": 5}]}, 3), ({"$or": [{"s": 5}, {"n": 5}]}, 1), ({"s": {"$eq": None}}, 1), ({"s": {"$in": [None, 3]}}, 1),
    ],
)
def test_another_type_is_no_match_and_no_error(docs, query, rows):
    assert find(docs, query).count() == rows and count_documents(docs, query).first()[0] == rows


def test_find_by_id_of_another_type(docs):
    assert find_by_id(docs, 5, id_field="s").count() == 0 and find_by_id(docs, "5", id_field="s").count() == 1


def test_reconcile_reports_on_keys_of_other_types(spark):
    s = spark.createDataFrame([(1,), (2,)], "k int")
    d = spark.createDataFrame([("1",), ("x",)], "k string")
    assert tuple(reconcile(s, d, "k").first())[:3] == ("PASS", 2, 2)
    both = reconcile(s, spark.createDataFrame([(5_000_000_000,)], "k long"), "k").first()
    assert both.Status_Rows == "FAIL" and both.Destination_Rows == 1


def test_a_missed_bracket_is_noticed(spark, monkeypatch):
    df = spark.range(60_000).select((F.col("id") * 7919 % 60_000).cast("double").alias("v"), F.lit(3.0).alias("c"))
    want = {"p25": 14999.75, "median": 29999.5, "p75": 44999.25}
    read = lambda: {r.metric: r.value for r in P.exact_quantiles(df, ["v", "c"], [0.25, 0.5, 0.75]).filter("column_name = 'v'").collect()}
    got = read()
    assert {m: got[m] for m in got if m != "iqr"} == {P._pct_name(p): v for p, v in zip((0.25, 0.5, 0.75), want.values(), strict=True)}
    real = F.percentile_approx
    monkeypatch.setattr(P.F, "percentile_approx", lambda c, p, n: real(F.least(c, F.lit(100.0)), p, n))  # a sketch that is far off
    assert read() == got
