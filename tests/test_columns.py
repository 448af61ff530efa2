import datetime as dt
import hashlib
import re
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import columns as C


def one(spark, expr, data=None, schema="x string"):
    df = spark.createDataFrame(data or [(None,)], schema)
    return [r[0] for r in df.select(expr.alias("v")).collect()]


def test_strip_and_rename(spark):
    df = spark.createDataFrame([("100'", ".")], ["Account No", "."])
    out = C.clean_columns(C.rename_columns(df, {"Account No": "AccountNo", "missing": "x"}), ["."])
    assert out.columns == ["AccountNo"]
    assert out.select(C.strip_chars("AccountNo")).first()[0] == "100"


def test_parse_date_bad_value_is_null_under_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "true")
    got = one(spark, C.parse_date("x"), [("2024-01-02",), ("not a date",), (None,)])
    assert got == [dt.date(2024, 1, 2), None, None]


def test_to_money_nan_and_half_even(spark):
    got = one(spark, C.to_money("x"), [("NaN",), ("0.125",), ("1.5",), ("junk",), (None,)])
    assert got == [None, Decimal("0.12"), Decimal("1.50"), None, None]


def test_surrogate_key_null_and_collision(spark):
    df = spark.createDataFrame([("1", "23", None), ("12", "3", None), (None, "3", "x")], "a string, b string, c string")
    k = df.select(C.surrogate_key(["a", "b", "c"], null_as={"c": ""}).alias("k")).collect()
    assert k[0][0] == k[1][0] == hashlib.sha256(b"123").hexdigest()  # no separator: collision
    assert k[2][0] is None  # a is not defaulted
    k2 = df.select(C.surrogate_key(["a", "b"], sep="|").alias("k")).collect()
    assert k2[0][0] != k2[1][0]


def test_key_text_of_dates_and_decimals(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), Decimal("1.50"))], "d date, m decimal(18,2)")
    assert df.select(C.surrogate_key(["d", "m"])).first()[0] == hashlib.sha256(b"2024-01-021.50").hexdigest()


def test_file_stem(spark):
    got = one(
        spark,
        C.file_stem("x"),
        [("/tmp/Example.XLSX",), ("dbfs:/a/b/transactions_raw/",), ("name",), ("",), (None,), ("a/b.c.d",)],
    )
    assert got == ["example", "transactions_raw", "name", "unknown", "unknown", "b"]


def test_lower_or_unknown_and_status(spark):
    assert one(spark, C.lower_or_unknown("x"), [("XLSX",), ("",), (None,)]) == ["xlsx", "unknown", "unknown"]
    df = spark.createDataFrame([(5, 5), (5, 4), (0, 0), (None, 3)], "s long, d long")
    diff, status = C.count_status("s", "d")
    assert [tuple(r) for r in df.select(diff, status).collect()] == [
        (0, "PASS"), (1, "FAIL"), (None, "UNKNOWN"), (None, "UNKNOWN")
    ]
    diff, status = C.count_status("s", "d", zero_is_unknown=False)
    assert df.select(status).collect()[2][0] == "PASS"


def test_local_time_and_ingestion_stamp(spark):
    df = spark.createDataFrame([(1,)], "a int")
    out = C.stamp_ingestion(df, now="2024-05-01 20:30:00").first()["IngestionTime"]
    assert out == dt.datetime(2024, 5, 2, 3, 30)
    assert df.select(C.day_stamp(C.local_time("+07:00", "2024-05-01 20:30:00"))).first()[0] == "20240502"


def test_fill_missing_and_partition_date(spark):
    df = spark.createDataFrame(
        [(None, dt.date(2024, 1, 3)), (dt.date(2024, 1, 1), dt.date(2024, 1, 3)), (None, None)], "d date, v date"
    )
    assert [r[0] for r in df.select(C.fill_missing_date("d", "1900-01-01")).collect()] == [
        dt.date(1900, 1, 1), dt.date(2024, 1, 1), dt.date(1900, 1, 1)
    ]
    assert [r[0] for r in df.select(C.partition_date("d", "v")).collect()] == [
        dt.date(2024, 1, 3), dt.date(2024, 1, 1), None
    ]


def test_conform_keeps_null_as_null(spark):
    df = spark.createDataFrame([("1", None, "2024-01-02", "3.456")], "a string, b string, c string, m string")
    schema = T.StructType(
        [
            T.StructField("a", T.LongType()),
            T.StructField("b", T.StringType()),
            T.StructField("c", T.DateType()),
            T.StructField("m", T.DecimalType(18, 2)),
            T.StructField("z", T.StringType()),
        ]
    )
    r = C.conform(df, schema).first()
    assert tuple(r) == (1, None, dt.date(2024, 1, 2), Decimal("3.46"), None)


def test_local_time_without_fixed_now(spark):
    import datetime as _dt

    df = spark.createDataFrame([(1,)], "a int")
    got = df.select(C.local_time("+07:00").alias("t")).first().t
    expected = _dt.datetime.now(_dt.UTC).replace(tzinfo=None) + _dt.timedelta(hours=7)
    assert abs((got - expected).total_seconds()) < 120
    assert C.stamp_ingestion(df).schema["IngestionTime"].dataType.simpleString() == "timestamp_ntz"


def test_parse_date_forms(spark):
    texts = ["2017-06-29 10:30:00", "2017-06-29T00:00:00", "29-Jun-17", " 06/29/2017 ", "6/29/2017", "2017-06-29 10:30:00.123456", "29-Jun-1997"]
    got = one(spark, C.parse_date("x"), [(t,) for t in texts])
    assert got == [dt.date(2017, 6, 29)] * 6 + [dt.date(1997, 6, 29)]
    assert one(spark, C.parse_date("x"), [("01-Feb-92",), ("31/12/2017",), ("",)]) == [dt.date(1992, 2, 1), None, None]


def test_to_money_never_fails_or_loses_digits(spark):
    texts = ["9999999999999999.99", "99999999999999999.99", "1e20", "Infinity", "-inf", "1.5e3", "0.135", "0.145", "1234567890123456.785"]
    got = one(spark, C.to_money("x"), [(t,) for t in texts])
    D = Decimal
    assert got == [D("9999999999999999.99"), None, None, None, None, D("1500.00"), D("0.14"), D("0.14"), D("1234567890123456.78")]
    doubles = one(spark, C.to_money("x"), [(0.125,), (float("nan"),), (float("inf"),), (1e300,), (2.675,)], "x double")
    assert doubles == [D("0.12"), None, None, None, D("2.68")]


def test_cast_failures_are_counted(spark):
    df = spark.createDataFrame(
        [("1", "x", "nan"), ("oops", "2024-01-02", "1e20"), (" ", "None", "12,5"), (None, None, None)], "n string, d string, m string"
    )
    schema = T.StructType(
        [T.StructField("n", T.IntegerType()), T.StructField("d", T.DateType()), T.StructField("m", T.DecimalType(18, 2)), T.StructField("gone", T.DateType())]
    )
    counts = C.cast_failures(df, schema)
    row = df.agg(*[c.alias(n) for n, c in counts.items()]).first()
    assert row.asDict() == {"n": 1, "d": 1, "m": 2, "gone": 0}
    assert C.conform(df, schema).collect()[0].n == 1


def test_cells_are_typed_once_and_formats_tried_by_shape(spark):
    from strata.functions.columns import DATE_FORMATS, _shape, conform_counted

    texts = ["2024-01-02", "2024-01-02 10:30:00", "2024-01-02t00:00:00", "2024-01-02T10:30:00.123456", "2-Jan-24", "02-JAN-1970", "1/2/2024",
             "2-Jan-70", "2024-13-01", "not a date", "", None, "2024-01-02x", "+12024-01-02", "1/2/24", " 2024-01-02 ", "2024-1-2", "NaN"]
    df = spark.createDataFrame([(t, t) for t in texts], "d string, `s.t` string")
    plain = F.coalesce(*[F.to_date(F.try_to_timestamp(F.trim("d"), F.lit(f))) for f in DATE_FORMATS])
    got = df.select("d", C.parse_date("d").cast("string").alias("a"), plain.cast("string").alias("b")).collect()
    assert [tuple(r) for r in got if r["a"] != r["b"]] == [("2-Jan-70", "1970-01-02", "2070-01-02")]  # short years after 2068 go back a century
    assert sum(re.search(_shape(f), "not a date") is not None for f in DATE_FORMATS) == 0
    schema = T.StructType([T.StructField("d", T.DateType()), T.StructField("s.t", T.StringType()), T.StructField("new", T.LongType())])
    typed, counts = conform_counted(df, schema)
    assert typed.select(F.col("d").cast("string"), "`s.t`", "new").collect() == C.conform(df, schema).select(F.col("d").cast("string"), "`s.t`", "new").collect()
    aggs = lambda c: [x.alias(f"n{i}") for i, x in enumerate(c.values())]
    assert typed.agg(*aggs(counts)).first() == df.agg(*aggs(C.cast_failures(df, schema))).first()
    amounts = ["1", "-1.5", "12.345", "1e3", "+7", " 8.10 ", "9999999999999999.99", "99999999999999999", "0.005", "1.", ".5", "NaN", "-0", "1\n", "1d", ""]
    money = T.StructType([T.StructField("x", T.DecimalType(18, 2))])
    sums = spark.createDataFrame([(a,) for a in amounts], "x string")
    assert C.conform(sums, money).collect() == sums.select(C.to_money("x").alias("x")).collect()
    from strata.sinks.tables import observe

    out = observe(typed, *aggs(counts))[0].select("d")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("gettimestamp") in (len(DATE_FORMATS), len(DATE_FORMATS) + 2)  # the short-year format stands three times
