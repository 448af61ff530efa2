import io
import re
import json
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.find import compile_filter, count_documents, find, find_by_id, find_one
from strata.sources.databases import (
    MissingCredentialsError,
    documents_to_df,
    documents_uri,
    jdbc_spec,
    read_documents,
)
from strata.sources.files import read_csv, read_txt, write_text
from strata.plans.workbooks import workbook_bytes, write_xlsx
from strata.sources.xlsx import WorkbookError, iter_rows, read_xlsx


@pytest.fixture()
def docs(spark):
    return spark.createDataFrame(
        [("a", 1, "x", 1.0), ("b", 2, None, 5.0), ("c", 3, "y", None)], "_id string, n long, s string, v double"
    )


def ids(df):
    return sorted(r["_id"] for r in df.collect())


def test_filter_semantics(docs):
    assert ids(find(docs)) == ["a", "b", "c"]
    assert ids(find(docs, {"s": None})) == ["b"]
    assert ids(find(docs, {"s": {"$ne": "x"}})) == ["b", "c"]  # $ne matches missing
    assert ids(find(docs, {"n": {"$nin": [1]}})) == ["b", "c"]
    assert ids(find(docs, {"n": {"$gte": 2, "$lte": 3}})) == ["b", "c"]
    assert ids(find(docs, {"$or": [{"n": 1}, {"v": {"$gt": 4}}]})) == ["a", "b"]
    assert ids(find(docs, {"s": {"$regex": "^y"}})) == ["c"]
    assert ids(find(docs, {"s": {"$not": {"$eq": "x"}}})) == ["b", "c"]
    assert ids(find(docs, {"s": {"$exists": True}})) == ["a", "c"]
    assert ids(find(docs, {"$nor": [{"n": 1}]})) == ["b", "c"]
    assert ids(find(docs, {"s": None, "n": 2}, skip_none=True)) == ["b"]
    with pytest.raises(ValueError):
        compile_filter({"n": {"$near": 1}})


def test_projection_limit_one_and_count(docs):
    assert find(docs, projection={"n": 1}).columns == ["_id", "n"]
    assert find(docs, projection={"n": 1, "_id": 0}).columns == ["n"]
    assert find(docs, projection={"s": 0}).columns == ["_id", "n", "v"]
    assert find(docs, limit=2).count() == 2 and find(docs, limit=0).count() == 3
    assert find_one(docs, {"n": {"$gt": 1}}).first()["_id"] == "b"
    assert find_by_id(docs, "c").first()["n"] == 3
    assert count_documents(docs, {"v": {"$exists": True}}).first()["count"] == 2


def test_filter_is_pushed_to_parquet(spark, tmp_path):
    p = str(tmp_path / "e")
    spark.range(100).withColumn("t", F.lit("x")).write.parquet(p)
    plan = find(spark.read.parquet(p), {"id": {"$gte": 10, "$lt": 20}})._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThanOrEqual(id,10), LessThan(id,20)]" in plan


def test_credential_messages_and_urls():
    with pytest.raises(MissingCredentialsError, match="Missing PostgreSQL credentials: password"):
        jdbc_spec("postgresql", "h", "d", "u", "", 5432)
    with pytest.raises(MissingCredentialsError, match="Missing MySQL credentials: host, password"):
        jdbc_spec("mysql", "", "d", "u", None)
    with pytest.raises(MissingCredentialsError, match="Missing SQL Server credentials: db"):
        jdbc_spec("sqlserver", "h", "", "u", "p")
    with pytest.raises(MissingCredentialsError, match="Missing MongoDB credentials: password"):
        documents_uri("h", 21017, "u", None, "d")
    pg = jdbc_spec("postgresql", "h", "d", "u", "p", 5432, sslmode="require")
    assert pg.url == "jdbc:postgresql://h:5432/d?sslmode=require"
    my = jdbc_spec("mysql", "h", "d", "u", "p")
    assert my.url == "jdbc:mysql://h:3306/d" and "sslMode" not in my.properties
    assert "sslMode" not in jdbc_spec("mysql", "h", "d", "u", "p", ssl_ca="ca").properties
    assert "sslMode" in jdbc_spec("mysql", "h", "d", "u", "p", ssl_ca="a", ssl_cert="b", ssl_key="c").properties
    ms = jdbc_spec("sqlserver", "h", "d", "u", "p", ssl_key="k")
    assert ms.url == "jdbc:sqlserver://h:1433;databaseName=d" and ms.properties["clientKey"] == "k"
    assert documents_uri("h", 21017, "u", "p w", "d", auth_source="admin") == "mongodb://u:p+w@h:21017/d?authSource=admin"


def test_documents_match_by_name(spark, tmp_path):
    p = tmp_path / "docs.json"
    p.write_text(
        "\n".join(
            json.dumps(d)
            for d in [
                {"b": "B1", "_id": {"$oid": "65f0"}, "a": "A1", "extra": 1},
                {"a": "A2", "_id": "plain"},
            ]
        )
    )
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("_id", "a", "b")])
    got = sorted(map(tuple, documents_to_df(spark.read.text(str(p)), schema).collect()))
    assert got == [("65f0", "A1", "B1"), ("plain", "A2", None)]
    got = read_documents(spark, str(p), schema, {"a": "A1"}).collect()
    assert [tuple(r) for r in got] == [("65f0", "A1", "B1")]


def test_csv_and_text_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a|b"), (2, None)], "k int, s string")
    df.write.option("header", True).csv(str(tmp_path / "c"))
    got = sorted(map(tuple, read_csv(spark, str(tmp_path / "c"), "k int, s string").collect()), key=str)
    assert got == [(1, "a|b"), (2, None)]
    write_text(spark.createDataFrame([(1, "x"), (2, "y")], "k int, s string").repartition(2), str(tmp_path / "t"))
    got = sorted(map(tuple, read_txt(spark, str(tmp_path / "t")).collect()))
    assert got == [("1", "x"), ("2", "y")]


def test_workbook_reader(spark, tmp_path):
    data = workbook_bytes(["Account No", "DATE", "AMT"], [["100'", "2024-01-02", 1.5], ["200'", None, 2]])
    (tmp_path / "a.xlsx").write_bytes(data)
    rows = list(iter_rows(data, "Sheet1"))
    assert rows[0] == ["Account No", "DATE", "AMT"] and rows[1] == ["100'", "2024-01-02", "1.5"]
    df = read_xlsx(spark, str(tmp_path / "a.xlsx"), "Sheet1")
    assert df.columns == ["Account No", "DATE", "AMT"]
    assert sorted(map(tuple, df.collect()), key=str) == [("100'", "2024-01-02", "1.5"), ("200'", None, "2")]


def test_workbook_date_cells():
    # a date-styled numeric cell (serial 45293 = 2024-01-02) is returned as a date
    buf = io.BytesIO(workbook_bytes(["d"], [[45293]]))
    with zipfile.ZipFile(buf) as z:
        parts = {n: z.read(n) for n in z.namelist()}
    parts["xl/styles.xml"] = (
        b'<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
        b'<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>'
    )
    parts["xl/worksheets/sheet1.xml"] = parts["xl/worksheets/sheet1.xml"].replace(b"<c r=\"A2\"><v>45293", b"<c r=\"A2\" s=\"1\"><v>45293")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for n, b in parts.items():
            z.writestr(n, b)
    assert list(iter_rows(out.getvalue()))[1] == ["2024-01-02"]


def test_plain_sheets_read_as_by_the_xml_parser(monkeypatch):
    import random

    from strata.sources import xlsx

    def by_parser(data):
        with monkeypatch.context() as m:
            m.setattr(xlsx, "_PLAIN_ROW", re.compile("(?!)"))
            return list(iter_rows(data))

    rng = random.Random(7)
    plain, odd = [None, "", "a", "  b ", "é漢", 1, 2.5, True], ["x&y", "<t>", "]]>", "l\nm"]
    for values in (plain, plain + odd):
        for n in (0, 1, 30, 3000):
            rows = [[rng.choice(values) for _ in range(rng.randint(0, 5))] for _ in range(n)]
            data = workbook_bytes(["a", "b"], rows)
            assert list(iter_rows(data)) == by_parser(data)
            text = [[("TRUE" if v else "FALSE") if isinstance(v, bool) else v if v is None else str(v) for v in r] for r in rows]
            for r in text:
                while r and r[-1] is None:
                    r.pop()
            assert list(iter_rows(data))[1:] == text
    # plain rows make no parser events: only the elements around them do
    started = []
    monkeypatch.setattr(xlsx._Sheet, "_start", lambda self, name, attributes: started.append(name))
    data = workbook_bytes(["a", "b"], [["x", 1]] * 50)
    assert len(list(iter_rows(data))) == 51 and len(started) == 2


def test_a_sheet_that_stops_being_plain_gives_every_row_once():
    rows = [[f"r{i}", "x" * 100] for i in range(2000)] + [["a&b", "z"]] + [["last", "w"]] * 3
    assert list(iter_rows(workbook_bytes(["a", "b"], rows)))[1:] == rows
    cut = workbook_bytes(["a"], [["x"]] * 20)
    with zipfile.ZipFile(io.BytesIO(cut)) as z:
        parts = {n: z.read(n) for n in z.namelist()}
    parts["xl/worksheets/sheet1.xml"] = parts["xl/worksheets/sheet1.xml"].replace(b"</sheetData>", b"")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for n, b in parts.items():
            z.writestr(n, b)
    with pytest.raises(SyntaxError):
        list(iter_rows(out.getvalue()))


def test_collection_reader_needs_its_connector(spark):
    from strata.sources.databases import ConnectorMissingError, collection_options, read_collection

    uri = documents_uri("h", 27017, "u", "p", "db", auth_source="admin")
    assert collection_options(uri, "db", "product") == {
        "connection.uri": "mongodb://u:p@h:27017/db?authSource=admin",
        "database": "db",
        "collection": "product",
    }
    with pytest.raises(ConnectorMissingError):
        read_collection(spark, uri, "db", "product", query={"product_id": 2})


def test_csv_keeps_malformed_lines(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("k,v\n1,a\nnot-a-number,b\n")
    rows = read_csv(spark, str(p), "k int, v string", corrupt_column="_bad").collect()
    got = [(r.k, r.v, r._bad) for r in rows]
    assert (1, "a", None) in got and any(b == "not-a-number,b" for _, _, b in got)


def test_text_without_header(spark, tmp_path):
    (tmp_path / "t.txt").write_text("1|x\n2|y\n3\n")
    got = sorted(map(tuple, read_txt(spark, str(tmp_path / "t.txt"), columns=["k", "s"], header=False).collect()))
    assert got == [("1", "x"), ("2", "y"), ("3", None)]
    (tmp_path / "u.txt").write_text("1|x\n2|y|extra\n3\n")
    with pytest.raises(Exception, match="more than 2 fields: 2\\|y\\|extra"):  # fields are not dropped
        read_txt(spark, str(tmp_path / "u.txt"), columns=["k", "s"], header=False).collect()


def test_nested_field_filter(spark):
    df = spark.createDataFrame([("a", (1, "x")), ("b", (2, "y"))], "_id string, meta struct<n:int, s:string>")
    assert ids(find(df, {"meta.n": {"$gt": 1}})) == ["b"]
    assert find(df, {"meta.s": "x"}, projection={"meta.s": 1}).columns == ["_id", "meta.s"]


def test_documents_from_a_list_of_dicts(spark):
    import datetime as _dt

    class Oid:
        def __init__(self, h):
            self.h = h

        def __str__(self):
            return self.h

    schema = T.StructType(
        [
            T.StructField("_id", T.StringType()),
            T.StructField("product_id", T.LongType()),
            T.StructField("updated", T.TimestampNTZType()),
            T.StructField("missing", T.StringType()),
        ]
    )
    docs = [
        {"updated": _dt.datetime(2024, 10, 17, 9, 30), "_id": Oid("67118a28"), "product_id": 2, "extra": [1, 2]},
        {"_id": Oid("67118a29"), "product_id": 5, "updated": None},
    ]
    got = sorted(map(tuple, documents_to_df(docs, schema, spark=spark).collect()), key=str)
    assert got == [("67118a28", 2, _dt.datetime(2024, 10, 17, 9, 30), None), ("67118a29", 5, None, None)]


def test_filter_on_a_field_the_frame_lacks(docs):
    assert ids(find(docs, {"nope": None})) == ["a", "b", "c"]
    assert ids(find(docs, {"nope": 5})) == []
    assert ids(find(docs, {"nope": {"$exists": False}})) == ["a", "b", "c"]
    assert ids(find(docs, {"nope": {"$ne": 5}, "n": 1})) == ["a"]
    assert count_documents(docs, {"nope": {"$gt": 1}}).first()["count"] == 0


def test_text_headers_go_by_position(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "1.txt").write_text("a|b\n1|x\na|b\n|\n")
    (tmp_path / "t" / "2.txt").write_text("a|b\n2|\n")
    got = sorted(map(tuple, read_txt(spark, str(tmp_path / "t")).collect()), key=str)
    assert got == sorted([("1", "x"), ("a", "b"), ("2", None), (None, None)], key=str)  # an equal data row stays
    (tmp_path / "t" / "3.txt").write_text("b|a\n3|y\n")
    with pytest.raises(Exception, match="header"):
        read_txt(spark, str(tmp_path / "t")).collect()


def test_workbooks_by_name_and_nothing_dropped(spark, tmp_path):
    d = tmp_path / "w"
    d.mkdir()
    (d / "1.xlsx").write_bytes(workbook_bytes(["a", "b", "c"], [["a1", "b1", None], [None, None, None]]))
    (d / "2.xlsm").write_bytes(workbook_bytes(["b", "a"], [["b9", "a9"]]))
    (d / "~$1.xlsx").write_bytes(b"lock")
    got = sorted(map(tuple, read_xlsx(spark, str(d)).collect()))
    assert got == [("a1", "b1", None), ("a9", "b9", None)]
    for name, data in [
        ("extra", workbook_bytes(["a", "b", "c"], [["a2", "b2", None, "EXTRA"]])),
        ("unknown", workbook_bytes(["a", "z"], [["1", "2"]])),
        ("twice", workbook_bytes(["a", "a"], [["1", "2"]])),
        ("text", b"no workbook"),
    ]:
        bad = tmp_path / name
        bad.mkdir()
        (bad / "1.xlsx").write_bytes(workbook_bytes(["a", "b", "c"], [["a1", "b1", "c1"]]))
        (bad / "2.xlsx").write_bytes(data)
        with pytest.raises(Exception, match=WorkbookError.__name__):
            read_xlsx(spark, str(bad)).collect()


def test_workbook_fixture_splits_files(spark, tmp_path):
    write_xlsx(spark.range(25).selectExpr("cast(id as string) id", "'x' v").coalesce(1), str(tmp_path / "o"), rows_per_file=10)
    assert len(list((tmp_path / "o").iterdir())) == 3
    assert read_xlsx(spark, str(tmp_path / "o")).count() == 25


def test_aware_datetimes_are_instants(spark):
    import datetime as _dt

    df = spark.createDataFrame([("a", _dt.datetime(2024, 1, 1)), ("b", _dt.datetime(2023, 12, 31, 17))], "_id string, ts timestamp_ntz")
    aware = _dt.datetime(2024, 1, 1, tzinfo=_dt.timezone(_dt.timedelta(hours=7)))
    assert ids(find(df, {"ts": aware})) == ["b"]
    assert ids(find(df, {"ts": {"$gt": aware}})) == ["a"]
    assert ids(find(df, {"ts": {"$in": [_dt.datetime(2024, 1, 1)]}})) == ["a"]


def test_empty_and_missing_nested_fields(spark):
    df = spark.createDataFrame([("a", (1, "x"))], "_id string, meta struct<n:int, s:string>")
    for op in ("$and", "$or", "$nor"):
        with pytest.raises(ValueError, match="at least one"):
            find(df, {op: []})
    assert ids(find(df, {"meta.gone": None})) == ["a"]
    assert ids(find(df, {"meta.gone.deeper": {"$gt": 1}})) == []
    assert ids(find(df, {"meta.gone": {"$exists": False}, "meta.n": 1})) == ["a"]


def test_id_filter_reaches_the_source(spark, tmp_path):
    p = tmp_path / "d.json"
    p.write_text('{"_id": {"$oid": "65f0"}, "a": "1"}\n{"_id": "plain", "a": "2"}\n{"_id": {"$oid": "65f1"}, "a": "3"}\n')
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("_id", "a")])
    one = read_documents(spark, str(p), schema, {"_id": "65f0"})
    assert [tuple(r) for r in one.collect()] == [("65f0", "1")]
    assert "PushedFilters: [In(_id" in one._jdf.queryExecution().executedPlan().toString()
    several = read_documents(spark, str(p), schema, {"_id": {"$in": ["plain", "65f1", "none"]}, "a": "3"})
    assert [r.a for r in several.collect()] == ["3"]


def test_find_one_may_stop_early(spark):
    from strata.operators.find import find_one

    df = spark.range(100).selectExpr("cast(id as string) _id", "id % 3 n")
    assert find_one(df, {"n": 1}).first()["_id"] == "1"
    early = find_one(df, {"n": 1}, any_match=True)
    assert early.first()["n"] == 1 and early.count() == 1
    assert "TakeOrdered" not in early._jdf.queryExecution().executedPlan().toString()
    assert find_one(df, {"n": 9}, any_match=True).count() == 0
