import json

from pyspark.sql import types as T

from strata.streaming import stream_documents_partitioned

SCHEMA = T.StructType(
    [
        T.StructField("_id", T.StringType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("created", T.TimestampNTZType()),
        T.StructField("updated", T.TimestampNTZType()),
    ]
)


def _write(path, name, docs):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(json.dumps(d) for d in docs))


def test_stream_resumes_from_its_checkpoint(spark, db, tmp_path):
    src, ckpt = tmp_path / "in", str(tmp_path / "ckpt")
    table = f"{db}.products"
    _write(src, "a.json", [
        {"_id": {"$oid": "01"}, "product_id": 1, "unit_price": 1.0, "created": "2024-10-16T08:00:00", "updated": "2024-10-17T09:00:00"},
        {"_id": {"$oid": "02"}, "product_id": 2, "unit_price": 2.0, "created": "2024-10-16T08:00:00", "updated": None},
    ])
    args = dict(keys=["product_id"], order_by=["updated"], date_col="updated", fallback_date_col="created", checkpoint=ckpt)
    stream_documents_partitioned(spark, str(src), SCHEMA, table, **args)
    first = sorted((r.product_id, r.unit_price, str(r.updated_Partition)) for r in spark.table(table).collect())
    assert first == [(1, 1.0, "2024-10-17"), (2, 2.0, "2024-10-16")]  # NULL updated falls back to created

    stream_documents_partitioned(spark, str(src), SCHEMA, table, **args)  # nothing new: unchanged
    assert sorted((r.product_id, r.unit_price, str(r.updated_Partition)) for r in spark.table(table).collect()) == first

    _write(src, "b.json", [
        {"_id": {"$oid": "01"}, "product_id": 1, "unit_price": 1.5, "created": "2024-10-16T08:00:00", "updated": "2024-10-17T18:00:00"},
    ])
    stream_documents_partitioned(spark, str(src), SCHEMA, table, **args)
    got = sorted((r._id, r.product_id, r.unit_price) for r in spark.table(table).collect())
    assert got == [("01", 1, 1.5), ("02", 2, 2.0)]  # same day: updated in place
