"""Document-style filters over frames.

A filter dict in the document-store query language is compiled into one
Spark ``Column``; nothing is evaluated in Python, so Catalyst pushes the
predicate into the Parquet / JSON / JDBC scan like any other filter.

Supported: ``{field: value}`` (``None`` matches NULL), ``$eq $ne $gt $gte
$lt $lte $in $nin $exists $regex $not`` on a field, and top-level
``$and $or $nor``. Unknown operators raise ``ValueError``. As in the
document store, ``$ne`` and ``$nin`` also match a missing (NULL) field.
``$exists`` tests for non-NULL: a frame read with a schema has every field.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import quote


def _lit(v: Any) -> Column:
    if isinstance(v, _dt.datetime):
        # stored times are UTC wall clock: an aware time is that instant in UTC
        if v.tzinfo is not None:
            v = v.astimezone(_dt.UTC).replace(tzinfo=None)
        return F.lit(v.isoformat(sep=" ")).cast("timestamp_ntz")
    if isinstance(v, _dt.date):
        return F.lit(v.isoformat()).cast("date")
    return F.lit(v)


def _paths(schema: T.StructType, prefix: str = "") -> dict[str, T.DataType | None]:
    """Every field of a schema by its dotted path, nested structs included, with its type (None inside an array
    or a map, where a path stands for several values)."""
    out: dict[str, T.DataType | None] = {}
    for f in schema.fields:
        kind = f.dataType
        out[prefix + f.name] = kind
        inside = isinstance(kind, T.ArrayType)
        while isinstance(kind, T.ArrayType):  # a path may go through arrays of structs
            kind = kind.elementType
        if isinstance(kind, T.StructType):
            nested = _paths(kind, f"{prefix}{f.name}.")
            out |= dict.fromkeys(nested) if inside else nested
        elif isinstance(kind, (T.MapType, T.VariantType)):
            out[f"{prefix}{f.name}.*"] = None
    return out


def _field(name: str, columns: Mapping[str, T.DataType | None] | None = None) -> Column:
    """The field as a Column; a field the frame does not have, at the top or
    nested, is a missing value (NULL), as in a schemaless collection."""
    if columns is not None and name not in columns:
        parents = [name.rsplit(".", i)[0] for i in range(1, name.count(".") + 1)]
        if not any(f"{p}.*" in columns for p in parents):
            return F.lit(None)
    return F.col(".".join(quote(p) for p in name.split(".")))


def _fits(v: Any, kind: T.DataType | None) -> bool:
    """Whether a value can equal one of the field's type: in a document collection a number is never a text, however it
    is written. Fields of unknown or nested type are compared as they are."""
    if isinstance(kind, T.BooleanType):
        return isinstance(v, bool)
    if isinstance(kind, T.NumericType):
        return isinstance(v, (int, float, Decimal)) and not isinstance(v, bool)
    if isinstance(kind, T.StringType):
        return isinstance(v, str)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return isinstance(v, _dt.date)
    if isinstance(kind, T.BinaryType):
        return isinstance(v, (bytes, bytearray))
    return True


def _compare(col: Column, op: str, v: Any, kind: T.DataType | None) -> Column:
    if not _fits(v, kind):
        return F.lit(False)
    x = _lit(v)
    return {"$eq": lambda: col == x, "$gt": lambda: col > x, "$gte": lambda: col >= x, "$lt": lambda: col < x, "$lte": lambda: col <= x}[op]()


def _among(col: Column, values: Iterable[Any], kind: T.DataType | None) -> Column:
    fitting = [_lit(x) for x in values if x is not None and _fits(x, kind)]
    return col.isin(fitting) if fitting else F.lit(False)


def _matches(col: Column, pattern: str, kind: T.DataType | None) -> Column:
    return col.rlike(pattern) if _fits(pattern, kind) else F.lit(False)


def _field_ops(col: Column, spec: Mapping[str, Any], kind: T.DataType | None = None) -> Column:
    out: Column | None = None
    for op, v in spec.items():
        if op == "$eq":
            e = col.isNull() if v is None else _compare(col, op, v, kind)
        elif op == "$ne":
            e = col.isNotNull() if v is None else ~F.coalesce(_compare(col, "$eq", v, kind), F.lit(False))
        elif op in ("$gt", "$gte", "$lt", "$lte"):
            e = _compare(col, op, v, kind)
        elif op == "$in":
            e = _among(col, v, kind)
            if any(x is None for x in v):
                e = e | col.isNull()
        elif op == "$nin":
            e = ~F.coalesce(_among(col, v, kind), F.lit(False))
            if any(x is None for x in v):
                e = e & col.isNotNull()
        elif op == "$exists":
            e = col.isNotNull() if v else col.isNull()
        elif op == "$regex":
            e = _matches(col, v, kind)
        elif op == "$not":
            inner = _field_ops(col, v, kind) if isinstance(v, Mapping) else _matches(col, v, kind)
            e = ~F.coalesce(inner, F.lit(False))
        else:
            raise ValueError(f"unsupported operator {op}")
        out = e if out is None else out & e
    return out if out is not None else F.lit(True)


def compile_filter(
    query: Mapping[str, Any] | None,
    skip_none: bool = False,
    columns: Iterable[str] | Mapping[str, T.DataType | None] | T.StructType | None = None,
) -> Column:
    """Turn a filter dict into a Column (F2-F6, F11). An empty or missing
    filter matches everything; ``skip_none`` drops fields whose value is
    ``None`` (optional filters) instead of matching NULL. With ``columns``
    (the frame's schema, or field paths) a field the frame lacks counts as
    missing; with the schema a value of another type than the field's matches nothing (``$ne``, ``$nin`` and ``$not``
    match) instead of being converted. An empty ``$and``, ``$or`` or ``$nor`` is an error, as in the store."""
    if not query:
        return F.lit(True)
    cols = None
    if columns is not None:
        cols = _paths(columns) if isinstance(columns, T.StructType) else columns if isinstance(columns, Mapping) else dict.fromkeys(columns)
    out: Column | None = None
    for k, v in query.items():
        if k in ("$and", "$or", "$nor"):
            parts = [compile_filter(q, skip_none, cols) for q in v]
            if not parts:
                raise ValueError(f"{k} needs at least one filter")
            e = parts[0]
            for p in parts[1:]:
                e = (e & p) if k == "$and" else (e | p)
            if k == "$nor":
                e = ~F.coalesce(e, F.lit(False))
        elif k.startswith("$"):
            raise ValueError(f"unsupported operator {k}")
        elif v is None and skip_none:
            continue
        elif isinstance(v, Mapping) and any(str(x).startswith("$") for x in v):
            e = _field_ops(_field(k, cols), v, (cols or {}).get(k))
        else:
            e = _field_ops(_field(k, cols), {"$eq": v}, (cols or {}).get(k))
        out = e if out is None else out & e
    # A NULL predicate already drops the row; keeping the bare comparison
    # lets Catalyst push it into the scan.
    return out if out is not None else F.lit(True)


def _project(df: DataFrame, projection: Mapping[str, Any] | None, id_field: str) -> DataFrame:
    """include mode if any field other than the id is truthy; the id is
    kept unless explicitly excluded."""
    if not projection:
        return df
    include = [k for k, v in projection.items() if v and k != id_field]
    if include:
        keep_id = projection.get(id_field, 1) and id_field in df.columns
        cols = ([id_field] if keep_id else []) + include
        return df.select(*[_field(c).alias(c) for c in cols])
    drop = [k for k, v in projection.items() if not v]
    return df.drop(*drop)


def find(
    df: DataFrame,
    query: Mapping[str, Any] | None = None,
    projection: Mapping[str, Any] | None = None,
    limit: int = 0,
    skip_none: bool = False,
    id_field: str = "_id",
) -> DataFrame:
    """Rows matching ``query``; ``limit`` 0 means no limit (L1)."""
    out = _project(df.filter(compile_filter(query, skip_none, df.schema)), projection, id_field)
    return out.limit(limit) if limit and limit > 0 else out


def find_with_optional_filters(
    df: DataFrame,
    criteria: Mapping[str, Any],
    projection: Mapping[str, Any] | None = None,
    limit: int = 0,
    id_field: str = "_id",
) -> DataFrame:
    """like ``find`` but criteria whose value is ``None`` are ignored."""
    return find(df, criteria, projection, limit, skip_none=True, id_field=id_field)


def find_one(
    df: DataFrame,
    query: Mapping[str, Any] | None = None,
    projection: Mapping[str, Any] | None = None,
    id_field: str = "_id",
    any_match: bool = False,
) -> DataFrame:
    """F8: the matching row with the smallest id (a frame of 0 or 1 rows).
    Planned as a distributed top-1, so no partition is gathered. With
    ``any_match`` whichever match is found first will do, and the scan stops there."""
    matches = df.filter(compile_filter(query, columns=df.schema))
    if any_match:
        return _project(matches.limit(1), projection, id_field)
    first = matches.orderBy(F.col(quote(id_field)).asc_nulls_last()).limit(1)
    return _project(first, projection, id_field)


def find_by_id(
    df: DataFrame, doc_id: Any, projection: Mapping[str, Any] | None = None, id_field: str = "_id"
) -> DataFrame:
    """the row with this id (0 or 1 rows)."""
    return _project(df.filter(compile_filter({id_field: doc_id}, columns=df.schema)).limit(1), projection, id_field)


def count_documents(df: DataFrame, query: Mapping[str, Any] | None = None) -> DataFrame:
    """one-row frame with the number of matching rows."""
    return df.filter(compile_filter(query, columns=df.schema)).agg(F.count(F.lit(1)).alias("count"))
