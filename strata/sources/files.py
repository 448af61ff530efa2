"""Delimited and text file scans (S2, S3) and table / SQL sources."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import quote
from strata.operators.schema import free_name


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | str | None = None,
    header: bool = True,
    sep: str = ",",
    corrupt_column: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Delimited files, split by Spark per file block.

    Without a schema every column is text named from the header (no
    inference pass over the data). With ``corrupt_column`` the schema gets a
    string field that keeps malformed lines (PERMISSIVE mode) instead of
    failing the job."""
    reader = spark.read.option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
    if schema is not None:
        if corrupt_column:
            st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
            schema = T.StructType([*st.fields, T.StructField(corrupt_column, T.StringType())])
            reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
        reader = reader.schema(schema)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.csv(list(paths) if not isinstance(paths, str) else paths)


def read_txt(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str = "|",
    columns: Sequence[str] | None = None,
    header: bool = True,
) -> DataFrame:
    """S3: text lines split on a separator into string columns.

    With ``header`` the first line of a file names the columns (one line to the
    driver) and the first line of **every** file is its header: it is dropped by
    position, so a data row with the same text stays, and a file whose header
    has other names or another order fails the read. An empty or missing field
    is NULL; quotes have no meaning; a line with more fields than columns fails the read."""
    paths = list(paths) if not isinstance(paths, str) else paths
    names = list(columns) if columns is not None else None
    if header:
        first = spark.read.text(paths).first()
        found = first[0].split(sep) if first is not None and first[0] else []
        names = names or found
        if len(names) < len(found):
            raise ValueError(f"{len(found)} columns in the header, {len(names)} names given")
        found += names[len(found):]
    elif names is None:
        raise ValueError("columns are required when the files have no header")
    else:
        found = names
    line = free_name("line", found, names)
    reader = (
        spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in [*found, line]]))
        .option("columnNameOfCorruptRecord", line)  # holds a line with too few or too many fields
        .option("sep", sep)
        .option("quote", "")
        .option("header", header)
        .option("enforceSchema", not header)  # compare each file's header with the names
        .option("columnPruning", False)  # a pruned parser does not count the fields
        .option("mode", "PERMISSIVE")
    )
    df = reader.csv(paths).toDF(*names, line)
    fields = F.size(F.split(F.col(quote(line)), re.escape(sep), -1))
    # Names the first field too, as Spark does not read the line column alone.
    start = F.coalesce(F.col(quote(names[0])), F.lit(""))
    message = F.concat(F.lit(f"more than {len(names)} fields: "), F.left(F.col(quote(line)), F.lit(200)), F.lit(" (first field: "), start, F.lit(")"))
    # A filter, so that it is evaluated whatever columns are read.
    return df.filter(F.when(fields > len(names), F.raise_error(message)).otherwise(F.lit(True))).drop(line)


def read_table(
    spark: SparkSession,
    name: str,
    columns: Sequence[str] | None = None,
    where: str | None = None,
) -> DataFrame:
    """A catalog table; column list and predicate are pruned and pushed
    into the scan by Catalyst."""
    df = spark.table(name)
    if where:
        df = df.filter(where)
    return df.select(*columns) if columns else df


def read_sql(
    spark: SparkSession,
    sql: str,
    views: Mapping[str, DataFrame] | None = None,
    args: Mapping[str, object] | None = None,
) -> DataFrame:
    """Run SQL text after registering frames as temp views;
    ``args`` are bound as named parameters (``:name``)."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql, args=dict(args)) if args else spark.sql(sql)


def write_text(df: DataFrame, path: str, sep: str = "|", header: bool = True) -> None:
    """Write columns as separated text lines, one header line per output
    file (the counterpart of ``read_txt``; no quoting)."""
    (
        df.write.mode("errorifexists")
        .option("header", header)
        .option("sep", sep)
        .option("quote", "")
        .option("nullValue", "")
        .csv(path)
    )
