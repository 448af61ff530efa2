"""Relational sources over JDBC (S4-S6) and document collections.

Spark's JDBC source owns the connections: it opens one per read partition
on the executors and pushes projections and filters into the query. This
module only validates options (the same messages as the original
connectors) and builds the URL and properties.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import quote_plus

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.find import find


class MissingCredentialsError(ValueError):
    """A required connection option is empty."""


# Display names, JDBC drivers and default ports per kind.
DISPLAY_NAMES = {
    "postgresql": "PostgreSQL",
    "mysql": "MySQL",
    "sqlserver": "SQL Server",
    "mongodb": "MongoDB",
}
DRIVERS = {
    "postgresql": "org.postgresql.Driver",
    "mysql": "com.mysql.cj.jdbc.Driver",
    "sqlserver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
}
DEFAULT_PORTS = {"mysql": 3306, "sqlserver": 1433}
DEFAULT_SSLMODE = "require"


def check_credentials(kind: str, **fields: object) -> None:
    """Raise ``MissingCredentialsError`` naming every empty field, in the
    order given, e.g. ``Missing PostgreSQL credentials: password``."""
    missing = [k for k, v in fields.items() if not v]
    if missing:
        raise MissingCredentialsError(f"Missing {DISPLAY_NAMES[kind]} credentials: {', '.join(missing)}")


@dataclass(frozen=True)
class JdbcSpec:
    url: str
    properties: dict[str, str]


def jdbc_spec(
    kind: str,
    host: str,
    db: str,
    user: str,
    password: str,
    port: int | None = None,
    sslmode: str | None = None,
    ssl_ca: str | None = None,
    ssl_cert: str | None = None,
    ssl_key: str | None = None,
) -> JdbcSpec:
    """URL and connection properties for one database kind.

    * PostgreSQL: ``sslmode`` goes into the URL.
    * MySQL: TLS only when CA, certificate and key are all given.
    * SQL Server: each TLS file is taken on its own; any of them turns
      encryption on.
    """
    if kind not in DRIVERS:
        raise ValueError(f"unknown database kind {kind!r}")
    port = port if port is not None else DEFAULT_PORTS.get(kind)
    check_credentials(kind, host=host, db=db, user=user, password=password, port=port)
    props = {"user": user, "password": password, "driver": DRIVERS[kind]}
    if kind == "postgresql":
        url = f"jdbc:postgresql://{host}:{port}/{db}"
        if sslmode:
            url += f"?sslmode={sslmode}"
    elif kind == "mysql":
        url = f"jdbc:mysql://{host}:{port}/{db}"
        if ssl_ca and ssl_cert and ssl_key:
            props.update(
                {
                    "sslMode": "VERIFY_CA",
                    "trustCertificateKeyStoreUrl": f"file:{ssl_ca}",
                    "clientCertificateKeyStoreUrl": f"file:{ssl_cert}",
                    "clientKeyUrl": f"file:{ssl_key}",
                }
            )
    else:
        url = f"jdbc:sqlserver://{host}:{port};databaseName={db}"
        if ssl_ca or ssl_cert or ssl_key:
            props["encrypt"] = "true"
        if ssl_ca:
            props["serverCertificate"] = ssl_ca
        if ssl_cert:
            props["clientCertificate"] = ssl_cert
        if ssl_key:
            props["clientKey"] = ssl_key
    return JdbcSpec(url, props)


def read_jdbc(
    spark: SparkSession,
    spec: JdbcSpec,
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    lower_bound: object = None,
    upper_bound: object = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Read a table or query. With ``partition_column`` and bounds the read
    is split into ``num_partitions`` range queries run in parallel on the
    executors; without them it is a single connection."""
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    reader = spark.read.format("jdbc").option("url", spec.url).option("fetchsize", fetch_size)
    for k, v in spec.properties.items():
        reader = reader.option(k, v)
    if query is not None:
        if partition_column:
            # partitioned reads need a relation: wrap the query
            reader = reader.option("dbtable", f"({query}) q")
        else:
            reader = reader.option("query", query)
    else:
        reader = reader.option("dbtable", table)
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned reads need lower_bound, upper_bound and num_partitions")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", int(num_partitions))
        )
    return reader.load()


def read_database(
    spark: SparkSession,
    kind: str,
    host: str,
    db: str,
    user: str,
    password: str,
    port: int | None = None,
    table: str | None = None,
    query: str | None = None,
    **options,
) -> DataFrame:
    """S4-S6 in one call: validate, build the URL and read."""
    tls = {k: options.pop(k) for k in ("sslmode", "ssl_ca", "ssl_cert", "ssl_key") if k in options}
    if kind == "postgresql":
        tls.setdefault("sslmode", DEFAULT_SSLMODE)
    spec = jdbc_spec(kind, host, db, user, password, port, **tls)
    return read_jdbc(spark, spec, table=table, query=query, **options)


# --- documents ----------------------------------------------------------------


def documents_uri(
    host: str,
    port: int,
    user: str,
    password: str,
    db_name: str,
    auth_source: str | None = None,
    ssl: bool = False,
    ssl_ca: str | None = None,
) -> str:
    """Connection URI of a document store (checked like the others)."""
    check_credentials("mongodb", host=host, db_name=db_name, user=user, password=password, port=port)
    uri = f"mongodb://{quote_plus(user)}:{quote_plus(password)}@{host}:{port}/{db_name}"
    params = []
    if auth_source:
        params.append(f"authSource={auth_source}")
    if ssl:
        params.append("tls=true")
    if ssl_ca:
        params.append(f"tlsCAFile={ssl_ca}")
    return uri + ("?" + "&".join(params) if params else "")


# Fixed value: the data source name and provider class of the document-store
# Spark connector (10.x).
COLLECTION_FORMAT = "mongodb"
COLLECTION_PROVIDER = "com.mongodb.spark.sql.connector.MongoTableProvider"


class ConnectorMissingError(RuntimeError):
    """The Spark connector for a source is not on the class path."""


def collection_options(uri: str, database: str, collection: str) -> dict[str, str]:
    return {"connection.uri": uri, "database": database, "collection": collection}


def read_collection(
    spark: SparkSession,
    uri: str,
    database: str,
    collection: str,
    schema: T.StructType | None = None,
    query: Mapping | None = None,
    projection: Mapping | None = None,
    limit: int = 0,
    skip_none: bool = False,
    id_field: str = "_id",
) -> DataFrame:
    """S7 against a live collection through the document store's Spark
    connector: partitions are read in parallel by the executors and the
    compiled filter is pushed to the server by the connector. Raises
    ``ConnectorMissingError`` when the connector jar is absent."""
    try:
        # the context class loader also sees jars added to the running session
        loader = spark.sparkContext._jvm.java.lang.Thread.currentThread().getContextClassLoader()
        loader.loadClass(COLLECTION_PROVIDER)
    except Exception as e:  # noqa: BLE001 - py4j wraps the JVM error
        raise ConnectorMissingError(
            f"the '{COLLECTION_FORMAT}' Spark connector is not on the class path; "
            "add it with spark.jars.packages, or export the collection as JSON lines "
            "and use read_documents"
        ) from e
    reader = spark.read.format(COLLECTION_FORMAT).options(**collection_options(uri, database, collection))
    if schema is not None:
        reader = reader.schema(schema)
    df = normalise_id(raw_id_filter(reader.load(), query, id_field), id_field)
    return find(df, query, projection, limit, skip_none=skip_none, id_field=id_field)


def normalise_id(df: DataFrame, id_field: str = "_id") -> DataFrame:
    """Document ids as plain strings: an extended-JSON ``{"$oid": ...}``
    object (read as text) is reduced to its hex value."""
    if id_field not in df.columns:
        return df
    raw = F.col(id_field).cast("string")
    oid = F.get_json_object(raw, "$.$oid")
    return df.withColumn(id_field, F.coalesce(oid, raw))


def raw_id_filter(df: DataFrame, query: Mapping | None, id_field: str = "_id") -> DataFrame:
    """Rows whose **raw** id can be the one asked for: an ``{id: text}`` or ``$in`` filter on the id,
    in the forms the store exports it (plain text, or an ``{"$oid": ...}`` object).

    ``normalise_id`` computes the id, so a filter after it never reaches the source; this one compares
    the stored column and does. It only narrows: the exact filter still follows."""
    want = (query or {}).get(id_field)
    if isinstance(want, Mapping) and set(want) == {"$in"}:
        want = list(want["$in"])
    elif isinstance(want, Mapping) and set(want) == {"$eq"}:
        want = [want["$eq"]]
    elif isinstance(want, str):
        want = [want]
    if not isinstance(want, list) or not all(isinstance(x, str) for x in want) or id_field not in df.columns:
        return df
    if not isinstance(df.schema[id_field].dataType, T.StringType):
        return df
    forms = [f for x in want for f in (x, '{"$oid":"%s"}' % x, '{"$oid": "%s"}' % x)]
    return df.filter(F.col(id_field).isin(forms))


def read_documents(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | str | None = None,
    query: Mapping | None = None,
    projection: Mapping | None = None,
    limit: int = 0,
    skip_none: bool = False,
    id_field: str = "_id",
) -> DataFrame:
    """A document collection exported as JSON lines, read in parallel.

    Fields are matched **by name**: a missing field is NULL and an extra
    field is dropped. Without a schema Spark infers one (a full pass). The
    filter is compiled to a Column and pushed down like any other."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    raw = reader.json(list(paths) if not isinstance(paths, str) else paths)
    df = normalise_id(raw_id_filter(raw, query, id_field), id_field)
    return find(df, query, projection, limit, skip_none=skip_none, id_field=id_field)


def _doc_json(doc: Mapping) -> str:
    import datetime as _dt
    import json

    def default(v):
        if isinstance(v, (_dt.datetime, _dt.date)):
            return v.isoformat()
        return str(v)  # object ids and other scalar wrappers

    return json.dumps(doc, default=default)


def documents_to_df(
    docs: DataFrame | Sequence[Mapping],
    schema: T.StructType,
    column: str = "value",
    id_field: str = "_id",
    spark: SparkSession | None = None,
) -> DataFrame:
    """Documents to typed columns, matched by name.

    ``docs`` is a frame of JSON documents (one per row, e.g. from
    ``spark.read.text``), or a list of dicts a caller already holds (a small
    result of a document query); the list is serialised to JSON and parsed
    by the same expression, so both paths give the same rows."""
    if not isinstance(docs, DataFrame):
        from pyspark.sql import SparkSession as _S

        session = spark or _S.getActiveSession()
        docs = session.createDataFrame([(_doc_json(d),) for d in docs], f"{column} string")
    fields = schema
    if id_field in schema.fieldNames():
        # read the id as text so an {"$oid": ...} object survives parsing
        fields = T.StructType(
            [T.StructField(f.name, T.StringType()) if f.name == id_field else f for f in schema.fields]
        )
    parsed = docs.select(F.from_json(F.col(column), fields).alias("d")).select("d.*")
    return normalise_id(parsed, id_field).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    )
