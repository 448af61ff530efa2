"""Session-level helpers: scratch locations, temporary conf, unique names.

Nothing here creates a session; every function takes the caller's one.
"""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and scratch tables.

    Read from ``spark.checkpoint.dir`` (the cluster's shared folder). Only a
    local session that has none gets a folder of its own; on a cluster a
    folder of the driver would not be seen by the executors, so that raises.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared scratch root (never reused)."""
    return "/".join([checkpoint_root(spark), "strata", *parts, uuid.uuid4().hex])


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a scratch folder on whatever file system it lies."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(target, True))


@contextlib.contextmanager
def staged_rows(df: DataFrame):
    """A frame that feeds several jobs, written once to the shared scratch
    folder; the copy goes when the block ends."""
    spark = df.sparkSession
    path = scratch_path(spark, "rows")
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_path(spark, path)


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def conf(spark: SparkSession, **settings: str):
    """Set SQL confs for the duration of a block and restore them after.

    Keys use ``__`` for dots, e.g. ``spark__sql__sources__partitionOverwriteMode``;
    plain dotted keys can be passed through ``**{"a.b": v}``.
    """
    keys = {k.replace("__", "."): str(v) for k, v in settings.items()}
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session zone. Every timestamp the library writes is
    ``timestamp_ntz`` already, so this only matters for callers' own casts."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def drop_scratch_database(spark: SparkSession, name: str) -> None:
    """Drop a scratch database with its tables and their files."""
    location = spark.catalog.getDatabase(name).locationUri
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")
    remove_path(spark, location)


def scratch_database(spark: SparkSession, prefix: str = "strata") -> str:
    """Create a database whose location is a fresh folder under the shared
    scratch root, so nothing lands in the driver's working directory."""
    name = unique_name(prefix)
    location = scratch_path(spark, "db")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{location}'")
    return name
