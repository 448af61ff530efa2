import datetime as dt
import glob

from pyspark.sql import functions as F

from strata.sinks.tables import (
    compact_partitions,
    last_load,
    load_partitioned,
    load_table,
    staged_table,
    table_exists,
    table_location,
)


def test_load_table_create_merge_idempotent(spark, db):
    name = f"{db}.t"
    src = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    r1 = load_table(spark, name, src, keys="k")
    assert (r1.operation, r1.rows) == ("create", 2)
    upd = spark.createDataFrame([(2, "B"), (3, "c")], "k long, v string")
    r2 = load_table(spark, name, upd, keys="k")
    assert (r2.operation, r2.updated, r2.inserted) == ("merge", 1, 1)
    r3 = load_table(spark, name, upd, keys="k")
    assert (r3.updated, r3.inserted) == (2, 0)  # same batch again: nothing inserted
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, "a"), (2, "B"), (3, "c")]
    h = last_load(spark, name).first()
    assert (h.operation, h.rows_updated, h.rows_inserted) == ("merge", 2, 0)


def test_first_load_keeps_duplicates_and_non_unique_appends(spark, db):
    name = f"{db}.log"
    dup = spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string")
    assert load_table(spark, name, dup, keys="k").operation == "create"
    assert load_table(spark, name, dup, keys="k").operation == "append"
    assert spark.table(name).count() == 4


def test_append_adds_new_column(spark, db):
    name = f"{db}.evo"
    load_table(spark, name, spark.createDataFrame([(1, "a")], "k long, v string"))
    load_table(spark, name, spark.createDataFrame([(2, 7)], "k long, extra int"))
    rows = sorted(map(tuple, spark.table(name).collect()), key=lambda r: r[0])
    assert spark.table(name).columns == ["k", "v", "extra"]
    assert rows == [(1, "a", None), (2, None, 7)]


def test_errors_propagate_instead_of_overwrite(spark, db):
    name = f"{db}.guard"
    load_table(spark, name, spark.createDataFrame([(1, "a")], "k long, v string"), keys="k")
    bad = spark.createDataFrame([(1,)], "other long")
    try:
        load_table(spark, name, bad, keys="k")
    except Exception:
        pass
    assert table_exists(spark, name) and spark.table(name).count() == 1


def _events(spark):
    return spark.createDataFrame(
        [
            (1, dt.datetime(2024, 1, 1, 10), 1.0),
            (2, dt.datetime(2024, 1, 2, 10), 2.0),
            (3, None, 3.0),
        ],
        "id long, ts timestamp_ntz, v double",
    )


def test_partitioned_upsert_moves_and_null_partition(spark, db):
    name = f"{db}.daily"
    load_partitioned(spark, name, _events(spark), keys=["id"], order_by=["ts"], date_col="ts")
    batch = spark.createDataFrame(
        [
            (1, dt.datetime(2024, 1, 1, 11), 10.0),  # same day: update
            (2, dt.datetime(2024, 1, 3, 9), 20.0),  # moved day: inserted, old row stays (K5)
            (4, None, 4.0),  # NULL partition: inserted, old NULL row kept
            (5, dt.datetime(2024, 1, 5, 1), 5.0),
            (5, dt.datetime(2024, 1, 5, 2), 6.0),  # de-duplicated: latest wins
        ],
        "id long, ts timestamp_ntz, v double",
    )
    res = load_partitioned(spark, name, batch, keys=["id"], order_by=["ts"], date_col="ts")
    assert (res.updated, res.inserted) == (1, 3)
    got = sorted((r.id, r.v) for r in spark.table(name).collect())
    assert got == [(1, 10.0), (2, 2.0), (2, 20.0), (3, 3.0), (4, 4.0), (5, 6.0)]


def test_compact_keeps_rows_and_reduces_files(spark, db):
    name = f"{db}.frag"
    base = spark.range(400).select(
        F.col("id"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 4).cast("int")).alias("d")
    )
    for i in range(4):
        part = base.filter(F.col("id") % 4 == i).repartition(4)
        load_table(spark, name, part) if i == 0 else __import__("strata.sinks.tables", fromlist=["x"]).append_table(spark, name, part)
    loc = table_location(spark, name).replace("file:", "")
    before = len(glob.glob(f"{loc}/**/*.parquet", recursive=True))
    assert compact_partitions(spark, name) == 400
    loc = table_location(spark, name).replace("file:", "")
    after = len(glob.glob(f"{loc}/**/*.parquet", recursive=True))
    assert spark.table(name).count() == 400 and after < before


def test_staged_table_is_dropped(spark, db):
    with staged_table(spark, spark.range(3), f"{db}.stage") as name:
        assert spark.table(name).count() == 3
    assert not table_exists(spark, f"{db}.stage")


def test_merge_strategy_follows_measured_size(spark, db):
    from strata.session import conf

    for limit in ("10MB", "-1"):
        name = f"{db}.strategy_{'b' if limit != '-1' else 'f'}"
        with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": limit}):
            load_table(spark, name, spark.range(100).withColumn("v", F.lit("a")), keys="id")
            r = load_table(spark, name, spark.range(90, 120).withColumn("v", F.lit("b")), keys="id")
        assert (r.updated, r.inserted) == (10, 20)
        assert spark.table(name).count() == 120


def test_vacuum_keeps_current_and_previous(spark, db):
    import os

    from strata.sinks.tables import vacuum_versions

    name = f"{db}.versions"
    for i in range(4):
        load_table(spark, name, spark.range(10).withColumn("v", F.lit(i)), keys="id")
    current = table_location(spark, name).replace("file:", "").rstrip("/")
    home = current.rsplit("/", 1)[0]
    assert len([d for d in os.listdir(home)]) == 4
    deleted = vacuum_versions(spark, name, keep_previous=1)
    assert len(deleted) == 2 and sorted(os.listdir(home)).count(current.rsplit("/", 1)[1]) == 1
    assert len(os.listdir(home)) == 2
    assert {r.v for r in spark.table(name).collect()} == {3}


def test_partitioned_upsert_on_keys_only_moves_rows(spark, db):
    name = f"{db}.daily_keys"
    load_partitioned(spark, name, _events(spark), keys=["id"], order_by=["ts"], date_col="ts")
    batch = spark.createDataFrame(
        [(2, dt.datetime(2024, 1, 3, 9), 20.0), (9, dt.datetime(2024, 1, 4, 9), 9.0)],
        "id long, ts timestamp_ntz, v double",
    )
    res = load_partitioned(
        spark, name, batch, keys=["id"], order_by=["ts"], date_col="ts", match_partition=False
    )
    assert (res.updated, res.inserted) == (1, 1)
    got = sorted((r.id, r.v, str(r.ts_Partition)) for r in spark.table(name).collect())
    # id 2 left 2024-01-02 (now empty) for 2024-01-03
    assert got == [(1, 1.0, "2024-01-01"), (2, 20.0, "2024-01-03"), (3, 3.0, "None"), (9, 9.0, "2024-01-04")]
    parts = {str(r[0]) for r in spark.table(name).select("ts_Partition").distinct().collect()}
    assert "2024-01-02" not in parts


def test_compact_selected_partitions_and_guards(spark, db):
    from strata.sinks.tables import append_table, merge_into

    name = f"{db}.sel"
    base = spark.range(40).select("id", (F.col("id") % 2).alias("p"))
    load_table(spark, name, base.filter("p = 0"))
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('note' = 'unpartitioned')")
    assert compact_partitions(spark, name) == 20
    pname = f"{db}.psel"
    dated = base.withColumn("d", F.date_add(F.lit("2024-01-01").cast("date"), F.col("p").cast("int")))
    load_partitioned(spark, pname, dated, keys=["id"], order_by=["id"], date_col="d")
    with pytest.raises(ValueError):
        merge_into(spark, pname, dated, ["id"])
    append_table(spark, pname, dated.withColumn("d_Partition", F.col("d")))
    assert compact_partitions(spark, pname, partitions=[dt.date(2024, 1, 1)]) == 40
    assert spark.table(pname).count() == 80


import pytest  # noqa: E402


def test_concurrent_partitioned_loads_keep_other_partitions(spark, db):
    """Two partitioned upserts in threads: neither may run as a static
    overwrite (which would clear the other partitions)."""
    import threading

    names = [f"{db}.conc_{i}" for i in range(2)]
    for n in names:
        load_partitioned(spark, n, _events(spark), keys=["id"], order_by=["ts"], date_col="ts")
    batch = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 12), 7.0)], "id long, ts timestamp_ntz, v double")
    errors = []

    def run(n):
        try:
            for _ in range(2):
                load_partitioned(spark, n, batch, keys=["id"], order_by=["ts"], date_col="ts", history=False)
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=run, args=(n,)) for n in names]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    for n in names:
        assert sorted((r.id, r.v) for r in spark.table(n).collect()) == [(1, 7.0), (2, 2.0), (3, 3.0)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def _filters(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if "PartitionFilters" in line]


@pytest.mark.parametrize("days", [3, 3000])
def test_touched_partitions_are_pruned(spark, tmp_path, days):
    """The target scan has a static partition filter for few and many dates."""
    from strata.sinks.tables import touched_partitions

    path = str(tmp_path / "t")
    day = F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int"))
    spark.range(8).select("id", day.alias("d")).write.partitionBy("d").parquet(path)
    batch = spark.range(days).select("id", day.alias("d"))
    target = spark.read.parquet(path)
    old = touched_partitions(target, batch, "d")
    pruned = [line for line in _filters(old) if ">= 2000-01-01" in line and "<= " in line]
    assert pruned
    assert old.count() == min(days, 8)
    assert touched_partitions(target, batch.limit(0), "d") is None


def test_plain_loads_do_not_shuffle(spark, db, monkeypatch):
    from strata.sinks import tables as T

    plans = []
    real = T._rows
    monkeypatch.setattr(T, "_rows", lambda obs, df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), real(obs, df))[1])
    hints = []
    monkeypatch.setattr(T, "write_balanced", lambda df, *cols: (hints.append(cols), df)[1])
    load_table(spark, f"{db}.plain", spark.range(5), history=False)
    load_table(spark, f"{db}.plain", spark.range(5), history=False)
    assert len(plans) == 2 and not any("Exchange" in p for p in plans) and not hints


def test_duplicate_source_keys_raise(spark, db):
    from strata.sinks.tables import merge_into

    name = f"{db}.dups"
    load_table(spark, name, spark.createDataFrame([(1, "a")], "k long, v string"))
    with pytest.raises(ValueError, match="several source rows"):
        merge_into(spark, name, spark.createDataFrame([(1, "b"), (1, "c")], "k long, v string"), ["k"])
    twice_null = spark.createDataFrame([(None, "b"), (None, "c"), (2, "d")], "k long, v string")
    assert merge_into(spark, name, twice_null, ["k"]).inserted == 3
    with pytest.raises(ValueError):
        merge_into(spark, name, twice_null, ["k"], null_safe=True)


@pytest.mark.parametrize("step", ["CREATE TABLE", "RECOVER", "RENAME TO", "second RENAME TO", "DROP TABLE"])
def test_crash_in_a_switch_loses_nothing(spark, db, monkeypatch, step):
    """Whichever catalog step fails, the retry ends with all rows."""
    name = f"{db}.crash"
    load_partitioned(spark, name, _events(spark), keys=["id"], order_by=["ts"], date_col="ts")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('owner_note' = 'it''s kept')")
    batch = spark.createDataFrame([(2, dt.datetime(2024, 1, 3, 9), 20.0), (9, None, 9.0)], "id long, ts timestamp_ntz, v double")

    def load():
        return load_partitioned(spark, name, batch, keys=["id"], order_by=["ts"], date_col="ts", match_partition=False)

    real, seen = type(spark).sql, []

    def failing(self, text, *a, **k):
        wanted = step.removeprefix("second ")
        if wanted in text and "__strata" in text and (wanted != "DROP TABLE" or "PREVIOUS" in text.upper()):
            seen.append(text)
            if len(seen) == (2 if step.startswith("second") or wanted == "DROP TABLE" else 1):
                raise RuntimeError("injected")
        return real(self, text, *a, **k)

    monkeypatch.setattr(type(spark), "sql", failing)
    try:
        with pytest.raises(RuntimeError, match="injected"):
            load()
    finally:
        monkeypatch.undo()
    load()
    got = sorted((r.id, r.v, str(r.ts_Partition)) for r in spark.table(name).collect())
    assert got == [(1, 1.0, "2024-01-01"), (2, 20.0, "2024-01-03"), (3, 3.0, "None"), (9, 9.0, "None")]
    props = {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert props.get("owner_note") == "it's kept"
    assert not [t.name for t in spark.catalog.listTables(db) if "__strata" in t.name]


def test_scratch_is_empty_after_loads(spark, db):
    import os

    from strata.session import checkpoint_root, drop_scratch_database, scratch_database

    own = scratch_database(spark, "gone")
    root = checkpoint_root(spark).replace("file:", "")

    def rows_and_staged():
        return {d: len(os.listdir(f"{root}/strata/{d}")) if os.path.isdir(f"{root}/strata/{d}") else 0 for d in ("rows", "staged")}

    before = rows_and_staged()
    for _ in range(2):
        load_table(spark, f"{own}.a", spark.range(9), keys="id")
        load_partitioned(spark, f"{own}.b", _events(spark), keys=["id"], order_by=["ts"], date_col="ts")
        with staged_table(spark, spark.range(3), f"{own}.stage"):
            pass
    assert rows_and_staged() == before
    place = spark.catalog.getDatabase(own).locationUri.replace("file:", "")
    drop_scratch_database(spark, own)
    assert not os.path.exists(place)


def test_history_is_compacted(spark, db, monkeypatch):
    from strata.sinks import tables as T

    monkeypatch.setattr(T, "HISTORY_FILES", 4)
    for i in range(9):
        load_table(spark, f"{db}.h", spark.range(i + 1))
    hist = f"{db}.{T.HISTORY_TABLE}"
    assert spark.table(hist).count() == 9 and len(spark.table(hist).inputFiles()) < 5


def test_no_local_scratch_on_a_cluster(spark):
    from strata.session import checkpoint_root

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return self

        def get(self, key, default=None):
            return default

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())
