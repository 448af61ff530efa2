"""Loads taken once, maintained gold and the key locator: results as of a full run, crashes at every step, folders left alone."""

import datetime as dt
import itertools
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from strata.operators.aggregate import account_summary
from strata.operators.state import account_spec, combine_state, partial_state
from strata.plans import incremental as I
from strata.plans import jobs
from strata.sinks import ledger, located, maintained
from strata.sinks.bucketed import find_keys, keyed_table
from strata.sinks.tables import load_partitioned, partition_columns, table_location

HEADERS = ["Account No", "DATE", "TRANSACTION DETAILS", "CHQ.NO.", "VALUE DATE", "WITHDRAWAL AMT", "DEPOSIT AMT", "BALANCE AMT", "."]


def raw(spark, rows):
    """(account, day or text, details, deposit, balance) rows as the source delivers them."""
    cells = [(f"{a}'", d, t, None, None, None, x, b, ".") for a, d, t, x, b in rows]
    return spark.createDataFrame(cells, ", ".join(f"`{h}` string" for h in HEADERS))


def some_loads(seed=4, n=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        rows = [(rng.randrange(1, 6), f"2024-01-{rng.randrange(1, 5):02d}", f"t{rng.randrange(3)}", "1.50", f"{rng.randrange(3)}.25") for _ in range(25)]
        out.append([*rows, (9, "not a date", f"load{i}", "1.00", "1.00")])
    return out


def full(loads):
    """Silver keys, gold rows and rejects of all loads by plain Python (a later load's equal row changes only its time)."""
    silver = {(str(a), d, t, x, b) for rows in loads.values() for a, d, t, x, b in rows if d[0] == "2"}
    gold = {}
    for a, d, _, x, b in silver:
        g = gold.setdefault(a, [0.0, "", []])
        g[0] += float(x)
        g[2].append((d, b))
    gold = {a: (g[0], max(g[2])[0], {b for d, b in g[2] if d == max(g[2])[0]}) for a, g in gold.items()}
    return silver, gold, sorted(t for rows in loads.values() for _, d, t, _, _ in rows if d[0] != "2")


def names(db):
    return [f"{db}.transactions_{x}" for x in ("raw", "clean", "datamart", "rejects")]


def compare(spark, db, loads):
    _, silver_t, gold_t, rejects_t = names(db)
    silver, gold, rejects = full(loads)
    got = [(r.AccountNo, str(r.Date), r.TransactionDetails, str(r.DepositAMT), str(r.BalanceAMT)) for r in spark.table(silver_t).collect()]
    assert len(got) == len(silver) and set(got) == silver
    rows = {r.AccountNo: r for r in keyed_table(spark, gold_t).collect()}
    assert set(rows) == set(gold)
    for a, (total, last, balances) in gold.items():
        assert float(rows[a].TotalDeposits) == total and str(rows[a].LastTransactionDate) == last and str(rows[a].NetBalance) in balances
    assert sorted(r.TransactionDetails for r in spark.table(rejects_t).collect()) == rejects


def test_loads_in_any_order_and_twice(spark, db):
    loads, now = {}, itertools.count(1)
    batches = some_loads()
    for i in (2, 0, 2, 1):  # load 2 is delivered again
        I.run_increment(spark, raw(spark, batches[i]), db, f"load-{i}", dt.datetime(2024, 2, next(now)), buckets=3)
        loads[i] = batches[i]
        compare(spark, db, loads)
    assert spark.table(names(db)[0]).count() == sum(map(len, batches))  # bronze is not doubled by the second delivery
    before = {t: spark.table(t).inputFiles() for t in names(db)}
    out = I.silver_increment(spark, names(db)[0], names(db)[1]), I.gold_increment(spark, names(db)[1], names(db)[2])
    assert [r.rows for r in out] == [0, 0] and before == {t: spark.table(t).inputFiles() for t in names(db)}


def test_a_crash_after_any_step_is_made_good(spark, db, monkeypatch):
    """Each run breaks off after another step; the next one takes up its loads and a new one, and the last is whole."""
    steps = [(I.ledger, "_append"), (I, "_replace_rejects"), (I, "load_partitioned"), (I.ledger, "record_changes"),
             (maintained, "replace_partitions"), (maintained, "load_bucketed"), (I.ledger, "mark_taken")]
    batches = some_loads(7, len(steps) + 1)
    for i, (module, step) in enumerate(steps):
        real = getattr(module, step)

        def crash(*a, real=real, **b):
            real(*a, **b)
            raise RuntimeError("crash")

        with monkeypatch.context() as m:
            m.setattr(module, step, crash)
            with pytest.raises(RuntimeError, match="crash"):
                I.run_increment(spark, raw(spark, batches[i]), db, str(i), dt.datetime(2024, 2, 1 + i), buckets=2)
    I.run_increment(spark, raw(spark, batches[-1]), db, "last", dt.datetime(2024, 2, 20), buckets=2)
    compare(spark, db, dict(enumerate(batches)))


def test_another_version_of_a_load_is_taken(spark, db):
    bronze = f"{db}.raw"
    rows = lambda *v: spark.createDataFrame([(x,) for x in v], "v string")
    ledger.land(spark, bronze, rows("a", "b"), "1")
    ledger.land(spark, bronze, rows("c"), "2/x='y'")
    loads = ledger.unseen(spark, "c", bronze)
    assert [x.load_id for x in loads] == ["1", "2/x='y'"] and sorted(r.v for r in ledger.rows_of(spark, bronze, loads[1:]).collect()) == ["c"]
    ledger.mark_taken(spark, "c", bronze, loads)
    ledger.land(spark, bronze, rows("b", "a"), "1")  # the same rows again
    assert ledger.unseen(spark, "c", bronze) == [] and len(ledger.unseen(spark, "other", bronze)) == 2
    ledger.land(spark, bronze, rows("a", "z"), "1")
    assert [x.load_id for x in ledger.unseen(spark, "c", bronze)] == ["1"]
    ledger.land(spark, bronze, rows(), "2/x='y'")  # now empty
    assert sorted(r.v for r in spark.table(bronze).collect()) == ["a", "z"]
    plan = ledger.rows_of(spark, bronze, loads[:1])._jdf.queryExecution().executedPlan().toString()
    assert "load_id" in plan.split("PartitionFilters: [")[1].split("]")[0]
    with pytest.raises(ValueError, match="load_id"):
        ledger.land(spark, bronze, rows("a").withColumn("Load_Id", F.lit(1)), "3")


def folders(spark, name):
    home = Path(table_location(spark, name).removeprefix("file:"))
    return {d.name: sorted((f.name, f.stat().st_mtime_ns) for f in d.glob("*.parquet")) for d in home.iterdir() if d.is_dir()}


def test_only_changed_partitions_of_the_state_are_written(spark, db):
    I.run_increment(spark, raw(spark, [(a, f"2024-01-{d:02d}", "t", "1.00", "2.00") for a in range(5) for d in range(1, 21)]), db, "a", "2024-02-01 00:00:00", buckets=4)
    state = f"{names(db)[2]}_state"
    before = folders(spark, state)
    I.run_increment(spark, raw(spark, [(1, "2024-01-05", "new", "7.00", "9.00"), (77, "2024-03-01", "new", "1.00", "1.00")]), db, "b", "2024-02-02 00:00:00", buckets=4)
    after = folders(spark, state)
    assert {d for d in after if after[d] != before.get(d)} == {"Date_Partition=2024-01-05", "Date_Partition=2024-03-01"} and len(before) == 20
    got = {r.AccountNo: (float(r.TotalDeposits), str(r.LastTransactionDate)) for r in keyed_table(spark, names(db)[2]).collect()}
    assert got["1"] == (27.0, "2024-01-20") and got["77"] == (1.0, "2024-03-01") and got["2"] == (20.0, "2024-01-20")


def test_combined_state_equals_the_summary(spark):
    rng = random.Random(3)
    day = lambda: rng.choice([None, dt.date(2024, 1, rng.randrange(1, 20))])
    rows = [(rng.choice([None, "a", "b", "c"]), day(), rng.choice([None, 1.25]), rng.choice([None, 2.5]), float(i), i, rng.randrange(4)) for i in range(300)]
    df = spark.createDataFrame(rows, "AccountNo string, Date date, DepositAMT double, WithdrawalAMT double, BalanceAMT double, TxnNo int, part int")
    for c in ("DepositAMT", "WithdrawalAMT", "BalanceAMT"):
        df = df.withColumn(c, F.col(c).cast("decimal(18,2)"))
    spec = account_spec(["TxnNo"])
    got = combine_state(partial_state(df, spec, "part"), spec)
    want = account_summary(df)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_groups_that_vanish_leave_the_aggregate(spark, db):
    source, state, gold = f"{db}.src", f"{db}.state", f"{db}.gold"
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1), 5), (None, dt.date(2024, 1, 1), 6), ("b", dt.date(2024, 1, 2), 7)], "g string, d date, v int")
    load_partitioned(spark, source, df.withColumn("k", F.monotonically_increasing_id()), ["k"], ["d"], "d")
    part = partition_columns(spark, source)[0]
    spec = maintained.AggregateSpec(keys=["g"], sums={"total": "v"})
    run = lambda days: (ledger.record_changes(spark, source, spark.createDataFrame([(d,) for d in days], "d date")),
                        maintained.refresh_aggregate(spark, source, state, gold, spec, "g", buckets=2))
    read = lambda: {r.g: r.total for r in keyed_table(spark, gold).collect()}
    run([dt.date(2024, 1, 1), dt.date(2024, 1, 2)])
    assert read() == {"a": 5, None: 6, "b": 7}
    ledger.clear_partition(spark, source, part, dt.date(2024, 1, 2))
    spark.catalog.refreshTable(source)
    run([dt.date(2024, 1, 2)])
    assert read() == {"a": 5, None: 6}
    run([dt.date(2024, 1, 1)])
    assert read() == {"a": 5, None: 6} and keyed_table(spark, gold).count() == 2


SCHEMA = "k long, updated date, v string"


def located_state(spark, name):
    rows = spark.table(name).collect()
    assert len({r.k for r in rows if r.k is not None}) == sum(r.k is not None for r in rows)  # a key has one row
    return {r.k: (r.updated, r.v, r.updated_Partition) for r in rows if r.k is not None}


def load(spark, name, rows, **options):
    return located.load_located(spark, name, spark.createDataFrame(rows, SCHEMA), ["K"], ["updated"], "updated", buckets=5, **options)


def test_moved_rows_leave_their_partition(spark, db):
    rng, name, want = random.Random(8), f"{db}.moving", {}
    day = lambda n: dt.date(2024, 1, n) if n else None
    for step in range(3):
        rows = [(k, day(rng.randrange(0, 28)), f"s{step}") for k in rng.sample(range(40), 15)]
        load(spark, name, rows)
        want |= {k: (d, v, d) for k, d, v in rows}
        assert located_state(spark, name) == want
    before = folders(spark, name)
    k = next(x for x in want if want[x][0] and sum(w[0] == want[x][0] for w in want.values()) == 1)  # alone in its partition
    old, new = want[k][0], next(d for d in (dt.date(2024, 1, n) for n in range(1, 29)) if d != want[k][0] and any(w[0] == d for w in want.values()))
    res = load(spark, name, [(k, new, "moved")])
    assert (res.updated, res.inserted) == (1, 0)
    after = folders(spark, name)
    assert set(before) - set(after) == {f"updated_Partition={old}"}
    assert {d for d in after if after[d] != before[d]} == {f"updated_Partition={new}"}
    places = {r.k: r.places for r in keyed_table(spark, located.locator_of(name)).collect()}
    assert places == {x: ["" if w[0] is None else str(w[0])] for x, w in (want | {k: (new, "", new)}).items()}


def test_located_null_keys_older_rows_and_existing_tables(spark, db):
    name = f"{db}.existing"
    d = dt.date(2024, 1, 5)
    load_partitioned(spark, name, spark.createDataFrame([(1, d, "a"), (2, d, "a"), (None, d, "n")], SCHEMA), ["k"], ["updated"], "updated")
    load(spark, name, [(1, dt.date(2024, 1, 9), "b"), (None, d, "m")])
    assert located_state(spark, name) == {1: (dt.date(2024, 1, 9), "b", dt.date(2024, 1, 9)), 2: (d, "a", d)}
    assert spark.table(name).filter("k IS NULL").count() == 2
    load(spark, name, [(1, dt.date(2024, 1, 7), "late"), (2, dt.date(2024, 1, 8), "c")], newest_wins=True)
    assert located_state(spark, name) == {1: (dt.date(2024, 1, 9), "b", dt.date(2024, 1, 9)), 2: (dt.date(2024, 1, 8), "c", dt.date(2024, 1, 8))}
    assert load(spark, name, []).rows == 0
    assert {r.k: r.places for r in find_keys(spark, located.locator_of(name), spark.createDataFrame([(1,)], "k int")).collect()} == {1: ["2024-01-09"]}


@pytest.mark.parametrize("call", [0, 1])
def test_crashes_between_locator_and_data(spark, db, monkeypatch, call):
    name, d = f"{db}.crash", dt.date(2024, 1, 5)
    load(spark, name, [(1, d, "a"), (2, d, "a")])
    real, calls = located.merge_bucketed, itertools.count()

    def crash(*a, **b):
        if next(calls) == call:
            raise RuntimeError("crash")
        return real(*a, **b)

    monkeypatch.setattr(located, "merge_bucketed", crash)
    with pytest.raises(RuntimeError):
        load(spark, name, [(1, dt.date(2024, 1, 9), "b")])
    monkeypatch.undo()
    load(spark, name, [(1, dt.date(2024, 1, 7), "c"), (2, dt.date(2024, 1, 9), "c")])
    assert located_state(spark, name) == {1: (dt.date(2024, 1, 7), "c", dt.date(2024, 1, 7)), 2: (dt.date(2024, 1, 9), "c", dt.date(2024, 1, 9))}


def test_jobs_agree_with_the_full_jobs(spark, db):
    """The incremental layers hold the rows that the jobs over everything hold."""
    batches = some_loads(11, 2)
    for i, b in enumerate(batches):
        I.run_increment(spark, raw(spark, b), db, str(i), dt.datetime(2024, 2, i + 1), buckets=3)
    bronze, silver, gold, _ = names(db)
    want = jobs.silver_frame(spark.table(bronze).drop("load_id"))
    shared = want.columns
    assert sorted(map(str, spark.table(silver).select(shared).collect())) == sorted(map(str, want.collect()))
    summary = account_summary(spark.table(silver)).drop("NetBalance")
    assert sorted(map(str, keyed_table(spark, gold).select(summary.columns).collect())) == sorted(map(str, summary.collect()))
