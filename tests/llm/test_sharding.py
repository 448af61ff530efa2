"""Stratified interleaving: row law, gapless slots, mixture of every shard."""

from collections import Counter

import pytest

from strata.llm import sharding as S

SF_SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, shard string"


def plain_check(rows, got, n):
    assert Counter((r.doc_id, r.source) for r in got) == Counter((d, s) for d, s, *_ in rows)
    counts = Counter(r.shard for r in got)
    full = [counts.get(k, 0) for k in range(n)]
    assert sum(full) == len(rows) and max(full) - min(full) <= 1
    for k in range(n):
        assert sorted(r.slot for r in got if r.shard == k) == list(range(full[k]))
    sources = Counter(s for _, s, *_ in rows)
    for s, total in sources.items():
        for k in range(n):
            have = sum(r.shard == k and r.source == s for r in got)
            assert abs(have - total / n) <= 2 + total / len(rows) * len(sources) / 2


@pytest.mark.parametrize("n", [1, 7, 40])
def test_every_shard_matches_the_mixture(spark, n):
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 11}" if i % 11 else None, "x") for i in range(1500)]
    rows += [(None, "hot", "x"), (None, None, "x"), (5, "s5", "x"), (5, "s5", "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = S.interleave_shards(df, n)
    assert out.columns == ["doc_id", "source", "shard", "slot"]
    got = out.collect()
    plain_check(rows, got, n)
    again = S.interleave_shards(df.repartition(9), n).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_shuffled_within_source(spark):
    got = S.interleave_shards(spark.createDataFrame([(i, "a", "x") for i in range(400)], SCHEMA), 4).collect()
    assert max(r.doc_id for r in got if r.shard == 0) > 300


@pytest.mark.parametrize("rows", [[], [(1, "a", "x")], [(1, None, "x"), (1, None, "x"), (2, "b", "x")]])
def test_fewer_rows_than_shards(spark, rows):
    got = S.interleave_shards(spark.createDataFrame(rows, SCHEMA), 40).collect()
    assert sorted(r.slot for r in got) == [0] * len(rows) and len({r.shard for r in got}) == len(rows)


def test_query(spark):
    import zlib

    import __spark_entry__ as E

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = E.queries()["op8_stratified_shards"](spark, SF_SMALL).collect()
    by = {r.doc_id: r for r in got}
    source = {d.doc_id: d.source for d in docs}
    for d in docs:
        raw = (d.text or "").encode()
        assert (by[d.doc_id].size, by[d.doc_id].text_crc32) == (len(raw) + 16, zlib.crc32(raw))
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    for r in got:
        object.__setattr__(r, "source", source[r.doc_id])
    plain_check([(d.doc_id, d.source) for d in docs], got, 40)


def test_written_shards(spark, tmp_path):
    rows = [(i, f"s{i % 3}", "x") for i in range(100)]
    out = S.interleave_shards(spark.createDataFrame(rows, SCHEMA), 5)
    S.write_shards(out, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted((r.doc_id, r.shard, r.slot) for r in back.collect()) == sorted((r.doc_id, r.shard, r.slot) for r in out.collect())
