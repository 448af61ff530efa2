"""The pipeline: every stage takes effect on planted rows, and run() agrees with the stages."""

import random

import corpus_pipeline as P
from strata.llm import decontaminate, langid, simhash

SF_SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages(spark, tmp_path):
    names = [n for n, _ in P.STAGES]
    assert names == ["language_id", "near_dedup", "decontamination", "source_mixing", "token_output"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = docs.collect()
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").first().text
    rng = random.Random(1)
    extra = [(9001, None, "en", "src0", 0), (9002, "12 34 ---", "en", "src1", 9), (9003, rows[0].text, rows[0].lang, "src2", 1)]
    extra += [(9004, " ".join(rng.choices(rows[1].text.split(), k=80)) + "\n" + bench + " " + rows[2].text[:200], "en", "src0", 1)]
    start = spark.createDataFrame([tuple(r) for r in rows] + extra, SCHEMA)
    stage = dict(P.STAGES)
    one = stage["language_id"](spark, start, SF_SMALL)
    assert one.columns == docs.columns
    kept = {r.doc_id for r in one.select("doc_id").collect()}
    assert not {9001, 9002} & kept and {9003, 9004} <= kept and len(kept) >= 0.97 * len(rows)
    one.write.parquet(f"{tmp_path}/1")
    one = spark.read.parquet(f"{tmp_path}/1")
    two = stage["near_dedup"](spark, one, SF_SMALL)
    groups = {}
    for r in simhash.near_duplicates(one).collect():
        groups.setdefault(r.component, []).append(r.doc_id)
    assert sorted(r.doc_id for r in two.collect()) == sorted(min(g) for g in groups.values())
    two.write.parquet(f"{tmp_path}/2")
    two = spark.read.parquet(f"{tmp_path}/2")
    three = stage["decontamination"](spark, two, SF_SMALL)
    left = {r.doc_id for r in three.collect()}
    leaks = {r.doc_id for r in decontaminate.find_leaks(two, spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")).collect() if r.leaks}
    assert 9004 in leaks and left == {r.doc_id for r in two.collect()} - leaks
    four = stage["source_mixing"](spark, three, SF_SMALL)
    assert four.columns == docs.columns and {r.doc_id for r in four.collect()} <= left
    four.write.parquet(f"{tmp_path}/4")
    five = stage["token_output"](spark, spark.read.parquet(f"{tmp_path}/4"), SF_SMALL)
    assert five.count() == spark.read.parquet(f"{tmp_path}/4").count()
    assert langid.UNKNOWN == "und"


def test_run(spark):
    out = P.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    rows = sorted(out.collect(), key=lambda r: r.start)
    assert rows and [r.start for r in rows] == [sum(x.n_tokens for x in rows[:i]) for i in range(len(rows))]
    assert [r.doc_id for r in rows] == sorted(r.doc_id for r in rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in P.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.count() == 0, name
