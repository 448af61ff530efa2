"""Source mixing: targets by hand, epochs, prefixes, reruns."""

import math
import re
import zlib

import pytest

from strata.llm import mixing as M

SCHEMA = "doc_id long, text string, source string, taken string"


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Share by weight; stop the ones above their cap and share again."""
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, target = sum(sizes.values()), set(names), {}
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total > most * sizes[s]}
        if not over:
            target |= {s: left * w[s] / total for s in open_}
            break
        for s in over:
            target[s] = most * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def check(rows, got):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, t, s, *_ in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    target = plain_targets(sizes)
    assert len(got) == len(rows)
    taken, largest = {}, {}
    for r in got:
        assert r.size == size(r.text) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source], abs=1e-6)
        assert r.taken == r.size * r.copies and 0 <= r.copies <= 3
        assert r.copies - math.floor(r.target / max(r.source_size, 1) + 1e-12) in (0, 1)
        taken[r.source] = taken.get(r.source, 0) + r.taken
        largest[r.source] = max(largest.get(r.source, 0), r.size)
    for s in taken:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6
    return target


def sample():
    rows = [(i, "w " * (1 + zlib.crc32(str(i).encode()) % 90), ["a", "b", "c", None, "", "é"][i % 6 if i % 3 else 0], "x") for i in range(900)]
    return rows + [(2000, None, "a", "x"), (2001, "", "empty", "x"), (2002, "long " * 30000, "b", "x"), (None, "no id", "c", "x"), (7, "w w", "c", "x"), (7, "w w", "c", "x")]


def test_targets_and_prefix(spark):
    rows = sample()
    docs = spark.createDataFrame(rows, SCHEMA)
    out = M.mix(docs)
    assert out.columns == ["doc_id", "text", "source", "size", "source_size", "target", "copies", "taken"]
    got = out.collect()
    check(rows, got)
    again = M.mix(docs.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_heavier_documents_come_first(spark):
    docs = spark.createDataFrame([(i, "one two", "ab"[i % 2]) for i in range(4000)], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, int(i % 4 < 2), 0) for i in range(4000)] + [(3, None, 0), (None, 1, 0), (5, 0, 1)], "doc_id long, quality int, toxic int")
    got = M.mix_documents(docs, labels).filter("source = 'b'").collect()
    share = lambda rows: sum(r.copies > 0 for r in rows) / len(rows)
    good, poor = [r for r in got if r.doc_id % 4 == 1 and r.doc_id != 5], [r for r in got if r.doc_id % 4 == 3]
    assert share(good) > 1.5 * share(poor) > 0


def test_stage_repeats_rows(spark):
    rows = sample()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    out = M.apply_mix(docs, labels)
    assert out.columns == docs.columns
    plan = {(r.doc_id, r.text, r.source): r for r in M.mix_documents(docs.drop("size"), labels).collect()}
    counts = {}
    for r in out.collect():
        counts[r.doc_id, r.text, r.source] = counts.get((r.doc_id, r.text, r.source), 0) + 1
    twice = {k for k in plan if sum((d, t, s) == k for d, t, s, _ in rows) == 2}
    assert {k: v for k, v in counts.items()} == {k: r.copies * (2 if k in twice else 1) for k, r in plan.items() if r.copies}


@pytest.mark.parametrize("rows", [[], [(1, None, None, "x")], [(1, "a b", "s", "x")], [(1, "a", None, "x"), (2, "b c d e f g", "z", "x")]])
def test_small_tables(spark, rows):
    got = M.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    check(rows, got)
