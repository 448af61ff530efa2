"""Pigeonhole edit matching against a brute-force word edit distance."""

import random
import re

import numpy as np

from strata.llm import decontaminate as D

SF_SMALL = "/root/testdata/sf0.001"


def words_of(text):
    return re.findall(r"[a-z0-9ß-￿]+", (text or "").lower())


def best_distance(item, text):
    """Smallest edit distance of the whole item to any stretch of the text (Sellers)."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, x in enumerate(item):
            new.append(min(row[i] + (x != c), row[i + 1] + 1, new[i] + 1))
        row = new
        best = min(best, row[-1])
    return best


def test_myers_is_the_edit_distance():
    rng = random.Random(7)
    for _ in range(400):
        p = [rng.randrange(4) for _ in range(rng.randrange(1, 90))]
        t = [rng.randrange(4) for _ in range(rng.randrange(0, 60))]
        want = best_distance(p, t)
        got = D.myers(p, t, len(p))
        assert got[0] == want
        assert D.myers(p, t, want) is not None and (want == 0 or D.myers(p, t, want - 1) is None)


def test_pieces_outnumber_errors():
    for m in range(5, 80):
        p = D.cut_pieces([(1, np.arange(m, dtype=np.uint64))])
        pieces = sorted((int(o), n) for n, _, _, off in p.by_length for o in off)
        assert len(pieces) == m // 5 + 1 and sum(n for _, n in pieces) == m
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:i]) for i in range(len(pieces))]


def planted(rng):
    vocab = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([5, 9, 14, 30, 70])))) for i in range(25)]
    docs = []
    for d in range(150):
        body = rng.choices(vocab, k=rng.randrange(0, 120))
        if d % 2:
            item = items[rng.randrange(25)][1].split()
            for _ in range(rng.randrange(0, len(item) // 5 + 2)):
                at = rng.randrange(len(item))
                kind = rng.randrange(3)
                item[at : at + (kind != 1)] = [] if kind == 0 else [rng.choice(vocab)]
            at = rng.randrange(len(body) + 1)
            body[at:at] = item
        docs.append((d, rng.choice([" ", ", ", "\n"]).join(body).title()))
    return items, docs


def test_matches_brute_force(spark):
    items, docs = planted(random.Random(11))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for d, text in docs:
        for i, item in items:
            e = best_distance(words_of(item), words_of(text))
            if e <= len(item.split()) // 5:
                want.add((d, i, e))
    for chunk in (D.WORDS_PER_CHUNK, 100):
        rows = D.find_leaks(df, bench, words_per_chunk=chunk).collect()
        assert {(r.doc_id, x.item_id, x.distance) for r in rows for x in r.leaks} == want
    assert len(want) > 30
    kept = {r.doc_id for r in D.drop_leaks(df, bench).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _, _ in want}


def test_edge_cases(spark):
    long = "filler " * 30000
    item = "ein kurzer Satz über die Höhe der Dinge"
    docs = [(None, None, "a"), (1, "", "b"), (2, long + item.upper() + " " + long, "c"), (3, "Tiny item", "d"), (4, "not a tiny item", "e"), (4, "not a tiny item", "e")]
    df = spark.createDataFrame(docs, "doc_id long, text string, leaks string")
    bench = spark.createDataFrame([(1, item), (2, "tiny item"), (3, ""), (4, None), (None, item), (1, item)], "item_id long, text string")
    got = sorted(((r.doc_id, [(x.item_id, x.distance) for x in r.leaks]) for r in D.find_leaks(df, bench).collect()), key=str)
    assert got == sorted([(None, []), (1, []), (2, [(1, 0)]), (3, [(2, 0)]), (4, [(2, 0)]), (4, [(2, 0)])], key=str)  # short items match anywhere, without errors
    assert D.find_leaks(df.limit(0), bench).count() == 0
    assert D.drop_leaks(df, bench.limit(0)).count() == len(docs)


def test_short_items_and_blank_free_scripts(spark):
    chinese = "水的沸点在海平面上是一百摄氏度"
    docs = [(1, "well, it is Not a TINY, item at all"), (2, "tiny little item"), (3, "前面的话" + chinese + "后面的话"), (4, "前面" + chinese.replace("海", "湖") + "后面"), (5, "沸点"), (6, "tiny item tiny item")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, "tiny item"), (2, chinese), (3, "沸点")], "item_id long, text string")
    got = {r.doc_id: [(x.item_id, x.distance, x.first_word, x.end_word) for x in r.leaks] for r in D.find_leaks(df, bench).collect()}
    assert got[1] == [(1, 0, 5, 7)] and got[2] == [] and got[5] == [(3, 0, 0, 2)] and got[6] == [(1, 0, 0, 2)]
    assert [x[:2] for x in got[3]] == [(2, 0), (3, 0)] and [x[:2] for x in got[4]] == [(2, 1), (3, 0)]


def test_query_finds_whole_items(spark):
    import __spark_entry__ as E

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()
    want = {(d.doc_id, i.item_id) for d in docs for i in items if best_distance(words_of(i.text), words_of(d.text)) <= len(words_of(i.text)) // 5 and len(words_of(i.text)) >= 5}
    got = {(r.doc_id, r.item_id) for r in E.queries()["op4_benchmark_leaks"](spark, SF_SMALL).collect()}
    assert got == want


def test_case_in_every_script_and_single_words(spark):
    greek = "η γρήγορη καφέ αλεπού πηδάει πάνω από τον τεμπέλη σκύλος"
    cyrillic = "быстрая коричневая лиса прыгает через ленивую собаку"
    docs = [(1, "x " + greek.upper() + " y"), (2, "x " + cyrillic.title() + " y"), (3, "The rest is clean"), (4, "ΣΚΎΛΟΣ alone")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, greek), (2, cyrillic), (3, "The"), (4, "σκύλος")], "item_id long, text string")
    got = {r.doc_id: [(x.item_id, x.distance) for x in r.leaks] for r in D.find_leaks(df, bench).collect()}
    assert got[1] == [(1, 0), (4, 0)] and got[2] == [(2, 0)] and got[3] == [(3, 0)] and got[4] == [(4, 0)]
    assert sorted(r.doc_id for r in D.drop_leaks(df, bench).collect()) == [3, 4] and D.single_word_items(bench) == 2
