"""Spelling variants: a plain counter and a plain matcher, blocks of large groups, defined cases."""

import random
import re
import zlib
from collections import Counter

import numpy as np
from strata.llm import variants as V

SF_SMALL = "/root/testdata/sf0.001"


def plain_words(docs):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(words):
    """By looking at every pair of words of nearly the same length."""
    out, by = {}, {}
    for w in words:
        by.setdefault(len(w), []).append(w)
    for w, n in words.items():
        near = [v for k in (-1, 0, 1) for v in by.get(len(w) + k, []) if one_edit(w, v)]
        best = min(near, key=lambda v: (-words[v], v)) if near else None
        form = best if best is not None and words[best] >= 2 * n else None
        out[w] = [form, n, len(near), words[form] if form else None]
    for w in out:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w].insert(1, root)
    return {w: tuple(x) for w, x in out.items()}


def rows(df):
    got = df.collect()
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    out = {r.word: tuple(r)[1:] for r in got}
    assert len(out) == len(got)
    return out


def made_words(rng, letters, n):
    words = {}
    while len(words) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.randrange(2, 9)))
        words[w] = rng.choice([3, 3, 4, 7, 8, 9, 40, 100, 100])
    return words


def test_matches_every_pair(spark):
    for letters, n in (("ab", 300), ("abcdeé", 500)):
        words = made_words(random.Random(n), letters, n)
        df = spark.createDataFrame([(w, c, "x") for w, c in words.items()], "word string, n int, size string").repartition(3)
        want = plain_groups(words)
        assert rows(V.group_variants(df)) == want
        # groups over the limit are cut into blocks, every two of which meet
        assert rows(V.group_variants(df, index_words=64, index_limit=20)) == want
        assert sum(x[2] for x in want.values()) > n


def test_one_hot_group(spark):
    rng = random.Random(2)
    words = {"prefix" + "".join(rng.choice("abc") for _ in range(rng.randrange(4, 7))): rng.randrange(3, 50) for _ in range(600)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert rows(V.group_variants(df, index_words=128, index_limit=100)) == plain_groups(words)


def test_chains_and_ties(spark):
    words = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "zzzzz": 5, "zzzzy": 10, "zzzzx": 10, "lonely": 4, "pairs": 5, "pairz": 6}
    got = rows(V.group_variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == plain_groups(words)
    assert got["aaaaa"][1] == "aabbb" and got["zzzzz"][0] == "zzzzx" and got["lonely"] == (None, "lonely", 4, 0, None) and got["pairs"][0] is None


def test_first_bit():
    rng = np.random.default_rng(4)
    bits = np.zeros((300, 5), np.uint64)
    want = []
    for r in range(300):
        at = rng.integers(0, 320, rng.integers(1, 4))
        for x in at:
            bits[r, x >> 6] |= np.uint64(1) << np.uint64(x & 63)
        want.append(at.min())
    assert V.first_bit(bits).tolist() == want


def test_words_of_documents(spark):
    rng = random.Random(9)
    bits = ["Straße", "straße", "ÉCOLE", "école", "x×y÷zzz", "naïve", "don't", "ǅabcdef", "İstanbul", "abc1defgh", "ß", "word", "Words"]
    docs = [(i, " ".join(rng.choice(bits) for _ in range(40))) for i in range(60)] + [(None, None), (None, "Words words words"), (7, ""), (8, "verylong" * 50000 + " words"), (9, "words"), (9, "words")]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, word string").repartition(4)
    got = {r.word: r.n for r in V.corpus_words(df).collect()}
    assert got == plain_words(docs) and any(c >= 3 for c in got.values())
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert V.corpus_words(empty).count() == 0 and V.group_variants(V.corpus_words(empty)).count() == 0


def test_long_words(spark):
    words = {"ab" * 100000: 3, "ab" * 99999 + "b": 9, "ab" * 99999 + "ab" + "c": 5, "x": 5, "y": 20, "": 4}
    got = rows(V.group_variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    w = "ab" * 100000
    assert got[w][0] == "ab" * 99999 + "b" and got[w][3] == 2 and got["x"] == (None, "x", 5, 0, None) and got[""][3] == 0


def test_query_against_plain(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = plain_groups(plain_words(docs))
    assert rows(V.op13_spelling_variants(spark, SF_SMALL)) == want and len(want) > 500
