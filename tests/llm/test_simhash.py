"""SimHash near-duplicates against brute force, and the Golay tables against their definition."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from strata.llm import simhash as S
from strata.llm.components import components

SF_SMALL = "/root/testdata/sf0.001"


def plain_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    """{row index: component id} by comparing all pairs."""
    fps = [plain_fingerprint(t) for _, t in rows]
    comp = list(range(len(rows)))
    find = lambda i: i if comp[i] == i else find(comp[i])
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                comp[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(d)
    least = {g: min([d for d in ids if d is not None], default=None) for g, ids in groups.items()}
    return fps, [least[find(i)] for i in range(len(rows))]


def test_codewords_are_unique_and_near():
    words = np.random.default_rng(1).integers(0, 1 << 23, 3000).astype(np.uint32)
    index = S.codeword_index(words)
    code = index << 11 | S._PARITY[index]
    assert max(int(x).bit_count() for x in code ^ words) <= 3
    all_codes = np.arange(4096, dtype=np.uint32) << 11 | S._PARITY
    assert min(int(x).bit_count() for x in all_codes[1:]) == 7
    near = S.near_codewords(words, 23)
    counts = (near >= 0).sum(axis=1)
    assert set(counts.tolist()) == {1, 6}


def test_one_flip_shares_a_codeword():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 1 << 21, 2000).astype(np.uint32)
    y = x ^ (np.uint32(1) << rng.integers(0, 21, 2000).astype(np.uint32))
    near = S.near_codewords(x, 21)
    assert all(c in row for c, row in zip(S.codeword_index(y).tolist(), near.tolist()))


def test_fingerprints_match_plain():
    texts = ["", None, "A", "a b", "One two\tTHREE", "x\x0by z  w ", " lead and trail \n", "é É ñ words of unicode text", "w " * 5000, "same same same same"]
    got = S.fingerprints(pa.array(texts, pa.string())).tolist()
    assert got == [plain_fingerprint(t) for t in texts]
    pieces = pa.chunked_array([pa.array(texts, pa.string())])
    assert S.fingerprints(pieces.chunk(0).slice(3, 4)).tolist() == got[3:7]


def test_links_are_complete(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = set(base)
    for b in base:
        for n in (1, 2, 3, 4):
            fps.add(b ^ sum(1 << i for i in rng.sample(range(64), n)))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = {tuple(sorted(r)) for r in S.link_fingerprints(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()}
    want = {tuple(sorted((signed[i], signed[j]))) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3}
    assert got == want


def edge_rows():
    long = " ".join(f"word{i % 300}" for i in range(4000))
    rows = [(5, "the same small text"), (3, "The  same small TEXT"), (9, None), (8, ""), (None, "\t \n"), (7, "single"), (7, "single"),
            (None, "only null ids here"), (20, long), (21, long + " tail"), (22, "quite another text of a few words"), (23, "ÀÉ ñandú straße")]
    return rows


def test_components_match_brute_force(spark):
    rows = edge_rows()
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, component string")
    got = sorted(((r.doc_id, r.fp, r.component_id) for r in S.near_duplicates(df).collect()), key=str)
    fps, comp = brute(rows)
    want = sorted(((d, f - (1 << 64) if f >> 63 else f, c) for (d, _), f, c in zip(rows, fps, comp)), key=str)
    assert got == want


def test_keep_one_per_component(spark):
    rows = edge_rows()
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, fp string")
    kept = S.keep_one(df)
    assert kept.columns == df.columns
    fps, comp = brute(rows)
    got = sorted((r.doc_id for r in kept.collect()), key=str)
    assert got == sorted([3, 7, 8, 20, 22, 23, None], key=str) and len(fps) == len(comp)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(df).count() == 0
    assert S.keep_one(df).count() == 0


@pytest.mark.parametrize("links", [[], [(1, 1)], [(2, 1), (3, 2), (3, 4), (9, 8)], [(i, i + 1) for i in range(40)]])
def test_components(spark, links):
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    nodes = {x for ab in links for x in ab if ab[0] != ab[1]}
    comp = {n: n for n in nodes}
    for _ in nodes:
        for a, b in links:
            if a != b:
                comp[a] = comp[b] = min(comp[a], comp[b])
    assert got == comp


def test_query_matches_brute_force(spark):
    import __spark_entry__ as E

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    fps, comp = brute(docs)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in E.queries()["op3_simhash_neardup"](spark, SF_SMALL).collect()}
    assert got == {d: (f"{f:016x}", c) for (d, _), f, c in zip(docs, fps, comp)}
