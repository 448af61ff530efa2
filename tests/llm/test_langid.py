"""Output-code language ID: held-out accuracy, defined cases, and decoding by hand."""

import zlib

import numpy as np
import pyarrow as pa

from strata.llm import langid as L

SF = "/root/testdata/sf0.01"


def test_codewords_keep_their_distance():
    for n in (2, 3, 4, 5, 7, 9, 40):
        c = L.codewords(n)
        assert c.shape[0] == n and set(np.unique(c)) <= {-1, 1}
        assert (np.abs(c.sum(axis=0)) < n).all()
        gaps = (c[:, None] != c[None]).sum(axis=2)[~np.eye(n, dtype=bool)]
        assert gaps.min() >= (1 << (n - 2) if n <= 7 else 6)
    assert L.codewords(0).shape == (0, 0) and L.codewords(1).shape == (1, 0)


def test_ngrams_do_not_cross_documents():
    (both, rows, lo), = L.ngrams(pa.array(["ab", "", None, "c", "ÉA é"]))
    assert rows.tolist() == [0, 2, 2, 2, 3, 9] and lo == 0
    assert both[1].tolist() == [L.FEATURES] * 2 and both[2].tolist() == [L.FEATURES] * 2
    alone, _, _ = next(L.ngrams(pa.array(["ÉA é"])))
    assert (both[3:] == alone).all()


def test_decoding_survives_wrong_bits():
    codes = L.codewords(4)
    m = L.LanguageModel(("a", "b", "c", "d"), codes, np.zeros((L.FEATURES + 1, 7), np.float32), np.full(codes.shape, 1 / 7))
    for i in range(4):
        for wrong in range(7):
            z = codes[i] * 4.0
            z[wrong] *= -1
            best, score = m.decode(z[None, :])
            assert best[0] == i and 0 < score[0] <= 1


def test_held_out_accuracy(spark):
    import __spark_entry__ as E

    truth = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = E.queries()["op5_language_id"](spark, SF).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    scored = [r for r in held if truth[r.doc_id].lang is not None and r.lang_pred != "und"]
    right = sum(r.lang_pred == truth[r.doc_id].lang for r in scored)
    assert len(scored) > 150 and right / len(scored) > 0.97
    assert sum(r.ambiguous for r in rows) < 0.02 * len(rows)


def rows_of():
    en, de = "the quick brown fox jumps over the lazy dog and runs away", "der schnelle braune Fuchs springt über den faulen Hund und läuft weg"
    rows = [(i, en if i % 2 else de, "en" if i % 2 else "de", "keep") for i in range(40)]
    return rows + [(100, None, "en", "k"), (101, "", "de", "k"), (102, "12 345 --- \U0001f600", "en", "k"), (None, de, None, "k"), (100, en * 3000, None, "k"), (103, "日本語", None, "k")]


def test_defined_cases(spark):
    df = spark.createDataFrame(rows_of(), "doc_id long, text string, lang string, score string")
    got = L.identify(df)
    assert got.columns == ["doc_id", "text", "lang", "held_out", "lang_pred", "score", "ambiguous"]
    by = {(r.doc_id, r.text): r for r in got.collect()}
    assert all(by[k].lang_pred == "und" and by[k].score == 0 for k in by if not k[1] or k[0] == 102)
    assert all(r.lang_pred == r.lang for r in by.values() if r.doc_id is not None and r.doc_id < 40)
    assert [r.lang_pred for r in by.values() if r.doc_id is None] == ["de"]
    kept = L.keep_identified(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert set(range(40)) <= set(ids) and not {101, 102} & set(ids) and ids.count(100) == 1


def test_without_labels_or_rows(spark):
    schema = "doc_id long, text string, lang string"
    assert L.identify(spark.createDataFrame([], schema)).count() == 0
    none = L.identify(spark.createDataFrame([(1, "words", None)], schema)).first()
    assert none.lang_pred == "und"
    one = L.identify(spark.createDataFrame([(i, "words", "xx") for i in range(8)], schema)).collect()
    assert {r.lang_pred for r in one} == {"xx"}
