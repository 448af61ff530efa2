"""The Katz model against a plain dictionary implementation, and its normalisation."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import common
from strata.llm import lm as L

SF_SMALL = "/root/testdata/sf0.001"


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), "</s>"]


class Plain:
    """Katz by dictionaries."""

    def __init__(self, texts, order):
        self.order, self.n = order, {k: Counter() for k in range(1, order + 1)}
        for t in texts:
            words = ["<s>"] * (order - 1) + tokens(t)
            for i in range(order - 1, len(words)):
                for k in range(1, order + 1):
                    self.n[k][tuple(words[i - k + 1 : i + 1])] += 1
        self.total = {k: Counter() for k in range(2, order + 1)}
        self.after = {k: {} for k in range(2, order + 1)}
        for k in range(2, order + 1):
            for g, c in self.n[k].items():
                self.total[k][g[:-1]] += c
                self.after[k].setdefault(g[:-1], []).append(g[-1])
        self.N, self.V = sum(self.n[1].values()), len(self.n[1])
        self.d = {k: self.discounts(Counter(self.n[k].values())) for k in self.n}
        left = sum((1 - self.d[1][c]) * c for c in self.n[1].values() if c <= 5)
        self.more = 0 if left > 0 else 1
        self.unknown = (left if left > 0 else 1) / (self.N + self.more)
        self.cache = {}

    @staticmethod
    def discounts(n):
        d, top = {}, 6 * n[6] / n[1] if n[1] else 1
        for r in range(1, 6):
            d[r] = (r - 0.5) / r
            if top < 1 and n[r] and n[r + 1]:
                x = ((r + 1) * n[r + 1] / (r * n[r]) - top) / (1 - top)
                d[r] = x if 0 < x < 1 else d[r]
        return d

    def context(self, k, h):
        if h not in self.cache:
            counts = [self.n[k][*h, w] for w in self.after[k][h]]
            left = sum((1 - self.d[k][c]) * c for c in counts if c <= 5)
            more = 0 if left > 0 else 1
            seen = sum(self.p(k - 1, (*h[1:], w)) for w in self.after[k][h])
            self.cache[h] = ((left if left > 0 else 1) / (self.total[k][h] + more) / (1 - seen), more)
        return self.cache[h]

    def p(self, k, g):
        c = self.n[k][g]
        if k == 1:
            return c * self.d[1].get(c, 1) / (self.N + self.more) if c else self.unknown
        if g[:-1] not in self.total[k]:
            return self.p(k - 1, g[1:])
        a, more = self.context(k, g[:-1])
        return c * self.d[k].get(c, 1) / (self.total[k][g[:-1]] + more) if c else a * self.p(k - 1, g[1:])

    def score(self, text):
        words = ["<s>"] * (self.order - 1) + tokens(text)
        return sum(math.log10(self.p(self.order, tuple(words[i - self.order + 1 : i + 1]))) for i in range(self.order - 1, len(words)))

    def base(self, text):
        return sum(math.log10((self.n[1][(w,)] + 1) / (self.N + self.V + 1)) for w in tokens(text))


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def compare(got, rows, order):
    model = Plain([t for d, t in rows if not held(d)], order)
    want = sorted(((d, t) for d, t in rows), key=lambda r: (str(r[0]), len(tokens(r[1])), model.score(r[1])))
    got = sorted(got, key=lambda r: (str(r.doc_id), r.n_tokens, r.score))
    assert len(got) == len(want)
    for g, (d, t) in zip(got, want):
        assert g.doc_id == d and g.held_out == held(d) and g.n_tokens == len(tokens(t)) and g.train_tokens == model.N
        assert g.n_known == sum(model.n[1][(w,)] > 0 for w in tokens(t))
        assert g.base_score == pytest.approx(model.base(t), rel=1e-9)
        assert g.score == pytest.approx(model.score(t), rel=1e-9, abs=1e-9)
    return model


def corpus():
    rng = np.random.default_rng(4)
    vocab = np.array([f"W{i}" for i in range(60)])
    weights = 1 / np.arange(1, 61)
    rows = [(i, " ".join(rng.choice(vocab, rng.integers(0, 60), p=weights / weights.sum()))) for i in range(220)]
    rows += [(None, None), (500, ""), (501, " \t "), (502, "Never seen\nwords"), (502, "Never seen\nwords"), (503, "w0 " * 6000), (504, "É ß \U0001f600 w0 w1")]
    rows += [(600 + i, "hot hot hot w1") for i in range(120)]
    return rows


@pytest.mark.parametrize(("order", "options"), [(1, {}), (2, {}), (2, {"tokens_per_bucket": 900}), (3, {"tokens_per_bucket": 1500}), (4, {"tokens_per_bucket": 700, "split_share": 20})])
def test_matches_plain(spark, monkeypatch, order, options):
    rows = corpus()
    df = spark.createDataFrame([(d, t, 1.0) for d, t in rows], "doc_id long, text string, score double").repartition(3)
    got = L.score_documents(df, order=order, held_out=common.crc_mod("doc_id", 7) == 2, **options).collect()
    model = compare(got, rows, order)
    if order > 1:  # every context sums to one over the vocabulary and the unknown word
        for h in list(model.total[order])[:60]:
            assert sum(model.p(order, (*h, *w)) for w in model.n[1]) + model.p(order, (*h, "never seen")) == pytest.approx(1, abs=1e-9)


def test_split_contexts_are_used(spark):
    blocks = L.encode_blocks(spark.createDataFrame(corpus(), "doc_id long, text string"))
    model = L.fit(blocks, 2, tokens_per_bucket=900)
    assert len(model.katz.split[2][0]) > 0
    kinds = {r.kind for r in model.level(spark, 2).select("kind").distinct().collect()}
    assert kinds == {1, 2, 3}


def test_discounts_and_weights():
    assert np.allclose(L.good_turing([0] * 6)[1:], [(r - 0.5) / r for r in range(1, 6)])
    d = L.good_turing([100, 40, 20, 12, 8, 5])
    assert ((d[1:] > 0) & (d[1:] < 1)).all()
    w, once = L.backoff_weights(np.array([10, 12]), np.array([[2, 0, 0, 0, 0], [0, 0, 0, 0, 0]]), np.array([0.3, 0.6]), d)
    assert once.tolist() == [0, 1] and np.allclose(w, [2 * (1 - d[1]) / 10 / 0.7, 1 / 13 / 0.4])


def test_pack_round_trip():
    for a in (np.arange(5, dtype=np.uint64), np.zeros(0, np.uint32), np.array([1.5, -2]), np.array([3], np.uint8)):
        assert L.unpack(L.pack(a), a.dtype.type).tolist() == a.tolist()


def test_no_training_and_empty(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = L.score_documents(df, held_out=F.lit(True)).collect()
    assert {(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got} == {(1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)}
    assert L.score_documents(df.limit(0), held_out=F.lit(True)).count() == 0


def test_query_matches_plain(spark):
    import __spark_entry__ as E

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    compare(E.queries()["op1_katz_scores"](spark, SF_SMALL).collect(), rows, L.ORDER)


def test_query_scores_with_trigrams(spark, tmp_path):
    import __spark_entry__ as E

    rows = [r for r in corpus() if r[0] is None or r[0] < 250]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    compare(E.queries()["op1_katz_scores"](spark, str(tmp_path)).collect(), rows, 3)


@pytest.mark.parametrize(("order", "options"), [(1, {}), (3, {}), (3, {"tokens_per_bucket": 1200}), (4, {"tokens_per_bucket": 700, "split_share": 20})])
def test_stored_model_scores_other_texts(spark, order, options):
    """A model is read back from its tables for texts it has not seen."""
    rows = corpus()
    learn, other = [r for r in rows if r[0] is None or r[0] % 3], [r for r in rows if r[0] is not None and r[0] % 3 == 0]
    other += [(900, "w0 unheard w0 w1 unheard unheard w2"), (900, None)]
    frame = lambda x: spark.createDataFrame(x, "doc_id long, text string").repartition(2)
    model, want = L.fit(L.encode_blocks(frame(learn)), order, **options), Plain([t for _, t in learn], order)
    got = L.score(L.encode_blocks(frame(other)), model).select("id", "score").collect()
    scores = lambda x: sorted(x, key=lambda r: (r[0], r[1]))
    for g, w in zip(scores(map(tuple, got)), scores((d, want.score(t)) for d, t in other), strict=True):
        assert g == pytest.approx(w, rel=1e-9, abs=1e-9)


def test_files_left_per_token(spark):
    """Trigrams that hardly repeat: what the model and the blocks' answers take is bounded, and what only the learning needs is gone."""
    from pathlib import Path

    from strata.session import checkpoint_root

    rng = np.random.default_rng(8)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 20_000, 400))) for i in range(1000)]
    root = Path(checkpoint_root(spark), "strata", "lm")
    before = set(root.rglob("*.parquet"))
    L.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), held_out=F.lit(False)).write.format("noop").mode("overwrite").save()
    left = set(root.rglob("*.parquet")) - before
    assert 0 < sum(f.stat().st_size for f in left) < 12 * 400 * len(rows)
    assert not [f for f in left if f"kind={L.EVIDENCE}" in str(f) or "blocks" in f.relative_to(root).parts]
