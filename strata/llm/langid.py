"""Language identification by error-correcting output codes.

Each language has a codeword; bit b of the codewords splits the languages in two, and
a binary classifier over hashed byte 2- and 3-grams predicts it. A classifier's weights are
the log ratios of the smoothed n-gram probabilities of its two sides, so the whole model
comes from one distributed count over all labelled training texts: at most
``languages x FEATURES`` numbers, whatever the corpus. Decoding is loss-weighted: every
language pays the logistic loss of each bit against its codeword, weighed by how
reliable that classifier was for that language, and the smallest loss wins. A small gap to
the runner-up is flagged as ambiguous.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .registry import query
from .text import text_buffer

FEATURES = 1 << 17
#: Texts are read in slices of so many bytes (or one longer text): a slice takes some 60 times its size.
SLICE_BYTES = 1 << 19
SMOOTHING = 0.5
#: Rows (in expectation) on which the reliability of each classifier is measured; a bounded
#: sample by hash of the id. The classifiers themselves are counted over every training row.
RELIABILITY_ROWS = 4_000
#: Evidence per bit: mean log ratio x square root of the n-grams, at most this many.
EVIDENCE_CAP = 20.0
#: Largest weight of one n-gram, so that a short foreign passage does not outweigh the rest of a text.
WEIGHT_CAP = 2.0
#: Below this share of the (softmax) loss mass the best language counts as ambiguous.
AMBIGUOUS_BELOW = 0.6
UNKNOWN = "und"

_CLASS = np.full(256, 0x20, dtype=np.uint8)  # everything but letters becomes a blank
for _b in itertools.chain(range(97, 123), range(128, 256)):
    _CLASS[_b] = _b
_CLASS[65:91] = np.arange(97, 123)


def codewords(n: int) -> np.ndarray:
    """(n, bits) matrix of +1 / -1: the exhaustive code up to 7 languages, beyond that the best of
    64 seeded random codes of 12 log2(n) bits by smallest distance. Every bit splits the languages."""
    if n < 2:
        return np.ones((n, 0), dtype=np.int8)
    if n <= 7:
        bits = range(1, 1 << (n - 1))
        return np.array([[1 if i == 0 or not b >> (i - 1) & 1 else -1 for b in bits] for i in range(n)], dtype=np.int8)
    rng, best, width = np.random.default_rng(5), None, 12 * math.ceil(math.log2(n))
    for _ in range(64):
        c = rng.choice(np.array([-1, 1], dtype=np.int8), size=(n, width))
        c = c[:, np.abs(c.sum(axis=0)) < n]
        gaps = (c[:, None, :] != c[None, :, :]).sum(axis=2) if n <= 512 else np.array([[width]])
        gap = int(gaps[~np.eye(len(gaps), dtype=bool)].min()) if len(gaps) > 1 else 0
        if best is None or gap > best[0]:
            best = (gap, c)
    return best[1]


def ngrams(col: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(feature of every byte position, row offsets, first row) per slice of texts; two
    features a position, laid out one after the other. Positions without an
    n-gram, or with blanks only, have the feature ``FEATURES``."""
    data, off = text_buffer(col)
    n, lo = len(off) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + slice_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        x = _CLASS[data[off[lo] : off[hi]]]
        rows = off[lo : hi + 1] - off[lo]
        if len(x) > 1:  # É to é and so on: the second byte after 0xC3
            upper = (x[:-1] == 0xC3) & (x[1:] >= 0x80) & (x[1:] <= 0x9E)
            x[1:][upper] += 0x20
        wide = np.full(len(x) + 2, 0x20, dtype=np.uint32)
        wide[:-2] = x
        two = wide[:-2] << 8 | wide[1:-1]
        three = two << 8 | wide[2:]
        last = rows[1:][rows[1:] > rows[:-1]] - 1
        both = np.empty((len(x), 2), dtype=np.uint32)
        for k, (v, blank) in enumerate(((two, 0x2020), (three, 0x202020))):
            f = (v + np.uint32(k << 24)) * np.uint32(0x9E3779B1) >> np.uint32(32 - 17)
            f[v == blank] = FEATURES
            f[last] = FEATURES
            if k:
                f[(last - 1)[last > 0]] = FEATURES
            both[:, k] = f
        yield both, rows, lo
        lo = hi


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    codes: np.ndarray  # (languages, bits)
    weights: np.ndarray  # (FEATURES + 1, bits); the last row is zero
    reliability: np.ndarray  # (languages, bits), rows sum to 1

    def margins(self, col: pa.Array) -> np.ndarray:
        """(rows, bits): evidence for +1 of every bit."""
        out = np.zeros((len(col), self.codes.shape[1]), dtype=np.float64)
        for both, rows, lo in ngrams(col):
            full = np.flatnonzero(rows[1:] > rows[:-1])
            if not len(full):
                continue
            at = rows[:-1][full]
            total = np.zeros((len(full), out.shape[1]))
            for k in range(2):
                total += np.add.reduceat(self.weights[both[:, k]], at, axis=0, dtype=np.float64)
            n = np.add.reduceat((both < FEATURES).sum(axis=1), at)
            out[lo + full] = total / np.sqrt(np.maximum(n, 1))[:, None]
        return np.clip(out, -EVIDENCE_CAP, EVIDENCE_CAP)

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(best language index, its share of the softmax over negative losses)."""
        loss = np.stack([np.logaddexp(0, -margins * c) @ r for c, r in zip(self.codes.astype(np.float64), self.reliability, strict=True)], axis=1)
        loss *= max(1, self.codes.shape[1])
        p = np.exp(loss.min(axis=1, keepdims=True) - loss)
        p /= p.sum(axis=1, keepdims=True)
        return loss.argmin(axis=1), p.max(axis=1)


def fit(train: DataFrame, *, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> LanguageModel:
    """Learn from every row with a text and a language. Rows without either are
    left out; with no row left the model knows no language and predicts ``und``."""
    rows = train.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    rows = rows.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(id_col).cast("string").alias("id"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for b in batches:
            langs = np.array(b.column("lang").to_pylist(), dtype=object)
            for lang in set(langs):
                mine = np.flatnonzero(langs == lang)
                docs[lang] = docs.get(lang, 0) + len(mine)
                total = sums.setdefault(lang, np.zeros(FEATURES + 1, dtype=np.int64))
                for both, _, _ in ngrams(b.column("text").take(pa.array(mine))):
                    total += np.bincount(both.ravel(), minlength=FEATURES + 1)
            del b
        common.release_memory()
        for lang, total in sums.items():
            f = np.flatnonzero(total[:FEATURES])
            f, c = np.append(f, FEATURES), np.append(total[f], docs[lang])  # the last entry: documents
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(f)), pa.array(f, pa.int32()), pa.array(c, pa.int64())], names=["lang", "f", "n"])

    counts = rows.select("text", "lang").mapInArrow(count, "lang string, f int, n long")
    table = counts.groupBy("lang", "f").agg(F.sum("n").alias("n")).toArrow()  # at most languages x (FEATURES + 1) rows
    names = sorted(set(table.column("lang").to_pylist()))
    n = np.zeros((len(names), FEATURES + 1))
    which = np.searchsorted(np.array(names, dtype=object), np.array(table.column("lang").to_pylist(), dtype=object)) if names else np.zeros(0, int)
    n[which, table.column("f").to_numpy()] = table.column("n").to_numpy()
    docs, n = n[:, FEATURES].sum(), n[:, :FEATURES] + SMOOTHING
    p = n / n.sum(axis=1, keepdims=True)
    codes = codewords(len(names))
    weights = np.zeros((FEATURES + 1, codes.shape[1]), dtype=np.float32)
    for b in range(codes.shape[1]):
        ratio = np.log(p[codes[:, b] > 0].mean(axis=0)) - np.log(p[codes[:, b] < 0].mean(axis=0))
        weights[:FEATURES, b] = np.clip(ratio, -WEIGHT_CAP, WEIGHT_CAP)
    even = np.full(codes.shape, 1 / max(1, codes.shape[1]))
    model = LanguageModel(tuple(names), codes, weights, even)
    if not codes.shape[1]:
        return model
    share = min(1.0, RELIABILITY_ROWS / max(1, docs))
    sample = rows.filter(F.pmod(F.xxhash64(F.lit("reliability"), "id"), F.lit(1_000_000)) < int(share * 1_000_000))
    held = train.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = held.value
            margins, langs = m.margins(b.column("text")), b.column("lang").to_pylist()
            for i, lang in enumerate(m.languages):
                mine = margins[[x == lang for x in langs]]
                right = ((mine * m.codes[i]) > 0).sum(axis=0)
                yield pa.RecordBatch.from_pydict({"i": [i] * len(right), "b": list(range(len(right))), "n": [len(mine)] * len(right), "ok": right.tolist()})
            del b
        common.release_memory()

    hits = sample.mapInArrow(judge, "i long, b long, n long, ok long").groupBy("i", "b").agg(F.sum("n").alias("n"), F.sum("ok").alias("ok")).collect()
    reliable = np.ones(codes.shape)
    for r in hits:
        reliable[r["i"], r["b"]] = (r["ok"] + 1) / (r["n"] + 2)
    return LanguageModel(model.languages, codes, weights, reliable / reliable.sum(axis=1, keepdims=True))


def predict(model: LanguageModel, spark: SparkSession, text: Column) -> Column:
    """struct(lang_pred, score, ambiguous) of a text column. ``und`` with score 0 for a null text or one
    without a letter; ambiguous rows keep their best language and are only flagged."""
    held = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double,ambiguous:boolean>")
    def guess(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = held.value
        for col in batches:
            best, score = m.decode(m.margins(col)) if m.languages else (np.zeros(len(col), int), np.zeros(len(col)))
            names = pa.array(m.languages or (UNKNOWN,)).take(pa.array(best))
            yield pa.StructArray.from_arrays(
                [names.cast(pa.string()), pa.array(score, pa.float64()), pa.array(score < AMBIGUOUS_BELOW)], ["lang_pred", "score", "ambiguous"]
            )
            del col
        common.release_memory()

    letters = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    none = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("ambiguous"))
    return F.when(letters, guess.asNondeterministic()(text)).otherwise(none)


def identify(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """Learn from the rows with crc32(id) mod 4 other than 2, then label every row.

    Adds ``held_out``, ``lang_pred``, ``score`` (0 to 1) and ``ambiguous``; input columns of these
    names are replaced. Null ids count as the empty text for the split; empty tables give
    no rows; texts of any length are read whole.
    """
    held = common.crc_mod(id_col, 4) == 2
    model = fit(docs.filter(~held), text_col=text_col, lang_col=lang_col, id_col=id_col)
    names = [c for c in docs.columns if c not in ("held_out", "lang_pred", "score", "ambiguous")]
    mark = common.free("guess", docs.columns)
    out = docs.withColumn(mark, predict(model, docs.sparkSession, F.col(text_col)))
    guessed = [F.col(f"{mark}.{c}") for c in ("lang_pred", "score", "ambiguous")]
    return out.select(*[F.col(f"`{c}`") for c in names], held.alias("held_out"), *guessed)


def keep_identified(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """The input rows whose language is known: those predicted ``und`` or flagged ambiguous go."""
    model = fit(docs.filter(common.crc_mod(id_col, 4) != 2), text_col=text_col, lang_col=lang_col, id_col=id_col)
    mark = common.free("guess", docs.columns)
    g = F.col(mark)
    guessed = docs.withColumn(mark, predict(model, docs.sparkSession, F.col(text_col)))
    return guessed.filter((g["lang_pred"] != UNKNOWN) & ~g["ambiguous"]).select(*[F.col(f"`{c}`") for c in docs.columns])


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")
