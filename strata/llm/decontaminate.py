"""Benchmark decontamination by pigeonhole edit matching.

A benchmark item of m words may differ from its copy in a document by up to
k = floor(m / 5) word edits (similarity of 0.8 or more). Cut into k + 1 pieces, at least one
piece survives unchanged; so the pieces' hashes are looked up at every word of every
document, and each hit is verified by Myers' bit-parallel edit distance between the whole item and
the words around it.

Documents are never shuffled: the item pieces go to the tasks as broadcasts of bounded size each, and one pass over
the documents looks all of them up, so a task's memory grows with the benchmark (16 bytes a word of it).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .registry import query
from .text import SLICE_BYTES, hash_words, letter_words, mix64

ERROR_SHARE = 0.2
#: Shorter items match without any error.
MIN_WORDS = 5
#: Words of benchmark items sent to the tasks at once (8 bytes each, and as much again for pieces).
WORDS_PER_CHUNK = 4_000_000


def myers(pattern: list[int], text: list[int], most: int) -> tuple[int, int] | None:
    """(distance, end) of the best match of the whole pattern anywhere in the text: the smallest
    edit distance (at most ``most``) and the first end where it occurs, None if there is none. Myers'
    bit-vectors: one step per symbol of the text, each a few operations on m-bit integers."""
    m = len(pattern)
    where: dict[int, int] = {}
    for i, c in enumerate(pattern):
        where[c] = where.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = full, 0, m, (m, 0)
    for j, c in enumerate(text):
        eq = where.get(c, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        plus, minus = down | ~(xh | up) & full, up & xh
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = plus << 1 & full, minus << 1 & full
        up, down = minus | ~(xv | plus) & full, plus & xv
        if score < best[0]:
            best = (score, j + 1)
    return best if best[0] <= most else None


@dataclass(frozen=True)
class Pieces:
    """Items of one chunk, as word hashes, and their pieces by length."""

    items: tuple[tuple[int, np.ndarray, int], ...]  # id, words, errors allowed
    by_length: tuple[tuple[int, np.ndarray, np.ndarray, np.ndarray], ...]  # words, sorted hashes, item, offset


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n consecutive words."""
    h = words[: len(words) - n + 1].copy()
    for i in range(1, n):
        h = mix64(h * np.uint64(3) + words[i : len(words) - n + 1 + i])
    return h


def _sequence_hash(words: np.ndarray) -> int:
    return int(run_hashes(words, len(words))[0])


def cut_pieces(items: list[tuple[int, np.ndarray]], error_share: float = ERROR_SHARE, min_words: int = MIN_WORDS) -> Pieces:
    """Even pieces, one more than the item's error budget; items without words are left out."""
    kept, found = [], {}
    for item_id, words in items:
        if not len(words):
            continue
        n = len(kept)
        errors = int(len(words) * error_share) if len(words) >= min_words else 0
        kept.append((item_id, words, errors))
        at = np.linspace(0, len(words), errors + 2).astype(int)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            found.setdefault(b - a, []).append((_sequence_hash(words[a:b]), n, a))
    tables = []
    for length, rows in sorted(found.items()):
        rows.sort()
        tables.append((length, np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows]), np.array([r[2] for r in rows])))
    return Pieces(tuple(kept), tuple(tables))


def folded(col: pa.Array) -> pa.Array:
    """Lower case in every script, one code point for one; a final sigma counts as a sigma."""
    return pc.replace_substring(pc.utf8_lower(col), "\u03c2", "\u03c3")


def match_column(col: pa.Array, pieces: Pieces) -> list[dict[int, tuple[int, int, int]]]:
    """Per text: item id -> (distance, first word, end word) of its best match (smallest
    distance, then earliest window). The window starts are those the piece hits imply."""
    out: list[dict[int, tuple[int, int, int]]] = [{} for _ in range(len(col))]
    for w in letter_words(folded(col), SLICE_BYTES):
        words = hash_words(w)
        size = np.diff(w.first)
        doc_of = np.repeat(np.arange(w.docs), size)
        hits = []  # (document, item, implied start)
        for length, hashes, item, offset in pieces.by_length:
            if len(words) < length:
                continue
            run = run_hashes(words, length)
            lo = np.searchsorted(hashes, run)
            lo[lo == len(hashes)] = 0
            pos = np.flatnonzero(hashes[lo] == run)
            pos = pos[doc_of[pos] == doc_of[pos + length - 1]]
            hi = np.searchsorted(hashes, run[pos], side="right")
            n = hi - lo[pos]
            rows = np.repeat(lo[pos], n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
            at = np.repeat(pos, n)
            hits.append(np.stack([doc_of[at], item[rows], at - offset[rows]], axis=1))
        if hits:
            exact = None
            for d, i, at in np.unique(np.concatenate(hits), axis=0).tolist():
                if (d, i) == exact:  # a later window is no better
                    continue
                item_id, pattern, errors = pieces.items[i]
                lo, hi = max(int(w.first[d]), at - errors), min(int(w.first[d + 1]), at + len(pattern) + errors)
                found = myers(pattern.tolist(), words[lo:hi].tolist(), errors)
                if found:
                    exact = (d, i) if found[0] == 0 else None
                    first = int(w.first[d])
                    hit = (found[0], lo - first, lo + found[1] - first)
                    old = out[w.offset + d].get(item_id)
                    out[w.offset + d][item_id] = min(hit, old) if old else hit
    return out


def _chunks(benchmark: DataFrame, id_col: str, text_col: str, words_per_chunk: int) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Benchmark items as word hashes, in id order, at most ``words_per_chunk`` words held at a time
    (or one item)."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = []
            for w in letter_words(folded(b.column("text")), SLICE_BYTES):
                h = hash_words(w)
                lists += [h[w.first[d] : w.first[d + 1]].tobytes() for d in range(w.docs)]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(lists, pa.binary())], names=["id", "words"])

    rows = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter("id is not null and text is not null")
    rows = common.cut(rows.mapInArrow(hashed, "id long, words binary"))
    total = rows.agg(F.sum(F.length("words"))).first()[0] or 0
    n = max(1, -(-total // (8 * words_per_chunk)))
    for k in range(n):
        part = rows if n == 1 else rows.filter(F.pmod(F.xxhash64("id"), F.lit(n)) == k)
        yield [(r["id"], np.frombuffer(r["words"], np.uint64)) for r in part.distinct().orderBy("id").collect()]


_HIT = ("item_id", "distance", "first_word", "end_word")
HITS = "array<struct<item_id:long,distance:int,first_word:int,end_word:int>>"


def _leaks_udf(held):
    """Text column to its leaks, against the broadcast pieces of one chunk."""

    @F.arrow_udf(HITS)
    def leaks(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("first_word", pa.int32()), ("end_word", pa.int32())])
        for col in batches:
            rows = [[(i, *hit) for i, hit in sorted(found.items())] for found in match_column(col, held.value)]
            yield pa.array([[dict(zip(_HIT, r, strict=True)) for r in row] for row in rows], pa.list_(kind))
            del col
        common.release_memory()

    return leaks.asNondeterministic()


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    error_share: float = ERROR_SHARE,
    min_words: int = MIN_WORDS,
    words_per_chunk: int = WORDS_PER_CHUNK,
    out_col: str = "leaks",
) -> DataFrame:
    """The input rows with ``leaks`` (or ``out_col``): array of (item_id, distance, first_word, end_word) for every
    benchmark item found in the text within its error budget, by item id; empty if none.

    Words are runs of letters and digits, lower-cased in every script, so case, blanks and
    punctuation do not hide a copy; scripts written without blanks count a word a character. Defined cases: null and empty texts have no leaks; null
    or empty items match nothing; items under ``min_words`` words match without errors only;
    repeated items of one id are merged, best match kept; empty tables give no leaks; an input column
    of the output's name is replaced.
    """
    spark = docs.sparkSession
    names = [c for c in docs.columns if c != out_col]
    out = docs.select(*[F.col(f"`{c}`") for c in names])
    parts: list[Column] = []
    for chunk in _chunks(benchmark, item_id_col, item_text_col, words_per_chunk):
        held = spark.sparkContext.broadcast(cut_pieces(chunk, error_share, min_words))
        parts.append(_leaks_udf(held)(F.col(text_col)))
    joined = F.array_sort(F.concat(*parts)) if len(parts) > 1 else parts[0]
    return out.withColumn(out_col, joined)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The input rows whose text holds no benchmark item. An item of a single word is no evidence of a
    copy: it takes no document out (``find_leaks`` lists it, ``single_word_items`` says how many there are)."""
    mark = common.free("leaks", docs.columns)
    found = find_leaks(docs, benchmark, out_col=mark, **options)
    return found.filter(~F.exists(mark, lambda x: x["end_word"] - x["first_word"] > 1)).drop(mark)


def single_word_items(benchmark: DataFrame, item_text_col: str = "text") -> int:
    """How many benchmark items ``drop_leaks`` leaves out of account."""
    def words(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for col in batches:
            counts = [np.diff(w.first) for w in letter_words(folded(col), SLICE_BYTES)]
            yield pa.array(np.concatenate(counts) if counts else np.zeros(0, np.int64), pa.int64())

    count = F.arrow_udf(words, "long")
    return benchmark.filter(count(F.coalesce(F.col(item_text_col).cast("string"), F.lit(""))) == 1).count()


@query("op4_benchmark_leaks")
def op4_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its leaks: one row per (document, item)."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, common.table(spark, sf_dir, "benchmark")).drop("text")
    return found.select("doc_id", F.explode("leaks").alias("l")).select("doc_id", "l.item_id", "l.distance", "l.first_word", "l.end_word")
