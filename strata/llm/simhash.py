"""SimHash near-duplicates linked by Golay-code fuzzy hashing.

A text's fingerprint takes each bit by majority over the XXH64 of its word shingles.
Fingerprints that differ in at most three bits are linked.

The 64 bits are cut into three segments of 22, 21 and 21 bits. Three errors over three
segments leave at least two segments with one error or none. A segment is a 23-bit
word of the perfect Golay code (zeros in front) and decodes to exactly one codeword;
the words one flip away decode to one to six codewords. So if x and y agree in a
segment up to one bit, the codeword of y is among those near x. Every fingerprint is
stored under the codeword pair of each two segments (3 keys of 24 bits) and probes with all
pairs of near codewords (3 to 108 keys); every hit is verified by its bit distance.

Only distinct fingerprints are joined: copies of a text are one row there.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .components import components
from .registry import query
from .text import Words, split_words

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
_SEGMENTS = ((42, 22), (21, 21), (0, 21))  # shift and width
_SLICE_BYTES = 1 << 19  # a slice takes some 100 times its size
_GENERATOR = 0b101011100011  # x^11+x^9+x^7+x^6+x^5+x+1, a generator of the (23, 12) code


def _golay() -> tuple[np.ndarray, np.ndarray]:
    """(parity of each 12-bit message, error pattern of each 11-bit syndrome)."""
    def rest(v: int) -> int:
        for s in range(22, 10, -1):
            if v >> s & 1:
                v ^= _GENERATOR << (s - 11)
        return v

    parity = np.array([rest(m << 11) for m in range(1 << 12)], dtype=np.uint32)
    error = np.zeros(1 << 11, dtype=np.uint32)
    for weight in range(1, 4):
        for bits in itertools.combinations(range(23), weight):
            e = sum(1 << b for b in bits)
            error[rest(e)] = e
    return parity, error


_PARITY, _ERROR = _golay()


def codeword_index(words: np.ndarray) -> np.ndarray:
    """12-bit message of the codeword nearest to each 23-bit word (within three bits)."""
    syndrome = _PARITY[words >> 11] ^ (words & np.uint32(0x7FF))
    return (words ^ _ERROR[syndrome]) >> np.uint32(11)


def near_codewords(words: np.ndarray, width: int) -> np.ndarray:
    """(n, width + 1) codeword indices of each word and its one-bit neighbours inside the
    segment; repeats are marked with -1 so that each index stands once in a row."""
    flips = np.concatenate([np.zeros(1, np.uint32), np.uint32(1) << np.arange(width, dtype=np.uint32)])
    near = codeword_index(words[:, None] ^ flips[None, :]).astype(np.int32)
    near.sort(axis=1)
    near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
    return near


def shingle_hashes(w: Words, k: int = SHINGLE_WORDS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(XXH64 of every k-word shingle, index of the first shingle of each document + total).
    A document with fewer words has one shingle, the whole sequence; one without words none."""
    inside = np.zeros(len(w.data) + 1, dtype=np.int8)
    inside[w.start] = 1
    inside[w.end] -= 1  # where one document's word ends and the next one's begins, both cancel
    keep = np.cumsum(inside[:-1]) > 0
    # A separator after each word that has another word behind it in its document.
    words = np.diff(w.first)
    followed = np.ones(len(w.start), dtype=bool)
    followed[w.first[1:][words > 0] - 1] = False
    gap = w.end[followed]
    keep[gap] = True
    data = w.data.copy()
    data[gap] = 0x20
    at = np.concatenate([[0], np.cumsum(keep)])
    start, end = at[w.start], at[w.end]
    raw = data[keep].tobytes()
    per = np.where(words >= k, words - k + 1, np.minimum(words, 1))
    first = np.concatenate([[0], np.cumsum(per)])
    doc = np.repeat(np.arange(len(words)), per)
    a = w.first[:-1][doc] + (np.arange(first[-1]) - first[:-1][doc])
    b = np.minimum(a + k, w.first[1:][doc]) - 1
    h = xxhash.xxh64_intdigest
    hashes = np.fromiter((h(raw[i:j], seed) for i, j in zip(start[a].tolist(), end[b].tolist(), strict=True)), np.uint64, len(a))
    return hashes, first


def fingerprints(col: pa.Array, k: int = SHINGLE_WORDS, seed: int = SEED) -> np.ndarray:
    """SimHash of every text of an Arrow column, as uint64; texts without words have 0."""
    out = np.zeros(len(col), dtype=np.uint64)
    for w in split_words(col, _SLICE_BYTES):
        hashes, first = shingle_hashes(w, k, seed)
        full = np.flatnonzero(first[1:] > first[:-1])
        if not len(full):
            continue
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, first[:-1][full], axis=0, dtype=np.uint32)
        majority = ones * 2 > (first[1:] - first[:-1])[full][:, None]
        out[w.offset + full] = np.packbits(majority, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprint_udf(k: int = SHINGLE_WORDS, seed: int = SEED):
    """Text column to fingerprint, as the signed long with the same bits."""

    @F.arrow_udf("long")
    def simhash(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for col in batches:
            yield pa.array(fingerprints(col, k, seed).view(np.int64))
            del col
        common.release_memory()

    return simhash.asNondeterministic()


def _segment_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per fingerprint the 3 keys it is stored under and the keys it probes with."""
    for batch in batches:
        fp = batch.column("fp").to_numpy().view(np.uint64)
        for lo in range(0, len(fp), 4096):
            x = fp[lo : lo + 4096]
            seg = [((x >> np.uint64(s)) & np.uint64((1 << n) - 1)).astype(np.uint32) for s, n in _SEGMENTS]
            own = [codeword_index(s).astype(np.int32) for s in seg]
            near = [near_codewords(s, n) for s, (_, n) in zip(seg, _SEGMENTS, strict=True)]
            mine, probes, rows = [], [], []
            for p, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
                mine.append(p << 24 | own[i] << 12 | own[j])
                grid = p << 24 | near[i][:, :, None] << 12 | near[j][:, None, :]
                ok = (near[i] >= 0)[:, :, None] & (near[j] >= 0)[:, None, :]
                probes.append(grid[ok])
                rows.append(np.repeat(np.arange(len(x)), ok.sum(axis=(1, 2))))
            row = np.concatenate(rows)
            order = np.argsort(row, kind="stable")
            first = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(x)))])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(x.view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, 3 * len(x) + 1, 3), pa.int32()), pa.array(np.stack(mine, axis=1).ravel(), pa.int32())),
                    pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(np.concatenate(probes)[order], pa.int32())),
                ],
                names=["fp", "own", "near"],
            )


def link_fingerprints(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b) for all pairs of a frame of distinct fingerprints (``fp`` long) that differ in at
    most ``max_bits`` (at most 3) bits; a < b, each pair up to three times."""
    if max_bits > 3:
        raise ValueError("three Golay segments guarantee two near ones up to 3 bits only")
    keys = common.cut(distinct.select("fp").mapInArrow(_segment_keys, "fp long, own array<int>, near array<int>"))
    stored = keys.select(F.explode("own").alias("key"), F.col("fp").alias("b"))
    probes = keys.select(F.explode("near").alias("probe"), F.col("fp").alias("a"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return probes.join(stored, (F.col("probe") == F.col("key")) & (F.col("a") < F.col("b")) & close).select("a", "b")


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    seed: int = SEED,
    carry: Sequence[str] = (),
) -> DataFrame:
    """(id, fp, component_id, component, and the columns to ``carry``) for every row: the fingerprint, the smallest id that can
    be reached over links, the row itself included, and the smallest fingerprint so reached.

    Defined cases: null and empty texts have fingerprint 0, which links like any other; null ids
    are skipped by the minimum, and a component of null ids only has a null id; repeated rows
    stay; an empty table gives no rows. The id column keeps its name and type.
    """
    fp = common.cut(docs.select(F.col(id_col), *carry, fingerprint_udf(k, seed)(F.col(text_col)).alias("fp")))
    distinct = common.cut(fp.groupBy("fp").agg(F.min(id_col).alias("least")))
    tree = components(link_fingerprints(distinct, max_bits))
    tree = tree.select(F.col("node").alias("fp"), "component")
    named = distinct.join(tree, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    first = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_fp = named.join(first, "component").select("fp", "component_id", "component")
    return fp.join(by_fp, "fp").select(F.col(id_col), "fp", "component_id", "component", *carry)


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, seed: int = SEED) -> DataFrame:
    """The input rows less near-duplicates: one row per component, that with the smallest id."""
    # Rows are told apart by id and a hash of the text; rows alike in both are copies.
    own = [common.free(c, docs.columns) for c in ("row_id", "text_hash")]
    known = docs.withColumns(dict(zip(own, (F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.xxhash64(text_col)), strict=True)))
    found = near_duplicates(known, id_col=id_col, text_col=text_col, k=k, max_bits=max_bits, seed=seed, carry=own)
    heads = found.filter(F.col(id_col).eqNullSafe(F.col("component_id"))).groupBy("component")
    heads = common.cut(heads.agg(F.min(F.struct(*own)).alias("h")).select("h.*"))
    # The texts are shuffled once: the join and the aggregate share the partitioning.
    kept = known.join(heads, own).dropDuplicates(own)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


@query("op3_simhash_neardup")
def op3_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
