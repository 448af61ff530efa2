"""A Katz backoff language model: Good-Turing discounted n-gram counts, exactly normalised
backoff weights, stored in partitioned tables and evaluated recursively per token.

Layout. Documents are packed once into blocks: the block's distinct words (64-bit hashes, sorted)
and every token as an index into them. A block asks for what it needs, each
distinct word or n-gram once however often it occurs, so a frequent one costs a row entry
per block; the answers come back in the order of the questions, so nothing but counts, places and the sums of
contexts travels back. While a level is learnt the same questions carry the training counts, so a block is counted and
answered in one exchange. What a block has been told is kept beside its tokens as one row, its state, so the next
level's questions need no exchange of blocks.

An n-gram's id is its bucket and its place there, and it is the key of the context it forms one level up: ids ascend in
the order in which a block asks, so they travel as small differences. Bigrams are dealt to buckets by a hash of their
context, longer n-grams go where their context was counted, all words that follow a context together, as the
normalisation needs them. A context so frequent that it would fill a bucket is split over many by its next word, and
its partial sums are added up.

Model. With c the count of (h, w), p(w | h) = d(c) c / c(h) if c > 0, else a(h) p(w | h'), h' being h
without its first word. d(c) is Katz's Good-Turing discount up to ``GT_MAX`` (d = 1 above). a(h) divides the
mass left by the seen words by the lower-order mass of the unseen ones, so every context sums to one. A
context whose words all occur more than ``GT_MAX`` times leaves nothing; it is counted once more
(c(h) + 1) and that share is left. Unigrams leave their mass to one unknown-word event.

Words are known by 64-bit hashes: with v distinct words the chance of any collision is about v * v / 2**65. Ids are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import conf, remove_path, scratch_path

from . import common
from .registry import query
from .text import hash_words, mix64, split_words

ORDER = 3
GT_MAX = 5
#: A block's task takes some 25 times this.
BLOCK_BYTES = 8 << 20
_SLICE_BYTES = 1 << 20
#: Buckets are sized by the tokens of the corpus; a context with more than a quarter of a bucket's is split.
TOKENS_PER_BUCKET = 2_500_000
SPLIT_SHARE = 4

#: Kinds of the rows that a level has only while it is learnt: what its weights are made of, the answers to the blocks' questions.
EVIDENCE, ANSWER = 8, 9
#: Bytes of states that one task reads.
_STATE_BYTES = "16m"

_END = np.uint64(1)  # the end token; word hashes are larger
_UNKNOWN = np.uint32(0xFFFFFFFF)
_START = np.uint64(1 << 62)  # the context before a document's first word; ids are smaller
_LOW = np.uint64(0xFFFFFFFF)
_HALF = np.uint64(32)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_ROW = "key long, kind int, part long, a binary, b binary, c binary, d binary, e binary, f binary, g binary, h binary, stats array<long>"
_NAMES = [c.split()[0] for c in _ROW.split(", ")]


def pack(values: np.ndarray) -> bytes:
    """Byte planes of an array, compressed: neighbours in a plane are alike."""
    if not len(values):
        return b""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes | None, kind: type) -> np.ndarray:
    if not data:
        return np.zeros(0, kind)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending values as their differences."""
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(data: bytes | None, kind: type) -> np.ndarray:
    return np.cumsum(unpack(data, kind), dtype=kind)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"key": pa.int64(), "kind": pa.int32(), "part": pa.int64(), "stats": pa.list_(pa.int64())}
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], kinds.get(n, pa.binary())) for n in _NAMES], names=_NAMES)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of sorted 64-bit keys by range."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start of each run of equal values, and the total length at the end)."""
    if not len(sorted_values):
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    start = np.concatenate([[0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1])
    return start, np.append(start, len(sorted_values))


# --- discounts and weights -------------------------------------------------------------------


def good_turing(n: list[int]) -> np.ndarray:
    """Katz's discounts d(0..GT_MAX) from the numbers of n-grams seen 1, 2, ... GT_MAX + 1 times; d(0) is
    unused. Where the counts give no discount inside (0, 1), (r - 1/2) / r takes its place."""
    d = np.ones(GT_MAX + 1)
    top = (GT_MAX + 1) * n[GT_MAX] / n[0] if n[0] else 1.0
    for r in range(1, GT_MAX + 1):
        d[r] = (r - 0.5) / r
        if top < 1 and n[r - 1] and n[r]:
            katz = ((r + 1) * n[r] / (r * n[r - 1]) - top) / (1 - top)
            d[r] = katz if 0 < katz < 1 else d[r]
    return d


def _discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return counts * np.where(counts <= GT_MAX, d[np.minimum(counts, GT_MAX).astype(np.int64)], 1.0)


def backoff_weights(total: np.ndarray, few: np.ndarray, seen: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a(h), 1 where the context is counted once more): ``total`` is c(h), ``few[:, r - 1]`` the number
    of words seen r times after h, ``seen`` the lower-order probability of all words seen after h."""
    left = few @ ((1 - d[1:]) * np.arange(1, GT_MAX + 1))
    once = left <= 0
    return np.where(once, 1.0, left) / (total + once) / np.maximum(1 - seen, 1e-300), once.astype(np.uint8)


@dataclass(frozen=True)
class Unigrams:
    """p(w) as a function of the count of w."""

    tokens: int
    words: int
    discounts: np.ndarray
    more: int
    unknown: float

    @classmethod
    def of(cls, tokens: int, words: int, n: list[int]) -> Unigrams:
        d = good_turing(n)
        left = float(sum(k * r * (1 - d[r]) for r, k in enumerate(n[:GT_MAX], 1)))
        more = int(left <= 0)
        return cls(tokens, words, d, more, (left or 1.0) / (tokens + more))

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, _discounted(counts, self.discounts) / max(self.tokens + self.more, 1), self.unknown)


@dataclass(frozen=True)
class Katz:
    """What the tasks need to know of a model: constants, and the weights of split contexts."""

    order: int
    buckets: int
    split_above: int
    train_docs: int
    unigrams: Unigrams | None = None
    discounts: dict[int, np.ndarray] = field(default_factory=dict)
    split: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)  # level: contexts, weights, once more


# --- blocks ----------------------------------------------------------------------------------


@dataclass
class Blocks:
    """A corpus in blocks (a stored table), and by model what its blocks know: their states up to a level, and answers
    that are not part of a state yet. With ``single`` the stored words go once a model has answered them."""

    table: DataFrame
    path: str
    tokens: int
    train_docs: int
    single: bool = False
    states: dict[str, tuple[int, DataFrame, str]] = field(default_factory=dict)  # model: level, table, folder
    answers: dict[tuple[str, int], tuple[DataFrame, str]] = field(default_factory=dict)  # model and level: table, folder


def encode_blocks(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", train: Column | None = None, single: bool = False) -> Blocks:
    """Pack documents: each row of the table is a block of up to ``BLOCK_BYTES`` of text, or one longer
    document. ``train`` marks the rows to learn from (default: all). ``single``: for one model only."""
    path = scratch_path(docs.sparkSession, "lm", "blocks")
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), (train if train is not None else F.lit(True)).alias("train")
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes, sizes, weight, first = [], [], 0, 0

            def block(upto: int) -> pa.RecordBatch:
                tokens, n = np.concatenate(hashes), np.concatenate(sizes)
                learn = np.array(b.column("train").slice(first, upto - first).fill_null(False).to_pylist(), dtype=bool)
                ids = b.column("id").slice(first, upto - first)
                words, at = np.unique(tokens, return_inverse=True)
                counts = np.bincount(at[np.repeat(learn, n)], minlength=len(words)).astype(np.uint32)
                return pa.RecordBatch.from_pydict({
                    "ids": [pack(ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))], "given": [pack(np.array(ids.is_valid().to_pylist(), np.uint8))],
                    "n_train": [int(learn.sum())], "n_tokens": [len(tokens)], "n": [pack(n)], "train": [pack(learn.astype(np.uint8))],
                    "tokens": [pack(at.astype(np.uint32))], "words": [pack(words)], "counts": [pack(counts)],
                })

            for w in split_words(b.column("text"), _SLICE_BYTES):
                if weight and weight + len(w.data) > BLOCK_BYTES:
                    yield block(w.offset)
                    hashes, sizes, weight, first = [], [], 0, w.offset
                hashes.append(np.insert(hash_words(w), w.first[1:], _END))
                sizes.append(np.diff(w.first) + 1)
                weight += len(w.data)
            if hashes:
                yield block(b.num_rows)

    kind = "ids binary, given binary, n_train long, n_tokens long, n binary, train binary, tokens binary, words binary, counts binary"
    table = common.stored(rows.mapInArrow(encode, kind).withColumn("block", F.monotonically_increasing_id()), path)
    s = table.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.sum("n_train"), F.lit(0))).first()
    return Blocks(table, path, s[0], s[1], single)


#: A block's state: its key, and packed document ids, which of them are given, token numbers, training marks, word ids, their counts,
#: tokens; then the parts of ``Told`` for each level from the second.
_STATE = "key long, parts array<binary>"
_OWN = 7


@dataclass
class Told:
    """What a level's answers tell a block, in the order of its n-grams and contexts."""

    counts: np.ndarray  # of the n-grams
    once: np.ndarray  # whether a context is counted once more
    need: np.ndarray  # the contexts that an unseen word follows here; the others need no weight
    weights: np.ndarray  # of those
    ids: np.ndarray  # of the n-grams with a count, empty on the highest level

    KINDS = (np.uint32, np.uint8, np.uint32, np.float64, np.uint64)

    @classmethod
    def of(cls, rows: pa.Table, d: np.ndarray) -> Told:
        """From a block's answers (see ``_reply``)."""
        columns = (rows.column(c).to_pylist() for c in ("part", *"abcdefgh"))
        found = sorted(zip(*columns, strict=True), key=lambda r: r[0])
        joined = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts])
        once = [unpack(r[2], np.uint8) for r in found]
        first = np.cumsum([0, *map(len, once)])
        need = [unpack_sorted(r[3], np.uint32) + np.uint32(f) for r, f in zip(found, first, strict=False)]
        weights = []
        for _, _, _, _, few, total, _, seen, w in found:
            if w is None:
                w, _ = backoff_weights(unpack(total, np.int64), unpack(few, np.uint32).reshape(-1, GT_MAX), unpack(seen, np.float64), d)
                weights.append(w)
            else:
                weights.append(unpack(w, np.float64))
        ids = [(np.uint64(r[0]) << _HALF) | unpack_sorted(r[6], np.uint32) for r in found]
        return cls(*(joined(p, k) for p, k in zip(([unpack(r[1], np.uint32) for r in found], once, need, weights, ids), cls.KINDS, strict=True)))

    def pack(self) -> list[bytes]:
        return [pack(self.counts), pack(self.once), pack_sorted(self.need), pack(self.weights), pack_sorted(self.ids)]

    @classmethod
    def unpack(cls, parts: list[bytes]) -> Told:
        return cls(*(f(p, k) for f, p, k in zip((unpack, unpack, unpack_sorted, unpack, unpack_sorted), parts, cls.KINDS, strict=True)))


class Block:
    """One block with the answers it has so far: token arrays by level."""

    def __init__(self, parts: list[bytes], model: Katz, *told: Told):
        ids, given, n, train, words, counts, tokens = parts[:_OWN]
        self.model, self.n = model, unpack(n, np.int64)
        self.docs = pa.array(unpack(ids, np.int64), mask=unpack(given, np.uint8) == 0)
        self.tokens, self.words = unpack(tokens, np.uint32), unpack_sorted(words, np.uint32)
        self.first = np.cumsum(self.n) - self.n
        self.train = np.repeat(unpack(train, np.uint8).astype(bool), self.n)
        self.told = [*(Told.unpack(parts[i : i + 5]) for i in range(_OWN, len(parts), 5)), *told]  # from level 2
        self.counts = {1: unpack(counts, np.uint64).astype(np.int64)[self.tokens]}
        self.asked: dict[int, Grams] = {}

    def _previous(self, values: np.ndarray, at_start) -> np.ndarray:
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[self.first] = at_start
        return out

    def context_count(self, level: int) -> np.ndarray:
        """How often training holds each token's context."""
        return self._previous(self.count(level - 1), self.model.train_docs)

    def _places(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """(place of the n-gram that ends at each token among the block's, where training holds it; the ids of the places)."""
        if level == 1:
            return self.tokens, self.words.astype(np.uint64)
        g, told = self.grams(level), self.told[level - 2]
        place = np.zeros(len(self.tokens), np.uint32)
        place[g.at] = g.gram
        ids = np.zeros(len(told.counts), np.uint64)
        ids[told.counts > 0] = told.ids
        return place, np.maximum.accumulate(ids)  # nobody asks for those without a count

    def grams(self, level: int) -> Grams:
        """The distinct n-grams whose context training holds, in the order of buckets, contexts and words."""
        if level in self.asked:
            return self.asked[level]
        model, total = self.model, self.context_count(level)
        at = np.flatnonzero(total > 0)
        place, ids = self._places(level - 1)
        context = self._previous(place, len(ids))[at]
        ids = np.append(ids, _START + np.uint64(level))
        buckets = np.uint64(model.buckets)
        home = (mix64(ids) if level == 2 else ids >> _HALF) % buckets
        parts = -(-total[at] // model.split_above)
        split = parts > 1
        tokens = self.tokens[at]
        share = mix64(self.words[tokens[split]].astype(np.uint64) + _STEP) % parts[split].astype(np.uint64)
        dealt = mix64(ids[context[split]] + (share + np.uint64(1)) * _STEP) % buckets
        pair, of = np.unique(context[split].astype(np.uint64) << _HALF | dealt, return_inverse=True)
        context[split] = len(ids) + of
        key, bucket = np.append(ids, ids[pair >> _HALF]), np.append(home, pair & _LOW)
        order = np.lexsort((key, bucket))
        rank = np.empty(len(order), np.uint64)
        rank[order] = np.arange(len(order), dtype=np.uint64)
        distinct, gram = np.unique(rank[context] << _HALF | tokens, return_inverse=True)
        del context, tokens, total, parts, split
        gram = gram.astype(np.uint32)
        token = np.empty(len(distinct), np.int64)
        token[gram] = at
        start, bounds = _runs(distinct >> _HALF)
        held = order[distinct[start] >> _HALF]
        self.asked[level] = Grams(key[held], bucket[held].astype(np.int64), held >= len(ids), start, np.diff(bounds), token, at, gram)
        return self.asked[level]

    def count(self, level: int) -> np.ndarray:
        """How often training holds the n-gram that ends at each token."""
        if level not in self.counts:
            self._answer(level)
        return self.counts[level]

    def _answer(self, level: int) -> None:
        g, told = self.grams(level), self.told[level - 2]
        full = lambda v, kind: np.full(len(self.tokens), v, kind)
        c, a, more = full(0, np.int64), full(1.0, np.float64), full(0, np.int64)
        weights, once = np.ones(len(g.keys)), told.once.copy()
        weights[told.need] = told.weights
        if g.big.any():
            keys, w, o = self.model.split[level]
            pos = np.searchsorted(keys, g.keys[g.big])
            weights[g.big], once[g.big] = w[pos], o[pos]
        context = np.repeat(np.arange(len(g.keys)), g.runs)[g.gram]
        c[g.at], a[g.at], more[g.at] = told.counts[g.gram], weights[context], once[context]
        self.counts[level], self.weights, self.more = c, a, more

    def probability(self, level: int) -> np.ndarray:
        """p of each token given the words before it, by recursion over the levels."""
        if level == 1:
            return self.model.unigrams.probability(self.counts[1])
        self._answer(level)
        c, a, total = self.counts[level], self.weights, self.context_count(level) + self.more
        lower = self.probability(level - 1)
        return np.where(c > 0, _discounted(c, self.model.discounts[level]) / np.maximum(total, 1), a * lower)


@dataclass
class Grams:
    keys: np.ndarray  # ids of the distinct contexts, ascending in a bucket
    bucket: np.ndarray  # of each context, ascending
    big: np.ndarray  # whether the context is split
    start: np.ndarray  # first n-gram of each context
    runs: np.ndarray  # n-grams of each context
    token: np.ndarray  # a token that ends each n-gram
    at: np.ndarray  # the tokens whose context training holds
    gram: np.ndarray  # n-gram of each of them

    def slices(self) -> Iterator[tuple[int, slice, slice]]:
        """(bucket, its contexts, its n-grams)."""
        start, bounds = _runs(self.bucket)
        ends = np.append(self.start, len(self.token))
        for s, e in zip(start.tolist(), bounds[1:].tolist(), strict=True):
            yield int(self.bucket[s]), slice(s, e), slice(int(ends[s]), int(ends[e]))


# --- tasks -----------------------------------------------------------------------------------


def _word_questions(buckets: int, counted: bool):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, packed, c in zip(b.column("block").to_pylist(), b.column("words").to_pylist(), b.column("counts").to_pylist(), strict=True):
                words, counts = unpack(packed, np.uint64), unpack(c, np.uint32)
                dealt = _bucket(words, buckets)
                start, ends = _runs(dealt)
                rows = []
                for s, e in zip(start.tolist(), ends[1:].tolist(), strict=True):
                    row = {"key": int(dealt[s]), "kind": 0, "part": block, "a": pack(words[s:e])}
                    rows.append(row | {"b": pack(counts[s:e])} if counted else row)
                yield _batch(rows)

    return ask


def _histogram(counts: np.ndarray) -> list[int]:
    return [int((counts == r).sum()) for r in range(1, GT_MAX + 2)]


def _count_words(buckets: int):
    """Counts of a bucket's words (ids go by falling count, so frequent words have small ids), and the answers to its blocks."""
    def count(key: tuple, rows: pa.Table) -> pa.Table:
        asked = [unpack(x, np.uint64) for x in rows.column("a").to_pylist()]
        counts = np.concatenate([unpack(x, np.uint32) for x in rows.column("b").to_pylist()])
        distinct, at = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, at, counts)
        known = total > 0
        words, n = distinct[known], total[known]
        bucket = key[0].as_py()
        ids = np.empty(len(words), np.int64)
        ids[np.lexsort((words, -n))] = np.arange(len(words)) * buckets + bucket
        if len(ids) and ids.max() >= int(_UNKNOWN):
            raise ValueError("more distinct words than 32-bit ids can tell apart")
        stats = [int(n.sum()), len(n), *_histogram(n)]
        out = [{"key": bucket, "kind": 1, "a": pack(words), "b": pack(n.astype(np.uint64)), "c": pack(ids.astype(np.uint32)), "stats": stats}]
        every = np.full(len(distinct), _UNKNOWN)
        every[known] = ids
        ends = np.cumsum([len(x) for x in asked])
        for part, mine in zip(rows.column("part").to_pylist(), np.split(at, ends[:-1]), strict=True):
            out.append({"key": part, "kind": ANSWER, "part": bucket, "a": pack(every[mine]), "b": pack(total[mine].astype(np.uint64))})
        return pa.Table.from_batches([_batch(out)])

    return count


def _find_words(key: tuple, rows: pa.Table) -> pa.Table:
    words, counts, ids, out = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.uint32), []
    columns = [rows.column(c).to_pylist() for c in ("kind", "part", "a", "b", "c")]
    for kind, _, a, b, c in zip(*columns, strict=True):
        if kind == 1:
            words, counts, ids = unpack(a, np.uint64), unpack(b, np.uint64), unpack(c, np.uint32)
    for kind, part, a, *_ in zip(*columns, strict=True):
        if kind == 0:
            want = unpack(a, np.uint64)
            got_id, got = np.full(len(want), _UNKNOWN), np.zeros(len(want), np.uint64)
            if len(words):
                at = np.minimum(np.searchsorted(words, want), len(words) - 1)
                hit = words[at] == want
                got_id[hit], got[hit] = ids[at[hit]], counts[at[hit]]
            out.append({"key": part, "kind": ANSWER, "part": key[0].as_py(), "a": pack(got_id), "b": pack(got)})
    return pa.Table.from_batches([_batch(out)])


def _state_row(key: int, parts: list[bytes]) -> pa.Table:
    return pa.table({"key": pa.array([key], pa.int64()), "parts": pa.array([parts], pa.list_(pa.binary()))})


def _first_state(key: tuple, block: pa.Table, found: pa.Table) -> pa.Table:
    """A block with word ids in place of hashes; words that training does not hold are one."""
    b = block.to_pylist()[0]
    rows = sorted(zip(*(found.column(c).to_pylist() for c in ("part", "a", "b")), strict=True))
    ids, counts = (np.concatenate([unpack(r[i], k) for r in rows]) for i, k in ((1, np.uint32), (2, np.uint64)))
    words, first, place = np.unique(ids, return_index=True, return_inverse=True)
    tokens = place[unpack(b["tokens"], np.uint32)].astype(np.uint32)
    return _state_row(key[0].as_py(), [*(b[c] for c in ("ids", "given", "n", "train")), pack_sorted(words), pack(counts[first]), pack(tokens)])


def _next_state(held, level: int):
    def tell(key: tuple, state: pa.Table, found: pa.Table) -> pa.Table:
        return _state_row(key[0].as_py(), state.column("parts")[0].as_py() + Told.of(found, held.value.discounts[level]).pack())

    return tell


def _gram_questions(held, level: int, counted: bool):
    """Rows of n-grams by bucket: contexts (a), run lengths (b), words (c); when counting also the training
    counts (d), the lower-order evidence (e: counts, h: totals of the lower contexts, above bigrams), and which contexts are
    parts of a split one (f)."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, parts in zip(batch.column("key").to_pylist(), batch.column("parts"), strict=True):
                block = Block(parts.as_py(), held.value)
                g = block.grams(level)
                ids, runs = block.words[block.tokens[g.token]], g.runs.astype(np.uint32)
                if counted:
                    n = np.bincount(g.gram[block.train[g.at]], minlength=len(g.token)).astype(np.uint32)
                    lower = block.count(level - 1)[g.token]
                    if level > 2:
                        total = (block.context_count(level - 1) + block.more)[g.token[g.start]]
                for bucket, c, w in g.slices():
                    row = {"key": bucket, "kind": 0, "part": key, "a": pack_sorted(g.keys[c]), "b": pack(runs[c]), "c": pack(ids[w])}
                    if counted:
                        row |= {"d": pack(n[w]), "e": pack(lower[w]), "f": pack(np.flatnonzero(g.big[c]).astype(np.uint32))}
                        if level > 2:
                            row["h"] = pack(total[c])
                    yield _batch([row])

    return ask


def _sums(n: np.ndarray, p: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of contexts whose n-grams start at ``first``: (totals, numbers of words seen 1, 2, ... times, lower mass of the seen words)."""
    sums = lambda x: np.add.reduceat(x, first) if len(first) else x
    few = np.stack([sums((n == r).astype(np.int64)) for r in range(1, GT_MAX + 1)], axis=1).astype(np.uint32)
    return sums(n), few, sums(p)


def _lower(model: Katz, level: int, lower: np.ndarray, total: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """p of the n-grams' words one level down, from their evidence."""
    if level == 2:
        return model.unigrams.probability(lower)
    return _discounted(lower, model.discounts[level - 1]) / np.repeat(total, runs)


class _Held:
    """The n-grams that a bucket holds, to answer questions."""

    def __init__(self, bucket: int, keys: np.ndarray, runs: np.ndarray, words: np.ndarray, n: np.ndarray, once: np.ndarray, ids: bool):
        self.bucket, self.keys, self.n, self.once, self.ids = bucket, keys, n, once, ids
        self.code = np.repeat(np.arange(len(keys), dtype=np.uint64), runs) << _HALF | words.astype(np.uint64)

    def reply(self, part: int, a: bytes, b: bytes, c: bytes) -> tuple[dict, np.ndarray]:
        """The answer to a block: counts a in the order of its n-grams, once-more flags b of its contexts, the contexts that an
        unseen word follows (c), the places of the n-grams that are here (f, if there is a level above); and the places
        here of the contexts c, whose sums (d: few, e: totals, g: lower mass) or weights (h) the caller adds."""
        want, runs, words = unpack_sorted(a, np.uint64), unpack(b, np.uint32), unpack(c, np.uint32)
        got, once, of, places = np.zeros(len(words), np.uint32), np.ones(len(want), np.uint8), np.full(len(want), -1), words[:0]
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
            hit = self.keys[at] == want
            asked = np.repeat(at.astype(np.uint64), runs) << _HALF | words.astype(np.uint64)
            pos = np.minimum(np.searchsorted(self.code, asked), len(self.code) - 1)
            same = (self.code[pos] == asked) & np.repeat(hit, runs)
            got[same] = self.n[pos[same]]
            once[hit] = self.once[at[hit]]
            of[hit] = at[hit]
            places = pos[same].astype(np.uint32)
        # Words that training has not seen after a context need its weight, the others only its total.
        need = np.zeros(len(want), bool)
        need[np.repeat(np.arange(len(want)), runs)[got == 0]] = True
        need &= of >= 0
        row = {"key": part, "kind": ANSWER, "part": self.bucket, "a": pack(got), "b": pack(once), "c": pack_sorted(np.flatnonzero(need).astype(np.uint32))}
        return row | ({"f": pack_sorted(places)} if self.ids else {}), of[need]


def _count_grams(held, level: int):
    """Rows of the model (kind 1; 3: parts of split contexts), the evidence of its weights (``EVIDENCE``) and the answers to every
    block's questions (``ANSWER``)."""
    def count(key: tuple, rows: pa.Table) -> pa.Table:
        model, bucket = held.value, key[0].as_py()
        parts: dict[str, list[np.ndarray]] = {c: [] for c in "kcdehf"}
        asked = []
        for part, a, b, c, d, e, f, h in zip(*(rows.column(x).to_pylist() for x in ("part", *"abcdefh")), strict=True):
            keys, runs, n = unpack_sorted(a, np.uint64), unpack(b, np.uint32), unpack(d, np.uint32)
            asked.append((part, a, b, c))
            mine = n > 0
            parts["k"].append(np.repeat(keys, runs)[mine])
            parts["c"].append(unpack(c, np.uint32)[mine])
            parts["d"].append(n[mine])
            parts["e"].append(unpack(e, np.int64)[mine])
            parts["h"].append(np.repeat(unpack(h, np.int64), runs)[mine] if level > 2 else np.zeros(0, np.int64))
            parts["f"].append(keys[unpack(f, np.uint32)])
        k, w, n, lower, under, split = (np.concatenate(parts.pop(x)) for x in "kcdehf")
        order = np.lexsort((w, k))
        k, w, n = k[order], w[order], n[order].astype(np.int64)
        start = np.flatnonzero(np.concatenate([np.ones(min(len(k), 1), bool), (k[1:] != k[:-1]) | (w[1:] != w[:-1])]))
        k, w, n, lower = k[start], w[start], np.add.reduceat(n, start) if len(k) else n, lower[order[start]]
        first, bounds = _runs(k)
        under = under[order[start[first]]] if level > 2 else under
        del order, start
        runs, keys = np.diff(bounds).astype(np.uint32), k[first]
        total, few, seen = _sums(n, _lower(model, level, lower, under, runs), first)
        never = (few.sum(axis=1) == 0).astype(np.uint8)  # no discount lies at 0 or 1: then and only then nothing is left
        counts = pack(n.astype(np.uint32))
        out = [
            {"key": bucket, "kind": 1, "a": pack_sorted(keys), "b": pack(runs), "c": pack(w), "d": counts, "stats": _histogram(n)},
            {"key": bucket, "kind": EVIDENCE, "b": pack(runs), "d": counts, "e": pack(lower), "h": pack(under)},
        ]
        if len(split) and len(keys):
            split = np.unique(split)
            at = np.minimum(np.searchsorted(keys, split), len(keys) - 1)
            at = at[keys[at] == split]  # a part may hold words of held-out texts only
            out.append({"key": bucket, "kind": 3, "a": pack(keys[at]), "e": pack(total[at]), "f": pack(few[at].ravel()), "g": pack(seen[at])})
        here = _Held(bucket, keys, runs, w, n, never, level < model.order)
        del k, lower, under
        for question in asked:
            row, at = here.reply(*question)
            out.append(row | {"d": pack(few[at].ravel()), "e": pack(total[at]), "g": pack(seen[at])})
        return pa.Table.from_batches([_batch(out)])

    return count


def _weigh(held, level: int, discounts: np.ndarray):
    """Backoff weights (a) and once-more flags (b) of a bucket's contexts, in their order."""
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, b, d, e, h in zip(*(batch.column(c).to_pylist() for c in ("key", *"bdeh")), strict=True):
                runs, n = unpack(b, np.uint32), unpack(d, np.uint32).astype(np.int64)
                p = _lower(held.value, level, unpack(e, np.int64), unpack(h, np.int64), runs)
                total, few, seen = _sums(n, p, np.cumsum(runs, dtype=np.int64) - runs)
                w, once = backoff_weights(total, few, seen, discounts)
                yield _batch([{"key": key, "kind": 2, "a": pack(w), "b": pack(once)}])

    return weigh


def _find_grams(level: int, order: int):
    def find(key: tuple, rows: pa.Table) -> pa.Table:
        by: dict[int, list[tuple]] = {}
        for kind, part, a, b, c, d in zip(*(rows.column(x).to_pylist() for x in ("kind", "part", "a", "b", "c", "d")), strict=True):
            by.setdefault(kind, []).append((part, a, b, c, d))
        if 0 not in by:
            return pa.Table.from_batches([_batch([])])
        _, a, b, c, d = by[1][0] if 1 in by else [None] * 5
        _, w, once, *_ = by[2][0] if 2 in by else [None] * 3
        weights = unpack(w, np.float64)
        runs, words, n = (unpack(x, np.uint32) for x in (b, c, d))
        here = _Held(key[0].as_py(), unpack_sorted(a, np.uint64), runs, words, n, unpack(once, np.uint8), level < order)
        out = []
        for part, a, b, c, _ in by[0]:
            row, at = here.reply(part, a, b, c)
            out.append(row | {"h": pack(weights[at])})
        return pa.Table.from_batches([_batch(out)])

    return find


# --- the model -------------------------------------------------------------------------------


@dataclass(frozen=True)
class KatzModel:
    """``path`` holds one table per level, ``level=k``, partitioned by kind (1: n-grams, 2: backoff weights, 3: parts
    of split contexts); rows are buckets."""

    path: str
    katz: Katz

    def level(self, spark: SparkSession, k: int) -> DataFrame:
        return spark.read.schema(_ROW).parquet(f"{self.path}/level={k}").filter(F.col("kind") < EVIDENCE)


def _rows(df: DataFrame) -> DataFrame:
    """Bring a frame to the common row layout; missing columns are null."""
    kinds = dict(c.split(" ", 1) for c in _ROW.split(", "))
    return df.select(*[(F.col(n) if n in df.columns else F.lit(None)).cast(kinds[n]).alias(n) for n in _NAMES])


def _stored(df: DataFrame, path: str, *partition: str) -> DataFrame:
    with conf(df.sparkSession, **{"spark.sql.files.maxPartitionBytes": _STATE_BYTES}):
        return common.stored(df, path, *partition)


def _states(blocks: Blocks, model: KatzModel, level: int) -> DataFrame:
    """The blocks with what the model has told them up to a level (or further). A state takes the place of the one before it and of the
    answers it holds, whose files go."""
    spark = blocks.table.sparkSession
    at, table, folder = blocks.states.get(model.path, (0, None, None))
    while at < level:
        at += 1
        found, answered = answers(blocks, model, at), blocks.answers[model.path, at][1]
        if at == 1:
            of = blocks.table.select(F.col("block").alias("key"), "ids", "given", "n", "train", "tokens")
            old, tell = blocks.path if blocks.single else None, _first_state
        else:
            of, old, tell = table, folder, _next_state(spark.sparkContext.broadcast(model.katz), at)
        folder = scratch_path(spark, "lm", "states")
        told = of.groupBy("key").cogroup(found.groupBy("key")).applyInArrow(tell, _STATE)
        table = _stored(told, folder)
        blocks.states[model.path] = (at, table, folder)
        del blocks.answers[model.path, at]
        for path in filter(None, (old, answered)):
            remove_path(spark, path)
    return table


def answers(blocks: Blocks, model: KatzModel, level: int) -> DataFrame:
    """What the model knows of a corpus's words (level 1) or n-grams, by block; computed once."""
    spark = blocks.table.sparkSession
    if (model.path, level) not in blocks.answers:
        if level == 1:
            asked = blocks.table.select("block", "words", "counts").mapInArrow(_word_questions(model.katz.buckets, False), _ROW)
            known = model.level(spark, 1).filter("kind = 1")
            found = asked.unionByName(_rows(known)).groupBy("key").applyInArrow(_find_words, _ROW)
        else:
            held = spark.sparkContext.broadcast(model.katz)
            asked = _states(blocks, model, level - 1).mapInArrow(_gram_questions(held, level, False), _ROW)
            known = model.level(spark, level).filter("kind in (1, 2)").select("key", "kind", "part", "a", "b", "c", "d")
            found = asked.unionByName(_rows(known)).groupBy("key").applyInArrow(_find_grams(level, model.katz.order), _ROW)
        folder = scratch_path(spark, "lm", "answers")
        blocks.answers[model.path, level] = (_stored(found, folder), folder)
    return blocks.answers[model.path, level][0]


def _summed(df: DataFrame) -> list[int]:
    """Sums of the ``stats`` arrays, one short array per bucket."""
    rows = [r[0] for r in df.select("stats").collect()]
    return [sum(x) for x in zip(*rows, strict=True)]


def fit(
    blocks: Blocks, order: int = ORDER, path: str | None = None, tokens_per_bucket: int = TOKENS_PER_BUCKET, split_share: int = SPLIT_SHARE
) -> KatzModel:
    """Learn from the training documents of a corpus. The driver sees per-bucket totals, and the partial
    sums of split contexts: at most 2 x split_share x buckets rows."""
    spark = blocks.table.sparkSession
    path = path or scratch_path(spark, "lm", "model")
    buckets = max(1, -(-blocks.tokens // tokens_per_bucket))
    asked = blocks.table.select("block", "words", "counts").mapInArrow(_word_questions(buckets, True), _ROW)
    words = common.stored(asked.groupBy("key").applyInArrow(_count_words(buckets), _ROW), f"{path}/level=1", "kind")
    blocks.answers[path, 1] = (words.filter(F.col("kind") == ANSWER), f"{path}/level=1/kind={ANSWER}")
    n = _summed(words.filter("kind = 1")) or [0] * (GT_MAX + 3)
    above = max(1, n[0] // (buckets * split_share))
    katz = Katz(order, buckets, above, blocks.train_docs, Unigrams.of(n[0], n[1], n[2:]))
    model = KatzModel(path, katz)
    for level in range(2, order + 1):
        table, folder = _states(blocks, model, level - 1), f"{path}/level={level}"
        held = spark.sparkContext.broadcast(katz)
        asked = table.mapInArrow(_gram_questions(held, level, True), _ROW)
        grams = _stored(asked.groupBy("key").applyInArrow(_count_grams(held, level), _ROW), folder, "kind")
        blocks.answers[path, level] = (grams.filter(F.col("kind") == ANSWER), f"{folder}/kind={ANSWER}")
        d = good_turing(_summed(grams.filter("kind = 1")) or [0] * (GT_MAX + 1))
        weights = grams.filter(F.col("kind") == EVIDENCE).select("key", "b", "d", "e", "h").mapInArrow(_weigh(held, level, d), _ROW)
        common.stored(weights.drop("kind"), f"{folder}/kind=2")
        remove_path(spark, f"{folder}/kind={EVIDENCE}")
        katz.discounts[level] = d
        katz.split[level] = _split_weights(grams.filter("kind = 3").select("a", "e", "f", "g").collect(), d)
    return model


def _split_weights(rows: list, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts in order, their weights and flags, from the partial sums of their parts."""
    if not rows:
        return np.zeros(0, np.uint64), np.zeros(0), np.zeros(0, np.uint8)
    keys = np.concatenate([unpack(r["a"], np.uint64) for r in rows])
    order = np.argsort(keys, kind="stable")
    first, _ = _runs(keys[order])
    add = lambda x: np.add.reduceat(x[order], first, axis=0)
    total = add(np.concatenate([unpack(r["e"], np.int64) for r in rows]))
    few = add(np.concatenate([unpack(r["f"], np.uint32).reshape(-1, GT_MAX) for r in rows]).astype(np.int64))
    seen = add(np.concatenate([unpack(r["g"], np.float64) for r in rows]))
    return keys[order][first], *backoff_weights(total, few, seen, d)


def score(blocks: Blocks, model: KatzModel) -> DataFrame:
    """(id, train, n_tokens, n_known, train_tokens, base_score, score) per document: log10 probabilities of the whole
    text with its end token, by add-one unigrams and by the model."""
    spark, order = blocks.table.sparkSession, model.katz.order
    states = _states(blocks, model, max(1, order - 1))
    held = spark.sparkContext.broadcast(model.katz)

    def evaluate(parts: list[bytes], *told: Told) -> pa.Table:
        m = held.value
        block = Block(parts, m, *told)
        u, c = m.unigrams, block.counts[1]
        base = np.log10((c + 1) / (u.tokens + u.words + 1))
        each = lambda x: np.add.reduceat(x, block.first)
        return pa.table({
            "id": block.docs, "train": pa.array(block.train[block.first]), "n_tokens": pa.array(block.n),
            "n_known": pa.array(each((c > 0).astype(np.int64))), "train_tokens": pa.array(np.full(len(block.n), u.tokens)),
            "base_score": pa.array(each(base)), "score": pa.array(each(np.log10(block.probability(order)))),
        })

    kind = "id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    if order == 1:
        return states.groupBy("key").applyInArrow(lambda _, state: evaluate(state.column("parts")[0].as_py()), kind)
    found = answers(blocks, model, order)

    def last(key: tuple, state: pa.Table, rows: pa.Table) -> pa.Table:
        return evaluate(state.column("parts")[0].as_py(), Told.of(rows, held.value.discounts[order]))

    return states.groupBy("key").cogroup(found.groupBy("key")).applyInArrow(last, kind)


def score_documents(docs: DataFrame, *, order: int = ORDER, held_out: Column, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Score every document by a model of those that are not held out.

    Returns (id_col, held_out, n_tokens, n_known, train_tokens, base_score, score). Defined cases: a null or
    empty text is its end token; null ids are kept; repeated rows are scored each; without training rows every
    token is unknown, with probability one; an empty table gives no rows.
    """
    blocks = encode_blocks(docs, id_col=id_col, text_col=text_col, train=~held_out, single=True)
    model = fit(blocks, order, **options)
    s = score(blocks, model)
    return s.select(F.col("id").alias(id_col), (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op1_katz_scores")
def op1_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_documents(docs, held_out=common.crc_mod("doc_id", 7) == 2)
