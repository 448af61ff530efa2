"""Spelling variant grouping by a bit-sliced position index.

For every (position, letter) the index holds a bitset of the words with that letter there. A word is matched
against all indexed words at once by word-parallel recurrences over its letters: one set of the words that
agree so far, and three sets of those with one error so far, a replaced, a missing or an additional
letter, the last two compared at positions shifted by one. Bits are ordered by falling count of the words, so
the first bit of a result is the word's best variant and the number of bits its number of near words.

Two words with one edit between them agree in their first or their last half. So words meet in groups of equal
length class and half, many groups share an index (a word only starts from the bits of its own
group), and a group too large for one index is cut into blocks, every two of which meet once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .registry import query

#: Runs of ASCII and Latin-1 letters (with the two signs between them).
LETTERS = r"[A-Za-zÀ-ÿ]+"
MIN_LENGTH = 5
MIN_COUNT = 3
#: How much more frequent a form is than its variant.
RATIO = 2
#: Words in an index, as aimed at and at most; queries matched at once.
INDEX_WORDS = 4096
INDEX_LIMIT = 4 * INDEX_WORDS
QUERY_WORDS = 1024
_ALPHABET = 1 << 21  # code points


def corpus_words(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the letter runs of all texts, lower-cased in ASCII, of ``MIN_LENGTH`` or more code points and
    ``MIN_COUNT`` or more occurrences.

    Where 97 divides h, the unsigned crc32 of ``<id>:<run>``, the code point of the run at h % length is left out first:
    misspellings planted at a fixed rate. A null id counts as the empty text.
    """
    runs = F.regexp_extract_all(F.col(f"`{text_col}`").cast("string"), F.lit(LETTERS), F.lit(0))
    each = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.explode(runs).alias("run"))
    each = each.filter(F.length("run") >= MIN_LENGTH).withColumn("run", common.ascii_lower(F.col("run")))
    each = each.withColumn("h", F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = each.select(F.when(F.col("h") % 97 == 0, cut).otherwise(F.col("run")).alias("word"))
    counted = words.filter(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= MIN_COUNT)


class PositionIndex:
    """Bitsets per (position, letter), per group and per length over some words, in the order given."""

    def __init__(self, words: list[str], group: np.ndarray):
        self.width = -(-len(words) // 64)
        letters, word, place = _letters(words)
        length = np.array([len(w) for w in words], np.int64)
        self.keys, self.slices = self._bits(place * _ALPHABET + letters, word)
        self.groups, self.members = self._bits(group, np.arange(len(words)))
        self.lengths, self.of_length = self._bits(length, np.arange(len(words)))

    def _bits(self, key: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sorted distinct keys, a bitset for each and an empty one behind them)."""
        keys, row = np.unique(key, return_inverse=True)
        bits = np.zeros((len(keys) + 1, self.width), np.uint64)
        np.bitwise_or.at(bits, (row, word >> 6), np.uint64(1) << (word & 63).astype(np.uint64))
        return keys, bits

    @staticmethod
    def _rows(keys: np.ndarray, bits: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        at = np.searchsorted(keys, wanted)
        at[at == len(keys)] = 0
        return bits[np.where(keys[at] == wanted, at, len(keys))] if len(keys) else bits[np.zeros(len(wanted), np.int64)]

    def near(self, words: list[str], group: np.ndarray, size: np.ndarray, twice: np.ndarray) -> np.ndarray:
        """One bitset per word: the indexed words of its group with exactly one edit between them, the shorter of
        both (or each) having ``size`` letters. For words with ``twice`` >= 0, words that agree in that many first
        letters are left out."""
        length = np.array([len(w) for w in words], np.int64)
        letters, word, place = _letters(words)
        text = np.full((len(words), int(length.max()) if len(words) else 0), -1, np.int64)
        text[word, place] = letters
        zero = self._rows(self.groups, self.members, group)
        replaced, missing, added = (np.zeros_like(zero) for _ in range(3))
        skip = np.zeros_like(zero)
        for i in range(text.shape[1]):
            live = np.flatnonzero(length > i)
            here, behind, ahead = (self._rows(self.keys, self.slices, (i + d) * _ALPHABET + text[live, i]) for d in (0, -1, 1))
            skip[twice == i] = zero[twice == i]
            z = zero[live]
            replaced[live] = (replaced[live] & here) | (z & ~here)
            missing[live] = (missing[live] & behind) | z
            added[live] = (added[live] | z) & ahead
            zero[live] = z & here
        replaced[length != size] = 0  # two of the longer words meet in the group of their own length
        alike, shorter, longer = (self._rows(self.lengths, self.of_length, length + d) for d in (0, -1, 1))
        return ((replaced & alike) | (missing & shorter) | ((added | zero) & longer)) & ~skip


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code point, word, place) of every letter of the words."""
    n = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    return letters, np.repeat(np.arange(len(words)), n), np.arange(len(letters)) - np.repeat(np.cumsum(n) - n, n)


def first_bit(bits: np.ndarray) -> np.ndarray:
    """Number of the lowest bit of each row that has one."""
    at = (bits != 0).argmax(axis=1)
    low = bits[np.arange(len(bits)), at]
    return at * 64 + np.bitwise_count((low & (~low + np.uint64(1))) - np.uint64(1)).astype(np.int64)


def _meet(table: pa.Table) -> pa.Table:
    """Best variant and number of near words of the members of one index: one block of words with itself, or two
    blocks of one large group with each other."""
    column = lambda c: table.column(c).combine_chunks().to_numpy(zero_copy_only=False)
    words, n, size, last, block = (column(c) for c in ("word", "n", "size", "last", "block"))
    first, second = column("first")[0], column("second")[0]
    order = np.array(sorted(range(len(words)), key=lambda i: (-n[i], words[i])), np.int64)
    words, n, size, last, block = (x[order] for x in (words, n, size, last, block))
    half = size // 2
    text = [f"{k}{'<' if e else '>'}{w[len(w) - (k - h) :] if e else w[:h]}" for w, k, h, e in zip(words, size.tolist(), half.tolist(), last.tolist(), strict=True)]
    group = np.unique(np.array(text, object), return_inverse=True)[1]
    out = [[], [], [], []]
    for asks, told in [(first, second)] if first == second else [(first, second), (second, first)]:
        inside, asked = np.flatnonzero(block == told), np.flatnonzero(block == asks)
        index = PositionIndex(words[inside].tolist(), group[inside])
        asked = asked[np.argsort(size[asked], kind="stable")]
        for lo in range(0, len(asked), QUERY_WORDS):
            q = asked[lo : lo + QUERY_WORDS]
            bits = index.near(words[q].tolist(), group[q], size[q], np.where(last[q], half[q], -1))
            hit = bits.any(axis=1)
            best = inside[first_bit(bits[hit])]
            for x, y in zip(out, (words[q][hit], np.bitwise_count(bits[hit]).sum(axis=1, dtype=np.int64), n[best], words[best]), strict=True):
                x.extend(y.tolist())
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.table([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=["word", "n_near", "best_n", "best"])


def near_words(words: DataFrame, *, index_words: int = INDEX_WORDS, index_limit: int = INDEX_LIMIT) -> DataFrame:
    """(word, n_near, best_n, best) for every word of (word, n) that has a near word: how many there are, and the most
    frequent (of equally frequent ones the first in code point order)."""
    total = words.count()
    buckets = max(1, -(-4 * total // index_words))
    classes = F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("size")
    sides = words.filter(F.length("word") > 1).select("word", "n", classes).withColumn("last", F.explode(F.array(F.lit(False), F.lit(True))))
    # Of a pair the shorter length is the class; its halves are the first size // 2 letters and the others from the end.
    tail = (F.col("size") - F.floor(F.col("size") / 2)).cast("int")
    half = F.when(F.col("last"), F.right("word", tail)).otherwise(F.left("word", F.floor(F.col("size") / 2).cast("int")))
    sides = sides.withColumn("bucket", F.pmod(F.xxhash64("size", "last", half), F.lit(buckets)))
    held = sides.groupBy("bucket").agg(F.count(F.lit(1)).alias("held")).select(F.col("bucket").alias("of"), F.ceil(F.col("held") / index_limit).alias("blocks"))
    dealt = sides.join(held, F.col("bucket") == F.col("of")).withColumn("block", F.pmod(F.xxhash64("word", F.lit(1)), F.col("blocks")))
    others = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    dealt = dealt.withColumn("other", F.explode(others))
    dealt = dealt.withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")})
    met = dealt.select("word", "n", "size", "last", "block", "bucket", "first", "second").groupBy("bucket", "first", "second")
    found = met.applyInArrow(_meet, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w"))).alias("b")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.w").alias("best"))


def follow(links: DataFrame) -> DataFrame:
    """(word, root) for links (word, form): pointer doubling, so a chain of k forms takes log2(k) joins. Counts
    at least double along a chain, so there are no cycles and a chain is short."""
    at = common.cut(links.select("word", F.col("form").alias("root")))
    while True:
        up = at.select(F.col("word").alias("from"), F.col("root").alias("to"))
        after = common.cut(at.join(up, F.col("root") == F.col("from"), "left").select("word", F.coalesce("to", "root").alias("root"), F.col("to").isNotNull().alias("moved")))
        at = after.select("word", "root")
        if after.filter("moved").isEmpty():
            return at


def group_variants(words: DataFrame, *, ratio: int = RATIO, index_words: int = INDEX_WORDS, index_limit: int = INDEX_LIMIT) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per row of words (word, n), both not null and words distinct.

    Two words are near if one inserted, deleted or replaced code point tells them apart. ``form``: the near word with the largest n
    (ties: the first in code point order) if that is ``ratio`` (2 or more) times the word's own or more; ``root``: the last word reached by
    following forms, the word itself without one. An empty table gives no rows; words of one letter
    or none have no near words; other columns are not read.
    """
    words = common.cut(words.select("word", F.col("n").cast("long").alias("n")))
    near = near_words(words, index_words=index_words, index_limit=index_limit)
    joined = words.join(near, "word", "left")
    own = F.col("best_n") >= F.lit(ratio) * F.col("n")
    listed = common.cut(joined.select("word", F.when(own, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(own, F.col("best_n")).alias("form_n")))
    roots = follow(listed.filter("form is not null")).select(F.col("word").alias("of"), "root")
    return listed.join(roots, F.col("word") == F.col("of"), "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


@query("op13_spelling_variants")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(corpus_words(common.table(spark, sf_dir, "documents")))
