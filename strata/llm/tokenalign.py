"""Cross-tokenizer alignment by interval coalescing.

Every text is encoded by two tokenizers, A (byte-level BPE) and B (sentence pieces). Each token is an interval
of the bytes of the text with a blank before it. The intervals of both are lexsorted by start and the
running maximum of their ends is taken: a group ends where a start reaches it. Within the groups overlapping
tokens are expanded to links, an A id and a B id each.

Corpus-wide counts of id pairs go by blocks of documents: a block asks once for each of its pairs, so what
is shuffled follows the distinct pairs of the blocks and not the links. Blocks are written before they are
counted, so the pair numbers in them stay valid when a task runs again.

A block is filled from slices of documents, encoded and aligned one after the other: a worker holds the arrays of
one slice's tokens, and of its block the distinct pairs of each document.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import conf

from . import common
from .registry import query

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
#: Text bytes in a block (or one longer text).
BLOCK_BYTES = 2 << 20
#: Text bytes encoded and aligned at a time (or one longer text): their token arrays are most of a worker's memory.
SLICE_BYTES = 128 << 10
#: Bytes of a batch that a worker gets when blocks are made (or one larger row).
BATCH_BYTES = 4 << 20
#: A pair of ids as one number: A above these bits, B below.
B_BITS = 24


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 stands for itself,
    the other bytes in order are the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class TokenBytes:
    """Bytes of every token by id."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ragged(self.first[ids], self.size[ids])]


def ragged(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices first[i], first[i] + 1, ... (size[i] of them) for all i in a row."""
    end = np.cumsum(size)
    return np.repeat(first - (end - size), size) + np.arange(end[-1] if len(end) else 0)


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    n = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(n.sum())), n


class ByteLevel:
    """A byte-level BPE file of the tokenizers library, special tokens being plain text.

    Where its merges are listed in the order of the ids they make, tiktoken's encoder applies the same
    merges some five times as fast; any other file is run by the tokenizers library itself.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary, merges, pre = spec["model"]["vocab"], spec["model"]["merges"], spec["pre_tokenizer"] or {}
        byte = byte_alphabet()
        by_id = sorted(vocabulary, key=vocabulary.get)
        tokens = [bytes(byte[c] for c in t) for t in by_id]
        made = [vocabulary["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in merges]
        plain = not spec["normalizer"] and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        if plain and made == list(range(256, len(tokens))) and not spec["model"]["ignore_merges"]:
            import tiktoken

            ranks = {t: i for i, t in enumerate(tokens)}
            fast = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self._encode = lambda texts: [fast.encode_ordinary(t) for t in texts]
        else:
            from tokenizers import Tokenizer

            slow = Tokenizer.from_file(path)
            slow.encode_special_tokens = True
            self._encode = lambda texts: [e.ids for e in slow.encode_batch_fast(texts, add_special_tokens=False)]
        self.bytes = TokenBytes(tokens)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts with a blank before each, in a row, and the number of each."""
        return _flat(self._encode([" " + t for t in texts]))


class Pieces:
    """A sentence piece model; it puts the blank before a text by itself."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        escaped = [re.fullmatch(r"<0x([0-9A-F]{2})>", p) for p in pieces]
        self.bytes = TokenBytes([bytes([int(e[1], 16)]) if e else p.replace("▁", " ").encode() for p, e in zip(pieces, escaped, strict=True)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return _flat(self.model.encode(texts, num_threads=1))


@dataclass
class Aligned:
    """Alignment of some documents. Token arrays run over all of them: A first, then B; tokens of a document
    whose bytes cannot be told from both encodings are left out."""

    n_a: np.ndarray  # per document
    n_b: np.ndarray
    ids: np.ndarray  # per token, in group order: by group, then A before B, then start
    kind: np.ndarray  # 0 for A, 1 for B
    doc: np.ndarray
    group: np.ndarray
    n_groups: np.ndarray  # per document
    link_doc: np.ndarray  # per link
    link_a: np.ndarray
    link_b: np.ndarray


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        size = max(len(self.a.bytes.size), len(self.b.bytes.size))
        self.digits = np.zeros((size, len(str(size)) + 1), np.uint8)
        text = [str(i).encode() for i in range(size)]
        self.n_digits = np.array([len(t) for t in text], np.int64)
        for i, t in enumerate(text):
            self.digits[i, : len(t)] = np.frombuffer(t, np.uint8)

    def align(self, texts: list[str]) -> Aligned:
        raw = [(" " + t).encode() for t in texts]
        used = np.array([len(t) > 0 for t in texts], bool)
        side = []
        for enc in (self.a, self.b):
            ids, n = enc.encode(texts)
            used &= _says(enc.bytes, ids, n, raw)
            side.append((ids, n, enc.bytes.size))
        base = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        docs = np.arange(len(texts))
        parts = []
        for ids, n, size in side:
            doc = np.repeat(docs, n)
            keep = used[doc]
            ids, doc = ids[keep], doc[keep]
            length = size[ids]
            first = np.cumsum(length) - length  # over the kept documents only: shift each to its place
            kept = np.where(used, n, 0)
            at = np.cumsum(kept) - kept
            offset = np.zeros(len(texts), np.int64)
            offset[kept > 0] = base[:-1][kept > 0] - first[at[kept > 0]]
            start = first + offset[doc]
            parts.append((ids, doc, start, start + length, kept))
        (ia, da, sa, ea, na), (ib, db, sb, eb, nb) = parts

        start, end = np.concatenate([sa, sb]), np.concatenate([ea, eb])
        kind = np.repeat(np.array([0, 1], np.int8), [len(sa), len(sb)])
        order = np.lexsort((kind, start))
        reach = np.maximum.accumulate(end[order]) if len(order) else end
        new = np.ones(len(order), bool)
        new[1:] = start[order][1:] >= reach[:-1]
        number = np.cumsum(new) - 1
        group = np.empty(len(order), np.int64)
        group[order] = number
        listed = np.lexsort((start, kind, group))
        doc = np.concatenate([da, db])
        first_of = doc[order][new]  # document of each group

        low = np.searchsorted(eb, sa, side="right")  # first B token that ends behind the A token's start
        count = np.searchsorted(sb, ea, side="left") - low
        who = np.repeat(np.arange(len(ia)), count)
        return Aligned(
            na, nb, np.concatenate([ia, ib])[listed], kind[listed], doc[listed], group[listed],
            np.bincount(first_of, minlength=len(texts)), da[who], ia[who], ib[ragged(low, count)],
        )

    def digests(self, x: Aligned, n_docs: int) -> list[str]:
        """SHA-256 of each document's groups as ``a1,a2|b1;a3|b2``; empty for one without tokens."""
        n = len(x.ids)
        chars, size = self.digits[x.ids], self.n_digits[x.ids].copy()
        mark = np.full(n, ord(","), np.uint8)
        mark[:-1][x.kind[:-1] != x.kind[1:]] = ord("|")
        mark[:-1][x.group[:-1] != x.group[1:]] = ord(";")
        chars[np.arange(n), size] = mark
        last = np.ones(n, bool)
        last[:-1] = x.doc[:-1] != x.doc[1:]
        size += ~last
        out = chars[np.arange(chars.shape[1]) < size[:, None]]
        ends = np.cumsum(np.bincount(x.doc, weights=size, minlength=n_docs).astype(np.int64))
        text = out.tobytes()
        return [hashlib.sha256(text[a:b]).hexdigest() if b > a else "" for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


def _says(tokens: TokenBytes, ids: np.ndarray, n: np.ndarray, raw: list[bytes]) -> np.ndarray:
    """Whether the joined bytes of each document's tokens are its own."""
    joined, ends = tokens.joined(ids).tobytes(), np.concatenate([[0], np.cumsum(tokens.size[ids])])
    at = ends[np.concatenate([[0], np.cumsum(n)])].tolist()
    return np.array([joined[a:b] == r for a, b, r in zip(at[:-1], at[1:], raw, strict=True)], bool)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligner(path_a: str, path_b: str) -> Aligner:
    """One per worker process."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def _slices(batches: Iterator[pa.RecordBatch], slice_bytes: int) -> Iterator[tuple[list[int | None], list[str], int]]:
    """(ids, texts, bytes of the texts) of a slice of documents at a time; a null text is empty."""
    for b in batches:
        size = pc.fill_null(pc.binary_length(b.column("text")), 0).to_numpy(zero_copy_only=False)
        off = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        lo = 0
        while lo < b.num_rows:
            hi = min(b.num_rows, max(lo + 1, int(np.searchsorted(off, off[lo] + slice_bytes, side="right")) - 1))
            ids, texts = (b.column(c).slice(lo, hi - lo).to_pylist() for c in ("id", "text"))
            yield ids, [t or "" for t in texts], int(off[hi] - off[lo])
            lo = hi


def _lists(values: np.ndarray, n: np.ndarray, kind: pa.DataType) -> pa.Array:
    off = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
    return pa.ListArray.from_arrays(off, pa.array(values, kind))


def _paths(path_a: str | None, path_b: str | None) -> tuple[str, str]:
    return path_a or public_tokenizers.path(TOKENIZER_A), path_b or public_tokenizers.path(TOKENIZER_B)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def align_documents(
    docs: DataFrame, path_a: str | None = None, path_b: str | None = None, *, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(doc_id, groups) of every row: ``groups`` is an array of (a, b), the ids of tokenizer A and B that cover the same
    bytes, in text order. The paths default to the public tokenizers.

    Defined cases: null and empty texts, and texts whose bytes one of the encodings does not give back
    (such as those that hold U+2581), have no groups; equal rows give equal rows; an empty table gives no
    rows; other columns are not read. One text is encoded at a time in whole, so memory follows the longest.
    """
    paths = _paths(path_a, path_b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = _aligner(*paths)
        for ids, texts, _ in _slices(batches, min(block_bytes, SLICE_BYTES)):
            x = tool.align(texts)
            n = int(x.n_groups.sum())
            sides = [_lists(x.ids[x.kind == k], np.bincount(x.group[x.kind == k], minlength=n), pa.int32()) for k in (0, 1)]
            groups = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(x.n_groups)]), pa.int32()), pa.StructArray.from_arrays(sides, names=["a", "b"]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), groups], names=["doc_id", "groups"])
            del x, sides, groups
        common.release_memory()

    return _texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, groups array<struct<a:array<int>,b:array<int>>>")


_BLOCK = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, digest string, at array<int>, times array<int>, "
    "pair array<long>, docs array<long>"
)


class _Block:
    """Rows of ``_BLOCK``, gathered slice by slice: a row per document, so that neither Spark's readers nor a shuffle hold a block
    as one value. The first row has the block's pairs."""

    def __init__(self):
        self.bytes, self.parts = 0, []

    def add(self, ids: list[int | None], x: Aligned, digests: list[str], size: int) -> None:
        n = len(ids)
        pair, at = np.unique(x.link_a << B_BITS | x.link_b, return_inverse=True)
        once, times = np.unique(x.link_doc * max(len(pair), 1) + at, return_counts=True)
        doc, at = np.divmod(once, max(len(pair), 1))
        own = [x.n_a, x.n_b, x.n_groups, np.bincount(x.link_doc, minlength=n)]
        self.parts.append((ids, own, digests, pair, np.bincount(doc, minlength=n), at.astype(np.int32), times.astype(np.int32)))
        self.bytes += size

    def rows(self, number: int) -> pa.RecordBatch:
        ids, own, digests, pairs, held, ats, times = zip(*self.parts, strict=True)
        ids, digests, held = [*chain.from_iterable(ids)], [*chain.from_iterable(digests)], np.concatenate(held)
        pair, place = np.unique(np.concatenate(pairs), return_inverse=True)
        first = np.cumsum([0, *map(len, pairs)])
        at = np.concatenate([place[f + a] for f, a in zip(first, ats, strict=False)])
        of_pair = np.zeros(len(ids), np.int64)
        of_pair[0] = len(pair)
        arrays = [pa.array(np.full(len(ids), number)), pa.array(ids, pa.int64()), *[pa.array(np.concatenate(c), pa.int64()) for c in zip(*own, strict=True)]]
        arrays += [pa.array(digests, pa.string()), _lists(at, held, pa.int32()), _lists(np.concatenate(times), held, pa.int32())]
        arrays += [_lists(pair, of_pair, pa.int64()), _lists(np.bincount(at, minlength=len(pair)), of_pair, pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in _BLOCK.split(", ")])


@dataclass(frozen=True)
class LinkTables:
    """``blocks``: a row per document, with its own figures and its distinct pairs: their place ``at`` in the block's ``pair``
    and how many ``times`` each is linked; ``pair`` and the pairs' ``docs`` stand in a block's first row. ``counts``: (pair, a_id, b_id, docs, best) over all documents; ``best`` is the
    highest count of the A id."""

    blocks: DataFrame
    counts: DataFrame


def link_tables(
    docs: DataFrame, path_a: str | None = None, path_b: str | None = None, *, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> LinkTables:
    """Align all documents and count in how many each pair of ids is linked. Defined cases as in ``align_documents``."""
    paths = _paths(path_a, path_b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, number, block = _aligner(*paths), TaskContext.get().partitionId() << 32, _Block()
        for ids, texts, size in _slices(batches, min(block_bytes, SLICE_BYTES)):
            if block.parts and block.bytes + size > block_bytes:
                yield block.rows(number)
                number, block = number + 1, _Block()
            x = tool.align(texts)
            block.add(ids, x, tool.digests(x, len(ids)), size)
            del x
        if block.parts:
            yield block.rows(number)
        del block
        common.release_memory()

    with conf(docs.sparkSession, **{"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}):
        blocks = common.stored(_texts(docs, id_col, text_col).mapInArrow(run, _BLOCK))
    seen = blocks.select(F.explode(F.arrays_zip("pair", "docs")).alias("x")).groupBy(F.col("x.pair").alias("pair")).agg(F.sum("x.docs").alias("docs"))
    seen = common.stored(seen.withColumn("a_id", F.shiftright("pair", B_BITS)).withColumn("b_id", F.col("pair").bitwiseAND(F.lit((1 << B_BITS) - 1))))
    best = seen.groupBy("a_id").agg(F.max("docs").alias("best"))
    return LinkTables(blocks, common.cut(seen.join(best, "a_id").select("pair", "a_id", "b_id", "docs", "best")))


def link_scores(tables: LinkTables) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per document."""
    asked = tables.blocks.select("block", F.posexplode("pair").alias("place", "pair"))
    answers = asked.join(tables.counts, "pair").select(F.col("block").alias("of"), "place", F.col("docs").alias("n"), (F.col("docs") == F.col("best")).alias("is_best"))
    out = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

    def finish(block: pa.Table, answer: pa.Table) -> pa.Table:
        place = answer.column("place").to_numpy()
        n, is_best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        n[place], is_best[place] = answer.column("n").to_numpy(), answer.column("is_best").to_numpy()
        held = pc.list_value_length(block.column("at")).to_numpy()
        at, times = (pc.list_flatten(block.column(c)).to_numpy() for c in ("at", "times"))
        ends = np.concatenate([[0], np.cumsum(held)])
        total = [np.diff(np.concatenate([[0], np.cumsum(times * x[at])])[ends]) for x in (is_best, n)]
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
        return pa.table([*block.select(names).columns, *map(pa.array, total), block.column("digest")], names=[*names, "n_best", "count_sum", "groups_sha256"])

    return tables.blocks.drop("pair", "docs").groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(finish, out)


@query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_scores(link_tables(common.table(spark, sf_dir, "documents")))
