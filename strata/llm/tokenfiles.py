"""Token ids in Arrow files of equal-length sequences.

Documents are range-partitioned by id and encoded in order. Each task writes one Arrow IPC
file whose record batches hold ``BATCH_ROWS`` rows of two fixed-size lists of ``seq_len``: ``ids``
and ``mask`` (false on the padding of the last sequence). As all batches but the last have the
same number of rows, sequence i is row ``i % BATCH_ROWS`` of batch ``i // BATCH_ROWS``: readers map the file
and view any sequence without copying. A second small file lists (doc_id, first, n).

Files are written beside their final name and moved, and their content depends on the rows
only, so a task that runs again leaves the same file.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

from . import common
from .registry import query
from .text import text_buffer

SEQ_LEN = 2048
BATCH_ROWS = 64
END_ID = 2
TOKENIZER = "word_bpe_49k.json"
#: Encoded words a worker keeps while a task runs; beyond it only those met more than once stay.
CACHE_BYTES = 64 << 20
#: Of these, what it keeps between tasks, when other operators use the worker as well.
RESTING_BYTES = 8 << 20
_CALL_WORDS = 500
_TAIL = r"([A-Za-z0-9])([.,;:!?]+)([\x09-\x0D ]|$)"
_CASE_MATTERS = (b"\xcc", b"\xcd", b"<|")
#: Lower-case letters of ASCII and Latin-1, in UTF-8.
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\xa0-\xb6\xb8-\xbf])+").fullmatch
_SLICE = 4 << 20


class WordEncoder:
    """Encodes texts by their blank-separated words, remembering each word's ids.

    Exact for tokenizers that lower-case, drop white space and never match across it (the word BPE
    here): the ids of a text are then those of its words in order. ASCII capitals are lower-cased
    before the look-up, except in texts where that could matter (combining marks, which compose with some
    letters in one case only, and special tokens). ``by_word=False`` encodes whole texts instead, for any
    other tokenizer.
    """

    def __init__(self, path: str, by_word: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer, self.by_word = Tokenizer.from_file(path), by_word
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.closes = np.zeros(self.vocabulary, dtype=bool)
        self.closes[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.index: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.first, self.size, self.hits = (np.zeros(1 << 14, np.int64) for _ in range(3))
        self.used = self.weight = 0

    def _ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, by the tokenizer itself: a few hundred to a call, told apart by their offsets."""
        parts, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for lo in range(0, len(words), _CALL_WORDS):
            texts = [w.decode() for w in words[lo : lo + _CALL_WORDS]]
            got = self.tokenizer.encode("\n".join(texts), add_special_tokens=False)
            ends = np.cumsum([len(t) + 1 for t in texts])
            at = np.searchsorted(ends, np.fromiter((o[0] for o in got.offsets), np.int64, len(got.ids)), side="right")
            parts.append(np.array(got.ids, np.uint32))
            sizes.append(np.bincount(at, minlength=len(texts)))
        return np.concatenate(parts), np.concatenate(sizes)

    def _letter_ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters only, which the vocabulary closes with a word-end token each."""
        texts = ["\n".join(w.decode() for w in words[lo : lo + _CALL_WORDS]) for lo in range(0, len(words), _CALL_WORDS)]
        got = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(got), np.uint32)
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):  # not such a vocabulary
            return self._ids(words)
        return ids, np.diff(ends, prepend=0)

    def _add(self, words: list[bytes], ids: np.ndarray, size: np.ndarray) -> None:
        n, total = len(self.index), len(ids)
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + len(words) > len(self.first):
            self.first, self.size, self.hits = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.size, self.hits))
        self.ids[self.used : self.used + total] = ids
        self.first[n : n + len(words)] = self.used + np.cumsum(size) - size
        self.size[n : n + len(words)] = size
        self.used += total
        self.index.update(zip(words, range(n, n + len(words)), strict=True))
        self.weight += sum(map(len, words)) + 160 * len(words) + 4 * total

    def _learn(self, new: set[bytes]) -> None:
        letters = [w for w in new if _LETTERS(w)]
        if letters:
            self._add(letters, *self._letter_ids(letters))
        if rest := list(new.difference(letters)):
            self._add(rest, *self._ids(rest))

    def _shrink(self) -> None:
        """Keep the words met more than once since the last time; all, if that is none."""
        hits = self.hits[: len(self.index)]
        keep = np.flatnonzero(hits > 1)
        if len(keep) > len(hits) // 2:  # even these are many: only the more frequent half
            keep = np.flatnonzero(hits > np.median(hits))
        self._keep(keep)

    def _keep(self, keep: np.ndarray) -> None:
        words = list(self.index)
        ids, size = self._gather(keep)
        old = [words[i] for i in keep.tolist()]
        self.index = dict(zip(old, range(len(old)), strict=True))
        self.ids, self.used = np.append(ids, np.zeros(1 << 16, np.uint32)), len(ids)
        room = np.zeros(1 << 14, np.int64)
        self.first, self.size, self.hits = np.append(np.cumsum(size) - size, room), np.append(size, room), np.zeros(len(old) + len(room), np.int64)
        self.weight = sum(map(len, old)) + 160 * len(old) + 4 * len(ids)

    def rest(self) -> None:
        """Keep no more than ``RESTING_BYTES`` of words, the most frequent ones."""
        if self.weight <= RESTING_BYTES:
            return
        n = len(self.index)
        weights = np.fromiter(map(len, self.index), np.int64, n) + 160 + 4 * self.size[:n]
        order = np.argsort(-self.hits[:n], kind="stable")
        self._keep(np.sort(order[: np.searchsorted(np.cumsum(weights[order]), RESTING_BYTES, side="right")]))

    def _gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of words in a row, size of each) by their numbers."""
        size = self.size[at]
        end = np.cumsum(size)
        total = int(end[-1]) if len(end) else 0
        kind = np.int32 if max(total, self.used) < 1 << 31 else np.int64
        place = np.repeat((self.first[at] - (end - size)).astype(kind), size)
        place += np.arange(total, dtype=kind)
        return self.ids[place], size

    def encode(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each); the texts are not null."""
        if not self.by_word:
            got = [e.ids for e in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            n = np.fromiter(map(len, got), np.int64, len(got))
            return np.fromiter(chain.from_iterable(got), np.uint32, int(n.sum())), n
        if self.weight > CACHE_BYTES:
            self._shrink()
        # The tokenizer never matches from an ASCII letter or digit on into the punctuation behind it, so
        # that is a word of its own: fewer distinct words.
        apart = pc.replace_substring_regex(_lowered(texts), _TAIL, r"\1 \2\3")
        lists = pc.ascii_split_whitespace(apart)  # 0x20 and 0x09-0x0D; may yield empty words
        found = lists.flatten().dictionary_encode()
        words = found.dictionary.cast(pa.large_binary()).to_pylist()
        if new := set(words).difference(self.index):
            self._learn(new)
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))[found.indices.to_numpy()]
        self.hits[: len(self.index)] += np.bincount(at, minlength=len(self.index))
        ids, size = self._gather(at)
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py() if len(lists) else np.zeros(1, np.int64)
        return ids, np.diff(np.concatenate([[0], np.cumsum(size)])[bounds])


def _lowered(texts: pa.LargeStringArray) -> pa.LargeStringArray:
    """ASCII capitals lower-cased, but for texts with combining marks (U+0300-U+036F) or special tokens."""
    lower = pc.ascii_lower(texts)
    data, off = text_buffer(texts)
    raw = data[off[0] : off[-1]].tobytes()
    if not any(x in raw for x in _CASE_MATTERS):
        return lower
    keep = [any(x in t for x in _CASE_MATTERS) for t in texts.cast(pa.large_binary()).to_pylist()]
    return pc.if_else(pa.array(keep), texts, lower)


_ENCODERS: dict[tuple[str, bool], WordEncoder] = {}


def _encoder(path: str, by_word: bool) -> WordEncoder:
    """One per worker process, so that its word cache lasts over tasks."""
    if (path, by_word) not in _ENCODERS:
        _ENCODERS[path, by_word] = WordEncoder(path, by_word)
    return _ENCODERS[path, by_word]


def sequence_schema(seq_len: int, kind: pa.DataType) -> pa.Schema:
    plain = lambda t: pa.list_(pa.field("item", t, nullable=False), seq_len)
    return pa.schema([pa.field("ids", plain(kind), nullable=False), pa.field("mask", plain(pa.bool_()), nullable=False)])


class SequenceWriter:
    """Packs a run of ids into sequences, one open batch at a time."""

    def __init__(self, sink, seq_len: int, kind: np.dtype):
        self.kind, self.rows = np.dtype(kind), BATCH_ROWS
        self.seq_len, self.schema = seq_len, sequence_schema(seq_len, pa.from_numpy_dtype(kind))
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.room, self.filled, self.total = np.zeros(self.rows * seq_len, self.kind), 0, 0

    def add(self, ids: np.ndarray) -> None:
        self.total += len(ids)
        while len(ids):
            n = min(len(ids), len(self.room) - self.filled)
            self.room[self.filled : self.filled + n] = ids[:n]
            self.filled, ids = self.filled + n, ids[n:]
            if self.filled == len(self.room):
                self._flush()

    def _flush(self) -> None:
        n = -(-self.filled // self.seq_len) * self.seq_len
        mask = np.arange(n) < self.filled
        self.room[self.filled :] = 0
        lists = [pa.FixedSizeListArray.from_arrays(a, type=f.type) for a, f in zip((pa.array(self.room[:n]), pa.array(mask)), self.schema, strict=True)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.filled = 0

    def close(self) -> None:
        if self.filled:
            self._flush()
        self.writer.close()


class SequenceFile:
    """Random access to the sequences of one file; arrays are views of the mapped file."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        local = isinstance(fs, pafs.LocalFileSystem)
        self.source = pa.memory_map(path) if local else fs.open_input_file(path)
        self.file = pa.ipc.open_file(self.source)
        self.seq_len = self.file.schema.field("ids").type.list_size
        self.rows = self.file.get_batch(0).num_rows if self.file.num_record_batches else 0
        self.at, self.batch = -1, None

    def __len__(self) -> int:
        n = self.file.num_record_batches
        return 0 if not n else (n - 1) * self.rows + self.file.get_batch(n - 1).num_rows

    def _open(self, k: int) -> pa.RecordBatch:
        if k != self.at:
            self.at, self.batch = k, self.file.get_batch(k)
        return self.batch

    def sequence(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids (a NumPy view) and mask of sequence i."""
        b, r = self._open(i // self.rows), i % self.rows
        part = slice(r * self.seq_len, (r + 1) * self.seq_len)
        return b.column(0).values.to_numpy(zero_copy_only=True)[part], b.column(1).values[part.start : part.stop]

    def ids(self, start: int, n: int) -> np.ndarray:
        """Ids start to start + n of the file's run; a view when they lie in one batch."""
        per, out = self.rows * self.seq_len, []
        while n:
            k, a = divmod(start, per)
            flat = self._open(k).column(0).values.to_numpy(zero_copy_only=True)[a : a + n]
            out.append(flat)
            start, n = start + len(flat), n - len(flat)
        return out[0] if len(out) == 1 else np.concatenate([*out, np.zeros(0, np.uint32)])


@dataclass(frozen=True)
class TokenFiles:
    """Folder of the files and a frame (part, n_docs, n_tokens), one row per file."""

    path: str
    parts: DataFrame


def write_token_files(
    docs: DataFrame, tokenizer: str, path: str | None = None, *, id_col: str = "doc_id", text_col: str = "text", seq_len: int = SEQ_LEN, end_id: int = END_ID, by_word: bool = True
) -> TokenFiles:
    """Encode every text (null: empty) with the end id behind it, and write the files.

    Ids ascend over the parts in order (null ids first; rows with the same id ascend by a hash
    of the text; a repeated row is written as often as it stands). ``path`` must be a
    folder that all executors share and defaults to one under the scratch root. An
    empty table writes no file. Ids are kept in 16 bits when the vocabulary allows.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(F.spark_partition_id().cast("long").alias("part"), "doc_id", "text")

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, fs, base = _encoder(tokenizer, by_word), *pafs.FileSystem.from_uri(path)
        kind = np.uint16 if max(enc.vocabulary, end_id + 1) <= 1 << 16 else np.uint32
        writer, ids_of, sizes = None, [], []
        for b in batches:
            if not b.num_rows:
                continue
            if writer is None:
                part = b.column("part")[0].as_py()
                fs.create_dir(base, recursive=True)
                name, temp = f"{base}/part-{part:06d}", f"{base}/_{part:06d}.{os.getpid()}.{os.urandom(4).hex()}"
                sink = fs.open_output_stream(f"{temp}.arrow")
                writer = SequenceWriter(sink, seq_len, kind)
            texts = b.column("text").cast(pa.large_string()).fill_null("")
            _, off = text_buffer(texts)
            ids_of.append(b.column("doc_id"))
            lo, n = 0, b.num_rows
            while lo < n:
                hi = min(n, max(lo + 1, int(np.searchsorted(off, off[lo] + _SLICE, side="right")) - 1))
                ids, size = enc.encode(texts.slice(lo, hi - lo))
                ends = np.cumsum(size)
                writer.add(np.insert(ids, ends, end_id).astype(kind))
                sizes.append(size + 1)
                lo = hi
        if writer is None:
            return
        writer.close()
        sink.close()
        size = np.concatenate(sizes)
        index = pa.table({"doc_id": pa.chunked_array(ids_of), "first": np.cumsum(size) - size, "n": size})
        with fs.open_output_stream(f"{temp}.docs") as out, pa.ipc.new_file(out, index.schema) as w:
            w.write_table(index, max_chunksize=1 << 16)
        for end in ("docs", "arrow"):
            fs.move(f"{temp}.{end}", f"{name}.{end}")
        total = int(size.sum())
        yield pa.RecordBatch.from_pydict({"part": [part], "n_docs": [len(size)], "n_tokens": [total]})
        del b, texts, off, ids, ends, ids_of, sizes, size, index, writer, sink
        enc.rest()
        common.release_memory()

    parts = common.cut(dealt.mapInArrow(store, "part long, n_docs long, n_tokens long"))
    return TokenFiles(path, parts)


def read_token_files(files: TokenFiles) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files: its first id's place among
    all ids, the number of its ids and their crc32 as little-endian unsigned 32-bit numbers."""
    spark, path = files.parts.sparkSession, files.path
    start, rows = 0, []
    for r in files.parts.orderBy("part").collect():  # one row per file
        rows.append((r["part"], start))
        start += r["n_tokens"]
    listed = spark.createDataFrame(rows, "part long, base long").repartition(max(1, len(rows)), "part")

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = pafs.FileSystem.from_uri(path)
        for b in batches:
            for part, base in zip(b.column("part").to_pylist(), b.column("base").to_pylist(), strict=True):
                seqs = SequenceFile(fs, f"{folder}/part-{part:06d}.arrow")
                with fs.open_input_file(f"{folder}/part-{part:06d}.docs") as src:
                    index = pa.ipc.open_file(src)
                    for k in range(index.num_record_batches):
                        d = index.get_batch(k)
                        first, n = d.column("first").to_numpy(), d.column("n").to_numpy()
                        crc = [zlib.crc32(seqs.ids(f, c).astype("<u4").tobytes()) for f, c in zip(first.tolist(), n.tolist(), strict=True)]
                        yield pa.RecordBatch.from_arrays(
                            [d.column("doc_id"), pa.array(first + base), d.column("n"), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"]
                        )

    return listed.mapInArrow(load, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the token files of documents and list them as read back."""
    return read_token_files(write_token_files(docs, tokenizer or public_tokenizers.path(TOKENIZER)))


@query("op7_token_files")
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
