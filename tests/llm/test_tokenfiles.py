"""Token files: exact ids against the tokenizer, round trip, random access."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
from tokenizers import Tokenizer

from strata.llm import tokenfiles as T

SF_SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(T.TOKENIZER)


def plain(rows, end=2):
    tok, start, out = Tokenizer.from_file(PATH), 0, []
    for d, text in rows:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, end]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def odd_texts():
    return [None, "", "   ", "plain words here", "Tabs\tand\nlines\r\n", "ÀÉ é ́ x", "it's they'll 12 345", "a<|endoftext|>b <|startoftext|> c",
            "non breaking wide", "x\x1cy\x85z", "你好 123 \U0001f600\U0001f600", "w" * 3000, "T\u0308 H\u0331 E\u0301 \u0301x \u0345", "x<|ENDOFTEXT|>y A<|endoftext|> <| B", "word. Word, WORD;:!?", "a.b. c, d ,e .. f...g! 1. 2: é. x.\ty;\n.z?", "long text " * 9000, "ΟΔΟΣ ΣΑΣ"]


def test_words_encode_like_whole_texts():
    enc, tok = T.WordEncoder(PATH), Tokenizer.from_file(PATH)
    texts = [t or "" for t in odd_texts()]
    arrow = lambda x: pa.array(x, pa.large_string())
    for _ in range(2):  # the second time from the cache
        ids, n = enc.encode(arrow(texts))
        got = np.split(ids, np.cumsum(n)[:-1])
        assert [g.tolist() for g in got] == [tok.encode(t, add_special_tokens=False).ids for t in texts]
        assert [g.tolist() for g in np.split(*(lambda r: (r[0], np.cumsum(r[1])[:-1]))(T.WordEncoder(PATH, by_word=False).encode(arrow(texts))))] == [g.tolist() for g in got]
    for _ in range(3):  # also after the cache was cut
        enc.weight = T.CACHE_BYTES + 1
        ids, n = enc.encode(arrow(texts[::2]))
        assert [g.tolist() for g in np.split(ids, np.cumsum(n)[:-1])] == [tok.encode(t, add_special_tokens=False).ids for t in texts[::2]]
    part = arrow(texts).slice(3, 5)
    ids, n = enc.encode(part)
    assert [g.tolist() for g in np.split(ids, np.cumsum(n)[:-1])] == [tok.encode(t, add_special_tokens=False).ids for t in texts[3:8]]
    enc.weight = T.CACHE_BYTES + 1
    assert enc.encode(arrow(["plain words here"]))[0].tolist() == tok.encode("plain words here", add_special_tokens=False).ids



def test_workers_keep_few_words_between_tasks(spark):
    """Workers are reused: after a task only the most frequent words stay, not all it met."""
    texts = [" ".join(f"w{i}x{j}" for j in range(400)) + " often often" for i in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    files = T.write_token_files(df, PATH)

    def kept(batches):
        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": [e.weight for e in T._ENCODERS.values()]})

    got = [r.n for r in spark.range(64).repartition(16).mapInArrow(kept, "n long").collect()]
    assert all(n <= T.RESTING_BYTES for n in got)
    assert sorted(tuple(r) for r in T.read_token_files(files).collect()) == plain(list(enumerate(texts)))
    enc = T.WordEncoder(PATH)
    before = enc.encode(pa.array(texts, pa.large_string()))
    assert enc.weight > T.RESTING_BYTES
    enc.rest()
    assert 0 < enc.weight <= T.RESTING_BYTES and b"often" in enc.index
    after = enc.encode(pa.array(texts, pa.large_string()))
    assert all((x == y).all() for x, y in zip(before, after, strict=True))


def test_round_trip(spark):
    rows = list(enumerate(odd_texts()))
    df = spark.createDataFrame([(d, t, "x") for d, t in reversed(rows)], "doc_id long, text string, part string")
    files = T.write_token_files(df, PATH, seq_len=16)
    got = sorted(tuple(r) for r in T.read_token_files(files).collect())
    assert got == plain(rows)
    fs, base = pafs.FileSystem.from_uri(files.path)
    parts = files.parts.orderBy("part").collect()
    assert sum(p.n_docs for p in parts) == len(rows)
    for p in parts:
        f = T.SequenceFile(fs, f"{base}/part-{p.part:06d}.arrow")
        assert len(f) == -(-p.n_tokens // 16)
        run = f.ids(0, p.n_tokens)
        for i in range(len(f)):
            ids, mask = f.sequence(i)
            valid = np.array(mask.to_pylist())
            assert len(ids) == 16 and valid.sum() == min(16, p.n_tokens - 16 * i)
            assert ids[valid].tolist() == run[16 * i : 16 * i + 16].tolist() and not ids[~valid].any()
            assert not ids.flags.owndata  # a view of the mapped file


def test_repeats_nulls_and_empty(spark):
    rows = [(None, "b"), (4, "same"), (4, "same"), (4, "other"), (2, None), (None, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in T.encode_documents(df).collect()), key=lambda r: r[1])
    assert sorted((str(r[0]), r[2], r[3]) for r in got) == sorted((str(r[0]), r[2], r[3]) for r in plain(rows))
    assert [r[0] for r in got] == [None, None, 2, 4, 4, 4]
    assert [r[1] for r in got] == np.cumsum([0] + [r[2] for r in got])[:-1].tolist()
    assert T.encode_documents(df.limit(0)).count() == 0


def test_query_matches_tokenizer(spark):
    import __spark_entry__ as E

    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect())
    assert sorted(tuple(r) for r in E.queries()["op7_token_files"](spark, SF_SMALL).collect()) == plain(rows)
