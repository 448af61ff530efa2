"""Token alignment: both tokenizers themselves, a plain aligner, counts over all documents, defined cases."""

import hashlib
import random
import tracemalloc
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from strata.llm import tokenalign as T

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(public_tokenizers.path(T.TOKENIZER_A))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(T.TOKENIZER_B))


@pytest.fixture(scope="module")
def aligner():
    return T.Aligner(public_tokenizers.path(T.TOKENIZER_A), public_tokenizers.path(T.TOKENIZER_B))


def plain_align(tokenizers, text):
    """(a tokens, b tokens) as (id, start, end) by the libraries and a loop; none where bytes differ."""
    if not text:
        return [], []
    a, b = tokenizers
    byte = T.byte_alphabet()
    pieces = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    other = []
    for i in b.encode(text):
        p = b.id_to_piece(i)
        other.append((i, bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()))
    if not b"".join(t for _, t in pieces) == b"".join(t for _, t in other) == (" " + text).encode():
        return [], []
    out = []
    for tokens in (pieces, other):
        at, spans = 0, []
        for i, t in tokens:
            spans.append((i, at, at + len(t)))
            at += len(t)
        out.append(spans)
    return tuple(out)


def plain_groups(a, b):
    common = {e for _, _, e in a} & {e for _, _, e in b}
    groups = []
    for side, tokens in enumerate((a, b)):
        at = 0
        for i, _, e in tokens:
            if at == len(groups):
                groups.append(([], []))
            groups[at][side].append(i)
            at += e in common
    return groups


def plain_links(a, b):
    out, low = [], 0
    for i, s, e in a:
        while b[low][2] <= s:
            low += 1
        k = low
        while k < len(b) and b[k][1] < e:
            out.append((i, b[k][0]))
            k += 1
    return out


def strange_texts(n, seed=3):
    rng = random.Random(seed)
    bits = ["word", " ", "  ", "\n", "\t", "é", "ß", "日本", "\U0001f600", "'s", "12345", "!!", "▁", "<|endoftext|>", "<s>", "\x00", " ", "́", "​", "\u0085", "a" * 70]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(0, 30))) for _ in range(n)]


def test_encoders_are_the_libraries(aligner, tokenizers):
    texts = strange_texts(3000)
    ids, n = aligner.a.encode(texts)
    want = [tokenizers[0].encode(" " + t, add_special_tokens=False).ids for t in texts]
    assert n.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    ids, n = aligner.b.encode(texts)
    want = [tokenizers[1].encode(t) for t in texts]
    assert n.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_slow_path_of_other_files(tmp_path, tokenizers, monkeypatch):
    import json

    with open(public_tokenizers.path(T.TOKENIZER_A)) as f:
        spec = json.load(f)
    spec["model"]["merges"][5], spec["model"]["merges"][6] = spec["model"]["merges"][6], spec["model"]["merges"][5]
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec))
    a = T.ByteLevel(str(path))
    assert "encode_batch_fast" in a._encode.__code__.co_names
    text = "some text <|endoftext|> here"
    assert a.encode([text])[0].tolist() and len(a.encode([text])[0]) > 5


def test_align_matches_plain(spark, tokenizers):
    texts = [*strange_texts(150, seed=8), None, "", "plain words in a row", "plain words in a row"]
    docs = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = {r.doc_id: r.groups for r in T.align_documents(df, block_bytes=300).collect()}
    plain = {i: plain_align(tokenizers, t) for i, t in docs}
    for i, (a, b) in plain.items():
        assert [(list(g.a), list(g.b)) for g in rows[i]] == plain_groups(a, b), texts[i]
    assert sum(bool(a) for a, _ in plain.values()) > 60 and sum(not a for a, _ in plain.values()) > 10
    check(plain, T.link_scores(T.link_tables(df, block_bytes=300)).collect())


def check(plain, got):
    held, best = Counter(), defaultdict(int)
    links = {i: plain_links(a, b) for i, (a, b) in plain.items()}
    for pairs in links.values():
        held.update(set(pairs))
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    assert len(got) == len(plain)
    for r in got:
        a, b = plain[r.doc_id]
        groups, pairs = plain_groups(a, b), links[r.doc_id]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        want = (len(a), len(b), len(groups), len(pairs), sum(held[p] == best[p[0]] for p in pairs), sum(held[p] for p in pairs))
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum) == want
        assert r.groups_sha256 == (hashlib.sha256(text.encode()).hexdigest() if groups else "")


def test_query_against_plain(spark, tokenizers):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    check({d.doc_id: plain_align(tokenizers, d.text) for d in docs}, T.op12_token_alignment(spark, SF_SMALL).collect())


def test_frame_cases(spark, aligner):
    schema = "doc_id long, text string, block string, pair int"
    long = "wörter " * 200000
    docs = [(None, None, "x", 1), (None, "a b", "x", 1), (1, "", "x", 1), (2, "▁", "x", 1), (3, long, "x", 1), (3, long, "x", 1), (4, " ", "x", None), (5, "  ", None, 1)]
    df = spark.createDataFrame(docs, schema)
    got = T.link_scores(T.link_tables(df)).collect()
    assert len(got) == len(docs)
    by = {(r.doc_id, r.n_a): r for r in got}
    assert by[1, 0].groups_sha256 == by[2, 0].groups_sha256 == by[None, 0].groups_sha256 == "" and by[1, 0].count_sum == 0
    twice = [r for r in got if r.doc_id == 3]
    assert twice[0] == twice[1] and twice[0].n_a > 400000 and twice[0].n_links >= twice[0].n_a
    empty = spark.createDataFrame([], schema)
    assert T.link_scores(T.link_tables(empty)).count() == 0 and T.align_documents(empty).count() == 0
    assert {r.doc_id: len(r.groups) for r in T.align_documents(df).collect()}[1] == 0


def block_rows(monkeypatch, batches):
    """What a task that makes blocks yields for its batches, in this process."""
    from contextlib import nullcontext
    from types import SimpleNamespace

    task = []
    monkeypatch.setattr(T.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 3))
    monkeypatch.setattr(T, "_texts", lambda *_: SimpleNamespace(mapInArrow=lambda f, _: task.append(f)))
    monkeypatch.setattr(T, "conf", lambda *_, **__: nullcontext(), raising=False)
    monkeypatch.setattr(T.common, "stored", lambda _: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        T.link_tables(SimpleNamespace(sparkSession=None))
    return task[0](iter(batches))


def batch_of(texts):
    return pa.RecordBatch.from_pydict({"id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})


def some_texts(n_bytes, seed=5):
    rng = random.Random(seed)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(5000)]
    return [" ".join(rng.choices(words, k=500)) for _ in range(n_bytes // 3200)]


def test_worker_holds_a_slice_and_its_block(aligner, monkeypatch):
    texts = some_texts(3 << 20)
    batch = batch_of(texts)
    for _ in block_rows(monkeypatch, [batch_of(texts[:2])]):  # the encoders are there
        pass
    tracemalloc.start()
    rows, largest = 0, 0
    for b in block_rows(monkeypatch, [batch]):
        held = tracemalloc.get_traced_memory()[1]
        rows += b.num_rows
        largest = max(largest, b.nbytes / b.num_rows)
    tracemalloc.stop()
    assert held < 64 << 20  # 347 MB when a block was aligned at once
    assert rows == len(texts) and largest < 64 << 10  # a block was one row before


def test_slices_and_batches_do_not_show_in_blocks(aligner, monkeypatch):
    texts = [*strange_texts(200, seed=4), None, "", *some_texts(1 << 18)]
    whole = [b.to_pylist() for b in block_rows(monkeypatch, [batch_of(texts)])]
    assert len(whole) == 1 and len(whole[0]) == len(texts) and {r["block"] for r in whole[0]} == {3 << 32}
    assert [len(r["pair"]) > 0 for r in whole[0]] == [True] + [False] * (len(texts) - 1)
    monkeypatch.setattr(T, "SLICE_BYTES", 500)
    batch = batch_of(texts)
    parts = [batch.slice(i, 7) for i in range(0, len(texts), 7)]
    assert [b.to_pylist() for b in block_rows(monkeypatch, parts)] == whole
