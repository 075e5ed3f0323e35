"""Packing against the library's ids, piece by piece and window by window."""

import collections
import random
import zlib
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tokenizers

from tamarack.llm import packing
from tamarack.llm.queries import QUERIES
from tests.llm.test_operators import docs, hard
from tests.llm.test_pipeline import documents, tables  # noqa: F401

CONTENT = open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read()
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_str(CONTENT.decode())
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_encoder(library, monkeypatch):
    monkeypatch.setattr(packing, "KEPT", 50)
    e, rnd = packing.Encoder(CONTENT, PATTERN), random.Random(1)
    some = ["a", "b c", " ", "  ", "\n", "\t", "\xa0", "　", "é", "🙂", "'s", "'ll", "1", "23", "!", "...", "x" * 50, "\x00", " ", "\x85", "\x1c", "<|endoftext|>", "日本", "́"]
    for k in range(6000):
        text = (" " if k % 2 else "").join(rnd.choice(some) for _ in range(rnd.randrange(12)))
        assert np.frombuffer(e.encode(text), "<u4").tolist() == library(text)
    assert len(e.known) <= 50
    for text in ("x" * 100_000, " " * 100_000, "ab " * 50_000):
        assert np.frombuffer(e.encode(text), "<u4").tolist() == library(text)
    with pytest.raises(ValueError):
        packing.byte_ranks(b'{"model": {"vocab": {"ab": 2, "abc": 1}, "merges": ["a b", "ab c"]}}')


def test_distinct_words_share_a_call(library, monkeypatch):
    """The engine is called for many distinct words at once, not for each."""
    import tiktoken

    calls = []
    for name in ("encode_ordinary", "encode_to_numpy"):
        own = getattr(tiktoken.Encoding, name)
        monkeypatch.setattr(tiktoken.Encoding, name, lambda self, text, own=own, **k: calls.append(len(text)) or own(self, text, **k))
    e = packing.Encoder(CONTENT, PATTERN)
    text = "first " + " ".join(f"word{k}\nx" for k in range(3000)) + " word7\nx" * 20_000
    assert np.frombuffer(e.encode(text), "<u4").tolist() == library(text)
    assert len(calls) <= 4 and sum(calls) < 50_000


@pytest.mark.parametrize("chunk, batch, gathered", [(16 << 20, 8 << 20, 1 << 16), (200, 60, 3), (1, 1, 1)])
def test_batches_of_texts(library, monkeypatch, chunk, batch, gathered):
    """Texts encoded together, whatever is cut where: white space of all kinds at all places, the engine's own special token."""
    for name, value in (("CHUNK", chunk), ("BATCH", batch), ("GATHERED", gathered)):
        monkeypatch.setattr(packing, name, value)
    e, rnd = packing.Encoder(CONTENT, PATTERN), random.Random(4)
    special = [*e.engine.special_tokens_set, "<|endoftext|>"]
    some = ["a", "bcd", " ", " ", " ", " ", "\n", "\xa0", "\u3000", "\x1c", "\x85", "é", "🙂", "'s", "12", "!", "日本", *special]
    texts = [None, "", " ", "  ", "a ", " a", "a\n", "a\n b", "a \nb", "x" * 3000, "日本語" * 500, " ".join(special), "".join(special)]
    texts += ["".join(rnd.choice(some) for _ in range(rnd.randrange(20))) for _ in range(1500)]
    for last in (1, None):
        column = pa.array(["cut off", *texts], pa.string()).slice(1)
        found = [(n, x.as_py()) for sizes, ids in e.rows(column, last) for n, x in zip(sizes, ids)]
        assert len(found) == len(texts)
        for text, (n, ids) in zip(texts, found):
            want = library(text) + ([] if last is None else [last])
            assert np.frombuffer(ids, "<u4").tolist() == want and n == len(want)
    assert [*e.rows(pa.array([], pa.string()), 1)] == []


def test_layout():
    rnd = random.Random(2)
    for total in (0, 1, 100, 2048, 2049, 5000, 20_480, 30_000):
        for cuts in (0, 1, 6):
            edges = sorted({0, total, *(rnd.randrange(total + 1) for _ in range(cuts))})
            seen = collections.Counter((s, o + i) for a, b in zip(edges, edges[1:]) for s, o, n in packing.layout(a, b, total) for i in range(n))
            sizes = collections.Counter(s for s, _ in seen)
            assert set(seen.values()) <= {1} and len(seen) == total
            assert all(max(o for x, o in seen if x == s) == n - 1 and (n == 2048 or n & (n - 1) == 0) for s, n in sizes.items())


def test_round_robin():
    """Every window is filled, no source is far from its share, and few pieces are splinters."""
    rnd = random.Random(3)
    for n in (1, 3, 20, 300):
        owned = np.array([rnd.randrange(1, 30_000) * 7 for _ in range(n)])
        total = int(owned.sum())
        spaces = [x for _, _, x in packing.layout(0, total, total)]
        deficit = np.zeros(n, np.int64)
        w, s, x = packing.dealt(spaces, owned, owned, total, deficit)
        assert np.bincount(w, weights=x).tolist() == spaces and np.bincount(s, weights=x, minlength=n).tolist() == owned.tolist()
        assert (deficit == 0).all()
        quota = np.zeros(n)
        served = np.zeros(n)
        for k, space in enumerate(spaces):
            quota += space * owned / total
            np.add.at(served, s[w == k], x[w == k])
            assert np.abs(quota - served).max() <= 3 * packing.LEAST
        if n == 20:
            full = [k for k, space in enumerate(spaces) if space == 2048]
            assert all(np.abs(x[w == k] - 2048 * owned[s[w == k]] / total).max() <= 2 * packing.LEAST for k in full)
        if n == 300:
            assert (x < packing.LEAST).mean() < 0.2


def held(spark, rows, pieces, library, tied=False):
    """Checks what must hold of any packing of ``rows`` (id, text, source); ``tied``: ids repeat."""
    ids = [array("I", [*library(t), 1]) for _, t, _ in rows]
    windows = collections.defaultdict(list)
    for p in pieces:
        windows[p.sequence_id].append(p)
    for ps in windows.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at == 2048 or at & (at - 1) == 0
    assert sorted(windows) == list(range(len(windows)))
    want = collections.Counter((d, a.tobytes()) for (d, _, _), a in zip(rows, ids))
    if not tied:
        texts = {d: a for (d, _, _), a in zip(rows, ids)}
        by = collections.defaultdict(list)
        for p in pieces:
            by[p.doc_id].append(p)
        for d, a in texts.items():
            at = 0
            for p in sorted(by.pop(d), key=lambda p: p.start):
                assert p.start == at and p.doc_tokens == len(a) and p.ids_crc32 == zlib.crc32(a[at : at + p.length].tobytes())
                at += p.length
            assert at == len(a)
        assert not by
    return want, windows


@pytest.mark.parametrize("slice_windows", [8, 2])
def test_query_rows(spark, tables, library, monkeypatch, slice_windows):  # noqa: F811
    monkeypatch.setattr(packing, "SLICE_WINDOWS", slice_windows)
    rows = [(d.doc_id, d.text, d.source) for d in documents(spark, tables["hard"])]
    pieces = QUERIES["op13_packing"](spark, tables["hard"]).collect()
    _, windows = held(spark, rows, pieces, library)
    # every full window holds each source near its share of all tokens
    source, own = {d: s for d, _, s in rows}, collections.Counter()
    for p in pieces:
        own[source[p.doc_id]] += p.length
    total = sum(own.values())
    gap = []
    for ps in windows.values():
        if sum(p.length for p in ps) == 2048:
            got = collections.Counter()
            for p in ps:
                got[source[p.doc_id]] += p.length
            gap.append(sum(abs(got[s] - 2048 * n / total) for s, n in own.items()))
    assert len(gap) > 100 and max(gap) < 0.35 * 2048 and sum(gap) / len(gap) < 0.1 * 2048
    # reruns agree
    key = lambda ps: sorted((p.doc_id, p.start, p.length, p.sequence_id, p.offset) for p in ps)
    assert key(pieces) == key(QUERIES["op13_packing"](spark, tables["hard"]).collect())


def test_hard_rows_and_sequences(spark, library):
    df = docs(spark, "a short text", "<|endoftext|>", None, "  two  spaces ", source=lambda k: [None, "", "s", "é"][k]).unionByName(hard(spark))
    rows = [(r.doc_id, r.text, r.source) for r in df.collect()]
    out = packing.pack(df, CONTENT, PATTERN).cache()
    pieces = out.collect()
    total = sum(len(library(t)) + 1 for _, t, _ in rows)
    assert sum(p.length for p in pieces) == total
    packed = {r.sequence_id: bytes(r.ids) for r in packing.sequences(out).collect()}
    assert sorted(packed) == list(range(len(packed)))
    for p in pieces:
        assert packed[p.sequence_id][4 * p.offset : 4 * (p.offset + p.length)] == bytes(p.ids)
    # rows of one id are told apart by their whole contents
    found = collections.Counter(b"".join(packed[k] for k in sorted(packed)))
    want = collections.Counter(b"".join(array("I", [*library(t), 1]).tobytes() for _, t, _ in rows))
    assert found == want
    assert packing.pack(df.limit(0), CONTENT, PATTERN).count() == 0


def test_many_sources_and_one_hot(spark, library):
    rnd = random.Random(7)
    texts = [" ".join(f"w{rnd.randrange(999)}" for _ in range(rnd.choice([3, 40, 400]))) for _ in range(400)]
    df = docs(spark, *texts, source=lambda k: "hot" if k % 3 == 0 else f"s{k % 150}")
    rows = [(r.doc_id, r.text, r.source) for r in df.collect()]
    from pyspark.sql import functions as F

    out = packing.pack(df, CONTENT, PATTERN).withColumn("ids_crc32", F.crc32("ids"))
    held(spark, rows, out.collect(), library)
