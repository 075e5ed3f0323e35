"""Periodic runs against all stretches, and the query over tables with hard rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from tamarack.llm import periodic
from tamarack.llm.queries import QUERIES
from tests.llm.test_operators import docs, hard, words
from tests.llm.test_pipeline import documents, tables  # noqa: F401


def brute_runs(w, power=4, shortest=6):
    """Every maximal stretch with a period, kept where no smaller one holds."""
    out, n = [], len(w)
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            s, m = i, j - i + q
            if j > i and m >= max(shortest, power * q) and not any(all(w[a] == w[a + p] for a in range(s, s + m - p)) for p in range(1, q)):
                out.append((s, m, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapsed(w, runs):
    gone = {k for s, m, q in runs for k in range(s + q, s + m)}
    return [x for k, x in enumerate(w) if k not in gone]


@pytest.mark.parametrize("power, shortest", [(4, 6), (2, 2), (3, 1), (2, 5), (3, 10)])
def test_runs(power, shortest):
    rnd = random.Random(power * 100 + shortest)
    some = 0
    for _ in range(1500):
        k = rnd.choice([1, 2, 3, 5])
        base, w = [rnd.randrange(k) for _ in range(rnd.randrange(1, 8))], []
        for _ in range(rnd.randrange(12)):
            w += base * rnd.randrange(6) if rnd.random() < 0.5 else [rnd.randrange(k) for _ in range(rnd.randrange(6))]
        want = brute_runs(w, power, shortest)
        assert periodic.runs(np.array(w, np.int64), power, shortest) == want
        some += len(want)
    assert some > 300


def test_long_texts():
    """Shapes with very many end positions or states, in time that grows with the text."""
    rnd = random.Random(3)
    assert periodic.runs(np.zeros(200_000, np.int64)) == [(0, 200_000, 1)]
    assert periodic.runs(np.tile(np.arange(5_000), 6)) == [(0, 30_000, 5_000)]
    both = np.concatenate([np.arange(100, 900), np.tile(np.arange(40), 9)[:-3], np.arange(1000, 1500), np.zeros(7, np.int64)])
    assert periodic.runs(both) == [(800, 357, 40), (1657, 7, 1)]
    blocks = np.tile(np.array([0] * 9 + [1]), 2_000)
    assert len(periodic.runs(blocks)) == 2_001
    assert periodic.runs(np.array([rnd.randrange(10**6) for _ in range(100_000)])) == []


def test_whole_stretches_hold_all_runs():
    rnd = random.Random(4)
    for _ in range(300):
        w = np.array([rnd.randrange(3) for _ in range(80)])
        held = periodic.stretches(w)
        assert all(any(lo <= s and s + m <= hi for lo, hi in held) for s, m, _ in brute_runs(w.tolist()))


def test_find_runs(spark):
    df = docs(spark, "a b " * 6 + "c", "x", "é\t" * 7, "a " * 5, None, "").unionByName(hard(spark))
    got = periodic.find_runs(df, power=4, shortest=6).collect()
    want = []
    for r in df.collect():
        w = words(r.text)
        runs = brute_runs(w) if len(w) < 1000 else [tuple(x) for x in periodic.runs(periodic.numbers(w))]
        want.append((r.doc_id, len(w), runs, b" ".join(brute_collapsed(w, runs)).decode()))
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed)) for r in got)
    assert sum(len(r.runs) for r in got) >= 2 and periodic.find_runs(df.limit(0)).count() == 0


def brute_query_row(doc_id, text):
    w = words(text)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    n = len(w)
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    first = {}
    ids = [first.setdefault(x, len(first)) for x in w]
    # the plain way is quadratic: words of very long texts without planted periods are told by distance with numpy
    runs = quick_runs(np.array(ids, np.int64))
    best = None
    for s, m, q in runs:
        if best is None or m * best[2] > best[1] * q:
            best = (s, m, q)
    told = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    tail = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *tail, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(b" ".join(brute_collapsed(w, runs))).hexdigest())


def quick_runs(w, power=4, shortest=6):
    """As :func:`brute_runs`, a distance at a time with numpy."""
    out = []
    for q in range(1, len(w) // power + 1):
        edge = np.flatnonzero(np.diff(np.concatenate([[0], w[:-q] == w[q:], [0]])))
        for s, e in zip(edge[::2].tolist(), edge[1::2].tolist()):
            m = e - s + q
            if m >= max(shortest, power * q) and not any(q % p == 0 and (w[s : s + m - p] == w[s + p : s + m]).all() for p in range(1, q)):
                out.append((s, m, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_query_rows(spark, tables):  # noqa: F811
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_periodic_runs"](spark, tables["hard"]).collect()}
    rows = documents(spark, tables["hard"])
    assert got == {d.doc_id: brute_query_row(d.doc_id, d.text) for d in rows} and len(got) == len(rows)
    assert sum(r[0] > 0 for r in got.values()) > 10


def test_query_on_repeated_and_missing_ids(spark, tmp_path):
    hard(spark).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()]
    assert sorted(map(repr, got)) == sorted(repr((r.doc_id, *brute_query_row(r.doc_id, r.text))) for r in hard(spark).collect())
