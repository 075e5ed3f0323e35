"""Periodic runs of words, by a suffix automaton with ordered sets of end positions.

A run is a stretch of words with smallest period q that is at least ``power`` periods and ``shortest`` words long and that
no neighbouring word extends.  States of the suffix automaton of a text are worked off from the longest to the shortest;
the ordered end positions of a state's children are merged, the smaller set into the larger.  Two positions that become
neighbours are ends of two occurrences of the state's longest string with none between: where their distance is not
greater than its length (for ``power`` periods: than its length / (power - 1)) they seed a repetition with that smallest
period, which is extended to a run by comparing words.  Distances that once were too great stay so, as lengths only
shrink, so each pair of neighbours is looked at once; a text of n words makes O(n log n) of them.

Most texts hold nothing periodic, so an exact test comes first: each run of k words inside a run occurs again within one
period of it (k follows from ``power`` and ``shortest``), so the automaton is built only over stretches where every run
of k words has an equal one within the stretch's length / ``power``.  Runs never cross such a stretch.  Hashes may let
more through, never less.  The automaton keeps about half a kilobyte for a word of a stretch while it is worked off.

Defined results: words are cut at white space of ASCII; null text has no words and no runs; ids are passed through and
may be null or repeat; equal rows give equal results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tamarack.llm.common import ship

POWER, SHORTEST = 4, 6
#: Passes of the test over stretches (each only narrows them), rows and bytes of a batch of results.
PASSES, ROWS, BATCH = 8, 512, 8 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_TURN = np.uint64(29)


def gram(power: int, shortest: int) -> int:
    """The longest k such that each k words of a run have an equal stretch one period away inside the run."""
    return min(max(shortest, power * q) - 2 * q + 1 for q in range(1, shortest + 2))


def stretches(ids: np.ndarray, power: int = POWER, shortest: int = SHORTEST) -> list[tuple[int, int]]:
    """Half-open ranges of words that hold all runs."""
    k, n = gram(power, shortest), len(ids)
    if n < max(shortest, power):
        return []
    h = ids[: n - k + 1].astype(np.uint64)
    for j in range(1, k):
        h = (h ^ (h >> _TURN)) * _ODD + ids[j : n - k + 1 + j].astype(np.uint64)
    h = (h ^ (h >> _TURN)) * _ODD
    order = np.argsort(h, kind="stable")
    same = np.flatnonzero(h[order[1:]] == h[order[:-1]])
    if not len(same):
        return []
    near = np.full(len(h), n, np.int64)
    a, b = order[same], order[same + 1]
    near[a] = b - a
    near[b] = np.minimum(near[b], b - a)
    limit = np.full(len(h), n // power, np.int64)
    size = None
    for _ in range(PASSES):
        edge = np.flatnonzero(np.diff(np.concatenate([[False], near <= limit, [False]]).astype(np.int8)))
        lo, hi = edge[::2], edge[1::2]
        words = hi - lo + k - 1
        long = words >= max(shortest, power)
        lo, hi, words = lo[long], hi[long], words[long]
        if not len(lo) or int(words.sum()) == size:
            break
        size = int(words.sum())
        limit[:] = 0
        for x, y, m in zip(lo.tolist(), hi.tolist(), words.tolist()):
            limit[x:y] = m // power
    return [(int(x), int(y) + k - 1) for x, y in zip(lo, hi)]


def seeds(word: list[int], power: int = POWER) -> set[tuple[int, int]]:
    """(period, end) of repetitions: the words of one period up to ``end`` (inclusive) are those one period before."""
    nxt: list[dict[int, int]] = [{}]
    link, length, own = [-1], [0], [-1]
    last = 0
    for at, c in enumerate(word):
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(at + 1)
        own.append(at)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(nxt[q].copy())
                link.append(link[q])
                length.append(length[p] + 1)
                own.append(-1)
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    del nxt
    # end positions are kept negative, as a chain of states brings them in falling order: new ones come last
    ends: list[list[int] | None] = [None if at < 0 else [-at] for at in own]
    met: dict[int, list[tuple[int, int]]] = {}  # neighbours that merging brought together, until all children are merged
    found: set[tuple[int, int]] = set()
    reach = power - 1
    for state in sorted(range(1, len(length)), key=length.__getitem__, reverse=True):
        few = ends[state]
        ends[state] = None
        for a, b in met.pop(state, ()):
            if few[bisect_left(few, a) + 1] == b:
                found.add((b - a, -a))
        up = link[state]
        most = length[up] // reach
        if not most:
            continue  # too short to seed anything, as are all above it
        many = ends[up]
        if many is None:
            ends[up] = few
            continue
        if len(few) > len(many):
            many, few = few, many
        near = []
        for e in few:
            k = bisect_left(many, e)
            if k and e - many[k - 1] <= most:
                near.append((many[k - 1], e))
            if k < len(many) and many[k] - e <= most:
                near.append((e, many[k]))
            many.insert(k, e)
        ends[up] = many
        if near:
            met.setdefault(up, []).extend(near)
    return found


def _same(word: np.ndarray, a: int, b: int, step: int) -> int:
    """How many words from ``a`` and from ``b`` on (``step`` 1 or -1) are equal, pair by pair."""
    most = min(len(word) - max(a, b) if step > 0 else min(a, b) + 1, len(word))
    done, block = 0, 16
    while done < most:
        m = min(block, most - done)
        if step > 0:
            differ = word[a + done : a + done + m] != word[b + done : b + done + m]
        else:
            differ = (word[a - done - m + 1 : a - done + 1] != word[b - done - m + 1 : b - done + 1])[::-1]
        if differ.any():
            return done + int(differ.argmax())
        done, block = done + m, 2 * block
    return done


def runs(ids: np.ndarray, power: int = POWER, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a text given as numbers of words, by start, then period."""
    out = []
    for lo, hi in stretches(ids, power, shortest):
        word = ids[lo:hi]
        period, upto = 0, -1
        for q, end in sorted(seeds(word.tolist(), power)):
            if q == period and end < upto:
                continue  # inside the run before
            back, ahead = _same(word, end, end - q, -1), _same(word, end + 1, end + 1 - q, 1)
            start, stop = end - back - q + 1, end + ahead + 1
            period, upto = q, stop
            if stop - start >= max(shortest, power * q):
                out.append((lo + start, stop - start, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def numbers(words: list[bytes]) -> np.ndarray:
    """Each word as the place of its first occurrence."""
    first: dict[bytes, int] = {}
    return np.fromiter(map(first.setdefault, words, range(len(words))), np.int64, len(words))


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that stay when each run keeps its first period; one that any run drops goes."""
    edge = np.zeros(len(words) + 1, np.int32)
    for start, length, period in found:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [w for w, gone in zip(words, (np.cumsum(edge[:-1]) > 0).tolist()) if not gone]


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", power: int = POWER, shortest: int = SHORTEST) -> DataFrame:
    """A row for each row of ``docs``: ``doc_id``, ``n_words``, ``runs`` (structs ``start``, ``length``, ``period``) and
    ``collapsed``, the text's words with one period of each run, joined by single spaces."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    run_type = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def told(ids: pa.Array, rows: list[tuple[int, list, bytes]]) -> pa.RecordBatch:
        found = pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r[1]] for r in rows], run_type)
        return pa.RecordBatch.from_arrays([ids, pa.array([r[0] for r in rows], pa.int64()), found, pa.array([r[2] for r in rows], pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lo, rows, size = 0, [], 0
            for k, t in enumerate(b.column("text").cast(pa.binary())):
                words = (t.as_py() or b"").split()
                found = runs(numbers(words), power, shortest) if words else []
                rows.append((len(words), found, b" ".join(collapsed(words, found) if found else words)))
                size += len(rows[-1][2])
                if size >= BATCH or len(rows) == ROWS:
                    yield told(b.column("doc_id").slice(lo, len(rows)), rows)
                    lo, rows, size = k + 1, [], 0
            if rows:
                yield told(b.column("doc_id").slice(lo, len(rows)), rows)

    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
