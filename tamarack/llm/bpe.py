"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token is a linked list of symbols.  Every pair that the vocabulary can merge waits in the bucket
of its merge's rank; a bitmap over ranks, with bitmaps over its words above it, says which buckets hold
anything, and find-first-set in each level gives the lowest rank.  A bucket yields its positions from
left to right; an entry whose pair has changed since it was queued is stale and is skipped.  Each
symbol enters and leaves a bounded number of buckets, so a pre-token of n bytes takes O(n) queue steps
whatever its length, where rescanning takes O(n^2).

The texts of a block are split first and their pre-tokens numbered.  Those met for the first time, most of
the cost where words are many, wait in one queue: their symbols are one linked list in arrays, with a
separator that merges with nothing between pre-tokens, and a bucket is merged in a few array operations
wherever its pair stands.  A bucket's order then matters only where its pairs overlap, unless a merge brings
up a lower rank than its own, which a vocabulary learnt by merging doesn't do: pre-tokens in which that
happens are merged again, one by one, as are long ones and small numbers of them.

Ids of pre-tokens already met are kept in a table of bounded size.

Defined results: null text is empty and has no ids; lone surrogates can't occur in a string column;
extra columns are ignored; repeated rows give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tamarack.llm.common import ship

#: Bits in a word of the bitmap; find-first-set on a word of this size is one step for Python's integers.
WORD = 256
#: Pairs or pre-tokens kept, characters of the latter; characters of texts encoded together.
KEPT, KEPT_CHARS, BLOCK = 800_000, 16 << 20, 4 << 20
#: Fewest pre-tokens that share a queue, bytes of the longest, bytes of all.
FEW, LONGEST_SHARED, SHARED = 5_000, 256, 4 << 20


class RankQueue:
    """A priority queue of list positions by merge rank."""

    def __init__(self, n_ranks: int) -> None:
        self.levels: list[list[int]] = []
        while True:
            n_ranks = -(-n_ranks // WORD)
            self.levels.append([0] * n_ranks)
            if n_ranks == 1:
                break
        self.buckets: dict[int, list] = {}  # of positions, or of arrays of them

    def push(self, rank: int, at: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            heappush(bucket, at)
        else:
            self.open(rank, [at])

    def push_all(self, ranks: np.ndarray, at: np.ndarray) -> None:
        """Positions by their ranks, an array a bucket."""
        order = ranks.argsort(kind="stable")
        ranks, at = ranks[order], at[order]
        cuts = [0, *((ranks[1:] != ranks[:-1]).nonzero()[0] + 1).tolist(), len(ranks)]
        for lo, hi, rank in zip(cuts, cuts[1:], ranks[cuts[:-1]].tolist() if len(ranks) else ()):
            bucket = self.buckets.get(rank)
            if bucket is not None:
                bucket.append(at[lo:hi])
            else:
                self.open(rank, [at[lo:hi]])

    def open(self, rank: int, bucket: list) -> None:
        self.buckets[rank] = bucket
        for level in self.levels:
            word = rank // WORD
            before = level[word]
            level[word] = before | BITS[rank % WORD]
            if before:
                return
            rank = word

    def lowest(self) -> int:
        """The lowest rank with a bucket, or -1."""
        at = 0
        for level in reversed(self.levels):
            word = level[at]
            if not word:
                return -1
            at = at * WORD + (word & -word).bit_length() - 1
        return at

    def clear(self, rank: int) -> None:
        del self.buckets[rank]
        for level in self.levels:
            word = rank // WORD
            level[word] ^= BITS[rank % WORD]
            if level[word]:
                return
            rank = word


BITS = [1 << k for k in range(WORD)]


class Numbers(dict):
    """Pre-tokens numbered as they are first met."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class Pairs:
    """The merges of all pairs of a vocabulary, to be looked up by arrays."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        get = ranks.get
        halves = ((get(t[:k]), get(t[k:]), r) for t, r in ranks.items() for k in range(1, len(t)))
        found = np.array([h for h in halves if h[0] is not None and h[1] is not None] or np.zeros((0, 3)), np.int64)
        keys = found[:, 0] << 32 | found[:, 1]
        order = keys.argsort()
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.ranks = np.append(found[order, 2], -1)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of pairs of ids, or -1."""
        keys = left << 32 | right
        at = self.keys.searchsorted(keys)
        return np.where(self.keys[at] == keys, self.ranks[at], -1)


class Bpe:
    """A vocabulary (bytes -> rank, which is also the id) and its pre-token pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.tokens = {i: b for b, i in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.queue = RankQueue(max(ranks.values()) + 1)
        self.byte = [ranks[bytes([b])] for b in range(256)]
        self.pairs: dict[int, int] = {}  # left id << 32 | right id -> id of the merge or -1; bounded
        self.numbers, self.packed = Numbers(), []  # number of a pre-token, and its ids
        self.shared: Pairs | None = None
        column = [None] * (max(ranks.values()) + 1)
        for i, b in self.tokens.items():
            column[i] = b
        self.column = pa.array(column, pa.large_binary())

    def pair(self, key: int) -> int:
        """The rank of a pair that ``self.pairs`` doesn't hold yet."""
        if len(self.pairs) >= KEPT:
            self.pairs.clear()
        rank = self.pairs[key] = self.ranks.get(self.tokens[key >> 32] + self.tokens[key & 0xFFFFFFFF], -1)
        return rank

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        ids = list(map(self.byte.__getitem__, piece))
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        queue, known = self.queue, self.pairs.get
        push, buckets = queue.push, queue.buckets
        a = ids[0]
        for k in range(1, n):
            b = ids[k]
            if (r := known(key := a << 32 | b)) is None:
                r = self.pair(key)
            if r >= 0:
                push(r, k - 1)
            a = b
        while buckets:
            rank = queue.lowest()
            bucket = buckets[rank]
            while bucket:
                k = heappop(bucket) if len(bucket) > 1 else bucket.pop()
                a = ids[k]
                j = right[k]
                if a < 0 or j >= n:
                    continue  # stale: merged into its left neighbour, or nothing follows any more
                if (r := known(key := a << 32 | ids[j])) is None:
                    r = self.pair(key)
                if r != rank:
                    continue  # stale: the pair has changed
                ids[k], ids[j], lower = rank, -1, False
                right[k] = after = right[j]
                if after < n:
                    left[after] = k
                    if (r := known(key := rank << 32 | ids[after])) is None:
                        r = self.pair(key)
                    if r >= 0:
                        push(r, k)
                        lower = r < rank
                if (i := left[k]) >= 0:
                    if (r := known(key := ids[i] << 32 | rank)) is None:
                        r = self.pair(key)
                    if r >= 0:
                        push(r, i)
                        lower |= r < rank
                if lower:
                    break  # a vocabulary learnt by merging has no such pair, but any other may
            if not bucket:
                queue.clear(rank)
        return [x for x in ids if x >= 0]

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of many pre-tokens, through one queue."""
        pairs, queue, buckets = self.shared, self.queue, self.queue.buckets
        size = np.array(list(map(len, pieces)))
        # a separator before each pre-token and one at the end
        symbols = np.frombuffer(b"".join(pieces), np.uint8)
        at = np.arange(len(symbols)) + np.repeat(np.arange(1, len(pieces) + 1), size)
        n = len(symbols) + len(pieces) + 1
        ids = np.full(n, len(self.column))
        ids[at] = np.array(self.byte)[symbols]
        left, right = np.arange(-1, n - 1, dtype=np.int32), np.arange(1, n + 1, dtype=np.int32)
        rank_at = np.append(pairs(ids[:-1], ids[1:]), -1).astype(np.int32)
        at = (rank_at >= 0).nonzero()[0]
        queue.push_all(rank_at[at], at)
        begins, again = (ids == len(self.column)).nonzero()[0], []
        while buckets:
            rank = queue.lowest()
            bucket = buckets[rank]
            queue.clear(rank)
            at = np.concatenate(bucket) if len(bucket) > 1 else bucket[0]
            at = at[rank_at[at] == rank]  # others are stale
            if not len(at):
                continue
            at.sort()
            j = right[at]
            meet = j[:-1] == at[1:]
            if meet.any():  # pairs that overlap: the first, third and so on of a run merge
                first = np.append(0, (~meet).nonzero()[0] + 1)
                at = at[(np.arange(len(at)) - np.repeat(first, np.diff(first, append=len(at)))) % 2 == 0]
                j = right[at]
            after = right[j]
            near = after[:-1] == at[1:]
            if near.any():  # a new symbol before a pair that merges too
                near = after[:-1][near]
                ranks = pairs(np.full(len(near), rank), ids[near])
                again.append(near[(ranks >= 0) & (ranks < rank)])
            ids[at], ids[j], rank_at[j] = rank, -1, -1
            right[at], left[after] = after, at
            before = left[at]
            at = np.concatenate([at, before[ids[before] != rank]])  # what follows a new symbol, and new symbols after others
            ranks = pairs(ids[at], ids[right[at]])
            rank_at[at] = ranks
            some = ranks >= 0
            ranks, at = ranks[some], at[some]
            if len(ranks) and ranks.min() < rank:
                again.append(at[ranks < rank])
            queue.push_all(ranks, at)
        ids = ids[ids >= 0]
        ends = (ids == len(self.column)).nonzero()[0]
        packed = ids.astype("<u4").tobytes()
        out = [packed[4 * lo + 4 : 4 * hi] for lo, hi in zip(ends.tolist(), ends[1:].tolist())]
        for k in np.unique(begins.searchsorted(np.concatenate(again)) - 1).tolist() if again else ():
            out[k] = self.merge_one(pieces[k])
        return out

    def merge_one(self, piece: bytes) -> bytes:
        ids = self.merge(piece)
        return struct.pack(f"<{len(ids)}I", *ids)

    def merged(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of pre-tokens."""
        many = [k for k, p in enumerate(pieces) if 1 < len(p) <= LONGEST_SHARED and p not in self.ranks]
        out: list[bytes | None] = [None] * len(pieces)
        if len(many) >= FEW:
            self.shared = self.shared or Pairs(self.ranks)
            upto = np.cumsum([len(pieces[k]) for k in many]) // SHARED
            for own in np.split(np.array(many), (upto[1:] != upto[:-1]).nonzero()[0] + 1):
                own = own.tolist()
                for k, ids in zip(own, self.merge_all([pieces[k] for k in own])):
                    out[k] = ids
        return [self.merge_one(p) if ids is None else ids for p, ids in zip(pieces, out)]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        number, packed = self.numbers.__getitem__, self.packed
        rows = [array("I", map(number, self.split(t))) for t in texts]
        packed += self.merged([w.encode() for w in islice(self.numbers, len(packed), None)])
        out = [b"".join(map(packed.__getitem__, row)) for row in rows]
        if len(packed) > KEPT or sum(map(len, self.numbers)) > KEPT_CHARS:
            self.numbers.clear()
            packed.clear()
        return out

    def encode(self, text: str) -> array:
        """Ids of a text, as unsigned 32-bit integers."""
        out = array("I")
        out.frombytes(self.encode_all([text])[0])
        return out

    def decode_all(self, rows: list[bytes]) -> list[bytes]:
        """The bytes of each row of ids."""
        out = self.column.take(pa.array(np.frombuffer(b"".join(rows), "<u4")))
        if out.null_count:
            raise KeyError("ids that the vocabulary doesn't have")
        ends = np.cumsum([0, *(len(r) // 4 for r in rows)])
        at = np.frombuffer(out.buffers()[1], np.int64)[ends].tolist()
        text = memoryview(out.buffers()[2] or b"")
        return [bytes(text[lo:hi]) for lo, hi in zip(at, at[1:])]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def parse_ranks(content: bytes) -> dict[bytes, int]:
    """The ranks in a file of lines ``base64 rank``."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line.strip())}


_loaded: dict[tuple[int, str], Bpe] = {}


def load(content: bytes, pattern: str) -> Bpe:
    key = (hash(content), pattern)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Bpe(parse_ranks(content), pattern)
    return _loaded[key]


def blocks(rows: list, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` characters or bytes."""
    lo = size = 0
    for hi, row in enumerate(rows, 1):
        size += len(row)
        if size >= most or hi == len(rows):
            yield lo, hi
            lo, size = hi, 0


def over_rows(docs: DataFrame, content: bytes, pattern: str, each, schema: str, id_col: str, col: str, empty) -> DataFrame:
    """``doc_id`` and the columns that ``each(bpe, values)`` returns, in blocks of rows; the vocabulary file is broadcast (under 1 MB)."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(content)
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["doc_id", *(x.split()[0] for x in schema.split(","))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(shared.value, pattern)
        for b in batches:
            values = [x or empty for x in b.column("value").to_pylist()]
            for lo, hi in blocks(values, BLOCK):
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), *map(pa.array, each(bpe, values[lo:hi]))], names)

    rows = docs.select(docs[id_col].alias("doc_id"), docs[col].alias("value"))
    return rows.mapInArrow(run, f"doc_id {kind}, {schema}")


def sha256(values: list[bytes]) -> list[str]:
    return [hashlib.sha256(x).hexdigest() for x in values]


def over_texts(docs: DataFrame, content: bytes, pattern: str, each, schema: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the columns that ``each(bpe, ids)`` returns for the packed ids of some rows, of all rows."""
    return over_rows(docs, content, pattern, lambda bpe, texts: each(bpe, bpe.encode_all(texts)), schema, id_col, text_col, "")


def encode_texts(docs: DataFrame, content: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit integers, as binary) for each row."""
    return over_texts(docs, content, pattern, lambda bpe, ids: [ids], "ids binary", id_col, text_col)


def decode_ids(encoded: DataFrame, content: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id`` and ``text`` (binary, as ids can stop inside a character) for each row of ids."""
    return over_rows(encoded, content, "x", lambda bpe, rows: [bpe.decode_all(rows)], "text binary", id_col, ids_col, b"")
