"""Substring dedup by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of a document.  A word goes if a window over it also starts in a
document with a smaller id; the first document keeps it.

Windows are compared in buckets.  A window's minimiser is the least hash of the ``MINIMISER``-word runs in
it; consecutive windows of a document that share it travel together as one packed string of words, a
super-k-mer, to the bucket of the minimiser.  Equal windows have equal minimisers and so meet in one bucket,
where they are sorted by hash, and windows of equal hash are compared word by word.

Hot keys: a first pass over all texts counts windows by minimiser, and runs that would be the minimiser of more
than one window in ``SHARE`` (or four times the buckets, where that is more) come last in the order of runs, so that
a frequent phrase is a minimiser only where all runs of a window are frequent.  Copies are combined before the shuffle: of equal super-k-mers in one chunk of
a task's input only the one of the smallest document travels, as all windows of the others are known to go.  A
passage that a third of all documents holds therefore reaches its bucket once for each chunk, not once for each
document.  There are ``SPLIT`` buckets for each shuffle partition; one is worked off in blocks, and one with more
than ``ROUND`` windows in two passes: the first keeps nothing but hashes, the second what repeats.

Words are cut and hashed with numpy over the bytes of whole chunks; loops in Python run over super-k-mers and over
windows whose hash repeats.

Defined results: ids are integers or strings; null text has no words; rows with a null id neither lose words nor
make others lose any; rows that repeat an id are compared as one document and keep their own texts; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from tamarack.llm.common import discard, materialize, n_partitions, ship

WINDOW, MINIMISER = 13, 2
#: Bytes of text whose super-k-mers are combined, bytes of a block of a bucket, most windows of a super-k-mer,
#: windows of a bucket that are held at once.
CHUNK, BLOCK, LONGEST, ROUND = 6 << 20, 4 << 20, 4096, 2_000_000
#: Buckets for each shuffle partition; the least share of windows that makes a run frequent; the least count of a chunk.
SPLIT, SHARE, LEAST = 4, 4096, 64
#: Words of more bytes are hashed one by one.
LONG_WORD = 64
LEVEL = 5
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_LAST = np.uint64(1 << 63)
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def tidy(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words, each with one space behind it; where each begins (and the end); and the first word of each text
    (and their number)."""
    joined = b"\n".join(texts) + b"\n"
    data = np.frombuffer(joined, np.uint8)
    space = _SPACE[data]
    before = np.empty_like(space)
    before[0], before[1:] = True, space[:-1]
    start = np.flatnonzero(before & ~space)
    size = np.flatnonzero(space & ~before) - start
    place = np.zeros(len(start) + 1, np.int64)
    np.cumsum(size + 1, out=place[1:])
    words = data[~(space & before)]  # spaces behind a space go
    words[place[1:] - 1] = 32
    edges = np.cumsum([0] + [len(t) + 1 for t in texts])
    return words.tobytes(), place, np.searchsorted(start, edges)


def word_hashes(text: bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The hash of each word ``text[start : start + size]``, eight bytes a step."""
    padded = text + bytes(8)
    eights = np.ndarray((len(text) + 1,), "<u8", padded, strides=(1,))
    h = _mixed((eights[start] & _MASK[np.minimum(size, 8)]) + size.astype(np.uint64) * _ODD[1])
    more = np.flatnonzero(size > 8)
    at = 8
    while len(more) and at < LONG_WORD:
        h[more] = _mixed(h[more] * _ODD[0] + (eights[start[more] + at] & _MASK[np.minimum(size[more] - at, 8)]))
        at += 8
        more = more[size[more] > at]
    for k in more.tolist():
        h[k] = xxhash.xxh64_intdigest(text[start[k] : start[k] + size[k]], 7)
    return h


_powers: list[np.ndarray] = []


def _rolling(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums S and factors R: ``(S[b] - S[a]) * R[a]`` is the hash of the words a..b-1, wherever they stand."""
    if not _powers or len(_powers[0]) < len(h) + 1:
        n = max(1 << 20, 2 * len(h) + 2)
        base = int(_ODD[2])
        _powers[:] = [np.cumprod(np.append(np.uint64(1), np.full(n - 1, x, np.uint64)), dtype=np.uint64) for x in (base, pow(base, -1, 1 << 64))]
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * _powers[0][: len(h)], out=total[1:])
    return total, _powers[1]


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def _among(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of ``x`` are in ``known`` (sorted): by a table of their upper bits, then exactly."""
    table = np.zeros(1 << 20, bool)
    table[(known >> np.uint64(44)).astype(np.int64)] = True
    out = table[(x >> np.uint64(44)).astype(np.int64)]
    maybe = np.flatnonzero(out)
    if len(maybe):
        out[maybe] = known[np.minimum(np.searchsorted(known, x[maybe]), len(known) - 1)] == x[maybe]
    return out


def super_kmers(h: np.ndarray, first: np.ndarray, heavy: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the hashed words of documents that begin at ``first`` (ending with the total): document, first word,
    one past the last word, and minimiser of each super-k-mer, in order.  Runs in ``heavy`` (sorted) come last."""
    none = np.zeros(0, np.int64)
    if len(h) < WINDOW:
        return none, none, none, none.astype(np.uint64)
    n = len(h) - MINIMISER + 1
    runs = _mixed(sum(h[k : k + n] * _ODD[k] for k in range(MINIMISER))) >> np.uint64(1)
    if heavy is not None and len(heavy):
        runs[_among(runs, heavy)] |= _LAST
    least = _sliding_min(runs, WINDOW - MINIMISER + 1)
    counts = np.diff(first)
    n = len(least)
    inside = np.arange(n) + WINDOW <= np.repeat(first[1:], counts)[:n]
    at = np.flatnonzero(inside)
    doc = np.repeat(np.arange(len(counts)), counts)[at]
    least = least[at]
    if not len(at):
        return none, none, none, none.astype(np.uint64)
    new = np.ones(len(at), bool)
    new[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(at)))
    if sizes.max() > LONGEST:
        starts = np.concatenate([np.arange(s, s + z, LONGEST) for s, z in zip(starts, sizes)])
        sizes = np.diff(np.append(starts, len(at)))
    return doc[starts], at[starts], at[starts] + sizes - 1 + WINDOW, least[starts]


class _Table:
    """The rows that tasks exchange.  Bucket -1: words ``start`` to ``stop`` of row (``doc_id``, ``h``) go.  Others:
    ``data`` is a piece of the bucket, see :func:`_pack`."""

    def __init__(self, text_ids: bool) -> None:
        self.text_ids = text_ids
        self.kind = "string" if text_ids else "long"
        self.ddl = f"doc_id {self.kind}, h long, start int, stop int, bucket int, data binary"
        self.types = [pa.string() if text_ids else pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        self.names = ["doc_id", "h", "start", "stop", "bucket", "data"]

    def ids(self, column) -> np.ndarray:
        """Ids as numbers, or as UTF-8, whose order is Spark's."""
        if not self.text_ids:
            return column.cast(pa.int64()).to_numpy(zero_copy_only=False)
        return _objects(column.cast(pa.binary()).to_pylist())

    def ranges(self, ids: np.ndarray, h: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.RecordBatch:
        """Rows of bucket -1 for half-open ranges of words, those that touch or overlap merged."""
        ranks = np.unique(ids, return_inverse=True)[1] if self.text_ids else ids
        order = np.lexsort((start, h, ranks))
        ranks, h, start, stop = ranks[order], h[order], start[order], stop[order]
        other = np.ones(len(order), bool)
        other[1:] = (ranks[1:] != ranks[:-1]) | (h[1:] != h[:-1])
        lift = (np.cumsum(other) - 1) << 32  # rows one after another, so that ends of one row never reach the next
        reach = np.maximum.accumulate(stop + lift)
        new = other.copy()
        new[1:] |= (start + lift)[1:] > reach[:-1]
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(order)) - 1
        kept = ids[order[at]]
        named = pa.array([x.decode() for x in kept] if self.text_ids else kept, self.types[0])
        n = len(at)
        return pa.RecordBatch.from_arrays([named, pa.array(h[at]), pa.array(start[at].astype(np.int32)), pa.array((reach - lift)[last].astype(np.int32)), pa.array(np.full(n, -1, np.int32)), pa.nulls(n, pa.binary())], self.names)

    def pieces(self, buckets: list[int], data: list[bytes]) -> pa.RecordBatch:
        n = len(buckets)
        return pa.RecordBatch.from_arrays([*(pa.nulls(n, t) for t in self.types[:4]), pa.array(buckets, pa.int32()), pa.array(data, pa.binary())], self.names)


def _objects(values: list) -> np.ndarray:
    out = np.empty(len(values), object)
    out[:] = values
    return out


def _pack(ids: np.ndarray, h: np.ndarray, at: np.ndarray, texts: list[bytes]) -> bytes:
    """A piece: number of windows; then, compressed, how many super-k-mers and their columns: id (numbers as steps
    from one to the next), hash of the row's text, number of the first word, words."""
    n = len(texts)
    if ids.dtype == object:
        named = np.array([len(x) for x in ids], np.uint32).tobytes() + b"".join(ids)
    else:
        named = np.diff(ids, prepend=0).tobytes()
    text = b"\n".join(texts)
    n_windows = text.count(b" ") + n * (2 - WINDOW)
    body = n.to_bytes(4, "little") + len(named).to_bytes(8, "little") + named + h.tobytes() + at.astype(np.uint32).tobytes() + text
    return n_windows.to_bytes(8, "little") + zstandard.ZstdCompressor(level=LEVEL).compress(body)


def _unpack(piece: bytes, text_ids: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    raw = zstandard.ZstdDecompressor().decompress(piece[8:])
    n, size, at = int.from_bytes(raw[:4], "little"), int.from_bytes(raw[4:12], "little"), 12
    if text_ids:
        ends = np.cumsum(np.frombuffer(raw, np.uint32, n, at), dtype=np.int64) + at + 4 * n
        ids = _objects([raw[a:z] for a, z in zip([at + 4 * n, *ends[:-1].tolist()], ends.tolist())])
    else:
        ids = np.cumsum(np.frombuffer(raw, np.int64, n, at))
    at += size
    return ids, np.frombuffer(raw, np.int64, n, at), np.frombuffer(raw, np.uint32, n, at + 8 * n).astype(np.int64), raw[at + 12 * n :]


def _send(ids: np.ndarray, rows: np.ndarray, texts: list[bytes], n_buckets: int, heavy: np.ndarray, table: _Table) -> Iterator[pa.RecordBatch]:
    """A chunk's super-k-mers, packed by bucket, and the ranges it can settle."""
    text, place, first = tidy(texts)
    h = word_hashes(text, place[:-1], np.diff(place) - 1)
    doc, start, stop, least = super_kmers(h, first, heavy)
    if not len(doc):
        return
    total, back = _rolling(h)
    whole = _mixed((total[stop] - total[start]) * back[start])
    rank = np.unique(ids, return_inverse=True)[1][doc] if table.text_ids else ids[doc]
    a, z = place[start], place[stop] - 1
    # of equal super-k-mers the one of the smallest id leads; those of larger ids are settled here
    order = np.argsort(whole, kind="stable")
    same = whole[order][1:] == whole[order][:-1]
    twice = np.zeros(len(order), bool)
    twice[1:], twice[:-1] = same, twice[:-1] | same
    order = order[twice]
    gone = np.zeros(len(doc), bool)
    if len(order):
        order = order[np.lexsort((rank[order], whole[order]))]
        held = [text[x:y] for x, y in zip(a[order].tolist(), z[order].tolist())]
        new = np.array([True, *(x != y for x, y in zip(held, held[1:]))])
        lead = rank[order][np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
        gone[order] = rank[order] > lead
    at = start - first[doc]
    if gone.any():
        yield table.ranges(ids[doc[gone]], rows[doc[gone]], at[gone], (at + stop - start)[gone])
    kept = np.flatnonzero(~gone)
    bucket = (_mixed(least[kept]) % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    kept, bucket = kept[order], bucket[order]
    held = [text[x:y] for x, y in zip(a[kept].tolist(), z[kept].tolist())]
    cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    packed = []
    for i, j in zip(cut.tolist(), [*cut[1:].tolist(), len(kept)]):
        k = kept[i:j]
        packed.append(_pack(ids[doc[k]], rows[doc[k]], at[k], held[i:j]))
    yield table.pieces(bucket[cut].tolist(), packed)


class _Block:
    """Some pieces of a bucket: super-k-mers (id, row, first word) and the windows in them (hash, super-k-mer,
    place in it, bytes of ``text``)."""

    def __init__(self, found: list[tuple]) -> None:
        self.ids, self.rows, self.at = (np.concatenate([x[k] for x in found]) for k in range(3))
        self.text = b"\n".join([x[3] for x in found])
        data = np.frombuffer(self.text, np.uint8)
        stop = np.append(np.flatnonzero((data == 32) | (data == 10)), len(data))
        start = np.append(0, stop[:-1] + 1)
        ends = np.append(np.flatnonzero(data[stop[:-1]] == 10) + 1, len(stop))
        h = word_hashes(self.text, start, stop - start)
        total, back = _rolling(h)
        sizes = np.diff(ends, prepend=0)
        n_windows = sizes - (WINDOW - 1)
        self.skm = np.repeat(np.arange(len(ends)), n_windows)
        self.place = np.arange(len(self.skm)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
        word = self.place + np.repeat(ends - sizes, n_windows)
        self.hash = _mixed((total[word + WINDOW] - total[word]) * back[word])
        self.start, self.stop = start[word], stop[word + WINDOW - 1]


def _blocks(pieces: list[bytes], text_ids: bool) -> Iterator[_Block]:
    held, size = [], 0
    for piece in pieces:
        held.append(_unpack(piece, text_ids))
        size += len(held[-1][3])
        if size >= BLOCK:
            yield _Block(held)
            held, size = [], 0
    if held:
        yield _Block(held)


def _repeated(h: np.ndarray, ids: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Which windows are equal to one with a smaller id."""
    order = np.lexsort((ids, h))
    hs = h[order]
    new = np.ones(len(order), bool)
    new[1:] = hs[1:] != hs[:-1]
    seq = order.tolist()
    differ = np.array([False, *(texts[i] != texts[j] for i, j in zip(seq, seq[1:]))], bool)
    if (differ & ~new).any():  # one hash, several windows: sort by words too
        seq = sorted(seq, key=lambda k: (h[k], texts[k], ids[k]))
        order = np.array(seq)
        new = np.array([True, *(texts[i] != texts[j] for i, j in zip(seq, seq[1:]))])
    lead = ids[order][np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    out = np.zeros(len(h), bool)
    out[order] = ids[order] > lead
    return out


def _settle(pieces: list[bytes], table: _Table) -> Iterator[pa.RecordBatch]:
    """Ranges of words that go, for one bucket."""
    if not pieces:
        return
    few = sum(int.from_bytes(p[:8], "little") for p in pieces) <= ROUND
    blocks = list(_blocks(pieces, table.text_ids)) if few else None
    hashes = np.concatenate([b.hash for b in blocks or _blocks(pieces, table.text_ids)])
    hashes.sort()
    again = np.unique(hashes[1:][hashes[1:] == hashes[:-1]])
    del hashes
    if not len(again):
        return
    got, texts = [], []
    for b in blocks or _blocks(pieces, table.text_ids):
        k = np.flatnonzero(_among(b.hash, again))
        skm = b.skm[k]
        got.append((b.hash[k], b.ids[skm], b.rows[skm], b.at[skm] + b.place[k]))
        texts += [b.text[x:y] for x, y in zip(b.start[k].tolist(), b.stop[k].tolist())]
    h, ids, rows, start = (np.concatenate(x) for x in zip(*got))
    gone = _repeated(h, np.unique(ids, return_inverse=True)[1] if table.text_ids else ids, texts)
    if gone.any():
        yield table.ranges(ids[gone], rows[gone], start[gone], start[gone] + WINDOW)


def _chunks(batches: Iterator[pa.RecordBatch], table: _Table) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Ids, row hashes and texts of chunks of about ``CHUNK`` bytes."""
    held, size = [], 0
    for b in batches:
        ids, rows, texts = table.ids(b.column("doc_id")), b.column("h").to_numpy(), b.column("text").cast(pa.binary()).to_pylist()
        lo = 0
        for k, t in enumerate(texts):
            size += len(t)
            if size >= CHUNK:
                held.append((ids[lo : k + 1], rows[lo : k + 1], texts[lo : k + 1]))
                yield np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]), [t for x in held for t in x[2]]
                held, size, lo = [], 0, k + 1
        if lo < len(texts):
            held.append((ids[lo:], rows[lo:], texts[lo:]))
    if held:
        yield np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]), [t for x in held for t in x[2]]


def shares(n_buckets: int) -> int:
    """Into how many parts of all windows a run may fall before it is frequent: a run that is not has at most a quarter of
    a bucket's mean share, so buckets stay even on clusters of any size; this many runs are broadcast, 8 bytes each."""
    return max(SHARE, 4 * n_buckets)


def _heavy(rows: DataFrame, table: _Table, share: int = SHARE) -> np.ndarray:
    """Runs that are the minimiser of more than one window in ``share``, sorted: no more than ``share`` of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, texts in _chunks(batches, table):
            text, place, first = tidy(texts)
            _, start, stop, least = super_kmers(word_hashes(text, place[:-1], np.diff(place) - 1), first)
            if not len(least):
                continue
            runs, where = np.unique(least, return_inverse=True)
            n = np.bincount(where, weights=stop - start - (WINDOW - 1)).astype(np.int64)
            often = n >= max(LEAST, n.sum() // (4 * share))
            yield pa.RecordBatch.from_arrays([pa.array([None, *runs[often].astype(np.int64).tolist()], pa.int64()), pa.array([int(n.sum()), *n[often].tolist()], pa.int64())], ["run", "n"])

    counts = materialize(rows.mapInArrow(count, "run long, n long").groupBy("run").agg(F.sum("n").alias("n")))
    total = counts.where("run is null").agg(F.sum("n")).first()[0] or 0
    found = counts.where(F.col("run").isNotNull() & (F.col("n") * share > total)).select("run").collect()
    discard(counts)
    return np.sort(np.array([r.run for r in found], np.int64).astype(np.uint64))


def numbered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text`` and ``h``, which tells rows of one id apart: 0 where no id repeats, else the text's hash."""
    once = docs.groupBy(id_col).count().where(F.col(id_col).isNotNull() & (F.col("count") > 1)).isEmpty()
    h = F.lit(0).cast("long") if once else F.xxhash64(text_col)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), h.alias("h"))


def repeats(docs: DataFrame) -> DataFrame:
    """(``doc_id``, ``h``, ``ranges``): for each row that loses words, half-open ranges of word numbers, each as
    one number (first word << 32 | one past the last); ``h`` is as :func:`numbered` has it in ``docs``."""
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema["doc_id"].dataType
    if not isinstance(kind, (IntegralType, StringType)):
        raise TypeError(f"ids have to be integers or strings, not {kind.simpleString()}")
    table = _Table(isinstance(kind, StringType))
    n = n_partitions(spark)
    n_buckets = SPLIT * n
    rows = docs.select(F.col("doc_id").cast(table.kind), "h", F.coalesce("text", F.lit("")).alias("text")).where("doc_id is not null")
    heavy = _heavy(rows, table, shares(n_buckets))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, hashes, texts in _chunks(batches, table):
            yield from _send(ids, hashes, texts, n_buckets, heavy, table)

    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        now = -1
        for b in batches:
            settled = pc.less(b.column("bucket"), 0)
            yield b.filter(settled)
            for bucket, data in zip(*(b.filter(pc.invert(settled)).column(c).to_pylist() for c in ("bucket", "data"))):
                if bucket != now:
                    yield from _settle(held, table)
                    held, now = [], bucket
                held.append(data)
        yield from _settle(held, table)

    sent = rows.mapInArrow(send, table.ddl)
    # settled ranges are dealt by document, the rest by bucket, the same number of buckets to each partition
    part = F.when(F.col("bucket") < 0, F.pmod(F.hash("doc_id", "h"), F.lit(n))).otherwise(F.col("bucket") % n)
    met = sent.repartitionById(n, part.cast("int")).sortWithinPartitions("bucket").mapInArrow(receive, table.ddl)
    span = F.shiftleft(F.col("start").cast("long"), 32).bitwiseOR(F.col("stop").cast("long"))
    return met.groupBy("doc_id", "h").agg(F.collect_list(span).alias("ranges"))


def gone_mask(n_words: int, ranges: np.ndarray) -> np.ndarray:
    """Which words of a text go."""
    edge = np.zeros(n_words + 1, np.int32)
    np.add.at(edge, ranges >> 32, 1)
    np.add.at(edge, ranges & 0xFFFFFFFF, -1)
    return np.cumsum(edge[:-1]) > 0


def over_kept(docs: DataFrame, each, schema: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and what ``each(number of words, removed, kept words)`` returns, for each row."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = [x.split()[0] for x in schema.split(",")]
    rows = numbered(docs, id_col, text_col)
    found = repeats(rows).select(F.col("doc_id").alias("_tmk_id"), F.col("h").alias("_tmk_h"), "ranges")
    both = rows.join(found, (rows["doc_id"] == found["_tmk_id"]) & (rows["h"] == found["_tmk_h"]), "left").select("doc_id", "text", "ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t, r in zip(b.column("text").cast(pa.binary()).to_pylist(), b.column("ranges")):
                words = (t or b"").split()
                if r.is_valid:
                    gone = gone_mask(len(words), r.values.to_numpy())
                    kept = [w for w, g in zip(words, gone.tolist()) if not g]
                else:
                    kept = words
                out.append(each(len(words), len(words) - len(kept), kept))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array([o[k] for o in out]) for k in range(len(names)))], ["doc_id", *names])

    return both.mapInArrow(run, f"doc_id {kind}, {schema}")


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``doc_id``, ``text``): each row's text without its repeated words, joined by single spaces."""
    return over_kept(docs, lambda n, gone, kept: (b" ".join(kept).decode(),), "text string", id_col, text_col)


def digest(n: int, gone: int, kept: list[bytes]) -> tuple[int, int, str]:
    return n, gone, hashlib.sha256(b" ".join(kept)).hexdigest()
