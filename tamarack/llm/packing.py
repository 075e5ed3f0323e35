"""Packing documents into sequences whose sources keep their share of tokens, by deficit round-robin.

Documents of each source stand in a queue in shuffled order (a hash of id and tokens).  A window of ``LENGTH`` tokens adds
to the deficit of each source its quantum, the window's tokens times the source's share of all tokens, and serves each
source the whole tokens of its deficit; what is left of the window goes to the largest deficits.  A source with less than
``LEAST`` tokens to its credit waits, so pieces don't become splinters where there are many sources, and its deficit is
carried into the windows after.  Documents are cut where a window ends and go on in the next one.  As every document is
packed once, the shares are those of the corpus: no others could last to its end.  For other weights mix the sources
first (:mod:`mixing`) and pack the mix.

The queues are cut into slices of equal virtual time: slice j of P holds the tokens of a source from floor(T * j / P) on,
T being its tokens, so each slice holds all sources at their shares, and where a slice begins among all tokens is a sum
over sources.  A slice begins with the deficits that this leaves: the tokens before it times the share, less what was
served.  So slices are dealt by tasks of their own, windows go on across them, and none waits for another.

Texts are encoded once and the ids written; the schedule works on (key, source, tokens, hash), the place of a document in
its queue being a prefix sum over hash ranges of its source; ids are moved once, to the cuts of their document.

Every sequence but the last few is full: the tokens left at the end make sequences of a power of two each, so there is
no padding at all.

Encoding: a text is cut at spaces between characters that are no white space, where a pre-token always begins.  The
distinct pieces of many texts are encoded by one call, in which ids that begin with a space tell pieces apart, and the ids
of each text are gathered from theirs.  A text with other spaces is encoded in one go.

Defined results: null text is empty and has the end token only; a null source is a source of its own; strings of special
tokens in a text are ordinary text; null ids and repeated rows are documents like others, and rows alike in id and tokens
may change places between reruns, which changes nothing; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarack.llm.common import materialize, n_partitions, ship, uses

LENGTH, END = 2048, 1
#: Fewest tokens of a piece where more than one source waits; tokens of a slice, and its windows at least.
LEAST, SLICE, SLICE_WINDOWS = 32, 1 << 21, 8
#: Heads whose ids are kept, characters of the longest; bytes of texts encoded together, of ids in a batch; ids moved at once.
KEPT, LONGEST_KEPT, CHUNK, BATCH, GATHERED = 100_000, 32, 4 << 20, 8 << 20, 1 << 16


def byte_ranks(content: bytes) -> dict[bytes, int]:
    """Bytes -> id of a byte-level BPE in the JSON format of ``tokenizers``, whose ids follow the order of merges."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}
    model = json.loads(content)["model"]
    merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    ids = [model["vocab"][t] for t in merges]
    if any(a >= b for a, b in zip(ids, ids[1:])):
        raise ValueError("ids don't follow the order of merges")
    return {bytes(byte[c] for c in t): model["vocab"][t] for t in [*byte, *merges]}


def blocks(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``most`` in all, or of one row that is larger."""
    upto, lo = np.cumsum(sizes), 0
    while lo < len(sizes):
        before = upto[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(upto, before + most, side="right")))
        yield lo, hi
        lo = hi


class Encoder:
    """Ids of texts, as little-endian unsigned 32-bit integers."""

    def __init__(self, content: bytes, pattern: str) -> None:
        import tiktoken

        ranks = byte_ranks(content)
        top = max(ranks.values()) + 1
        # the special token is never allowed, so it is ordinary text; with none at all the engine stops at every place to look for one
        self.engine = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={"<|none|>": top})
        self.after_space = np.zeros(top, bool)
        self.after_space[[i for b, i in ranks.items() if b[:1] == b" "]] = True
        self.known: dict[str, bytes] = {}

    def whole(self, text: str) -> np.ndarray:
        return self.engine.encode_to_numpy(text, allowed_special=set(), disallowed_special=())

    def head(self, text: str) -> bytes:
        """Ids of what stands before the first space."""
        found = self.known.get(text)
        if found is None:
            found = self.whole(text).tobytes()
            if len(text) <= LONGEST_KEPT:
                if len(self.known) >= KEPT:
                    self.known.clear()
                self.known[text] = found
        return found

    def pieces(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, each after a space, and where each word's begin.  No word has a space or white space at its ends."""
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array([0, len(words)], pa.int64()), words), " ")
        ids = self.whole(" " + joined[0].as_py())
        begins = np.flatnonzero(self.after_space[ids])
        assert len(begins) == len(words)
        return ids, begins

    def rows(self, texts: pa.Array, last: int | None = None) -> Iterator[tuple[np.ndarray, pa.Array]]:
        """Numbers of ids and ids of the texts, ``last`` behind each, in batches of about ``BATCH`` bytes."""
        texts = pc.fill_null(texts, "")
        for lo, hi in blocks(pc.binary_length(texts).to_numpy(zero_copy_only=False), CHUNK):
            yield from self._chunk(texts.slice(lo, hi - lo), last)

    def _chunk(self, texts: pa.Array, last: int | None) -> Iterator[tuple[np.ndarray, pa.Array]]:
        n, split = len(texts), pc.split_pattern(texts, " ")
        coded = split.flatten().dictionary_encode()
        words, index = coded.dictionary, coded.indices.to_numpy()
        bounds = split.offsets.to_numpy().astype(np.int64)
        first, m = bounds[:-1], len(words)
        size, inner, upto = (pc.binary_length(x).to_numpy() for x in (words, pc.utf8_trim_whitespace(words), pc.utf8_rtrim_whitespace(words)))
        # texts that have white space beside a space are encoded in one go
        odd = ((size == 0) | (inner < size))[index]
        odd[first] = (upto < size)[index[first]] & (np.diff(bounds) > 1)
        odd = np.logical_or.reduceat(odd, first)
        rest = ~np.repeat(odd, np.diff(bounds))
        rest[first] = False
        used = np.zeros(m, bool)
        used[index[rest]] = True
        ids, begins = self.pieces(words.filter(pa.array(used)))
        heads = [self.head(t) for t in pc.if_else(pa.array(odd), texts, words.take(pa.array(index[first]))).to_pylist()]
        # where the ids of each entry begin, and how many: words, heads, the last id, nothing
        counts, starts = np.zeros(m + n + 2, np.int64), np.zeros(m + n + 2, np.int64)
        counts[:m][used], starts[:m][used] = np.diff(begins, append=len(ids)), begins
        counts[m:-1] = [*(len(x) // 4 for x in heads), 0 if last is None else 1]
        starts[m:] = len(ids) + np.cumsum(counts[m:]) - counts[m:]
        ids = np.concatenate([ids, np.frombuffer(b"".join(heads), np.uint32), np.array([] if last is None else [last], np.uint32)])
        index = np.where(rest, index, m + n + 1)
        index[first] = m + np.arange(n)
        index = np.insert(index, bounds[1:], m + n)
        bounds += np.arange(n + 1)
        counts = counts[index]
        at = np.concatenate([[0], np.cumsum(counts)])
        ends = at[bounds]
        for lo, hi in blocks(4 * np.diff(ends), BATCH):
            out = np.empty(ends[hi] - ends[lo], np.uint32)
            for a, b in blocks(counts[bounds[lo] : bounds[hi]], GATHERED):
                a, b = a + bounds[lo], b + bounds[lo]
                if b - a == 1:
                    own = slice(starts[index[a]], starts[index[a]] + counts[a])
                else:
                    own = np.repeat(starts[index[a:b]] - at[a:b], counts[a:b]) + np.arange(at[a], at[b])
                out[at[a] - ends[lo] : at[b] - ends[lo]] = ids[own]
            offsets = (4 * (ends[lo : hi + 1] - ends[lo])).astype(np.int32)
            yield np.diff(ends[lo : hi + 1]), pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(offsets), pa.py_buffer(out)])

    def encode(self, text: str) -> bytes:
        return b"".join(x.as_py() for _, ids in self.rows(pa.array([text], pa.string())) for x in ids)


_loaded: dict[int, Encoder] = {}


def encoded(docs: DataFrame, content: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", end: int = END) -> DataFrame:
    """``doc_id``, ``src`` (a source key that is never null), ``n`` and ``ids``, the end token last, for each row."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(content)  # a vocabulary file
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        content = shared.value
        if hash(content) not in _loaded:
            _loaded[hash(content)] = Encoder(content, pattern)
        encoder = _loaded[hash(content)]
        for b in batches:
            at = 0
            for n, ids in encoder.rows(b.column("text"), end):
                own = b.slice(at, len(ids))
                yield pa.RecordBatch.from_arrays([own.column("doc_id"), own.column("src"), pa.array(n, pa.int64()), ids], ["doc_id", "src", "n", "ids"])
                at += len(ids)

    src = F.coalesce(F.concat(F.lit("1"), F.col(f"`{source_col}`").cast("string")), F.lit("2"))
    rows = docs.select(docs[id_col].alias("doc_id"), src.alias("src"), docs[text_col].alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, src string, n long, ids binary")


def layout(at: int, stop: int, total: int, length: int = LENGTH) -> list[tuple[int, int, int]]:
    """(sequence, first offset, tokens) of the windows that share tokens ``at`` to ``stop`` of ``total``."""
    full = total - total % length
    out = []
    while at < min(stop, full):
        n = min(length - at % length, stop - at, full - at)
        out.append((at // length, at % length, n))
        at += n
    sequence, begin = full // length, full
    for bit in reversed(range(length.bit_length())):
        if (total - full) >> bit & 1:
            lo, hi = max(at, begin), min(stop, begin + (1 << bit))
            if lo < hi:
                out.append((sequence, lo - begin, hi - lo))
            sequence, begin = sequence + 1, begin + (1 << bit)
    return out


def dealt(spaces: list[int], owned: np.ndarray, left: np.ndarray, total: int, deficit: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, source, tokens) that deficit round-robin serves: sources have ``owned`` of ``total`` tokens, and ``left`` of
    them fill ``spaces``.  ``deficit`` is in parts of a token, ``total`` to one, and is changed in place."""
    left = left.copy()
    w, s, x = [], [], []
    for k, space in enumerate(spaces):
        deficit += space * owned
        if space == left.sum():
            take = left.copy()
        else:
            take = np.minimum(np.maximum(deficit // total, 0), left)
            take[(take < least) & (take < left)] = 0
            need = space - int(take.sum())
            if need < 0:
                for i in np.argsort(deficit - take * total, kind="stable"):
                    back = min(-need, int(take[i]))
                    take[i] -= back
                    need += back
                    if not need:
                        break
            rank = np.argsort(take * total - deficit, kind="stable") if need else ()
            for all_of_it in (False, True):
                for i in rank:
                    if not need:
                        break
                    more = min(need, int(left[i] - take[i]), need if all_of_it else 1 if take[i] else least)
                    take[i] += more
                    need -= more
        deficit -= take * total
        left -= take
        some = np.flatnonzero(take)
        w.append(np.full(len(some), k))
        s.append(some)
        x.append(take[some])
    return np.concatenate(w), np.concatenate(s), np.concatenate(x)


def slice_pieces(key: np.ndarray, source: np.ndarray, owned: np.ndarray, begin: np.ndarray, first: np.ndarray, n: np.ndarray, at: int, served: np.ndarray, total: int) -> dict[str, np.ndarray]:
    """Pieces of a slice.  Its rows are parts of documents: ``n`` tokens of document ``key`` from ``begin`` on, at ``first`` in
    the queue of ``source``, which owns ``owned`` tokens, ``served`` of them before this slice; ``at`` are the tokens before
    it of all sources."""
    order = np.lexsort((first, source))
    key, source, begin, n = key[order], source[order], begin[order], n[order]
    names, lead, of = np.unique(source, return_index=True, return_inverse=True)
    owned, served = owned[order][lead], served[order][lead]
    left = np.bincount(of, weights=n).astype(np.int64)
    # exact: products of two totals don't fit 64 bits, their difference does
    deficit = np.array([at * int(t) - int(d) * total for t, d in zip(owned, served)], np.int64)
    plan = layout(at, at + int(n.sum()), total)
    w, s, x = dealt([p[2] for p in plan], owned, left, total, deficit)
    before = np.cumsum(x) - x
    sequence, offset, _ = (np.array(c, np.int64) for c in zip(*plan))
    offset = offset[w] + before - before[np.searchsorted(w, w)]
    # the queues end to end, cut where a part of a document or what a window takes of a source ends
    by = np.lexsort((w, s))
    ends, takes = np.cumsum(n), np.cumsum(x[by])
    cuts = np.union1d(ends, takes)
    lo = np.concatenate([[0], cuts[:-1]])
    part, turn = np.searchsorted(ends, lo, side="right"), np.searchsorted(takes, lo, side="right")
    inside = lo - (takes - x[by])[turn]
    return {"key": key[part], "start": begin[part] + lo - (ends - n)[part], "length": cuts - lo, "sequence_id": sequence[w[by]][turn], "offset": offset[by][turn] + inside}


def _slice_start(j: str, slices: int) -> Column:
    """floor(owned * j / slices), in 64 bits."""
    return F.expr(f"(owned div {slices}) * ({j}) + ((owned % {slices}) * ({j})) div {slices}")


def schedule(small: DataFrame, total: int, slices: int) -> DataFrame:
    """(``key``, ``start``, ``length``, ``sequence_id``, ``offset``) of all pieces, from (``key``, ``src``, ``n``, ``h``)."""
    spark = small.sparkSession
    bits = min(16, max(6, (4 * n_partitions(spark)).bit_length()))
    ranged = small.withColumn("range", F.shiftrightunsigned("h", 64 - bits).cast("int"))
    stats = materialize(ranged.groupBy("src", "range").agg(F.sum("n").alias("n")))
    upto = Window.partitionBy("src").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    told = stats.select("src", "range", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("ahead"), F.sum("n").over(Window.partitionBy("src")).alias("owned"))
    starts = stats.groupBy("src").agg(F.sum("n").alias("owned")).withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    starts = starts.groupBy("slice").agg(F.sum(_slice_start("slice", slices)).alias("at"))
    inside = Window.partitionBy("src", "range").orderBy("h", "key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranged.join(told, ["src", "range"]).withColumn("first", F.col("ahead") + F.sum("n").over(inside) - F.col("n"))
    of = lambda x: F.expr(f"(cast({x} + 1 as decimal(20,0)) * {slices} - 1) div owned").cast("int")  # noqa: E731  the slice of a token
    parts = placed.withColumn("slice", F.explode(F.sequence(of("first"), of("first + n - 1"))))
    parts = parts.withColumns({"served": _slice_start("slice", slices), "next": _slice_start("slice + 1", slices)})
    lo, hi = F.greatest("first", "served"), F.least(F.col("first") + F.col("n"), F.col("next"))
    parts = parts.select("slice", "key", "src", "owned", "served", (lo - F.col("first")).alias("begin"), lo.alias("first"), (hi - lo).alias("n"))

    def run(table: pa.Table) -> pa.Table:
        c = {x: table.column(x).combine_chunks().to_numpy(zero_copy_only=False) for x in table.column_names}
        src = np.unique(c["src"].astype(str), return_inverse=True)[1]
        return pa.table(slice_pieces(c["key"], src, c["owned"], c["begin"], c["first"], c["n"], int(c["at"][0]), c["served"], total))

    out = parts.join(starts, "slice").groupBy("slice").applyInArrow(run, "key long, start long, length long, sequence_id long, offset long")
    return uses(out, stats)


def pack(docs: DataFrame, content: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """A row for each piece: ``doc_id``, ``start`` and ``length`` in its document's tokens, ``ids`` (little-endian unsigned
    32-bit integers), ``doc_tokens``, ``sequence_id`` and ``offset`` in that sequence."""
    spark = docs.sparkSession
    rows = encoded(docs, content, pattern, id_col, text_col, source_col)
    rows = materialize(rows.withColumns({"key": F.monotonically_increasing_id(), "h": F.xxhash64("doc_id", "ids")}), compression="zstd")
    small = rows.select("key", "src", "n", "h")
    total = small.agg(F.sum("n")).first()[0] or 0
    slices = max(1, min(max(4 * n_partitions(spark), total // SLICE), total // (SLICE_WINDOWS * LENGTH)))
    pieces = schedule(small, total, slices)
    cuts = pieces.groupBy("key").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("cuts"))
    own = "substring(ids, cast(4 * c.start + 1 as int), cast(4 * c.length as int))"
    both = rows.select("key", "doc_id", "n", "ids").join(cuts, "key")
    both = both.select("doc_id", F.col("n").alias("doc_tokens"), F.expr(f"transform(cuts, c -> struct(c.start, c.length, c.sequence_id, c.offset, {own} as ids))").alias("cuts"))
    out = both.select("doc_id", "doc_tokens", F.inline("cuts")).select("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
    return uses(out, rows, *pieces._tamarack_uses)


def sequences(pieces: DataFrame) -> DataFrame:
    """(``sequence_id``, ``ids``): the pieces of :func:`pack` put together, at most ``LENGTH`` tokens each."""
    held = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(F.aggregate(held, F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))
