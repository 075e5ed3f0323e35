"""Operator 10 at five-word shingles: pairs whose shingle sets have a Jaccard similarity of 0.8 or more.

The first candidates are those of operator 10: each text has a SimHash fingerprint, here of its distinct five-word
shingles, and Golay keys link fingerprints of two bits or less apart (:func:`simhash.links`); the node of the smallest
hash speaks for equal fingerprints.  At similarity 0.8 fingerprints differ in about ten bits (an angle of acos(8/9), so
15 % of the bits), and wider radii need hundreds of keys a document, see README.  What lies farther than two bits comes
from banded MinHash: ``BANDS`` keys of ``ROWS`` minima each, so a pair at similarity 0.8 shares a key with probability
1 - (1 - 0.8^5)^20 = 0.9996, and more above.  Candidates of both kinds are verified on the shingles of the texts
themselves, so no pair below 0.8 is linked.

Equal texts are one node.  Nodes that share a key form a bucket.  Its members are verified against the bucket's pivot,
the one that shares its keys with most nodes; where a group has a common original, that is the pivot of its largest
buckets.  A bucket whose members are then all in one component needs nothing more, because no further pair in it could
change a component.  In the others all pairs of different components are compared inside tasks, block by block of up
to ``BLOCK`` members, and only links leave them.  That links the same components as all pairs of each bucket.

No step depends on a size: both sides of every join on texts are dealt by key.

Defined results: words are cut and ASCII letters lowered as in :mod:`simhash`; a text of fewer than five words
is one shingle of all its words, so null and empty texts are copies of each other; a null id never names a component
unless it has no other; an empty table gives an empty result; extra columns are ignored or, in
:func:`drop_near_copies`, kept whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.llm import graph, simhash
from tamarack.llm.common import discard, materialize, n_partitions, ship, uses

SHINGLE, SIMILAR, BANDS, ROWS, SEED, CHUNK = 5, 0.8, 20, 5, 42, 4096
#: Most members and shingles of a block, members compared pair by pair, shingles of a step of the product; shingles
#: of texts that are kept between pairs.
BLOCK, BLOCK_SHINGLES, FEW, STEP, HELD = 512, 250_000, 12, 4096, 100_000
_rng = np.random.default_rng(SEED)
_FLIP, _TIMES = _rng.integers(0, 1 << 64, BANDS * ROWS, np.uint64), _rng.integers(0, 1 << 64, BANDS * ROWS, np.uint64) | np.uint64(1)


def shingles(text: str | None) -> set[bytes]:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) < SHINGLE:
        return {b" ".join(words)}
    return set(map(b" ".join, zip(*(words[k:] for k in range(SHINGLE)))))


def similarity(a: set[bytes], b: set[bytes]) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both)


def sketch(text: str | None) -> tuple[int, list[int], int]:
    """The number of distinct shingles, the key of each band and the SimHash fingerprint."""
    found = shingles(text)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in found), np.uint64, len(found))
    least, over = np.full(BANDS * ROWS, ~np.uint64(0)), np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        over += np.unpackbits(hashes[at : at + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        mixed = (hashes[at : at + CHUNK, None] ^ _FLIP) * _TIMES
        np.minimum(least, mixed.min(axis=0), out=least)
    rows = least.reshape(BANDS, ROWS)
    bits = np.packbits(2 * over > len(found), bitorder="little")
    return len(found), [digest(r.tobytes(), k) - (1 << 63) for k, r in enumerate(rows)], int(bits.view(np.int64)[0])


def _node(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of ``pairs`` (``a``, ``b``) whose texts are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, set[bytes]] = {}
        size = 0

        def of(node: int, text: pa.StringScalar) -> set[bytes]:
            nonlocal size
            if node not in held:
                if size > HELD:
                    held.clear()
                    size = 0
                held[node] = shingles(text.as_py())
                size += len(held[node])
            return held[node]

        for b in batches:
            cols = [b.column(c) for c in ("a", "b", "ta", "tb")]
            ok = [similarity(of(x.as_py(), s), of(y.as_py(), t)) >= SIMILAR for x, y, s, t in zip(*cols)]
            yield pa.RecordBatch.from_arrays([cols[0], cols[1]], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    both = pairs.hint("merge").join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    both = both.hint("merge").join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def fuzzy_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs (``x``, ``n``, ``y``, ``m``) of ``nodes`` (``node``, ``n``, ``fp``) whose fingerprints are equal or that Golay keys
    link: nodes, and the sizes of their sets of shingles."""
    told = materialize(nodes.groupBy("fp").agg(F.min(F.struct("node", "n")).alias("p")).select("fp", "p.node", "p.n"))
    linked = materialize(simhash.links(told.select("fp")))
    end = lambda fp, node, n: told.select(F.col("fp").alias(fp), F.col("node").alias(node), F.col("n").alias(n)).hint("merge")
    same = nodes.select(F.col("node").alias("x"), "n", "fp").join(end("fp", "y", "m"), "fp").where("x <> y")
    apart = linked.join(end("a", "x", "n"), "a").join(end("b", "y", "m"), "b")
    return uses(same.select("x", "n", "y", "m").unionByName(apart.select("x", "n", "y", "m")), told, linked)


def _fits(m: str, n: str) -> Column:
    """Whether sets of these sizes can be similar."""
    return F.least(m, n) >= F.greatest(m, n) * F.lit(SIMILAR)


def shared_shingles(sets: list[set[bytes]]) -> np.ndarray:
    """How many shingles each two sets share: a product of sparse columns, ``STEP`` shingles at a time."""
    seen: dict[bytes, int] = {}
    for s in sets:
        for x in s:
            seen[x] = seen.get(x, 0) + 1
    column = {x: k for k, x in enumerate(x for x, n in seen.items() if n > 1)}
    own = [np.sort(np.array([column[x] for x in s if x in column], np.int64)) for s in sets]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, len(column), STEP):
        part = np.zeros((len(sets), STEP), np.float32)
        for k, c in enumerate(own):
            part[k, c[np.searchsorted(c, at) : np.searchsorted(c, at + STEP)] - at] = 1
        out += part @ part.T
    return out


def block_links(members: list[tuple[int, int, int, set[bytes]]]) -> list[tuple[int, int]]:
    """Links between similar members (node, root, block, shingles) of different roots: enough for their components.

    Of members of two blocks only pairs across them are compared, as those inside have a group of their own.
    """
    top: dict[int, int] = {}

    def find(x: int) -> int:
        while top.setdefault(x, x) != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    sets = [m[3] for m in members]
    if len(members) <= FEW:
        close = ((i, j) for i in range(len(members)) for j in range(i) if similarity(sets[i], sets[j]) >= SIMILAR)
    else:
        both = shared_shingles(sets)
        sizes = np.array([len(s) for s in sets], np.float64)
        close = zip(*(x.tolist() for x in np.nonzero(np.tril(both / (sizes[:, None] + sizes[None, :] - both) >= SIMILAR, -1))))
    across = len({m[2] for m in members}) > 1
    out = []
    for i, j in close:
        (a, ra, ba, _), (b, rb, bb, _) = members[i], members[j]
        if (ba != bb or not across) and (x := find(ra)) != (y := find(rb)):
            top[x] = y
            out.append((a, b))
    return out


def _compared(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Links among ``rows`` (``key``, ``x``, ``root``, ``blocks``): members of a bucket and how many blocks it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, members, out, size = None, [], [], 0
        sets: dict[int, set[bytes]] = {}

        def told() -> pa.RecordBatch:
            pairs = [*out]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in range(2)], ["a", "b"])

        for b in batches:
            for key, lo, hi, x, root, block, text in zip(*(b.column(c) for c in ("key", "lo", "hi", "x", "root", "block", "text"))):
                at = (key.as_py(), lo.as_py(), hi.as_py())
                if at != group:
                    out += block_links(members)
                    group, members = at, []
                    if size > BLOCK_SHINGLES:
                        sets.clear()
                        size = 0
                x = x.as_py()
                if x not in sets:
                    sets[x] = shingles(text.as_py())
                    size += len(sets[x])
                members.append((x, root.as_py(), block.as_py(), sets[x]))
            yield told()
        out += block_links(members)
        yield told()

    block = F.pmod(F.xxhash64("x"), "blocks").cast("int")
    rows = rows.withColumn("block", block).hint("merge").join(texts.select(F.col("node").alias("x"), "text"), "x")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
    rows = rows.select("key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "x", "root", "block", "text")
    rows = rows.repartition(n_partitions(rows.sparkSession), "key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    return rows.mapInArrow(run, "a long, b long")


def _found(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(``doc_id``, ``node``, ``root``, ``component_id``) for each row; its node is the hash of its text."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            told = [sketch(t.as_py()) for t in b.column("text")]
            sizes, keys = pa.array([x[0] for x in told], pa.int64()), pa.array([x[1] for x in told], pa.list_(pa.int64()))
            fps = pa.array([x[2] for x in told], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("node"), sizes, keys, fps], ["doc_id", "node", "n", "keys", "fp"])

    rows = docs.select(docs[id_col].alias("doc_id"), _node(docs[text_col]).alias("node"), docs[text_col].alias("text"))
    told = materialize(rows.mapInArrow(run, f"doc_id {kind}, node long, n long, keys array<bigint>, fp long"))
    nodes = materialize(told.groupBy("node").agg(F.min("doc_id").alias("first"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("fp").alias("fp")))
    keyed = nodes.select(F.col("node").alias("x"), "n", F.explode("keys").alias("key"))
    often = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    shared = materialize(keyed.join(often, "key"))
    degree = shared.groupBy("x").agg(F.sum("many").alias("degree"))
    pivot = shared.join(degree, "x").groupBy("key").agg(F.max(F.struct("degree", F.xxhash64("x").alias("h"), "x", "n")).alias("p"))
    met = shared.join(pivot.select("key", F.col("p.x").alias("y"), F.col("p.n").alias("m")), "key").where(_fits("m", "n") & (F.col("x") != F.col("y")))
    near = fuzzy_pairs(nodes)
    fuzzy = materialize(uses(near.where(_fits("m", "n")), *near._tamarack_uses))
    both = met.select("x", "y").unionByName(fuzzy.select("x", "y"))
    tried = materialize(both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    # the text of each node that shares a key or has a near fingerprint, from the row of its smallest id
    some = shared.select(F.col("x").alias("node")).unionByName(fuzzy.select(F.explode(F.array("x", "y")).alias("node")))
    wanted = nodes.join(some.distinct(), "node", "left_semi").select(F.col("node").alias("w"), "first")
    texts = rows.join(wanted.hint("merge"), rows["doc_id"].eqNullSafe(wanted["first"]) & (rows["node"] == wanted["w"]), "left_semi")
    texts = materialize(texts.select("node", F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(["node"]))
    links = materialize(_verified(tried, texts))
    discard(tried, fuzzy)
    roots = graph.components(links)
    # buckets of three or more with several components
    named = shared.join(roots.withColumnRenamed("node", "x"), "x", "left").withColumn("root", F.coalesce("root", "x"))
    left = named.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    left = left.where("c > 2 and lo <> hi").select("key", F.greatest(F.lit(1), F.ceil(F.col("c") / BLOCK), F.ceil(F.col("s") / BLOCK_SHINGLES)).alias("blocks"))
    more = materialize(_compared(named.join(left, "key").select("key", "x", "root", "blocks"), texts))
    discard(texts, shared, *roots._tamarack_uses)
    roots = graph.components(links.unionByName(more))
    discard(links, more)
    return uses(graph.named(told.select("doc_id", "node"), nodes, roots), told, nodes, *roots._tamarack_uses)


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``doc_id``, ``node``, ``component_id``) for each row; the component is named by its smallest id.

    ``node`` is the hash of the text.
    """
    out = _found(docs, id_col, text_col)
    return uses(out.select("doc_id", "node", "component_id"), *out._tamarack_uses)


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component: of rows with an id one with the smallest, else one without.

    Rows of one component that share that id are told apart by text; of those alike in both one stays.
    """
    found = _found(docs, id_col, text_col)
    told = materialize(found.select("doc_id", "node", "root"))
    discard(*found._tamarack_uses)
    return uses(graph.first_of_each(docs, told, _node(F.col(f"`{text_col}`")), id_col), told)
