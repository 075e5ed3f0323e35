"""SimHash near-dedup: Golay-code fuzzy hashing finds fingerprints that differ in few bits.

A text's fingerprint has a bit set where over half of the 64-bit hashes of its 3-word shingles have it.
Documents with equal fingerprints are one node, so copies never meet each other.

Finding nodes at distance 2 or less: the fingerprint is cut into segments A (23 bits), B (23) and C (18).
The binary Golay code is perfect: each 23-bit word lies within 3 bits of exactly one codeword, whose 12
information bits are its index.  The keys of a segment are the indices of the word and of the 23 words one
bit away (one or six different ones).  Two words at distance 2 or less share a key, that of a word between
them.  With at most two errors over three segments, one of these holds, and each is a kind of key:

* A is equal, and B shares a key;
* B is equal, and A shares a key;
* A and B have one error each, so C is equal and both A and B share a key.

Nodes that share a key are candidates and are verified by their distance.  Keys are counted first, combined before
the shuffle, and only shared keys go on.  A key shared by more than ``SMALL`` nodes isn't paired up: its nodes emit
the words between them (the node and its 64 neighbours), and nodes that meet at such a word are within 2 bits of
each other, so each links to the least of them.  That finds the same components exactly, with 65 rows a node instead
of all pairs.

Components are found by joins over distinct fingerprints; only ids and fingerprints move, never texts.  Both sides of
every join are dealt by key, so no table of keys, links or names passes the driver, whatever its size.

Defined results: null and empty texts have fingerprint zero and are linked like any other; a null id never
names a component unless the component has no other; repeated rows share their component; an empty table
gives an empty result; extra columns are ignored or, in :func:`drop_near_copies`, kept whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tamarack.llm import graph
from tamarack.llm.common import discard, materialize, ship, uses

SEED, SHINGLE, DISTANCE, SMALL = 42, 3, 2, 32
#: Fixed value: a generator polynomial of the binary Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
CHUNK = 16384


def fingerprint(text: str | None) -> int:
    """The fingerprint of one text, as a signed 64-bit integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE + 1)
    over = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        part = words[at : at + CHUNK + SHINGLE - 1]
        shingles = map(b" ".join, zip(part, part[1:], part[2:])) if len(part) >= SHINGLE else [b" ".join(part)]
        hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64)
        over += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * over > n, bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """(``doc_id``, ``fp``) for each row, and with ``keep`` the ``row``, a struct."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t.as_py()) for t in b.column("text")]
            rows = [b.column("row")] if keep else []
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps, pa.int64()), *rows], ["doc_id", "fp", "row"][: 2 + keep])

    cols = [docs[id_col].alias("doc_id"), docs[text_col].alias("text")]
    if not keep:
        return docs.select(*cols).mapInArrow(run, f"doc_id {kind}, fp long")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(*cols, row)
    return rows.mapInArrow(run, StructType([StructField("doc_id", docs.schema[id_col].dataType), StructField("fp", LongType()), StructField("row", rows.schema["row"].dataType)]))


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator."""
    rest = words.astype(np.int64)
    for k in range(22, 10, -1):
        rest = np.where(rest >> k & 1, rest ^ GENERATOR << (k - 11), rest)
    return rest


def golay_index() -> np.ndarray:
    """For each 23-bit word, the information bits (the upper 12) of the codeword within 3 bits of it."""
    one = 1 << np.arange(23)
    two = (one[:, None] | one[None, :]).ravel()
    errors = np.unique(np.concatenate([[0], one, two, (two[:, None] | one[None, :]).ravel()]))
    leader = np.zeros(2048, np.int64)
    leader[_syndromes(errors)] = errors  # 2048 error patterns of up to 3 bits, one for each syndrome
    every = np.arange(1 << 23)
    return ((every ^ leader[_syndromes(every)]) >> 11).astype(np.int16)


_table: list[np.ndarray] = []


def segment_keys(words: np.ndarray) -> np.ndarray:
    """Distinct keys of each 23-bit word, padded on the right with -1: at most six columns."""
    if not _table:
        _table.append(golay_index())
    near = words[:, None] ^ np.append(0, 1 << np.arange(23))[None, :]
    keys = np.sort(_table[0][near].astype(np.int64), axis=1)
    keys[:, 1:][keys[:, 1:] == keys[:, :-1]] = -1
    return -np.sort(-keys, axis=1)[:, :6]


def fuzzy_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``fps``, key) of every key of every fingerprint."""
    u = fps.view(np.uint64)
    low = np.uint64((1 << 23) - 1)
    a, b, c = (u & low).astype(np.int64), (u >> np.uint64(23) & low).astype(np.int64), (u >> np.uint64(46)).astype(np.int64)
    ka, kb = segment_keys(a), segment_keys(b)
    cross = np.where((ka[:, :, None] >= 0) & (kb[:, None, :] >= 0), (c[:, None, None] << 24) | (ka[:, :, None] << 12) | kb[:, None, :], -1)
    kinds = [np.where(kb >= 0, (a[:, None] << 12) | kb, -1), np.where(ka >= 0, (1 << 60) | (b[:, None] << 12) | ka, -1), np.where(cross >= 0, (2 << 60) | cross, -1).reshape(len(fps), -1)]
    keys = np.concatenate(kinds, axis=1)
    row, col = np.nonzero(keys >= 0)
    return row, keys[row, col]


def links(nodes: DataFrame) -> DataFrame:
    """Edges (``a``, ``b``) between fingerprints ``fp`` (distinct) that have the components of all pairs within 2 bits."""
    ship(nodes.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column("fp").to_numpy(zero_copy_only=False)
            for at in range(0, len(fps), CHUNK):
                part = fps[at : at + CHUNK]
                row, keys = fuzzy_keys(part)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[row])], ["key", "fp"])

    keyed = nodes.select("fp").mapInArrow(run, "key long, fp long")
    often = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    keyed = materialize(keyed.join(often.hint("merge"), "key"))
    few = keyed.where(F.col("n") <= SMALL).groupBy("key").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    few = few.select(F.explode("fps").alias("a"), "fps").select("a", F.explode(F.filter("fps", lambda x: (x > F.col("a")) & (F.bit_count(x.bitwiseXOR(F.col("a"))) <= DISTANCE))).alias("b"))
    flips = F.array(F.lit(0).cast("long"), *[F.shiftleft(F.lit(1).cast("long"), k) for k in range(64)])
    many = keyed.where(F.col("n") > SMALL).select("fp").distinct().select("fp", F.explode(F.transform(flips, lambda m: m.bitwiseXOR(F.col("fp")))).alias("mid"))
    least = many.groupBy("mid").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    met = many.join(least.hint("merge"), "mid").select(F.col("fp").alias("a"), "b").where("a <> b")
    return uses(few.unionByName(met).distinct(), keyed)


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``doc_id``, ``fp``, ``component_id``) for each row; the component is named by its smallest id."""
    out = _found(docs, id_col, text_col)
    return uses(out.select("doc_id", F.col("node").alias("fp"), "component_id"), *out._tamarack_uses)


def _found(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(``doc_id``, ``node``, ``root``, ``component_id``) for each row; its node is its fingerprint."""
    fps = materialize(fingerprints(docs, id_col, text_col).withColumnRenamed("fp", "node"))
    nodes = materialize(fps.groupBy("node").agg(F.min("doc_id").alias("first")))
    linked = materialize(links(nodes.select(F.col("node").alias("fp"))))
    roots = graph.components(linked)
    discard(linked)
    return uses(graph.named(fps, nodes, roots), fps, nodes, *roots._tamarack_uses)


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component: of rows with an id one with the smallest, else one without.

    Rows of one component that share that id are told apart by fingerprint; of those alike in both one stays.
    """
    found = _found(docs, id_col, text_col)
    told = materialize(found.select("doc_id", "node", "root"))
    discard(*found._tamarack_uses)
    marked = fingerprints(docs, id_col, text_col, keep=True)
    return uses(graph.first_of_each(marked, told, F.col("fp"), "doc_id").select("row.*"), told)
