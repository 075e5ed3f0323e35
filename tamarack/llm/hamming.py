"""Exact top-k search over binary codes by incremental multi-index hashing.

A 64-bit code is cut into m segments, about log2(number of codes / 4) bits each, and every segment is an index
of its own.  Search radii grow in shells: shell t looks up, in each segment, all values exactly t bits from
the query's.  After shell t every code within m * (t + 1) - 1 bits has been met, because a code farther than
t in each of m segments is at least m * (t + 1) away.  Each code met is verified by its whole distance, and a
query is done when its k-th verified distance is within what is covered; only the others go on.

Lookups of a shell are joined with the index like any two tables, so no shell needs another way: with segments of log2(n / 4)
bits a lookup meets about four codes, and the last shell, whose radius is a whole segment, meets every code.  How many
shells a query takes follows from how far its k-th neighbour is; on random codes that is far and wide shells meet much of
a small table, on codes of alike vectors the first shells are enough.

Codes are indexed once however many rows share them, with the ``k + 1`` smallest ids of each (enough for k
neighbours other than the query itself), so a vector that a third of all rows repeat is one entry.  Equal
query codes are searched once.

Defined results: neighbours are ordered by distance, then id; a row is not its own neighbour; rows that repeat
an id and code count once; null vectors are neither queries nor neighbours; null, NaN and negative elements
and zero give bit 0; a query in a table of fewer than k other rows gets them all; an empty table gives none.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarack.llm.common import discard, materialize

BITS, K = 64, 10


def sign_code(vector: Column) -> Column:
    """The signs of up to 64 elements as one long; null for a null vector, an error for a longer one."""
    bit = lambda x, i: F.when((x > 0) & ~F.isnan(x), F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))
    signs = F.aggregate(F.transform(vector, bit), F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))
    return F.when(F.size(vector) > BITS, F.raise_error(F.lit(f"a code has {BITS} bits at most"))).otherwise(signs)


def _cuts(n_codes: int) -> list[tuple[int, int]]:
    """(first bit, bits) of each segment: about four codes to a value, as a lookup costs as much as a few candidates."""
    width = min(24, max(4, round(math.log2(max(2, n_codes) / 4))))
    m = -(-BITS // width)
    edges = [BITS * j // m for j in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _part(code: Column, cut: tuple[int, int]) -> Column:
    return F.shiftrightunsigned(code, cut[0]).bitwiseAND(F.lit((1 << cut[1]) - 1))


def _met(open_: DataFrame, index: DataFrame, cuts: list[tuple[int, int]], t: int) -> DataFrame:
    """(``q``, ``c``, ``d``) of codes that shell ``t`` meets and no earlier one did, each once."""

    def keys(name: str, j: int, masks) -> Column:
        around = F.split(F.lit(",".join(map(str, masks(cuts[j][1])))), ",").cast("array<bigint>")  # folded to one literal
        return F.transform(around, lambda x: _part(F.col(name), cuts[j]).bitwiseXOR(x) + F.lit(j << 32))

    def keyed(rows: DataFrame, name: str, masks) -> DataFrame:
        return rows.select(name, F.explode(F.concat(*[keys(name, j, masks) for j in range(len(cuts))])).alias("key"))

    shell = lambda n: [sum(1 << b for b in bs) for bs in combinations(range(n), t)]
    # lookups are many times the rows they come from, so the planner's guess at their size must not make it broadcast them
    pairs = keyed(open_, "q", shell).hint("merge").join(keyed(index.select("c"), "c", lambda n: [0]), "key")
    away = [F.bit_count(_part(F.col("q").bitwiseXOR(F.col("c")), cut)) for cut in cuts]
    seg = F.shiftright("key", 32)
    # met in the first segment at distance t, if no segment is nearer
    fresh = F.least(*away) == t
    first = F.coalesce(*[F.when(x == t, F.lit(j)) for j, x in enumerate(away)])
    return pairs.where(fresh & (first == seg)).select("q", "c", F.bit_count(F.col("q").bitwiseXOR(F.col("c"))).alias("d"))


def top_k(rows: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """The ``k`` nearest rows of each query: ``query_id``, ``rank`` (from 1), ``neighbor_id``, ``distance``.

    ``rows`` and ``queries`` have ``id`` and ``code`` (long).
    """
    rows, queries = (x.where("code is not null").select("id", "code").distinct() for x in (rows, queries))
    first = rows.withColumn("r", F.row_number().over(Window.partitionBy("code").orderBy("id"))).where(F.col("r") <= k + 1)
    index = materialize(first.groupBy(F.col("code").alias("c")).agg(F.sort_array(F.collect_list("id")).alias("ids")))
    n_codes = index.count()
    cuts = _cuts(n_codes)
    open_ = materialize(queries.select(F.col("code").alias("q")).distinct())
    by_near = Window.partitionBy("q").orderBy("d", F.get("ids", F.lit(0)), "c")
    best: DataFrame | None = None
    t = 0
    while t <= max(n for _, n in cuts) and not open_.isEmpty():
        met = _met(open_, index, cuts, t).hint("merge").join(index, "c").select("q", "c", "d", "ids")
        if best is not None:
            met = met.unionByName(best)
        near = materialize(met.withColumn("r", F.row_number().over(by_near)).where(F.col("r") <= k + 1).drop("r"))
        if best is not None:
            discard(best)
        best = near
        covered = len(cuts) * (t + 1) - 1
        have = best.withColumn("n", F.sum(F.size("ids")).over(by_near.rowsBetween(Window.unboundedPreceding, 0)))
        done = have.where((F.col("n") > k) & (F.col("d") <= covered)).select("q").distinct()
        still = materialize(open_.join(done, "q", "left_anti"))
        discard(open_)
        open_, t = still, t + 1
    if best is None:
        best = index.select(F.col("c").alias("q"), "c", F.lit(0).alias("d"), "ids").limit(0)
    found = queries.select(F.col("id").alias("query_id"), F.col("code").alias("q")).join(best, "q")
    found = found.select("query_id", F.explode("ids").alias("neighbor_id"), F.col("d").cast("long").alias("distance")).where("neighbor_id is not null and not neighbor_id <=> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "neighbor_id"))
    return found.withColumn("rank", rank.cast("long")).where(F.col("rank") <= k).select("query_id", "rank", "neighbor_id", "distance")
