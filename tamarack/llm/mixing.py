"""Mixing sources to target weights by weighted fair queueing (DataFrame operations only).

Documents of each source stand in a queue in shuffled order (a hash of id and text).  A serving's virtual finish
time is the number of words its source has served up to and including it, divided by the source's target.  When
a queue runs out before its target it is served again, ``cap`` rounds at most.  The mix is the global order by
finish time, cut where the running total of words reaches the budget: a serving is taken, whole, if the servings
before it are fewer words than the budget.  Each source then ends within one document of its target.

Two passes.  The first works on (source, hash, id, size) only: the place in a queue is a prefix sum over hash ranges
of the source (a small table of sums for each range, then a running sum inside it), so a source with a third of all
rows is spread over as many tasks as it has ranges; the place of the cut is found from sums over ``SLICES`` slices of
finish time and a running total inside one slice.  The second numbers the rows with their texts in the same way,
drops what lies behind the cut and range-sorts the rest by finish time.

Sources are ranked by range partitions and counts before them, and the level that shares the budget is found by
repeated sums, so no task holds all sources.

Defined results: null text counts as no words; a document without words has nothing to serve and is not in the mix
(``taken`` 0); a null source is a source of its own and sorts last; null ids are allowed; repeated rows are separate
documents, and those that are alike in all are taken or left together; an empty table gives an empty mix; other
columns stay, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarack.llm.common import discard, materialize, n_partitions, words

WEIGHTS = (3.0, 1.0, 2.0)
BUDGET = 1.5
CAP = 2
#: Slices of finish time whose sums reach the driver: this many up to time 1 and as many beyond.
SLICES = 4096
#: Bits of the shuffling hash.
BITS = 60
_ORDER = ("finish", "h", "id", "src", "round")


def queued(docs: DataFrame, keep: list[str], id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """For each document ``row`` (a struct of the columns in ``keep``), ``id``, ``size`` in words, the hash ``h``
    that shuffles, and ``src``, a source key that is never null."""
    text, source = F.col(f"`{text_col}`"), F.col(f"`{source_col}`")
    told = F.md5(F.concat_ws(":", F.col(f"`{id_col}`").cast("string"), text))
    return docs.select(
        *([F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")] if keep else []),
        F.col(f"`{id_col}`").cast("string").alias("id"),
        F.size(words(text)).cast("long").alias("size"),
        F.conv(F.substring(told, 1, BITS // 4), 16, 10).cast("long").alias("h"),
        F.coalesce(F.concat(F.lit("1"), source), F.lit("2")).alias("src"),
    )


def _with_range(rows: DataFrame) -> DataFrame:
    bits = min(16, max(6, (4 * n_partitions(rows.sparkSession)).bit_length()))
    return rows.withColumn("range", F.shiftright("h", BITS - bits).cast("int"))


def targets(per: DataFrame, weights=WEIGHTS, budget: float = BUDGET, cap: int = CAP) -> DataFrame:
    """(``src``, ``source_size``, ``target``) from (``src``, ``source_size``), a row for each source.

    ``weights`` are dealt to the sources in the order of their names, again and again.  The budget is shared by
    weight; a target above ``cap`` times its source's size stops there and the rest is shared again, until none is.
    """
    # rank by name: the place within a range of names, and the sources in the ranges before
    dealt = materialize(per.repartitionByRange(n_partitions(per.sparkSession), "src").withColumn("part", F.spark_partition_id()))
    ahead = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ahead = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", ahead.alias("ahead"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy("src")) - 1 + F.col("ahead")
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = materialize(dealt.join(F.broadcast(ahead), "part").select("src", "source_size", weight.alias("w"), (F.col("source_size") * float(cap)).alias("most")))
    discard(dealt)
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, F.lit(False)
    n_full = -1
    while True:
        s = ranked.agg(F.sum(F.when(full, 1).otherwise(0)).alias("n"), F.sum(F.when(full, F.col("most")).otherwise(0.0)).alias("most"), F.sum(F.when(full, 0.0).otherwise(F.col("w"))).alias("w")).first()
        if s.n == n_full or not s.w:
            break
        n_full, level = s.n, (total * budget - s.most) / s.w
        full = F.col("most") / F.col("w") <= level
    return ranked.select("src", "source_size", F.when(full, F.col("most")).otherwise(F.lit(level) * F.col("w")).alias("target"))


def servings(rows: DataFrame, plan: DataFrame, cap: int = CAP) -> DataFrame:
    """``rows`` (from :func:`queued`) with ``source_size``, ``target`` and ``served``, an array of the servings that begin
    before their source has its target: finish time, and what settles ties."""
    inside = Window.partitionBy("src", "range").orderBy("h", "id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = _with_range(rows).join(plan, ["src", "range"])
    out = out.withColumn("before", F.col("ahead") + F.sum("size").over(inside) - F.col("size"))
    start = [F.col("before") + k * F.col("source_size") for k in range(cap)]
    each = [F.when((s < F.col("target")) & (F.col("size") > 0), F.struct(((s + F.col("size")) / F.col("target")).alias("finish"), "h", "id", "src", F.lit(k).alias("round"))) for k, s in enumerate(start)]
    return out.withColumn("served", F.filter(F.array(*each), lambda x: x.isNotNull())).drop("before", "ahead", "range")


def _key(values) -> Column:
    kinds = ("double", "long", "string", "string", "int")
    return F.struct(*[F.lit(v).cast(k).alias(c) for v, k, c in zip(values, kinds, _ORDER)])


def plan(small: DataFrame, weights=WEIGHTS, budget: float = BUDGET, cap: int = CAP) -> tuple[DataFrame, Column | None]:
    """From the queues without their texts: what each hash range of a source needs to number its rows, and the last
    serving before the budget is used up (null: all are)."""
    stats = materialize(_with_range(small).groupBy("src", "range").agg(F.sum("size").alias("n")))
    goals = targets(stats.groupBy("src").agg(F.sum("n").alias("source_size")), weights, budget, cap)
    upto = Window.partitionBy("src").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ahead = stats.select("src", "range", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("ahead"))
    told = materialize(ahead.join(goals, "src"))
    total = (stats.agg(F.sum("n")).first()[0] or 0) * budget
    discard(stats)
    every = servings(small, told, cap).select("size", F.explode("served").alias("s")).select("size", *[F.col("s")[c].alias(c) for c in _ORDER])
    every = materialize(every.withColumn("slice", F.least(F.floor(F.col("finish") * SLICES), F.lit(2 * SLICES)).cast("int")))
    before, cut = 0, None
    for r in sorted(every.groupBy("slice").agg(F.sum("size").alias("n")).collect()):
        if before + r.n >= total:
            cut = r.slice
            break
        before += r.n
    last = None
    if cut is not None:
        run = F.sum("size").over(Window.partitionBy("slice").orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, -1))
        kept = every.where(F.col("slice") == cut).withColumn("run", F.coalesce(run, F.lit(0)) + before).where(F.col("run") < total)
        found = kept.agg(F.max(F.struct(*_ORDER)).alias("last")).first().last
        last = _key(found) if found else None
    discard(every)
    return told, last


def scheduled(rows: DataFrame, told: DataFrame, last: Column | None, cap: int = CAP) -> DataFrame:
    """``rows`` with ``served`` cut to the servings in the mix."""
    out = servings(rows, told, cap)
    return out if last is None else out.withColumn("served", F.filter("served", lambda s: s <= last))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, budget: float = BUDGET, cap: int = CAP) -> DataFrame:
    """The mixed corpus: a row of ``docs`` for each serving in the mix, in the order of finish times.

    The order is global over the partitions of the result (range partitions, sorted inside).
    """
    small = materialize(queued(docs, [], id_col, text_col, source_col))
    told, last = plan(small, weights, budget, cap)
    discard(small)
    rows = scheduled(queued(docs, docs.columns, id_col, text_col, source_col), told, last, cap).select("row", F.explode("served").alias("s"))
    order = [F.col("s")[c] for c in _ORDER]
    return rows.repartitionByRange(n_partitions(docs.sparkSession), *order).sortWithinPartitions(*order).select("row.*")
