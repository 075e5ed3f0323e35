"""Answers that cost money: asked once for equal contents, and kept from the moment they are given.

A store is a folder of Parquet files (``ask``, ``answer``, ``error``), keyed by a hash of the asked model's name and what
it is shown.  What the store doesn't know yet is asked in waves of ``slots`` tasks, so no more than ``slots`` calls are
under way, each task asking about ``each`` of the wave's contents.  Waves follow the order of the rows and are cut by
number, so none is larger.  A task's answers are moved into the store when it ends, not when the job does (the committer's
second algorithm), so a run that dies loses what its unfinished tasks have asked, at most ``slots * each`` answers, and a
run after it asks nothing that is in the store.  An executor that is lost asks its own task's contents again.  Rows that
failed are kept with their error, for this run to tell, and are asked again by the next one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamarack.tables import discard, exists, materialize, shared_dir, ship, temporary, uses

SLOTS, EACH, MOST_WAVES = 32, 8, 10_000
KIND = "ask string, answer string, error string"


def known(spark: SparkSession, store: str) -> DataFrame:
    """(``ask``, ``answer``, ``error``) of a store, a row for each ``ask``; ``error`` is null where there is an answer."""
    rows = spark.read.schema(KIND).parquet(store) if exists(spark, store) else spark.createDataFrame([], KIND)
    good = F.col("error").isNull()
    # a task that ran twice left two answers: the lesser, so that reruns agree
    out = rows.groupBy("ask").agg(F.min(F.when(good, F.col("answer"))).alias("answer"), F.max(F.when(~good, F.col("error"))).alias("error"), F.bool_or(good).alias("good"))
    return out.select("ask", "answer", F.when(~F.col("good"), F.col("error")).alias("error"))


def _wave(rows: DataFrame, shown: str, factory: Callable[[], object], use: Callable[[object, object], str]) -> DataFrame:
    """(``ask``, ``answer``, ``error``) of each row's ``shown``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        backend = None
        for b in batches:
            out = []
            backend = factory() if backend is None and len(b) else backend
            for ask, content in zip(b["ask"], b[shown]):
                try:
                    out.append((ask, use(backend, content), None))
                except Exception as e:  # one bad row must not stop the others
                    out.append((ask, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["ask", "answer", "error"], dtype=object)

    return rows.select("ask", shown).mapInPandas(run, KIND)


def _numbered(pending: DataFrame) -> DataFrame:
    """``pending`` with ``number``, from 0 without gaps, by ``at``, a :func:`monotonically_increasing_id` that was written."""
    part = F.shiftright("at", 33).alias("part")
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over a row for each task that wrote
    counts = pending.groupBy(part).count().select("part", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("ahead"))
    inside = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return pending.withColumn("part", part).join(F.broadcast(counts), "part").withColumn("number", F.col("ahead") + inside).drop("part", "ahead")


def answered(rows: DataFrame, shown: str, factory: Callable[[], object], use: Callable[[object, object], str], name: str, store: str | None = None, slots: int = SLOTS, each: int = EACH) -> DataFrame:
    """``rows`` without ``shown`` (a string or binary column, null: nothing) but with ``answer`` and ``error``.

    ``factory`` makes a back end, once in a task, and ``use(back end, content)`` is its answer.  ``name`` tells models and
    prompts apart that share a ``store``; without a store, answers last as long as the driver.  ``rows`` is read more than
    once, so it should be a written table.
    """
    spark = rows.sparkSession
    ship(spark)
    store = store or temporary(spark, f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}")
    content = F.coalesce(F.col(shown).cast("binary"), F.lit(b""))
    keyed = rows.withColumn("ask", F.sha2(F.concat(F.encode(F.lit(name + "\0"), "UTF-8"), content), 256))
    seen = keyed.select("ask", shown, F.monotonically_increasing_id().alias("row"))
    unique = seen.groupBy("ask").agg(F.first(shown).alias(shown), F.min("row").alias("row"))
    have = known(spark, store).where("error is null").select("ask")
    pending = materialize(unique.join(have, "ask", "left_anti").sort("row").withColumn("at", F.monotonically_increasing_id()))
    n = pending.count()
    each = max(each, -(-n // (slots * MOST_WAVES)))
    waves = -(-n // (slots * each))
    if waves:
        dealt = _numbered(pending).withColumn("wave", F.expr(f"number div {slots * each}").cast("int"))
        dealt = materialize(dealt.repartition("wave"), partition_by="wave") if waves > 1 else dealt
        for k in range(waves):
            asked = _wave(dealt.where(F.col("wave") == k).repartition(slots), shown, factory, use)
            asked.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(store)
        if waves > 1:
            discard(dealt)
    discard(pending)
    told = keyed.drop(shown).join(known(spark, store), "ask", "left").drop("ask")
    return uses(told, *getattr(rows, "_tamarack_uses", ()))
