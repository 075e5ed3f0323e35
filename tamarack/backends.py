"""Boundaries to what Spark can't do: rasterising PDFs, reading page images, asking a language model.

Each back end is a factory that the caller hands in; it is called once for each task, so clients and models
live in the Python workers, never in the plan.  Answers come back as columns, and a row that fails carries
its error and goes on.  What is paid for, pages read and answers given, goes through :mod:`tamarack.answers`.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.answers import SLOTS, answered
from tamarack.tables import materialize, ship, uses

MAX_TEXT, TRIES = 15_000, 3
#: What in an error's text makes a call worth another try.
RETRYABLE = ("429", "500", "503", "rate", "quota")


class Rasterizer(Protocol):
    """Pages of a PDF, as PNG bytes in order."""

    def pages(self, pdf: bytes, dpi: int) -> list[bytes]: ...


class PageReader(Protocol):
    """The text on a page image."""

    def read(self, png: bytes) -> str: ...


class Model(Protocol):
    """The answer, as JSON text, to a prompt about a document."""

    def answer(self, text: str) -> str: ...


def retried(call: Callable[[], str], tries: int = TRIES, wait: Callable[[float], None] = time.sleep) -> str:
    """``call()``, again after 2, 4 ... seconds while it fails with an error that may pass."""
    for k in range(tries):
        try:
            return call()
        except Exception as e:
            if k + 1 == tries or not any(x in str(e).lower() for x in RETRYABLE):
                raise
            wait(2.0 ** (k + 1))
    raise AssertionError("unreachable")


def _over(df: DataFrame, source: str, keep: list[str], out: str, schema: str, factory: Callable[[], object], use: Callable[[object, object], list]) -> DataFrame:
    """``keep`` columns, ``out`` rows of ``use(back end, value)`` and ``error`` for each row of ``df``."""
    kinds = dict(df.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        backend = factory()
        for b in batches:
            rows = []
            for r in b.to_dict("records"):
                base = {c: r[c] for c in keep}
                try:
                    rows += [base | x | {"error": None} for x in use(backend, r[source])]
                except Exception as e:  # one bad row must not stop the others
                    rows.append(base | {"error": f"{type(e).__name__}: {e}"})
            yield pd.DataFrame({c: pd.Series([x.get(c) for x in rows], dtype=object) for c in [*keep, *out.split(","), "error"]})

    ship(df.sparkSession)
    head = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    return df.select(*keep, source).mapInPandas(run, f"{head}, {schema}, error string")


def rasterize(pdfs: DataFrame, factory: Callable[[], Rasterizer], dpi: int = 300) -> DataFrame:
    """A row for each page of each PDF (``source_file``, ``filename``, ``page``, ``png``, ``error``)."""
    use = lambda b, pdf: [{"page": k, "png": p} for k, p in enumerate(b.pages(bytes(pdf), dpi), 1)]
    return _over(pdfs, "content", ["source_file", "filename"], "page,png", "page int, png binary", factory, use)


def read_pages(pages: DataFrame, factory: Callable[[], PageReader], wait: Callable[[float], None] = time.sleep, name: str = "reader", store: str | None = None, slots: int = SLOTS) -> DataFrame:
    """``pages`` read: (``source_file``, ``filename``, ``page``, ``page_text``, ``error``).

    Pages are written first, so that each PDF is rasterised once, and equal images are read once; texts are kept in
    ``store``, see :mod:`tamarack.answers`.
    """
    pages = materialize(pages.withColumnRenamed("error", "_page_error"))
    read = answered(pages.where("_page_error is null"), "png", factory, lambda b, png: retried(lambda: b.read(bytes(png)), wait=wait), name, store, slots)
    columns = ("source_file", "filename", "page")
    bad = pages.where("_page_error is not null").select(*columns, F.lit(None).cast("string").alias("page_text"), F.col("_page_error").alias("error"))
    return uses(read.select(*columns, F.col("answer").alias("page_text"), "error").unionByName(bad), pages)


def page_mark(n: Column) -> Column:
    return F.concat(F.lit("\n\n\n=== PAGE "), n.cast("string"), F.lit(" ===\n\n\n"))


def join_pages(read: DataFrame) -> DataFrame:
    """One text for each document: pages in order, each after a marker unless it is the only one."""
    docs = read.groupBy("source_file", "filename").agg(F.array_sort(F.collect_list(F.struct("page", "page_text"))).alias("ps"), F.max("error").alias("error"))
    marked = F.array_join(F.transform("ps", lambda p: F.concat(page_mark(p["page"]), p["page_text"])), "")
    return docs.select("source_file", "filename", F.when(F.size("ps") == 1, F.get("ps", F.lit(0))["page_text"]).otherwise(marked).alias("text"), "error")


def ask(df: DataFrame, factory: Callable[[], Model], key: str, text_col: str = "cleaned_text", out: str = "model", chars: int = MAX_TEXT, wait: Callable[[float], None] = time.sleep, name: str = "model", store: str | None = None, slots: int = SLOTS) -> DataFrame:
    """``key`` and ``out``, a model's answer to the first ``chars`` characters of each text; null where it failed.

    Equal texts are asked about once; answers are kept in ``store``, see :mod:`tamarack.answers`.
    """
    cut = materialize(df.select(key, F.substring(text_col, 1, chars).alias("_text")))
    told = answered(cut, "_text", factory, lambda b, text: retried(lambda: b.answer(text or ""), wait=wait), name, store, slots)
    return uses(told.withColumnRenamed("answer", out), cut)
