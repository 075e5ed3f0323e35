"""Plans that call out: PDFs through rasterising and OCR, and texts through a language model.

Calls run on the executors, one back end for each task.  Rows are dealt out anew before the calls, as a page or
a model's answer costs far more than moving its row, and what fails carries its error and goes on.  Paid answers are
asked once for equal contents and kept as they come, see :mod:`tamarack.answers`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack import backends
from tamarack.answers import SLOTS
from tamarack.operators.reclassify import MAX_CHARS, needs_reclassification
from tamarack.plans.extraction import cleaned, extract_cleaned, extract_documents
from tamarack.tables import materialize, uses


def process_pdfs(
    pdfs: DataFrame, rasterizer: Callable[[], backends.Rasterizer], reader: Callable[[], backends.PageReader], dpi: int = 300, name: str = "hosted", as_of: Column | None = None,
    store: str | None = None, slots: int = SLOTS,
) -> DataFrame:
    """Records of PDFs (``content``, ``source_file``, ``filename``); ``error`` says why a file or page could not be read.

    Pages are made once and equal ones read once; ``store`` keeps their texts for later runs.
    """
    pages = backends.rasterize(pdfs.repartition("source_file"), rasterizer, dpi)
    read = backends.read_pages(pages, reader, name=name, store=store, slots=slots)
    out = extract_documents(backends.join_pages(read), as_of=as_of).withColumn("ocr_backend", F.lit(name))
    return uses(out, *read._tamarack_uses)


def extract_with_model(
    df: DataFrame, key: str, model: Callable[[], backends.Model], second: Callable[[], backends.Model] | None = None, as_of: Column | None = None, do_clean: bool = True,
    name: str = "model", store: str | None = None, slots: int = SLOTS,
) -> DataFrame:
    """Records of (``key``, ``filename``, ``text``) merged with a model's answers; ``key`` is unique.

    Texts are cleaned once and written.  ``second`` is asked only about rows whose outcome is vague after the merge; only
    those are extracted again.  ``store`` keeps answers by ``name`` and what was shown, for this run's retries and for
    later runs; ``slots`` calls are under way at most.
    """
    shown = materialize(cleaned(df, do_clean))
    answers = materialize(backends.ask(shown, model, key, name=name, store=store, slots=slots).select(key, "model"))
    rows = shown.join(answers, key, "left")

    def told(some: DataFrame, *columns: str) -> DataFrame:
        out = extract_cleaned(some, *columns, as_of=as_of).drop(*columns)
        return out if do_clean else out.withColumn("cleaned_text", F.lit(None).cast("string"))

    out = told(rows, "model")
    if second is None:
        return uses(out, shown, answers)
    out = materialize(out)
    vague = out.where(needs_reclassification(F.col("outcome_type"))).select(key, "case_number").join(shown.select(key, "cleaned_text"), key)
    text = F.concat(F.lit("Case: "), F.coalesce("case_number", F.lit("unknown")), F.lit("\n\nDocument text:\n"), F.substring("cleaned_text", 1, MAX_CHARS))
    asked = vague.select(key, text.alias("cleaned_text"))
    more = materialize(backends.ask(asked, second, key, out="answer", chars=2 * MAX_CHARS, name=f"{name} again", store=store, slots=slots).select(key, "answer"))
    again = told(rows.join(more, key), "model", "answer")
    return uses(out.join(more, key, "left_anti").select(again.columns).unionByName(again), shown, answers, out, more)
