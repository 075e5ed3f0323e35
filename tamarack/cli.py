"""Command line: extract a file, a folder of texts or PDFs, or a folder as it grows.

Settings come from the environment, see ``tamarack.config``: with a key, an address and a name of a model it is asked
too, unless ``--regex-only`` is given.  PDFs are rasterised by pdf2image and read by the back end of the settings, or by
back ends named ``module:factory``, see ``tamarack.backends``.
"""

from __future__ import annotations

import argparse
import hashlib
import importlib
import logging
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack import adapters
from tamarack.answers import SLOTS
from tamarack.config import Settings
from tamarack.plans.extraction import extract_documents
from tamarack.plans.services import extract_with_model, process_pdfs
from tamarack.session import session
from tamarack.sources.files import read_pdfs, read_texts
from tamarack.sources.runs import PER_BATCH, Output, run
from tamarack.sources.sinks import failures, records, write_json
from tamarack.streaming.ingest import run_incremental
from tamarack.tables import materialize

log = logging.getLogger("tamarack")


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tamarack", description=__doc__)
    p.add_argument("-v", "--verbose", action="store_true")
    sub = p.add_subparsers(dest="command", required=True)
    one = sub.add_parser("extract", help="one text file, as a JSON record")
    one.add_argument("path")
    one.add_argument("-o", "--output")
    many = sub.add_parser("extract-dir", help="all text files of a folder, as wide rows")
    many.add_argument("path")
    many.add_argument("-o", "--output", required=True)
    many.add_argument("--format", choices=("csv", "json"), default="csv")
    for texts in (one, many):
        texts.add_argument("--regex-only", action="store_true", help="ask no model")
        texts.add_argument("--no-clean", action="store_true", help="take texts as they are")
    pdf = sub.add_parser("process", help="one PDF, as a JSON record")
    pdf.add_argument("path")
    pdf.add_argument("-o", "--output")
    pdfs = sub.add_parser("process-dir", help="all PDFs of a folder, as wide rows")
    pdfs.add_argument("path")
    pdfs.add_argument("-o", "--output", required=True)
    for x in (pdf, pdfs):
        x.add_argument("--rasterizer")
        x.add_argument("--reader")
        x.add_argument("--dpi", type=int)
    for x in (many, pdfs):
        x.add_argument("--resume", action="store_true", help="skip files whose rows are in the output")
        x.add_argument("--per-batch", type=int, default=PER_BATCH, help="files whose rows are committed together")
    for x in (one, many, pdf, pdfs):
        x.add_argument("--answers", help="folder that keeps paid answers for later runs; for folders OUTPUT.answers")
        x.add_argument("--slots", type=int, default=SLOTS, help="calls under way at a time")
    grow = sub.add_parser("ingest", help="text files that are new since the last run")
    grow.add_argument("folder")
    grow.add_argument("-o", "--output", required=True)
    grow.add_argument("--checkpoint", required=True)
    return p


def _factory(name: str):
    module, _, attr = name.partition(":")
    return getattr(importlib.import_module(module), attr)


def _store(args: argparse.Namespace) -> str | None:
    """Where paid answers are kept: of a folder's run beside its output, so that a run which died asks nothing twice."""
    return args.answers or (args.output.rstrip("/") + ".answers" if args.command.endswith("-dir") else None)


def _named(*what: object) -> str:
    """A name for a model with its prompts and settings: others get answers of their own."""
    return hashlib.sha256("\0".join(map(str, what)).encode()).hexdigest()


def _extracted(files: DataFrame, args: argparse.Namespace, settings: Settings) -> DataFrame:
    """Records of texts, with a model's answers where the settings have one and it is wanted."""
    if args.regex_only or not settings.calls_model():
        return extract_documents(files, do_clean=not args.no_clean)
    name = _named(settings.llm_base_url, settings.llm_model, settings.llm_temperature, adapters.MODEL_ROLE, adapters.MODEL_PROMPT, adapters.SECOND_ROLE)
    return extract_with_model(
        files, "source_file", lambda: adapters.ChatModel(settings), lambda: adapters.SecondOpinion(settings), do_clean=not args.no_clean, name=name, store=_store(args), slots=args.slots)


def _read(pdfs: DataFrame, args: argparse.Namespace, settings: Settings) -> DataFrame:
    """Records of PDFs, written before they are used, so that no page is read twice."""
    rasterizer = _factory(args.rasterizer) if args.rasterizer else adapters.PdfPages
    reader = _factory(args.reader) if args.reader else adapters.reader(settings)
    store = _store(args)
    kind = args.reader or _named(settings.ocr_backend, settings.for_ocr()[1:], settings.ocr_model_path, adapters.PAGE_PROMPT)
    out = process_pdfs(pdfs, rasterizer, reader, args.dpi or settings.pdf_dpi, kind, store=store, slots=args.slots)
    return materialize(out.withColumn("ocr_backend", F.lit(args.reader or settings.ocr_backend)))


def _one(out: DataFrame, path: str | None) -> None:
    if path:
        write_json(out, path, "overwrite")
    else:
        print(records(out).first()["value"])


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    logging.basicConfig(level=logging.DEBUG if args.verbose else logging.INFO, format="%(levelname)s %(message)s")
    spark, settings = session(), Settings.from_env()
    try:
        if args.command == "extract":
            _one(_extracted(read_texts(spark, args.path, glob=""), args, settings), args.output)
        elif args.command == "process":
            out = _read(read_pdfs(spark, args.path, "*"), args, settings)
            bad = failures(out).first()
            if bad:
                raise RuntimeError(f"{bad.file}: {bad.error}")
            _one(out, args.output)
        elif args.command == "ingest":
            run_incremental(spark, args.folder, args.output, args.checkpoint)
        else:
            texts = args.command == "extract-dir"
            out = Output(spark, args.output, args.format if texts else "csv")
            read = (lambda paths: read_texts(spark, paths, glob="")) if texts else (lambda paths: read_pdfs(spark, paths, "*"))
            extract = (lambda files: _extracted(files, args, settings)) if texts else (lambda files: _read(files, args, settings))
            told = run(spark, args.path, "*.txt" if texts else "*.pdf", out, read, extract, args.resume, args.per_batch)
            log.info("%s", told)
    except Exception:
        log.exception("failed")
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
