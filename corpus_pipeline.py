"""The corpus pipeline: quality rules, line dedup, near-dedup, source mixing and byte-level BPE encoding.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns the columns of
``documents``; the last returns the encoded corpus.  Between stages the rows are written as Parquet.

Every stage passes null ids, languages and sources through, treats repeated rows as documents of their own unless it says
otherwise, keeps columns it doesn't know, and gives no rows for no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.llm import bpe, lines, mixing, nearcopies, quality
from tamarack.llm.common import discard, materialize, read, uses

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; a null or empty text has too few words and goes; equal texts share a fate."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that too many documents of a source share go; documents stay, if need be with an empty text; a null text
    stays null, and documents without a source are a source of their own."""
    out = lines.drop_boilerplate(docs)
    told = out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
    return uses(told, *out._tamarack_uses)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more) stays: the one with the
    smallest id, or one without an id if none has any; of rows alike in id and text the first in the order of all columns.
    Null and empty texts are copies of each other; a text of fewer than five words is one shingle."""
    return nearcopies.drop_near_copies(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix takes a document, in the order of the mix; documents without words are not in it, those
    without a source are a source of their own, and rows alike in all are taken or left together."""
    return mixing.mix(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row's tokens: ``doc_id``, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit integers) and the
    hash of the decoded bytes; a null text has no tokens."""
    import public_tokenizers

    with open(public_tokenizers.path(VOCABULARY), "rb") as f:
        content = f.read()

    def each(coder: bpe.Bpe, ids: list[bytes]) -> list[list]:
        return [[len(x) // 4 for x in ids], ids, bpe.sha256(coder.decode_all(ids))]

    return bpe.over_texts(docs, content, public_tokenizers.PATTERN, each, "n_tokens long, ids binary, decoded_sha256 string")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("source_mixing", source_mixing),
    ("byte_bpe", byte_bpe),
]

#: Near copies, components, the estimated posterior and tokens are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        kept = materialize(stage(spark, docs, sf_dir))
        discard(docs)
        docs = kept
    return uses(STAGES[-1][1](spark, docs, sf_dir), docs)
