"""Sinks: nested JSON records, wide CSV and JSON rows, errors, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.operators.flatten import flatten

#: Columns of a record, in order, without the raw text.
RECORD = (
    "case_number", "agreement_signed_date", "filename", "plaintiff", "defendant", "payment_schedule", "total_payment_sum", "outcome_type", "outcome_details", "mandatory_vacate_date",
    "third_party_acceptance", "assistance_deadline", "additional_agreement_terms", "sealing_reference_stipulation", "enforcement_period", "extraction_method",
    "confidence_score", "confidence_label", "confidence_details",
)


def records(df: DataFrame) -> DataFrame:
    """Each row's record as JSON text, nulls included."""
    return df.select(F.to_json(F.struct(*RECORD), {"ignoreNullFields": "false", "pretty": "true"}).alias("value"))


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.select(*RECORD).write.mode(mode).option("ignoreNullFields", False).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Wide rows with a header; ``mode="append"`` adds to an earlier run's."""
    extra = ("source_file",) if "source_file" in df.columns else ()
    flatten(df, extra=extra).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_flat_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    flatten(df).write.mode(mode).option("ignoreNullFields", False).json(path)


def failures(df: DataFrame) -> DataFrame:
    """(``file``, ``error``) of rows that could not be read (column ``error``)."""
    return df.where("error is not null").select(F.col("source_file").alias("file"), "error")


def summary(df: DataFrame, skipped: int = 0) -> DataFrame:
    """``ok``, ``failed``, ``skipped`` and ``total``."""
    bad = F.col("error").isNotNull() if "error" in df.columns else F.lit(False)
    return df.agg(F.count_if(~bad).alias("ok"), F.count_if(bad).alias("failed"), F.lit(skipped).cast("long").alias("skipped"), (F.count(F.lit(1)) + skipped).alias("total"))
