"""Second opinions on vague outcomes, from a model's JSON answer in a column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.functions.regex import sub

#: Outcomes that are vague, and those an answer may give.
VAGUE = ("Unknown", "Agreed Entry", "Agreed Judgment", "Settlement")
VALID = ("Pay and Stay", "Pay and Vacate", "Pay or Vacate", "Vacate Only")
ANSWER = "outcome_type string, confidence string, reasoning string"
MAX_CHARS = 8000


def needs_reclassification(outcome: Column) -> Column:
    return outcome.isNull() | outcome.isin(*VAGUE)


def bare_json(answer: Column) -> Column:
    """An answer without the fence that models put around code."""
    return sub(sub(answer, r"\A\s*```(?:json)?\s*"), r"\s*```\s*\z")


def apply_answers(df: DataFrame, answer_col: str) -> DataFrame:
    """``df`` with vague outcomes replaced where the answer is one of the four; others stay as they are."""
    out = df.withColumn("_a", F.from_json(bare_json(F.col(answer_col)), ANSWER))
    use = F.coalesce(needs_reclassification(F.col("outcome_type")) & F.col("_a.outcome_type").isin(*VALID), F.lit(False))
    return out.withColumns({
        "outcome_type": F.when(use, F.col("_a.outcome_type")).otherwise(F.col("outcome_type")),
        "outcome_details": F.when(use, F.coalesce(F.col("_a.reasoning"), F.col("outcome_details"))).otherwise(F.col("outcome_details")),
        "extraction_method": F.when(use, F.concat(F.col("extraction_method"), F.lit("+Reclassified"))).otherwise(F.col("extraction_method")),
    }).drop("_a")
