"""Merging model results (as JSON text in a column) with what the patterns found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.functions.regex import blank
from tamarack.operators.case_ids import case_in_name, date_in_name
from tamarack.operators.obligations import only_breach_vacates
from tamarack.operators.payments import SCHEDULE, renumber

#: Outcome types.
OUTCOMES = ("Pay and Stay", "Pay and Vacate", "Pay or Vacate", "Vacate Only", "Agreed Entry", "Agreed Judgment", "Settlement", "Unknown")
TEXT_FIELDS = ("case_number", "plaintiff", "defendant", "total_payment_sum", "outcome_details", "mandatory_vacate_date", "additional_agreement_terms")
_PAYMENT = "struct<due_date:string,payment_type:string,amount:string,month_rent:string,time:string,extra_text:string>"
MODEL_SCHEMA = ",".join(f"{c} string" for c in (*TEXT_FIELDS, "outcome_type")) + f",third_party_acceptance boolean,payment_schedule array<{_PAYMENT}>"


def from_model(json: Column) -> Column:
    """A model's JSON answer as a struct; null for no answer, an empty object, or one that can't be read."""
    raw = F.from_json(json, MODEL_SCHEMA)
    keys = F.json_object_keys(json)
    listed = F.from_json(raw["additional_agreement_terms"], "array<string>")
    terms = F.when(F.startswith(F.ltrim(raw["additional_agreement_terms"]), F.lit("[")), F.array_join(listed, "; ")).otherwise(raw["additional_agreement_terms"])
    kind = F
    for o in OUTCOMES:
        kind = kind.when(F.lower(raw["outcome_type"]) == o.lower(), o)
    items = F.transform(raw["payment_schedule"], lambda p, i: F.struct(
        (i + 1).alias("payment_number"), p["due_date"].alias("due_date"),
        F.when(p["payment_type"].isin("fixed_amount", "monthly_rent"), p["payment_type"]).alias("payment_type"),
        p["amount"].alias("amount"), p["month_rent"].alias("month_rent"), p["time"].alias("time"), p["extra_text"].alias("extra_text"), F.lit(None).cast("string").alias("raw_text"),
    ))
    schedule = F.when(F.array_contains(keys, "payment_schedule"), items).otherwise(F.array().cast(SCHEDULE)).cast(SCHEDULE)
    fields = [(terms if c == "additional_agreement_terms" else raw[c]).alias(c) for c in (*TEXT_FIELDS, "third_party_acceptance")]
    return F.when((F.size(keys) > 0) & schedule.isNotNull(), F.struct(*fields, kind.alias("outcome_type"), schedule.alias("payment_schedule")))


def merge(df: DataFrame, model_col: str | None = None, text_col: str = "cleaned_text", as_of: Column | None = None) -> DataFrame:
    """``df`` (with the columns of the pattern extractors) after gaps and conflicts with the model's answer are
    settled, and file names have had the last word.  Sets ``extraction_method``.

    What names give is taken from ``_named_case`` and ``_named_date`` where the extraction has left it."""
    out = df
    if model_col is not None:
        out = out.withColumn("_m", from_model(F.col(model_col)))
        m, has = F.col("_m"), F.col("_m").isNotNull()
        squeezed = lambda c: F.replace(F.lower(F.coalesce(c, F.lit(""))), F.lit(" "), F.lit(""))
        clash = has & F.contains(squeezed(m["outcome_type"]), F.lit("vacate")) & (squeezed(F.col("outcome_type")) == "payandstay")
        out = out.withColumn("_clash", clash).withColumn("_breach", F.when(F.col("_clash"), only_breach_vacates(F.col(text_col))))
        over = F.coalesce(F.col("_breach"), F.lit(False))
        merged = {c: F.coalesce(m[c], F.col(c)) for c in (*TEXT_FIELDS, "third_party_acceptance", "outcome_type")}
        for c in ("outcome_type", "outcome_details"):
            merged[c] = F.when(over, F.col(c)).otherwise(merged[c])
        vacate = F.when(F.col("_clash"), F.coalesce(F.col("mandatory_vacate_date"), merged["mandatory_vacate_date"])).otherwise(merged["mandatory_vacate_date"])
        merged["mandatory_vacate_date"] = F.when(~over, vacate)
        filled = F.filter(m["payment_schedule"], lambda p: p["amount"].isNotNull() | p["month_rent"].isNotNull())
        merged["payment_schedule"] = F.when(has, renumber(filled)).otherwise(F.col("payment_schedule"))
        merged["extraction_method"] = F.when(has, "LLM+Regex").otherwise("Regex-only")
        out = out.withColumns(merged).drop("_m", "_clash", "_breach")
    else:
        out = out.withColumn("extraction_method", F.lit("Regex-only"))
    name = F.col("filename")
    named = F.col("_named_case") if "_named_case" in df.columns else case_in_name(name)
    dated = F.col("_named_date") if "_named_date" in df.columns else date_in_name(name)
    has_name = ~blank(F.col("filename"))
    return out.withColumns({
        "case_number": F.coalesce(F.when(has_name, named), F.col("case_number")),
        "agreement_signed_date": F.coalesce(F.when(has_name, dated), F.col("agreement_signed_date")),
    }).drop("_named_case", "_named_date")
