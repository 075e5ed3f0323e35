"""The flat row: one wide row for each document, with up to 20 payments as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.functions.regex import item

MAX_PAYMENTS = 20
LEADING = ("filename", "case_number", "agreement_signed_date", "plaintiff", "defendant", "outcome_type", "outcome_details")
TRAILING = ("mandatory_vacate_date", "third_party_acceptance", "additional_agreement_terms", "assistance_deadline", "extraction_method", "confidence_score", "confidence_label", "confidence_details")


def shown_amount(p: Column) -> Column:
    """An item's amount: a rent as month and amount, or as "Monthly rent" with neither."""
    rent = F.concat_ws(" ", F.nullif(p["month_rent"], F.lit("")), F.concat(F.lit("$"), F.nullif(p["amount"], F.lit(""))))
    return F.when(p["payment_type"] == "monthly_rent", F.coalesce(F.nullif(rent, F.lit("")), F.lit("Monthly rent"))).otherwise(p["amount"])


def flatten(df: DataFrame, max_payments: int = MAX_PAYMENTS, extra: tuple[str, ...] = ()) -> DataFrame:
    """The flat rows of ``df``; ``extra`` names further columns to carry along."""
    n = F.size("payment_schedule")
    cols = [F.col(c) for c in LEADING] + [n.alias("payment_count"), F.col("total_payment_sum"), (n > 10).alias("has_more_than_10_payments")]
    for k in range(max_payments):
        p = item(F.col("payment_schedule"), k)
        cols += [p["due_date"].alias(f"payment_{k + 1}_date"), shown_amount(p).alias(f"payment_{k + 1}_amount"), p["payment_type"].alias(f"payment_{k + 1}_type"), p["extra_text"].alias(f"payment_{k + 1}_extra")]
    return df.select(*cols, *[F.col(c) for c in TRAILING + extra])
