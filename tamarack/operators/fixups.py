"""Corrections after extraction, each a function from DataFrame to DataFrame."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.functions.dates import MONTHS
from tamarack.functions.numbers import to_double, two_places
from tamarack.functions.regex import blank, fence, has, item, let, strip, sub

#: Plaintiffs that file often, in the order they are tried, and how OCR spells them.
KNOWN_PLAINTIFFS = (
    ("McNaughten", ("mcnaughten", "mcnaughton", "mcnaught", "mc naughten", "menaughten", "menaughton")),
    ("Vinebrook", ("vinebrook", "vine brook", "vinebrook homes", "vinbrook", "vinebrooke", "vnebrook", "vinebroo")),
    ("S81", ("s81", "s812", "s8 1", "s8'12", "s8l2", "s8id", "581", "5812", "s 81", "s-81")),
    ("Wallick", ("wallick", "walick", "wallck", "waliick")),
    ("NRP Group", ("nrp group", "nrp", "nrp grp")),
    ("Elam", ("elam", "elam and", "elam &")),
    ("Riverdale", ("riverdale", "river dale", "riverdal", "riverdalle")),
    ("National Church Residences", ("national church", "natl church", "national church residences")),
    ("CASTO", ("casto", "casto communities")),
    ("Blueprint", ("blueprint", "blue print")),
    ("Hearty Home", ("hearty home", "hearty homes", "heartyhome")),
)
#: The first days and last days around the agreement that a payment may fall on.
DAYS_BEFORE, DAYS_AFTER = 7, 548
EARLY, LATE = "DATE_BEFORE_AGREEMENT", "DATE_TOO_FAR_FUTURE"
#: Fixed value: a filing stamp that OCR took for a name.
STAMP = r"\d{4}\s+[A-Z]{3}\s+\d{1,2}\s+[AP]M"
MONTH_WORDS = tuple(m.lower() for m in MONTHS) + tuple(m[:3].lower() for m in MONTHS)


def fix_total(df: DataFrame) -> DataFrame:
    """The total becomes the sum of fixed amounts where that is above zero."""
    amount = lambda p: F.when(p["payment_type"] == "fixed_amount", F.coalesce(to_double(p["amount"]), F.lit(0.0))).otherwise(0.0)
    total = F.aggregate("payment_schedule", F.lit(0.0), lambda s, p: s + F.coalesce(amount(p), F.lit(0.0)))
    return df.withColumn("total_payment_sum", F.coalesce(let(total, lambda x: F.when(x > 0, two_places(x))), F.col("total_payment_sum")))


def fix_case(df: DataFrame) -> DataFrame:
    return df.withColumn("case_number", sub(F.col("case_number"), r"\b5812\b", "S812"))


def fix_outcome(df: DataFrame) -> DataFrame:
    return df.withColumn("outcome_type", F.when(F.col("outcome_type") == "Vacate or Pay", "Pay or Vacate").otherwise(F.col("outcome_type")))


def known_plaintiff(name: Column) -> Column:
    """The first known plaintiff that a name contains a spelling of, or resembles; null if none.

    A name resembles a spelling of four letters or more if it begins with the same four and over 0.6 of
    the spelling's letters agree place by place.
    """
    table = F.from_json(F.lit(json.dumps([{"n": n, "v": v, "head": v[:4] if len(v) >= 4 else None} for n, vs in KNOWN_PLAINTIFFS for v in vs])), "array<struct<n:string,v:string,head:string>>")
    # every hit holds one of these, and few names do
    some = "|".join(sorted({re.escape(v[:4]) for _, vs in KNOWN_PLAINTIFFS for v in vs}))

    def hit(low: Column, t: Column) -> Column:
        v = t["v"]
        places = F.sequence(F.lit(1), F.length(v))
        same = F.size(F.filter(places, lambda i: F.substring(low, i, F.lit(1)) == F.substring(v, i, F.lit(1))))
        return F.contains(low, v) | F.coalesce(F.startswith(low, t["head"]), F.lit(False)) & (same / F.length(v) > 0.6)

    found = lambda low: F.when((F.length(low) >= 2) & low.rlike(some), item(F.filter(table, lambda t: hit(low, t)), 0)["n"])
    return let(F.lower(strip(name)), found)


def fix_plaintiff(df: DataFrame) -> DataFrame:
    return df.withColumn("plaintiff", F.coalesce(known_plaintiff(F.col("plaintiff")), F.col("plaintiff")))


def fix_rent(df: DataFrame) -> DataFrame:
    """Items that are rents in truth become so; an amount that looks guessed goes; the total follows."""

    def fixed(p: Column) -> Column:
        return let(F.when(F.upper(p["amount"]) != F.lower(p["amount"]), strip(p["amount"])), lambda word: let(F.coalesce(F.lower(word).isin(*MONTH_WORDS), F.lit(False)), lambda is_month: told(p, word, is_month)))

    def told(p: Column, word: Column, is_month: Column) -> Column:
        month = F.when(is_month, F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substring(word, 2, 20)))).otherwise(p["month_rent"])
        amount = F.when(~is_month, p["amount"])
        rent = is_month | F.contains(F.lower(F.coalesce(p["extra_text"], F.lit(""))), F.lit("rent")) | (~blank(month) & (p["payment_type"] == "fixed_amount"))
        rent = F.coalesce(rent, F.lit(False))
        value = to_double(amount)
        guessed = F.coalesce((value > 0) & (value % 50 == 0), F.lit(False)) & blank(p["extra_text"])
        return p.withField("month_rent", month).withField("payment_type", F.when(rent, "monthly_rent").otherwise(p["payment_type"])).withField("amount", F.when(~(rent & guessed), amount))

    return fix_total(df.withColumn("payment_schedule", F.transform("payment_schedule", fixed)))


def fix_dates(df: DataFrame) -> DataFrame:
    """Payments due oddly long before or after the agreement carry a warning, once."""
    form = r"\A\d{4}-\d{1,2}-\d{1,2}\z"
    day = lambda c: F.when(has(c, form), c.try_cast("date"))
    df = fence(df.withColumn("_signed", day(F.col("agreement_signed_date"))), "_signed")
    signed = F.col("_signed")

    def flagged(p: Column) -> Column:
        return let(day(p["due_date"]), lambda due: warned(p, due))

    def warned(p: Column, due: Column) -> Column:
        warning = F.when(due < F.date_sub(signed, DAYS_BEFORE), EARLY).when(due > F.date_add(signed, DAYS_AFTER), LATE)
        new = warning.isNotNull() & ~F.contains(F.coalesce(p["extra_text"], F.lit("")), warning)
        return p.withField("extra_text", F.when(F.coalesce(new, F.lit(False)), F.concat_ws("; ", F.nullif(p["extra_text"], F.lit("")), warning)).otherwise(p["extra_text"]))

    return df.withColumn("payment_schedule", F.transform("payment_schedule", flagged)).drop("_signed")


def plaintiff_flag(name: Column) -> Column:
    """Why a plaintiff's name looks like an OCR artifact, or null."""
    digits = F.length(name) - F.length(sub(name, r"\d"))
    return (
        F.when(has(name, STAMP), F.concat(F.lit("OCR artifact detected: '"), name, F.lit("'")))
        .when((F.length(name) > 0) & (digits / F.length(name) > 0.5), F.concat(F.lit("Mostly numeric plaintiff: '"), name, F.lit("'")))
    )


def apply_fixups(df: DataFrame) -> DataFrame:
    for step in (fix_total, fix_case, fix_outcome, fix_plaintiff, fix_rent, fix_dates):
        df = step(df)
    return fence(df, "payment_schedule", "total_payment_sum", "plaintiff")
