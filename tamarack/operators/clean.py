"""Cleaning of OCR text: money glyphs, number glyphs, impossible dates, payment order, white space."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.functions import dates
from tamarack.functions.regex import fence, gaps, has, holds, let, matches, mentions, rewrite, strip, stripped, sub, sub_if

#: Glyphs that OCR takes for digits, and the digits.
GLYPHS = ("OolISBZgq", "001158299")
GLYPHS_IN_NUMBERS = ("OolI", "0011")
#: What is taken for money, a number, a date.
MONEY = r"\$[\d,.\w]+"
#: A look ahead comes first in the last three, as a word's edge costs more to test than a character.
NUMBER = r"(?=\d)\b\d{1,3}[,.]?[\dOoIl]{2,3}\.[\dOoIl]{2}\b"
TEXT_DATE = rf"(?=[JFMASOND])\b({dates.FULL})\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s*(\d{{4}})?\b"
NUMERIC_DATE = r"(?=\d)\b(\d{1,2})[/-](\d{1,2})[/-](\d{2,4})\b"
#: A schedule's header, then whole lines up to two line feeds or the end of the text.
BLOCK = r"(Payment\s+Schedule|Payment\s+Plan|Installment\s+Schedule)[:\s]*\n((?:(?s:.*?)\n)??)(?=\n\n|\z)"
INVALID = " [INVALID DATE]"


def fix_money(text: Column) -> Column:
    return rewrite(text, MONEY, "", lambda m, _: F.concat(F.lit("$"), F.translate(F.substring(m, F.lit(2), F.length(m)), *GLYPHS)), anchor=holds(text, "$"))


def fix_numbers(text: Column) -> Column:
    return rewrite(text, NUMBER, "", lambda m, _: F.translate(m, *GLYPHS_IN_NUMBERS), anchor=has(text, r"\.[\dOoIl]{2}"))


def flag_text_dates(text: Column) -> Column:
    def change(m: Column, g: Column) -> Column:
        ymd = F.struct(dates.month_number(g["g1"], False).alias("m"), g["g2"].cast("int").alias("d"), g["g3"].cast("int").alias("y"))
        return let(ymd, lambda x: F.when(~dates.valid(x["m"], x["d"], x["y"]), F.concat(m, F.lit(INVALID))))

    return rewrite(text, TEXT_DATE, "i", change, 3, anchor=mentions(text, *(m.lower() for m in dates.MONTHS)))


def flag_numeric_dates(text: Column) -> Column:
    def change(m: Column, g: Column) -> Column:
        ymd = F.struct(g["g1"].cast("int").alias("m"), g["g2"].cast("int").alias("d"), dates.widened(g["g3"].cast("int")).alias("y"))
        return let(ymd, lambda x: F.when(~dates.valid(x["m"], x["d"], x["y"]), F.concat(m, F.lit(INVALID))))

    return rewrite(text, NUMERIC_DATE, "", change, 3, anchor=has(text, r"[/-]\d"))


def sort_schedules(text: Column) -> Column:
    """Lines of each payment schedule in the order of their dates, lines without a date last, blank lines gone.

    A struct of ``text`` and ``moved``, which has an element for each block whose order changed.
    """
    blocks = F.transform(matches(text, BLOCK, 2, "i"), lambda m: F.struct(
        m["g1"].alias("head"),
        F.transform(
            F.filter(F.split(strip(F.coalesce(m["g2"], F.lit(""))), "\n"), lambda x: strip(x) != ""),
            lambda x, i: F.struct(dates.line_key(x).alias("key"), i.alias("i"), x.alias("line")),
        ).alias("ls"),
    ))

    def ordered(b: Column) -> Column:
        dated = F.filter(b["ls"], lambda x: x["key"].isNotNull())
        return let(F.struct(dated.alias("as_was"), F.array_sort(dated).alias("sorted")), lambda d: F.struct(
            F.concat(b["head"], F.lit("\n"), F.array_join(F.transform(F.concat(d["sorted"], F.filter(b["ls"], lambda x: x["key"].isNull())), lambda x: x["line"]), "\n")).alias("new"),
            (d["as_was"] != d["sorted"]).alias("moved")))

    def build(done: Column) -> Column:
        out = F.array_join(F.flatten(F.zip_with(gaps(text, BLOCK, "i"), done, lambda g, d: F.array(g, F.coalesce(d["new"], F.lit(""))))), "")
        return F.struct(out.alias("text"), F.transform(F.filter(done, lambda d: d["moved"]), lambda d: d["new"]).alias("moved"))

    some = mentions(text, "schedule", "plan") & has(text, r"(?:Payment\s+(?:Schedule|Plan)|Installment\s+Schedule)[:\s]*\n", "i")
    same = F.struct(text.alias("text"), F.array().cast("array<string>").alias("moved"))
    return F.when(some, let(F.transform(blocks, ordered), build)).otherwise(same)


def tidy(text: Column) -> Column:
    text = sub_if(holds(text, "\n\n\n\n"), text, r"\n{4,}", "\n\n\n")
    text = let(text, lambda t: sub_if(holds(t, "  "), t, r" {2,}", " "))
    pages = lambda t: sub(sub(t, r"\[--- PAGE (\d+) START ---\]", "\n\n=== PAGE $1 ===\n\n"), r"\[--- PAGE (\d+) END ---\]", "")
    return let(let(text, lambda t: F.when(holds(t, "[--- PAGE "), pages(t)).otherwise(t)), stripped)


#: What the log of changes says.
STEPS = ((fix_money, "Fixed money: ", True), (fix_numbers, "Fixed number: ", True), (flag_text_dates, "Invalid date: ", False), (flag_numeric_dates, "Invalid date: ", False))
MOVED = "Reordered payment schedule chronologically"


def clean(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with ``cleaned_text`` and ``ocr_changes``; a null text counts as empty."""
    out = df.withColumn("_t", F.coalesce(F.col(text_col), F.lit("")))
    logs = []
    for k, (step, head, both) in enumerate(STEPS):
        out = out.withColumn(f"_r{k}", step(F.col("_t"))).withColumn("_t", F.col(f"_r{k}.text"))
        told = (lambda c, head=head: F.concat(F.lit(head), c["old"], F.lit(" -> "), c["new"])) if both else (lambda c, head=head: F.concat(F.lit(head), c["old"]))
        logs.append(F.transform(F.col(f"_r{k}.changed"), _one(told)))
    out = out.withColumn("_sorted", sort_schedules(F.col("_t")))
    logs.append(F.transform(F.col("_sorted.moved"), lambda _: F.lit(MOVED)))
    out = out.withColumns({"cleaned_text": tidy(F.col("_sorted.text")), "ocr_changes": F.concat(*logs)})
    return fence(out, "cleaned_text", "ocr_changes").drop("_t", "_sorted", *[f"_r{k}" for k in range(len(STEPS))])


def _one(f):
    """``f`` as a function of one argument, as Spark counts a lambda's parameters."""
    return lambda c: f(c)
