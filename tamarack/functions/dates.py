"""Dates as text: validity, and normalisation to ISO form.

``as_of`` stands for today: a two-digit year takes the century that puts it less than 50 years ahead, and a
date without a day takes the day of ``as_of``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamarack.functions.regex import blank, first, has, holds, let, strip, sub, sub_if

#: Month names.
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
FULL = "|".join(MONTHS)
SHORT = "|".join(m[:3] for m in MONTHS)
NUMERIC = r"\d{1,2}[/\-.]\d{1,2}[/\-.]\d{2,4}"
TEXT_FULL = rf"(?:{FULL})\s+\d{{1,2}}(?:st|nd|rd|th)?,?\s+\d{{4}}"
TEXT_SHORT = rf"(?:{SHORT})\.?\s+\d{{1,2}}(?:st|nd|rd|th)?,?\s+\d{{4}}"
ANY_TEXT_FIRST = rf"{TEXT_FULL}|{TEXT_SHORT}|{NUMERIC}"


def month_number(word: Column, short: bool = True) -> Column:
    """1 to 12 for a month's name (any case; its first three letters and "sept" too if ``short``), else null."""
    word, out = F.lower(word), F
    for k, m in enumerate(MONTHS, 1):
        names = [m.lower()] + ([m[:3].lower()] if short else []) + (["sept"] if short and k == 9 else [])
        out = out.when(word.isin(*names), k)
    return out


def leap(y: Column) -> Column:
    return (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))


def month_days(m: Column, y: Column | None) -> Column:
    """Days of a month; February has 29 in a leap year, 28 if there is no year."""
    february = F.lit(28) if y is None else F.when(F.coalesce(leap(y), F.lit(False)), 29).otherwise(28)
    return F.when(m == 2, february).when(m.isin(4, 6, 9, 11), 30).otherwise(31)


def valid(m: Column, d: Column, y: Column | None) -> Column:
    return F.coalesce(m.between(1, 12) & (d >= 1) & (d <= month_days(m, y)), F.lit(False))


def widened(y: Column) -> Column:
    """Years below 100: up to 49 in this century, others in the last."""
    return F.when(y < 50, y + 2000).when(y < 100, y + 1900).otherwise(y)


def iso(y: Column, m: Column, d: Column) -> Column:
    return F.concat_ws("-", y.cast("string"), F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0"))


def line_key(line: Column) -> Column:
    """yyyymmdd of a line's date, null if it has none.

    A date in numbers counts first; if it is no real date, the line has none, whatever else it says.
    """
    p, q = r"(\d{1,2})[/-](\d{1,2})[/-](\d{2,4})", rf"({FULL})\s+(\d{{1,2}}),?\s*(\d{{4}})"
    n = lambda pattern, g, flags="": first(line, pattern, g, flags).cast("int")
    numbers = F.struct(n(p, 1).alias("m"), n(p, 2).alias("d"), widened(n(p, 3)).alias("y"))
    words = F.struct(month_number(first(line, q, 1, "i"), False).alias("m"), n(q, 2, "i").alias("d"), n(q, 3, "i").alias("y"))
    key = lambda x: F.when(valid(x["m"], x["d"], x["y"]) & (x["y"] >= 1), x["y"] * 10000 + x["m"] * 100 + x["d"])
    return let(F.when(has(line, p), numbers).otherwise(words), key)


#: Forms that are told apart: month, day, year in numbers; a word, a day, a year; a clerk's stamp, perhaps with a time.
_NUMBERS = r"\A(\d{1,2})[/\-.](\d{1,2})[/\-.](\d{2,4})\z"
_WORDED = r"\A([A-Za-z]+)\.?\s+(\d{1,2})(?:st|nd|rd|th)?[,/]?\s+(\d{4})\z"
_STAMP = r"\A(\d{4})\s+([A-Za-z]{3})\s+(\d{1,2})(?:[\s,]+(?:AM|PM)\s+(\d{1,2}):\d{2})?\z"
_SLASHED = r"(\d{1,2})/(\d{1,2})/(\d{2,4})"
_TIME = r"\s+(?:by|at)\s+\d{1,2}:\d{2}\s*(?:AM|PM)?"


def _iso_or(x: Column, other: Column) -> Column:
    """The date of a struct (m, d, y), or ``other`` if it is none."""
    return let(x, lambda v: F.when(valid(v["m"], v["d"], v["y"]) & (v["y"] >= 1), iso(v["y"], v["m"], v["d"])).otherwise(other))


def _ymd(y: Column, m: Column, d: Column) -> Column:
    return F.struct(y.alias("y"), m.alias("m"), d.alias("d"))


def normalize_date(date: Column, as_of: Column | None = None) -> Column:
    """ISO form of a date as it occurs in documents; what is no date comes back as it is, null and '' as null."""
    today = F.current_date() if as_of is None else as_of
    this_year, this_day = F.year(today), F.dayofmonth(today)
    number = lambda t, p, g: first(t, p, g, "i").cast("int")
    without_day = lambda y, m: iso(y, m, F.least(this_day, month_days(m, y)))

    def in_numbers(t: Column) -> Column:
        def years(x: Column) -> Column:
            # a first number above 12 is the day
            swap = x["a"].between(13, 31)
            full = x["y"] + F.floor(this_year / 100).cast("int") * 100
            century = F.when(full >= this_year + 50, full - 100).when(full < this_year - 50, full + 100).otherwise(full)
            return _ymd(F.when(x["digits"] == 2, century).otherwise(x["y"]), F.when(swap, x["b"]).otherwise(x["a"]), F.when(swap, x["a"]).otherwise(x["b"]))

        parts = F.struct(number(t, _NUMBERS, 1).alias("a"), number(t, _NUMBERS, 2).alias("b"), number(t, _NUMBERS, 3).alias("y"), F.length(first(t, _NUMBERS, 3)).alias("digits"))
        return _iso_or(let(parts, years), as_written(t))

    def as_written(t: Column) -> Column:
        """A date with slashes that is no real date, in the order of ISO; else the text."""
        y = first(t, _SLASHED, 3)
        return F.when(y.isNull(), t).otherwise(F.concat_ws("-", F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y), F.lpad(first(t, _SLASHED, 1), 2, "0"), F.lpad(first(t, _SLASHED, 2), 2, "0")))

    def by_month(t: Column, parts: Column) -> Column:
        """A named month gives the date; any other word leaves the number to be the month, and no day."""
        named = lambda x: _iso_or(x, t)
        return let(parts, lambda x: F.when(x["m"].isNotNull(), F.when(x["hour"] > 12, without_day(x["y"], x["m"])).otherwise(named(x)))
                   .when(x["d"].between(1, 12) & (x["y"] > 31), without_day(x["y"], x["d"])).otherwise(t))

    def in_words(t: Column) -> Column:
        return by_month(t, F.struct(number(t, _WORDED, 3).alias("y"), month_number(first(t, _WORDED, 1, "i")).alias("m"), number(t, _WORDED, 2).alias("d"), F.lit(0).alias("hour")))

    def stamped(t: Column) -> Column:
        return by_month(t, F.struct(number(t, _STAMP, 1).alias("y"), month_number(first(t, _STAMP, 2, "i")).alias("m"), number(t, _STAMP, 3).alias("d"), F.coalesce(number(t, _STAMP, 4), F.lit(0)).alias("hour")))

    def parse(t: Column) -> Column:
        return F.when(has(t, _NUMBERS), in_numbers(t)).when(has(t, _WORDED, "i"), in_words(t)).when(has(t, _STAMP, "i"), stamped(t)).otherwise(as_written(t))

    return let(date, lambda d: F.when(~blank(d), let(strip(sub_if(holds(d, ":"), d, _TIME, "", "i")), parse)))
