"""Case numbers and agreement dates, from a file's name first, then from the text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamarack.functions.dates import SHORT, normalize_date
from tamarack.functions.regex import first, let, mentions, sub


#: Endings of files' names, and how a name gives an agreement's month, day and year.
ENDINGS = ("txt", "png", "pdf", "jpg", "jpeg")
AGREED_JOINED = r"_-_(\d{1,2}_\d{1,2}_\d{4})_-_DAGREED"
AGREED = r"\s*-\s*(\d{1,2})\s+(\d{1,2})\s+(\d{4})\s*-\s*DAGREED"


def _bare(filename: Column) -> Column:
    return sub(filename, rf"\.(?:{'|'.join(ENDINGS)})\z", "", "i")


def _year(y: Column) -> Column:
    return F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y)


def case_in_name(filename: Column) -> Column:
    """The case number that a file's name gives."""
    bare = sub(sub(_bare(filename), r"_png\z"), r"_cleaned\z")
    # fixed values: forms of a case number in a name, in the order they are tried
    ladder = [(r"\A(\d{4})_CVG_(\d{5,6})", ""), (r"(\d{4})\s+CVG\s+(\d{5,6})", "i"), (r"(\d{4})_CVG_(\d{5,6})", "i"),
              (r"(\d{2,4})[_\s-]+CVG[_\s-]+(\d{5,6})", "i"), (r"(\d{4})CVG(\d{6})", "i"), (r"(\d{2})CVG(\d{5,6})", "i")]
    # concat is null unless the rule matches
    by_rule = lambda name: [F.concat(_year(first(name, p, 1, f)), F.lit(" CVG "), first(name, p, 2, f)) for p, f in ladder]
    return let(F.when(mentions(filename, "cvg"), bare), lambda name: F.coalesce(*by_rule(name)))


def case_in_text(text: Column) -> Column:
    # fixed values: forms in a text
    long_form, short_form = r"\d{4}\s*CVG\s*\d{6}", r"\d{2}[_\s]CVG[_\s]\d{5,6}"
    label = r"Case\s+No\.?[:\s]*"
    found = F.when(mentions(text, "cvg"), F.coalesce(*[first(text, p, 1, "i") for p in (f"{label}({long_form})", f"{label}({short_form})", f"({long_form})", f"({short_form})")]))
    widened = lambda x: F.when((F.size(F.split(x, " ")) == 3) & (F.length(F.substring_index(x, " ", 1)) == 2), F.concat(F.lit("20"), x)).otherwise(x)
    return let(sub(sub(found, "[_-]", " "), r"\s+", " "), widened)


def case_number(text: Column, filename: Column) -> Column:
    return F.coalesce(case_in_name(filename), case_in_text(text))


def date_in_name(filename: Column) -> Column:
    """The agreement's date that a file's name gives."""
    two = lambda x: F.lpad(x, 2, "0")
    dated = lambda m, d, y: F.when(m.isNotNull(), F.concat_ws("-", y, two(m), two(d)))
    joined = lambda name: let(F.split(first(name, AGREED_JOINED, 1, "i"), "_"), lambda x: dated(x[0], x[1], x[2]))
    spaced = lambda name: dated(*(first(name, AGREED, g, "i") for g in (1, 2, 3)))
    return let(F.when(mentions(filename, "dagreed"), sub(_bare(filename), r"_cleaned\z")), lambda name: F.coalesce(joined(name), spaced(name)))


def date_in_text(text: Column, as_of: Column | None = None) -> Column:
    # fixed values: wordings around an agreement's date
    slash = r"(\d{1,2}/\d{1,2}/\d{2,4})"
    named = rf"((?:{SHORT})[A-Z]*\s+\d{{1,2}}[,\s]+\d{{4}})"
    judge, signed = r"(?:JUDGE|MAGISTRATE)[\s\S]{0,100}?", r"Date[\s:]*<?signature>?[\s\S]{0,50}?"
    mark = r"<watermark>.*?{}.*?</watermark>"
    # each with the pieces one of which every match holds
    rules = [
        (judge + slash, "is", ("judge", "magistrate")), (judge + named, "is", ("judge", "magistrate")), (signed + slash, "is", ("signature",)), (signed + named, "is", ("signature",)),
        (mark.format(r"(\d{4}\s+[A-Z]{3}\s+\d{1,2}[\s,]+(?:AM|PM)\s+\d{1,2}:\d{2})"), "is", ("<watermark>",)), (mark.format(r"([A-Z]{3}\s+\d{1,2}\s+\d{4})"), "is", ("<watermark>",)),
        (r"(\d{4}\s+[A-Z]{3}\s+\d{1,2})(?:\s+[AP]M?)?", "", ())]
    found = [F.when(mentions(text, *anchors), first(text, p, 1, f)) if anchors else first(text, p, 1, f) for p, f, anchors in rules]
    return normalize_date(F.coalesce(*found), as_of)


def agreement_date(text: Column, filename: Column, as_of: Column | None = None) -> Column:
    return F.coalesce(date_in_name(filename), date_in_text(text, as_of))
