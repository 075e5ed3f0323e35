"""Payment schedules: table rows, bullets, prose and descriptions, as an array of items.

Table rows are always read; each further form is looked for only where nothing was found before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.functions import dates
from tamarack.functions.numbers import to_double, two_places
from tamarack.functions.regex import every, fence, first, has, holds, item, let, matches, mentions, pages, strip, sub, title, window, with_starts

#: Wordings of amounts, dates, times and limits.
AMOUNT = r"\d+(?:,\d{3})*(?:\.\d{2})?"
DATE = dates.ANY_TEXT_FIRST
TIME = r"(\d{1,2}:\d{2}\s*(?:AM|PM)?)"
CLOCK = r"\d{1,2}:\d{2}\s*(?:AM|PM)"
UNTIL = r"(?:by|no\s+later\s+than)\s+"
WEEKDAY = r"(?:(?:Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday)\s+)?"
#: What stands before an amount in a table cell (row number, bullets, dashes, bullets misread).
LEAD = r"\A(?:\d+\.\s*)?[;\s•·\-–—•â\u0080¢]*"
#: Words in a description, and how each is told.
EXTRAS = (("water", ("water",)), ("late fees", ("late fee", "late charges")), ("utilities", ("utility", "utilities")), ("third party assistance", ("third party",)))
#: The misread forms of month names before "rent".
MISREAD = "|".join("May" if m == "May" else m[:3] + r"\w*" for m in dates.MONTHS)

ITEM = "struct<payment_number:int,due_date:string,payment_type:string,amount:string,month_rent:string,time:string,extra_text:string,raw_text:string>"
SCHEDULE = f"array<{ITEM}>"


def describe(text: Column) -> Column:
    """What a description tells: a struct of ``kind``, ``month`` and ``extra``."""

    def told(t: Column) -> Column:
        plain, misread = first(t, rf"({dates.FULL}|{dates.SHORT})\s+rent", 1, "i"), first(t, rf"({MISREAD})\s+rent", 1, "i")
        extra = let(F.lower(t), lambda low: F.concat_ws(", ", *[F.when(_any(low, words), name) for name, words in EXTRAS]))
        month = F.when(mentions(t, "rent"), let(F.coalesce(plain, sub(misread, "[0-9]")), title))
        return let(month, lambda m: F.struct(F.when(m.isNotNull(), F.lit("monthly_rent")).otherwise("fixed_amount").alias("kind"), m.alias("month"), F.nullif(extra, F.lit("")).alias("extra")))

    return let(text, told)


def _any(text: Column, words) -> Column:
    out = F.contains(text, F.lit(words[0]))
    for w in words[1:]:
        out = out | F.contains(text, F.lit(w))
    return out


#: An item as found: ``about`` is the text that describes it, what is null here is taken from that description.
_FOUND = "array<struct<due:string,kind:string,amount:string,month:string,time:string,extra:string,raw:string,about:string>>"


def _item(due: Column, amount=None, raw=None, about=None, kind=None, month=None, time=None, extra=None) -> Column:
    lit = lambda x: F.lit(x).cast("string") if x is None or isinstance(x, str) else x
    named = {"due": due, "kind": kind, "amount": amount, "month": month, "time": time, "extra": extra, "raw": raw, "about": about}
    return F.struct(*[lit(x).alias(n) for n, x in named.items()])


def _finished(items: Column, as_of: Column) -> Column:
    """Items of the public schema: described, dated and numbered."""

    def one(x: Column, i: Column) -> Column:
        made = lambda d: F.struct(
            (i + 1).alias("payment_number"), dates.normalize_date(x["due"], as_of).alias("due_date"), F.coalesce(x["kind"], d["kind"]).alias("payment_type"), x["amount"].alias("amount"),
            F.coalesce(x["month"], d["month"]).alias("month_rent"), x["time"].alias("time"), F.coalesce(x["extra"], d["extra"]).alias("extra_text"), x["raw"].alias("raw_text"))
        return let(describe(x["about"]), made)

    return F.transform(items, one)


def _slashes(date: Column) -> Column:
    return F.translate(date, "-.", "//")


def _plain(amount: Column) -> Column:
    return F.replace(amount, F.lit(","), F.lit(""))


def _table_items(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with ``_y1``: the items of all table rows, in order."""
    date, money = f"({dates.NUMERIC})", rf"\$\s*({AMOUNT})"
    rows = F.transform(every(text, r"<tr>(.*?)</tr>", 1, "s"), lambda r: F.transform(every(r, r"<td>(.*?)</td>", 1, "s"), strip))
    out = df.withColumn("_rows", F.filter(rows, lambda cells: (F.size(cells) >= 2) & F.exists(cells, lambda c: has(c, dates.NUMERIC))))

    def told(cells: Column) -> Column:
        def cell(c: Column, i: Column) -> Column:
            def named(bare: Column) -> Column:
                kind = (
                    F.when(F.startswith(bare, F.lit("$")) & (F.length(bare) > 1), "a").when((bare == "$") & (i + 1 < F.size(cells)), "a")
                    .when(has(c, dates.NUMERIC), "d").when(holds(c, ":") & has(c, TIME, "i"), "t").otherwise("")
                )
                return F.struct(i.alias("i"), c.alias("c"), bare.alias("bare"), kind.alias("kind"))

            return let(strip(sub(c, LEAD)), named)

        return F.transform(cells, cell)

    out = out.withColumn("_told", F.transform("_rows", told))
    of = lambda cells, kind: F.filter(cells, lambda x: x["kind"] == kind)

    # each amount takes the first date to its right that no amount before it took
    def pair(cells: Column) -> Column:
        none = F.expr("cast(array() as array<struct<a:int,d:int>>)")

        def step(s: Column, a: Column) -> Column:
            d = item(F.filter(of(cells, "d"), lambda x: (x["i"] > a["i"]) & (x["i"] > s["last"])), 0)["i"]
            return F.when(d.isNull(), s).otherwise(F.struct(d.alias("last"), F.concat(s["out"], F.array(F.struct(a["i"].alias("a"), d.alias("d")))).alias("out")))

        return F.aggregate(of(cells, "a"), F.struct(F.lit(-1).alias("last"), none.alias("out")), step, lambda s: s["out"])

    both = lambda cells: F.exists(cells, lambda x: x["kind"] == "a") & F.exists(cells, lambda x: x["kind"] == "d")
    out = out.withColumn("_paired", F.transform("_told", lambda cells: F.struct(cells.alias("cells"), F.when(both(cells), pair(cells)).alias("pairs"), item(F.reverse(of(cells, "t")), 0)["c"].alias("time"))))

    # fixed values: an amount and its date in one cell
    forms = (rf"\$\s*(\d+(?:\.\d{{2}})?)\s+(?:by|on or before)?\s*{date}", rf"\$\s*(\d+(?:\.\d{{2}})?)\s+(?:rent\s+)?(?:on\s+or\s+before|by)\s+{date}")

    def combined(cells: Column) -> Column:
        """The one cell of a row that has an amount and its date."""
        c = item(F.filter(cells, lambda x: holds(x["c"], "$") & (has(x["c"], forms[0], "i") | has(x["c"], forms[1], "i"))), 0)["c"]
        amount, day = (F.coalesce(first(c, forms[0], g, "i"), first(c, forms[1], g, "i")) for g in (1, 2))
        return F.struct(c.alias("c"), amount.alias("amount"), _slashes(day).alias("day"))

    def one(x: Column) -> Column:
        made = _item(x["day"], x["amount"], F.concat(F.lit("$"), x["amount"], F.lit(" by "), x["day"]), about=x["c"], time=first(x["c"], TIME, 1, "i"))
        return F.array(F.when(x["amount"].isNotNull(), made))

    def from_pair(row: Column, p: Column) -> Column:
        bare, nxt, dcell = (item(row["cells"], k) for k in (p["a"], p["a"] + 1, p["d"]))
        lone = (bare["bare"] == "$") & (p["a"] + 1 < F.size(row["cells"]))
        cell = F.when(lone, F.concat(F.lit("$"), nxt["c"])).otherwise(bare["bare"])
        clock = lambda x: first(F.when(holds(x, ":"), x), TIME, 1, "i")
        return let(F.struct(
            cell.alias("cell"), _slashes(first(dcell["c"], date, 1)).alias("day"), (lone & (p["d"] == p["a"] + 1)).alias("skip"),
            F.coalesce(clock(row["time"]), clock(dcell["c"])).alias("time"), _plain(first(cell, money, 1)).alias("amount"),
            strip(F.regexp_replace(cell, r"\A\$+", "")).alias("words"),
        ), from_cells)

    def from_cells(x: Column) -> Column:
        number = x["amount"].isNotNull()
        empty = ~number & ((sub(x["cell"], r"[$\s_.]") == "") | (x["words"] == ""))
        raw = F.concat(F.lit("$"), F.coalesce(x["amount"], x["words"]), F.lit(" by "), x["day"])
        made = _item(x["day"], x["amount"], raw, about=F.when(number, x["cell"]).otherwise(x["words"]), time=x["time"], extra=F.when(~number, x["words"]))
        return F.when(~empty & ~x["skip"], made)

    items = F.transform("_paired", lambda row: F.when(row["pairs"].isNull(), let(combined(row["cells"]), one)).otherwise(F.transform(row["pairs"], lambda p: from_pair(row, p))))
    return out.withColumn("_y1", F.filter(F.flatten(items), lambda x: x.isNotNull())).drop("_rows", "_told", "_paired")


def payments(df: DataFrame, text_col: str = "cleaned_text", as_of: Column | None = None) -> DataFrame:
    """``df`` with ``payment_schedule`` and ``total_payment_sum`` (the sum of all amounts that are numbers)."""
    as_of = F.current_date() if as_of is None else as_of
    text = F.col(text_col)
    out = _table_items(df.withColumn("_t", F.when(F.contains(text, F.lit("<tr>")), text).otherwise("")), F.col("_t"))
    money = rf"\$\s*({AMOUNT})"

    def near(before: int):
        def build(t: Column, m: Column, at: Column, amount: int, day: Column, time: Column | None) -> Column:
            # the words before, the match itself and those behind it: a match may be longer than a page
            end = at + F.length(m["g0"])
            about = F.concat(window(t, at - before, at), m["g0"], window(t, end, end + 50))
            return _item(day, _plain(m[f"g{amount}"]), m["g0"], about=about, time=time)

        return build

    def placed(pattern: str, groups: int, build, keep=None):
        def make(t: Column) -> Column:
            found = with_starts(t, pattern, matches(t, pattern, groups, "i"), "i")
            found = F.filter(found, lambda x: keep(x["m"])) if keep else found
            # pages are cut where something was found
            return let(found, lambda xs: let(F.when(F.size(xs) > 0, pages(t)), lambda cut: F.transform(xs, lambda x: build(cut, x["m"], x["at"]))))

        return make

    def plain(pattern: str, groups: int, build):
        return lambda t: F.transform(matches(t, pattern, groups, "i"), build)

    wide, narrow = near(80), near(50)
    due = r"on\s+or\s+before|by|due\s+(?:to\s+\w+\s+)?by"
    summary = lambda m: _any(F.lower(F.coalesce(m["g2"], F.lit(""))), ("represents", "in the amount of"))
    pay = r"(?:will\s+pay|shall\s+pay|agrees?\s+to\s+pay)[^$\n]*?"
    limit = r"(?:no\s+later\s+than|by|on\s+or\s+before)\s+"
    # fixed values: the wordings of each form, in the order they are looked for, after the pieces that every match holds
    # (one of each group)
    forms = [
        # an amount, then a date in numbers
        ((("$",),), placed(rf"{money}\s+(?:{due})\s+({dates.NUMERIC})(?:\s+(?:by\s+)?({CLOCK}))?", 3, lambda t, m, at: narrow(t, m, at, 1, _slashes(m["g2"]), m["g3"]))),
        # an amount, then a date in words
        ((("$",),), placed(rf"{money}\s+(?:{due}|due)\s+({dates.TEXT_FULL}|{dates.TEXT_SHORT})", 2, lambda t, m, at: narrow(t, m, at, 1, m["g2"], None))),
        # an amount "to be paid by" a date, unless the text between sums up
        ((("$",), ("paid", "due")), placed(rf"{money}([^$\n]*?)(?:to\s+be\s+paid|due)\s+{UNTIL}({DATE})", 3, lambda t, m, at: wide(t, m, at, 1, _slashes(m["g3"]), None), lambda m: ~summary(m))),
        # "March rent of" an amount "to be paid by" a date
        ((("$",), ("rent",), ("paid", "due")), plain(rf"(\w+)\s+rent\s+of\s+{money}[^.]*?(?:to\s+be\s+paid|due)\s+{UNTIL}({DATE})", 3, lambda m: _item(_slashes(m["g3"]), _plain(m["g2"]), m["g0"], kind="monthly_rent", month=title(m["g1"])))),
        # "agrees to pay" an amount "by" a time and a date
        ((("$",), ("pay",)), plain(rf"(?:agrees?\s+to\s+pay|shall\s+pay)[^$]*?{money}\s+by\s+(?:({CLOCK}),?\s*)?({DATE})", 3, lambda m: _item(sub(_slashes(m["g3"]), r"(\d{1,2})(?:st|nd|rd|th)", "$1"), _plain(m["g1"]), m["g0"], kind="fixed_amount", time=m["g2"]))),
        # "will pay" an amount "no later than" a day, and months' rents to be paid so
        ((("pay", "paid"),), lambda t: F.concat(
            F.coalesce(placed(rf"{pay}{money}\s+{limit}{WEEKDAY}({DATE})", 2, lambda t, m, at: wide(t, m, at, 1, _slashes(m["g2"]), None))(t), _none()),
            F.coalesce(plain(rf"({dates.FULL}|{dates.SHORT})\s+rent\s+(?:will\s+be|shall\s+be|to\s+be|is\s+to\s+be)\s+paid\s+{limit}{WEEKDAY}({DATE})", 2, lambda m: _item(_slashes(m["g2"]), None, m["g0"], kind="monthly_rent", month=title(m["g1"])))(F.when(mentions(t, "rent"), t)), _none()),
        )),
        # "$March rent ..." with no number
        ((("$",), ("rent",)), plain(rf"\$([A-Za-z]+\s+rent[^$\n]*?)\s+on or before\s+(\d{{1,2}}/\d{{1,2}}/\d{{4}})(?:\s+(?:by\s+)?({CLOCK}))?", 3, lambda m: _item(m["g2"], None, m["g0"], about=m["g1"], kind="monthly_rent", time=m["g3"], extra=m["g1"]))),
    ]
    out = out.withColumn("_y", F.coalesce(F.col("_y1").cast(_FOUND), _none()))
    for needs, make in forms:
        look = F.size("_y") == 0
        for n in needs:
            look = look & mentions(text, *n)
        # the text is null, and the form costs nothing, where it isn't looked for
        out = out.withColumn("_t", F.when(look, text))
        out = out.withColumn("_y", F.when(F.col("_t").isNull(), F.col("_y")).otherwise(F.coalesce(make(F.col("_t")).cast(_FOUND), _none())))
    total = F.aggregate("_y", F.lit(0.0), lambda s, x: s + F.coalesce(to_double(x["amount"]), F.lit(0.0)))
    out = out.withColumns({"payment_schedule": _finished(F.col("_y"), as_of).cast(SCHEDULE), "total_payment_sum": F.when(total > 0, two_places(total))}).drop("_t", "_y", "_y1")
    return fence(out, "payment_schedule", "total_payment_sum")


def _none() -> Column:
    return F.array().cast(_FOUND)


def renumber(schedule: Column) -> Column:
    return F.transform(schedule, lambda x, i: x.withField("payment_number", i + 1))
