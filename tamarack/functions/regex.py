"""Regular expressions with Python's meaning on the JVM, and rewriting without a UDF.

Patterns carry the flags ``d`` (only a line feed ends a line) and ``U`` (Unicode classes), which makes ``\\d``,
``\\w``, ``\\s``, ``.`` and ignore-case mean what they mean for Python text.  ``\\z`` is the end of the text.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters beyond ASCII that a pattern without case takes for one of ASCII, and that one.
FOLDED = (("\u0130", "i"), ("\u0131", "i"), ("\u017f", "s"), ("\u212a", "k"))
_EDGE = r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"


def rx(pattern: str, flags: str = "") -> str:
    return f"(?{flags}dU){pattern}"


def first(text: Column, pattern: str, group: int = 1, flags: str = "") -> Column:
    """A group of the first match; null without a match or if it is empty."""
    # nullif would search twice within a lambda, where Catalyst writes its argument out twice
    return let(F.regexp_extract(text, rx(pattern, flags), group), lambda m: F.when(m != "", m))


def has(text: Column, pattern: str, flags: str = "") -> Column:
    return F.coalesce(text.rlike(rx(pattern, flags)), F.lit(False))


def every(text: Column, pattern: str, group: int = 0, flags: str = "") -> Column:
    """A group of each match, in order."""
    return F.regexp_extract_all(text, F.lit(rx(pattern, flags)), F.lit(group))


def sub(text: Column, pattern: str, to: str = "", flags: str = "") -> Column:
    return F.regexp_replace(text, rx(pattern, flags), to)


def strip(text: Column) -> Column:
    return F.regexp_replace(text, _EDGE, "")


def contains_any(text: Column, phrases) -> Column:
    out = F.lit(False)
    for p in phrases:
        out = out | F.contains(text, F.lit(p))
    return out


def mentions(text: Column, *anchors: str) -> Column:
    """Whether a text has one of ``anchors`` in any case, as patterns that ignore case see it.

    An anchor is a piece that every match of a pattern holds, so a pattern is looked for only where one of its anchors
    stands: finding a literal takes a fraction of what a pattern costs, and most texts lack most patterns.  It is looked
    for in lower case, and by a pattern only in texts with one of the four other letters that fold to ASCII.
    """
    lower = [a.lower() for a in anchors]
    found = contains_any(F.lower(text) if any(a.upper() != a for a in lower) else text, lower)
    odd = [c for c, plain in FOLDED if any(plain in a for a in lower)]
    if odd:
        found = found | contains_any(text, odd) & text.rlike("(?iu)" + "|".join(re.escape(a) for a in anchors))
    return F.coalesce(found, F.lit(False))


def holds(text: Column, *pieces: str) -> Column:
    """Whether a text has one of ``pieces`` as they are."""
    return F.coalesce(contains_any(text, pieces), F.lit(False))


def sub_if(anchor: Column, text: Column, pattern: str, to: str = "", flags: str = "") -> Column:
    return F.when(anchor, sub(text, pattern, to, flags)).otherwise(text)


def stripped(text: Column) -> Column:
    """:func:`strip` of a long text, which is searched only if there is something at an end of it."""
    edges = F.concat(F.substring(text, 1, 1), F.substring(text, -1, 1))
    kept = F.regexp_extract(text, r"(?sU)\A[\s\x1c-\x1f]*+(.*[^\s\x1c-\x1f])", 1)
    return F.when(edges.rlike(rx(r"[\s\x1c-\x1f]")), kept).otherwise(text)


def blank(text: Column) -> Column:
    """Null or empty, as Python's ``not text``."""
    return F.coalesce(text, F.lit("")) == ""


def item(arr: Column, i: Column | int) -> Column:
    """Element from 0, null outside."""
    return F.get(arr, F.lit(i) if isinstance(i, int) else i)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed, and planned, once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fence(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with columns that the optimiser will not look behind.

    A condition on a computed column is otherwise pushed below its computation, written out again at every
    place that refers to it; over a chain of steps that grows without bound.  Catalyst moves nothing past an
    expression that isn't deterministic, which the partition's number formally isn't.
    """
    return df.withColumns({n: F.when(F.spark_partition_id() >= 0, F.col(n)) for n in names})


def title(word: Column) -> Column:
    return F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substring(word, F.lit(2), F.length(word))))


def matches(text: Column, pattern: str, groups: int, flags: str = "") -> Column:
    """``array<struct<g0, g1, ...>>`` of all matches; an absent group is null.

    The text is searched once; groups are taken from each match by itself.  Sound for patterns that look at no more
    than what is true at the edges of a text too (word boundaries before and behind words, ends, the end of the text).
    """
    one = lambda m: F.struct(F.nullif(m, F.lit("")).alias("g0"), *[first(m, pattern, g, flags).alias(f"g{g}") for g in range(1, groups + 1)])
    return F.transform(every(text, pattern, 0, flags), one)


#: A code point that no text is meant to hold, and that stands for a match for as long as a text is cut.
MARK = "\ufdd0"


def gaps(text: Column, pattern: str, flags: str = "") -> Column:
    """What stands before, between and behind all matches.

    A pattern is compiled once where it is replaced, but for every row where a text is split by it; splitting by one
    character needs no pattern.
    """
    marked = F.split(F.regexp_replace(text, rx(pattern, flags), MARK), MARK, -1)
    return F.when(holds(text, MARK), F.split(text, rx(pattern, flags), -1)).otherwise(marked)


def place(text: Column, pattern: str, flags: str = "") -> Column:
    """Where the first match starts, in code points from 1; 0 without a match.  For patterns that match something."""
    before = sub(text, rf"(?:{pattern})(?s:.*)\z", "", flags)
    return let(before, lambda b: F.when(b != text, F.length(b) + 1).otherwise(0))


def running(sizes: Column) -> Column:
    """For each element the sum of those before it.

    Arrays grow by copies, so sums are made in blocks of about the root of their number: n sqrt(n) copies, not n * n.
    """

    def sums(xs: Column, start: Column) -> Column:
        zero = F.struct(start.cast("long").alias("at"), F.array().cast("array<bigint>").alias("out"))
        step = lambda s, x: F.struct((s["at"] + x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out"))
        return F.aggregate(xs, zero, step, lambda s: s["out"])

    def build(xs: Column) -> Column:
        block = F.greatest(F.ceil(F.sqrt(F.size(xs))), F.lit(1)).cast("int")
        cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / block).cast("int")), lambda j: F.slice(xs, j * block + 1, block))
        return let(cut, lambda blocks: F.flatten(F.zip_with(blocks, sums(F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda s, x: s + x)), F.lit(0)), sums)))

    return F.when(F.size(sizes) == 0, F.array().cast("array<bigint>")).otherwise(let(F.transform(sizes, lambda x: x.cast("long")), build))


def with_starts(text: Column, pattern: str, found: Column, flags: str = "") -> Column:
    """``array<struct<m, at>>``: each of :func:`matches` with the place it starts at (from 1), from the lengths of matches
    and of what stands between them: linear in the text however many there are."""

    def run(all_: Column) -> Column:
        def build(cut: Column) -> Column:
            sizes = F.transform(all_, lambda m, i: F.length(item(cut, i)) + F.length(m["g0"]))
            return let(running(sizes), lambda before: F.transform(all_, lambda m, i: F.struct(m.alias("m"), (item(before, i) + F.length(item(cut, i)) + 1).cast("int").alias("at"))))

        return let(F.when(F.size(all_) > 0, gaps(text, pattern, flags)).otherwise(F.array().cast("array<string>")), build)

    return let(found, run)


#: Characters of a page, see :func:`pages`.
PAGE = 2048


def pages(text: Column) -> Column:
    """``text`` cut into pages of ``PAGE`` code points, so that a window can be taken without counting from the start."""
    return F.when(F.length(text) <= PAGE, F.array(text)).otherwise(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PAGE}}}"), F.lit(0)))


def window(cut: Column, start: Column, stop: Column) -> Column:
    """Code points ``start`` to ``stop`` (from 1, exclusive) of a text in :func:`pages`; at most ``PAGE`` of them."""
    lo = F.greatest(start, F.lit(1)) - 1
    page = F.floor(lo / PAGE).cast("int")
    both = F.concat(F.coalesce(item(cut, page), F.lit("")), F.coalesce(item(cut, page + 1), F.lit("")))
    return F.substring(both, lo - page * PAGE + 1, F.greatest(stop - 1 - lo, F.lit(0)))


def rewrite(text: Column, pattern: str, flags: str, change: Callable[[Column, Column], Column], groups: int = 0, anchor: Column | None = None) -> Column:
    """Replace each match by ``change(match, groups)`` (null: as it was); nothing is looked for where ``anchor`` is false.

    A struct of ``text``, the new text, and ``changed``, an ``array<struct<old, new>>`` of the matches that changed.
    """

    def build(done: Column) -> Column:
        joined = F.array_join(F.flatten(F.zip_with(gaps(text, pattern, flags), done, lambda g, d: F.array(g, F.coalesce(d["new"], F.lit(""))))), "")
        # most matches stay as they are, and so does a text without others
        out = F.when(F.exists(done, lambda d: d["old"] != d["new"]), joined).otherwise(text)
        return F.struct(out.alias("text"), F.filter(done, lambda d: d["old"] != d["new"]).alias("changed"))

    found = matches(text, pattern, groups, flags)
    made = let(F.transform(found, lambda m: F.struct(m["g0"].alias("old"), F.coalesce(change(m["g0"], m), m["g0"]).alias("new"))), build)
    same = F.struct(text.alias("text"), F.array().cast("array<struct<old:string,new:string>>").alias("changed"))
    return made if anchor is None else F.when(anchor, made).otherwise(same)
