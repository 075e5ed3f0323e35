"""Plaintiff and defendant: from party tables, from the caption's text, or from signatures.

Each step adds columns, so that what the next one looks at several times is computed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.functions.regex import every, fence, first, gaps, has, holds, item, let, mentions, strip, sub, sub_if

#: Headers that are no names, labels that are no names.
HEADER = r"MUNICIPAL COURT|FRANKLIN COUNTY|^IN THE"
HEADER_ABOVE = r"MUNICIPAL COURT|FRANKLIN COUNTY|COLUMBUS.*OHIO|^IN THE"
HEADER_INLINE = r"MUNICIPAL COURT|FRANKLIN COUNTY"
LABELS = ("v.", "vs.", "defendant", "defendants", "plaintiff", "plaintiffs", "date")
SIGNATURE = r"<signature>(.*?)</signature>"
#: Wordings of plaintiffs and defendants in running text.
PLAINTIFF_LINE = r"\s*(?:Plaintiff|PLAINTIFF)"
PLAINTIFF_END = r"Plaintiff\s*[,(.]"
PLAINTIFF_AFTER = rf"((?:[A-Z][^\n]*\n){{0,3}}[^\n]*?),?\s*{PLAINTIFF_END}"
PLAINTIFFS = r"([A-Z][A-Za-z\s.,&/]+?)\s*(?:,\s*)?PLAINTIFF\(S\)"
VERSUS_LINE = r"v(?:\.|s|ersus)\s*\.?\s*\n\s*(?:Name:\s*)?([^\n]+)"
VERSUS_NAME = r"(?:v\.|vs\.|versus)\s+([A-Z][A-Za-z\s]+?)(?:\s*,|\s*\n)"
DEFENDANTS = r"(?:v\.|vs\.)\s*\n?\s*([A-Z][A-Za-z\s.,]+?)\s*(?:,\s*)?DEFENDANT\(S\)"
ADDRESS, NAME, DEFENDANT_TAIL = r"Address:.*\z", r"Name:\s*", r"[,\s]*Defendant.*\z"
#: Fixed value: characters from a signature in which its label is looked for.
WINDOW = 200


def _trim_marks(text: Column) -> Column:
    return F.regexp_replace(text, r"[,.:]+\z", "")


def _labelled(cells: Column, p: Column, d: Column) -> Column:
    """Names in cells that hold a name, a break and a label, as a struct (``p``, ``d``)."""
    parts = F.transform(F.filter(cells, lambda c: F.contains(c, F.lit("<br>"))), lambda c: F.split(sub(c, SIGNATURE), "<br>"))
    named = F.filter(
        F.transform(parts, lambda x: F.struct(strip(item(x, 0)).alias("name"), F.lower(_trim_marks(strip(item(x, 1)))).alias("label"))),
        lambda x: (F.length(x["name"]) >= 2) & ~has(x["name"], HEADER, "i"),
    )
    is_p = lambda x: F.contains(x["label"], F.lit("plaintiff"))
    is_d = lambda x: F.contains(x["label"], F.lit("defendant"))

    def pick(all_: Column) -> Column:
        # a cell that gives the plaintiff isn't looked at for the defendant
        one = lambda first_p: F.struct(
            F.coalesce(p, first_p["name"]).alias("p"),
            F.coalesce(d, item(F.filter(all_, lambda x: is_d(x) & ~(is_p(x) & p.isNull() & (x == first_p))), 0)["name"]).alias("d"))
        return let(item(F.filter(all_, is_p), 0), one)

    return let(named, pick)


def _above(cells: Column, label: str, refuse) -> Column:
    """The nearest acceptable cell before the first cell that begins with ``label`` and has one."""
    ok = lambda c: (
        (F.length(c) > 1) & ~_trim_marks(F.lower(c)).isin(*LABELS) & ~F.startswith(F.upper(c), F.lit("CASE"))
        & ~has(c, r"\A\d{1,2}[/-]\d{1,2}[/-]\d{2,4}\n?\z") & ~refuse(c)
    )
    told = F.transform(cells, lambda c, i: F.struct(i.alias("i"), c.alias("c"), F.startswith(F.lower(_trim_marks(c)), F.lit(label)).alias("label"), ok(c).alias("ok")))

    def pick(all_: Column) -> Column:
        nearest = lambda x: item(F.reverse(F.filter(all_, lambda y: y["ok"] & (y["i"] < x["i"]))), 0)["c"]
        return item(F.filter(F.transform(F.filter(all_, lambda x: x["label"]), nearest), lambda n: n.isNotNull()), 0)

    return let(told, pick)


def _block_above(text: Column) -> Column:
    """The lines above the first line that begins with the plaintiff's label and has any: each begins with a capital,
    the first from its first capital on.

    The text is cut before each such line, and of each piece all up to its last line of another kind goes, by
    patterns that run over single characters only, so no length of block exhausts the stack.
    """

    def block(piece: Column) -> Column:
        ended = sub(piece, r"\n\s*,?\s*\z")
        return first(sub(ended, r"\A.*\n(?![A-Z][^\n])", "", "s"), r"[A-Z][^\n].*\z", 0, "s")

    pieces = gaps(text, rf"\n(?={PLAINTIFF_LINE})")
    return let(pieces, lambda x: item(F.filter(F.transform(F.slice(x, F.lit(1), F.size(x) - 1), lambda p: let(p, block)), lambda b: b.isNotNull()), 0))


def _signed(sigs: Column, text: Column, want: str, other: str) -> Column:
    """The first signature whose label, in the text from it on, is ``want`` before ``other``."""

    def fits(s: Column) -> Column:
        at = F.instr(text, F.concat(F.lit("<signature>"), s, F.lit("</signature>")))
        after = F.lower(F.substring(text, at, F.lit(WINDOW)))
        a, b = F.instr(after, want), F.instr(after, other)
        return (F.length(strip(s)) > 1) & (at > 0) & (a > 0) & ((b == 0) | (a < b))

    return strip(item(F.filter(sigs, fits), 0))


def parties(df: DataFrame, text_col: str = "cleaned_text") -> DataFrame:
    """``df`` with ``plaintiff`` and ``defendant``."""
    text = F.col(text_col)
    plain = text
    for tag in ("page_number", "watermark", "img"):
        plain = sub_if(holds(text, f"<{tag}>"), plain, rf"<{tag}>.*?</{tag}>")
    # what is cut above can bring a mark together, so these are looked for in what is left of it
    plain = let(plain, lambda t: sub_if(has(t, r"[mM]\d"), t, r"^\s*[mM]\d+\s*$", "", "m"))
    plain = let(plain, lambda t: sub_if(holds(t, "PAGE"), t, r"^=+\s*PAGE\s+\d+\s*=+\s*$", "", "m"))
    out = df.withColumn("_plain", plain)
    cells = lambda k: F.transform(F.flatten(F.transform(every(item(F.when(holds(F.col("_plain"), "<table>"), every(F.col("_plain"), r"<table>(.*?)</table>", 1, "s")).otherwise(F.array().cast("array<string>")), k), r"<tr>(.*?)</tr>", 1, "s"), lambda r: every(r, r"<td>(.*?)</td>", 1, "s"))), lambda c: strip(sub(c, SIGNATURE)))
    out = out.withColumns({
        "_sigs": F.when(holds(F.col("_plain"), "<signature>") | F.col("_plain").isNull(), every(F.col("_plain"), SIGNATURE, 1)).otherwise(F.array().cast("array<string>")),
        "_bare": F.when(holds(F.col("_plain"), "<"), sub(sub(F.col("_plain"), SIGNATURE), r"</?u>")).otherwise(F.col("_plain")),
        "_cells0": cells(0), "_cells1": cells(1),
        "_p": F.lit(None).cast("string"), "_d": F.lit(None).cast("string"),
    })
    for k in (0, 1):
        c, p, d = F.col(f"_cells{k}"), F.col("_p"), F.col("_d")
        out = out.withColumn("_pd", _labelled(c, p, d)).withColumns({"_p": F.col("_pd.p"), "_d": F.col("_pd.d")})
        out = out.withColumns({
            "_p": F.coalesce(p, _above(c, "plaintiff", lambda x: has(x, HEADER, "i"))),
            "_d": F.coalesce(d, _above(c, "defendant", lambda x: has(x, r"\Adate\n?\z", "i"))),
        })
    bare = F.col("_bare")
    some = lambda word, x: F.when(mentions(bare, word), x)
    squeeze = lambda x: sub(x, r"\s+", " ")
    m1 = squeeze(strip(_block_above(bare)))
    # these two try every start of a line or a run, so they are looked for only where what ends each match stands
    m2 = squeeze(sub(strip(first(F.when(has(bare, PLAINTIFF_END, "i"), bare), PLAINTIFF_AFTER, 1, "i")), r"\n", " "))
    m3 = strip(first(F.when(mentions(bare, "plaintiff(s)"), bare), PLAINTIFFS, 1, "i"))
    keep = lambda name, header: let(name, lambda x: F.when(~has(x, header, "i") & (x != ""), x))
    v = lambda p, f: F.when(mentions(bare, "v"), first(bare, p, 1, f))
    d1 = strip(v(VERSUS_LINE, "i"))
    d1 = strip(squeeze(sub(sub(sub(d1, ADDRESS, "", "i"), NAME), DEFENDANT_TAIL, "", "i")))
    d2 = sub(strip(v(VERSUS_NAME, "i")), DEFENDANT_TAIL, "", "i")
    d3 = strip(v(DEFENDANTS, "is"))
    long_ = lambda name: let(name, lambda x: F.when(F.length(x) > 1, x))
    out = out.withColumns({
        "_p": F.coalesce(F.col("_p"), some("plaintiff", F.coalesce(keep(m1, HEADER_ABOVE), keep(m2, HEADER), keep(m3, HEADER_INLINE))), _signed(F.col("_sigs"), text, "plaintiff", "defendant")),
        "_d": F.coalesce(F.col("_d"), long_(d1), long_(d2), some("defendant", d3), _signed(F.col("_sigs"), text, "defendant", "plaintiff")),
    })
    p = sub(sub(strip(sub(F.col("_p"), r"<[^>]+>")), r"\s*[:/]\s*\z"), r",\s*\z")
    d = sub(sub(strip(sub(F.col("_d"), r"<[^>]+>")), r"\s*[,.]\z"), r"\A\(.*?\)\s*")
    out = out.withColumns({"_p": p, "_d": d})
    fits = lambda c: F.length(c).between(2, 100)
    out = out.withColumns({
        "plaintiff": F.when(fits(F.col("_p")) & ~F.startswith(F.lower("_p"), F.lit("defendant")), F.col("_p")),
        "defendant": F.when(fits(F.col("_d")) & ~has(F.col("_d"), r"\ADefendants?\n?\z", "i"), F.col("_d")),
    })
    return fence(out, "plaintiff", "defendant").drop("_plain", "_sigs", "_bare", "_cells0", "_cells1", "_p", "_d", "_pd")
