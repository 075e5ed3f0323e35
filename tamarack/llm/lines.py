"""Line dedup by site-relative frequency (DataFrame operations only).

Pages are grouped by host.  A line's ratio is the number of the host's pages that hold it divided by the
host's pages; a line above ``ratio`` on at least ``least`` pages is boilerplate, and every occurrence of
it on that host goes.  Lines end at line feeds; lines without a word are never dropped; case and
spaces count.

Counting moves a 128-bit hash for each distinct line of a page, combined before the shuffle, never texts.
A host has at most (mean distinct lines of a page / ratio) boilerplate lines, so they fit in one array for
each host; that table is broadcast when its measured size is below ``BROADCAST_BYTES`` and joined on
salted hosts otherwise, which spreads a host with a third of all pages.

Defined results: null text stays null and has no lines; a null host is a host of its own; a page that
loses all its lines has an empty text and stays; repeated rows are pages of their own; ties don't arise;
an empty table gives an empty result; other columns stay, whatever their names and types.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.llm.common import materialize, uses

RATIO, LEAST = 0.1, 5
BROADCAST_BYTES, SALTS = 32 << 20, 64


def url_host(url: Column) -> Column:
    """The host of a URL, lower case; null if it has none."""
    return F.lower(F.parse_url(url, F.lit("HOST")))


def _hash(line: Column) -> Column:
    return F.unhex(F.md5(line))


def boilerplate(pages: DataFrame, ratio: float = RATIO, least: int = LEAST) -> DataFrame:
    """(``host``, ``gone``): the hashes of each host's boilerplate lines, from (``host``, ``text``)."""
    lines = F.array_distinct(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike("[^ \\t-\\r]")))
    hosts = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    held = pages.select("host", F.explode(F.transform(lines, _hash)).alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    # frequent lines of a host are spread over salts, to each of which the host's total goes
    salted = held.where(F.col("n") >= least).withColumn("salt", F.pmod(F.xxhash64("line"), F.lit(SALTS)).cast("int"))
    often = salted.join(hosts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["host", "salt"]).where(F.col("n") > ratio * F.col("pages"))
    return often.groupBy("host").agg(F.collect_list("line").alias("gone"))


def drop_boilerplate(pages: DataFrame, text_col: str = "text", host_col: str = "source", ratio: float = RATIO, least: int = LEAST, count_col: str | None = None) -> DataFrame:
    """``pages`` with boilerplate lines gone from its text, and ``count_col``, if named, how many went from each page."""
    if count_col in pages.columns:
        raise ValueError(f"there is a column {count_col} already")
    host = F.coalesce(F.concat(F.lit("1"), F.col(f"`{host_col}`")), F.lit("2"))
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), host.alias("host"), F.col(f"`{text_col}`").alias("text"))
    gone = materialize(boilerplate(rows.select("host", "text"), ratio, least))
    size = gone.agg(F.sum(F.size("gone") * 16 + F.length("host"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        out = rows.join(F.broadcast(gone), "host", "left")
    else:
        # a salt of all columns that can be hashed, so that copies of one page are spread by their ids; it is the same in every attempt
        known = [F.col("row")[c] for c, kind in pages.dtypes if "map<" not in kind and "variant" not in kind]
        salted = rows.withColumn("salt", F.pmod(F.xxhash64(*known), F.lit(SALTS)).cast("int"))
        out = salted.join(gone.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["host", "salt"], "left")
    every = F.split("text", "\n")
    out = out.withColumn("kept", F.when(F.col("gone").isNull(), every).otherwise(F.filter(every, lambda x: ~F.array_contains("gone", _hash(x)))))
    cols = [(F.array_join("kept", "\n") if c == text_col else F.col("row")[c]).alias(c) for c in pages.columns]
    count = [F.coalesce(F.size(every) - F.size("kept"), F.lit(0)).cast("long").alias(count_col)] if count_col else []
    return uses(out.select(*cols, *count), gone)
