"""How much the sources of a language differ in their words: a two-pass vocabulary automaton and sparse postings.

First pass: exact document frequencies.  Each task counts, by language, the documents that hold a term, in a table of
bounded size that it empties into the shuffle when full; terms in ``LEAST_DOCS`` documents or more are kept.

Second pass: occurrences.  Texts are reduced to terms and single-byte delimiters, and an Aho-Corasick automaton of the
kept terms, each between two delimiters, finds every occurrence, so a term never matches inside another.  The automaton is
built once a worker from the broadcast terms.  ``SHARD`` bounds their bytes: a larger vocabulary is cut into shards by
hash, and texts are gone over once for each, only those of the shard's languages where these are few.

What the automaton counts are postings (language, term, source, count), none where a source lacks a term.  A term's share
of a group is 1 + floor(SCALE * (count + SMOOTH) / (all + SMOOTH * terms)), exactly, so an absent term has the same share
``p0`` throughout a group, and the distance of sources g and h is

    sum over g's postings of |p - p0(h)|, over h's of |p - p0(g)|, (terms - postings of g - postings of h) * |p0(g) - p0(h)|,
    and over terms of both |p(g) - p(h)| - |p(g) - p0(h)| - |p(h) - p0(g)| + |p0(g) - p0(h)|.

The first sums need each source's postings by value only (equal shares counted together) against the sources of its
language; the last works on a term's postings inside tasks and leaves them added up by pair, so no pair of postings
is ever a row.

Defined results: null text, language and source are empty strings; terms are cut and lowered by their ASCII characters only;
rows are documents, whether ids are null or repeat; a language that keeps no term has distances of 0 and no terms; ties
are ranked by name; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamarack.llm.common import discard, materialize, ship, uses

LEAST_DOCS, SMOOTH, SCALE, TOP = 30, 5, 1_000_000_000, 50
#: Bytes of kept terms in one automaton (about 100 bytes of memory each), entries of a counting table, cells of a step.
SHARD, HELD, STEP = 4 << 20, 400_000, 1 << 19
#: Most languages of a shard that texts are chosen by.
FEW = 500
#: Letters A to Z lowered; other bytes of ASCII but a to z are delimiters; the rest belongs to other scripts.
_PLAIN = bytes(c if c >= 128 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


def _frequencies(rows: DataFrame) -> DataFrame:
    """(``lang``, ``term``, ``n``) to be added up: documents of a language that hold a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def told() -> Iterator[pa.RecordBatch]:
            for lang, c in held.items():
                if c:
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c)), pa.array(list(c), pa.binary()).cast(pa.string()), pa.array(list(c.values()), pa.int64())], ["lang", "term", "n"])
            held.clear()

        for b in batches:
            for k, (lang, text) in enumerate(zip(b.column("lang").to_pylist(), b.column("text").cast(pa.binary()))):
                held.setdefault(lang, Counter()).update(set(terms(text.as_py())))
                if k % 64 == 0 and sum(map(len, held.values())) > HELD:
                    yield from told()
        yield from told()

    return rows.select("lang", "text").mapInArrow(run, "lang string, term string, n long")


def vocabulary(rows: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """(``lang``, ``term``) of terms in at least ``least`` documents of their language; ``rows`` has no nulls."""
    return _frequencies(rows).groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("lang", "term")


def _occurrences(rows: DataFrame, kept: dict[str, list[str]]) -> DataFrame:
    """(``lang``, ``source``, ``term``, ``n``) to be added up: occurrences of the ``kept`` terms of each language."""
    shared = rows.sparkSession.sparkContext.broadcast(kept)  # at most SHARD bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        known: dict[str, ahocorasick.Automaton | None] = {}
        held: dict[tuple[str, str], Counter] = {}

        def automaton(lang: str) -> ahocorasick.Automaton | None:
            if lang not in known:
                found = shared.value.get(lang)
                known[lang] = made = ahocorasick.Automaton() if found else None
                for k, t in enumerate(found or ()):  # bytes as characters, a delimiter on both sides
                    made.add_word(f" {t.encode().decode('latin-1')} ", k)
                if found:
                    made.make_automaton()
            return known[lang]

        def told() -> Iterator[pa.RecordBatch]:
            for (lang, source), c in held.items():
                own = shared.value[lang]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c)), pa.array([source] * len(c)), pa.array([own[k] for k in c]), pa.array(list(c.values()), pa.int64())], ["lang", "source", "term", "n"])
            held.clear()

        for b in batches:
            for k, (lang, source, text) in enumerate(zip(b.column("lang").to_pylist(), b.column("source").to_pylist(), b.column("text").cast(pa.binary()))):
                if (found := automaton(lang)) is not None:
                    line = f" {text.as_py().translate(_PLAIN).decode('latin-1')} "
                    hits = [v for _, v in found.iter(line)]
                    if hits:
                        held.setdefault((lang, source), Counter()).update(hits)
                if k % 64 == 0 and sum(map(len, held.values())) > HELD:
                    yield from told()
        yield from told()

    return rows.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, n long")


def postings(rows: DataFrame, kept: DataFrame, shard: int | None = None) -> DataFrame:
    """(``lang``, ``source``, ``term``, ``n``): how often each kept term stands in the texts of a source."""
    size = kept.agg(F.sum(F.octet_length("term") + 2)).first()[0] or 0
    shards = max(1, -(-size // (shard or SHARD)))
    out = None
    for k in range(shards):
        mine: dict[str, list[str]] = {}
        for r in kept.where(F.pmod(F.xxhash64("lang", "term"), F.lit(shards)) == k).collect():
            mine.setdefault(r.lang, []).append(r.term)
        own = rows.where(F.col("lang").isin([*mine])) if len(mine) <= FEW else rows
        found = _occurrences(own, mine)
        out = found if out is None else out.unionByName(found)
    return out.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))


def _share(count: str, of: str) -> F.Column:
    """The smoothed share of a count, in parts of ``SCALE``; exact."""
    return F.expr(f"1 + (cast({count} + {SMOOTH} as decimal(20,0)) * {SCALE}) div (cast({of} as decimal(20,0)) + {SMOOTH} * cast(terms as decimal(20,0)))")


def _single(key, ours: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
    """For a source, the sum of |share - p0| over its postings for each other source of its language, without the part
    of |p0 - p0| that stands for all terms."""
    p, n = (ours[c].to_numpy(np.int64) for c in ("p", "n"))
    order = np.argsort(p)
    p, n = p[order], n[order]
    below, sums = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(n * p)])
    x, own = others["other_p0"].to_numpy(np.int64), others["p0"].to_numpy(np.int64)
    k = np.searchsorted(p, x)
    value = x * below[k] - sums[k] + (sums[-1] - sums[k]) - x * (below[-1] - below[k]) - below[-1] * np.abs(x - own)
    return pd.DataFrame({"lang": others["lang"], "a": others["a"], "b": others["b"], "part": value})


def _joint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For pairs of sources, what terms of both add; a row of the input has all postings of a term, by source."""
    for b in batches:
        lang, index = b.column("lang").dictionary_encode(), b.column("postings")
        code, names = lang.indices.to_numpy(), lang.dictionary
        place = index.offsets.to_numpy()
        flat = index.values
        at, p, p0 = (flat.field(k).to_numpy() for k in range(3))
        size, wide = np.diff(place), int(at.max(initial=0)) + 1
        for k in np.unique(size[size > 1]):
            rows = np.flatnonzero(size == k)
            step = max(1, STEP // int(k * k))
            for lo in range(0, len(rows), step):
                part = rows[lo : lo + step]
                cell = place[part][:, None] + np.arange(k)
                for i in range(0, int(k), max(1, STEP // int(k * len(part)))):
                    some = slice(i, i + max(1, STEP // int(k * len(part))))
                    s, x, x0 = at[cell], p[cell], p0[cell]
                    a, y, y0 = (v[:, some, None] for v in (s, x, x0))
                    s, x, x0 = (v[:, None, :] for v in (s, x, x0))
                    value = np.abs(y - x) - np.abs(y - x0) - np.abs(x - y0) + np.abs(y0 - x0)
                    lower = np.broadcast_to(a < s, value.shape)
                    key = ((code[part].astype(np.int64)[:, None, None] * wide + a) * wide + s)[lower]
                    if not len(key):
                        continue
                    key, where = np.unique(key, return_inverse=True)
                    total = np.zeros(len(key), np.int64)
                    np.add.at(total, where, value[lower])
                    columns = [names.take(pa.array(key // wide**2)), *(pa.array(x) for x in (key // wide % wide, key % wide, total))]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "a", "b", "part"])


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank`` for each (language, source).

    Part ``pair``: every other source of the language by its distance, the sum of differences of all kept terms' shares.
    Part ``term``: the ``top`` terms that the source holds and whose share exceeds the language's most.
    """
    ship(docs.sparkSession)
    rows = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for n, c in (("text", text_col), ("lang", lang_col), ("source", source_col))])
    kept = materialize(vocabulary(rows, least))
    found = materialize(postings(rows, kept))
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    groups = rows.select("lang", "source").distinct().join(sizes, "lang", "left").join(found.groupBy("lang", "source").agg(F.sum("n").alias("words")), ["lang", "source"], "left")
    groups = groups.na.fill(0, ["terms", "words"])
    index = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long")
    groups = materialize(groups.withColumns({"at": index, "p0": F.when(F.col("terms") > 0, _share("0", "words")).otherwise(0)}))
    discard(kept)
    shares = found.join(groups, ["lang", "source"]).select("lang", "source", "term", "terms", "n", "at", "p0", _share("n", "words").alias("p"))
    shares = materialize(shares)
    whole = shares.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.first("terms").alias("terms"))
    whole = whole.join(found.groupBy("lang").agg(F.sum("n").alias("words")), "lang").select("lang", "term", _share("n", "words").alias("q"))
    over = shares.join(whole, ["lang", "term"]).where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    over = over.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)

    # every two sources of a language, the lower first; then what postings add
    one = groups.select("lang", "terms", F.col("at").alias("a"), F.col("source").alias("source_a"), F.col("p0").alias("p0_a"))
    two = groups.select("lang", F.col("at").alias("b"), F.col("source").alias("source_b"), F.col("p0").alias("p0_b"))
    pairs = one.join(two, "lang").where("a < b")
    values = shares.groupBy("lang", F.col("at").alias("g"), "p").agg(F.count(F.lit(1)).alias("n"))
    both = [pairs.select("lang", "a", "b", F.col(x).alias("g"), F.col(f"p0_{x}").alias("p0"), F.col(f"p0_{y}").alias("other_p0")) for x, y in ("ab", "ba")]
    kind = "lang string, a long, b long, part long"
    single = values.groupBy("lang", "g").cogroup(both[0].unionByName(both[1]).groupBy("lang", "g")).applyInPandas(_single, kind)
    held = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("at", "p", "p0")).alias("postings"))
    joint = held.where(F.size("postings") > 1).mapInArrow(_joint, kind)
    added = single.unionByName(joint).groupBy("lang", "a", "b").agg(F.sum("part").alias("part"))
    value = F.col("terms") * F.abs(F.col("p0_a") - F.col("p0_b")) + F.coalesce("part", F.lit(0))
    told = materialize(pairs.join(added, ["lang", "a", "b"], "left").select("lang", "source_a", "source_b", value.alias("value")))
    told = uses(told.select("lang", F.col("source_a").alias("source"), F.col("source_b").alias("item"), "value").unionByName(
        told.select("lang", F.col("source_b").alias("source"), F.col("source_a").alias("item"), "value")), told)
    told_ranked = told.withColumn("rank", F.row_number().over(ranked))
    columns = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank"))
    return uses(columns(told_ranked, "pair").unionByName(columns(over, "term")), *told._tamarack_uses, shares, found, groups)
