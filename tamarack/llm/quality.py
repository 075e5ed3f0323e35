"""Quality rules as weak supervision (DataFrame operations only).

Each rule looks at a few counts of a document and votes good (1), bad (-1) or abstains (0).  How far
each rule can be trusted is not set by hand: expectation-maximisation over the votes estimates, for
each rule, how often it votes bad on bad and on good documents, and the posterior probability that a
document is good replaces the test that every rule must pass.

The votes of all documents are counted by pattern (at most 2 * 3^rules patterns, combined before the
shuffle), so the estimation works on a table of bounded size whatever the corpus is; it is one Spark
expression over that table, and the decision for each pattern is joined back.

Defined results: null text has no words and fails the base test; an empty table gives an empty result;
extra columns stay; repeated rows are judged alike.  With fewer than two distinct patterns the
estimation keeps its starting values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.llm.common import materialize, uses, words

#: Characters that count as symbols.
SYMBOLS = "[#*$%&|<>]"
ROUNDS = 40
THRESHOLD = 0.5
#: Fixed value: the highest rate of false alarms that is estimated for a rule.
MOST_FALSE = 0.3
#: Sentence ends before white space, and those of scripts that need none behind them.
ENDS = "[.!?\u061f\u06d4](?=[ \\t-\\r]|$)"
#: The range in front is one test for characters of Latin texts, the class is thirteen.
OTHER_ENDS = "(?=[\u0589-\uff61])[\u0964\u0965\u3002\uff01\uff1f\uff61\u0589\u1362\u1367\u104b\u17d4\u17d5\u0f0d]"
#: The low bits of a packed window hold its place; longer texts take the exact path for every window.
PLACE_BITS = 24


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _neighbours(arr: str, key) -> Column:
    """Elements of the sorted array column ``arr`` that share their key with the one before or after."""
    return F.filter(F.col(arr), lambda x, k: ((k > 0) & (key(F.get(arr, k - 1)) == key(x))) | (key(F.get(arr, k + 1)) == key(x)))


def features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts the rules look at, each named ``_tmk_...``.

    Words in repeated 3-word windows: windows are hashed; where a hash occurs twice, hashes are packed with their
    place into one number and sorted, and windows whose hash repeats are compared as texts, so the count is exact.
    Names that begin with ``_tmk_`` are the operator's own here and in :func:`judge`; :func:`keep_good` takes any.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.withColumns({
        "_tmk_w": words(F.col(text_col)),
        "_tmk_l": F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \\t-\\r]")),
        "_tmk_symbols": _count(text, SYMBOLS + "+").cast("long"),
        "_tmk_upper": _count(text, "\\p{Lu}+").cast("long"),
        "_tmk_alnum": _count(text, "[\\p{L}\\p{M}\\p{N}]+").cast("long"),
        "_tmk_bangs": _count(text, "!+").cast("long"),
        # one class of characters each: a choice between patterns would be tried at every character
        "_tmk_ends": (_count(text, ENDS) + _count(text, OTHER_ENDS)).cast("long"),
    })
    n = F.size("_tmk_w")
    mask = (1 << PLACE_BITS) - 1
    place = F.sequence(F.lit(0), n - 3)
    triple = lambda i: (F.get("_tmk_w", i), F.get("_tmk_w", i + 1), F.get("_tmk_w", i + 2))
    df = df.withColumn("_tmk_x", F.when((n >= 4) & (n <= mask), F.transform(place, lambda i: F.xxhash64(*triple(i)))).otherwise(F.array().cast("array<bigint>")))
    # most texts repeat no window, which their hashes tell at once; only the others are sorted
    packed = F.sort_array(F.transform("_tmk_x", lambda h, i: h.bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long"))))
    df = df.withColumn("_tmk_p", F.when(F.size(F.array_distinct("_tmk_x")) < F.size("_tmk_x"), packed).otherwise(F.array().cast("array<bigint>")))
    twice = F.transform(_neighbours("_tmk_p", lambda x: F.shiftright(x, PLACE_BITS)), lambda x: x.bitwiseAND(F.lit(mask)).cast("int"))
    df = df.withColumn("_tmk_c", F.when(n <= mask, twice).otherwise(place))
    df = df.withColumn("_tmk_t", F.sort_array(F.transform("_tmk_c", lambda i: F.struct(F.concat_ws(" ", *triple(i)).alias("k"), i.alias("i")))))
    same = _neighbours("_tmk_t", lambda x: x["k"])
    covered = F.array_distinct(F.flatten(F.transform(same, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    df = df.withColumns({
        "_tmk_words": n.cast("long"),
        "_tmk_chars": F.length(F.array_join("_tmk_w", "")).cast("long"),
        "_tmk_lines": F.size("_tmk_l").cast("long"),
        "_tmk_dups": (F.size("_tmk_l") - F.size(F.array_distinct("_tmk_l"))).cast("long"),
        "_tmk_repeats": F.size(covered).cast("long"),
    })
    return df.drop("_tmk_w", "_tmk_l", "_tmk_x", "_tmk_p", "_tmk_c", "_tmk_t")


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes() -> list[Column]:
    """The rules, over the columns of :func:`features`; n is never zero where a share is taken of it."""
    n, chars = F.col("_tmk_words"), F.col("_tmk_chars")
    share = lambda c, pct: 100 * F.col(c) > pct * n
    return [
        _vote(share("_tmk_symbols", 15), ~share("_tmk_symbols", 4)),
        _vote(100 * F.col("_tmk_upper") > 40 * chars, 100 * F.col("_tmk_upper") < 15 * chars),
        _vote(share("_tmk_bangs", 20), ~share("_tmk_bangs", 5)),
        _vote(share("_tmk_repeats", 35), ~share("_tmk_repeats", 15)),
        _vote(100 * F.col("_tmk_dups") > 40 * F.col("_tmk_lines"), 100 * F.col("_tmk_dups") <= 20 * F.col("_tmk_lines")),
        _vote((chars < 2 * n) | (chars > 15 * n), (chars >= 3 * n) & (chars <= 11 * n)),
        _vote(100 * F.col("_tmk_alnum") < 88 * chars, 100 * F.col("_tmk_alnum") > 92 * chars),
        _vote(200 * F.col("_tmk_ends") < n, 100 * F.col("_tmk_ends") > n),
    ]


def base_failed() -> Column:
    n = F.col("_tmk_words")
    return (n < 50) | (100 * F.col("_tmk_repeats") > 50 * n)


def with_pattern(df: DataFrame) -> DataFrame:
    """``df`` with ``_tmk_pattern``: whether the base test failed, then the votes, as text."""
    return df.withColumn("_tmk_pattern", F.concat_ws(",", F.when(base_failed(), "f").otherwise("p"), *[v.cast("string") for v in votes()]))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def estimate(patterns: DataFrame, n_rules: int, rounds: int = ROUNDS) -> DataFrame:
    """From (``_tmk_pattern``, ``_tmk_n``): ``_tmk_pattern`` and ``_tmk_good``, the posterior that it is good.

    State: p, the share of bad documents, and for each rule b and g, how often it votes bad on bad and on
    good documents.  Priors bound them: p is from 0.01 to 0.5, as most documents are taken to be good; b from 0.05 to
    0.98; g from 0.0002 to ``MOST_FALSE`` and never above b, so a rule that clean documents trip often loses its weight.
    """
    rules = F.sequence(F.lit(0), F.lit(n_rules - 1))
    item = F.struct(
        F.col("_tmk_pattern").alias("key"),
        F.transform(F.slice(F.split("_tmk_pattern", ","), 2, n_rules), lambda x: x.cast("int")).alias("v"),
        F.col("_tmk_n").cast("double").alias("n"),
    )
    one = patterns.agg(F.sort_array(F.collect_list(item)).alias("xs"))
    clip = lambda x, lo, hi: F.greatest(F.lit(lo), F.least(hi if isinstance(hi, Column) else F.lit(hi), x))

    def bad(s: Column, x: Column) -> Column:
        def step(acc: Column, j: Column) -> Column:
            v, b, g = F.get(x["v"], j), F.get(s["b"], j), F.get(s["g"], j)
            return acc + F.when(v == -1, F.log(b / g)).when(v == 1, F.log((1 - b) / (1 - g))).otherwise(0.0)

        odds = F.aggregate(rules, F.log(s["p"] / (1 - s["p"])), step)
        return 1 / (1 + F.exp(-odds))

    total = lambda xs, f: F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + f(x))

    def again(s: Column, _: Column) -> Column:
        posterior = F.transform("xs", lambda x: F.struct(x["v"].alias("v"), (x["n"] * bad(s, x)).alias("b"), (x["n"] * (1 - bad(s, x))).alias("g")))

        def update(ps: Column) -> Column:
            # one pseudo-document of each vote keeps rates off 0 and 1
            rate = lambda f, j: (total(ps, lambda x: F.when(F.get(x["v"], j) == -1, x[f]).otherwise(0.0)) + 1.0) / (total(ps, lambda x: F.when(F.get(x["v"], j) != 0, x[f]).otherwise(0.0)) + 2.0)
            nb, ng = total(ps, lambda x: x["b"]), total(ps, lambda x: x["g"])
            return _let(F.transform(rules, lambda j: clip(rate("b", j), 0.05, 0.98)), lambda b: F.struct(
                clip((nb + 1.0) / (nb + ng + 10.0), 0.01, 0.5).alias("p"),
                b.alias("b"),
                F.transform(rules, lambda j: clip(rate("g", j), 0.0002, F.least(F.lit(MOST_FALSE), F.get(b, j)))).alias("g"),
            ))

        return _let(posterior, update)

    start = F.struct(F.lit(0.1).alias("p"), F.array_repeat(F.lit(0.5), n_rules).alias("b"), F.array_repeat(F.lit(0.001), n_rules).alias("g"))
    fitted = one.select("xs", F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, again).alias("s"))
    return fitted.select("s", F.explode("xs").alias("x")).select(F.col("x")["key"].alias("_tmk_pattern"), (1 - bad(F.col("s"), F.col("x"))).alias("_tmk_good"))


def judge(featured: DataFrame, counted: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``featured`` (with its pattern) joined with ``_tmk_base_failed``, ``_tmk_good`` and ``_tmk_kept``.

    The joined side has a row for each pattern, at most 2 * 3^8 = 13,122 of them, so it is broadcast.  It is
    written first: as a plain table, no condition on it is carried over to the expressions behind the pattern.
    """
    n_rules = len(votes())
    counts = (counted if counted is not None else featured).groupBy("_tmk_pattern").agg(F.count(F.lit(1)).alias("_tmk_n"))
    verdict = estimate(counts, n_rules).select(
        F.col("_tmk_pattern"), F.col("_tmk_good"),
        F.startswith("_tmk_pattern", F.lit("f")).alias("_tmk_base_failed"),
        (F.startswith("_tmk_pattern", F.lit("p")) & (F.col("_tmk_good") >= threshold)).alias("_tmk_kept"),
    )
    verdict = materialize(verdict)
    return uses(featured.join(F.broadcast(verdict), "_tmk_pattern"), verdict)


def keep_good(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that pass the base test and are more likely good than not.

    The rows are written once with their votes, so the rules run over each text once.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    voted = materialize(with_pattern(features(rows)).select("row", "_tmk_pattern"))
    judged = judge(voted, threshold=threshold)
    return uses(judged.where("_tmk_kept").select("row.*"), voted, *judged._tamarack_uses)
