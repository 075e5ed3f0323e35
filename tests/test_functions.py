import datetime
import random
import re
import time

from pyspark.sql import functions as F

from tamarack.functions import dates, numbers, regex

DAY = datetime.date(2026, 11, 26)


def test_normalize_date(spark):
    cases = {
        "1/22/2024": "2024-01-22", "2-8-24": "2024-02-08", "7.5.2024": "2024-07-05", "13/5/2024": "2024-05-13", "1/2/75": "2075-01-02", "1/2/76": "1976-01-02",
        "2/30/2024": "2024-02-30", "30/13/2024": "2024-30-13", "0/5/2024": "2024-00-05", "1/32/2024": "2024-01-32", "February 30, 2024": "February 30, 2024",
        "2024 JAN 22": "2024-01-22", "2024 JAN 22, PM 3:42": "2024-01-22", "JAN 22 2024": "2024-01-22", "May 1st, 2024": "2024-05-01", "5/5/024": "24-05-05", "1/22/202": "202-01-22",
        "immediately 5, 2024": "2024-05-26", "of 15 2024": "of 15 2024", "June 5/ 2024": "2024-06-05",
        "2024 Jan 22 PM 13:42": "2024-01-26", "1/22/2024 by 5:00 PM": "2024-01-22", "January 22, 2024": "2024-01-22", "": None, None: None,
    }
    rows = spark.createDataFrame([(k, v) for k, v in cases.items()], "s string, want string")
    for r in rows.withColumn("got", dates.normalize_date(F.col("s"), F.lit(DAY))).collect():
        assert r.got == r.want, r


def test_month_with_slash_is_no_date(spark):
    got = spark.range(1).select(dates.normalize_date(F.lit("Jan/ 5, 2024"), F.lit(DAY)).alias("x")).first().x
    assert got == "Jan/ 5, 2024"


def test_round2_is_python_round(spark):
    rnd = random.Random(3)
    xs = [k / 1000 for k in range(1001)] + [sum(rnd.choice([0.1, 0.15, 0.25, 0.05, 0.2]) * rnd.random() for _ in range(4)) for _ in range(2000)] + [1 / 8, 0.845, 0.675]
    for r in spark.createDataFrame([(x,) for x in xs], "x double").withColumn("y", numbers.round2(F.col("x"))).collect():
        assert r.y == round(r.x, 2), r.x


def test_rewrite_and_places(spark):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("ab1 $.") for _ in range(rnd.randint(0, 30))) for _ in range(300)]
    df = spark.createDataFrame([(x,) for x in texts], "t string")
    out = df.select("t", regex.rewrite(F.col("t"), r"\$[\w.]+", "", lambda m, _: F.upper(m)).alias("r"), regex.with_starts(F.col("t"), r"a(b)?1*", regex.matches(F.col("t"), r"a(b)?1*", 1)).alias("w")).collect()
    for r in out:
        assert r.r.text == re.sub(r"\$[\w.]+", lambda m: m[0].upper(), r.t)
        assert [(x.m.g0, x.m.g1, x["at"] - 1) for x in r.w] == [(m[0], m[1], m.start()) for m in re.finditer(r"a(b)?1*", r.t)]


def test_running_sums_and_windows(spark):
    rnd = random.Random(6)
    rows = [([rnd.randrange(9) for _ in range(n)],) for n in [0, 1, 2, 3, 5, 16, 17, 99, 1000]]
    for r in spark.createDataFrame(rows, "xs array<int>").select("xs", regex.running(F.col("xs")).alias("s")).collect():
        assert r.s == [sum(r.xs[:k]) for k in range(len(r.xs))]
    texts = ["", "short", "é🙂\n" * 3000, "x" * 2048, "ab" * 2048 + "c"]
    spans = [(rnd.randrange(-300, 9100), rnd.randrange(0, 2000)) for _ in range(200)]
    df = spark.createDataFrame([(t, a, a + n) for t in texts for a, n in spans], "t string, a int, b int").withColumn("cut", regex.pages(F.col("t")))
    for r in df.select("t", "a", "b", regex.window(F.col("cut"), F.col("a"), F.col("b")).alias("w")).collect():
        assert r.w == r.t[max(r.a, 1) - 1 : max(r.b - 1, 0)], (len(r.t), r.a, r.b)


def test_anchors_hide_no_match(spark):
    """An anchor is seen wherever a pattern that ignores case would match it, odd letters included."""
    rnd = random.Random(8)
    odd = {"i": "iI\u0130\u0131", "k": "kK\u212a", "s": "sS\u017f"}
    texts = ["".join(rnd.choice(odd.get(c, c + c.upper())) for c in rnd.choice(["dismiss", "keys", "vacate", "third", "none"])) + rnd.choice(["", " x", "\n"]) for _ in range(400)] + ["", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    words = ("dismiss", "keys", "vacate", "third")
    for r in df.select("t", regex.mentions(F.col("t"), *words).alias("m"), *[regex.has(F.col("t"), w, "i").alias(w) for w in words]).collect():
        assert r.m == any(r[w] for w in words)


def test_gaps_and_first_places(spark):
    rnd = random.Random(9)
    texts = ["".join(rnd.choice(["a", "b", "1", "\n", "🙂", "\ufdd0"] if k % 5 == 0 else ["a", "b", "1", "\n", "🙂"]) for _ in range(rnd.randrange(14))) for k in range(500)] + [None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", regex.gaps(F.col("t"), r"ab?").alias("g"), regex.place(F.col("t"), r"a1*b").alias("at")).collect():
        if r.t is None:
            assert r.g is None and r.at is None or r.at == 0
            continue
        m = re.search("a1*b", r.t)
        assert r.g == re.split("ab?", r.t) and r.at == (m.start() + 1 if m else 0), r.t


def test_a_hundred_thousand_matches_in_one_text(spark):
    """Places and what stands around them take time in proportion to the text."""
    from tamarack.operators import obligations, payments

    n = 100_000
    mention = "On breach 🙂 Defendant shall vacate. "
    pay = "water $5.00 by 1/2/2024 🙂 "
    df = spark.createDataFrame([(mention * n, pay * n)], "m string, p string")
    began = time.time()
    found = df.select(regex.with_starts(F.col("m"), r"shall\s+vacate", regex.matches(F.col("m"), r"shall\s+vacate", 0)).alias("w")).first().w
    assert len(found) == n and all(x["at"] - 1 == k * len(mention) + mention.index("shall") for k, x in enumerate(found))
    assert df.select(obligations.only_breach_vacates(F.col("m")).alias("x")).first().x
    assert not df.select(obligations.only_breach_vacates(F.concat(F.col("m"), F.lit("." * 200 + "They must vacate."))).alias("x")).first().x
    got = payments.payments(df, "p", F.lit(DAY)).select(F.size("payment_schedule").alias("n"), F.exists("payment_schedule", lambda x: x["extra_text"] != "water").alias("odd"), F.get("payment_schedule", F.lit(n - 1)).alias("last")).first()
    assert got.n == n and not got.odd and (got["last"].amount, got["last"].due_date) == ("5.00", "2024-01-02")
    assert time.time() - began < 240


def test_fence_stops_conditions(spark):
    df = regex.fence(spark.range(3).withColumn("x", F.concat(F.lit("a"), F.col("id").cast("string"))), "x").where("x = 'a1'")
    assert df.count() == 1


def test_mentions_folds_letters_as_patterns_do(spark):
    """Looked for in lower case first, with the four letters beyond ASCII that fold to i, s and k."""
    from tamarack.functions.regex import mentions

    rows = [("to be PAID", True), ("paıd", True), ("PAİD", True), ("aſsistance", True), ("<watermarK>", True), ("pa id", False), ("", False), (None, False), ("İı", False)]
    df = spark.createDataFrame(rows, "t string, want boolean")
    assert all(r.got == r.want for r in df.select("want", mentions(F.col("t"), "paid", "assistance", "<watermark>").alias("got")).collect())


def test_descriptions_with_and_without_rent(spark):
    """Months are looked for where rent is mentioned, in any case."""
    from tamarack.operators import payments

    df = spark.createDataFrame([("$5 for March RENT and water",), ("$5 in March",)], "t string").select(payments.describe(F.col("t")).alias("d"))
    assert [tuple(r.d) for r in df.collect()] == [("monthly_rent", "March", "water"), ("fixed_amount", None, None)]
