"""Quality rules that clean documents trip."""

import math
import random

import pytest

from tamarack.llm import quality
from tests.llm.test_operators import docs

GOOD = "p,1,1,1,1,1,1,1,1"
JUNK = ("p,-1,1,1,1,1,1,-1,1", "p,1,-1,-1,1,1,1,-1,1", "p,1,1,1,-1,-1,1,1,1")
LIST = "p,1,1,1,1,1,1,1,-1"


@pytest.mark.parametrize("n", [100, 500, 2000, 4000])
def test_a_rule_that_clean_texts_trip_loses_weight(spark, n):
    rows = [(GOOD, 10_000), *((x, 250) for x in JUNK), (LIST, n)]
    told = {r._tmk_pattern: r._tmk_good for r in quality.estimate(spark.createDataFrame(rows, "_tmk_pattern string, _tmk_n long"), 8).collect()}
    assert told[GOOD] > 0.9 and told[LIST] > 0.9 and all(told[x] < 0.1 for x in JUNK)


def test_clean_lists_tables_and_other_scripts_stay(spark):
    rnd = random.Random(31)
    vocab = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 9))) for _ in range(2000)]
    hindi = ["".join(rnd.choice("कखगचजटडतदनपबमरलसह") + rnd.choice(["ा", "ि", "ी", "े", "ो", "्", "ं"]) for _ in range(rnd.randint(2, 4))) for _ in range(2000)]
    text = lambda words, end, n: " ".join(" ".join(rnd.choice(words) for _ in range(9)) + end for _ in range(n))
    clean = [text(vocab, ".", 13) for _ in range(90)] + [text(hindi, "।", 13) for _ in range(30)] + [text(hindi, " ।", 13) for _ in range(5)]
    clean += ["\n".join(f"{rnd.choice(vocab)} {rnd.choice(vocab)}" for _ in range(120)) for _ in range(25)]  # lists
    clean += ["\n".join(f"{rnd.choice(vocab)}\t{rnd.randrange(10**4)}\t{rnd.randrange(10**4)}" for _ in range(80)) for _ in range(15)]  # tables
    junk = [" ".join(rnd.choice(vocab) + rnd.choice(["***", "$$$", "%%%"]) for _ in range(120)) for _ in range(8)] + [" ".join(rnd.choice(vocab).upper() + "!!" for _ in range(120)) for _ in range(8)]
    assert {r.doc_id for r in quality.keep_good(docs(spark, *clean, *junk)).collect()} == set(range(len(clean)))


def plain_em(patterns, rules, rounds=quality.ROUNDS):
    """The same estimate, and its priors, by loops."""
    rows = [([int(v) for v in p.split(",")[1:]], n) for p, n in patterns]
    p, b, g = 0.1, [0.5] * rules, [0.001] * rules

    def bad(v):
        odds = math.log(p / (1 - p))
        for x, hit, false in zip(v, b, g):
            odds += math.log(hit / false) if x == -1 else math.log((1 - hit) / (1 - false)) if x == 1 else 0.0
        return 1 / (1 + math.exp(-odds))

    for _ in range(rounds):
        post = [(v, n * bad(v), n * (1 - bad(v))) for v, n in rows]
        rate = lambda k, j: (sum(x[k] for x in post if x[0][j] == -1) + 1) / (sum(x[k] for x in post if x[0][j]) + 2)
        nb, ng = sum(x[1] for x in post), sum(x[2] for x in post)
        p = min(0.5, max(0.01, (nb + 1) / (nb + ng + 10)))
        b = [min(0.98, max(0.05, rate(1, j))) for j in range(rules)]
        g = [max(0.0002, min(quality.MOST_FALSE, b[j], rate(2, j))) for j in range(rules)]
    return {pattern: 1 - bad([int(v) for v in pattern.split(",")[1:]]) for pattern, _ in patterns}


def test_estimate_is_plain_em(spark):
    rnd = random.Random(33)
    rows = {}
    for _ in range(4000):
        junk = rnd.random() < 0.15
        votes = [rnd.choice([-1, -1, 1, 0]) if junk and j < 5 or rnd.random() < 0.02 * j else rnd.choice([1, 1, 1, 0]) for j in range(8)]
        key = ",".join([rnd.choice("pppf"), *map(str, votes)])
        rows[key] = rows.get(key, 0) + 1
    got = {r._tmk_pattern: r._tmk_good for r in quality.estimate(spark.createDataFrame(list(rows.items()), "_tmk_pattern string, _tmk_n long"), 8).collect()}
    want = plain_em(list(rows.items()), 8)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert quality.estimate(spark.createDataFrame([], "_tmk_pattern string, _tmk_n long"), 8).count() == 0
