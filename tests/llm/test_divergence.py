"""The divergence audit against plain sums over every term, with small tables of the counting side."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from tamarack.llm import divergence
from tests.llm.test_operators import hard

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_audit(rows, least, top):
    rows = [((t or ""), (g or ""), (s or "")) for t, g, s in rows]
    found = [([x.translate(LOW) for x in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", t)], g, s) for t, g, s in rows]
    out = []
    for lang in {g for _, g, _ in rows}:
        own = [(ts, s) for ts, g, s in found if g == lang]
        docs = collections.Counter(t for ts, _ in own for t in set(ts))
        kept = sorted(t for t, n in docs.items() if n >= least)
        v = len(kept)
        count = {s: collections.Counter() for _, s in own}
        for ts, s in own:
            count[s].update(t for t in ts if docs[t] >= least)

        def share(c):
            n = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * v) for t in kept}

        q = share(sum(count.values(), collections.Counter()))
        p = {s: share(c) for s, c in count.items()}
        for s in count:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in count if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if count[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, t, n, k) for k, (t, n) in enumerate(items[:most], 1)]
    return sorted(out)


def rows_of(seed):
    rnd = random.Random(seed)
    vocabulary = ["the", "The", "THE", "of", "é", "É", "straße", "日本", "a1b", "x_y", "it's", *[f"w{chr(97 + k)}" for k in range(20)]]
    rows = []
    for _ in range(160):
        source = rnd.choice(["s0", "s0", "s0", "s1", "s2", "Z", "é", "", None])
        some = vocabulary if source != "s2" else vocabulary[:6]
        text = rnd.choice([" ", ", ", "\n", "-", "\x00"]).join(rnd.choice(some) for _ in range(rnd.randrange(30)))
        rows.append((rnd.choice([text, text, text, None, ""]), rnd.choice(["en", "en", "fr", None, "", "rare"]), source))
    return [*rows, *rows[:5], ("only words", "alone", "one")]


SCHEMA = "text string, lang string, source string"


def told(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed, least, top", [(1, 5, 50), (2, 8, 3), (3, 10**6, 50)])
def test_audit(spark, seed, least, top):
    rows = rows_of(seed)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(7) for c in ("n", "term", "part", "at")})
    assert told(divergence.audit(df, least=least, top=top)) == brute_audit(rows, least, top)


def test_shards_small_tables_and_steps(spark, monkeypatch):
    """Vocabularies cut into shards, tables that empty often, pairs in small steps: in the driver's hands, as the
    functions run there; and the same audit over them."""
    rows = rows_of(5)
    df = spark.createDataFrame([tuple(x or "" for x in r) for r in rows], SCHEMA)
    kept = divergence.vocabulary(df, 5)
    one = sorted(map(tuple, divergence.postings(df, kept).collect()))
    many = sorted(map(tuple, divergence.postings(df, kept, shard=40).collect()))
    assert one == many and len(one) > 50
    monkeypatch.setattr(divergence, "FEW", 0)
    assert sorted(map(tuple, divergence.postings(df, kept, shard=100).collect())) == one
    monkeypatch.setattr(divergence, "STEP", 8)
    monkeypatch.setattr(divergence, "HELD", 3)
    assert told(divergence.audit(df, least=5)) == brute_audit(rows, 5, 50)


def test_joint_parts():
    import pyarrow as pa

    rnd = random.Random(6)
    held, want = [], collections.Counter()
    for _ in range(200):
        g = sorted(rnd.sample(range(9), rnd.randrange(2, 9)))
        post = [{"at": k, "p": rnd.randrange(100), "p0": k * 3} for k in g]
        rnd.shuffle(post)
        lang = rnd.choice("xy")
        held.append((lang, post))
        for a in post:
            for b in post:
                if a["at"] < b["at"]:
                    want[lang, a["at"], b["at"]] += abs(a["p"] - b["p"]) - abs(a["p"] - b["p0"]) - abs(b["p"] - a["p0"]) + abs(a["p0"] - b["p0"])
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("at", "p", "p0")]))
    batch = pa.RecordBatch.from_arrays([pa.array([x for x, _ in held]), pa.array([p for _, p in held], kind)], ["lang", "postings"])
    for step in (1 << 19, 50, 1):
        divergence.STEP, before = step, divergence.STEP
        got = collections.Counter()
        try:
            for part in (batch, batch.slice(50, 20)):
                for b in divergence._joint(iter([part])):
                    for r in b.to_pylist():
                        if part is batch:
                            got[r["lang"], r["a"], r["b"]] += r["part"]
        finally:
            divergence.STEP = before
        assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_hard_rows(spark):
    df = hard(spark)
    rows = [(r.text, r.lang, r.source) for r in df.collect()]
    assert told(divergence.audit(df, least=2)) == brute_audit(rows, 2, 50)
    assert divergence.audit(df.limit(0)).count() == 0
