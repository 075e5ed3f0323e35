"""The pipeline's near-dedup against all pairs by five-word shingles."""

import collections
import random

from pyspark.sql import functions as F

from tamarack.llm import nearcopies
from tests.llm.test_operators import docs, hard


def brute_roots(texts):
    sets = [nearcopies.shingles(t) for t in texts]
    roots = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if roots[a] != roots[b] and nearcopies.similarity(sets[a], sets[b]) >= nearcopies.SIMILAR:
                roots = [min(roots[a], roots[b]) if r in (roots[a], roots[b]) else r for r in roots]
    return roots


def word(rnd):
    return f"w{rnd.randrange(10**6)}"


def edited(rnd, words, changed):
    out = list(words)
    for k in rnd.sample(range(len(words)), changed):
        out[k] = word(rnd)
    return out


def test_near_dedup_by_shingle_similarity(spark):
    rnd = random.Random(21)
    texts = []
    for n, changed in [(300, 2), (300, 5), (1000, 10), (100, 1), (300, 12)] * 20:
        t = [word(rnd) for _ in range(n)]
        texts += [" ".join(t), " ".join(edited(rnd, t, changed))]
    # a group whose members are similar to its first and often not to each other
    base = [word(rnd) for _ in range(200)]
    texts += [" ".join(edited(rnd, base, 4)) for _ in range(60)]
    roots = brute_roots(texts)
    got = {r.doc_id: r.component_id for r in nearcopies.near_copies(docs(spark, *texts)).collect()}
    assert got == dict(enumerate(roots)) and 100 < len(set(roots)) < 200
    assert {r.doc_id for r in nearcopies.drop_near_copies(docs(spark, *texts)).collect()} == set(roots)


def test_large_groups_of_alike_texts(spark):
    """Texts around the threshold with no original, more than a block of them, with chains among them."""
    rnd = random.Random(22)
    base = [word(rnd) for _ in range(120)]
    texts = [" ".join(edited(rnd, base, rnd.choice([2, 3]))) for _ in range(700)]
    roots = brute_roots(texts)
    got = {r.doc_id: r.component_id for r in nearcopies.near_copies(docs(spark, *texts)).collect()}
    assert sum(got[k] == r for k, r in enumerate(roots)) >= 0.999 * len(texts) and len(set(roots)) < 600


def test_shared_shingles_and_block_links():
    rnd = random.Random(23)
    sets = [{b"%d" % rnd.randrange(9000) for _ in range(rnd.randrange(1, 6000))} for _ in range(20)]
    both = nearcopies.shared_shingles(sets)
    assert all(both[i, j] == len(sets[i] & sets[j]) for i in range(20) for j in range(20) if i != j)
    close = [{b"%d" % k for k in range(100)} | {b"x%d" % i} for i in range(20)]
    for n in (5, 20):  # pair by pair, and by the product
        members = [(i, i, 0, close[i]) for i in range(n)]
        assert len(nearcopies.block_links(members)) == n - 1
        halves = [(i, i, i % 2, close[i]) for i in range(n)]
        assert {a % 2 != b % 2 for a, b in nearcopies.block_links(halves)} == {True}
        assert nearcopies.block_links([(i, 7, 0, close[i]) for i in range(n)]) == []


def test_rows_without_ids_and_repeated_ids(spark):
    text = " ".join(f"word{k}" for k in range(40))
    rows = [(5, text), (None, text + " tail"), (7, "alone and short"), (7, "another text of the same id"), (7, "alone and short"), (None, "no id here"), (None, "no id here"), (8, None), (9, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("root", F.lit("r"))
    kept = nearcopies.drop_near_copies(df)
    assert kept.columns == df.columns
    assert collections.Counter((r.doc_id, r.text) for r in kept.collect()) == collections.Counter([(5, text), (7, "alone and short"), (7, "another text of the same id"), (None, "no id here"), (8, None)])
    some = hard(spark).withColumn("node", F.lit(1)).withColumn("id", F.lit(2))
    ids = [r.doc_id for r in nearcopies.drop_near_copies(some).collect()]
    assert len(ids) == len(set(ids)) == 6
    assert nearcopies.drop_near_copies(df.limit(0)).count() == 0


def test_rows_alike_in_id_and_text(spark):
    """Of rows that differ in other columns only the first in their order stays, in every order of the input."""
    rows = [(1, "one text of a few words", lang, {"k": k}) for lang in ("fr", "de", None) for k in range(3)]
    kept = set()
    for turn in range(3):
        df = spark.createDataFrame(rows[turn:] + rows[:turn], "doc_id long, text string, lang string, more map<string,int>").repartition(3)
        out = [(r.doc_id, r.lang, tuple(r.more.items())) for r in nearcopies.drop_near_copies(df).collect()]
        assert len(out) == 1
        kept |= set(out)
    assert len(kept) == 1


def test_fingerprints_and_golay_keys_propose_pairs(spark):
    """The named method is a step of the stage: pairs of near or equal fingerprints reach the check on texts."""
    rnd = random.Random(24)
    texts = []
    for _ in range(40):
        t = [word(rnd) for _ in range(600)]
        texts += [" ".join(t), " ".join([*t, word(rnd)])]
    fps = [nearcopies.sketch(t)[2] for t in texts]
    nodes = spark.createDataFrame([(k, nearcopies.sketch(t)[0], fps[k]) for k, t in enumerate(texts)], "node long, n long, fp long")
    near = {(a, b) for a in range(len(fps)) for b in range(a) if ((fps[a] ^ fps[b]) & (1 << 64) - 1).bit_count() <= 2}
    got = {(max(r.x, r.y), min(r.x, r.y)) for r in nearcopies.fuzzy_pairs(nodes).collect()}
    assert got == near and len(near) > 20
    shown = nearcopies.near_copies(docs(spark, *texts))
    assert {r.doc_id: r.component_id for r in shown.collect()} == dict(enumerate(brute_roots(texts)))


def test_no_table_of_links_or_names_is_broadcast(spark):
    """Op 10's joins deal both sides by key, however small they are, so nothing passes the driver."""
    from tamarack.llm import simhash

    told = docs(spark, *[f"some words of text {k % 7} and more of it" for k in range(50)])
    fps = nearcopies.materialize(simhash.fingerprints(told).select("fp").distinct())
    for df in (simhash.near_copies(told), simhash.links(fps)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
