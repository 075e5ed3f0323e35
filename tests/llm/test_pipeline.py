"""The contract queries against SQL and brute force, and the pipeline stage by stage."""

import collections
import glob
import hashlib
import os
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tamarack.llm import bpe, langid, pii
from tamarack.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SMALL
from tests.llm.test_near import brute_roots
from tests.llm.test_operators import RANKS, brute_components, brute_fingerprint, brute_lines, brute_mix, brute_pii, brute_quality, greedy, words


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The smallest tables with hard rows among the documents, and the same without any rows."""
    top = tmp_path_factory.mktemp("tables")
    for name in ("hard", "empty"):
        for f in glob.glob(f"{SMALL}/*.parquet"):
            df = spark.read.parquet(f)
            (df if name == "hard" else df.limit(0)).write.parquet(f"{top}/{name}/{os.path.basename(f)}")
    rnd = random.Random(40)
    long = " ".join(rnd.choice(["alpha", "beta", "gamma", "delta."]) + str(rnd.randrange(300)) for _ in range(30_000))
    rows = [(10_001, None, None, None), (10_002, "", "en", None), (10_003, long, "en", "src1"), (10_004, "a\nsame\nline", "en", None), (10_005, "a\nsame\nline", None, "src2"),
            (10_006, "x" * 100_000, "xx", "src2"), (10_007, " \t\n ", None, "é"), (10_008, "🙂 \x00 é 4111 1111 1111 1111 a@b.cc", None, "src1"), (10_009, " ".join(f"w{k}" for k in range(80)) + ".", "en", "only"),
            (10_010, " ".join(f"w{k}" for k in range(80)) + ". more", "en", "only")]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    extra.unionByName(docs).write.mode("overwrite").parquet(f"{top}/hard/documents.parquet")
    return {"hard": f"{top}/hard", "empty": f"{top}/empty"}


def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").collect()


def result(spark, name, sf):
    return {r.doc_id: r for r in QUERIES[name](spark, sf).collect()}


@pytest.mark.parametrize("where", ["hard", "empty"])
@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_oracle(spark, tables, name, where):
    con = duckdb.connect()
    for f in glob.glob(f"{tables[where]}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}/*.parquet')")
    df = QUERIES[name](spark, tables[where])
    q = con.execute(ORACLE_SQL[name])
    named = [d[0] for d in q.description]
    want = sorted(repr(tuple(r[named.index(c)] for c in sorted(named))) for r in q.fetchall())
    assert sorted(repr(tuple(r[c] for c in sorted(df.columns))) for r in df.collect()) == want


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE_SQL])
def test_empty_tables(spark, tables, name):
    assert QUERIES[name](spark, tables["empty"]).count() == 0


def test_pii_rows(spark, tables):
    got = result(spark, "op5_pii", tables["hard"])
    for d in documents(spark, tables["hard"]):
        r, base = got.pop(d.doc_id), brute_pii(d.text or "")
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[0] == k for x in base) for k in pii.BASE_KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest()
        spans = [x.split(":") for x in r.spans.split(",")] if r.spans else []
        order = [(pii.KINDS.index(k), int(s)) for k, s, _ in spans]
        assert order == sorted(order) and {f"{k}:{s}:{e}" for k, s, e in base} <= {":".join(x) for x in spans} and r.n_spans == len(spans) == len(r.scores.split(",") if r.scores else [])
    assert not got


def test_language_rows(spark, tables):
    got, docs = result(spark, "op6_language_id", tables["hard"]), documents(spark, tables["hard"])
    held = [d for d in docs if zlib.crc32(str(d.doc_id).encode()) % 3 == 1]
    assert {k for k, r in got.items() if r.held_out} == {d.doc_id for d in held} and len(got) == len(docs)
    assert all(0 <= r.score <= 1 and (r.lang_pred == "und") == (not any(map(str.isalpha, d.text or ""))) for d in docs for r in [got[d.doc_id]])
    scored = [d for d in held if d.lang and d.doc_id < 10_000]
    assert sum(got[d.doc_id].lang_pred == d.lang for d in scored) >= 0.97 * len(scored)
    # neither lang nor source nor id of a row is an input of its prediction
    other = spark.read.parquet(f"{tables['hard']}/documents.parquet")
    change = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    other = other.withColumns({"lang": F.when(change, F.lit("zz")).otherwise(F.col("lang")), "source": F.lit("s")})
    path = tables["hard"] + "-changed"
    other.write.mode("overwrite").parquet(f"{path}/documents.parquet")
    assert {k: (r.lang_pred, r.score) for k, r in result(spark, "op6_language_id", path).items()} == {k: (r.lang_pred, r.score) for k, r in got.items()}


def test_language_is_the_plain_argmin(spark, tables):
    """The query's language and score against a plain parse of each text by each language."""
    docs = spark.read.parquet(f"{tables['hard']}/documents.parquet")
    texts = langid.training_text(docs.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1))
    model = langid.Model(texts)
    known = {x: "".join(map(chr, model.codes(t))) for x, t in texts.items()}
    got = result(spark, "op6_language_id", tables["hard"])
    some = 0
    for d in documents(spark, tables["hard"]):
        codes = "".join(map(chr, model.codes(d.text or "")))
        if not 0 < len(codes) < 3000 or got[d.doc_id].lang_pred == "und":
            continue
        rate = {x: greedy(codes, known[x]) / len(codes) for x in model.languages}
        odds = {x: np.exp(-langid.SHARP * (r - min(rate.values()))) for x, r in rate.items()}
        assert got[d.doc_id].lang_pred == min(model.languages, key=lambda x: (rate[x], x))
        assert abs(got[d.doc_id].score - 1 / sum(odds.values())) < 1e-9
        some += 1
    assert some > 100


def test_bpe_rows(spark, tables):
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.parse_ranks(RANKS), special_tokens={})
    got = result(spark, "op7_byte_bpe", tables["hard"])
    for d in documents(spark, tables["hard"]):
        r, ids = got.pop(d.doc_id), enc.encode_ordinary(d.text or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()
    assert not got


def test_quality_rows(spark, tables):
    got = result(spark, "op8_quality_rules", tables["hard"])
    for d in documents(spark, tables["hard"]):
        r, (n, chars, symbols, dups, repeats) = got.pop(d.doc_id), brute_quality(d.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dups, repeats)
        assert r.base_failed == (n < 50 or 100 * repeats > 50 * n) and not (r.base_failed and r.kept) and r.kept == (not r.base_failed and r.p_good >= 0.5)
        assert r.votes.split(",")[1:] == brute_votes(d.text)
    assert not got


def brute_votes(text):
    """The rules by plain counting."""
    t = text or ""
    n, chars, symbols, dups, repeats = brute_quality(t)
    lines = [x for x in t.split("\n") if re.search("[^ \t-\r]", x)]
    upper = sum(c.isupper() and not 0x24B6 <= ord(c) <= 0x24CF for c in t)
    import unicodedata

    letters = sum(unicodedata.category(c)[0] in "LMN" for c in t)
    ends = len(re.findall("[.!?؟۔](?=[ \t-\r]|\\Z)|[।॥。！？｡։።፧။។៕།]", t))
    vote = lambda bad, good: "-1" if bad else "1" if good else "0"
    return [
        vote(100 * symbols > 15 * n, 100 * symbols <= 4 * n), vote(100 * upper > 40 * chars, 100 * upper < 15 * chars),
        vote(100 * t.count("!") > 20 * n, 100 * t.count("!") <= 5 * n), vote(100 * repeats > 35 * n, 100 * repeats <= 15 * n),
        vote(100 * dups > 40 * len(lines), 100 * dups <= 20 * len(lines)), vote(chars < 2 * n or chars > 15 * n, 3 * n <= chars <= 11 * n),
        vote(100 * letters < 88 * chars, 100 * letters > 92 * chars), vote(200 * ends < n, 100 * ends > n),
    ]


def test_simhash_rows(spark, tables):
    got, docs = result(spark, "op10_simhash", tables["hard"]), documents(spark, tables["hard"])
    fps = [brute_fingerprint(d.text) for d in docs]
    least = {}
    for d, g in zip(docs, roots := brute_components(fps)):
        least[g] = min(least.get(g, d.doc_id), d.doc_id)
    assert {k: (r.fingerprint, r.component_id) for k, r in got.items()} == {d.doc_id: (f"{f:016x}", least[g]) for d, f, g in zip(docs, fps, roots)}


def told(rows):
    return collections.Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in rows)


def test_stages(spark, tables):
    """Each stage on all its predecessor kept, against brute force."""
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "source_mixing", "byte_bpe"]
    stage = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{tables['hard']}/documents.parquet").cache()
    good = stage["quality_rules"](spark, docs, tables["hard"]).cache()
    verdict = result(spark, "op8_quality_rules", tables["hard"])
    assert told(good.collect()) == told(r for r in docs.collect() if verdict[r.doc_id].kept) and good.count() > 100
    # hard rows go past the first stage too
    more = good.unionByName(docs.where("doc_id > 10000")).dropDuplicates(["doc_id"]).cache()
    cut = stage["line_dedup"](spark, more, tables["hard"]).cache()
    rows = more.collect()
    assert cut.columns == docs.columns
    kept = dict(brute_lines([(r.doc_id, r.text, r.source) for r in rows], 0.1, 5))
    assert told(cut.collect()) == collections.Counter((r.doc_id, kept[r.doc_id], r.lang, r.source, None if kept[r.doc_id] is None else len(kept[r.doc_id])) for r in rows)
    once = stage["near_dedup"](spark, cut, tables["hard"]).cache()
    rows = sorted(cut.collect(), key=lambda r: r.doc_id)
    roots = brute_roots([r.text for r in rows])
    assert told(once.collect()) == told(rows[k] for k in set(roots)) and once.columns == docs.columns
    mixed = stage["source_mixing"](spark, once, tables["hard"]).cache()
    rows = once.collect()
    taken = brute_mix([(r.doc_id, r.text, r.source) for r in rows])[2]
    assert collections.Counter(r.doc_id for r in mixed.collect()) == +collections.Counter({rows[k].doc_id: n for k, n in taken.items()}) and mixed.columns == docs.columns
    coded = stage["byte_bpe"](spark, mixed, tables["hard"]).collect()
    coder = bpe.load(RANKS, public_tokenizers.PATTERN)
    texts = {r.doc_id: r.text or "" for r in rows}
    assert len(coded) == mixed.count() and all(coder.decode(np.frombuffer(r.ids, "<u4").tolist()) == texts[r.doc_id].encode() and r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in coded)


def test_pipeline_is_its_stages(spark, tables):
    docs = spark.read.parquet(f"{tables['hard']}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables["hard"]).cache()
    key = lambda rows: sorted((r.doc_id, r.n_tokens, bytes(r.ids)) for r in rows)
    assert key(corpus_pipeline.run(spark, tables["hard"]).collect()) == key(docs.collect())
    assert words("a b") == [b"a", b"b"]


def test_empty_corpus(spark, tables):
    assert corpus_pipeline.run(spark, tables["empty"]).count() == 0
