"""Language identification by cross-parsing entropy.

A model of a language is the suffix automaton of labelled text in it.  A text is parsed against each
model greedily: a phrase is the longest match from where the last phrase ended, and the character after
it begins the next one.  The language that needs the fewest phrases per character wins.

Training text is a bounded sample: about ``chars`` code points for each language (``ALL`` times that in all, shared by
the languages, but never fewer than ``LEAST`` for any while that is at most ``MOST`` together), from at most
``per_language`` labelled documents, those with the smallest hash of their id, and from a hashed place in each, so that a
rerun learns the same and no shared opening is all there is.  Every labelled language is learned, with all characters of
its sample; only a table with more than ``MOST`` / ``SHORTEST`` of them, which are no languages any more, is held to those
of most labelled rows.  A model takes about 50 bytes a code point; all are built once, each in a task, and broadcast
as arrays, at most 50 * ``MOST`` bytes.  Everything else covers all rows and whole texts.

Parsing is vectorised: the automaton is one array of transitions, each state's row laid into gaps of the others, and
all texts of a batch, cut into blocks of ``BLOCK`` characters, take their steps together.  Blocks are first parsed as
if a phrase began with each; then each is parsed again from the state in which the block before it ended, until a
phrase begins where one did in the first parse, as the two are the same from there on.  A block whose last state
changed hands it on to the next.  So phrases cross blocks, and the count is that of the parse in one go.

Defined results: a text that is null or has no letter is ``und`` with score 0; ties go to the language
that comes first by name; with no labelled text at all every row is ``und``; rows that repeat are judged alike; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamarack.llm.common import discard, materialize, n_partitions, ship

CHARS, PER_LANGUAGE, ALL, LEAST, BLOCK = 40_000, 200, 4, 2_000, 512
#: Bounds of the sample: code points in all where there are very many languages, and of one language then.
MOST, SHORTEST = 1_000_000, 64
#: Bits of a document's hash that draw it.
DRAW = 40
#: Most characters of texts that are parsed together.
BATCH = 2_000_000
#: How sharply the score follows the difference in phrases per character.
SHARP = 60.0
#: Codes of a letter that no training text has, and of a run of anything but letters; letters follow.
UNSEEN, GAP = 0, 1
_LOW = np.int64((1 << 32) - 1)


def automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``codes``; state 0 is the root."""
    nxt: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in codes:
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


def laid_out(nxt: list[dict[int, int]], n_codes: int) -> tuple[np.ndarray, np.ndarray]:
    """Transitions in one array.  A state is known by the place of its row, ``base``; its transition by code ``c`` is at
    ``base + c``: the state's own base << 32 | the next one's, so a slot that another row filled is told apart.

    Also the state after each code when a phrase begins with it (the root's own base if none does).
    """
    window = 2048
    total = sum(map(len, nxt))
    size = 4 * total + len(nxt) + 4 * n_codes + 4 * window
    free, unused = np.ones(size, bool), np.ones(size, bool)
    base = np.zeros(len(nxt), np.int64)
    low = n_codes
    several = sorted((s for s, d in enumerate(nxt) if len(d) > 1), key=lambda s: -len(nxt[s]))
    for s in several:
        row = sorted(nxt[s])
        at = low
        while True:
            if at + row[-1] + window > len(free):
                free, unused = (np.concatenate([x, np.ones(len(x), bool)]) for x in (free, unused))
            ok = unused[at : at + window].copy()
            for c in row:
                ok &= free[at + c : at + c + window]
            k = int(ok.argmax())
            if ok[k]:
                break
            at += window
        base[s] = at + k
        unused[at + k] = False
        free[np.array(row) + at + k] = False
        if not unused[low : low + window].any():
            low += window
    slots = iter(np.flatnonzero(free[n_codes:]) + n_codes)
    for s, d in enumerate(nxt):
        if len(d) > 1:
            continue
        c = next(iter(d), 0)
        b = next(b for p in slots if unused[b := int(p) - c])
        base[s] = b
        unused[b] = False
        if d:
            free[b + c] = False
    steps = np.full(int(base.max()) + n_codes + 1, -1, np.int64)
    for s, d in enumerate(nxt):
        b = int(base[s])
        for c, to in d.items():
            steps[b + c] = b << 32 | int(base[to])
    first = np.full(n_codes, base[0], np.int64)
    for c, to in nxt[0].items():
        first[c] = base[to]
    return steps, first


def _letters() -> np.ndarray:
    """Which code points are letters or marks on them."""
    return np.fromiter((chr(c).isalpha() or unicodedata.category(chr(c))[0] == "M" for c in range(0x110000)), bool, 0x110000)


class Model:
    """Automata of all languages over the characters of all training texts."""

    def __init__(self, texts: dict[str, str], build: bool = True) -> None:
        self.languages = sorted(texts)
        letters = _letters()
        seen = np.unique(np.frombuffer("".join(texts.values()).lower().encode("utf-32-le", "surrogatepass"), np.uint32))
        seen = seen[letters[seen]]
        self.lookup = np.where(letters, np.int32(UNSEEN), np.int32(GAP))
        self.lookup[seen] = np.arange(GAP + 1, GAP + 1 + len(seen), dtype=np.int32)
        self.n_codes = GAP + 1 + len(seen)
        self.models = [self.built(texts[x]) for x in self.languages] if build else []

    def built(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        return laid_out(automaton(self.codes(text).tolist()), self.n_codes)

    def codes(self, text: str) -> np.ndarray:
        """Letters as codes; a run of anything else counts as one gap."""
        codes = self.lookup[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
        keep = codes != GAP
        keep[1:] |= codes[:-1] != GAP
        return codes[keep]

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases per character, a row for each text and a column for each language; texts are not empty."""
        codes = [self.codes(t) for t in texts]
        codes = [c if len(c) else np.full(1, GAP, np.int32) for c in codes]
        sizes = np.array([len(c) for c in codes])
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        first = np.repeat(np.cumsum(sizes) - sizes, blocks) + BLOCK * inside
        length = np.minimum(BLOCK, np.repeat(np.cumsum(sizes), blocks) - first)
        flat = np.concatenate(codes)
        out = np.empty((len(texts), len(self.models)))
        for j, (steps, begin) in enumerate(self.models):
            out[:, j] = np.bincount(owner, weights=parsed(flat, first, length, inside > 0, steps, begin), minlength=len(texts)) / sizes
        return out


def parsed(flat: np.ndarray, first: np.ndarray, length: np.ndarray, goes_on: np.ndarray, steps: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """How many phrases begin in each block of ``flat``; a block that ``goes_on`` follows the one before it."""
    root = begin[UNSEEN]  # no phrase goes on after a letter that training has not

    def step(state: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states, and where a phrase begins."""
        found = steps.take(state + c)
        new = ((found >> 32) != state) | (state == root)
        return np.where(new, begin.take(c), found & _LOW), new

    # as if a phrase began with each block; longer blocks first, so those still at work are the first ones
    order = np.argsort(-length, kind="stable")
    at, size = first[order], length[order]
    alive = np.searchsorted(-size, -np.arange(size[0]), side="left")
    begins = np.zeros(len(flat), bool)
    begins[at] = True
    state = begin.take(flat[at])
    for k in range(1, int(size[0])):
        n = alive[k]
        here = at[:n] + k
        state[:n], begins[here] = step(state[:n], flat[here])
    first_end = np.empty_like(state)
    first_end[order] = state
    end = first_end.copy()
    upto = np.cumsum(begins)
    last = first + length - 1
    count = upto[last] - upto[first] + 1
    todo = np.flatnonzero(goes_on)
    while len(todo):
        state, mine, now = end[todo - 1], np.zeros(len(todo), np.int64), todo
        changed = []
        k = 0
        while len(now):
            here = first[now] + k
            state, new = step(state, flat[here])
            met = new & begins[here]
            count[now[met]] = mine[met] + upto[last[now[met]]] - upto[here[met]] + 1
            mine += new
            over = ~met & (k + 1 == length[now])
            count[now[over]] = mine[over]
            done = met | over
            if done.any():
                which, after = now[done], np.where(met, first_end[now], state)[done]
                changed.append(which[end[which] != after] + 1)
                end[which] = after
            going = ~done
            state, mine, now = state[going], mine[going], now[going]
            k += 1
        todo = np.concatenate(changed) if changed else todo[:0]
        todo = todo[todo < len(first)]
        todo = np.sort(todo[goes_on[todo]])
    return count


def learned(spark: SparkSession, texts: dict[str, str]) -> Model:
    """The model of ``texts``, a language built in each task."""
    model = Model(texts, build=False)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            made = [shared.value.built(t) for t in b["text"]]
            yield pd.DataFrame({"lang": b["lang"]} | {c: [m[k].astype(np.int64).tobytes() for m in made] for k, c in enumerate(("steps", "first"))})

    rows = spark.createDataFrame([(x, texts[x]) for x in model.languages], "lang string, text string")
    rows = rows.repartition(min(len(texts), 4 * n_partitions(spark)), "lang").mapInPandas(run, "lang string, steps binary, first binary")
    found = {r.lang: (np.frombuffer(r.steps, np.int64), np.frombuffer(r.first, np.int64)) for r in rows.collect()}
    model.models = [found[x] for x in model.languages]
    return model


def drawn(h: Column, n: Column, per_language: int) -> Column:
    """Whether a document of hash ``h`` is drawn: about 2 * ``per_language`` + 50 of a language's ``n`` are."""
    return h < F.lit(float(1 << DRAW) * (2.0 * per_language + 50)) / n


def training_text(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", chars: int = CHARS, per_language: int = PER_LANGUAGE) -> dict[str, str]:
    """The bounded sample of labelled text: language -> about ``chars`` code points.

    Documents are drawn by a threshold on their hash that follows from the language's count, then ranked, so that no
    task gathers more of a language than a few times ``per_language`` excerpts; that many reach the driver.
    """
    text = F.col(text_col)
    h = F.pmod(F.xxhash64(F.col(id_col).cast("string"), lang_col), F.lit(1 << DRAW))
    rows = labelled.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), text.alias("t"), h.alias("h"))
    # texts are looked through once; what is drawn is then read by its hash
    told = materialize(rows.where(F.col("t").rlike("\\p{L}")).select("lang", "h", F.length("t").alias("size")))
    counts = told.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    n_languages = counts.count()
    if n_languages > MOST // SHORTEST:
        counts = counts.orderBy(F.desc("n"), "lang").limit(MOST // SHORTEST)
        n_languages = MOST // SHORTEST
    chars = max(min(chars, ALL * chars // max(1, n_languages)), min(chars, LEAST, MOST // max(1, n_languages)))
    # a row for each language, a few for each document drawn: both bounded as the sample is, so broadcast
    ranked = told.join(F.broadcast(counts), "lang").where(drawn(F.col("h"), F.col("n"), per_language))
    ranked = ranked.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h", "size"))).where(F.col("k") <= per_language)
    chosen = materialize(ranked.select("lang", "h", "n").distinct())
    size = F.ceil(F.lit(chars) / F.least("n", F.lit(per_language))).cast("int")
    start = F.pmod(F.xxhash64("h"), F.greatest(F.length("t") - size + 1, F.lit(1))).cast("int") + 1
    cut = rows.join(F.broadcast(chosen), ["lang", "h"]).where(F.col("t").rlike("\\p{L}")).select("lang", F.substring("t", start, size).alias("t"), "h")
    best = cut.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h", "t"))).where(F.col("k") <= per_language)
    out: dict[str, list[str]] = {}
    for r in best.select("lang", "t", "h").orderBy("lang", "h", "t").collect():
        out.setdefault(r.lang, []).append(r.t)
    discard(told, chosen)
    return {lang: "\n".join(ts) for lang, ts in out.items()}


def predict_language(docs: DataFrame, texts: dict[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of ``docs``: ``doc_id``, ``lang_pred`` and ``score`` (0 to 1)."""
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    shared = spark.sparkContext.broadcast(learned(spark, texts) if texts else None)  # arrays of the bounded sample

    def judged(texts_: list[str]) -> tuple[list[str], list[float]]:
        model = shared.value
        rate = model.phrases(texts_)
        best = rate.argmin(axis=1)
        odds = np.exp(-SHARP * (rate - rate.min(axis=1, keepdims=True)))
        return [model.languages[k] for k in best], (1 / odds.sum(axis=1)).tolist()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            lang, score = np.full(len(b), "und", object), np.zeros(len(b))
            known = [k for k, t in enumerate(b["text"]) if shared.value and t is not None and any(map(str.isalpha, t))]
            held, size = [], 0
            for k in known:
                held.append(k)
                size += len(b["text"].iat[k])
                if size >= BATCH or k == known[-1]:
                    lang[held], score[held] = judged([b["text"].iat[i] for i in held])
                    held, size = [], 0
            yield pd.DataFrame({"doc_id": b["doc_id"], "lang_pred": lang, "score": score})

    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return rows.mapInPandas(run, f"doc_id {kind}, lang_pred string, score double")
