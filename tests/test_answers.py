"""Paid answers: counted calls, equal contents, runs that die half-way, calls under way."""

import collections
import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from tamarack import answers, backends
from tamarack.plans.services import extract_with_model, process_pdfs

TEXT = "Defendant shall pay $100.00 on or before 2/1/2024"


class Logged:
    """Answers, and a line in a file for each call when it begins and when it ends."""

    def __init__(self, path, dies_on=None, fails_on=None, takes=0.0):
        self.path, self.dies_on, self.fails_on, self.takes = path, dies_on, fails_on, takes

    def note(self, what):
        with open(self.path, "a") as f:
            f.write(f"{time.time()}\t{what}\n")

    def answer(self, text):
        if self.dies_on and self.dies_on in text:
            os._exit(3)
        self.note("begin\t" + text.replace("\n", " "))
        time.sleep(self.takes)
        self.note("end\t")
        if self.fails_on and self.fails_on in text:
            raise ValueError("no")
        return f"about {text}"

    def read(self, png):
        return self.answer(png.decode())


def calls(path):
    return [x.split("\t")[2].strip() for x in open(path) if "\tbegin\t" in x] if os.path.exists(path) else []


def use(b, text):
    return b.answer(text or "")


def test_equal_contents_are_asked_once(spark, tmp_path):
    log, store = str(tmp_path / "log"), str(tmp_path / "store")
    rows = spark.createDataFrame([(k, f"t{k % 7}" if k % 10 else None, "x") for k in range(100)], "k int, shown string, answered string")
    out = answers.answered(rows, "shown", lambda: Logged(log), use, "m", store, slots=3, each=1)
    got = {r.k: r.answer for r in out.collect()}
    assert got == {k: f"about t{k % 7}" if k % 10 else "about " for k in range(100)} and out.columns == ["k", "answered", "answer", "error"]
    assert sorted(calls(log)) == sorted(["", *(f"t{k}" for k in range(7))])
    # another run asks nothing; another model is asked anew; a run without a store has its own
    assert answers.answered(rows, "shown", lambda: Logged(log), use, "m", store).where("answer is null").count() == 0 and len(calls(log)) == 8
    answers.answered(rows, "shown", lambda: Logged(log), use, "other", store).count()
    assert len(calls(log)) == 16
    answers.answered(rows, "shown", lambda: Logged(log), use, "m").count()
    assert len(calls(log)) == 24
    assert answers.answered(rows.limit(0), "shown", lambda: Logged(log), use, "m").count() == 0 and len(calls(log)) == 24


def test_failures_are_told_and_asked_again(spark, tmp_path):
    log, store = str(tmp_path / "log"), str(tmp_path / "store")
    rows = spark.createDataFrame([(k, f"t{k}") for k in range(6)], "k int, shown string")
    told = {r.k: (r.answer, r.error) for r in answers.answered(rows, "shown", lambda: Logged(log, fails_on="t2"), use, "m", store).collect()}
    assert told.pop(2) == (None, "ValueError: no") and all(a and e is None for a, e in told.values())
    told = {r.k: (r.answer, r.error) for r in answers.answered(rows, "shown", lambda: Logged(log), use, "m", store).collect()}
    assert told[2] == ("about t2", None) and collections.Counter(calls(log)) == collections.Counter([f"t{k}" for k in range(6)] + ["t2"])


def test_a_killed_run_asks_nothing_twice(spark, tmp_path):
    """The worker dies in the middle of a wave: what tasks before it have asked is in the store."""
    log, store = str(tmp_path / "log"), str(tmp_path / "store")
    rows = spark.createDataFrame([(k, f"t{k:02}") for k in range(40)], "k int, shown string")
    with pytest.raises(Exception):
        answers.answered(rows, "shown", lambda: Logged(log, dies_on="t2", takes=0.05), use, "m", store, slots=2, each=1)
    before = calls(log)
    kept = answers.known(spark, store).count()
    assert 0 < kept < 40 and len(before) - kept <= 2  # at most what the other slot had under way
    out = answers.answered(rows, "shown", lambda: Logged(log), use, "m", store, slots=2, each=1)
    assert {r.k: r.answer for r in out.collect()} == {k: f"about t{k:02}" for k in range(40)}
    again = [x for x, n in collections.Counter(calls(log)).items() if n > 1]
    assert len(calls(log)) <= 42 and len(again) <= 2


def test_no_wave_is_larger_than_its_tasks(spark, tmp_path):
    """A run that dies loses a wave at most: each of them has slots * each contents, the last one what is left."""
    store = str(tmp_path / "store")
    rows = spark.createDataFrame([(k, f"t{k:02}") for k in range(41)], "k int, shown string").repartition(5)
    answers.answered(rows, "shown", lambda: Logged(str(tmp_path / "log")), use, "m", store, slots=2, each=2)
    job = F.regexp_extract(F.input_file_name(), "part-[0-9]+-([0-9a-f-]{36})", 1)
    sizes = [r["count"] for r in spark.read.parquet(store).groupBy(job.alias("job")).count().collect()]
    assert sorted(sizes) == [1] + [4] * 10


def test_slots_bound_calls_under_way(spark, tmp_path):
    log = str(tmp_path / "log")
    rows = spark.createDataFrame([(k, f"t{k}") for k in range(30)], "k int, shown string").repartition(8)
    answers.answered(rows, "shown", lambda: Logged(log, takes=0.02), use, "m", slots=2, each=3).count()
    now = most = 0
    for line in sorted(open(log)):
        now += 1 if "\tbegin\t" in line else -1
        most = max(most, now)
    assert len(calls(log)) == 30 and most <= 2


def test_model_answers_survive_a_dead_run(spark, tmp_path):
    """The whole plan: first answers are kept when asking for second opinions dies; texts are shown as they were."""
    one, two, store = (str(tmp_path / x) for x in ("one", "two", "store"))
    rows = spark.createDataFrame([(k, None, f"text {k % 4} Agreed entry") for k in range(12)], "k int, filename string, text string")

    class First(Logged):
        def answer(self, text):
            super().answer(text)
            return '{"outcome_type": "Settlement"}'

    class Second(Logged):
        def answer(self, text):
            super().answer(text)
            return '{"outcome_type": "Vacate Only", "reasoning": "why"}'

    run = lambda **kw: extract_with_model(rows, "k", lambda: First(one), lambda: Second(two, **kw), store=store, slots=1)
    with pytest.raises(Exception):
        run(dies_on="text 2").count()
    assert len(calls(one)) == 4
    out = run()
    assert {(r.k, r.outcome_type) for r in out.collect()} == {(k, "Vacate Only") for k in range(12)}
    assert len(calls(one)) == 4 and len(set(calls(two))) == 4 and out.count() == 12 and len(calls(one)) == 4


class Pages:
    """Rasterises, and leaves a file for each call."""

    def __init__(self, path):
        self.path = path

    def pages(self, pdf, dpi):
        open(f"{self.path}/{time.time_ns()}", "w").close()
        if pdf == b"bad":
            raise ValueError("broken")
        return [bytes(pdf), b"same last page"]


def test_pdfs_are_rasterised_once_and_equal_pages_read_once(spark, tmp_path):
    made, log, store = tmp_path / "made", str(tmp_path / "log"), str(tmp_path / "store")
    made.mkdir()
    files = [(f"{k}.pdf", f"{k}", bytearray(TEXT.encode() + b"%d" % (k % 2))) for k in range(5)] + [("bad.pdf", "bad", bytearray(b"bad"))]
    pdfs = spark.createDataFrame(files, "source_file string, filename string, content binary")
    run = lambda: process_pdfs(pdfs, lambda: Pages(made), lambda: Logged(log), store=store).select("source_file", "outcome_type", "error")
    rows = {r.source_file: r for r in run().collect()}
    assert len(rows) == 6 and rows["bad.pdf"].error.startswith("ValueError") and rows["0.pdf"].outcome_type == "Pay and Stay"
    assert len(glob.glob(f"{made}/*")) == 6 and len(calls(log)) == 3
    run().collect()
    assert len(calls(log)) == 3


def test_texts_are_cleaned_once(spark, tmp_path):
    """What is shown is a written table: the plan behind it holds no cleaning."""
    rows = spark.createDataFrame([(1, None, TEXT + " $1O.0O")], "k int, filename string, text string")
    out = extract_with_model(rows, "k", lambda: Logged(str(tmp_path / "log")), store=str(tmp_path / "store"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "olISBZgq" not in plan and "Fixed money" not in plan and out.first().cleaned_text.endswith("$10.00")
    assert backends.ask(rows, lambda: Logged(str(tmp_path / "log")), "k", "text").columns == ["k", "model", "error"]
