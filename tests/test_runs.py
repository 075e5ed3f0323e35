"""Runs over folders: listing, batches, one commit each, and crashes at each step."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tamarack.plans.extraction import extract_documents
from tamarack.sources import runs
from tamarack.sources.files import read_results, read_texts
from tamarack.sources.sinks import write_csv
from tamarack.streaming.ingest import run_incremental

TEXT = "Defendant shall pay $100.00 on or before 2/1/2024"


def records(df):
    """Enough of a record for flat rows, without the plan of extraction; a text ``bad`` fails."""
    kind = "array<struct<payment_number:int,due_date:string,payment_type:string,amount:string,month_rent:string,time:string,extra_text:string,raw_text:string>>"
    from tamarack.sources.sinks import RECORD

    out = df.withColumns({c: F.lit(None).cast("string") for c in RECORD if c not in df.columns and c != "payment_schedule"})
    out = out.withColumn("payment_schedule", F.array().cast(kind)).withColumn("plaintiff", F.col("text"))
    return out.withColumns({c: F.lit(None).cast("string") for c in ("errors", "ocr_changes", "ocr_backend") if c not in out.columns}).withColumn("error", F.when(F.col("text") == "bad", "unreadable"))


def made(folder, names):
    os.makedirs(folder, exist_ok=True)
    for n in names:
        with open(f"{folder}/{n}", "w") as f:
            f.write("bad" if "bad" in n else f"text of {n}")


def ran(spark, source, out, resume=True, per_batch=2, seen=None, kind="csv"):
    def read(paths):
        df = read_texts(spark, paths, glob="")
        if seen is not None:
            seen.extend(os.path.basename(p) for p in df.inputFiles())
        return df

    return runs.run(spark, str(source), "*.txt", runs.Output(spark, str(out), kind), read, records, resume, per_batch)


def names(spark, out):
    return sorted(r.source_file for r in read_results(spark, str(out)).collect())


def test_batches_counters_and_errors(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    made(src, ["c.txt", "a.txt", "bad.txt", "e[1].txt", "d *.txt", "5% + 1.txt", "x.pdf"])
    assert ran(spark, src, out, resume=False) == {"ok": 5, "failed": 1, "skipped": 0, "total": 6}
    assert names(spark, out) == ["5% + 1.txt", "a.txt", "c.txt", "d *.txt", "e[1].txt"]
    assert read_results(spark, str(out)).where("plaintiff = concat('text of ', source_file)").count() == 5
    assert [tuple(r) for r in spark.read.json(f"{out}.errors").select("file", "error").collect()] == [("bad.txt", "unreadable")]
    assert len(runs.Output(spark, str(out)).committed()) == 3
    with pytest.raises(FileExistsError):
        ran(spark, src, out, resume=False)


def test_resume_reads_new_and_failed_files_only(spark, tmp_path):
    src, out, seen = tmp_path / "in", tmp_path / "out", []
    made(src, ["a.txt", "b.txt", "bad.txt"])
    ran(spark, src, out, resume=False)
    made(src, ["c.txt"])
    assert ran(spark, src, out, seen=seen) == {"ok": 1, "failed": 1, "skipped": 2, "total": 4}
    assert sorted(seen) == ["bad.txt", "c.txt"] and names(spark, out) == ["a.txt", "b.txt", "c.txt"]
    # what is compared before is the listing: the scan asks for no content
    todo = runs.left(runs.listed(spark, str(src), "*.txt"), runs.Output(spark, str(out)).done())
    plan = todo._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan and sorted(r.source_file for r in todo.collect()) == ["bad.txt"]
    # its metrics too: names are listed, but not one byte of a file is read
    assert {r.source_file: r.length for r in runs.listed(spark, str(src), "*.txt").collect()} == {n: os.path.getsize(src / n) for n in ("a.txt", "b.txt", "bad.txt", "c.txt")}


def test_rows_of_runs_before_batches_count(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    made(src, ["a.txt", "b.txt"])
    write_csv(records(read_texts(spark, str(src)).where("filename = 'a'")), str(out))
    assert ran(spark, src, out) == {"ok": 1, "failed": 0, "skipped": 1, "total": 2}
    assert sorted(names(spark, out)) == ["a.txt", "b.txt"]


def test_json_rows(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    made(src, ["a.txt", "b.txt"])
    ran(spark, src, out, resume=False, kind="json")
    made(src, ["c.txt"])
    assert ran(spark, src, out, kind="json")["skipped"] == 2
    assert sorted(r.plaintiff for r in spark.read.json(str(out)).collect()) == [f"text of {n}.txt" for n in "abc"]


@pytest.mark.parametrize("step", ["before the manifest", "inside the manifest", "before the parts move", "between parts", "after a batch"])
def test_crashes(spark, tmp_path, monkeypatch, step):
    """Wherever a run dies, the next one leaves each file's row once."""
    src, out = tmp_path / "in", tmp_path / "out"
    made(src, [f"{k}.txt" for k in range(5)])
    left = [2]

    def dies(when):
        left[0] -= when
        if not left[0]:
            raise KeyboardInterrupt(step)

    with monkeypatch.context() as m:
        sign, publish, move = runs.Output._sign, runs.Output.publish, runs.Output._move
        if step == "before the manifest":
            m.setattr(runs.Output, "_sign", lambda self, *a: (dies(1), sign(self, *a)))
        elif step == "inside the manifest":
            m.setattr(runs.Output, "_move", lambda self, old, new: (dies(new.endswith(".json")), move(self, old, new)))
        elif step == "before the parts move":
            m.setattr(runs.Output, "publish", lambda self, *a: (dies(1), publish(self, *a)))
        elif step == "between parts":
            m.setattr(runs.Output, "_move", lambda self, old, new: (move(self, old, new), dies("/rows/" in old)))
        else:
            m.setattr(runs.Output, "publish", lambda self, *a: (publish(self, *a), dies(1)))
        with pytest.raises(KeyboardInterrupt):
            ran(spark, src, out, resume=False)
    told = ran(spark, src, out)
    assert sorted(names(spark, out)) == [f"{k}.txt" for k in range(5)] and told["ok"] + told["skipped"] == 5
    # done files were not done again, and nothing is left of what was dropped
    assert told["skipped"] == (2 if step in ("before the manifest", "inside the manifest") else 4)
    assert {os.path.basename(x) for x in glob.glob(f"{out}/_batches/*")} == {y for b in runs.Output(spark, str(out)).committed() for y in (b, f"{b}.json")}


def test_a_batch_of_a_stream_that_is_run_again(spark, tmp_path, monkeypatch):
    """A crash behind the commit: the engine runs the batch again, and its rows are there once."""
    src, out, ck = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    made(src, [])
    for n in ("a.txt", "b.txt"):
        (src / n).write_text(TEXT)
    publish = runs.Output.publish
    with monkeypatch.context() as m:
        m.setattr(runs.Output, "publish", lambda self, *a: (publish(self, *a), 1 / 0))
        with pytest.raises(Exception):
            run_incremental(spark, str(src), out, ck)
    assert sorted(names(spark, out)) == ["a.txt", "b.txt"]
    (src / "c.txt").write_text(TEXT)
    run_incremental(spark, str(src), out, ck)
    assert sorted(names(spark, out)) == ["a.txt", "b.txt", "c.txt"]


def test_one_pass_over_records(spark, tmp_path):
    """Counters, rows and errors come from one run of the extraction."""
    src, out, log = tmp_path / "in", tmp_path / "out", tmp_path / "log"
    made(src, ["a.txt", "bad.txt", "c.txt"])
    path = str(log)

    @F.udf("string")
    def noted(text):
        with open(path, "a") as f:
            f.write("x\n")
        return text

    df = records(read_texts(spark, str(src)).withColumn("text", noted.asNondeterministic()("text")))
    made_ = runs.Output(spark, str(out)).commit(df)
    assert (made_["ok"], made_["failed"]) == (2, 1) and len(log.read_text().split()) == 3
    assert extract_documents(read_texts(spark, str(src))).columns
