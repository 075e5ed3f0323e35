import json

from pyspark.sql import functions as F

from tamarack import backends
from tamarack.config import Settings
from tamarack.evaluate import evaluate, gate
from tamarack.plans.extraction import extract_documents
from tamarack.plans.services import extract_with_model
from tamarack.sources import files, sinks
from tamarack.streaming.ingest import run_incremental

TEXT = "Defendant shall pay $100.00 on or before 2/1/2024"


def test_texts_results_and_resume(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    for n in ("b.txt", "a.x.txt"):
        (src / n).write_text(TEXT)
    (src / "c.pdf").write_bytes(b"%PDF")
    rows = files.read_texts(spark, str(src))
    assert {(r.source_file, r.filename) for r in rows.select("source_file", "filename").collect()} == {("b.txt", "b"), ("a.x.txt", "a.x")}
    assert [r.source_file for r in files.read_pdfs(spark, str(src)).select("source_file").collect()] == ["c.pdf"]
    sinks.write_csv(extract_documents(rows.where("filename = 'b'")), str(out))
    back = files.read_results(spark, str(out))
    assert len(back.columns) == 99 and back.first().payment_1_amount == "100.00"
    assert [r.source_file for r in files.skip_done(rows, back).collect()] == ["a.x.txt"]
    record = json.loads(sinks.records(extract_documents(rows.where("filename = 'b'"))).first()["value"])
    assert record["outcome_type"] == "Pay and Stay" and "text" not in record and record["plaintiff"] is None


def test_stream_takes_each_file_once(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text(TEXT)
    run = lambda: run_incremental(spark, str(src), str(tmp_path / "out"), str(tmp_path / "ck"))
    run()
    (src / "b.txt").write_text(TEXT)
    run()
    assert sorted(r.source_file for r in files.read_results(spark, str(tmp_path / "out")).collect()) == ["a.txt", "b.txt"]


class Pages:
    def pages(self, pdf, dpi):
        if pdf == b"bad":
            raise ValueError("broken")
        return [bytes([x]) for x in pdf]


class Reader:
    def __init__(self):
        self.calls = 0

    def read(self, png):
        self.calls += 1
        if self.calls == 1:
            raise RuntimeError("429 too many")
        return f"page {png[0]}"


def test_back_ends(spark):
    pdfs = spark.createDataFrame([("a.pdf", "a", bytearray([1, 2])), ("b.pdf", "b", bytearray([3])), ("c.pdf", "c", bytearray(b"bad"))], "source_file string, filename string, content binary").coalesce(1)
    pages = backends.rasterize(pdfs, Pages)
    got = {r.filename: r for r in backends.join_pages(backends.read_pages(pages, Reader, wait=_no_wait)).collect()}
    assert got["b"].text == "page 3"
    assert got["a"].text == "\n\n\n=== PAGE 1 ===\n\n\npage 1\n\n\n=== PAGE 2 ===\n\n\npage 2"
    assert got["c"].error.startswith("ValueError")


class Answers:
    def answer(self, text):
        if "fail" in text:
            raise ValueError("no")
        return '{"plaintiff": "From Model", "outcome_type": "Settlement"}'


class Second:
    def answer(self, text):
        return '{"outcome_type": "Vacate Only", "reasoning": "why"}'


def test_model_answers(spark):
    rows = spark.createDataFrame([(1, None, "nothing"), (2, None, "fail")], "k int, filename string, text string")
    got = {r.k: r for r in extract_with_model(rows, "k", Answers, Second).collect()}
    assert (got[1].plaintiff, got[1].outcome_type, got[1].outcome_details, got[1].extraction_method) == ("From Model", "Vacate Only", "why", "LLM+Regex+Reclassified")
    assert (got[2].plaintiff, got[2].extraction_method) == (None, "Regex-only+Reclassified")


class Counted:
    """Answers, and a line in a file for each call."""

    def __init__(self, path, kind):
        self.path, self.kind = path, kind

    def answer(self, text):
        with open(self.path, "a") as f:
            f.write("x\n")
        return '{"outcome_type": "%s", "reasoning": "why"}' % self.kind


def test_each_call_is_made_once(spark, tmp_path):
    rows = spark.createDataFrame([(k, None, f"text {k}" + (" Agreed entry" if k % 2 else " pay $5")) for k in range(6)], "k int, filename string, text string")
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    out = extract_with_model(rows, "k", lambda: Counted(one, "Settlement"), lambda: Counted(two, "Vacate Only"))
    for _ in range(2):
        assert sorted(r.k for r in out.select("k", "outcome_type", "confidence_score").collect()) == list(range(6))
    vague = out.where("extraction_method like '%Reclassified'").count()
    assert len(open(one).readlines()) == 6 and len(open(two).readlines()) == vague > 0


def _no_wait(seconds):
    pass


def test_settings_and_evaluation(spark):
    s = Settings.from_env({"LLM_API_KEY": "k", "USE_LLM": "false", "PDF_DPI": "200"})
    assert not s.calls_model() and s.pdf_dpi == 200 and s.for_ocr()[0] == "k"
    rows = spark.createDataFrame([("a", "X ", "10.001")], "filename string, who string, n string")
    truth = spark.createDataFrame([("a", "who", "x"), ("a", "n", "10"), ("b", "who", None)], "filename string, field string, expected string")
    assert {r.field: (r.n, r.n_correct) for r in evaluate(rows, truth).collect()} == {"who": (2, 2), "n": (1, 1)}


def test_totals_and_floors(spark):
    kind = "filename string, who string, amount string, payment_schedule array<struct<a:int>>"
    rows = spark.createDataFrame([("a", "X", "10.001", [(1,), (2,)]), ("b", "Y", None, []), ("c", "Z", "3", None)], kind)
    truth = spark.createDataFrame([(f, c, e) for f, who, amount, n in (("a", "x ", "10", "2"), ("b", "y", None, "0"), ("c", "no", "4", "0"), ("d", "q", "1", "1")) for c, e in (("who", who), ("amount", amount), ("payment_count", n))], "filename string, field string, expected string")
    got = {r.field: (r.n, r.n_correct, r.accuracy) for r in evaluate(rows, truth, overall=True).collect()}
    assert got == {"who": (4, 2, 0.5), "amount": (4, 2, 0.5), "payment_count": (4, 3, 0.75), "overall": (12, 7, 7 / 12)}
    told = {r.field: (r.n, r.floor, r.met) for r in gate(rows, truth, {"who": 0.5, "payment_count": 0.8, "overall": 0.5, "case_number": 0.9}).collect()}
    assert told == {"who": (4, 0.5, True), "amount": (4, None, None), "payment_count": (4, 0.8, False), "overall": (12, 0.5, True), "case_number": (0, 0.9, False)}
    assert {r.met for r in gate(rows.limit(0), truth.limit(0)).collect() if r.floor is not None} == {False}


def test_truth_file(spark, tmp_path):
    (tmp_path / "cases.json").write_text(json.dumps([{"filename": "a", "text_file": "a.txt", "expected": {"plaintiff": "X", "payment_count": 2, "mandatory_vacate_date": None}}]))
    rows = files.read_truth(spark, str(tmp_path / "cases.json"))
    assert {(r.filename, r.field, r.expected) for r in rows.collect()} == {("a", "plaintiff", "X"), ("a", "payment_count", "2"), ("a", "mandatory_vacate_date", None)}


def test_counts(spark):
    r = sinks.summary(spark.createDataFrame([(None,), ("x",)], "error string").withColumn("source_file", F.lit("f")), 3).first()
    assert (r.ok, r.failed, r.skipped, r.total) == (1, 1, 3, 5)
