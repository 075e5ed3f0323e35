import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tamarack.functions.dates import TEXT_FULL
from tamarack.operators import clean, fixups, flatten, obligations, parties, payments
from tamarack.plans.extraction import extract, extract_documents



def day():
    return F.lit("2026-11-26").cast("date")


def texts(spark, *ts):
    return spark.createDataFrame([(k, t) for k, t in enumerate(ts)], "k int, text string")


def test_clean(spark):
    rows = texts(spark, "Pay $1,O00.00 now", "on November 31, 2024", "on November 30, 2024", "a\n\n\n\n\nb", "", None, "fine text", "Feb. x February 29 y $Nov rent",
                 "Payment Plan:\n2/1/2024 b\n1/1/2024 a\nnone\n\n\nafter", "13/40/2024 and 2/29/2024")
    got = {r.k: (r.cleaned_text, r.ocr_changes) for r in clean.clean(rows).collect()}
    assert got[0] == ("Pay $1,000.00 now", ["Fixed money: $1,O00.00 -> $1,000.00"])
    assert got[1] == ("on November 31, 2024 [INVALID DATE]", ["Invalid date: November 31, 2024"])
    assert got[2] == ("on November 30, 2024", [])
    assert got[3] == ("a\n\n\nb", [])
    assert got[4] == ("", []) and got[5] == ("", []) and got[6] == ("fine text", [])
    assert got[7][0].startswith("Feb. x February 29  [INVALID DATE]".replace("  ", " ")[:18]) and "$N0v rent" in got[7][0]
    assert got[8][0] == "Payment Plan\n1/1/2024 a\n2/1/2024 b\nnone\n\nafter" and got[8][1] == ["Reordered payment schedule chronologically"]
    assert got[9] == ("13/40/2024 [INVALID DATE] and 2/29/2024", ["Invalid date: 13/40/2024"])


def test_parties(spark):
    rows = texts(spark, "Sunrise Apartments LLC\nPlaintiff,\nv.\nJohn Smith\nDefendant.", "nothing here", "ACME, INC., PLAINTIFF(S) v. JANE DOE, DEFENDANT(S)",
                 "<table><tr><td>MUNICIPAL COURT</td></tr><tr><td>Blue</td><td>Plaintiff,</td></tr><tr><td>X</td><td>Defendant</td></tr></table>", None)
    got = {r.k: (r.plaintiff, r.defendant) for r in parties.parties(rows, "text").collect()}
    assert got[0] == ("Sunrise Apartments LLC", "John Smith")
    assert got[1] == (None, None) and got[4] == (None, None)
    assert got[2][0].startswith("ACME")
    assert got[3][0] == "Blue"


def test_payments(spark):
    rows = texts(spark, "- $2538.52 on or before 1/31/2024\n- $700.00 on or before 2/29/2024", "none", "<table><tr><td>$</td><td>300</td><td>1/5/2024</td></tr><tr><td>$____</td><td>2/5/2024</td></tr></table>",
                 "a sum in the amount of $900 represents rent; $5,000.00 in full to be paid by May 1st, 2024", None)
    got = {r.k: r for r in payments.payments(rows, "text", day()).collect()}
    assert [(p.amount, p.due_date, p.payment_number) for p in got[0].payment_schedule] == [("2538.52", "2024-01-31", 1), ("700.00", "2024-02-29", 2)]
    assert got[0].total_payment_sum == "3238.52"
    assert got[1].payment_schedule == [] and got[1].total_payment_sum is None and got[4].payment_schedule == []
    assert [(p.amount, p.due_date) for p in got[2].payment_schedule] == [("300", "2024-01-05")]
    assert [(p.amount, p.due_date) for p in got[3].payment_schedule] == [("5000.00", "2024-05-01")]


def test_obligations(spark):
    rows = texts(spark, "Defendant shall vacate the premises on or before March 26th, 2024.", "If Defendant breaches he agrees to vacate the premises by 1/1/2024.", "Acknowledges receipt of notice. Defendant agrees to vacate the premises by 1/1/2024.", None)
    got = {r.k: r for r in obligations.obligations(rows, "text", day()).collect()}
    assert got[0].mandatory_vacate_date == "2024-03-26" and got[0].outcome_type == "Vacate Only"
    assert got[1].mandatory_vacate_date is None and got[2].mandatory_vacate_date is None


def test_places_count_code_points(spark):
    near = "On breach " + "\U0001f600" * 5 + "x" * 116 + " Defendant shall vacate the premises by 1/2/2024."
    far = "On breach " + "\U0001f600" * 5 + "x" * 176 + " Defendant shall vacate the premises by 1/2/2024."
    got = {r.k: r.mandatory_vacate_date for r in obligations.obligations(texts(spark, near, far), "text", day()).collect()}
    assert got == {0: None, 1: "2024-01-02"}


def test_long_captions(spark):
    many = "\n".join(["Capital line"] * 60)
    rows = texts(spark, f"IN THE FRANKLIN COUNTY MUNICIPAL COURT\n{many}\nPlaintiff\n\nZed Homes, Plaintiff,", "x\nab Acme Inc\nand Sons Ltd\n  Sunrise\nLLC,\n\n ,\n Plaintiff", "no capital\nplaintiff\n\nBlue Sky,\nPlaintiff",
                 "abc\nPlaintiff Foo\nPlaintiff", "Homes\nPlaintiff\nOther\nPlaintiff")
    got = {r.k: r.plaintiff for r in parties.parties(rows, "text").collect()}
    assert got == {0: "Zed Homes", 1: "Sunrise LLC", 2: "Blue Sky", 3: "Plaintiff Foo", 4: "Homes"}


def test_lines_above_the_label_as_python_finds_them(spark):
    rnd = random.Random(5)
    bits = ["A", "Bc", "d", " ", ",", "\n", "\n", "\n", "Plaintiff", "PLAINTIFF", "Plain", "é", "Ab cd"]
    ts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 25))) for _ in range(3000)]
    form = re.compile(r"([A-Z][^\n]+(?:\n[A-Z][^\n]+)*?)\s*[,]?\s*\n\s*(?:Plaintiff|PLAINTIFF)")
    got = {r.k: r.b for r in texts(spark, *ts).select("k", parties._block_above(F.col("text")).alias("b")).collect()}
    for k, x in enumerate(ts):
        m = form.search(x)
        assert (got[k] and got[k].strip()) == (m and m[1].strip()), (x, got[k], m and m[1])


def test_no_length_is_cut(spark):
    run = "5" * 1_200_000 + "O"
    assert len(clean.clean(texts(spark, "$" + run)).first().cleaned_text) == len(run) + 1


def test_known_plaintiffs(spark):
    rows = spark.createDataFrame([("Delamere",), ("s8'12",), ("vinebr00k homes",), ("Unknown LLC",), ("x",), (None,)], "n string")
    assert [r.p for r in rows.select(fixups.known_plaintiff(F.col("n")).alias("p")).collect()] == ["Elam", "S81", "Vinebrook", None, None, None]


DOC = "IN THE COURT\n\nSunrise LLC,\nPlaintiff,\n\nv.\n\nJohn Smith,\nDefendant.\n\nDefendant shall pay $100.25 on or before 2/1/2024.\n"


def test_whole_plan_and_filters(spark):
    rows = spark.createDataFrame([("2024_CVG_000123_x_-_1_22_2024_-_DAGREED_x_cleaned.txt", DOC), (None, None)], "filename string, text string")
    out = extract_documents(rows, as_of=day())
    flat = {r.filename: r for r in flatten.flatten(out).collect()}
    r = flat["2024_CVG_000123_x_-_1_22_2024_-_DAGREED_x_cleaned.txt"]
    assert (r.case_number, r.agreement_signed_date, r.plaintiff, r.defendant, r.outcome_type) == ("2024 CVG 000123", "2024-01-22", "Sunrise LLC", "John Smith", "Pay and Stay")
    assert (r.payment_count, r.payment_1_amount, r.total_payment_sum, r.extraction_method) == (1, "100.25", "100.25", "Regex-only")
    assert len(r) == 98
    assert flat[None].outcome_type == "Unknown"


@pytest.mark.parametrize("column", ["plaintiff", "outcome_type"])
def test_conditions_on_results_plan_quickly(spark, column):
    rows = spark.createDataFrame([("a", DOC)], "filename string, text string")
    assert extract(rows, as_of=day()).where(f"{column} is not null").count() == 1


def test_long_text_is_no_stack_overflow(spark):
    long = "\n".join(["Capital line of words"] * 3000) + "\nPlaintiff,\n"
    assert parties.parties(texts(spark, long), "text").select("plaintiff").collect()[0][0] is None
    assert TEXT_FULL


def test_a_label_without_its_ending_costs_no_more_than_the_line(spark):
    """Labels that end no caption in a line of 40,000 characters: every start was tried over the rest of the line."""
    line = "<signature>Ann Homes</signature> for plaintiff here " + "x " * 20_000 + "<signature>Bob</signature> defendant"
    began = time.time()
    assert [tuple(r) for r in parties.parties(texts(spark, line), "text").select("plaintiff", "defendant").collect()] == [("Ann Homes", "Bob")]
    assert time.time() - began < 30
