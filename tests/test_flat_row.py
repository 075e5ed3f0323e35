from datetime import date

from pyspark.sql import functions as F

from tamarack.operators import obligations
from tamarack.plans.corpus import documents
from tamarack.plans.extraction import extract_documents
from tamarack.plans.queries import flat_row
from tests.conftest import SMALL


def test_what_nobody_selects_is_not_computed(spark):
    spark.conf.set("spark.sql.debug.maxToStringFields", "100000")
    try:
        plan = flat_row(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    for told in ("Names look plausible", "Clean OCR text", "Filename matches", "Lump Sum Payment", "Dismiss if Paid"):
        assert told not in plan
    # what a file's name gives is looked for in one place, not again after the merge
    assert plan.count("_-_DAGREED,") == 1


def test_reasons_and_details_are_there_when_selected(spark):
    rows = extract_documents(documents(spark, SMALL), as_of=F.lit(date(2026, 11, 26)))
    assert "_named_case" not in rows.columns and "_c_pay" not in rows.columns
    r = rows.where("k % 4 = 0").select("outcome_details", "confidence_details").first()
    assert "Dismiss if Paid" in r.outcome_details and "filename_consistency=1.00 (Filename matches)" in r.confidence_details


def test_a_day_to_vacate_by_stands_before_the_full_stop(spark):
    texts = ["D shall vacate by 3/4/2024", "Def. shall vacate the premises\nnot later, by March 5, 2024", "D must vacate the premises. By 3/4/2024 he pays", "vacate the premises at 3/4/2024"]
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "k int, text string")
    got = obligations.obligations(rows, "text", F.lit(date(2024, 1, 1))).orderBy("k").select("mandatory_vacate_date").collect()
    assert [r[0] for r in got] == ["2024-03-04", "2024-03-05", None, None]
