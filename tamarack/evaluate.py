"""Accuracy of extracted fields against known answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.functions.regex import strip

TOLERANCE, OVERALL = 0.01, "overall"
#: Shares of right answers that a release is held to.
FLOORS = {"case_number": 0.95, "outcome_type": 0.85, "plaintiff": 0.80, "defendant": 0.80, "payment_count": 0.85, "mandatory_vacate_date": 0.90, "overall": 0.85}


def _compared(rows: DataFrame, truth: DataFrame) -> DataFrame:
    """A row for each known answer: ``filename``, ``field`` and whether it is right."""
    if "payment_count" not in rows.columns and "payment_schedule" in rows.columns:
        rows = rows.withColumn("payment_count", F.size(F.coalesce("payment_schedule", F.array().cast(rows.schema["payment_schedule"].dataType))))
    fields = [c for c, kind in rows.dtypes if c != "filename" and not kind.startswith(("array", "struct", "map"))]
    long = rows.select("filename", F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("actual")) for c in fields])).alias("x")).select("filename", "x.*")
    both = truth.join(long, ["filename", "field"], "left")
    a, e = F.col("actual"), F.col("expected")
    near = F.abs(a.try_cast("double") - e.try_cast("double")) <= TOLERANCE
    right = a.eqNullSafe(e) | F.coalesce(F.lower(strip(a)) == F.lower(strip(e)), F.lit(False)) | F.coalesce(near, F.lit(False))
    return both.select("filename", "field", right.alias("right"))


def evaluate(rows: DataFrame, truth: DataFrame, overall: bool = False) -> DataFrame:
    """``field``, ``n``, ``n_correct`` and ``accuracy`` of ``rows`` (a row for each ``filename``) against
    ``truth`` (``filename``, ``field``, ``expected``), and with ``overall`` of all fields together.

    Texts are equal without regard to case and outer white space, numbers within ``TOLERANCE``; two nulls are equal.
    ``payment_count`` is the length of the schedule where ``rows`` has no such column.  One pass gives fields and total.
    """
    told = _compared(rows, truth)
    grouped = told.rollup("field") if overall else told.groupBy("field")
    out = grouped.agg(F.count(F.lit(1)).alias("n"), F.count_if("right").alias("n_correct"), F.grouping("field").alias("whole")) if overall else grouped.agg(F.count(F.lit(1)).alias("n"), F.count_if("right").alias("n_correct"))
    if overall:
        out = out.withColumn("field", F.when(F.col("whole") == 1, OVERALL).otherwise(F.col("field"))).drop("whole")
    return out.withColumn("accuracy", F.try_divide("n_correct", "n"))


def gate(rows: DataFrame, truth: DataFrame, floors: dict[str, float] | None = None) -> DataFrame:
    """:func:`evaluate` with the total, the ``floor`` of each field that has one, and whether it is ``met``.

    A field without known answers meets nothing: its row has ``n`` 0 and ``met`` false.
    """
    floors = FLOORS if floors is None else floors
    held = rows.sparkSession.createDataFrame([*floors.items()], "field string, floor double")
    out = evaluate(rows, truth, overall=True).join(F.broadcast(held), "field", "full")
    n, right = (F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "n_correct"))
    return out.select("field", n, right, "accuracy", "floor", F.when(F.col("floor").isNotNull(), F.coalesce(F.col("accuracy") >= F.col("floor"), F.lit(False))).alias("met"))
