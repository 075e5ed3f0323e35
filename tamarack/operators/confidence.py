"""A confidence score for each row from six signals, with its label and the reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.functions.numbers import round2, two_places
from tamarack.functions.regex import blank, contains_any, strip, sub
from tamarack.operators.fixups import EARLY, LATE

#: Weights of the signals, in the order they are added.
WEIGHTS = (("method_agreement", 0.25), ("field_completeness", 0.15), ("filename_consistency", 0.05), ("payment_validity", 0.20), ("ocr_quality", 0.15), ("name_plausibility", 0.20))
HIGH, MEDIUM = 0.85, 0.60
#: Parts of words that show a business.
ENTITIES = (
    "llc", "inc", "corp", "ltd", "lp", "lc", "group", "properties", "property", "prop", "realty", "real estate", "real", "rentals", "rental",
    "apartments", "apts", "apt", "housing", "homes", "home", "management", "mgmt", "investments", "investment", "associates", "company", "co.",
    "partners", "capital", "solutions", "services", "trust", "foundation", "church", "residences", "communities", "dba", "d/b/a", "estate", "estates",
)
#: Labels of a form that are no names, as compared after trailing marks are cut.
FORM_LABELS = ("plaintiff", "plaintiffs", "plaintiff(s)", "plaintiff,", "defendant", "defendants", "defendant(s)", "defendant,", "v.", "vs.", "vs")


# The scores and the wordings of reasons below are fixed values too; each stands with its signal.
#
# A signal is a score and a reason in two columns, so that reasons nobody selects cost nothing.  What several of them look
# at is a column of an earlier step (:func:`_seen`), computed once for a row.


def _sig(score, reason) -> tuple[Column, Column]:
    return (F.lit(score) if isinstance(score, float) else score).cast("double"), F.lit(reason) if isinstance(reason, str) else reason


def _choose(*cases: tuple[Column | None, float | Column, str | Column]) -> tuple[Column, Column]:
    """The signal of the first case whose condition holds; the last has none."""
    score, reason = F, F
    for when, *told in cases[:-1]:
        s, r = _sig(*told)
        score, reason = score.when(when, s), reason.when(when, r)
    s, r = _sig(*cases[-1][1:])
    return score.otherwise(s), reason.otherwise(r)


def _text(x: Column) -> Column:
    return x.cast("string")


def _seen(df: DataFrame) -> DataFrame:
    """``df`` with what the signals look at, in columns that begin with ``_c``."""
    digits = lambda c: sub(c, "[^0-9]+")
    o, case, date = F.lower(F.coalesce(F.col("outcome_type"), F.lit(""))), F.col("case_number"), F.col("agreement_signed_date")
    text = F.coalesce(F.nullif(F.col("cleaned_text"), F.lit("")), F.col("text"), F.lit(""))

    def state(p: Column) -> Column:
        amount, due = p["amount"].isNotNull() | p["month_rent"].isNotNull(), p["due_date"].isNotNull()
        flagged = contains_any(F.coalesce(p["extra_text"], F.lit("")), (EARLY, LATE))
        return F.when(flagged, "flagged").when(amount & due, "well").when(amount | due, "partial").otherwise("")

    out = df.withColumns({
        "_c_pay": F.contains(o, F.lit("pay")), "_c_vacate": F.contains(o, F.lit("vacate")),
        "_c_name": digits(F.col("filename")), "_c_case": digits(case), "_c_plain": F.translate(F.col("filename"), "_- ", ""), "_c_year": F.substring(digits(date), 1, 4),
        "_c_n": F.size("payment_schedule"), "_c_states": F.transform("payment_schedule", state),
        "_c_size": F.length(text), "_c_unsure": F.when(F.contains(text, F.lit("[?]")), F.length(text) - F.length(F.replace(text, F.lit("[?]"), F.lit("")))).otherwise(F.when(text.isNotNull(), 0)),
        "_c_warned": F.exists("errors", lambda e: contains_any(F.lower(e), ("ocr", "artifact"))),
        "_c_p": strip(F.coalesce(F.col("plaintiff"), F.lit(""))), "_c_d": strip(F.coalesce(F.col("defendant"), F.lit(""))),
    })
    count = lambda s: F.size(F.filter("_c_states", lambda x: x == s))
    gaps = [F.when(blank(F.col(c)), c) for c in ("case_number", "plaintiff", "defendant", "outcome_type")]
    gaps.append(F.when(F.col("_c_pay") & (F.col("_c_n") == 0), "payment_schedule (expected for Pay outcome)").when(~F.col("_c_pay") & F.col("_c_vacate") & blank(F.col("mandatory_vacate_date")), "mandatory_vacate_date (expected for Vacate outcome)"))
    return out.withColumns({
        "_c_missing": F.array_compact(F.array(*gaps)), "_c_well": count("well"), "_c_partial": count("partial"), "_c_flagged": count("flagged"), "_c_unsure": (F.col("_c_unsure") / 3).cast("int"),
        "_c_has_case": ~blank(case), "_c_has_date": ~blank(date), "_c_case_ok": (F.col("_c_case") != "") & F.contains("_c_name", F.col("_c_case")), "_c_date_ok": F.contains("_c_plain", F.col("_c_year")),
    })


def method_agreement() -> tuple[Column, Column]:
    m = F.coalesce(F.col("extraction_method"), F.lit(""))
    overridden = F.exists("errors", lambda e: F.contains(F.lower(e), F.lit("overriding")))
    return _choose(
        (F.contains(m, F.lit("LLM+Regex")) & overridden, 0.6, "LLM+Regex ran but outcome was overridden (disagreement resolved)"),
        (F.contains(m, F.lit("LLM+Regex")), 1.0, "LLM and Regex both ran and agreed"),
        (F.contains(m, F.lit("Regex-only")), 0.4, "Regex-only (no LLM cross-validation)"),
        (None, 0.3, F.concat(F.lit("Single extraction method: "), m)),
    )


def field_completeness() -> tuple[Column, Column]:
    missing = F.col("_c_missing")
    score = F.greatest(F.lit(0.1), (5 - F.size(missing)) / F.lit(5.0))
    return _sig(score, F.when(F.size(missing) > 0, F.concat(F.lit("Missing: "), F.array_join(missing, ", "))).otherwise("All expected fields populated"))


def filename_consistency() -> tuple[Column, Column]:
    has_case, has_date, case_ok, date_ok = (F.col(f"_c_{c}") for c in ("has_case", "has_date", "case_ok", "date_ok"))
    total = F.when(has_case, 1).otherwise(0) + F.when(has_date, 1).otherwise(0)
    passed = F.when(has_case & case_ok, 1).otherwise(0) + F.when(has_date & date_ok, 1).otherwise(0)
    issues = F.concat_ws("; ", F.when(has_case & ~case_ok, "case_number not found in filename"), F.when(has_date & ~date_ok, "agreement_date not matched in filename"))
    return _choose(
        (blank(F.col("filename")), 0.5, "No filename available for validation"),
        (total == 0, 0.5, "No fields to validate against filename"),
        (None, F.try_divide(passed, total), F.when(issues == "", "Filename matches").otherwise(issues)),
    )


def payment_validity() -> tuple[Column, Column]:
    pay, vacate, n, well, partial, flagged = (F.col(f"_c_{c}") for c in ("pay", "vacate", "n", "well", "partial", "flagged"))
    quality = F.try_divide(well + 0.5 * (partial + flagged), n)
    issues = F.concat_ws(
        "; ", F.when(flagged > 0, F.concat(_text(flagged), F.lit(" payment(s) with date anomaly"))),
        F.when(partial > 0, F.concat(_text(partial), F.lit(" payment(s) missing date or amount"))), F.when(well == n, "All payments have amount and date"),
    )
    return _choose(
        (vacate & ~pay & (n == 0), 1.0, "Vacate-only with no payments (expected)"),
        (pay & (n == 0), 0.2, "Pay-type outcome but no payments extracted"),
        (n == 0, 0.7, "No payments and no pay-type outcome"),
        (None, quality, F.when(issues == "", "Payments present").otherwise(issues)),
    )


def ocr_quality() -> tuple[Column, Column]:
    changes, size, unsure, warned = F.size("ocr_changes"), F.col("_c_size"), F.col("_c_unsure"), F.col("_c_warned")
    less = [
        (F.when(changes > 20, 0.3).when(changes > 10, 0.15), F.concat(_text(changes), F.lit(" OCR corrections applied"))),
        (F.when(unsure > 5, 0.3).when(unsure > 2, 0.15), F.concat(_text(unsure), F.lit(" uncertain [?] markers"))),
        (F.when(size < 200, 0.2), F.concat(F.lit("Short OCR text ("), _text(size), F.lit(" chars)"))),
        (F.when(warned, 0.2), F.lit("OCR artifact warning flagged")),
    ]
    score, issues = F.lit(1.0), []
    for take, reason in less:
        score = score - F.coalesce(take, F.lit(0.0))
        issues.append(F.when(take.isNotNull(), reason))
    told = F.concat_ws("; ", *issues)
    return _choose((size < 50, 0.1, "OCR text is empty or extremely short"), (None, F.greatest(F.lit(0.1), score), F.when(told == "", "Clean OCR text").otherwise(told)))


def name_plausibility() -> tuple[Column, Column]:
    p, d = F.col("_c_p"), F.col("_c_d")
    is_label = lambda x: F.regexp_replace(F.lower(x), r"[.,:()]+\z", "").isin(*FORM_LABELS)
    labels = F.concat_ws("; ", *[F.when(is_label(x), F.concat(F.lit(f"{who} is a form label ('"), x, F.lit("'), not an actual name"))) for who, x in (("plaintiff", p), ("defendant", d))])
    swapped = (p != "") & (d == "") & ~F.contains(p, F.lit(" ")) & ~contains_any(F.lower(p), ENTITIES)
    short = lambda who, x: F.concat(F.lit(f"{who} very short ("), _text(F.length(x)), F.lit(" chars)"))
    small = lambda x: (x != "") & (F.length(x) <= 3)
    single = ~F.contains(d, F.lit(" ")) & ~F.contains(d, F.lit(","))
    score = F.lit(1.0) - F.when(p == "", 0.4).when(small(p), 0.15).otherwise(0.0) - F.when(d == "", 0.4).when(small(d), 0.15).when(single, 0.1).otherwise(0.0)
    issues = F.concat_ws(
        "; ", F.when(p == "", F.lit("plaintiff is empty")).when(small(p), short("plaintiff", p)),
        F.when(d == "", F.lit("defendant is empty")).when(small(d), short("defendant", d)).when(single, "defendant is single word (possibly incomplete)"),
    )
    return _choose(
        (is_label(p) | is_label(d), 0.1, labels),
        (swapped, 0.2, "Likely plaintiff/defendant swap: single-word non-entity plaintiff with empty defendant"),
        (None, F.greatest(F.lit(0.1), score), F.when(issues == "", "Names look plausible").otherwise(issues)),
    )


def confidence(df: DataFrame) -> DataFrame:
    """``df`` with ``confidence_score``, ``confidence_label`` and ``confidence_details``."""
    signals = (method_agreement(), field_completeness(), filename_consistency(), payment_validity(), ocr_quality(), name_plausibility())
    seen = _seen(df)
    out = seen.withColumns({f"_s{k}": s for k, (s, _) in enumerate(signals)} | {f"_w{k}": w for k, (_, w) in enumerate(signals)})
    # the fixed scores have two places, so rounding leaves them as they are
    out = out.withColumns({f"_s{k}": round2(F.col(f"_s{k}")) for k in range(len(signals))})
    total = F.lit(WEIGHTS[0][1]) * F.col("_s0")
    for k, (_, w) in enumerate(WEIGHTS[1:], 1):
        total = total + F.lit(w) * F.col(f"_s{k}")
    out = out.withColumn("_total", total).withColumn("confidence_score", round2(F.col("_total")))
    score = F.col("confidence_score")
    told = [F.concat(F.lit(f"{name}="), two_places(F.col(f"_s{k}")), F.lit(" ("), F.col(f"_w{k}"), F.lit(")")) for k, (name, _) in enumerate(WEIGHTS)]
    return out.withColumns({
        "confidence_label": F.when(score >= HIGH, "HIGH").when(score >= MEDIUM, "MEDIUM").otherwise("LOW"),
        "confidence_details": F.concat_ws("; ", *told),
    }).drop("_total", *[f"_{c}{k}" for c in "sw" for k in range(len(signals))], *[c for c in seen.columns if c not in df.columns])
