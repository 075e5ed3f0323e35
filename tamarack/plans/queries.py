"""One query for each extraction operator over rendered documents, and its oracle from the base columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.answers import answered
from tamarack.evaluate import evaluate, gate
from tamarack.operators import case_ids, clean, confidence, fixups, flatten, merge, obligations, parties, payments, reclassify
from tamarack.plans.corpus import BASE_SQL, FILENAME, base, documents
from tamarack.plans.extraction import extract_documents
from tamarack.sources.files import skip_done
from tamarack.tables import materialize, uses

TODAY = "2026-11-26"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def today() -> Column:
    return F.lit(TODAY).cast("date")


def _add(name: str, run: Callable[[SparkSession, str], DataFrame], oracle: str | None) -> None:
    QUERIES[name] = run
    if oracle is not None:
        ORACLE_SQL[name] = f"{BASE_SQL}\n{oracle}"


def _on_text(name: str, text: str, build: Callable[[DataFrame], DataFrame], oracle: str) -> None:
    """A query over ``text``, an SQL expression of the base columns."""
    _add(name, lambda spark, sf: build(base(spark, sf).selectExpr("*", f"{text} as text", "cast(null as string) as filename")), oracle)


def _col(name: str, make: Callable[[], Column]):
    return lambda df: df.select("k", make().alias(name))


t = lambda: F.col("text")
f = lambda: F.col("filename")

# identifiers and dates
_add("case_number_filename", lambda s, sf: base(s, sf).selectExpr("k", f"{FILENAME} as filename").select("k", case_ids.case_number(F.lit(""), f()).alias("case_number")),
     "select k, year(d) || ' CVG ' || no as case_number from b")
_on_text("case_number_text", "case k % 3 when 0 then concat('x\\nCase No. ', year(d), ' CVG ', no, '\\n') when 1 then concat('Case No: ', year(d), 'CVG', no) else concat('in ', substring(year(d), 3, 2), '_CVG_', substring(no, 2, 5), ' of') end",
         _col("case_number", lambda: case_ids.case_number(t(), f())),
         "select k, case k % 3 when 0 then year(d) || ' CVG ' || no when 1 then year(d) || 'CVG' || no else '20' || substring(cast(year(d) as varchar), 3, 2) || ' CVG ' || substring(no, 2, 5) end as case_number from b")
_add("agreement_date_filename", lambda s, sf: base(s, sf).selectExpr("k", f"{FILENAME} as filename").select("k", case_ids.agreement_date(F.lit(""), f(), today()).alias("agreement_signed_date")),
     "select k, i0 as agreement_signed_date from b")
_on_text("agreement_date_text", "case k % 4 when 0 then concat('JUDGE A. Smith\\n', m0) when 1 then concat('MAGISTRATE Jones, ', t0) when 2 then concat('<watermark>', upper(date_format(d, 'yyyy MMM d')), ' AM 9:15</watermark>') else concat('Date: <signature>X</signature> ', m0) end",
         _col("agreement_signed_date", lambda: case_ids.agreement_date(t(), f(), today())), "select k, i0 as agreement_signed_date from b")

# cleaning
_on_text("clean_money", "concat('Pay $', replace(amt, '0', 'O'), ' now')", lambda df: clean.clean(df).select("k", "cleaned_text", F.size("ocr_changes").cast("long").alias("n_changes")),
         "select k, 'Pay $' || amt || ' now' as cleaned_text, cast(case when contains(amt, '0') then 1 else 0 end as bigint) as n_changes from b")
_on_text("clean_dates", "concat('Due ', month(d), '/', day(d) + 20, '/', year(d), ' at noon')", lambda df: clean.clean(df).select("k", "cleaned_text", F.size("ocr_changes").cast("long").alias("n_changes")),
         "select k, 'Due ' || month(d) || '/' || (day(d) + 20) || '/' || year(d) || (case when day(d) + 20 > day(last_day(d)) then ' [INVALID DATE]' else '' end) || ' at noon' as cleaned_text, cast(case when day(d) + 20 > day(last_day(d)) then 1 else 0 end as bigint) as n_changes from b")
_on_text("clean_order", "concat('Payment Schedule:\\n', case when k % 2 = 0 then concat('first ', m15, '\\nthen ', m45) else concat('then ', m45, '\\nfirst ', m15) end, '\\nno date\\n')",
         lambda df: clean.clean(df).select("k", "cleaned_text", F.size("ocr_changes").cast("long").alias("n_changes")),
         "select k, 'Payment Schedule' || chr(10) || 'first ' || m15 || chr(10) || 'then ' || m45 || chr(10) || 'no date' as cleaned_text, cast(k % 2 as bigint) as n_changes from b")
_on_text("clean_whitespace", "concat('  a', repeat('\\n', cast(2 + k % 5 as int)), 'b   c[--- PAGE 3 START ---]d[--- PAGE 3 END ---] ')", lambda df: clean.clean(df).select("k", "cleaned_text"),
         "select k, 'a' || repeat(chr(10), case when k % 5 >= 2 then 3 else cast(2 + k % 5 as integer) end) || 'b c' || chr(10) || chr(10) || '=== PAGE 3 ===' || chr(10) || chr(10) || 'd' as cleaned_text from b")

# parties
_who = lambda df: parties.parties(df, "text").select("k", "plaintiff", "defendant")
_parties = "select k, nat || ' Homes' as plaintiff, cust as defendant from b"
_on_text("parties_text", "concat('IN THE COURT\\n\\n', nat, ' Homes,\\nPlaintiff,\\n\\nv.\\n\\n', cust, ',\\nDefendant.\\n')", _who, _parties)
_on_text("parties_table", "case k % 2 when 0 then concat('<table><tr><td>', nat, ' Homes<br>Plaintiff,</td></tr><tr><td>', cust, '<br>Defendant,</td></tr></table>') else concat('<table><tr><td>', nat, ' Homes</td></tr><tr><td>:</td></tr><tr><td>Plaintiff,</td></tr><tr><td>', cust, '</td></tr><tr><td>Defendant.</td></tr></table>') end", _who, _parties)
_on_text("parties_signature", "concat('signed <signature>', nat, ' Homes</signature> for plaintiff here ', repeat('x ', 120), '<signature>', cust, '</signature> defendant')", _who, _parties)

# payments
_items = lambda df: payments.payments(df, "text", today()).select("k", "total_payment_sum", F.explode("payment_schedule").alias("p")).select(
    "k", "total_payment_sum", "p.payment_number", "p.due_date", "p.payment_type", "p.amount", "p.month_rent", "p.time", "p.extra_text")
_row = lambda n, due, amt, total, kind="'fixed_amount'", month="cast(null as varchar)", time="cast(null as varchar)", extra="cast(null as varchar)": (
    f"select k, {total} as total_payment_sum, cast({n} as integer) as payment_number, {due} as due_date, {kind} as payment_type, {amt} as amount, {month} as month_rent, {time} as time, {extra} as extra_text from b")
_on_text("payments_bullet", "concat('- $', amt, ' on or before ', m15, '\\n', repeat('. ', 40), '\\n- $', amt2, ' by ', m45, ' by 5:00 PM ', repeat('. ', 40), 'water')", _items,
         _row(1, "i15", "amt", "total") + " union all " + _row(2, "i45", "amt2", "total", time="'5:00 PM'"))
_on_text("payments_table", "concat('<table><tr><td>1.</td><td>; • $ ', amt, '</td><td>', m15, '</td><td>$March rent + late fee</td><td>', m45, '</td></tr><tr><td>$', amt2, ' by ', m45, ' 4:30 PM</td><td> </td></tr></table>')", _items,
         _row(1, "i15", "amt", "total") + " union all " + _row(2, "i45", "cast(null as varchar)", "total", "'monthly_rent'", "'March'", extra="'March rent + late fee'") + " union all " + _row(3, "i45", "amt2", "total", time="'4:30 PM'"))
_on_text("payments_text_date", "concat('$', amt, ' due ', t0, ' and utilities')", _items, _row(1, "i0", "amt", "amt", extra="'utilities'"))
_on_text("payments_prose", "case k % 3 when 0 then concat('$', amt, ' for arrears to be paid no later than ', t30) when 1 then concat('Defendant agrees to pay the sum, $', amt, ' by 5:00 PM, ', t30, '.') else concat('Defendant will pay the arrears of $', amt, ' no later than Monday ', t30, '.') end", _items,
         _row(1, "i30", "amt", "amt", time="case when k % 3 = 1 then '5:00 PM' end"))
_on_text("payments_rent", "case k % 3 when 0 then concat('July rent of $', amt, ' to be paid by ', t30) when 1 then concat('July rent will be paid no later than ', t30) else concat('$July rent and water on or before ', m15, ' by 5:00 PM') end", _items,
         "select k, case when k % 3 = 0 then amt end as total_payment_sum, cast(1 as integer) as payment_number, case when k % 3 = 2 then i15 else i30 end as due_date, 'monthly_rent' as payment_type, case when k % 3 = 0 then amt end as amount, 'July' as month_rent, case when k % 3 = 2 then '5:00 PM' end as time, case when k % 3 = 2 then 'July rent and water' end as extra_text from b")

# obligations
_on_text("vacate_date", "case k % 5 when 0 then concat('Defendant agrees to vacate the premises, keys included, on or before ', t30, '.') when 1 then concat('Defendant shall **voluntarily vacate** by ', m15) when 2 then concat('x\\n* D shall vacate by ', m45) when 3 then concat('Upon breach Defendant shall vacate the premises by ', m15) else concat('Defendant acknowledges receipt of a notice to vacate the premises by ', m15) end",
         _col("mandatory_vacate_date", lambda: obligations.vacate_date(t(), today())), "select k, case k % 5 when 0 then i30 when 1 then i15 when 2 then i45 end as mandatory_vacate_date from b")
_on_text("breach_only", "case k % 3 when 0 then 'no such words' when 1 then concat('In default, Defendant shall vacate the premises by ', m15) else concat('Defendant shall vacate the premises. ', repeat('word ', 50), 'On breach he must vacate.') end",
         _col("breach_only", lambda: obligations.only_breach_vacates(t())), "select k, k % 3 = 1 as breach_only from b")
_outcome = lambda df: df.select("k", obligations.outcome(t(), obligations.vacate_date(t(), today())).alias("o")).select("k", F.col("o.kind").alias("outcome_type"), F.col("o.details").alias("outcome_details"))
_on_text("outcome", "case k % 6 when 0 then concat('pay $', amt, ' in installments, dismissed if all terms are met') when 1 then concat('Defendant shall vacate the premises by ', m15) when 2 then concat('pay $', amt, '. Defendant shall vacate the premises by ', m15, '. Immediate judgment otherwise') when 3 then 'Agreed Judgment Entry' when 4 then 'an agreed entry' else 'nothing' end", _outcome,
         "select k, case k % 6 when 0 then 'Pay and Stay' when 1 then 'Vacate Only' when 2 then 'Pay and Vacate' when 3 then 'Agreed Judgment' when 4 then 'Agreed Entry' else 'Unknown' end as outcome_type, case k % 6 when 0 then 'Payment Plan - Dismiss if Paid' when 1 then 'By ' || i15 when 2 then 'Vacate by ' || i15 || ' - Immediate Judgment on Breach' when 5 then 'Unable to Determine Terms' else 'Terms Require Review' end as outcome_details from b")
_on_text("third_party", "case when k % 2 = 0 then 'Plaintiff will accept third-party payments' else 'a third person' end", _col("third_party_acceptance", lambda: F.when(obligations.has(t(), obligations.THIRD_PARTY, "i"), True)), "select k, case when k % 2 = 0 then true end as third_party_acceptance from b")
_terms = lambda c: (lambda df: obligations.obligations(df, "text", today()).select("k", c))
_on_text("assistance_deadline", "case when k % 2 = 0 then concat('Assistance must be secured by ', t30) else concat('before ', m15, ' he seeks assistance') end", _terms("assistance_deadline"), "select k, case when k % 2 = 0 then i30 else i15 end as assistance_deadline from b")
_on_text("additional_terms", "concat(case when k % 2 = 0 then 'return the keys, ' else '' end, case when k % 3 = 0 then 'leave it broom clean, ' else '' end, case when k % 5 = 0 then 'no contact' else '' end)", _terms("additional_agreement_terms"),
         "select k, nullif(concat_ws('; ', case when k % 5 = 0 then 'No contact' end, case when k % 2 = 0 then 'Return keys' end, case when k % 3 = 0 then 'Broom swept clean' end), '') as additional_agreement_terms from b")
_on_text("sealing", "case when k % 2 = 0 then concat('the case is sealed from online access after ', k) else 'open' end", _terms("sealing_reference_stipulation"), "select k, case when k % 2 = 0 then 'sealed from online access' end as sealing_reference_stipulation from b")
_on_text("enforcement", "concat('This entry is enforceable for up to ', 1 + k % 90, ' days')", _terms("enforcement_period"), "select k, (1 + k % 90) || ' days' as enforcement_period from b")

# merge, with the model's answer as JSON
_MODEL = "concat('{\"case_number\": \"M', k, '\", \"outcome_type\": \"pay and vacate\", \"payment_schedule\": [{\"payment_type\": \"fixed_amount\", \"amount\": ', amt, ', \"due_date\": \"2020-01-01\"}, {\"due_date\": \"x\"}], \"additional_agreement_terms\": [\"a\", \"b\"], \"mandatory_vacate_date\": \"2020-02-02\"}')"


def merge_llm(spark: SparkSession, sf: str) -> DataFrame:
    text = "case when k % 3 = 2 then concat('Defendant shall vacate the premises. ', repeat('. ', 120), 'pay $5') else 'pay $5. On default Defendant must vacate the premises.' end"
    rows = base(spark, sf).selectExpr("k", f"{text} as text", f"case when k % 3 = 0 then '{{}}' else {_MODEL} end as model", "cast(null as string) as filename", "concat('R', k) as case_number", "cast(null as string) as agreement_signed_date",
                                      "'P' as plaintiff", "cast(null as string) as defendant", "cast(null as string) as total_payment_sum", f"cast(array() as {payments.SCHEDULE}) as payment_schedule")
    out = merge.merge(obligations.obligations(rows, "text", today()), "model", "text", today())
    return out.select("k", "case_number", "plaintiff", "outcome_type", "mandatory_vacate_date", F.size("payment_schedule").cast("long").alias("n_payments"), F.get("payment_schedule", F.lit(0))["amount"].alias("amount"), "additional_agreement_terms", "extraction_method")


_add("merge_llm", merge_llm, """select k, case when k % 3 = 0 then 'R' else 'M' end || k as case_number, 'P' as plaintiff, case when k % 3 = 2 then 'Pay and Vacate' else 'Pay and Stay' end as outcome_type,
    case when k % 3 = 2 then '2020-02-02' end as mandatory_vacate_date, cast(case when k % 3 = 0 then 0 else 1 end as bigint) as n_payments, case when k % 3 > 0 then cast(cast(cents as double) / 100 as varchar) end as amount,
    case when k % 3 = 0 then 'Vacate premises' else 'a; b' end as additional_agreement_terms, case when k % 3 = 0 then 'Regex-only' else 'LLM+Regex' end as extraction_method from b""")

# corrections
_ONE = "named_struct('payment_number', 1, 'due_date', {due}, 'payment_type', {kind}, 'amount', {amt}, 'month_rent', {month}, 'time', cast(null as string), 'extra_text', {extra}, 'raw_text', cast(null as string))"
_NULL = "cast(null as string)"


def _schedule(*items: dict) -> str:
    one = [_ONE.format(**({"due": _NULL, "kind": "'fixed_amount'", "amt": _NULL, "month": _NULL, "extra": _NULL} | x)) for x in items]
    return f"cast(array({', '.join(one)}) as {payments.SCHEDULE}) as payment_schedule"


def _fix(name: str, cols: list[str], step: Callable[[DataFrame], DataFrame], oracle: str) -> None:
    _add(name, lambda s, sf: step(base(s, sf).selectExpr("k", *cols)), oracle)


_first = lambda df: df.select("k", "total_payment_sum", F.get("payment_schedule", F.lit(0)).alias("p")).select("k", "total_payment_sum", "p.payment_type", "p.amount", "p.month_rent", "p.extra_text")
_fix("fix_total", [_schedule({"amt": "amt"}, {"amt": "amt2"}, {"kind": "'monthly_rent'", "amt": "'999'"}), "'old' as total_payment_sum"], lambda df: fixups.fix_total(df).select("k", "total_payment_sum"), "select k, total as total_payment_sum from b")
_fix("fix_case", ["concat('5812 CVG ', no, case when k % 2 = 0 then ' 15812' else '' end) as case_number"], lambda df: fixups.fix_case(df), "select k, 'S812 CVG ' || no || (case when k % 2 = 0 then ' 15812' else '' end) as case_number from b")
_fix("fix_plaintiff", ["case k % 5 when 0 then 'VINEBROOX HOMES' when 1 then concat('The Delamere ', k) when 2 then 'Waltham Assets' when 3 then 'S8''12' else concat(cust, ' q') end as plaintiff"], lambda df: fixups.fix_plaintiff(df),
     "select k, case when k % 5 = 0 then 'Vinebrook' when k % 5 = 2 then 'Waltham Assets' when k % 5 = 3 or contains(case when k % 5 = 1 then cast(k as varchar) else cust end, '581') then 'S81' when k % 5 = 1 then 'Elam' else cust || ' q' end as plaintiff from b")
_fix("fix_rent", [_schedule({"amt": "case k % 3 when 0 then 'march' when 1 then '750' else amt end", "month": "case when k % 3 = 1 then 'May' end", "extra": "case when k % 3 = 2 then 'some Rent' end"}), "cast(null as string) as total_payment_sum"], lambda df: _first(fixups.fix_rent(df)),
     "select k, cast(null as varchar) as total_payment_sum, 'monthly_rent' as payment_type, case when k % 3 = 2 then amt end as amount, case k % 3 when 0 then 'March' when 1 then 'May' end as month_rent, case when k % 3 = 2 then 'some Rent' end as extra_text from b")
_fix("fix_dates", [_schedule({"amt": "amt", "due": "date_format(date_add(d, case k % 4 when 0 then -8 when 1 then -7 when 2 then 548 else 549 end), 'yyyy-MM-dd')", "extra": "case when k % 2 = 0 then 'water' end"}), "cast(null as string) as total_payment_sum", "date_format(d, 'yyyy-MM-dd') as agreement_signed_date"], lambda df: _first(fixups.fix_dates(fixups.fix_dates(df))),
     "select k, cast(null as varchar) as total_payment_sum, 'fixed_amount' as payment_type, amt as amount, cast(null as varchar) as month_rent, case k % 4 when 0 then 'water; DATE_BEFORE_AGREEMENT' when 2 then 'water' when 3 then 'DATE_TOO_FAR_FUTURE' end as extra_text from b")
_fix("flag_plaintiff", ["case k % 3 when 0 then upper(date_format(d, 'yyyy MMM dd')) || ' PM 3:42' when 1 then concat(no, ' x') else cust || ' and Sons of all' end as plaintiff"], lambda df: df.select("k", fixups.plaintiff_flag(F.col("plaintiff")).alias("flag")),
     "select k, case k % 3 when 0 then 'OCR artifact detected: ''' || upper(strftime(d, '%Y %b %d')) || ' PM 3:42''' when 1 then 'Mostly numeric plaintiff: ''' || no || ' x''' end as flag from b")
_fix("needs_reclass", ["case k % 4 when 0 then 'Settlement' when 1 then 'Pay and Stay' when 2 then 'Unknown' end as outcome_type"], lambda df: df.select("k", reclassify.needs_reclassification(F.col("outcome_type")).alias("needs")), "select k, k % 4 <> 1 as needs from b")
_fix("reclassify", ["case when k % 2 = 0 then 'Unknown' else 'Vacate Only' end as outcome_type", "'d' as outcome_details", "'Regex-only' as extraction_method", "concat('```json\\n{\"outcome_type\": \"', case when k % 3 = 0 then 'Pay or Vacate' else 'Maybe' end, '\", \"reasoning\": \"r', k, '\"}\\n```') as answer"],
     lambda df: reclassify.apply_answers(df, "answer").drop("answer"),
     "select k, case when k % 6 = 0 then 'Pay or Vacate' when k % 2 = 0 then 'Unknown' else 'Vacate Only' end as outcome_type, case when k % 6 = 0 then 'r' || k else 'd' end as outcome_details, 'Regex-only' || (case when k % 6 = 0 then '+Reclassified' else '' end) as extraction_method from b")

# the whole plan
FLAT = ("filename", "case_number", "agreement_signed_date", "plaintiff", "defendant", "outcome_type", "payment_count", "total_payment_sum", "has_more_than_10_payments",
        "payment_1_date", "payment_1_amount", "payment_1_type", "payment_2_date", "payment_2_amount", "payment_20_extra", "mandatory_vacate_date", "extraction_method", "confidence_score", "confidence_label")


def flat_row(spark: SparkSession, sf: str) -> DataFrame:
    return flatten.flatten(extract_documents(documents(spark, sf), as_of=today())).select(*FLAT)


_KNOWN = """truth as (
    select k, d, cust, amt, amt2, total, i0, i15, i30, i45, year(d) || '_CVG_' || no || '_q7_' || year(d) || '_CVG_' || no || '_-_' || strftime(d, '%-m_%-d_%Y') || '_-_DAGREED_-_CV_Docket_cleaned.txt' as filename,
        year(d) || ' CVG ' || no as case_number, nat || ' Properties LLC' as plaintiff from b)
"""
ORACLE_FLAT = f"""{BASE_SQL}, {_KNOWN}
select filename, case_number, i0 as agreement_signed_date, plaintiff, cust as defendant, case k % 4 when 1 then 'Vacate Only' when 2 then 'Pay and Vacate' else 'Pay and Stay' end as outcome_type,
    cast(case k % 4 when 1 then 0 when 2 then 1 else 2 end as integer) as payment_count, case k % 4 when 1 then null when 2 then amt else total end as total_payment_sum, false as has_more_than_10_payments,
    case when k % 4 <> 1 then i15 end as payment_1_date, case when k % 4 <> 1 then amt end as payment_1_amount, case when k % 4 <> 1 then 'fixed_amount' end as payment_1_type,
    case when k % 4 in (0, 3) then i45 end as payment_2_date, case when k % 4 in (0, 3) then amt2 end as payment_2_amount, cast(null as varchar) as payment_20_extra,
    case when k % 4 in (1, 2) then i30 end as mandatory_vacate_date, 'Regex-only' as extraction_method, cast(0.83 as double) as confidence_score, 'MEDIUM' as confidence_label from truth"""
QUERIES["flat_row"] = flat_row
ORACLE_SQL["flat_row"] = ORACLE_FLAT


def confidence_signals(spark: SparkSession, sf: str) -> DataFrame:
    rows = base(spark, sf).selectExpr(
        "k", "case when k % 2 = 0 then 'LLM+Regex' else 'Regex-only' end as extraction_method", "case when k % 3 = 0 then array('OCR artifact detected') else cast(array() as array<string>) end as errors",
        "case when k % 5 > 0 then concat(year(d), ' CVG ', no) end as case_number", "concat(nat, ' LLC') as plaintiff", "case when k % 7 > 0 then cust end as defendant", "'Pay and Stay' as outcome_type", "cast(null as string) as mandatory_vacate_date",
        f"{FILENAME} as filename", "date_format(d, 'yyyy-MM-dd') as agreement_signed_date", _schedule({"amt": "amt", "due": "'2020-01-01'"}, {"amt": "amt"}), "repeat('word ', 60) as cleaned_text", "'' as text", "cast(array() as array<string>) as ocr_changes")
    return confidence.confidence(rows).select("k", "confidence_score", "confidence_label", "confidence_details")


# weights in hundredths times scores in hundredths are whole, so the total is exact; a total half-way between
# hundredths is told apart by the order in which the doubles are added
_add("confidence", confidence_signals, """, s as (
    select k, case when k % 2 = 0 then 100 else 40 end as s1, 100 - (case when k % 5 = 0 then 20 else 0 end) - (case when k % 7 = 0 then 20 else 0 end) as s2, case when k % 3 = 0 then 80 else 100 end as s5, case when k % 7 = 0 then 60 else 90 end as s6 from b),
r as (select *, round(0.25 * (s1 / 100.0)::double + 0.15::double * (s2 / 100.0)::double + 0.05::double * 1.0::double + 0.2::double * 0.75::double + 0.15::double * (s5 / 100.0)::double + 0.2::double * (s6 / 100.0)::double, 2) as score from s)
select k, score as confidence_score, case when score >= 0.85 then 'HIGH' when score >= 0.6 then 'MEDIUM' else 'LOW' end as confidence_label,
    'method_agreement=' || (case when s1 = 100 then '1.00 (LLM and Regex both ran and agreed)' else '0.40 (Regex-only (no LLM cross-validation))' end)
    || '; field_completeness=' || printf('%.2f', s2 / 100.0) || ' (' || (case when s2 = 100 then 'All expected fields populated' else 'Missing: ' || concat_ws(', ', case when k % 5 = 0 then 'case_number' end, case when k % 7 = 0 then 'defendant' end) end) || ')'
    || '; filename_consistency=1.00 (Filename matches); payment_validity=0.75 (1 payment(s) missing date or amount)'
    || '; ocr_quality=' || (case when s5 = 80 then '0.80 (OCR artifact warning flagged)' else '1.00 (Clean OCR text)' end)
    || '; name_plausibility=' || (case when s6 = 60 then '0.60 (defendant is empty)' else '0.90 (defendant is single word (possibly incomplete))' end) as confidence_details from r""")


def resume_antijoin(spark: SparkSession, sf: str) -> DataFrame:
    files = base(spark, sf).selectExpr("k", "concat('doc_', k, '.txt') as source_file")
    return skip_done(files, files.where("k % 3 = 0").select("source_file"))


_add("resume_antijoin", resume_antijoin, "select k, 'doc_' || k || '.txt' as source_file from b where k % 3 <> 0")


def field_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    rows = base(spark, sf).selectExpr("concat('f', k) as filename", "concat(upper(nat), ' ') as plaintiff", "case when k % 4 = 0 then 'x' else cust end as defendant", "amt as total_payment_sum")
    truth = base(spark, sf).selectExpr("concat('f', k) as filename", "stack(3, 'plaintiff', lower(nat), 'defendant', cust, 'total_payment_sum', concat(amt, '0')) as (field, expected)")
    return evaluate(rows, truth).select("field", "n", "n_correct")


_add("field_accuracy", field_accuracy, "select 'plaintiff' as field, count(*) as n, count(*) as n_correct from b union all select 'defendant', count(*), count(*) filter (k % 4 <> 0) from b union all select 'total_payment_sum', count(*), count(*) from b")


def accuracy_floors(spark: SparkSession, sf: str) -> DataFrame:
    """Fields and total against floors; a schedule of k % 3 payments has to have as many."""
    rows = base(spark, sf).selectExpr("concat('f', k) as filename", "case when k % 10 = 0 then 'x' else cust end as defendant", "transform(sequence(1, cast(k % 3 + 1 as int)), x -> named_struct('n', x)) as payment_schedule")
    truth = base(spark, sf).selectExpr("concat('f', k) as filename", "stack(2, 'defendant', upper(cust), 'payment_count', cast(k % 3 + if(k % 4 = 0, 2, 1) as string)) as (field, expected)")
    return gate(rows, truth, {"defendant": 0.8, "payment_count": 0.85, "overall": 0.85}).drop("accuracy")


_add("accuracy_floors", accuracy_floors, """, s as (
    select 'defendant' as field, count(*) as n, count(*) filter (k % 10 <> 0) as n_correct, 0.8::double as floor from b
    union all select 'payment_count', count(*), count(*) filter (k % 4 <> 0), 0.85::double from b
    union all select 'overall', 2 * count(*), count(*) filter (k % 10 <> 0) + count(*) filter (k % 4 <> 0), 0.85::double from b)
    select field, n, n_correct, floor, n_correct >= floor * n as met from s""")


class Echo:
    """Stands in for a model: what it is shown, turned round."""

    def answer(self, text: str) -> str:
        if text.endswith("0"):
            raise ValueError("no answer")
        return text[::-1]


def answers_once(spark: SparkSession, sf: str) -> DataFrame:
    """Answers to texts most of which are equal; those that end in 0 fail and say why."""
    rows = materialize(base(spark, sf).selectExpr("k", "concat(nat, ' ', k % 40) as shown"))
    out = answered(rows, "shown", Echo, lambda b, text: b.answer(text), "echo", slots=8, each=1000)
    return uses(out, rows)


_add("answers_once", answers_once, "select k, case when k % 10 <> 0 then reverse(nat || ' ' || (k % 40)) end as answer, case when k % 10 = 0 then 'ValueError: no answer' end as error from b")
