"""Queries over the wordings and branches that the queries of ``tamarack.plans.queries`` don't reach."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamarack.operators import case_ids, clean, confidence, fixups, flatten, obligations, parties, payments
from tamarack.plans.corpus import base
from tamarack.plans.queries import _add, _col, _fix, _items, _on_text, _row, _terms, f, t, today

# cleaning: number glyphs, impossible dates in words
_cleaned = lambda df: clean.clean(df).select("k", "cleaned_text", F.array_join("ocr_changes", "|").alias("changes"))
_on_text("clean_decimals", "concat('Rate 1,2O', k % 10, '.5l now, ', amt)", _cleaned,
         "select k, 'Rate 1,20' || k % 10 || '.51 now, ' || amt as cleaned_text, 'Fixed number: 1,2O' || k % 10 || '.5l -> 1,20' || k % 10 || '.51' as changes from b")
_on_text("clean_text_dates", "case k % 3 when 0 then 'on February 30, 2023!' when 1 then concat('on ', t0, '!') else 'by February 29.' end", _cleaned,
         "select k, case k % 3 when 0 then 'on February 30, 2023 [INVALID DATE]!' when 1 then 'on ' || t0 || '!' else 'by February 29 [INVALID DATE].' end as cleaned_text, case k % 3 when 0 then 'Invalid date: February 30, 2023' when 1 then '' else 'Invalid date: February 29' end as changes from b")

# identifiers and dates
_YY = "substring(cast(year(d) as {}), 3, 2)"
_add("case_number_names", lambda s, sf: base(s, sf).selectExpr("k", f"case k % 5 when 0 then concat('x ', year(d), ' CVG ', no, '.pdf') when 1 then concat('a_', year(d), '_CVG_', no, '_cleaned') when 2 then concat('q-', {_YY.format('string')}, '-CVG-', no) when 3 then concat('z', year(d), 'CVG', no) else concat('z', {_YY.format('string')}, 'CVG', no) end as filename")
     .select("k", case_ids.case_number(F.lit("Case No. 1999 CVG 999999"), f()).alias("case_number")),
     f"select k, case when k % 5 in (2, 4) then '20' || {_YY.format('varchar')} else cast(year(d) as varchar) end || ' CVG ' || no as case_number from b")
_add("agreement_date_more", lambda s, sf: base(s, sf).selectExpr("k", "case when k % 4 = 0 then concat('x - ', month(d), ' ', day(d), ' ', year(d), ' - DAGREED') end as filename",
                                                                 "case k % 4 when 1 then concat('Date: <signature> ', t0) when 2 then concat('<watermark>FILED ', upper(date_format(d, 'MMM d yyyy')), '</watermark>') when 3 then concat('clerk ', upper(date_format(d, 'yyyy MMM d')), ' x') else 'Date' end as text")
     .select("k", case_ids.agreement_date(t(), f(), today()).alias("agreement_signed_date")), "select k, i0 as agreement_signed_date from b")

# parties: running text, plaintiffs and defendants in capitals, what is cut off a name
_LETTERS = "translate(nat, '_0123456789', 'Xabcdefghij')"
_on_text("parties_more", f"""case k % 7 when 0 then concat('m12\\n', nat, ' Homes, Plaintiff, and others') when 1 then concat('MUNICIPAL COURT 7 ', {_LETTERS}, ' HOMES PLAINTIFF(S)') when 2 then concat('ACME v. ', {_LETTERS}, ', et al')
         when 3 then concat('x v. ', {_LETTERS}, ' ROE DEFENDANT(S)') when 4 then concat('<table><tr><td><b>', nat, '</b> :</td></tr><tr><td>Plaintiff</td></tr></table>') when 5 then concat(repeat('A', 101), '\\nPlaintiff') else concat('v.\\n(c/o x) ', nat, '.\\n') end""",
         lambda df: parties.parties(df, "text").select("k", "plaintiff", "defendant"),
         f"select k, case k % 7 when 0 then nat || ' Homes' when 1 then {_LETTERS} || ' HOMES' when 4 then nat end as plaintiff, case k % 7 when 2 then {_LETTERS} when 3 then {_LETTERS} || ' ROE' when 6 then nat end as defendant from b")

# payments: blanks of a template
_on_text("payments_blank", "concat('<table><tr><td>$____</td><td>', m15, '</td></tr><tr><td>$', amt, '</td><td>', m45, '</td></tr></table>')", _items, _row(1, "i45", "amt", "amt"))

# obligations
_on_text("vacate_more", "case k % 2 when 0 then concat('He will vacate the premises by ', m15) else concat('Upon breach he will vacate the premises by ', m15, '. ', repeat('x ', 90), 'Then vacate the premises and yard by ', m45) end",
         _col("mandatory_vacate_date", lambda: obligations.vacate_date(t(), today())), "select k, case k % 2 when 0 then i15 else i45 end as mandatory_vacate_date from b")
_on_text("outcome_signs", "case k % 5 when 0 then '$Mar rent is due' when 1 then 'he shall make the following payments' when 2 then 'tenant will pay $ later' when 3 then '$ #12 is due, dismissed if all is paid and terms are met' else 'this settlement is final' end",
         lambda df: df.select("k", obligations.outcome(t(), F.lit(None).cast("string")).alias("o")).select("k", F.col("o.kind").alias("outcome_type"), F.col("o.details").alias("outcome_details")),
         "select k, case when k % 5 = 4 then 'Settlement' else 'Pay and Stay' end as outcome_type, case k % 5 when 4 then 'Terms Require Review' when 3 then 'Lump Sum Payment - Dismiss if Paid' else 'Lump Sum Payment' end as outcome_details from b")
_on_text("third_party_wordings", "case k % 5 when 0 then 'with third party assistance' when 1 then 'will accept 3rd or accept third-party money' when 2 then 'third party assistance will be accepted' when 3 then 'a 3rd party agency providing monetary assistance' else 'a third person may help' end",
         _col("third_party_acceptance", lambda: F.when(obligations.has(t(), obligations.THIRD_PARTY, "i"), True)), "select k, case when k % 5 < 4 then true end as third_party_acceptance from b")
_on_text("terms_more", "case k % 6 when 0 then 'dismissed upon compliance' when 1 then 'immediate judgment' when 2 then 'comply with all lease terms' when 3 then 'pay the water utilities' when 4 then 'remove all possessions' else 'vacate the premises; compliance with regular pest control' end", _terms("additional_agreement_terms"),
         "select k, case k % 6 when 0 then 'Dismiss if terms met' when 1 then 'Immediate judgment on breach' when 2 then 'Comply with lease' when 3 then 'Pay utilities' when 4 then 'Remove personal property' else 'Vacate premises; Pest control compliance' end as additional_agreement_terms from b")
_on_text("sealing_wordings", "case k % 3 when 0 then 'he will not object to it being sealed.' when 1 then 'have the case sealed today' else 'for sealing of the records now' end", _terms("sealing_reference_stipulation"),
         "select k, case k % 3 when 0 then 'not object to it being sealed' when 1 then 'case sealed' else 'sealing of the records' end as sealing_reference_stipulation from b")
_on_text("enforcement_wordings", "case k % 2 when 0 then concat('This agreement shall remain enforceable for a term of ', 1 + k % 90, ' days') else concat('the time for execution is extended to ', 1 + k % 90, '  days') end", _terms("enforcement_period"),
         "select k, (1 + k % 90) || (case k % 2 when 0 then ' ' else '  ' end) || 'days' as enforcement_period from b")

# corrections and flat rows
_fix("fix_outcome", ["case when k % 3 = 0 then 'Vacate or Pay' when k % 3 = 1 then 'Vacate Only' end as outcome_type"], lambda df: fixups.fix_outcome(df),
     "select k, case when k % 3 = 0 then 'Pay or Vacate' when k % 3 = 1 then 'Vacate Only' end as outcome_type from b")
#: Items of a schedule longer than a flat row has room for, made from their number.
_ITEMS = """transform(sequence(1, cast(k % 23 as int)), i -> named_struct('payment_number', i, 'due_date', concat('2024-01-', lpad(i, 2, '0')), 'payment_type', case i % 3 when 0 then 'monthly_rent' when 1 then 'fixed_amount' end,
    'amount', case when i % 4 > 0 then cast(100 + i as string) end, 'month_rent', case when i % 6 = 0 then 'May' end, 'time', cast(null as string), 'extra_text', case when i % 5 = 0 then concat('e', i) end, 'raw_text', cast(null as string)))"""


def _flat(spark, sf):
    texts = ("case_number", "agreement_signed_date", "plaintiff", "defendant", "outcome_type", "outcome_details", "total_payment_sum", "mandatory_vacate_date", "assistance_deadline", "additional_agreement_terms", "extraction_method", "confidence_label", "confidence_details")
    rows = base(spark, sf).selectExpr("concat('f', k) as filename", *(f"concat('{c}', k) as {c}" for c in texts), "k % 2 = 0 as third_party_acceptance", "0.5D as confidence_score", f"case when k % 23 = 0 then array() else {_ITEMS} end as payment_schedule")
    return flatten.flatten(rows)


def _flat_sql() -> str:
    def one(i: int) -> str:
        there = f"k % 23 >= {i}"
        amount = f"'{100 + i}'" if i % 4 else None
        told = {1: amount or "cast(null as varchar)", 2: amount or "cast(null as varchar)"}.get(i % 3)
        if told is None:
            told = "'" + (" ".join(x for x in ("May" if i % 6 == 0 else "", f"${100 + i}" if amount else "") if x) or "Monthly rent") + "'"
        kind = {0: "'monthly_rent'", 1: "'fixed_amount'", 2: "cast(null as varchar)"}[i % 3]
        extra = f"'e{i}'" if i % 5 == 0 else "cast(null as varchar)"
        return f"case when {there} then '2024-01-{i:02}' end as payment_{i}_date, case when {there} then {told} end as payment_{i}_amount, case when {there} then {kind} end as payment_{i}_type, case when {there} then {extra} end as payment_{i}_extra"

    texts = ("case_number", "agreement_signed_date", "plaintiff", "defendant", "outcome_type", "outcome_details", "total_payment_sum", "mandatory_vacate_date", "assistance_deadline", "additional_agreement_terms", "extraction_method", "confidence_label", "confidence_details")
    return ("select 'f' || k as filename, " + ", ".join(f"'{c}' || k as {c}" for c in texts) + ", k % 2 = 0 as third_party_acceptance, cast(0.5 as double) as confidence_score, cast(k % 23 as integer) as payment_count, k % 23 > 10 as has_more_than_10_payments, "
            + ", ".join(map(one, range(1, 21))) + " from b")


_add("flat_columns", _flat, _flat_sql())

# confidence: the branches of each signal, each dealt by its own remainder of the order's number
_ITEM = "named_struct('payment_number', 1, 'due_date', {}, 'payment_type', 'fixed_amount', 'amount', {}, 'month_rent', cast(null as string), 'time', cast(null as string), 'extra_text', {}, 'raw_text', cast(null as string))"
_WELL, _LATE, _BARE = _ITEM.format("'2024-01-05'", "'5'", "cast(null as string)"), _ITEM.format("'2029-01-05'", "'5'", "'DATE_TOO_FAR_FUTURE'"), _ITEM.format("cast(null as string)", "cast(null as string)", "cast(null as string)")


def _signals(spark, sf):
    rows = base(spark, sf).selectExpr(
        "k", "element_at(array('LLM+Regex', 'LLM+Regex', 'Regex-only', 'Regex'), cast(k % 4 as int) + 1) as extraction_method", "case when k % 4 = 0 then array('Overriding it') else cast(array() as array<string>) end as errors",
        "'C 12' as case_number", "element_at(array('vs.', 'Sunrise', 'AB', null, 'Sun Homes', 'Sun Homes LLC'), cast(k % 6 as int) + 1) as plaintiff", "element_at(array('Jane Doe', '', 'XY', 'Doe, J', 'Smith', 'Jane Doe'), cast(k % 6 as int) + 1) as defendant",
        "element_at(array('Vacate Only', 'Pay and Stay', 'Settlement', 'Pay and Vacate', null), cast(k % 5 as int) + 1) as outcome_type", "cast(null as string) as mandatory_vacate_date",
        f"case k % 5 when 3 then array({_WELL}, {_LATE}) when 4 then array({_BARE}) else cast(array() as array<{_KIND}>) end as payment_schedule",
        "element_at(array(null, 'f_99_2023', 'c12_2023'), cast(k % 3 as int) + 1) as filename", "'2024-01-02' as agreement_signed_date",
        "case k % 7 when 0 then 'short' when 1 then repeat('word ', 20) when 5 then repeat('word ', 20) else concat(repeat('word ', 60), repeat('[?]', case k % 7 when 2 then 3 when 3 then 6 else 0 end)) end as cleaned_text", "'' as text",
        "array_repeat('c', case k % 7 when 4 then 11 when 5 then 21 else 0 end) as ocr_changes")
    return confidence.confidence(rows).select("k", "confidence_details")


_KIND = payments.SCHEDULE.removeprefix("array<").removesuffix(">")
_add("confidence_signals", _signals, """, s as (
    select k, list_filter([case when k % 6 = 3 then 'plaintiff' end, case when k % 6 = 1 then 'defendant' end, case when k % 5 = 4 then 'outcome_type' end,
        case k % 5 when 1 then 'payment_schedule (expected for Pay outcome)' when 0 then 'mandatory_vacate_date (expected for Vacate outcome)' end], lambda x: x is not null) as gaps from b)
select k, 'method_agreement=' || (['0.60 (LLM+Regex ran but outcome was overridden (disagreement resolved))', '1.00 (LLM and Regex both ran and agreed)', '0.40 (Regex-only (no LLM cross-validation))', '0.30 (Single extraction method: Regex)'])[1 + k % 4]
    || '; field_completeness=' || printf('%.2f', (5 - len(gaps)) / 5.0) || ' (' || (case when len(gaps) = 0 then 'All expected fields populated' else 'Missing: ' || array_to_string(gaps, ', ') end) || ')'
    || '; filename_consistency=' || (['0.50 (No filename available for validation)', '0.00 (case_number not found in filename; agreement_date not matched in filename)', '0.50 (agreement_date not matched in filename)'])[1 + k % 3]
    || '; payment_validity=' || (['1.00 (Vacate-only with no payments (expected))', '0.20 (Pay-type outcome but no payments extracted)', '0.70 (No payments and no pay-type outcome)', '0.75 (1 payment(s) with date anomaly)', '0.00 (Payments present)'])[1 + k % 5]
    || '; ocr_quality=' || (['0.10 (OCR text is empty or extremely short)', '0.80 (Short OCR text (100 chars))', '0.85 (3 uncertain [?] markers)', '0.70 (6 uncertain [?] markers)', '0.85 (11 OCR corrections applied)', '0.50 (21 OCR corrections applied; Short OCR text (100 chars))', '1.00 (Clean OCR text)'])[1 + k % 7]
    || '; name_plausibility=' || (['0.10 (plaintiff is a form label (''vs.''), not an actual name)', '0.20 (Likely plaintiff/defendant swap: single-word non-entity plaintiff with empty defendant)', '0.70 (plaintiff very short (2 chars); defendant very short (2 chars))',
        '0.60 (plaintiff is empty)', '0.90 (defendant is single word (possibly incomplete))', '1.00 (Names look plausible)'])[1 + k % 6] as confidence_details from s""")
