"""What an agreement obliges to: vacate dates, breach clauses, outcome, terms, deadlines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.functions.dates import NUMERIC, SHORT, normalize_date
from tamarack.functions.regex import contains_any, fence, first, has, holds, let, matches, mentions, pages, place, strip, sub, sub_if, window, with_starts

#: Phrases before a mention of vacating that make it a notice or a consequence of breach.
NOTICE = ("acknowledges receipt", "receipt of", "notice to vacate served", "notice to leave served")
BREACH = ("breach", "default", "fail to comply", "failure to comply", "if any of the terms", "if the terms", "not object to", "granted judgment", "set-out", "set out")

#: The wordings of obligations, mentions, conditions, plans, deadlines, sealing and enforcement.
_MUST = r"(?:shall|must|agrees?\s+to)"
_LIMIT = r"(?:on\s+or\s+before|by|before|on)\s+"
_DAY = rf"([A-Za-z]+\s+\d{{1,2}},?\s+\d{{4}}|{NUMERIC})"
VACATE = (
    rf"(?:shall|must|agrees?\s+to|required\s+to)\s+(?:\w+\s+)?vacate\s+(?:the\s+)?(?:premises?|property|rental\s+unit)[^.]*?{_LIMIT}{_DAY}",
    rf"Defendant(?:\(s\))?\s+{_MUST}\s+(?:\w+\s+)?vacate[^.]*?{_LIMIT}{_DAY}",
    rf"vacate\s+(?:the\s+)?premises?[^.]*?{_LIMIT}{_DAY}",
    rf"(?:^|\n)\s*\*?\s*(?:D|Def\.?|Dft\.?|Defendant(?:\(s\))?)\s+shall\s+vacate\s+(?:by|on\s+or\s+before|before)\s+{_DAY}",
    rf"vacate\s+(?:the\s+)?premises?\s+and\s+[^.]*?(?:on\s+or\s+before|by|before)\s+{_DAY}",
)
#: What each match of those holds: they run over no full stop from the word to the day.
DATED = r"vacate[^.]*\d"
MENTION = rf"{_MUST}\s+(?:\w+\s+)?vacate|vacate\s+(?:the\s+)?(?:premises?|property|immediately)"
DISMISS = r"dismiss.*?(?:if|upon).*?(?:compliance|terms?|satisfied|met)"
JUDGMENT = r"immediate.*?judgment|move.*?directly.*?judgment|breach.*?judgment"
PLAN = r"payment.*?(?:schedule|plan)|pay.*?follows|installments|following\s+manner"
#: Labels of additional terms, in order, and what shows each; last the piece that every match holds.
TERMS = (
    ("Dismiss if terms met", DISMISS, "dismiss"), ("Immediate judgment on breach", JUDGMENT, "judgment"), ("Comply with lease", r"comply\s+with\s+(?:all\s+)?lease", "comply"),
    ("Pay utilities", r"pay[^.]*?utilities", "utilities"), ("No contact", r"no\s+(?:intentional\s+)?contact", "contact"), ("Return keys", r"return[^.]*?keys", "return"),
    ("Broom swept clean", r"broom\s+(?:swept\s+)?clean", "broom"), ("Remove personal property", r"remove[^.]*?(?:property|possessions)", "remove"),
    ("Vacate premises", r"vacate\s+(?:the\s+)?premises?", "vacate"), ("Pest control compliance", r"compliance\s+with[^.]*?pest\s+control", "pest"),
)
_DEADLINE = r"([A-Za-z]+\s+\d{1,2},?\s+\d{4}|\d{1,2}/\d{1,2}/\d{4})"
ASSISTANCE = (
    rf"(?:assistance|help|support)\s+(?:must be|shall be)\s+(?:received|obtained|secured)\s+by\s+{_DEADLINE}",
    rf"(?:by|before)\s+{_DEADLINE}[^.]*?assistance",
)
THIRD_PARTY = r"third[\s-]?party\s+(?:assistance|payment)|accept\s+third[\s-]?party|third party assistance will be accepted|3rd party agency providing monetary assistance"
SEALING = (r"sealed?\s+(?:from\s+)?online\s+(?:access|records?)", r"not object to.*?sealed?", r"case sealed", r"sealing.*?(?:records?|case)")
ENFORCEMENT = (
    r"(?:enforceable|in effect|valid)\s+(?:for\s+)?up to\s+(\d+\s+days)",
    r"(?:agreement|entry)\s+shall\s+remain\s+enforceable\s+for[^.]*?(\d+\s+days)",
    r"time for execution.*?extended.*?to\s+(\d+\s+days)",
)
#: Signs of a payment, in the text as it is, and in lower case, each with pieces one of which it holds.
PAYS = (r"\$\s*\d", ""), (rf"\$\s*(?:{SHORT})\w*\s+rent", "i"), (r"\$\s*#\d+", "")
PAYS_LOWER = (
    (r"agree\s+to\s+pay.*?(?:following|schedule|manner)", ("agree",)), (r"shall\s+make\s+the\s+following\s+payments", ("following",)),
    (r"due\s+to\s+plaintiff\s+by", ("due",)), (r"(?:agrees?\s+to\s+pay|shall\s+pay)\s+(?:plaintiff\s+)?\$|will\s+pay\s+\$", ("$",)),
    (r"\w+\s+rent\s+(?:will|shall)\s+be\s+paid", ("rent",)),
)


def vacate_date(text: Column, as_of: Column | None = None) -> Column:
    """The date of an unconditional obligation to vacate.  Only the first hit of each pattern is tested."""
    text = F.when(mentions(text, "vacate"), text)

    def hit(t: Column, p: str) -> Column:
        before = lambda at: F.lower(F.substring(t, F.greatest(at - 150, F.lit(1)), F.least(at - 1, F.lit(150))))
        bound = lambda b: ~contains_any(b, NOTICE + BREACH)
        return let(place(t, p, "im"), lambda at: F.when((at > 0) & let(before(at), bound), strip(first(t, p, 1, "im"))))

    plain = sub(sub_if(holds(text, "**"), text, r"\*\*"), r"(\d{1,2})(?:st|nd|rd|th)", "$1")
    return normalize_date(let(plain, lambda t: F.when(has(t, DATED, "i"), F.coalesce(*[hit(t, p) for p in VACATE]))), as_of)


def only_breach_vacates(text: Column) -> Column:
    """Whether vacating is mentioned, and only in notices or consequences of breach."""
    bound = lambda before: contains_any(before, NOTICE + BREACH)

    def judged(low: Column) -> Column:
        def judge(found: Column) -> Column:
            return let(F.when(F.size(found) > 0, pages(low)), lambda cut: F.forall(found, lambda x: let(window(cut, x["at"] - 200, x["at"]), bound)))

        return let(with_starts(low, MENTION, matches(low, MENTION, 0)), lambda found: (F.size(found) > 0) & judge(found))

    return F.coalesce(let(F.lower(F.when(mentions(text, "vacate"), text)), judged), F.lit(False))


def _pays(text: Column, low: Column) -> Column:
    """Whether a text, also given in lower case, speaks of a payment."""
    # a sum of money is the commonest sign, so it is looked for first
    pays = F.lit(False)
    for p, flags in PAYS:
        pays = pays | has(text, p, flags)
    pays = holds(text, "$") & pays
    for p, pieces in PAYS_LOWER:
        pays = pays | holds(low, *pieces) & has(low, p)
    return pays


def _named(low: Column) -> Column:
    out = F
    for phrase, kind in (("agreed judgment entry", "Agreed Judgment"), ("agreed entry", "Agreed Entry"), ("settlement", "Settlement")):
        out = out.when(F.contains(low, F.lit(phrase)), kind)
    return out


def _kind(pays: Column, named: Column, leaves: Column) -> Column:
    return F.when(pays & leaves, "Pay and Vacate").when(leaves, "Vacate Only").when(pays, "Pay and Stay").otherwise(F.coalesce(named, F.lit("Unknown")))


def _details(low: Column, pays: Column, named: Column, vacates: Column) -> Column:
    def signs(low: Column) -> Column:
        return F.struct((holds(low, "schedule", "plan", "follows", "installments", "manner") & has(low, PLAN)).alias("plan"),
                        (holds(low, "dismiss") & has(low, DISMISS, "s")).alias("dismissal"), (holds(low, "judgment") & has(low, JUDGMENT, "s")).alias("judgment"))

    def told(s: Column) -> Column:
        leaves, breach = vacates.isNotNull(), F.when(s["judgment"], "Immediate Judgment on Breach")
        join = lambda *xs: F.concat_ws(" - ", *xs)
        return (
            F.when(pays & leaves, join(F.when(s["plan"], "Payment Plan"), F.concat(F.lit("Vacate by "), vacates), F.when(s["dismissal"], "Dismiss if Terms Met"), breach))
            .when(leaves, join(F.concat(F.lit("By "), vacates), F.when(s["dismissal"], "Dismiss if Vacated"), breach))
            .when(pays, join(F.when(s["plan"], "Payment Plan").otherwise("Lump Sum Payment"), F.when(s["dismissal"], "Dismiss if Paid"), breach))
            .when(named.isNull(), "Unable to Determine Terms").otherwise("Terms Require Review")
        )

    return let(signs(low), told)


def outcome(text: Column, vacates: Column) -> Column:
    """A struct of ``kind`` and ``details`` from the text and its vacate date."""

    def told(s: Column) -> Column:
        return F.struct(_kind(s["pays"], s["named"], vacates.isNotNull()).alias("kind"), _details(s["low"], s["pays"], s["named"], vacates).alias("details"))

    return let(let(F.lower(text), lambda low: F.struct(low.alias("low"), _pays(text, low).alias("pays"), _named(low).alias("named"))), told)


def obligations(df: DataFrame, text_col: str = "cleaned_text", as_of: Column | None = None) -> DataFrame:
    """``df`` with the vacate date, outcome, terms and deadlines that its text states."""
    text = F.col(text_col)
    out = fence(df.withColumn("mandatory_vacate_date", vacate_date(text, as_of)), "mandatory_vacate_date")
    # kind and details apart, so that details nobody selects cost nothing
    out = out.withColumn("_low", F.lower(text)).withColumns({"_pays": _pays(text, F.col("_low")), "_named": _named(F.col("_low"))})
    vacates = F.col("mandatory_vacate_date")
    out = out.withColumns({
        "outcome_type": _kind(F.col("_pays"), F.col("_named"), vacates.isNotNull()), "outcome_details": _details(F.col("_low"), F.col("_pays"), F.col("_named"), vacates),
        "third_party_acceptance": F.when(mentions(text, "party") & has(text, THIRD_PARTY, "i"), True),
        "assistance_deadline": normalize_date(F.coalesce(*[strip(F.when(mentions(text, "assistance", "help", "support"), first(text, p, 1, "i"))) for p in ASSISTANCE]), as_of),
        "additional_agreement_terms": F.nullif(F.concat_ws("; ", *[F.when(mentions(text, piece) & has(text, p, "is"), label) for label, p, piece in TERMS]), F.lit("")),
        "sealing_reference_stipulation": strip(F.coalesce(*[F.when(mentions(text, "seal"), first(text, p, 0, "i")) for p in SEALING])),
        "enforcement_period": strip(F.coalesce(*[F.when(mentions(text, "days"), first(text, p, 1, "i")) for p in ENFORCEMENT])),
    })
    return fence(out, "outcome_type", "outcome_details").drop("_low", "_pays", "_named")
