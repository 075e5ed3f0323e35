"""Chat formatting with Spark expressions only.

Turns of a conversation are collected as structs and sorted, adjacent turns of one role are merged
into one block with array functions, and the blocks are concatenated:

* ``[INST]role\\ntext[NEXT]text[/INST]`` for every role that is not trained on,
* ``<s>role\\ntext[NEXT]text</s>`` for the role that is (``assistant``).

``[NEXT]`` keeps the turns of a merged block apart, so the output can be read back turn by turn.
Inside roles and texts a backslash becomes ``\\0``, ``[`` becomes ``\\1``, ``<`` becomes ``\\2`` and, in roles
only, a line feed becomes ``\\3``: no text can hold a control string, and every text comes back as it was.

Defined results: null text and null role read as empty; turns sort by number (nulls first), ties by
role, then text; rows with a null conversation id form one conversation; other columns are ignored;
an empty table gives an empty result.  A conversation is one row of the result, so it has to fit in
one string; nothing else is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "[INST]", "[/INST]"
OPEN_LOSS, CLOSE_LOSS = "<s>", "</s>"
NEXT = "[NEXT]"
#: What stands for each escaped character.  The backslash is first when escaping, last when reading.
CODES = (("\\", "\\0"), ("[", "\\1"), ("<", "\\2"))


def escape(text: Column, role: bool = False) -> Column:
    for plain, code in CODES + ((("\n", "\\3"),) if role else ()):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, role: bool = False) -> Column:
    for plain, code in reversed(CODES + ((("\n", "\\3"),) if role else ())):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """A row for each conversation: its id, ``formatted`` and ``loss_spans``, the half-open ranges of
    code points of ``formatted`` under the loss mask, one for each turn of ``loss_role``."""
    blank = F.lit("")
    rows = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col), blank).alias("role"),
            F.coalesce(F.col(text_col), blank).alias("text"),
        ).alias("t"),
    )
    conv = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    # where a run of one role begins; one past the last turn closes the last run
    first = F.filter(F.sequence(F.lit(0), F.size("ts") - 1), lambda i: (i == 0) | (F.get("ts", i)["role"] != F.get("ts", i - 1)["role"]))
    conv = conv.withColumn("at", F.concat(first, F.array(F.size("ts"))))

    def block(i: Column) -> Column:
        start, stop = F.get("at", i), F.get("at", i + 1)
        role = F.get("ts", start)["role"]
        return F.struct(
            role.alias("role"),
            F.transform(F.slice("ts", start + 1, stop - start), lambda x: escape(x["text"])).alias("texts"),
        )

    conv = conv.select("conv_id", F.transform(F.sequence(F.lit(0), F.size("at") - 2), block).alias("blocks"))
    is_loss = lambda b: b["role"] == F.lit(loss_role)
    head = lambda b: F.concat(F.when(is_loss(b), F.lit(OPEN_LOSS)).otherwise(F.lit(OPEN)), escape(b["role"], True), F.lit("\n"))
    tail = lambda b: F.when(is_loss(b), F.lit(CLOSE_LOSS)).otherwise(F.lit(CLOSE))
    pieces = F.transform("blocks", lambda b: F.concat(head(b), F.array_join(b["texts"], NEXT), tail(b)))
    # a run over (length, trained on) gives each trained turn its place
    parts = F.flatten(F.transform("blocks", lambda b: F.concat(
        F.array(F.struct(F.length(head(b)).alias("n"), F.lit(False).alias("loss"))),
        F.flatten(F.transform(b["texts"], lambda t, k: F.array(
            F.struct(F.when(k > 0, len(NEXT)).otherwise(0).alias("n"), F.lit(False).alias("loss")),
            F.struct(F.length(t).alias("n"), is_loss(b).alias("loss")),
        ))),
        F.array(F.struct(F.length(tail(b)).alias("n"), F.lit(False).alias("loss"))),
    )))
    conv = conv.select("conv_id", F.array_join(pieces, "").alias("formatted"), parts.alias("parts"))
    # a fold copies what it has at each step, so parts are run over in stretches of about the root of their number
    conv = conv.withColumn("stretch", F.ceil(F.sqrt(F.size("parts"))).cast("int"))
    stretches = F.transform(F.sequence(F.lit(0), (F.ceil(F.size("parts") / F.col("stretch")) - 1).cast("int")), lambda k: F.slice("parts", k * F.col("stretch") + 1, F.col("stretch")))
    span = lambda s, p: F.struct(s["at"].alias("start"), (s["at"] + p["n"]).alias("end"))
    none = F.expr("cast(array() as array<struct<start:int,end:int>>)")
    within = lambda ps: F.aggregate(
        ps,
        F.struct(F.lit(0).alias("at"), none.alias("spans")),
        lambda s, p: F.struct((s["at"] + p["n"]).alias("at"), F.when(p["loss"], F.concat(s["spans"], F.array(span(s, p)))).otherwise(s["spans"]).alias("spans")),
    )
    conv = conv.withColumn("told", F.transform(stretches, within))
    begins = F.aggregate(
        "told",
        F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("begins")),
        lambda s, x: F.struct((s["at"] + x["at"]).alias("at"), F.concat(s["begins"], F.array(s["at"])).alias("begins")),
        lambda s: s["begins"],
    )
    moved = F.zip_with("told", begins, lambda x, b: F.transform(x["spans"], lambda s: F.struct((s["start"] + b).alias("start"), (s["end"] + b).alias("end"))))
    return conv.select("conv_id", "formatted", F.flatten(moved).alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """The turns in a formatted conversation: ``array<struct<role, text>>``."""
    blocks = F.split(formatted, r"</s>|\[/INST\]")
    blocks = F.slice(blocks, 1, F.size(blocks) - 1)

    def turns(b: Column) -> Column:
        cut = F.instr(b, "\n")
        mark = F.when(F.startswith(b, F.lit(OPEN_LOSS)), len(OPEN_LOSS)).otherwise(len(OPEN))
        role = unescape(F.substring(b, mark + 1, cut - mark - 1), True)
        texts = F.split(F.substring(b, cut + 1, F.length(b)), r"\[NEXT\]")
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), "")
