"""Chat formatting by sorted turn structs, merged roles and concatenation, in Spark expressions only.

A conversation becomes blocks of one role. Control strings start with ``<|``:

    <|start|>role<|says|>text<|turn|>text of the same role<|end|>

Inside roles and texts a backslash is doubled and ``<|`` becomes ``<\\|``. No
control string can then occur there, and since doubled backslashes come in even
runs, the single one between ``<`` and ``|`` is unambiguous.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, SAYS, TURN, END = "<|start|>", "<|says|>", "<|turn|>", "<|end|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def format_conversations(turns: DataFrame, learn_role: str = "assistant") -> DataFrame:
    """``conv_id, formatted, loss_spans`` from rows (conv_id, turn, role, text).

    ``loss_spans``, array<struct<start, end>>, are the code points of
    ``formatted`` that hold texts of ``learn_role``. Turns sort by turn, null
    last; equal turns by role and text, so ties and repeated rows have a fixed
    order and all stay. Null roles and texts are empty; rows without a conv_id
    are one conversation. Adjacent turns of a role share a block. The output is
    one text a conversation, so a conversation's turns meet in one row; nothing
    else is gathered. Other columns are left out.
    """
    own = turns.select(
        "conv_id", "turn",
        escape(F.coalesce(F.col("role").cast("string"), F.lit(""))).alias("role"),
        escape(F.coalesce("text", F.lit(""))).alias("text"),
        F.coalesce(F.col("role") == learn_role, F.lit(False)).alias("learn"),
    )
    in_order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    opens = F.coalesce(F.lag("role").over(in_order) != F.col("role"), F.lit(True))
    placed = own.withColumns({"place": F.row_number().over(in_order), "opens": opens})
    head = F.when(~F.col("opens"), F.lit(TURN)).otherwise(F.concat(F.when(F.col("place") > 1, F.lit(END)).otherwise(F.lit("")), F.lit(START), "role", F.lit(SAYS)))
    sized = placed.withColumn("ends", F.sum((F.char_length(head) + F.char_length("text")).cast("long")).over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    turn = F.struct("place", "role", "text", "opens", "learn", (F.col("ends") - F.char_length("text")).alias("start"), F.col("ends").alias("end"))
    gathered = sized.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    all_turns = F.col("turns")
    firsts = F.transform(F.filter(all_turns, lambda t: t["opens"]), lambda t: t["place"])
    blocks = F.transform(
        firsts, lambda p, i: F.slice(all_turns, p, F.coalesce(F.get(firsts, i + 1), F.size(all_turns) + 1) - p)
    )
    texts = lambda block: F.array_join(F.transform(block, lambda t: t["text"]), TURN)
    made = F.transform(blocks, lambda b: F.concat(F.lit(START), F.get(b, F.lit(0))["role"], F.lit(SAYS), texts(b), F.lit(END)))
    spans = F.transform(F.filter(all_turns, lambda t: t["learn"]), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end")))
    return gathered.select("conv_id", F.array_join(made, "").alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text, array<struct<role, text>>, unescaped."""
    blocks = F.filter(F.split(formatted, r"<\|end\|>", -1), lambda b: b != "")
    parts = lambda b: F.split(F.substring(b, len(START) + 1, F.char_length(b)), r"<\|says\|>", -1)
    return F.flatten(
        F.transform(blocks, lambda b: F.transform(
            F.split(F.get(parts(b), F.lit(1)), r"<\|turn\|>", -1),
            lambda t: F.struct(unescape(F.get(parts(b), F.lit(0))).alias("role"), unescape(t).alias("text")),
        ))
    )


def under_mask(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the mask, in order: array<string>."""
    return F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
