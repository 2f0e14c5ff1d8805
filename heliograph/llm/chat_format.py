"""Chat formatting by prefix-target expansion. Native DataFrame code.

A turn is written as START role SEP text END. Control strings inside roles and texts are escaped by
a backslash after their first character (and backslashes are doubled), so the marks are unambiguous
and the text comes back exactly. Every assistant turn becomes an example of its own: all preceding
turns are context, and only its text is trainable (loss_start and loss_length, in code points of
`formatted`). A conversation that doesn't end with an assistant turn gets one more row with no
trainable text, so that nothing is lost.

A conversation is one row while it is expanded: its size bounds a task's memory, and that of its
longest prefix each output row. Conversations are shuffled once, by conv_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the template; every control string that texts may not hold unescaped.
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROLS = [START, SEP, END, "<s>", "</s>", "[INST]", "[/INST]"]

PROBE = "</s>[INST] ok [/INST]"


def escape(text: Column) -> Column:
    """Text without any control string in it; `unescape` undoes it."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROLS:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def with_probe(conversations: DataFrame) -> DataFrame:
    """The conversations and conversation -1, whose texts look like control strings."""
    probe = conversations.sparkSession.sql(
        f"SELECT * FROM VALUES (-1L, 0L, 'user', '{PROBE}'), (-1L, 1L, 'assistant', '{PROBE}') AS t(conv_id, turn, role, text)"
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)


def examples(conversations: DataFrame) -> DataFrame:
    """conv_id, example, formatted, loss_start, loss_length, is_last.

    Turns are ordered by turn (null first), then role and text, so ties and repeated rows have one
    order; repeated rows are turns of their own. Null role and text count as empty; a null conv_id is
    one conversation. Roles other than 'assistant' are context only. Empty input, empty result.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.select("conv_id", F.struct("turn", role.alias("role"), text.alias("text")).alias("t"))
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    shape = lambda t: F.concat(F.lit(START), escape(t["role"]), F.lit(SEP), escape(t["text"]), F.lit(END))
    whole = whole.withColumns({"n": F.size("turns"), "pieces": F.transform("turns", shape)})
    index = F.sequence(F.lit(1), F.col("n"))
    wanted = F.filter(index, lambda i: (i == F.col("n")) | (F.element_at("turns", i)["role"] == "assistant"))
    exploded = whole.select("conv_id", "turns", "pieces", "n", F.posexplode(wanted).alias("example", "i"))
    last = F.element_at("turns", F.col("i"))
    formatted = F.array_join(F.slice("pieces", F.lit(1), F.col("i")), "")
    trainable = last["role"] == "assistant"
    length = F.when(trainable, F.char_length(escape(last["text"]))).otherwise(0)
    rows = exploded.select("conv_id", "example", formatted.alias("formatted"), length.cast("long").alias("loss_length"),
                           trainable.alias("trainable"), (F.col("i") == F.col("n")).alias("is_last"))
    start = F.char_length("formatted") - len(END) - F.col("loss_length")
    return rows.select("conv_id", "example", "formatted", F.when(F.col("trainable"), start).otherwise(0).cast("long").alias("loss_start"),
                       "loss_length", "trainable", "is_last")


def report(rows: DataFrame) -> DataFrame:
    """Per conversation, from its examples: turns and trained text, parsed out of the formatted strings."""
    trained = F.when(F.col("trainable"), F.struct("example", unescape(F.expr("substring(formatted, loss_start + 1, loss_length)")).alias("text")))
    parts = F.split(F.col("formatted"), F.concat(F.lit("\\Q"), F.lit(END), F.lit("\\E")))
    turns = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))
    shown = F.transform(turns, lambda t: F.concat(
        unescape(F.substring_index(F.substr(t, F.lit(len(START) + 1)), SEP, 1)),
        F.lit("\n"),
        unescape(F.substr(t, F.instr(t, SEP) + len(SEP))),
        F.lit("\n"),
    ))
    read = rows.select(
        "conv_id", F.char_length("formatted").cast("long").alias("size"), trained.alias("trained"),
        F.when(F.col("is_last"), F.size(turns)).alias("n"),
        F.when(F.col("is_last"), F.sha2(F.array_join(shown, ""), 256)).alias("sha"),
    )
    grouped = read.groupBy("conv_id").agg(
        F.max("n").cast("long").alias("n_turns"), F.max("sha").alias("turns_sha256"),
        F.array_join(F.transform(F.array_sort(F.collect_list("trained")), lambda x: x["text"]), "").alias("loss"),
        F.sum("size").alias("formatted_chars"),
    )
    return grouped.select("conv_id", "n_turns", "turns_sha256", F.char_length("loss").cast("long").alias("loss_chars"),
                          F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
