"""Chat formatting: prefix-target expansion with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: The role ends at the first newline that no backslash precedes.
_ROLE = r"(?s)^([^\\\n]*+(?:\\.[^\\\n]*+)*+)\n"


def escape(text: Column) -> Column:
    """Double backslashes, then break every ``<|`` as ``<\\|``: no control string is left, and :func:`unescape` undoes it."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def chat_examples(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", target: str = "assistant") -> DataFrame:
    """One training example for every ``target`` turn, with all turns before it as context.

    Returns ``conv_id, example, formatted, loss_start, loss_end``: the text of the example
    and the half-open range of code points that is trained on, which is that reply alone.
    Turns after the last reply come in one more example without a trainable range
    (``loss_start = loss_end``), so that the output holds every turn.

    Turns are ordered by (turn, role, text), null turns first; repeated rows stay. A null
    role or text counts as empty; rows with a null conversation form one conversation.
    Other columns are ignored; an empty table gives no rows. A conversation is read as one
    row, as its last example is one text anyway; examples are exploded before their text is
    built, so a long conversation never has all its examples in memory.
    """
    said = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    convs = turns.groupBy(F.col(conv).alias("conv_id")).agg(F.sort_array(F.collect_list(said)).alias("said"))
    marked = F.transform("said", lambda t: F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"), escape(t["text"]), F.lit(END + "\n")))
    ends = F.filter(F.sequence(F.lit(1), F.size("said")), lambda i: (F.element_at("said", i)["role"] == target) | (i == F.size("said")))
    one = convs.select("conv_id", "said", marked.alias("marked"), F.posexplode(ends).alias("example", "upto"))
    last = F.element_at("said", F.col("upto"))
    reply = F.when(last["role"] == target, F.char_length(escape(last["text"]))).otherwise(0)
    return one.select(
        "conv_id", "example", F.array_join(F.slice("marked", 1, F.col("upto")), "").alias("formatted"), reply.alias("_reply")
    ).select(
        "conv_id", "example", "formatted",
        (F.char_length("formatted") - len(END) - 1 - F.col("_reply")).alias("loss_start"),
        (F.char_length("formatted") - len(END) - 1).alias("loss_end"),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, what its examples say: turns, digests of turns and of trained text, and size."""
    learnt = unescape(F.col("formatted").substr(F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    per = examples.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("whole"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", learnt.alias("learnt")))), lambda x: x["learnt"]), "").alias("learnt"),
        F.sum(F.char_length("formatted")).alias("formatted_chars"),
    )
    blocks = F.filter(F.split("whole", r"\Q" + END + r"\E\n"), lambda b: b != "")
    bodies = F.transform(blocks, lambda b: b.substr(F.lit(len(START) + 1), F.char_length(b)))

    def turn(body: Column) -> Column:
        role = F.regexp_extract(body, _ROLE, 1)
        return F.concat(unescape(role), F.lit("\n"), unescape(body.substr(F.char_length(role) + 2, F.char_length(body))), F.lit("\n"))

    return per.select(
        "conv_id",
        F.size(bodies).cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform(bodies, turn), ""), 256).alias("turns_sha256"),
        F.char_length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )
