"""Chat formatting by prefix-target expansion: one example per assistant turn.

An example is the formatted turns before an assistant turn, then that turn; only its reply is
under the loss mask. A conversation that does not end with an assistant turn has one more
example with nothing to learn, so that no turn is lost. Template of a turn:

    <|im_start|>ROLE\\nTEXT<|im_end|>\\n

Control strings inside texts and roles are escaped reversibly: every ``<`` + backslashes + ``|``
gets one backslash more, after which no text holds ``<|``; in roles a line break becomes ``\\n``.

The expansion is quadratic in a conversation's turns because its result is; a conversation is
formatted once and every example is a prefix of it, cut by position. Turns are ordered by
(turn, role, text), so ties have one result. Cases: null text is empty, null role is an empty
role; a null conv_id is one conversation; repeated rows are turns of their own; an empty table
gives no rows; other columns are ignored. A conversation is the unit that must fit a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    # doubled backslashes are told apart from the one before an n by cutting at them first
    parts = F.transform(F.split(unescape(role), r"\\\\"), lambda x: F.replace(x, F.lit("\\n"), F.lit("\n")))
    return F.array_join(parts, "\\")


def examples(conversations: DataFrame) -> DataFrame:
    """(conv_id, position, text, loss_start, loss_end): ``position`` is the target's place among
    the turns; code points [loss_start, loss_end) of ``text`` are trainable."""
    turn = F.struct("turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    turns = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    parts = F.transform("turns", lambda t: F.struct((t.role == ASSISTANT).alias("target"), F.concat(F.lit(START), _escape_role(t.role), F.lit("\n")).alias("head"), escape(t.text).alias("body")))
    rows = turns.select("conv_id", parts.alias("parts"))
    rows = rows.select("conv_id", "parts", F.transform("parts", lambda p: F.concat(p.head, p.body, F.lit(END + "\n"))).alias("formatted"))
    ends = F.aggregate("formatted", F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + F.length(x))))
    rows = rows.select("conv_id", "parts", F.array_join("formatted", "").alias("whole"), ends.alias("ends"))
    last = F.size("parts") - 1
    wanted = F.filter(F.sequence(F.lit(0), last), lambda i: F.get("parts", i).target | (i == last))
    rows = rows.select("conv_id", "parts", "whole", "ends", F.explode(wanted).alias("position"))
    part = F.get("parts", F.col("position"))
    start = F.get("ends", F.col("position")) + F.length(part.head)
    return rows.select("conv_id", F.col("position").cast("long").alias("position"), F.substring("whole", F.lit(1), F.get("ends", F.col("position") + 1)).alias("text"), start.cast("long").alias("loss_start"), F.when(part.target, start + F.length(part.body)).otherwise(start).cast("long").alias("loss_end"))


def digests(rows: DataFrame) -> DataFrame:
    """Reads examples back: (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars) per conversation."""
    loss = unescape(F.substring("text", F.col("loss_start").cast("int") + 1, (F.col("loss_end") - F.col("loss_start")).cast("int")))
    per = rows.select("conv_id", "position", "text", loss.alias("loss"), F.length("text").cast("long").alias("size"))
    by_conv = per.groupBy("conv_id").agg(F.max(F.struct("position", "text")).alias("longest"), F.array_sort(F.collect_list(F.struct("position", "loss"))).alias("learnt"), F.sum("size").alias("formatted_chars"))
    by_conv = by_conv.select("conv_id", "formatted_chars", F.array_join(F.transform("learnt", lambda x: x.loss), "").alias("loss"), F.slice(F.split("longest.text", r"<\|im_start\|>"), 2, 2**31 - 1).alias("parts"))

    def back(p: Column) -> Column:
        role = F.substring_index(p, "\n", 1)
        body = F.substr(p, F.length(role) + 2, F.length(p) - F.length(role) - 2 - len(END))
        return F.concat(_unescape_role(role), F.lit("\n"), unescape(body), F.lit("\n"))

    whole = F.array_join(F.transform("parts", back), "")
    return by_conv.select("conv_id", F.size("parts").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
