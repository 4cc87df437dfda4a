"""Chat formatting by prefix-target expansion: every assistant turn becomes an example of its own.

All of it is DataFrame functions: one shuffle on the conversation, a running length per conversation,
one transcript per conversation, and an explode that cuts each example out of the transcript.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE, NEWLINE = "<|im_start|>", "<|im_end|>", "<|nl|>"


def escape(text: Column) -> Column:
    """Break every ``<|`` by a backslash; one more backslash where there are some already (so it can be undone)."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    """Inverse of :func:`escape`."""
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """Escaped role on one line; no escaped text holds ``<|``, so the newline mark is unambiguous."""
    return F.replace(escape(role), F.lit("\n"), F.lit(NEWLINE))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(NEWLINE), F.lit("\n")))


def expand_chat(conversations: DataFrame, trainable_role: str = "assistant") -> DataFrame:
    """One example per assistant turn: the transcript up to and with that turn, only the reply trainable.

    Input columns ``conv_id, turn, role, text``; others are ignored. Output ``conv_id, example`` (0, 1, ...),
    ``n_turns`` in the example, ``formatted``, ``loss_start, loss_end`` (code points of ``formatted``: the
    escaped reply, without its marks), ``trainable`` and ``complete`` (it holds the whole conversation).

    A conversation that does not end with an assistant turn gets a last, untrainable row with the whole
    transcript (``loss_start = loss_end``), so that the output always holds every turn.
    Rows order by ``turn`` (null first), ties by role and text; repeated rows are turns of their own.
    Null role or text: empty. Null ``conv_id``: a conversation of its own. No rows: no rows.
    An example is one value, so one conversation's transcript must fit a row; that is the format's own bound.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.select(
        "conv_id", "turn", "role", "text",
        F.concat(F.lit(OPEN), escape_role(role), F.lit("\n")).alias("head"), escape(text).alias("body"),
        (role == trainable_role).alias("own"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    tail = len(CLOSE) + 1
    turns = (turns
             .withColumn("at", F.row_number().over(order))
             .withColumn("end", F.sum(F.length("head") + F.length("body") + tail).over(
                 order.rowsBetween(Window.unboundedPreceding, 0))))
    turn = F.struct("at", F.concat("head", "body", F.lit(CLOSE + "\n")).alias("shown"))
    target = F.struct("at", "end", (F.col("end") - tail - F.length("body")).alias("loss_start"),
                      (F.col("end") - tail).alias("loss_end"), "own")
    grouped = (turns
               .groupBy("conv_id")
               .agg(F.sort_array(F.collect_list(turn)).alias("turns"), F.max(target).alias("final"),
                    F.sort_array(F.collect_list(F.when(F.col("own"), target))).alias("own_targets")))
    targets = F.when(F.col("final.own"), F.col("own_targets")).otherwise(F.concat("own_targets", F.array("final")))
    script = grouped.select("conv_id", targets.alias("targets"), F.size("turns").alias("all_turns"),
                            F.array_join(F.transform("turns", lambda t: t["shown"]), "").alias("transcript"))
    cut = script.select("conv_id", "all_turns", "transcript", F.posexplode("targets").alias("example", "t"))
    return cut.select(
        "conv_id", F.col("example").cast("int").alias("example"), F.col("t.at").cast("long").alias("n_turns"),
        F.substring("transcript", F.lit(1), F.col("t.end").cast("int")).alias("formatted"),
        F.when(F.col("t.own"), F.col("t.loss_start")).otherwise(F.col("t.end")).cast("long").alias("loss_start"),
        F.when(F.col("t.own"), F.col("t.loss_end")).otherwise(F.col("t.end")).cast("long").alias("loss_end"),
        F.col("t.own").alias("trainable"), (F.col("t.at") == F.col("all_turns")).alias("complete"))


def loss_text(example: Column, start: Column, end: Column) -> Column:
    """The trainable text of an example, unescaped."""
    return unescape(F.substring(example, (start + 1).cast("int"), (end - start).cast("int")))


def parse_turns(formatted: Column) -> Column:
    """The turns of a formatted text as an array of (role, text)."""
    pieces = F.split(formatted, OPEN.replace("|", r"\|"))
    shown = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))
    return F.transform(shown, lambda p: F.struct(
        unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
        unescape(F.substring(p, F.locate("\n", p) + 1, F.length(p) - F.locate("\n", p) - len(CLOSE) - 1)).alias("text")))


def chat_digest(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from the examples: turns, text under the loss, characters (op1's contract)."""
    turns = F.when(F.col("complete"), parse_turns(F.col("formatted")))
    loss = loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_end"))
    rows = examples.select(
        "conv_id", "example", turns.alias("turns"), F.when(F.col("trainable"), loss).alias("loss"),
        F.length("formatted").cast("long").alias("chars"))
    rows = rows.select(
        "conv_id", "example", "loss", "chars", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""),
               256).alias("turns_sha256"))
    grouped = rows.groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"), F.max("turns_sha256").alias("turns_sha256"),
        F.array_join(F.transform(F.sort_array(F.collect_list(
            F.when(F.col("loss").isNotNull(), F.struct("example", "loss")))), lambda x: x["loss"]), "").alias("loss"),
        F.sum("chars").alias("formatted_chars"), F.count("loss").alias("n_examples"))
    return grouped.select(
        "conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars", "n_examples")
