"""Chat formatting by prefix-target expansion, with DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it are context, and only its own text is trainable.
The examples of a conversation share their context, so the stored output holds each formatted conversation once, with a
list of examples that say where they end and which code points are trainable.  The store therefore grows with the turns,
not with their square; ``examples`` expands it to one row per example.

A conversation becomes one row, like a document: its turns are gathered in turn order (then by role and text, where turn
numbers repeat).  Null roles and texts count as empty, a null turn comes first, rows with equal ids belong together.  A
conversation without assistant turns has no example.  Extra columns are ignored; an empty table gives no rows.

Template: ``### role:`` and a line break, the text, ``</turn>`` and a line break.  Inside roles and texts a backslash
becomes ``\\b``, ``###`` becomes ``\\h``, ``</turn>`` becomes ``\\e`` and, in roles only, a line break becomes ``\\n`` and a
colon ``\\c``: no control string is left, and since every other backslash is gone the escapes can be undone exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "### ", "</turn>\n"
TEXT_ESCAPES = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\e"))
ROLE_ESCAPES = (*TEXT_ESCAPES, ("\n", "\\n"), (":", "\\c"))
TARGET = "assistant"


def escape(text: Column, escapes: tuple = TEXT_ESCAPES) -> Column:
    for plain, code in escapes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, escapes: tuple = TEXT_ESCAPES) -> Column:
    for plain, code in reversed(escapes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def format_conversations(turns: DataFrame, target: str = TARGET) -> DataFrame:
    """conv_id, formatted, examples: one row per conversation.

    ``examples`` lists, per assistant turn, the turn's number, the code points of the example (``end``) and the trainable
    span (``mask_start`` counted from 0, ``mask_chars``).  Text to train on is the first ``end`` code points.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    head = F.concat(F.lit(START), escape(role, ROLE_ESCAPES), F.lit(":\n"))
    rows = turns.select("conv_id", "turn", role.alias("role"), head.alias("head"), escape(text).alias("body"))
    gathered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "head", "body"))).alias("turns"))
    # running lengths: where each turn's body starts, and where its block ends
    block = lambda t: F.char_length(t.head) + F.char_length(t.body) + len(END)
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit(-1).alias("number"),
                    F.array().cast("array<struct<number:int,end:bigint,mask_start:bigint,mask_chars:bigint>>").alias("examples"))
    step = lambda s, t: F.struct(
        (s["at"] + block(t)).alias("at"), (s["number"] + 1).alias("number"),
        F.when(t.role == target, F.concat(s["examples"], F.array(F.struct(
            (s["number"] + 1).alias("number"), (s["at"] + block(t)).alias("end"),
            (s["at"] + F.char_length(t.head)).alias("mask_start"), F.char_length(t.body).cast("long").alias("mask_chars")))))
        .otherwise(s["examples"]).alias("examples"))
    return gathered.select(
        "conv_id",
        F.concat_ws("", F.transform("turns", lambda t: F.concat(t.head, t.body, F.lit(END)))).alias("formatted"),
        F.aggregate("turns", zero, step, lambda s: s["examples"]).alias("examples"))


def examples(formatted: DataFrame, *keep: str, all_rows: bool = False) -> DataFrame:
    """One row per example: conv_id, number, text (context and target), mask_start, mask_chars, and the columns ``keep``.

    ``all_rows``: with a row of nulls for each conversation that has no example.
    """
    spread = F.explode_outer if all_rows else F.explode
    rows = formatted.select("conv_id", *keep, "formatted", spread("examples").alias("e"))
    text = F.substring("formatted", F.lit(1), F.col("e.end").cast("int"))
    return rows.select("conv_id", F.col("e.number").alias("number"), text.alias("text"), F.col("e.mask_start").alias("mask_start"),
                       F.col("e.mask_chars").alias("mask_chars"), *keep)


def trained_text(target: str = TARGET) -> Column:
    """The text under the loss mask of a row of ``examples``; an example that does not end with the target's own turn is an error."""
    head = START + _plain_escape(target) + ":\n"
    start, chars = F.col("mask_start").cast("int"), F.col("mask_chars").cast("int")
    ends = (start + chars + len(END) == F.char_length("text")) & F.endswith("text", F.lit(END))
    begins = F.substring("text", start - len(head) + 1, F.lit(len(head))) == head
    loss = F.when(ends & begins, unescape(F.substring("text", start + 1, chars)))
    return F.when(F.col("text").isNotNull(), F.coalesce(loss, F.raise_error(F.lit("an example whose mask is not its last turn"))))


def _plain_escape(role: str) -> str:
    for plain, code in ROLE_ESCAPES:
        role = role.replace(plain, code)
    return role


def turns_of(formatted: Column) -> Column:
    """The (role, text) turns that a formatted text holds."""
    blocks = F.filter(F.split(formatted, END, -1), lambda b: b != "")
    middle = lambda b: F.instr(b, ":\n")
    return F.transform(blocks, lambda b: F.struct(
        unescape(F.substring(b, F.lit(len(START) + 1), middle(b) - len(START) - 1), ROLE_ESCAPES).alias("role"),
        unescape(F.substring(b, middle(b) + 2, F.char_length(b))).alias("text")))


def digest(formatted: DataFrame, target: str = TARGET) -> DataFrame:
    """Per conversation, from the stored output: turn count and digest, and the text under the loss masks of its expanded examples."""
    turns = turns_of(F.col("formatted"))
    whole = formatted.select(
        "conv_id", "formatted", "examples", F.size(turns).cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", F.transform(turns, lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))), 256).alias("turns_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))
    of_conversation = ("n_turns", "turns_sha256", "formatted_chars")
    rows = examples(whole, *of_conversation, all_rows=True).select("conv_id", *of_conversation, F.struct("number", trained_text(target).alias("loss")).alias("one"))
    grouped = rows.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in of_conversation],
                                          F.sort_array(F.collect_list(F.when(F.col("one.number").isNotNull(), F.col("one")))).alias("all"))
    loss = F.concat_ws("", F.transform("all", lambda one: one["loss"]))
    return grouped.select("conv_id", "n_turns", "turns_sha256", F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                          "formatted_chars", F.size("all").cast("long").alias("n_examples"))
