"""Chat formatting by prefix-target expansion, with DataFrame functions only.

Every assistant turn becomes an example of its own: all preceding turns are its context, and only
that reply is trainable. A turn reads ``<|role|>text<|end|>``. Inside roles and texts ``~``,
``<|`` and ``|>`` are written ``~0``, ``~1`` and ``~2``, so no text can forge a control string and
every text can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Turns that the first of the two grouping steps brings together.
TURNS_PER_BLOCK = 64
TRAINED_ROLE = "assistant"
_PAIRS = (("~", "~0"), ("<|", "~1"), ("|>", "~2"))
_END = "<|end|>"


def escaped(text: Column) -> Column:
    for plain, code in _PAIRS:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in reversed(_PAIRS):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def conversations(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as array<struct<role,text>>.

    Null roles and texts are empty. Turns come in the order of (turn, role, text), nulls first;
    repeated rows are turns of their own; a null id is a conversation of its own. A conversation
    is gathered in two steps, blocks of 64 turns first, so no task sorts all rows of a long one.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turns = rows.select(
        F.col(id_col).alias("conv_id"),
        F.floor(F.coalesce(F.col(turn_col).cast("long"), F.lit(-1)) / TURNS_PER_BLOCK).alias("block"),
        F.struct(F.col(turn_col).cast("long").alias("turn"), blank(role_col).alias("role"),
                 blank(text_col).alias("text")).alias("it"),
    )
    blocks = turns.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list("it")).alias("its"))
    whole = blocks.groupBy("conv_id").agg(
        F.flatten(
            F.transform(F.sort_array(F.collect_list(F.struct("block", "its"))), lambda b: b["its"])
        ).alias("its")
    )
    bare = lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))
    return whole.select("conv_id", F.transform("its", bare).alias("turns"))


def examples(chats: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """(conv_id, example, formatted, loss_from, loss_chars), one row per trained turn.

    ``formatted`` holds all turns up to and with the trained one; the loss mask covers its
    characters from ``loss_from`` (counted from 0) on, ``loss_chars`` many, which are the escaped
    reply and nothing else. Turns behind the last reply make one more example without loss
    (``loss_chars`` null), so that nothing of a conversation is lost; leave it out for training.
    ``example`` counts from 0. An empty table gives no rows.
    """
    head = lambda t: F.concat(F.lit("<|"), escaped(t["role"]), F.lit("|>"))
    shown = chats.select(
        "conv_id", "turns",
        F.transform(
            "turns", lambda t: F.concat(head(t), escaped(t["text"]), F.lit(_END))
        ).alias("shown"),
    )
    replies = F.filter(
        F.sequence(F.lit(1), F.size("turns")),
        lambda i: F.element_at("turns", i)["role"] == trained_role,
    )
    tail = F.when(
        F.element_at("turns", -1)["role"] != trained_role, F.array(F.size("turns"))
    ).otherwise(F.array().cast("array<int>"))
    each = shown.select(
        "conv_id", "turns", "shown", F.posexplode(F.concat(replies, tail)).alias("example", "upto")
    )
    turn = F.element_at("turns", F.col("upto"))
    formatted = F.array_join(F.slice("shown", F.lit(1), F.col("upto")), "")
    sized = each.select(
        "conv_id", "example", formatted.alias("formatted"),
        F.when(turn["role"] == trained_role, F.char_length(escaped(turn["text"]))).alias("loss_chars"),
    )
    loss_from = F.char_length("formatted") - F.col("loss_chars") - len(_END)
    return sized.select(
        "conv_id", "example", "formatted", loss_from.alias("loss_from"), "loss_chars"
    )


def parsed(formatted: Column) -> Column:
    """The turns of a formatted text, as array<struct<role,text>>."""
    parts = F.split(formatted, r"<\|end\|>", -1)
    inner = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def turn(part: Column) -> Column:
        stop = F.instr(part, "|>")
        return F.struct(
            unescaped(F.substring(part, F.lit(3), stop - 3)).alias("role"),
            unescaped(F.substring(part, stop + 2, F.char_length(part))).alias("text"),
        )

    return F.transform(inner, turn)


def masked(formatted: Column, loss_from: Column, loss_chars: Column) -> Column:
    """The text below the loss mask, read back from the formatted text."""
    return unescaped(F.substring(formatted, loss_from + 1, loss_chars))


def digest(made: DataFrame) -> DataFrame:
    """Per conversation what can be read back from its examples; see ``op7``'s contract."""
    read = made.select(
        "conv_id", "example", "formatted",
        F.char_length("formatted").cast("long").alias("size"),
        F.when(F.col("loss_chars").isNotNull(), F.struct(
            "example", masked(F.col("formatted"), F.col("loss_from"), F.col("loss_chars")).alias("text")
        )).alias("loss"),
    )
    whole = read.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("last"),
        F.sort_array(F.collect_list("loss")).alias("losses"),
        F.sum("size").alias("formatted_chars"),
        F.count(F.lit(1)).alias("n_examples"),
    )
    turns = parsed(F.col("last"))
    shown = F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(F.transform("losses", lambda x: x["text"]), "")
    return whole.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(F.array_join(shown, ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
        "n_examples",
    )
