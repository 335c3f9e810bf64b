"""Chat formatting with Spark expressions only.

Turns are collected for each conversation, sorted as structs, adjacent turns of
one role are merged into a block, and blocks are concatenated:

    [TURN]role[BODY]text[NEXT]text[/TURN][TURN]...

``[NEXT]`` separates the merged turns of a block. Roles and texts are escaped:
a backslash is doubled, and ``[`` and ``<`` get a backslash behind them. So no
control string (nor ``[INST]``, ``</s>``, ``<|...|>`` of other templates) can
come from a text, and :func:`unescaped` gives back the text exactly. The loss
mask has one flag for each part between control strings; the texts of the
loss roles are under it.

Defined results: a null text or role is empty; null turns come first, turns with
equal numbers go by role, then text, so repeated rows are turns of their own; a
null conv_id is a conversation of its own; an empty table gives an empty result.
A conversation is one row of output, so its turns meet in one task whatever
formats them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTROL = r"\[(?:TURN|BODY|NEXT|/TURN)\]"  # as a pattern; escaped text has a backslash behind every [
LOSS_ROLES = ("assistant",)


def escaped(c: Column) -> Column:
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(c, F.lit("<"), F.lit("<\\")), F.lit("["), F.lit("[\\"))


def unescaped(c: Column) -> Column:
    c = F.replace(F.replace(c, F.lit("[\\"), F.lit("[")), F.lit("<\\"), F.lit("<"))
    return F.replace(c, F.lit("\\\\"), F.lit("\\"))


def format_conversations(turns: DataFrame, loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """(conv_id, formatted, loss_mask) from rows (conv_id, turn, role, text)."""
    row = F.struct(F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    convs = turns.groupBy(F.col("conv_id").cast("bigint").alias("conv_id")).agg(F.sort_array(F.collect_list(row)).alias("t"))
    # places where a block begins, and one behind the end
    at = F.sequence(F.lit(1), F.size("t"))
    begins = F.filter(at, lambda i: (i == 1) | (F.element_at("t", i)["role"] != F.element_at("t", F.greatest(i - 1, F.lit(1)))["role"]))
    convs = convs.withColumn("s", F.concat(begins, F.array(F.size("t") + 1)))
    block = F.transform(
        F.slice("s", 1, F.size("s") - 1),
        lambda b, k: F.struct(
            F.element_at("t", b)["role"].alias("role"),
            F.transform(F.slice("t", b, F.element_at("s", k + 2) - b), lambda t: t["text"]).alias("texts"),
        ),
    )
    convs = convs.select("conv_id", block.alias("blocks"))
    text = F.array_join(
        F.transform(
            "blocks",
            lambda b: F.concat(
                F.lit("[TURN]"), escaped(b["role"]), F.lit("[BODY]"), F.array_join(F.transform(b["texts"], escaped), "[NEXT]"), F.lit("[/TURN]")
            ),
        ),
        "",
    )
    # the parts of a block between control strings: before [TURN], the role, each text
    mask = F.flatten(
        F.transform("blocks", lambda b: F.concat(F.array(F.lit(False), F.lit(False)), F.transform(b["texts"], lambda _: b["role"].isin(*loss_roles))))
    )
    return convs.select("conv_id", text.alias("formatted"), F.concat(mask, F.array(F.lit(False))).alias("loss_mask"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of (role, text)."""
    blocks = F.slice(F.split(formatted, r"\[/TURN\]"), 1, F.size(F.split(formatted, r"\[/TURN\]")) - 1)
    split = F.transform(blocks, lambda b: F.split(b, CONTROL))  # "", role, texts
    return F.flatten(
        F.transform(
            split,
            lambda p: F.transform(F.slice(p, 3, F.size(p) - 2), lambda t: F.struct(unescaped(F.element_at(p, 2)).alias("role"), unescaped(t).alias("text"))),
        )
    )


def loss_texts(formatted: Column, mask: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    pairs = F.zip_with(F.split(formatted, CONTROL), mask, lambda p, m: F.struct(p.alias("part"), m.alias("under")))
    return F.transform(F.filter(pairs, lambda x: x["under"]), lambda x: unescaped(x["part"]))


def digest(chats: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from the formatted texts."""
    back = chats.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("t"), F.array_join(loss_texts(F.col("formatted"), F.col("loss_mask")), "").alias("loss"))
    lines = F.array_join(F.transform("t", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("t").cast("bigint").alias("n_turns"), F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
