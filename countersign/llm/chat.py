r"""Chat formatting with Spark expressions only.

A conversation's rows are sorted by turn, adjacent rows of one role become one turn, and all are
joined to one text::

    <turn>user<says>Hello<then>Are you there?</turn>
    <turn>assistant<says>Yes.</turn>

Control strings inside texts and roles get a backslash more (``</turn>`` becomes ``<\/turn>``,
``<\/turn>`` becomes ``<\\/turn>``) and lose it when read back, so any text survives.

Results in special cases: NULL texts and roles are empty ones; NULL turns come first; rows of the same
turn are ordered by role, then text, and repeated rows stay; rows without a conversation id form
one conversation with a NULL id; an empty table gives no row; other columns are ignored. A
conversation is one value of the result, so its rows meet in one task by definition.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, SAYS, THEN, CLOSE = "<turn>", "<says>", "<then>", "</turn>\n"
_NAMES = "turn|says|then|/turn"


def quoted(text: Column) -> Column:
    return F.regexp_replace(text, rf"<(\\*)({_NAMES})>", r"<\\$1$2>")


def unquoted(text: Column) -> Column:
    return F.regexp_replace(text, rf"<\\(\\*)({_NAMES})>", "<$1$2>")


def format_chats(turns: DataFrame, learn_role: str = "assistant") -> DataFrame:
    """``conv_id, n_blocks, pieces, formatted`` per conversation.

    ``pieces`` is the text in order, cut where the loss mask changes:
    ``array<struct<text, loss>>``. Under the loss are the texts of ``learn_role``, without marks.
    """
    row = F.struct(
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    grouped = (
        turns.select("conv_id", row.alias("entry"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("entry")).alias("entries"))
    )
    entries = F.col("entries")
    starts = F.filter(
        F.sequence(F.lit(0), F.size(entries) - 1),
        lambda i: (i == 0) | (entries[i]["role"] != F.get(entries, i - 1)["role"]),
    )

    def block(start: Column, k: Column) -> Column:
        end = F.coalesce(F.get(F.col("starts"), k + 1), F.size(entries))
        texts = F.transform(F.slice(entries, start + 1, end - start), lambda e: e["text"])
        return F.struct(entries[start]["role"].alias("role"), texts.alias("texts"))

    merged = grouped.withColumn("starts", starts).select(
        "conv_id", F.transform("starts", block).alias("blocks")
    )

    def piece(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def pieces_of(block: Column) -> Column:
        learnt, mark = block["role"] == learn_role, F.lit(False)
        first = piece(F.concat(F.lit(OPEN), quoted(block["role"]), F.lit(SAYS)), mark)
        texts = F.flatten(
            F.transform(
                block["texts"],
                lambda t, i: F.array(
                    piece(F.when(i > 0, F.lit(THEN)).otherwise(F.lit("")), mark),
                    piece(quoted(t), learnt),
                ),
            )
        )
        return F.concat(F.array(first), texts, F.array(piece(F.lit(CLOSE), mark)))

    cut = merged.select(
        "conv_id", F.size("blocks").alias("n_blocks"),
        F.flatten(F.transform("blocks", pieces_of)).alias("pieces"),
    )
    return cut.withColumn("formatted", F.array_join(F.col("pieces")["text"], ""))


def read_turns(formatted: Column) -> Column:
    """The rows of a formatted conversation, in order: ``array<struct<role, text>>``."""
    blocks = F.split(formatted, CLOSE)
    blocks = F.slice(blocks, 1, F.size(blocks) - 1)

    def rows(block: Column) -> Column:
        role = unquoted(F.substring_index(F.substr(block, F.lit(len(OPEN) + 1)), SAYS, 1))
        said = F.element_at(F.split(block, SAYS, 2), 2)
        return F.transform(
            F.split(said, THEN, -1), lambda t: F.struct(role.alias("role"), unquoted(t).alias("text"))
        )

    return F.flatten(F.transform(blocks, rows))


def loss_text(pieces: Column) -> Column:
    """All text under the loss mask, as it was before formatting."""
    learnt = F.filter(pieces, lambda p: p["loss"])
    return F.array_join(F.transform(learnt, lambda p: unquoted(p["text"])), "")
