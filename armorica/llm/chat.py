"""Conversations as training text: a template whose grammar reads back to the source.

A turn is ``### <role>: <text> </turn>`` and a line end. Each turn is rendered as it
is, reparsed, and compared with the source; where the two differ, or the text holds a
control string, its control strings and backslashes are escaped and the turn is
compared again; one that still differed would fail the job. In a role, ``%``, ``:``, ``<`` and line ends are written as percent codes.

The end of a turn cannot occur inside a turn that read back, and it cannot overlap with
itself, so a rendered conversation reads back turn by turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from armorica.llm.common import named

START = "### "
BETWEEN = ": "
END = " </turn>\n"
CONTROL = r"###|</turn>"
# In this order; read back in reverse.
ROLE_CODES = (("%", "%25"), (":", "%3A"), ("<", "%3C"), ("\n", "%0A"))


def _write_role(role: Column) -> Column:
    for plain, code in ROLE_CODES:
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def _read_role(role: Column) -> Column:
    for plain, code in reversed(ROLE_CODES):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"(\\|" + CONTROL + ")", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _render(role: Column, body: Column) -> Column:
    return F.concat(F.lit(START), _write_role(role), F.lit(BETWEEN), body, F.lit(END))


def _header_length(piece: Column) -> Column:
    """Characters up to the body; 0 if the piece is no turn."""
    colon = F.locate(BETWEEN, piece)
    return F.when(piece.startswith(START) & (colon > len(START)), colon + len(BETWEEN) - 1).otherwise(0)


def read_turns(formatted: Column) -> Column:
    """Deterministic parser: the turns of a formatted text as (``role``, ``text``); null members where a piece is no turn."""
    pieces = F.split(formatted, END, -1)

    def turn(piece: Column) -> Column:
        header = _header_length(piece)
        role = F.substring(piece, F.lit(len(START) + 1), header - len(START) - len(BETWEEN))
        body = F.substring(piece, header + 1, F.length(piece))
        return F.struct(F.when(header > 0, _read_role(role)).alias("role"), F.when(header > 0, unescape(body)).alias("text"))

    return F.transform(F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def _reads_back(role: Column, text: Column, body: Column) -> Column:
    """Whether a turn rendered with this body is one turn again, with the same role and text."""
    turns = read_turns(_render(role, body))
    return F.coalesce((F.size(turns) == 1) & (F.get(turns, F.lit(0))["role"] == role) & (F.get(turns, F.lit(0))["text"] == text), F.lit(False))


def format_conversations(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    loss_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``loss_mask`` and ``intact``.

    ``loss_mask`` lists the character ranges (``start`` from 0, ``length``) of the texts
    of ``loss_role`` in ``formatted``, in order; unescaped, they are those texts.
    ``intact``: the formatted text reads back to the source.

    Null texts and roles are empty. Rows are ordered by turn (null first); rows of equal
    turn by role and text, so repeated rows are repeated turns. A null conversation is a
    conversation. Other columns are not read. An empty table gives no rows.
    """
    source = turns.select(
        named(conv_col).alias("conv_id"),
        named(turn_col).alias("turn"),
        F.coalesce(named(role_col), F.lit("")).alias("role"),
        F.coalesce(named(text_col), F.lit("")).alias("text"),
    )
    role, text = F.col("role"), F.col("text")
    plain = ~text.rlike(CONTROL) & _reads_back(role, text, text)
    escaped = F.when(_reads_back(role, text, escape(text)), escape(text)).otherwise(F.raise_error(F.lit("a turn does not read back")))
    written = source.withColumn("body", F.when(plain, text).otherwise(escaped))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    piece = _render(role, F.col("body"))
    header = F.length(_write_role(role)) + len(START) + len(BETWEEN)
    placed = (
        written.withColumn("piece", piece)
        .withColumn("place", F.row_number().over(order))
        .withColumn("stop", F.sum(F.length("piece").cast("bigint")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    )
    mask = F.struct((F.col("stop") - F.length("piece") + header).alias("start"), F.length("body").cast("bigint").alias("length"))
    grouped = placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("place", "piece"))).alias("pieces"),
        F.array_sort(F.collect_list(F.when(role == loss_role, mask))).alias("loss_mask"),
        F.array_sort(F.collect_list(F.struct("place", "role", "text"))).alias("source"),
    )
    formatted = F.array_join(F.transform("pieces", lambda x: x["piece"]), "")
    same = F.transform("source", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    return grouped.withColumn("formatted", formatted).select(
        "conv_id", "formatted", "loss_mask", (read_turns(F.col("formatted")) == same).alias("intact")
    )


def loss_text(formatted: Column, loss_mask: Column) -> Column:
    """Text under the mask, unescaped, range by range."""
    return F.array_join(
        F.transform(loss_mask, lambda x: unescape(F.substring(formatted, x["start"].cast("int") + 1, x["length"].cast("int")))), ""
    )
