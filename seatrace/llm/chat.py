"""Chat formatting: a finite-state machine over roles and a declarative template.

Native DataFrame functions only. A conversation is one row of the result, so its turns are
gathered into that row; no other grouping happens.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """How turns are written, which of them count for the loss, and what order is valid.

    A turn is ``open`` + role + ``middle`` + text + ``close``. ``controls`` are the strings
    that must not appear inside a text; they hold the template's own markers and those of
    other common templates. ``moves`` maps (state, role) to the next state.
    """

    open: str = "<|im_start|>"
    middle: str = "\n"
    close: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    controls: tuple[str, ...] = (
        "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>",
        "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    )
    start: str = "start"
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "system",
            ("start", "user"): "user",
            ("system", "user"): "user",
            ("user", "assistant"): "assistant",
            ("assistant", "user"): "user",
        }
    )
    final: tuple[str, ...] = ("assistant",)


TEMPLATE = Template()


def escaped(text: Column, template: Template = TEMPLATE) -> Column:
    """``text`` without any control string: escapes are doubled, then one is put behind the
    first character of each control string."""
    text = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    for control in template.controls:
        text = F.replace(text, F.lit(control), F.lit(control[0] + ESCAPE + control[1:]))
    return text


def unescaped(text: Column, template: Template = TEMPLATE) -> Column:
    for control in template.controls:
        text = F.replace(text, F.lit(control[0] + ESCAPE + control[1:]), F.lit(control))
    return F.replace(text, F.lit(ESCAPE * 2), F.lit(ESCAPE))


#: A line feed inside a role; a single escape never follows "<" in escaped text otherwise.
ROLE_LINE_FEED = "<" + ESCAPE + "n>"


def _escaped_role(role: Column, template: Template) -> Column:
    return F.replace(escaped(role, template), F.lit("\n"), F.lit(ROLE_LINE_FEED))


def _unescaped_role(role: Column, template: Template) -> Column:
    return unescaped(F.replace(role, F.lit(ROLE_LINE_FEED), F.lit("\n")), template)


def conversations(rows: DataFrame) -> DataFrame:
    """conv_id and turns, an array of (turn, role, text) in order.

    Turns sort by turn, then role, then text; null turns come first. Null roles and texts
    are empty. Repeated rows are repeated turns. Rows with a null conv_id are one
    conversation.
    """
    turn = F.struct(
        "turn",
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def format_chats(rows: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """conv_id, valid, first_invalid, segments and formatted of each conversation.

    ``rows`` needs conv_id, turn, role and text. ``segments`` is an array of (text, loss)
    whose texts make up ``formatted``; loss marks the texts of the loss roles, without
    markers. ``first_invalid`` is the position (from 0) of the first turn that the state
    machine has no move for, null if there is none; ``valid`` also asks for a final state.
    Invalid conversations are formatted all the same.
    """
    moves = F.create_map(
        *[F.lit(x) for (state, role), to in template.moves.items() for x in (f"{state}\n{role}", to)]
    )

    def step(state: Column, turn: Column) -> Column:
        to = F.try_element_at(moves, F.concat(state["state"], F.lit("\n"), turn["role"]))
        bad = state["bad"].isNotNull()
        return F.struct(
            F.when(bad, state["state"]).otherwise(F.coalesce(to, F.lit("invalid"))).alias("state"),
            F.when(bad, state["bad"]).when(to.isNull(), state["seen"]).alias("bad"),
            (state["seen"] + 1).alias("seen"),
        )

    begin = F.struct(
        F.lit(template.start).alias("state"),
        F.lit(None).cast("int").alias("bad"),
        F.lit(0).alias("seen"),
    )

    def segments(turn: Column) -> Column:
        head = F.concat(F.lit(template.open), _escaped_role(turn["role"], template), F.lit(template.middle))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(
                escaped(turn["text"], template).alias("text"),
                turn["role"].isin(*template.loss_roles).alias("loss"),
            ),
            F.struct(F.lit(template.close).alias("text"), F.lit(False).alias("loss")),
        )

    walked = conversations(rows).select(
        "conv_id",
        F.aggregate("turns", begin, step).alias("walk"),
        F.flatten(F.transform("turns", segments)).alias("segments"),
    )
    return walked.select(
        "conv_id",
        (F.col("walk.bad").isNull() & F.col("walk.state").isin(*template.final)).alias("valid"),
        F.col("walk.bad").alias("first_invalid"),
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
    )


def read_turns(formatted: Column, template: Template = TEMPLATE) -> Column:
    """Array of (role, text) read back from formatted text."""
    closed = F.filter(F.split(formatted, re.escape(template.close)), lambda piece: piece != "")

    def parsed(piece: Column) -> Column:
        body = F.substring(piece, F.lit(len(template.open) + 1), F.length(piece))
        role = F.substring_index(body, template.middle, 1)
        text = F.substring(body, F.length(role) + len(template.middle) + 1, F.length(body))
        return F.struct(
            _unescaped_role(role, template).alias("role"), unescaped(text, template).alias("text")
        )

    return F.transform(closed, parsed)


def loss_text(segments: Column, template: Template = TEMPLATE) -> Column:
    """All text under the loss mask, unescaped, in order."""
    under = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(under, lambda s: unescaped(s["text"], template)), "")


def chat_digest(formatted: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Counts and digests read back from the result of ``format_chats``."""
    read = formatted.select(
        "conv_id",
        "valid",
        "formatted",
        read_turns(F.col("formatted"), template).alias("turns"),
        loss_text(F.col("segments"), template).alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )
