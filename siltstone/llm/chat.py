"""Conversations as text segments with loss flags, from a declarative template.

The template's control strings all begin with ``<``. Texts and roles are
escaped so that none of them holds a ``<``: a backslash becomes ``\\b``, a
``<`` becomes ``\\l``. In an escaped text every backslash starts one of these
codes, so they are undone one after the other, and control strings in the
formatted text are always the template's own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROLE, TEXT = object(), object()


@dataclass(frozen=True)
class Template:
    """What a turn looks like, which roles are trained on, and which turns may follow which.

    ``turn`` is a sequence of literals and of the slots ROLE and TEXT, in
    that order. ``moves`` maps the state to the roles that may come next; the
    state is the last role, and "" at the start. ``ends`` are the roles that may
    come last.
    """

    turn: tuple = ("<turn>", ROLE, "<says>", TEXT, "</turn>\n")
    learned: tuple[str, ...] = ("assistant",)
    moves: tuple[tuple[str, tuple[str, ...]], ...] = (
        ("", ("system", "user")),
        ("system", ("user",)),
        ("user", ("assistant",)),
        ("assistant", ("user", "tool")),
        ("tool", ("assistant",)),
    )
    ends: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        literals = [x for x in self.turn if isinstance(x, str)]
        if [x for x in self.turn if not isinstance(x, str)] != [ROLE, TEXT] or len(literals) != 3:
            raise ValueError("a turn is a literal, ROLE, a literal, TEXT, a literal")
        if any(not x.startswith("<") or x.count("<") > 1 for x in literals):
            raise ValueError("each literal starts with its only '<'")


TEMPLATE = Template()


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def _valid(roles: Column, template: Template) -> Column:
    """Runs the states over the roles; a wrong turn leads to the state null, which none leaves."""
    def move(state: Column, role: Column) -> Column:
        nexts = F.when(F.lit(False), F.lit(False))
        for name, allowed in template.moves:
            nexts = nexts.when(state == name, role.isin(*allowed))
        return F.when(nexts, role)

    last = F.aggregate(roles, F.lit(""), move)
    return F.coalesce(last.isin(*template.ends), F.lit(False))


def format_chats(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", template: Template = TEMPLATE,
) -> DataFrame:
    """One row per conversation: conv_id, valid, segments (text, loss) in order.

    Rows of a conversation are ordered by turn, ties by role and text; a
    repeated row is a turn of its own. A null text or role is an empty one; a
    null conv_id is a conversation of its own. ``valid`` tells whether the turn
    order is one that the template allows; nothing is dropped. The turns of one
    conversation are gathered in one row, as its formatted text is.
    """
    rows = turns.select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        ).alias("t"),
    )
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def turn(t: Column) -> Column:
        parts = []
        for x in template.turn:
            if x is TEXT:
                parts.append(segment(escape(t["text"]), t["role"].isin(*template.learned)))
            else:
                parts.append(segment(escape(t["role"]) if x is ROLE else F.lit(x), F.lit(False)))
        return F.array(*parts)

    return chats.select(
        "conv_id",
        _valid(F.transform("t", lambda t: t["role"]), template).alias("valid"),
        F.flatten(F.transform("t", turn)).alias("segments"),
    )


def formatted(segments: str = "segments") -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def learned_text(segments: str = "segments") -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    kept = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(kept, lambda s: unescape(s["text"])), "")


def parse_chat(text: Column, template: Template = TEMPLATE) -> Column:
    """The turns (role, text) of a formatted text, read back."""
    opening, _, middle, _, closing = template.turn
    whole = F.split(text, F.lit(f"\\Q{closing}\\E"), -1)
    each = F.slice(whole, F.lit(1), F.size(whole) - 1)

    def turn(t: Column) -> Column:
        parts = F.split(F.substr(t, F.lit(len(opening) + 1)), F.lit(f"\\Q{middle}\\E"), 2)
        return F.struct(unescape(parts[0]).alias("role"), unescape(parts[1]).alias("text"))

    return F.transform(each, turn)
