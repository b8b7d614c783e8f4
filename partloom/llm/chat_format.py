"""Chat formatting: conversations to marked text with a loss mask, by a declarative template.

A template names the marks around a turn, the roles and which of them bear loss, and the order in
which roles may follow one another. A finite-state machine over the roles of a conversation says
whether its order is allowed and where it breaks. Everything is SQL functions over arrays.

Defined results: a null text or role is empty; a role the template does not know bears no loss and
makes the order invalid; turns are ordered by (turn, role, text) with nulls first, so ties and
repeated rows keep one order; rows without ``conv_id`` form one conversation; an empty table gives no
rows; further columns are ignored. One row holds a whole conversation, as its text is one value; the work grows
with its length. Where turns begin in it is a running sum over rows, not over an array.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START = "start"
BROKEN = "broken"


@dataclass(frozen=True)
class ChatTemplate:
    """``{open}{role}{after_role}{text}{close}`` per turn.

    ``follows`` maps a state (``start`` or the role just seen) to the roles that may come next;
    ``ends`` are the states in which a conversation may stop. ``mark`` is the two-character control
    sequence that every opening and closing mark starts with, and that texts may not contain bare.
    """

    open: str = "<|im_start|>"
    after_role: str = "\n"
    close: str = "<|im_end|>"
    between: str = "\n"
    mark: str = "<|"
    loss_roles: tuple[str, ...] = ("assistant",)
    follows: Mapping[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            START: ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user", "tool"),
            "tool": ("assistant",),
        }
    )
    ends: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        if len(self.mark) != 2 or "\\" in self.mark or "\n" in self.mark or self.mark[0] == self.mark[1]:
            raise ValueError("mark must be two different characters, neither a backslash nor a line end")
        if not (self.open.startswith(self.mark) and self.close.startswith(self.mark)) or self.open == self.close:
            raise ValueError("open and close must differ and start with mark")
        if self.after_role != "\n":
            raise ValueError("a role ends with a line end")


def _escape(value: Column, template: ChatTemplate) -> Column:
    # A doubled backslash makes every run of them even, so a single one can only be the escape's own.
    first, second = template.mark
    doubled = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit(template.mark), F.lit(f"{first}\\{second}"))


def _unescape(value: Column, template: ChatTemplate) -> Column:
    first, second = template.mark
    bare = F.replace(value, F.lit(f"{first}\\{second}"), F.lit(template.mark))
    return F.replace(bare, F.lit("\\\\"), F.lit("\\"))


def _escape_role(value: Column, template: ChatTemplate) -> Column:
    return F.replace(_escape(value, template), F.lit("\n"), F.lit("<\\n>"))


def _unescape_role(value: Column, template: ChatTemplate) -> Column:
    return _unescape(F.replace(value, F.lit("<\\n>"), F.lit("\n")), template)


def _machine(template: ChatTemplate) -> Column:
    """The transitions as a map from "state role" to the next state."""
    steps = [(f"{state}\n{role}", role) for state, roles in template.follows.items() for role in roles]
    return F.create_map(*(F.lit(x) for pair in steps for x in pair))


def format_conversations(turns: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text).

    ``segments``: array of (text, loss) whose texts, put together, are ``formatted``; ``turn_spans``: the
    (start, length, loss) of each turn's text in ``formatted``, in characters from 0; ``loss_spans``: the (start,
    length) of those that bear loss; ``valid``: the roles follow the template's order; ``broken_at``: the
    number of the first turn out of order, else null.
    """
    template = template or ChatTemplate()
    role, text, tail = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")), template.close + template.between
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    before = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    shown = F.concat(F.lit(template.open), _escape_role(F.col("role"), template), F.lit(template.after_role))
    bears = F.col("role").isin(*template.loss_roles) if template.loss_roles else F.lit(False)
    rows = rows.select("*", shown.alias("shown"), _escape(F.col("text"), template).alias("body"), bears.alias("loss"))
    length = F.char_length("shown") + F.char_length("body") + len(tail)
    # A running sum over rows: in an array each step would copy what there is.
    begun = F.coalesce(F.sum(length).over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.select(
        "conv_id", F.row_number().over(before).alias("place"), "role", "shown", "body", "loss",
        (begun + F.char_length("shown")).cast("int").alias("start"),
    )
    gathered = rows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "role", "shown", "body", "loss", "start"))).alias("turns")
    )

    def segments(turn: Column) -> Column:
        part = lambda value, loss: F.struct(value.alias("text"), loss.alias("loss"))
        return F.array(part(turn["shown"], F.lit(False)), part(turn["body"], turn["loss"]), part(F.lit(tail), F.lit(False)))

    def span(turn: Column) -> Column:
        return F.struct(turn["start"].alias("start"), F.char_length(turn["body"]).alias("length"), turn["loss"].alias("loss"))

    machine = _machine(template)

    def step(state: Column, turn: Column) -> Column:
        moved = F.coalesce(F.element_at(machine, F.concat(state["at"], F.lit("\n"), turn["role"])), F.lit(BROKEN))
        at = F.when(state["at"] == BROKEN, F.lit(BROKEN)).otherwise(moved)
        fine = F.when(at == BROKEN, state["fine"]).otherwise(state["fine"] + 1)
        return F.struct(at.alias("at"), fine.alias("fine"))

    begin = F.struct(F.lit(START).alias("at"), F.lit(0).alias("fine"))
    built = gathered.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.flatten(F.transform("turns", segments)).alias("segments"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["shown"], t["body"], F.lit(tail))), "").alias("formatted"),
        F.transform("turns", span).alias("turn_spans"),
        F.aggregate("turns", begin, step).alias("order"),
    )
    return built.select(
        "conv_id",
        "n_turns",
        "segments",
        "formatted",
        "turn_spans",
        F.transform(F.filter("turn_spans", lambda s: s["loss"]), lambda s: F.struct(s["start"], s["length"])).alias("loss_spans"),
        (F.col("order.at").isin(*template.ends) if template.ends else F.col("order.at") != BROKEN).alias("valid"),
        F.when(F.col("order.at") == BROKEN, F.col("order.fine").cast("long")).alias("broken_at"),
    )


def read_formatted(formatted: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """The turns and the loss text, recovered from ``formatted`` and ``turn_spans`` alone.

    Adds ``read_turns`` (array of role and text) and ``loss_text`` to the columns given. A turn whose text is not
    as long as its span says makes ``loss_text`` null.
    """
    template = template or ChatTemplate()
    # Escaped texts hold no bare mark, so the marks cut the text apart exactly.
    cut_apart = F.split("formatted", _quoted(template.open))
    pieces = F.slice(cut_apart, F.lit(2), F.size(cut_apart))
    ending = len(template.close + template.between)

    def role_of(piece: Column) -> Column:
        return F.substring_index(piece, "\n", 1)

    def body_of(piece: Column) -> Column:
        start = F.char_length(role_of(piece)) + 2
        return F.substr(piece, start, F.char_length(piece) - start + 1 - ending)

    def turn(piece: Column) -> Column:
        return F.struct(_unescape_role(role_of(piece), template).alias("role"), _unescape(body_of(piece), template).alias("text"))

    def under_loss(piece: Column, span: Column) -> Column:
        fits = F.char_length(body_of(piece)) == span["length"]
        return F.when(~span["loss"], F.lit("")).otherwise(F.when(fits, _unescape(body_of(piece), template)))

    parts = F.zip_with(pieces, "turn_spans", under_loss)
    return formatted.withColumns(
        {
            "read_turns": F.transform(pieces, turn),
            "loss_text": F.when(~F.exists(parts, lambda p: p.isNull()), F.array_join(parts, "")),
        }
    )


def _quoted(text: str) -> str:
    return "".join("\\" + c if not c.isalnum() and c.isascii() else c for c in text)
