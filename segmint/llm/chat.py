"""Chat formatting: a role state machine and a declarative template, in SQL functions only.

A template names each role's label and whether its texts count for the loss, and the
turn orders it accepts. ``format_chat`` emits, per conversation, text segments with loss
flags, the formatted text they join to, and whether the turn order is accepted.
``read_chat`` parses the formatted text back into turns.

A turn is ``### Label: text</turn>`` and a line end. In texts, ``\\`` becomes ``\\\\``, the
mark ``###`` becomes ``\\h`` and ``</turn>`` becomes ``\\e``, so control strings never occur
inside an escaped text and reading back is exact.

Null text counts as empty. A role that the template does not know (null: an empty one)
is written as ``~`` and its escaped name and makes the order invalid; it never counts for
the loss. Turns are ordered by (turn, role, text), nulls first; repeated rows stay. A null
conversation id is a conversation of its own. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK, CLOSE = "###", "</turn>"


@dataclass(frozen=True)
class ChatTemplate:
    labels: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    loss: frozenset[str] = frozenset({"assistant"})
    #: state -> roles that may follow; a state is "start" or the last role
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    )
    accepts: frozenset[str] = frozenset({"assistant"})


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit(MARK), F.lit("\\h"))
    return F.replace(text, F.lit(CLOSE), F.lit("\\e"))


def unescape(text: Column) -> Column:
    """Undo ``escape``: an escaped backslash splits the text into parts without one."""
    def part(p: Column) -> Column:
        p = F.replace(p, F.lit("\\c"), F.lit(":"))
        return F.replace(F.replace(p, F.lit("\\h"), F.lit(MARK)), F.lit("\\e"), F.lit(CLOSE))

    return F.array_join(F.transform(F.split(text, r"\Q\\\E"), part), "\\")


def _map(pairs: list[tuple[str, str]]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs for x in pair])


def _concat(parts: Column) -> Column:
    return F.array_join(parts, "")


def format_chat(turns: DataFrame, template: ChatTemplate = ChatTemplate(), id_col: str = "conv_id") -> DataFrame:
    """One row per conversation: id, n_turns, ``segments`` (text, loss), formatted, valid."""
    labels = _map(list(template.labels.items()))
    moves = _map([(f"{state}>{role}", role) for state, roles in template.follows.items() for role in roles])
    text = F.coalesce(F.col("text"), F.lit(""))
    role = F.coalesce(F.col("role"), F.lit(""))
    grouped = turns.groupBy(F.col(id_col)).agg(
        F.sort_array(F.collect_list(F.struct(F.col("turn").alias("turn"), role.alias("role"), text.alias("text")))).alias("turns")
    )

    def header(t: Column) -> Column:
        unknown = F.concat(F.lit("~"), F.replace(escape(t["role"]), F.lit(":"), F.lit("\\c")))
        return F.concat(F.lit(f"{MARK} "), F.coalesce(F.try_element_at(labels, t["role"]), unknown), F.lit(": "))

    def segments(t: Column) -> Column:
        def piece(value: Column, loss: Column) -> Column:
            return F.struct(value.alias("text"), loss.alias("loss"))

        return F.array(
            piece(header(t), F.lit(False)),
            piece(escape(t["text"]), t["role"].isin(*template.loss)),
            piece(F.lit(f"{CLOSE}\n"), F.lit(False)),
        )

    def step(state: Column, t: Column) -> Column:
        return F.coalesce(F.try_element_at(moves, F.concat(state, F.lit(">"), t["role"])), F.lit("invalid"))

    final = F.aggregate("turns", F.lit("start"), step)
    return grouped.select(
        id_col,
        F.size("turns").cast("long").alias("n_turns"),
        final.isin(*template.accepts).alias("valid"),
        F.flatten(F.transform("turns", segments)).alias("segments"),
    ).withColumn("formatted", _concat(F.transform("segments", lambda s: s["text"])))


def read_chat(formatted: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """The turns (role, text) of a formatted conversation."""
    roles = _map([(label, role) for role, label in template.labels.items()])
    body = F.split(formatted, rf"\Q{CLOSE}\E\n")
    body = F.slice(body, 1, F.size(body) - 1)  # behind the last close there is nothing

    def turn(part: Column) -> Column:
        cut = F.locate(": ", part)
        label = F.substring(part, F.lit(len(MARK) + 2), cut - len(MARK) - 2)
        own = unescape(F.substring(label, F.lit(2), F.length(label)))
        role = F.when(F.startswith(label, F.lit("~")), own).otherwise(F.try_element_at(roles, label))
        return F.struct(role.alias("role"), unescape(F.substring(part, cut + 2, F.length(part))).alias("text"))

    return F.transform(body, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return _concat(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])))
