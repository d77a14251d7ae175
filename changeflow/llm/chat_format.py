"""Chat logs: final messages from events, and training texts with a loss mask.

A log has one row per event: conversation, sequence number, turn, kind, role and
text.  Kinds:

``start``       a message begins; its text, if any, is the first part
``delta``       a further part of the text
``edit``        the text is replaced, and later turns begun before it are void
``regenerate``  the text is dropped and comes anew; later turns as for an edit

Events are folded per message, so a conversation with very many turns is spread
over tasks; only finished turns meet to be put in line.

The template is ``<|turn|>role<|text|>text<|end|>`` per turn.  A control string
in a role or text gets a backslash after its first sign; one that has some
already gets one more, so that removing one restores the text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: This template's control strings, and those of common templates.
CONTROLS = r"(<)(\\*)(\|(?:turn|text|end|im_start|im_end|endoftext)\||/?s|<SYS>|</SYS>)(>)"
CONTROLS_SQUARE = r"(\[)(\\*)(/?INST)(\])"
ESCAPED = CONTROLS.replace(r"(\\*)", r"\\(\\*)")
ESCAPED_SQUARE = CONTROLS_SQUARE.replace(r"(\\*)", r"\\(\\*)")


def escape(text: Column) -> Column:
    for pattern in (CONTROLS, CONTROLS_SQUARE):
        text = F.regexp_replace(text, pattern, r"$1\\$2$3$4")
    return text


def unescape(text: Column) -> Column:
    for pattern in (ESCAPED, ESCAPED_SQUARE):
        text = F.regexp_replace(text, pattern, r"$1$2$3$4")
    return text


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages of a log with conv_id, seq, turn, kind, role, text.

    One row per message that is left: conv_id, turn, role, text.  Null text
    counts as empty, a null kind as ``delta``; the role is the latest that an
    event of the message names.  Events of one sequence number are taken in
    order of kind and text.  Rows without a turn are no message.
    """
    kind = F.coalesce("kind", F.lit("delta"))
    event = F.struct("seq", kind.alias("kind"), F.coalesce("text", F.lit("")).alias("text"), "role")
    forks = kind.isin("edit", "regenerate")
    messages = events.where(F.col("turn").isNotNull()).groupBy("conv_id", "turn").agg(
        F.sort_array(F.collect_list(event)).alias("events"),
        F.max(F.when(forks, F.col("seq"))).alias("forked"),
    )
    earlier = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    alive = messages.withColumn("void", F.max("forked").over(earlier)).withColumn(
        "events",
        F.filter("events", lambda e: F.col("void").isNull() | (e["seq"] > F.col("void"))),
    ).where(F.size("events") > 0)
    # Parts from the last reset on: their texts in order are the message.
    resets = F.transform(
        "events", lambda e, i: F.when(e["kind"].isin("start", "edit", "regenerate"), i).otherwise(F.lit(-1))
    )
    last = F.greatest(F.array_max(resets), F.lit(0))
    parts = F.slice("events", last + 1, F.size("events"))
    roles = F.filter(F.transform("events", lambda e: e["role"]), lambda r: r.isNotNull())
    return alive.select(
        "conv_id", "turn", F.get(roles, F.size(roles) - 1).alias("role"),
        F.array_join(F.transform(parts, lambda e: e["text"]), "").alias("text"),
    )


def render(messages: DataFrame, learn_roles: Sequence[str] = ("assistant",)) -> DataFrame:
    """The training text of each conversation, and which of its pieces count for the loss.

    ``messages`` has conv_id, turn, role, text.  One row per conversation:
    conv_id, formatted, pieces (array of text and loss; joined they are
    ``formatted``).  A null role is written as an empty one; null text as empty.
    """
    role = F.coalesce("role", F.lit(""))
    text = escape(F.coalesce("text", F.lit("")))
    rendered = messages.select(
        "conv_id",
        F.struct(
            "turn",
            F.concat(F.lit(TURN), escape(role), F.lit(TEXT)).alias("head"),
            text.alias("body"),
            role.isin(list(learn_roles)).alias("loss"),
        ).alias("line"),
    )
    lines = rendered.groupBy("conv_id").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    pieces = F.flatten(F.transform("lines", lambda x: F.array(
        F.struct(x["head"].alias("text"), F.lit(False).alias("loss")),
        F.struct(x["body"].alias("text"), x["loss"].alias("loss")),
        F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")),
    )))
    whole = lines.select("conv_id", pieces.alias("pieces"))
    return whole.select(
        "conv_id", F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"), "pieces"
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a training text: an array of role and text, unescaped."""
    marked = F.split(formatted, r"<\|turn\|>")
    turns = F.slice(marked, 2, F.greatest(F.size(marked) - 1, F.lit(0)))
    return F.transform(turns, lambda t: F.struct(
        unescape(F.substring_index(t, TEXT, 1)).alias("role"),
        unescape(F.substring_index(F.substring_index(t, TEXT, -1), END, 1)).alias("text"),
    ))


def format_chats(events: DataFrame, learn_roles: Sequence[str] = ("assistant",)) -> DataFrame:
    """From the log to training texts: ``fold_events``, then ``render``."""
    return render(fold_events(events), learn_roles)


def as_events(conversations: DataFrame) -> DataFrame:
    """A log whose final messages are the rows of ``conversations``, in order of turn.

    Every text is streamed in two parts.  An assistant's comes after a draft that
    is regenerated, a user's first version is its mirror image, edited later.
    Rows of one conversation and turn are messages of their own, in order of role
    and text; a null turn comes first.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select(
        "conv_id", F.col("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.row_number().over(order).cast("bigint").alias("turn"),
    )
    half = F.floor(F.length("text") / 2).cast("int")
    first, rest = F.left("text", half), F.substring("text", half + 1, F.length("text"))

    def event(kind: str, role: Column, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), role.alias("role"), text.alias("text"))

    role, none = F.col("role"), F.lit(None).cast("string")
    said = [event("start", role, first), event("delta", none, rest)]
    answered = [event("start", role, rest), event("regenerate", none, first), event("delta", none, rest)]
    edited = [event("start", role, F.reverse("text")), event("edit", none, first), event("delta", none, rest)]
    log = (
        F.when(role == "assistant", F.array(*answered))
        .when(role == "user", F.array(*edited))
        .otherwise(F.array(*said))
    )
    listed = rows.select("conv_id", "turn", F.posexplode(log).alias("i", "event"))
    return listed.select(
        "conv_id", (F.col("turn") * 10 + F.col("i")).alias("seq"), "turn", "event.kind", "event.role", "event.text"
    )
