"""Chat formatting from event logs: fold, then render.  Only DataFrame functions.

The log of a conversation holds events in order of ``seq``.  ``message`` opens a
turn, ``delta`` appends streamed text, ``edit`` replaces the text of a turn and
``regenerate`` empties it for the deltas that follow.  An edit or a regeneration
also discards every later turn logged before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

START, END = "<|im_start|>", "<|im_end|>"
#: The marker starts with these two characters; a text never keeps them adjacent.
OPEN = "<|"
OPENING = ("message", "edit", "regenerate")
FIRST = -(2 ** 62)          # a null turn or seq sorts before all others


def escape(text: Column) -> Column:
    r"""``\`` becomes ``\\`` and ``<|`` becomes ``<\|``, so no marker can appear."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(OPEN), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    r"""Undo ``escape``: doubled backslashes never leave a lone one before ``|``."""
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit(OPEN)), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    """Roles stand on a line of their own: percent escapes for %, < and line ends."""
    for a, b in (("%", "%25"), ("\n", "%0A"), ("<", "%3C")):
        role = F.replace(role, F.lit(a), F.lit(b))
    return role


def unescape_role(role: Column) -> Column:
    for a, b in (("<", "%3C"), ("\n", "%0A"), ("%", "%25")):
        role = F.replace(role, F.lit(b), F.lit(a))
    return role


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, turn, role, text) from (conv_id, seq, turn, kind, role, text).

    Null text counts as empty, a null kind as ``message``, a null turn or seq comes
    first; unknown kinds are ignored.  Events of equal seq are taken in order of
    kind, role and text.  The role is that of the turn's last opening event that
    names one.  Deltas without an opening event open their turn.  Conversations
    are windows: running maxima over sorted rows, no state in Python.
    """
    e = events.select("conv_id", F.coalesce(F.col("seq").cast("long"), F.lit(FIRST)).alias("seq"),
                      F.coalesce(F.col("turn").cast("long"), F.lit(FIRST)).alias("turn"),
                      F.coalesce("kind", F.lit("message")).alias("kind"), "role",
                      F.coalesce("text", F.lit("")).alias("text")).filter(F.col("kind").isin(*OPENING, "delta"))
    earlier = (Window.partitionBy("conv_id").orderBy("turn")
               .rangeBetween(Window.unboundedPreceding, -1))
    order = ["seq", F.col("kind") == "delta", "kind", F.col("role").asc_nulls_first(), "text"]
    here = Window.partitionBy("conv_id", "turn").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("conv_id", "turn")
    e = (e.withColumn("_cut", F.max(F.when(F.col("kind").isin("edit", "regenerate"), F.col("seq"))).over(earlier))
         .filter(F.col("_cut").isNull() | (F.col("seq") > F.col("_cut")))
         .withColumn("_n", F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy(*order)))
         .withColumn("_epoch", F.sum(F.col("kind").isin(*OPENING).cast("int")).over(here))
         .withColumn("_role", F.last("role", ignorenulls=True).over(here))
         .withColumn("_last", F.max("_epoch").over(whole))
         .filter(F.col("_epoch") == F.col("_last")))
    parts = F.sort_array(F.collect_list(F.struct("_n", "text", "_role")))
    return (e.groupBy("conv_id", "turn").agg(parts.alias("p"))
            .select("conv_id", "turn", F.element_at("p", -1)["_role"].alias("role"),
                    F.array_join(F.col("p.text"), "").alias("text")))


def render(messages: DataFrame, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv_id, formatted, mask) from final messages (conv_id, turn, role, text).

    A turn is written ``<|im_start|>role\\ntext<|im_end|>\\n``; ``mask`` lists the
    spans (start, length in code points, 0-based) of ``formatted`` that carry loss:
    the texts of ``trained`` roles.  A null role is written as empty.  A rendered
    conversation is one string, so it is bounded by the size of a string value (2 GB).
    Turns of equal number are written in order of role and text, null roles first; the
    mask counts in the same order.  Repeated rows are written again, a null conv_id is a
    conversation like any other, an empty table gives none; other columns are left out.
    """
    role, text = escape_role(F.coalesce("role", F.lit(""))), escape(F.coalesce("text", F.lit("")))
    m = (messages.select("conv_id", "turn", "role", "text",
                         F.concat(F.lit(START), role, F.lit("\n")).alias("_head"), text.alias("_body"))
         .withColumn("_turn", F.concat("_head", "_body", F.lit(END + "\n"))))
    order = F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    before = Window.partitionBy("conv_id").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    m = m.withColumn("_at", F.coalesce(F.sum(F.char_length("_turn")).over(before), F.lit(0))
                     + F.char_length("_head"))
    span = F.struct(F.col("_at").cast("long").alias("start"), F.char_length("_body").cast("long").alias("length"))
    rows = F.sort_array(F.collect_list(F.struct(
        order.alias("place"), F.col("_turn").alias("out"),
        F.when(F.col("role").isin(*trained), span).alias("span"))))
    return (m.groupBy("conv_id").agg(rows.alias("r"))
            .select("conv_id", F.array_join(F.col("r.out"), "").alias("formatted"),
                    F.filter(F.col("r.span"), lambda s: s.isNotNull()).alias("mask")))


def parse(formatted: Column) -> Column:
    """Turns of a formatted conversation, read back: array of (role, text)."""
    turns = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda s: s != "")
    tail = len(END) + 1

    def one(t: Column) -> Column:
        line = F.instr(t, "\n")
        return F.struct(unescape_role(F.substring(t, F.lit(1), line - 1)).alias("role"),
                        unescape(F.substring(t, line + 1, F.char_length(t) - line - tail)).alias("text"))

    return F.transform(turns, one)


def masked(formatted: Column, mask: Column) -> Column:
    """Texts under the loss mask, unescaped, in order."""
    return F.transform(mask, lambda s: unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))


def digest(rendered: DataFrame) -> DataFrame:
    """What the formatted strings hold, read back from them and their masks: one row for each of
    ``rendered``.  A conversation without loss has the digest of the empty text."""
    d = rendered.withColumn("_turns", parse(F.col("formatted")))
    d = d.withColumn("_loss", F.array_join(masked(F.col("formatted"), F.col("mask")), ""))
    lines = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return d.select("conv_id", F.size("_turns").cast("long").alias("n_turns"), F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
                    F.char_length("_loss").cast("long").alias("loss_chars"),
                    F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
                    F.char_length("formatted").cast("long").alias("formatted_chars"))
