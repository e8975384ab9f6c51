"""Chat formatting from an event log, in DataFrame functions only.

Events of a conversation: (conv_id, seq, message, kind, role, text), in the order of ``seq``:

* ``open``: the message begins, empty, with a role; ``delta``: streamed text is appended;
* ``edit``: the text so far is replaced by this one; ``regenerate``: it is discarded, and what is
  streamed next is the new version; ``delete``: the message goes until it is opened again.

A message is folded by itself, so a conversation with very many messages is spread over tasks; only
the rendered conversation, which is one output row, meets in one. Texts are escaped reversibly: all
marks of the template begin with ``<`` or ``[`` and no backslash, and inside texts every ``<`` and ``[``
is followed by one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DELTA = 512  # code points streamed at a time by ``events_of_turns``
BEGIN, HEAD_END, END = "<s>[", "\n", "</s>"
NEW_LINE = "[n"  # a line break inside a role
LOSS_ROLE = "assistant"


def _replaced(text: Column, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, text)


def escape(text: Column) -> Column:
    """No mark of the template can be read in the result."""
    return _replaced(text, [("\\", "\\\\"), ("<", "<\\"), ("[", "[\\")])


def unescape(text: Column) -> Column:
    return _replaced(text, [("<\\", "<"), ("[\\", "["), ("\\\\", "\\")])


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(NEW_LINE))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(NEW_LINE), F.lit("\n")))


def events_of_turns(turns: DataFrame, delta: int = DELTA) -> DataFrame:
    """The log that streams a table of finished turns (conv_id, turn, role, text).

    A turn is one ``open`` event and a ``delta`` for each ``delta`` code points. Turns that share
    conv_id and turn are messages of their own, in the order of role and text; null turns come first,
    null roles and texts are empty.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # equal rows are numbered, so that each stays a message
    rows = turns.groupBy("conv_id", "turn", role.alias("role"), text.alias("text")).agg(F.count("*").alias("copies"))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
    message = F.struct("turn", "role", F.xxhash64("text").alias("hash"), F.length("text").alias("length"), "copy")
    pieces = F.sequence(F.lit(0), F.ceil(F.length("text") / delta).cast("int"))
    rows = rows.select("conv_id", message.alias("message"), "role", "text", F.explode(pieces).alias("piece"))
    opened = F.col("piece") == 0
    return rows.select(
        "conv_id",
        F.struct("message", "piece").alias("seq"),
        "message",
        F.when(opened, "open").otherwise("delta").alias("kind"),
        F.when(opened, F.col("role")).alias("role"),
        F.when(~opened, F.substring("text", (F.col("piece") - 1) * delta + 1, F.lit(delta))).alias("text"),
    )


def fold_messages(events: DataFrame) -> DataFrame:
    """Final messages of an event log: conv_id, message, seq (of its first event), role, text.

    ``seq`` and ``message`` may have any sortable type. Events with equal ``seq`` are taken in the
    order of kind, role and text; events of other kinds change nothing; a null text is empty, a
    message that was never opened has the role ''. Deleted messages are left out.
    """
    event = F.struct("seq", "kind", "role", F.coalesce("text", F.lit("")).alias("text"))
    resets = F.col("kind").isin("open", "edit", "regenerate", "delete")
    folded = events.groupBy("conv_id", "message").agg(
        F.array_sort(F.collect_list(event)).alias("events"),
        F.min("seq").alias("seq"),
        F.max(F.when(resets, event.dropFields("text"))).alias("reset"),
        F.max(F.when(F.col("kind") == "open", F.struct("seq", F.coalesce("role", F.lit("")).alias("role")))).alias("opened"),
    )
    live = folded.where(F.coalesce(F.col("reset.kind") != "delete", F.lit(True)))
    # what counts are the texts from the last reset on
    since = F.filter("events", lambda e: (F.col("reset").isNull() | (e.dropFields("text") >= F.col("reset"))) & e["kind"].isin("edit", "delta"))
    text = F.array_join(F.transform(since, lambda e: e["text"]), "")
    return live.select("conv_id", "message", "seq", F.coalesce("opened.role", F.lit("")).alias("role"), text.alias("text"))


def render(messages: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """One formatted text per conversation, and where its loss mask lies.

    ``loss`` has an entry per turn: start and length, in code points from the beginning of that
    turn's text in the format, or null where nothing is learnt. Returns conv_id, formatted, loss.
    """
    head = F.concat(F.lit(BEGIN), escape_role(F.col("role")), F.lit(HEAD_END))
    body = escape(F.col("text"))
    turns = messages.select("conv_id", "seq", "role", head.alias("head"), body.alias("body"))
    span = F.when(F.col("role") == loss_role, F.struct(F.length("head").alias("start"), F.length("body").alias("length")))
    turn = F.struct("seq", F.concat("head", "body", F.lit(END)).alias("piece"), span.alias("loss"))
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return whole.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform("turns", lambda t: t["loss"]).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns (role, text) and the text under the loss mask, unescaped, from what ``render`` returned."""
    cut = F.split("formatted", END)
    rows = formatted.withColumn("pieces", F.slice(cut, F.lit(1), F.size(cut) - 1))

    def turn(piece: Column) -> Column:
        at = F.instr(piece, HEAD_END)
        role = F.substring(piece, F.lit(len(BEGIN) + 1), at - len(BEGIN) - 1)
        return F.struct(unescape_role(role).alias("role"), unescape(F.substring(piece, at + len(HEAD_END), F.length(piece))).alias("text"))

    masked = F.zip_with("pieces", "loss", lambda p, m: F.when(m.isNotNull(), unescape(F.substring(p, m["start"] + 1, m["length"]))))
    return rows.select("conv_id", "formatted", F.transform("pieces", turn).alias("turns"), F.filter(masked, lambda t: t.isNotNull()).alias("learnt"))


def format_turns(turns: DataFrame) -> DataFrame:
    """Formatted conversations of a table of finished turns, by way of its event log."""
    return render(fold_messages(events_of_turns(turns)))
