"""Chat formatting: conversations folded from their event logs and rendered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values of the template. A turn is START role newline text END.
START, END = "<|im_start|>", "<|im_end|>\n"
#: Inside texts and roles the two characters that begin a control string get a third one.
OPEN, ESCAPED, NEWLINE = "<|", "<||", "<|nl|>"

#: Kinds of events. All but deltas begin a new version of their message.
MESSAGE, DELTA, EDIT, REGENERATE, DELETE = "message", "delta", "edit", "regenerate", "delete"


def escape(text: Column) -> Column:
    return F.replace(text, F.lit(OPEN), F.lit(ESCAPED))


def unescape(text: Column) -> Column:
    return F.replace(text, F.lit(ESCAPED), F.lit(OPEN))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(NEWLINE))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(NEWLINE), F.lit("\n")))


def final_messages(events: DataFrame) -> DataFrame:
    """Fold a log of (conv_id, seq, turn, kind, role, text) into (conv_id, turn, nth, role, text).

    Events concern the message at ``turn``; ``seq`` orders them. ``message`` opens a
    message with its text, ``delta`` appends, ``edit`` replaces the text, ``regenerate``
    begins an empty version that deltas fill, ``delete`` drops the message. Several
    ``message`` events at one turn are several messages (``nth`` counts them). A delta
    before any of them opens one. Other kinds change nothing.

    A null text is empty, a null role is the first one given in the message, else empty. A
    null conv_id is one conversation, a null turn or seq comes first; equal seq are
    ordered by kind, role and text, so that the result does not depend on input order.
    """
    known = events.where(F.col("kind").isin(MESSAGE, DELTA, EDIT, REGENERATE, DELETE))
    known = known.select("conv_id", "turn", "seq", "kind", "role", F.coalesce("text", F.lit("")).alias("text"))
    # a message's log is what is sorted, so a long conversation is many tasks' work
    rank = F.when(F.col("kind") == MESSAGE, 0).otherwise(1)
    log = Window.partitionBy("conv_id", "turn").orderBy("seq", rank, "kind", "role", "text")
    upto = log.rowsBetween(Window.unboundedPreceding, 0)
    numbered = known.select(
        "*",
        F.row_number().over(log).alias("at"),
        F.sum((F.col("kind") == MESSAGE).cast("int")).over(upto).alias("nth"),
        F.sum((F.col("kind") != DELTA).cast("int")).over(upto).alias("version"),
    )
    last = Window.partitionBy("conv_id", "turn", "nth")
    current = numbered.select(
        "*",
        F.max("version").over(last).alias("last"),
        F.min(F.when(F.col("role").isNotNull(), F.struct("at", "role"))).over(last)["role"].alias("own_role"),
    ).where(F.col("version") == F.col("last"))
    parts = F.sort_array(F.collect_list(F.struct("at", F.when(F.col("kind") == REGENERATE, "").otherwise(F.col("text")).alias("text"))))
    return (
        current.groupBy("conv_id", "turn", "nth", "own_role")
        .agg(parts.alias("parts"), F.max((F.col("kind") == DELETE).cast("int")).alias("gone"))
        .where("gone = 0")
        .select(
            "conv_id",
            "turn",
            "nth",
            F.coalesce("own_role", F.lit("")).alias("role"),
            F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"),
        )
    )


def render(messages: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans.

    ``formatted`` holds the turns in order; ``loss_spans`` the start and end (exclusive, in
    code points of ``formatted``) of the escaped text of each turn by ``trained_role``. A
    conversation becomes one string, so it has to fit into one value; that is the only
    place where its turns meet.
    """
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    pieces = messages.select(
        "conv_id",
        "turn",
        "nth",
        head.alias("head"),
        escape(F.col("text")).alias("body"),
        (F.col("role") == trained_role).alias("trained"),
    ).select(
        "*",
        F.length("head").alias("skip"),
        F.length("body").alias("take"),
        (F.length("head") + F.length("body") + len(END)).cast("long").alias("total"),
    )
    before = Window.partitionBy("conv_id").orderBy("turn", "nth").rowsBetween(Window.unboundedPreceding, 0)
    placed = pieces.select(
        "conv_id",
        "turn",
        "nth",
        F.concat("head", "body", F.lit(END)).alias("piece"),
        (F.sum("total").over(before) - F.col("total") + F.col("skip")).alias("start"),
        "take",
        "trained",
    )
    turns = F.sort_array(F.collect_list(F.struct("turn", "nth", "piece", "start", "take", "trained")))
    gathered = placed.groupBy("conv_id").agg(turns.alias("turns"))
    spans = F.transform(
        F.filter("turns", lambda t: t["trained"]),
        lambda t: F.struct(t["start"].alias("start"), (t["start"] + t["take"]).alias("end")),
    )
    return gathered.select("conv_id", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"), spans.alias("loss_spans"))


def format_chats(events: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """``render`` of the ``final_messages`` of an event log."""
    return render(final_messages(events), trained_role)


def parse(formatted: Column) -> Column:
    """The turns of a rendered conversation as an array of (role, text), unescaped."""
    parts = F.split(formatted, r"<\|im_end\|>\n")
    bodies = F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda p: F.substring(p, len(START) + 1, 2**31 - 1))

    def turn(body: Column) -> Column:
        role = F.substring_index(body, "\n", 1)
        text = F.substring(body, F.length(role) + 2, F.lit(2**31 - 1))
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(bodies, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, with nothing between."""
    pieces = F.transform(
        spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    )
    return F.array_join(pieces, "")


def conversation_log(conversations: DataFrame) -> DataFrame:
    """A table of (conv_id, turn, role, text) as an event log: each row is one message."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("seq"),
        F.col("turn").cast("long").alias("turn"),
        F.lit(MESSAGE).alias("kind"),
        "role",
        "text",
    )


def digests(chats: DataFrame) -> DataFrame:
    """What the rendered output holds: counts and hashes of its turns and its loss text."""
    read = chats.select("conv_id", "formatted", parse(F.col("formatted")).alias("turns"), loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(flat, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
