"""Chat formatting by prefix-target expansion.

Each turn is rendered as ``### role:`` newline, body, ``</turn>`` newline. The control
strings never occur inside a rendered role or body, because ``escape`` rewrites them:
backslash to ``\\e``, ``###`` to ``\\h``, ``</turn>`` to ``\\t``, and a role's colon to
``\\d``. ``unescape`` is its exact inverse.

Every assistant turn becomes one example: its context is the rendering of all turns before
it, and only its own body is trainable. ``expanded`` writes the examples out in pieces of
bounded size, whose number grows with the square of a conversation. Contexts of one
conversation are prefixes of the same rendering, so ``prefix_targets`` can also name where
each context ends instead of copying it; ``with_context`` writes those contexts as one value.

Cases: null text or role reads as empty; null ``turn`` sorts first; tied turns go by role,
then text; repeated rows are turns of their own; a null ``conv_id`` is a conversation like
any other; no rows in give no rows out; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, COLON, CLOSE = "### ", ":\n", "</turn>\n"
MARKS = (("\\", "\\e"), ("###", "\\h"), ("</turn>", "\\t"))
ASSISTANT = "assistant"
# Turns per block; offsets are added up within and then across blocks, so that no task
# has to hold a conversation of any length.
BLOCK = 1024
# Code points after which the next turn opens a new piece: a piece is this and one turn at most.
PIECE = 4096


def escape(text: Column, role: bool = False) -> Column:
    for mark, code in (*MARKS, *([(":", "\\d")] if role else [])):
        text = F.replace(text, F.lit(mark), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for mark, code in ((":", "\\d"), *reversed(MARKS)):
        text = F.replace(text, F.lit(code), F.lit(mark))
    return text


def render_turns(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per turn: conv_id, turn_no (from 1), role, segment, and its code-point offsets.

    ``start`` counts the code points of the conversation's rendering before the segment;
    ``body_start`` and ``body_end`` bound the body in the same rendering.
    """
    turns = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.floor(F.col("turn") / block).alias("block"),
    )
    turns = turns.withColumn("head", F.concat(F.lit(OPEN), escape(F.col("role"), role=True), F.lit(COLON))).withColumn("body", escape(F.col("text")))
    turns = turns.withColumn("segment", F.concat("head", "body", F.lit(CLOSE))).withColumn("chars", F.length("segment").cast("long"))
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    turns = turns.withColumn("nth", F.row_number().over(inside)).withColumn("upto", F.sum("chars").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        turns.groupBy("conv_id", "block")
        .agg(F.count(F.lit(1)).alias("rows_in"), F.sum("chars").alias("chars_in"))
        .select(
            F.col("conv_id").alias("b_conv"),
            F.col("block").alias("b_block"),
            F.coalesce(F.sum("rows_in").over(before), F.lit(0)).alias("rows_before"),
            F.coalesce(F.sum("chars_in").over(before), F.lit(0)).alias("chars_before"),
        )
    )
    placed = turns.join(blocks, turns.conv_id.eqNullSafe(blocks.b_conv) & turns.block.eqNullSafe(blocks.b_block))
    start = F.col("chars_before") + F.col("upto") - F.col("chars")
    body_start = start + F.length("head")
    return placed.select(
        "conv_id",
        (F.col("rows_before") + F.col("nth")).alias("turn_no"),
        "role",
        "segment",
        start.alias("start"),
        body_start.alias("body_start"),
        (body_start + F.length("body")).alias("body_end"),
    )


def prefix_targets(turns: DataFrame, assistant: str = ASSISTANT) -> DataFrame:
    """One row per assistant turn of ``render_turns``: where its context ends and what is trainable.

    The example's text is the first ``loss_end`` code points of the conversation's rendering
    and the closing mark; ``context_chars`` of them are context; the loss covers
    ``loss_start`` to ``loss_end``, which hold ``target`` (still escaped).
    """
    return turns.where(F.col("role") == assistant).select(
        "conv_id",
        F.col("turn_no").alias("target_turn"),
        F.col("start").alias("context_chars"),
        F.col("body_start").alias("loss_start"),
        F.col("body_end").alias("loss_end"),
        F.substring("segment", F.col("body_start") - F.col("start") + 1, F.col("body_end") - F.col("body_start")).alias("target"),
    )


def with_context(turns: DataFrame, examples: DataFrame) -> DataFrame:
    """Examples with ``context`` written out; its size is the sum of all prefixes."""
    left = turns.select(F.col("conv_id").alias("t_conv"), "turn_no", "segment")
    key = ["conv_id", "target_turn", "context_chars", "loss_start", "loss_end", "target"]
    joined = examples.join(left, examples.conv_id.eqNullSafe(left.t_conv) & (left.turn_no < examples.target_turn), "left")
    parts = F.array_sort(F.collect_list(F.when(F.col("turn_no").isNotNull(), F.struct("turn_no", "segment"))))
    return joined.groupBy(*key).agg(F.array_join(F.transform(parts, lambda p: p["segment"]), "").alias("context"))


def pieces(turns: DataFrame, size: int = PIECE) -> DataFrame:
    """The renderings of ``render_turns`` in pieces: runs of turns that start within the same ``size`` code points.

    A turn longer than that leaves a gap in the piece numbers.
    """
    part = F.struct("turn_no", "role", "segment", "start", "body_start", "body_end")
    return turns.groupBy("conv_id", F.floor(F.col("start") / size).alias("piece")).agg(F.array_sort(F.collect_list(part)).alias("parts"))


def _text(parts: Column | str) -> Column:
    return F.array_join(F.transform(parts, lambda p: p["segment"]), "")


def expanded(cut: DataFrame, assistant: str = ASSISTANT, size: int = PIECE) -> DataFrame:
    """Every assistant turn of ``pieces`` as an example of its own, one row per piece of its text.

    The texts of an example's rows, by ``piece``, are the turns before it and its own.
    ``context_chars`` of a row are context. ``loss_from`` to ``loss_to`` bound the reply in the
    text of the last row and are null in the others. Rows meet the pieces before theirs by
    conversation and piece, so that a long conversation is spread over as many keys.
    """
    replies = F.explode(F.filter("parts", lambda p: p["role"] == assistant)).alias("t")
    first = F.get("parts", 0)["start"]
    own = cut.select("*", replies).select(
        "conv_id",
        F.col("t.turn_no").alias("target_turn"),
        "piece",
        _text(F.filter("parts", lambda p: p["turn_no"] <= F.col("t.turn_no"))).alias("text"),
        (F.col("t.start") - first).alias("context_chars"),
        (F.col("t.body_start") - first).alias("loss_from"),
        (F.col("t.body_end") - first).alias("loss_to"),
    )
    # What a later piece can follow reaches its own end; most conversations have no such piece.
    last = F.element_at("parts", -1)
    full = cut.where(last["start"] + F.length(last["segment"]) >= (F.col("piece") + 1) * size)
    left = full.select(F.col("conv_id").alias("p_conv"), F.col("piece").alias("p_piece"), _text("parts").alias("text"))
    later = cut.where("piece > 0").select("conv_id", "piece", replies).select("conv_id", F.col("t.turn_no").alias("target_turn"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("piece") - 1)).alias("piece"))
    before = later.join(left, later.conv_id.eqNullSafe(left.p_conv) & (later.piece == left.p_piece)).select(
        "conv_id", "target_turn", "piece", "text", F.length("text").cast("long").alias("context_chars"), F.lit(None).cast("long").alias("loss_from"), F.lit(None).cast("long").alias("loss_to")
    )
    return own.unionByName(before)


def conversation_digests(cut: DataFrame, examples: DataFrame) -> DataFrame:
    """What can be read back from ``pieces`` and ``expanded``, per conversation.

    A digest is over one value, so this, unlike the operator, brings the rendering of a
    conversation and its replies into one row. Examples are summed as they are made:
    ``examples_hash`` adds 32 bits of the md5 of every row of ``expanded``.
    """
    nothing = F.lit(None).cast("string")
    row = F.concat_ws(":", "target_turn", "piece", F.coalesce("loss_from", F.lit(-1)), F.coalesce("loss_to", F.lit(-1)), "text")
    target = F.when(F.col("loss_from").isNotNull(), F.substring("text", F.col("loss_from") + 1, F.col("loss_to") - F.col("loss_from")))
    sums = ("context_chars", "example_chars", "examples_hash")
    rows = cut.select("conv_id", F.col("piece").alias("place"), _text("parts").alias("segment"), nothing.alias("target"), *[F.lit(0).cast("long").alias(c) for c in sums]).unionByName(
        examples.select(
            "conv_id",
            F.col("target_turn").alias("place"),
            nothing.alias("segment"),
            target.alias("target"),
            "context_chars",
            F.length("text").cast("long").alias("example_chars"),
            F.conv(F.substring(F.md5(row.cast("binary")), 1, 8), 16, 10).cast("long").alias("examples_hash"),
        )
    )
    pick = lambda name: F.transform(
        F.array_sort(F.collect_list(F.when(F.col(name).isNotNull(), F.struct("place", name)))), lambda p: p[name]
    )
    whole = rows.groupBy("conv_id").agg(F.array_join(pick("segment"), "").alias("rendering"), pick("target").alias("targets"), *[F.sum(c).alias(c) for c in sums])
    back = F.transform(
        F.filter(F.split("rendering", CLOSE), lambda t: t != ""),
        lambda t: F.concat(
            unescape(F.substring(F.substring_index(t, COLON, 1), len(OPEN) + 1, 2**31 - 1)),
            F.lit("\n"),
            unescape(F.substring(t, F.length(F.substring_index(t, COLON, 1)) + len(COLON) + 1, F.length(t))),
            F.lit("\n"),
        ),
    )
    read = whole.select("conv_id", "rendering", back.alias("turns"), F.array_join(F.transform("targets", unescape), "").alias("loss"), F.size("targets").alias("n_examples"), *sums)
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("rendering").cast("long").alias("formatted_chars"),
        F.col("n_examples").cast("long").alias("n_examples"),
        *sums,
    )
