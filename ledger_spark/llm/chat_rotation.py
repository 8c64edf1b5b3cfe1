"""Multi-party perspective rotation of conversations.

For every participant of a conversation the whole dialogue is rendered with that speaker as the
assistant and all others as named users. A rendered message is one row that knows its place in
the rendered text, so no conversation is gathered anywhere, however long it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledger_spark.operators.spread import lookup_join

SYSTEM = "system"
# Turns of a conversation whose lengths are added up together before their sums are.
TURNS_PER_BLOCK = 256
HEAD, MIDDLE, END = "<|im_start|>", "\n", "<|im_end|>\n"


def messages(df: DataFrame) -> DataFrame:
    """Distinct (conv_id, turn, speaker, text): a repeated message is the same message. NULL text
    is empty; a message without a conversation, turn or speaker belongs to no dialogue."""
    known = df.where(
        F.col("conv_id").isNotNull() & F.col("turn").isNotNull() & F.col("role").isNotNull()
    )
    return known.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.col("role").alias("speaker"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).distinct()


def _before(rows: DataFrame, keys: list[str], size: str) -> DataFrame:
    """``rows`` with ``begin``: the sum of ``size`` over earlier messages of the same keys.

    Messages are added up within a turn, turns within a block and blocks within the dialogue, so no
    window holds more than a block of turns or the blocks of one dialogue.
    """
    block = F.floor(F.col("turn") / TURNS_PER_BLOCK)
    rows = rows.withColumn("_block", block)
    earlier = Window.unboundedPreceding, -1
    turns = rows.groupBy(*keys, "_block", "turn").agg(F.sum(size).alias("_size"))
    blocks = turns.groupBy(*keys, "_block").agg(F.sum("_size").alias("_size"))

    def running(frame: DataFrame, by: list[str], order: str, name: str) -> DataFrame:
        window = Window.partitionBy(*by).orderBy(order).rowsBetween(*earlier)
        total = F.coalesce(F.sum("_size").over(window), F.lit(0))
        return frame.withColumn(name, total).drop("_size")

    blocks = running(blocks, keys, "_block", "_before_block")
    turns = running(turns, [*keys, "_block"], "turn", "_before_turn")
    places = turns.join(blocks, [*keys, "_block"])
    within = Window.partitionBy(*keys, "_block", "turn").orderBy("speaker", "text")
    inside = F.coalesce(F.sum(size).over(within.rowsBetween(*earlier)), F.lit(0))
    begin = F.col("_before_block") + F.col("_before_turn") + F.col("_inside")
    return (
        rows.withColumn("_inside", inside)
        .join(places, [*keys, "_block", "turn"])
        .withColumn("begin", begin)
        .drop("_block", "_before_block", "_before_turn", "_inside")
    )


def _rendered(header: Column, text: Column) -> Column:
    return F.concat(F.lit(HEAD), header, F.lit(MIDDLE), text, F.lit(END))


def rotate(df: DataFrame) -> DataFrame:
    """One row per conversation, perspective and message, for columns conv_id, turn, role, text.

    perspective is the participant who speaks as the assistant; system messages stay system ones and
    are no participant. segment is the rendered message; the segments of a perspective by ``begin``
    are its rendered dialogue. begin and end count characters in it; mask_begin and mask_end bound
    what is trained on (text and end mark of the assistant's own messages), NULL for all others.
    Messages of one turn come in the order of speaker and text. A conversation of system messages
    only has no perspective; an empty table gives an empty table; other columns are left out.
    """
    said = messages(df)
    participants = (
        said.where(F.col("speaker") != SYSTEM)
        .select("conv_id", F.col("speaker").alias("perspective"))
        .distinct()
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_set("perspective")).alias("perspectives"))
    )
    own = F.col("speaker") == F.col("perspective")
    header = (
        F.when(F.col("speaker") == SYSTEM, SYSTEM)
        .when(own, "assistant")
        .otherwise(F.concat(F.lit("user name="), F.col("speaker")))
    )
    rows = (
        lookup_join(said, participants, "conv_id")
        .withColumn("perspective", F.explode("perspectives"))
        .drop("perspectives")
        .withColumns({"own": own, "header": header})
        .withColumn("segment", _rendered(F.col("header"), F.col("text")))
        .withColumn("length", F.length("segment").cast("long"))
    )
    placed = _before(rows, ["conv_id", "perspective"], "length")
    front = F.col("begin") + len(HEAD) + F.length("header") + len(MIDDLE)
    end = F.col("begin") + F.col("length")
    return placed.select(
        "conv_id",
        "perspective",
        "turn",
        "speaker",
        "segment",
        "begin",
        end.alias("end"),
        F.when(F.col("own"), front).alias("mask_begin"),
        F.when(F.col("own"), end - 1).alias("mask_end"),
    )
