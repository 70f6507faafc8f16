"""Dialogues rendered once for every participant, in Spark's own expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Turns in one part of a rendered dialogue.
PART_TURNS = 64
#: Turn numbers that are counted together before the turns are numbered.
COARSE = 4096
PROMPT = "system"


def _ordinals(turns: DataFrame) -> DataFrame:
    """The turns with ``place``, 0, 1, ... in each conversation, in two steps."""
    turns = turns.withColumn("coarse", F.floor(F.col("turn") / COARSE))
    keys = ["conv_id", "coarse"]
    before = Window.partitionBy("conv_id").orderBy(F.col("coarse").asc_nulls_last())
    counts = turns.groupBy(*keys).count()
    offsets = counts.select(
        F.col("conv_id").alias("c"),
        F.col("coarse").alias("k"),
        F.coalesce(F.sum("count").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"),
    )
    order = [F.col(name).asc_nulls_last() for name in ("turn", "speaker", "text")]
    ranked = turns.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("coarse").eqNullSafe(F.col("k"))
    return ranked.join(offsets, same).withColumn("place", F.col("offset") + F.col("rank") - 1)


def _spans(pieces: Column) -> Column:
    """[start, end) of the texts to learn from, in characters of the part."""
    start = F.struct(
        F.lit(0).alias("at"),
        F.array().cast("array<struct<start:int,end:int>>").alias("spans"),
    )

    def add(now: Column, piece: Column) -> Column:
        begin = now["at"] + F.length(piece["head"])
        end = begin + F.length(piece["body"])
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(
            (end + F.length(piece["tail"])).alias("at"),
            F.when(piece["learn"], F.concat(now["spans"], span)).otherwise(now["spans"]).alias("spans"),
        )

    return F.aggregate(pieces, start, add, lambda end: end["spans"])


def perspectives(conversations: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """Each dialogue as each participant would continue it.

    Columns: conv_id, perspective (the speaker who is the assistant), part, n_turns,
    rendered, mask (spans of characters to learn from: the assistant's texts with
    their end marks). A turn becomes ``<|assistant|>``, ``<|user|>`` with the name
    of the speaker, or ``<|system|>``, a line break, its text and ``<|end|>``, a
    line break. The speaker ``system`` is a prompt in every perspective, not a
    participant.

    Turns are ordered by turn, speaker and text, nulls last. A row that is repeated
    exactly is one turn, delivered twice. A null text is empty; a null or empty
    speaker is ``unknown``; rows without a conversation id form one conversation.
    A long dialogue is rendered in parts of ``part_turns`` turns, so no row grows
    with the length of a dialogue. A dialogue of prompts alone has no participant
    and no row, nor has an empty table. Other columns are ignored.
    """
    speaker = F.when(F.coalesce("role", F.lit("")) == "", "unknown").otherwise(F.col("role"))
    turns = conversations.select("conv_id", "turn", speaker.alias("speaker"), F.coalesce("text", F.lit("")).alias("text"))
    turns = _ordinals(turns.distinct())
    people = turns.where(F.col("speaker") != PROMPT)
    people = people.select(F.col("conv_id").alias("of"), F.col("speaker").alias("perspective")).distinct()
    seen = turns.join(people, F.col("conv_id").eqNullSafe(F.col("of")))
    own = F.col("speaker") == F.col("perspective")
    head = (
        F.when(F.col("speaker") == PROMPT, "<|system|>\n")
        .when(own, "<|assistant|>\n")
        .otherwise(F.concat(F.lit("<|user|>"), F.col("speaker"), F.lit("\n")))
    )
    learn = own & (F.col("speaker") != PROMPT)
    piece = F.struct(
        "place",
        head.alias("head"),
        F.concat("text", F.when(learn, "<|end|>").otherwise("")).alias("body"),
        F.when(learn, "\n").otherwise("<|end|>\n").alias("tail"),
        learn.alias("learn"),
    )
    part = F.floor(F.col("place") / part_turns).alias("part")
    parts = seen.groupBy("conv_id", "perspective", part).agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    texts = F.transform("pieces", lambda p: F.concat(p["head"], p["body"], p["tail"]))
    return parts.select(
        "conv_id",
        "perspective",
        "part",
        F.size("pieces").cast("long").alias("n_turns"),
        F.array_join(texts, "").alias("rendered"),
        _spans(F.col("pieces")).alias("mask"),
    )
