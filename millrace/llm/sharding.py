"""Shards by jump consistent hashing, in Spark's own expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.shared import written

#: Rows that are numbered together, about.
SLOT_ROWS = 50_000
#: The multiplier of the published generator, 2862933555777941757, in two halves.
HIGH, LOW = divmod(2862933555777941757, 1 << 32)
LOW_HIGH, LOW_LOW = divmod(LOW, 1 << 16)
HALF = (1 << 32) - 1


def _next_state(state: Column) -> Column:
    """state * multiplier + 1 modulo 2**64, in parts that can't overflow a long."""
    low, high = state.bitwiseAND(HALF), F.shiftrightunsigned(state, 32)
    first = low * LOW_LOW
    middle = low * LOW_HIGH + F.shiftrightunsigned(first, 16)
    product = F.shiftleft(middle, 16).bitwiseOR(first.bitwiseAND(0xFFFF))
    upper = (
        F.shiftrightunsigned(product, 32)
        + (low * HIGH).bitwiseAND(HALF)
        + (high * LOW_LOW).bitwiseAND(HALF)
        + F.shiftleft((high * LOW_HIGH).bitwiseAND(0xFFFF), 16)
    )
    lower = product.bitwiseAND(HALF) + 1
    upper = upper + F.shiftrightunsigned(lower, 32)
    return F.shiftleft(upper.bitwiseAND(HALF), 32).bitwiseOR(lower.bitwiseAND(HALF))


def jump_shard(key: Column, shards: int) -> Column:
    """The shard of a long key, 0 to ``shards`` - 1, by the published jump algorithm.

    One shard more moves a share of about 1 / (shards + 1) of the keys, all of them
    into the new shard. A key makes at most ``shards`` jumps.
    """
    start = F.struct(key.alias("state"), F.lit(-1).cast("long").alias("at"), F.lit(0).cast("long").alias("to"))

    def jump(now: Column, _: Column) -> Column:
        state = _next_state(now["state"])
        share = F.lit(float(1 << 31)) / (F.shiftrightunsigned(state, 33) + 1).cast("double")
        moved = F.struct(
            state.alias("state"),
            now["to"].alias("at"),
            ((now["to"] + 1).cast("double") * share).cast("long").alias("to"),
        )
        return F.when(now["to"] < shards, moved).otherwise(now)

    steps = F.sequence(F.lit(1), F.lit(shards))
    return F.aggregate(steps, start, jump, lambda end: end["at"].cast("int"))


def assign_shards(documents: DataFrame, shards: int = 24) -> DataFrame:
    """Each document with its shard, its place there, and its shard with one more.

    Columns: doc_id, size (bytes of the text plus 8), text_crc32, law (``key``: the
    id and the number of shards decide), shard, slot (0, 1, ... in each shard),
    grown_shard. A null text has no bytes; a null id is a key like any other.
    Repeated rows are kept and get slots of their own. Other columns are ignored.

    Slots are numbered in two steps: each shard is cut into ranges of a hash, with
    as many ranges as its rows need, and the counts of ranges are added up. Rows of
    one id and text share a range, unless they are rows of different input parts.
    """
    key = F.xxhash64("doc_id")
    text = F.coalesce("text", F.lit("")).cast("binary")
    part = F.shiftright(F.monotonically_increasing_id(), 33)
    placed = written(
        documents.select(
            "doc_id",
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            jump_shard(key, shards).alias("shard"),
            jump_shard(key, shards + 1).alias("grown_shard"),
            F.xxhash64("doc_id", "text", part).alias("place"),
        ),
        "shards",
    )
    ranges = max(1, -(-placed.count() // (shards * SLOT_ROWS)))
    placed = placed.withColumn("range", F.pmod("place", F.lit(ranges)).cast("int"))
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("shard", "range").count()
    offsets = offsets.select("shard", "range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "range").orderBy("place", "doc_id", "text_crc32")
    numbered = placed.withColumn("rank", F.row_number().over(inside))
    return numbered.join(offsets, ["shard", "range"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("offset") + F.col("rank") - 1).alias("slot"),
        "grown_shard",
    )
