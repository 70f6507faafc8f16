"""Benchmark items inside documents, by size-partitioned MinHash containment."""

import re
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import releasing

#: Words: letters and digits; everything else separates.
WORD = re.compile(r"[^\W_]+")
#: Characters of items that are searched at once; more items are searched in blocks.
BLOCK_CHARS = 32_000_000


class Item(NamedTuple):
    item_id: int
    shingles: frozenset[bytes]


class Sketches(NamedTuple):
    """One block of items. For each shingle length, the sorted MinHash values of all
    sketches and, for each value, the items that hold it."""

    items: list[Item]
    values: dict[int, np.ndarray]
    holders: dict[int, dict[int, list[int]]]


def word_shingles(text: str | None, words: int) -> tuple[bytes, list[int], list[int]]:
    """The joined words, and where each shingle begins and ends. Fewer words: none."""
    parts = " ".join(WORD.findall((text or "").lower())).encode()
    sizes = [len(part) for part in parts.split(b" ")] if parts else []
    ends = list(accumulate(size + 1 for size in sizes))
    return parts, [0, *ends[: len(ends) - words]] if len(ends) >= words else [], ends[words - 1 :]


def _hashes(shingles) -> np.ndarray:
    from xxhash import xxh64_intdigest

    return np.fromiter(map(xxh64_intdigest, shingles), np.uint64)


def may_lack(size: int, per_mille: int) -> int:
    """Shingles that an item of ``size`` may lack at this containment."""
    return size - -(-size * per_mille // 1000)


def sketch(items: list[tuple[int, str | None]], words: int, per_mille: int) -> Sketches:
    """Bottom MinHash values of the items, partitioned by size.

    Items of 2**p to 2**(p+1) - 1 different shingles are one partition; its sketches
    hold as many of an item's smallest hashes as its largest item may lack at the
    containment sought, and one more. A document that contains an item therefore
    holds a shingle of its sketch.
    """
    made, values, holders = [], {}, {}
    for item_id, text in items:
        count = len(WORD.findall((text or "").lower()))
        length = min(words, count)
        if not length:
            continue
        parts, starts, ends = word_shingles(text, length)
        shingles = frozenset(parts[a : b - 1] for a, b in zip(starts, ends, strict=True))
        largest = (1 << len(shingles).bit_length()) - 1
        lowest = np.sort(_hashes(shingles))[: may_lack(largest, per_mille) + 1]
        for value in lowest.tolist():
            holders.setdefault(length, {}).setdefault(value, []).append(len(made))
        made.append(Item(item_id, shingles))
    for length, known in holders.items():
        values[length] = np.sort(np.fromiter(known, np.uint64, len(known)))
    return Sketches(made, values, holders)


def found_items(text: str | None, block: Sketches, per_mille: int) -> list[tuple[int, int, int]]:
    """(item, shared shingles, shingles of the item) for each contained item."""
    found = []
    for length, values in block.values.items():
        parts, starts, ends = word_shingles(text, length)
        if not starts:
            continue
        hashes = _hashes([parts[a : b - 1] for a, b in zip(starts, ends, strict=True)])
        at = np.searchsorted(values, hashes)
        hits = hashes[values[np.minimum(at, len(values) - 1)] == hashes]
        if not len(hits):
            continue
        holders = block.holders[length]
        candidates = sorted({i for value in set(hits.tolist()) for i in holders[value]})
        own = {parts[a : b - 1] for a, b in zip(starts, ends, strict=True)}
        for i in candidates:
            item = block.items[i]
            shared, size = len(item.shingles & own), len(item.shingles)
            if shared * 1000 >= size * per_mille:
                found.append((item.item_id, shared, size))
    return found


MATCH = pa.struct([("item_id", pa.int64()), ("shared", pa.int32()), ("size", pa.int32())])


def _search(block, per_mille: int):
    @F.arrow_udf("array<struct<item_id:bigint,shared:int,size:int>>")
    @releasing
    def search(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            rows = [found_items(text, block.value, per_mille) for text in batch.to_pylist()]
            named = [[dict(zip(MATCH.names, match, strict=True)) for match in row] for row in rows]
            yield pa.array(named, pa.list_(MATCH))

    return search.asNondeterministic()


def matches(documents: DataFrame, benchmark: DataFrame, words: int = 5, containment: float = 0.8) -> Column:
    """A column for ``documents``: the benchmark items that a text contains.

    An item is contained if the text holds at least ``containment`` of the item's
    different shingles of ``words`` words, anywhere. Words are runs of letters and
    digits in lower case. An item of fewer words is one shingle. An item without
    words, or null, is in no text; a null or empty text contains none. Items with
    one id or one text are found one by one.

    The sketches of a block of items, whose size is bounded, go to every executor,
    and each document is hashed, searched and verified where it is: no document is
    shuffled. A larger benchmark is searched block by block, in full.
    """
    spark = documents.sparkSession
    per_mille = round(containment * 1000)
    chars = benchmark.agg(F.sum(F.length("text") + 1)).first()[0] or 0
    blocks = max(1, -(-chars // BLOCK_CHARS))
    found = []
    for number in range(blocks):
        own = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number)
        items = [(row.item_id, row.text) for row in own.select("item_id", "text").collect()]
        block = spark.sparkContext.broadcast(sketch(items, words, per_mille))
        found.append(_search(block, per_mille)("text"))
    return found[0] if blocks == 1 else F.concat(*found)


def contained_items(documents: DataFrame, benchmark: DataFrame, words: int = 5, containment: float = 0.8) -> DataFrame:
    """A row for each document and item inside it: doc_id, item_id, shared, size.

    ``shared`` of the item's ``size`` shingles are in the document. Documents without
    items have no row. Repeated documents and items have rows of their own; other
    columns are ignored; an empty table on either side gives an empty result.
    """
    column = matches(documents, benchmark, words, containment)
    rows = documents.select("doc_id", column.alias("found"))
    return rows.select("doc_id", F.inline("found"))


def without_items(documents: DataFrame, benchmark: DataFrame, words: int = 5, containment: float = 0.8) -> DataFrame:
    """The documents, with all their columns, that contain no benchmark item."""
    column = matches(documents, benchmark, words, containment)
    rows = documents.select(F.struct("*").alias("row"), "text").select("row", column.alias("found"))
    kept = rows.where(F.size("found") == 0)
    return kept.select(*(F.col("row").getField(name).alias(name) for name in documents.columns))
