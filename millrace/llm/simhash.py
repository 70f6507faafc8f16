"""SimHash near-duplicates, found with pivot distance tables."""

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import components, map_batches, releasing, written

#: Reference fingerprints: 16 numbers from a fixed generator.
PIVOTS = np.random.default_rng(20).integers(0, 2**64, 16, dtype=np.uint64)
#: A bucket of more fingerprints is cut into chunks of about this size, which meet pairwise.
CHUNK = 4096


def fingerprint(text: str | None, words: int = 4) -> int:
    """The 64-bit SimHash of a text's word shingles; 0 for null or no words."""
    from xxhash import xxh64_intdigest

    parts = (text or "").encode().lower().split()  # of bytes: ASCII only, as wanted
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = list(accumulate(len(part) + 1 for part in parts))
    starts = [0, *ends[: max(0, len(parts) - words)]]
    ends = ends[min(words, len(parts)) - 1 :]
    hashes = np.fromiter(
        (xxh64_intdigest(joined[a : b - 1], 42) for a, b in zip(starts, ends, strict=True)),
        np.uint64,
        len(starts),
    )
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 65_536):
        bits = np.unpackbits(hashes[start : start + 65_536, None].view(np.uint8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(packed.view(np.uint64)[0])


def _fingerprints(words: int):
    @F.arrow_udf("long")
    @releasing
    def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            prints = [fingerprint(text, words) for text in batch.to_pylist()]
            yield pa.array(np.array(prints, np.uint64).view(np.int64))

    return of.asNondeterministic()


def _masks(distance: int) -> list[int]:
    """Bits that two linked fingerprints may have in common, as signed numbers.

    Of distance + 2 blocks, two prints that differ in at most ``distance`` bits
    share two at least.
    """
    edges = np.linspace(0, 64, distance + 3).astype(int)
    blocks = [sum(1 << bit for bit in range(a, b)) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    masks = [a | b for a, b in combinations(blocks, 2)]
    return [mask - 2**64 if mask >= 2**63 else mask for mask in masks]


def _linked(groups: np.ndarray, sides: np.ndarray, prints: np.ndarray, distance: int):
    """Links that join the prints of each group: a spanning forest, not all pairs.

    Rows of a group are adjacent. Row i meets rows i+1, i+2, ... of its group; pairs
    that are already joined are skipped, pairs that differ by more than ``distance``
    in their distance to any pivot are discarded, and survivors are verified.
    """
    n = len(prints)
    table = np.stack([np.bitwise_count(prints ^ pivot) for pivot in PIVOTS]).astype(np.int8)
    joined = np.arange(n)
    start = np.searchsorted(groups, groups)  # first row of the own group
    end = np.searchsorted(groups, groups, "right") - 1
    left = np.arange(n)
    found: list[tuple[int, int]] = []
    step = 0
    while len(left):
        step += 1
        left = left[left + step <= end[left]]
        pairs = left[joined[left] != joined[left + step]]
        pairs = pairs[(sides[pairs] < 0) | (sides[pairs] != sides[pairs + step])]
        for row in table:
            pairs = pairs[np.abs(row[pairs] - row[pairs + step]) <= distance]
        pairs = pairs[np.bitwise_count(prints[pairs] ^ prints[pairs + step]) <= distance]
        for i in pairs.tolist():
            a, b = joined[i], joined[i + step]
            if a != b:
                own = joined[start[i] : end[i] + 1]
                own[own == max(a, b)] = min(a, b)
                found.append((i, i + step))
    return found


def _link_buckets(distance: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in _with_end(batches):
            if batch is not None:
                rows = [batch[name].to_numpy(zero_copy_only=False) for name in ("bucket", "cell", "side", "print")]
                if kept is not None:
                    rows = [np.concatenate(pair) for pair in zip(kept, rows, strict=True)]
                if not len(rows[0]):
                    continue
                changes = (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])
                cut = int(np.flatnonzero(changes)[-1]) + 1 if changes.any() else 0
                kept = [part[cut:] for part in rows]
                rows, changes = [part[:cut] for part in rows], changes[: max(0, cut - 1)]
            elif kept is None:
                break
            else:
                rows = kept
                changes = (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])
            if len(rows[0]) < 2:
                continue
            groups = np.append(0, np.cumsum(changes))
            prints = rows[3].view(np.uint64)
            if found := _linked(groups, rows[2], prints, distance):
                ends = rows[3][np.array(found)]
                yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["u", "v"])

    return link


def _with_end(batches: Iterator[pa.RecordBatch]):
    yield from batches
    yield None


def fingerprint_links(prints: DataFrame, distance: int = 4) -> DataFrame:
    """Links ``u``, ``v`` between different values of the column ``print``.

    They connect what pairs of at most ``distance`` differing bits connect. Buckets
    share two of distance + 2 blocks of bits. A bucket of many prints is cut into
    chunks; each pair of chunks is a cell with tasks of its own.
    """
    places = [F.struct(F.lit(i).alias("table"), F.col("print").bitwiseAND(F.lit(mask)).alias("key")) for i, mask in enumerate(_masks(distance))]
    placed = prints.select("print").distinct().select("print", F.inline(F.array(*places)))
    placed = placed.select(F.xxhash64("table", "key").alias("bucket"), "print")
    sizes = placed.groupBy("bucket").count()
    large = sizes.where(F.col("count") > CHUNK).select("bucket", F.ceil(F.col("count") / CHUNK).cast("int").alias("chunks"))
    cut = placed.join(large, "bucket", "left").withColumn("chunk", F.expr("pmod(xxhash64(print, 7), chunks)"))
    other = F.explode(F.when(F.col("chunks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("chunks") - 1)))
    cells = cut.withColumn("other", other).select(
        "bucket",
        F.when(F.col("chunks").isNull(), F.lit(0)).otherwise(F.least("chunk", "other") * F.col("chunks") + F.greatest("chunk", "other")).cast("long").alias("cell"),
        # rows of two chunks meet across; rows of one chunk, or of no chunk, all meet
        F.when(F.col("chunks").isNull() | (F.col("chunk") == F.col("other")), F.lit(-1)).otherwise(F.col("chunk")).cast("long").alias("side"),
        "print",
    )
    cells = cells.repartition("bucket", "cell").sortWithinPartitions("bucket", "cell", "print")
    return map_batches(cells, _link_buckets(distance), "u long, v long")


def near_duplicates(documents: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` per document.

    Fingerprints link at ``distance`` or fewer differing bits; a component has the
    smallest doc_id that can be reached. Equal fingerprints are one class: only
    classes are compared, so copies cost nothing. Null and empty texts have the
    fingerprint 0. Repeated rows stay repeated. Rows with a null id take part; their
    component_id is null only if nothing in the component has an id. Other columns
    are ignored. An empty table gives an empty result.
    """
    prints = written(documents.select("doc_id", _fingerprints(words)("text").alias("print")), "prints")
    return _with_components(prints, distance).select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def _with_components(prints: DataFrame, distance: int) -> DataFrame:
    """The rows with their component's ``root``, a print, and ``component_id``;
    ``prints`` is a written table."""
    classes = prints.groupBy("print").agg(F.min("doc_id").alias("least_id"))
    roots = components(fingerprint_links(prints, distance))
    rooted = classes.join(roots.withColumnRenamed("node", "print"), "print", "left")
    rooted = written(rooted.select("print", F.coalesce("root", "print").alias("root"), "least_id"), "classes")
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = rooted.join(least, "root").select("print", "root", "component_id")
    return prints.join(named, "print")


def first_of_groups(documents: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """The documents without near-duplicates: one row of each component, that with the
    smallest id.

    All columns stay. Of rows with one id, that with the smallest text hash stays, and
    of rows alike in both one. A row without an id stays only where its component has
    no id at all, one for each such component. Unlike documents with one id are
    documents each.
    """
    hashed = F.xxhash64("text")
    prints = documents.select("doc_id", hashed.alias("text_hash"), _fingerprints(words)("text").alias("print"))
    named = _with_components(written(prints, "prints"), distance)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")).alias("row")
    chosen = named.groupBy("root").agg(first).select("row.doc_id", "row.text_hash")
    own = documents.columns
    rows = documents.select(F.struct("*").alias("row"), F.col("doc_id").alias("k1"), hashed.alias("k2"))
    rows = rows.dropDuplicates(["k1", "k2"])
    chosen = chosen.select(F.col("doc_id").alias("c1"), F.col("text_hash").alias("c2"))
    kept = rows.join(chosen, F.col("k1").eqNullSafe(F.col("c1")) & (F.col("k2") == F.col("c2")), "left_semi")
    return kept.select(*(F.col("row").getField(name).alias(name) for name in own))
