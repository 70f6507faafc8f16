"""The trie of all beginnings of conversations, from z-fast tries of its parts."""

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from functools import reduce
from hashlib import sha256
from itertools import accumulate
from operator import xor
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.shared import map_batches, written

#: Turns in one segment of a conversation. A longer one is several sequences.
SEGMENT = 1024
#: Turns that one trie in memory holds, at most but for the last sequence.
TRIE_TURNS = 400_000
#: Conversation ids joined into one piece of text before it is hashed.
IDS_TOGETHER = 4096
#: Letters of a text that help to deal turns out; rows beyond them are sorted whole.
TIE_LETTERS = 32
KEY = ["fa", "fb"]
MASK = (1 << 64) - 1


def two_fattest(a: int, b: int) -> int:
    """The number in (a, b] that the largest power of two divides."""
    return b & (-1 << ((a ^ b).bit_length() - 1))


class Node:
    """A compacted node: the prefixes of lengths (start, end] of one sequence."""

    __slots__ = ("parent", "start", "end", "path", "details", "least", "weights")

    def __init__(self, parent: "Node | None", start: int, end: int, path: Sequence[int], details):
        self.parent, self.start, self.end = parent, start, end
        self.path, self.details = path, details
        self.least: int | None = None
        self.weights: list[int] | None = None

    def handle(self) -> int:
        return self.path[two_fattest(self.start, self.end)]


class ZFastTrie:
    """A compacted trie of sequences, each given as the fingerprints of its prefixes.

    ``path[n]`` is the fingerprint of the first n items after a common beginning,
    path[0] that of the beginning itself, of which a trie may hold several. Nodes
    stand in a hash table under the prefix whose length is the two-fattest number of
    their edge, so that the node at which a sequence leaves the trie is found by a
    binary search over lengths, with one lookup a step.
    """

    def __init__(self):
        self.roots: dict[int, Node] = {}
        self.handles: dict[int, Node] = {}
        self.edges: dict[int, Node] = {}  # by the first prefix of the edge
        self.size = 0

    def exit_node(self, path: Sequence[int]) -> tuple[Node, int]:
        """The node whose edge the sequence leaves or ends in, and how many of its
        items are in the trie."""
        node, low, high = self.roots[path[0]], 0, len(path) - 1
        while low < high:
            length = two_fattest(low, high)
            found = self.handles.get(path[length])
            if found is None:
                high = length - 1
            elif found.end < len(path) and path[found.end] == found.path[found.end]:
                node, low = found, found.end
            else:
                return found, self._common(found, path)
        below = self.edges.get(path[node.end + 1]) if node.end + 1 < len(path) else None
        return (below, self._common(below, path)) if below else (node, node.end)

    @staticmethod
    def _common(node: Node, path: Sequence[int]) -> int:
        """The last length at which the sequence is still on the node's edge."""
        lengths = range(node.start + 1, min(node.end, len(path) - 1) + 1)
        left = bisect_left(lengths, True, key=lambda n: path[n] != node.path[n])
        return node.start + left

    def _place(self, node: Node) -> Node:
        self.handles[node.handle()] = node
        self.edges[node.path[node.start + 1]] = node
        return node

    def _split(self, node: Node, length: int) -> Node:
        del self.handles[node.handle()]
        upper = Node(node.parent, node.start, length, node.path, node.details)
        node.parent, node.start = upper, length
        self._place(upper)
        self._place(node)
        return upper

    def insert(self, path: Sequence[int], details, member: int, weights: Sequence[int]) -> None:
        """Add a sequence of a member; its weights count at its last node."""
        if path[0] not in self.roots:
            self.roots[path[0]] = Node(None, 0, 0, path, details)
        node, length = self.exit_node(path)
        if length < node.end:
            node = self._split(node, length)
        if length + 1 < len(path):
            node = self._place(Node(node, length, len(path) - 1, path, details))
        node.least = member if node.least is None else min(node.least, member)
        node.weights = [a + b for a, b in zip(node.weights or [0] * len(weights), weights, strict=True)]
        self.size += len(path) - 1

    def totals(self) -> list[Node]:
        """The nodes below the roots, deepest first. Weights become those of the whole
        subtree, ``least`` its smallest member."""
        nodes = sorted(self.handles.values(), key=lambda node: -node.end)
        for node in nodes:
            above = node.parent
            if above.least is None or node.least < above.least:
                above.least = node.least
            above.weights = [a + b for a, b in zip(above.weights or [0] * len(node.weights), node.weights, strict=True)]
        return nodes


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _expanded(trie: ZFastTrie, width: int) -> Iterator[pa.RecordBatch]:
    """One row for each prefix on each edge."""
    names = ["fa", "fb", "pa", "pb", "depth", "bytes", "before", "least", *(f"w{i}" for i in range(width))]
    rows: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    for node in trie.totals():
        depth, sizes, before = node.details
        for n in range(node.start + 1, node.end + 1):
            own, above = node.path[n], node.path[n - 1]
            rows.append(
                (_signed(own >> 64), _signed(own & MASK), _signed(above >> 64), _signed(above & MASK))
                + (depth + n, sizes[n - 1], before[n - 1], node.least, *node.weights)
            )
        if len(rows) >= 10_000:
            yield batch()
            rows.clear()
    if rows:
        yield batch()


def _tries(weights: list[str]):
    """Tries of the segments in a task, expanded: one row for each distinct prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = ZFastTrie()
        for batch in batches:
            columns = [batch[name].to_pylist() for name in ("conv_id", "base_a", "base_b", "base_bytes", "first", "ta", "tb", "sizes")]
            carried = zip(*(batch[name].to_pylist() for name in weights), strict=True)
            for (conv, base_a, base_b, base_bytes, first, ta, tb, sizes), own in zip(zip(*columns, strict=True), carried, strict=True):
                tags = [(a & MASK) << 64 | b & MASK for a, b in zip(ta, tb, strict=True)]
                path = list(accumulate(tags, xor, initial=(base_a & MASK) << 64 | base_b & MASK))
                before = list(accumulate(sizes, initial=base_bytes))
                trie.insert(path, (first, sizes, before), conv, own)
                if trie.size >= TRIE_TURNS:
                    yield from _expanded(trie, len(weights))
                    trie = ZFastTrie()
        yield from _expanded(trie, len(weights))

    return run


def digested(conversations: DataFrame) -> DataFrame:
    """conv_id, place (0, 1, ...), two digests of role and text, and the text's bytes.

    Turns are ordered by turn, nulls first, then role and text; a null role or text
    is empty; a repeated row is a turn of its own; rows without a conversation id
    are left out. Rows are dealt out by ranges of that order and counted in each
    range, so a conversation with a large part of all rows is spread over tasks.
    """
    role, text = (F.coalesce(F.col(name), F.lit("")).alias(name) for name in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long"), "turn", role, text)
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role")]
    dealt = rows.repartitionByRange(*order, F.substring("text", 1, TIE_LETTERS))
    placed = dealt.sortWithinPartitions(*order, "text").select(
        "conv_id",
        F.monotonically_increasing_id().alias("row"),
        F.xxhash64("role", "text").alias("da"),
        F.xxhash64(F.lit("second"), F.length("text"), "text", "role").alias("db"),
        F.octet_length("text").cast("long").alias("bytes"),
    )
    turns = written(placed, "turns").withColumn("part", F.shiftright("row", 33))
    parts = turns.groupBy("conv_id", "part").agg(F.min("row").alias("start"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("conv_id", "part", (F.col("start") - F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("start"))
    places = turns.join(starts, ["conv_id", "part"])
    return places.select("conv_id", (F.col("row") - F.col("start")).alias("place"), "da", "db", "bytes")


class Dialogues(NamedTuple):
    """``turns`` as ``digested`` gives them, and ``ids``: every conv_id, also of
    conversations without turns."""

    turns: DataFrame
    ids: DataFrame


def with_shared_beginnings(turns: DataFrame, every: int = 5, most: int = 9) -> Dialogues:
    """Every conversation c with the first h turns of conversation c - c % every, all
    if it has fewer, in place of its own first h; h is crc32(c as text) % most."""
    counts = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    leader = (F.col("conv_id") - F.col("conv_id") % every).alias("leader")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h")
    members = counts.select("conv_id", leader, h)
    sizes = counts.select(F.col("conv_id").alias("leader"), F.col("n").alias("n_leader"))
    taken = F.least("h", F.coalesce("n_leader", F.lit(0)))
    members = members.join(sizes, "leader", "left").withColumn("taken", taken)
    members = written(members.select("conv_id", "leader", "h", "taken"), "members")
    beginnings = turns.where(F.col("place") < most - 1).withColumnRenamed("conv_id", "leader")
    borrowed = members.join(beginnings, "leader").where("place < taken")
    own = turns.join(members, "conv_id").where("place >= h").withColumn("place", F.col("place") - F.col("h") + F.col("taken"))
    columns = ["conv_id", "place", "da", "db", "bytes"]
    return Dialogues(own.select(*columns).union(borrowed.select(*columns)), members.select("conv_id"))


def _segments(turns: DataFrame) -> DataFrame:
    """Conversations in segments of turns with the fingerprint of all before them.

    A turn's tag is a hash of its place and digest, in two halves; the fingerprint
    of a prefix is the exclusive or of its tags, 128 bits.
    """
    place = F.col("place")
    tagged = turns.select(
        "conv_id",
        F.floor(place / SEGMENT).alias("layer"),
        F.struct(
            place,
            F.xxhash64("place", "da").alias("ta"),
            F.xxhash64("db", F.lit("second"), "place").alias("tb"),
            "bytes",
        ).alias("turn"),
    )
    layers = tagged.groupBy("conv_id", "layer").agg(
        F.array_sort(F.collect_list("turn")).alias("turns"),
        F.bit_xor("turn.ta").alias("xa"),
        F.bit_xor("turn.tb").alias("xb"),
        F.sum("turn.bytes").alias("n_bytes"),
    )
    whole = Window.partitionBy("conv_id")
    earlier = whole.orderBy("layer").rowsBetween(Window.unboundedPreceding, -1)

    def before(total: Column) -> Column:
        return F.coalesce(total.over(earlier), F.lit(0).cast("long"))

    segments = layers.select(
        "conv_id",
        "layer",
        (F.col("layer") * SEGMENT).alias("first"),
        before(F.bit_xor("xa")).alias("base_a"),
        before(F.bit_xor("xb")).alias("base_b"),
        before(F.sum("n_bytes")).alias("base_bytes"),
        F.sum("n_bytes").over(whole).alias("total"),
        F.bit_xor("xa").over(whole).alias("end_a"),
        F.bit_xor("xb").over(whole).alias("end_b"),
        *(F.col(f"turns.{old}").alias(new) for old, new in (("ta", "ta"), ("tb", "tb"), ("bytes", "sizes"))),
    )
    return written(segments, "segments")


def _insert_all(segments: DataFrame, *weights: str) -> DataFrame:
    """Every distinct prefix with its smallest member and its sums of weights.

    Segments are dealt out by their first turns, so that common prefixes meet in
    one task's trie; a beginning that many share is spread by conversation.
    """
    near = [F.get("ta", F.lit(i)) for i in range(3)]
    dealt = segments.repartitionByRange("layer", "base_a", *near, "conv_id")
    names = ["fa", "fb", "pa", "pb", "depth", "bytes", "before", "least"]
    schema = ", ".join(f"{name} long" for name in [*names, *(f"w{i}" for i in range(len(weights)))])
    parts = map_batches(dealt, _tries(list(weights)), schema)
    fixed = [F.min(name).alias(name) for name in names[2:]]  # alike in all rows of a prefix, but for least
    return parts.groupBy(*KEY).agg(*fixed, *(F.sum(f"w{i}").alias(name) for i, name in enumerate(weights)))


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (fa, fb, conv_id) rows as pieces of comma-joined ids."""
    now, ids = None, []
    rows: list[tuple] = []

    def batch() -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["fa", "fb", "first", "ids"]
        )

    for part in batches:
        for *node, conv in zip(*(part[name].to_pylist() for name in ("fa", "fb", "conv_id")), strict=True):
            if node != now or len(ids) == IDS_TOGETHER:
                if ids:
                    rows.append((*now, ids[0], ",".join(map(str, ids))))
                now, ids = node, []
                if len(rows) >= 1000:
                    yield batch()
                    rows.clear()
            ids.append(conv)
    if ids:
        rows.append((*now, ids[0], ",".join(map(str, ids))))
        yield batch()


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces of a node's ids as one digest for each node."""
    now, digest, rows = None, None, []
    names, types = ["fa", "fb", "ends_sha256"], (pa.int64(), pa.int64(), pa.string())

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    for part in batches:
        for *node, text in zip(*(part[name].to_pylist() for name in ("fa", "fb", "ids")), strict=True):
            if node == now:
                digest.update(b",")
            else:
                if now:
                    rows.append((*now, digest.hexdigest()))
                now, digest = node, sha256()
                if len(rows) >= 10_000:
                    yield batch()
                    rows.clear()
            digest.update(text.encode())
    if now:
        rows.append((*now, digest.hexdigest()))
        yield batch()


def end_digests(ends: DataFrame) -> DataFrame:
    """For each node (fa, fb) the SHA-256 of its conv_ids, ascending, comma-joined.

    Ids are joined in pieces by ranges of (node, id); then a node's pieces pass by
    in order, so a node at which very many conversations end is never held whole.
    """
    pieces = ends.repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    pieces = written(map_batches(pieces, _joined_ids, "fa long, fb long, first long, ids string"), "ends")
    passing = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return map_batches(passing, _hashed_ids, "fa long, fb long, ends_sha256 string")


class Trie(NamedTuple):
    """``nodes``: see ``prefix_trie``. ``ends``: conv_id with the fa, fb of its node."""

    nodes: DataFrame
    ends: DataFrame


def prefix_trie(dialogues: Dialogues) -> Trie:
    """All distinct beginnings of conversations, from the textless root.

    Columns of the nodes: fa, fb (the node's fingerprint), conv_id (smallest member),
    depth, parent_conv_id (null at the root), n_convs (members: conversations that
    begin so), n_children, n_leaves (nodes without children in the subtree, the top
    included) and saved_tokens (summed over the subtree, the members but one times
    the bytes of the node's last text).

    Each task inserts its segments into z-fast tries and writes their expanded edges,
    one row for each prefix it has seen however many conversations share it; equal
    prefixes of all tasks are then added up. A node's smallest member owns it, which
    gives each conversation the end of its path; a second pass adds up what the owners
    hold in each subtree. Rows are linear in the turns, whatever the depth.

    Nodes are told apart by 128 bits. A conversation without turns ends at the root;
    without conversations there is no root and no row.
    """
    segments = _segments(dialogues.turns)
    ids = dialogues.ids
    nodes = written(_insert_all(segments.withColumn("members", F.lit(1)), "members", "total"), "prefixes")
    children = nodes.groupBy(F.col("pa").alias("fa"), F.col("pb").alias("fb")).agg(F.count("*").alias("n_children"))
    nodes = written(nodes.join(children, KEY, "left").fillna(0, ["n_children"]), "nodes")
    held = nodes.groupBy(F.col("least").alias("conv_id")).agg(
        F.sum("bytes").alias("own"),
        F.sum((F.col("n_children") == 0).cast("long")).alias("leaf"),
        F.min("before").alias("own_from"),
    )
    held = written(held, "owners")
    below = _insert_all(segments.join(held, "conv_id"), "own", "leaf").select(*KEY, "own", "leaf")
    whole = nodes.join(below, KEY).join(held.select(F.col("conv_id").alias("least"), "own_from"), "least")
    # Bytes of all members from here on, less those of the distinct turns: what the
    # owners hold, without the part of this node's owner above it.
    beyond = F.col("total") - F.col("members") * F.col("before")
    distinct = F.col("own") - (F.col("before") - F.col("own_from"))
    least = F.col("least").alias("conv_id")
    rows = whole.select(*KEY, "pa", "pb", least, "depth", "members", "n_children", "leaf", (beyond - distinct).alias("saved"))
    zero = F.lit(0).cast("long")
    figures = [
        ids.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("members")),
        segments.where("layer = 0").agg(F.sum("total").alias("total")),
        held.agg(F.sum("own").alias("own"), F.sum("leaf").alias("leaf")),
        nodes.where("depth = 1").agg(F.count("*").alias("n_children")),
    ]
    figures = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), figures)
    root = figures.agg(*(F.max(name).alias(name) for name in figures.columns)).where("members > 0")
    root = root.select(
        *(zero.alias(name) for name in ("fa", "fb", "pa", "pb")),
        "conv_id",
        zero.alias("depth"),
        "members",
        "n_children",
        F.when(F.col("n_children") == 0, 1).otherwise(F.col("leaf")).alias("leaf"),
        (F.coalesce("total", zero) - F.coalesce("own", zero)).alias("saved"),
    )
    rows = written(rows.union(root), "trie")
    above = rows.select(F.col("fa").alias("pa"), F.col("fb").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    linked = rows.where("depth > 0").join(above, ["pa", "pb"])
    linked = linked.unionByName(rows.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")))
    result = linked.select(
        *KEY,
        "conv_id",
        "depth",
        "parent_conv_id",
        F.col("members").alias("n_convs"),
        "n_children",
        F.col("leaf").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
    )
    last = segments.where("layer = 0").select("conv_id", F.col("end_a").alias("fa"), F.col("end_b").alias("fb"))
    ends = ids.join(last, "conv_id", "left").fillna(0, KEY)
    return Trie(result, ends)


def node_texts(nodes: DataFrame, dialogues: Dialogues, conversations: DataFrame) -> DataFrame:
    """The nodes below the root with the role and text of their last turn."""
    role, text = (F.coalesce(F.col(name), F.lit("")).alias(name) for name in ("role", "text"))
    texts = conversations.select(role, text).select(
        F.xxhash64("role", "text").alias("da"),
        F.xxhash64(F.lit("second"), F.length("text"), "text", "role").alias("db"),
        "role",
        "text",
    )
    turns = dialogues.turns.select("conv_id", (F.col("place") + 1).alias("depth"), "da", "db")
    return nodes.join(turns, ["conv_id", "depth"]).join(texts.dropDuplicates(["da", "db"]), ["da", "db"])
