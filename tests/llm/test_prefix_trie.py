import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import prefix_trie
from millrace.llm.prefix_trie import ZFastTrie, two_fattest

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def rebuilt(rows, every=5, most=9):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {conv: [t[2:] for t in sorted(turns)] for conv, turns in own.items()}
    hs = {conv: zlib.crc32(str(conv).encode()) % most for conv in own}
    return {conv: own.get(conv - int(conv % every if conv >= 0 else -(-conv % every)), [])[: hs[conv]] + turns[hs[conv] :] for conv, turns in own.items()}


def brute(paths):
    members = defaultdict(list)
    for conv, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(conv)
    found = []
    for node, convs in members.items():
        below = [other for other in members if other[: len(node)] == node]
        childless = [o for o in below if not any(len(p) == len(o) + 1 and p[: len(o)] == o for p in below)]
        ends = sorted(c for c in convs if len(paths[c]) == len(node))
        found.append(
            (
                min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                sum(len(o) == len(node) + 1 for o in below), len(childless),
                sum((len(members[o]) - 1) * len(o[-1][1].encode()) for o in below if o),
                sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(found, key=str)


def found(dialogues):
    trie = prefix_trie.prefix_trie(dialogues)
    nodes = trie.nodes.join(prefix_trie.end_digests(trie.ends), prefix_trie.KEY, "left")
    none = sha256(b"").hexdigest()
    rows = [tuple(row[name] for name in COLUMNS) for row in nodes.fillna(none, ["ends_sha256"]).collect()]
    return sorted(rows, key=str)


ROWS = [
    *[(c, t, "user" if t % 2 else "bot", f"turn {t} of {c % 3}") for c in range(12) for t in range(c % 7)],
    *[(c, t, "user", "same") for c in range(40, 60) for t in range(3)],
    (100, None, "user", "no turn"), (100, 2, None, None), (100, 2, "user", "tie b"), (100, 2, "user", "tie a"), (100, 2, "user", "tie a"), (100, -3, "bot", "é 漢字"),
    (None, 1, "user", "no id"), (103, 0, "user", "x" * 100_000), (104, 0, "user", "x" * 100_000), (104, 1, "user", ""), (-7, 0, "user", "below zero"), (-5, 0, "user", "leads"),
]


@pytest.mark.parametrize("segment, turns", [(1024, 400_000), (2, 3)])
def test_equals_brute_force(spark, monkeypatch, segment, turns):
    monkeypatch.setattr(prefix_trie, "SEGMENT", segment)
    monkeypatch.setattr(prefix_trie, "TRIE_TURNS", turns)
    monkeypatch.setattr(prefix_trie, "IDS_TOGETHER", 3)
    rows = ROWS + [(200, t, "user", f"long {t % 50}") for t in range(120)] + [(201, t, "user", f"long {t % 50}") for t in range(90)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({"fa": F.lit("own"), "place": F.lit(1), "depth": F.lit(2)})
    dialogues = prefix_trie.with_shared_beginnings(prefix_trie.digested(frame))
    assert found(dialogues) == brute(rebuilt(rows))


def test_plain_conversations(spark):
    turns = prefix_trie.digested(spark.createDataFrame(ROWS, SCHEMA))
    dialogues = prefix_trie.Dialogues(turns, turns.select("conv_id").distinct())
    assert found(dialogues) == brute(rebuilt(ROWS, most=1))


def test_a_conversation_over_several_ranges(spark):
    rows = [(1, t, "user", f"t{t}") for t in range(3000)] + [(2, t, "user", f"t{t}") for t in range(1500)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = prefix_trie.digested(spark.createDataFrame(rows, SCHEMA).repartition(7))
        nodes = prefix_trie.prefix_trie(prefix_trie.Dialogues(turns, turns.select("conv_id").distinct())).nodes
        counts = {(r.n_convs, r.conv_id): r["count"] for r in nodes.groupBy("n_convs", "conv_id").count().collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert counts == {(2, 1): 1501, (1, 1): 1500}


def test_node_texts(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "bot", "b"), (2, 0, "user", "a"), (2, 1, "bot", "c")], SCHEMA)
    turns = prefix_trie.digested(frame)
    dialogues = prefix_trie.Dialogues(turns, turns.select("conv_id").distinct())
    nodes = prefix_trie.node_texts(prefix_trie.prefix_trie(dialogues).nodes, dialogues, frame)
    assert sorted((r.conv_id, r.depth, r.role, r.text) for r in nodes.collect()) == [(1, 1, "user", "a"), (1, 2, "bot", "b"), (2, 2, "bot", "c")]


def test_empty_table(spark):
    turns = prefix_trie.digested(spark.createDataFrame([], SCHEMA))
    dialogues = prefix_trie.with_shared_beginnings(turns)
    assert found(dialogues) == []


def test_two_fattest():
    for a in range(40):
        for b in range(a + 1, 41):
            assert two_fattest(a, b) == max(range(a + 1, b + 1), key=lambda n: n & -n)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=12), min_size=1, max_size=25))
def test_trie_in_memory_equals_all_prefixes(sequences):
    trie, seen = ZFastTrie(), defaultdict(list)
    for member, items in enumerate(sequences):
        path = [hash(("", *items[:n])) for n in range(len(items) + 1)]
        trie.insert(path, None, member, (1, len(items)))
        for n, fingerprint in enumerate(path):
            seen[fingerprint].append(member)
    rows = {}
    for node in trie.totals():
        for n in range(node.start + 1, node.end + 1):
            assert node.path[n] not in rows
            rows[node.path[n]] = (node.least, *node.weights)
    root = hash(("",))
    assert rows == {f: (min(m), len(m), sum(len(sequences[i]) for i in m)) for f, m in seen.items() if f != root}
