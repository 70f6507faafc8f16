import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import vectors
from millrace.llm.graphs import Graph, audited_beam
from millrace.llm.vectors import near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def _unit(x):
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def _clusters(random, n, size=32, spread=0.05):
    centres = random.normal(size=(n // 12 + 1, size))
    return centres[random.integers(0, len(centres), n)] + random.normal(size=(n, size)) * spread * random.choice([0.5, 1, 4], (n, 1))


def test_graph_recall_and_round_trip():
    random = np.random.default_rng(1)
    units = _unit(_clusters(random, 1500))
    graph = Graph.from_bytes(Graph.build(units).to_bytes())
    beam = audited_beam(graph, 0.93, 64, 256, 0.995)
    assert beam
    found = np.zeros((len(units), len(units)), bool)
    for rows, ids, sims in graph.above(units, 0.93, beam):
        assert np.allclose(sims, np.einsum("ij,ij->i", units[rows], units[ids]), atol=1e-5)
        found[rows, ids] = True
    truth = units @ units.T >= 0.93
    assert (found & truth).sum() >= 0.99 * truth.sum()


def test_beams_widen_for_large_clusters():
    random = np.random.default_rng(2)
    units = _unit(np.concatenate([np.ones((400, 16)) + random.normal(size=(400, 16)) * 0.02, random.normal(size=(300, 16))]))
    graph = Graph.build(units)
    counts = np.zeros(len(units), int)
    for rows, _, _ in graph.above(units, 0.93, 16):
        np.add.at(counts, rows, 1)
    truth = (units @ units.T >= 0.93).sum(axis=1)
    assert counts.sum() >= 0.995 * truth.sum()


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_tiny_graphs(n):
    units = _unit(np.random.default_rng(n).normal(size=(n, 8))) if n else np.zeros((0, 8), np.float32)
    if n:
        graph = Graph.build(units)
        ids, sims = graph.search(units, min(4, n))
        assert ids[:, 0].tolist() == list(range(n)) and np.allclose(sims[:, 0], 1, atol=1e-5)


def brute(rows, least=0.93):
    usable = [e is not None and len(e) > 0 and label is not None and i is not None and all(x is not None and np.isfinite(x) for x in e) and any(e) for i, e, label in rows]
    n = len(rows)
    near = np.zeros((n, n), bool)
    for a in range(n):
        for b in range(a):
            if usable[a] and usable[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], np.float32).astype(float), np.array(rows[b][1], np.float32).astype(float)
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                near[a, b] = near[b, a] = x @ y / np.sqrt((x @ x) * (y @ y)) >= least
    component = [row[0] for row in rows]
    while True:
        new = [min([component[a], *(component[b] for b in np.flatnonzero(near[a]))], key=lambda c: (c is None, c)) for a in range(n)]
        if new == component:
            break
        component = new
    return [(rows[a][0], int(near[a].sum()), component[a], rows[a][0] is not None and rows[a][0] == component[a]) for a in range(n)]


def _table(random):
    points = _clusters(random, 260, 16)
    rows = [(int(i) * 3, points[i].astype(np.float32).tolist(), int(i % 3)) for i in range(len(points))]
    copies = [(2000 + k, rows[10][1], rows[10][2]) for k in range(40)]
    nan, inf = float("nan"), float("inf")
    odd = [
        (3000, None, 1), (3001, [], 1), (3002, [0.0] * 16, 1), (3003, [nan] + [1.0] * 15, 1), (3004, [inf] + [1.0] * 15, 1), (3005, [None] + [1.0] * 15, 1),
        (3006, rows[4][1], None), (None, rows[4][1], 1), (3007, rows[4][1][:8], 1), (3008, [2 * x for x in rows[4][1][:8]], 1), (3009, [1e-30 * x for x in rows[7][1]], rows[7][2]),
        (3010, [1e30 * x for x in rows[7][1]], rows[7][2]), (3011, [-0.0, 1.0] + [0.0] * 14, 2), (3012, [0.0, 1.0] + [0.0] * 14, 2), (0, rows[0][1], rows[0][2]),
    ]
    return rows + copies + odd


@pytest.mark.parametrize("shard", [8192, 40])
def test_equals_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(vectors, "SHARD", shard)
    rows = _table(np.random.default_rng(4))
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit("own")).withColumn("n_links", F.lit(-1))
    found = [tuple(row) for row in near_vectors(frame).collect()]
    assert sorted(found, key=str) == sorted(brute(rows), key=str)


def test_unreachable_nodes_are_compared_exactly(spark, monkeypatch):
    monkeypatch.setattr(vectors, "audited_beam", lambda *_: 0)
    rows = _table(np.random.default_rng(5))[:120]
    found = [tuple(row) for row in near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(found, key=str) == sorted(brute(rows), key=str)


def test_empty_table(spark):
    assert near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    only = near_vectors(spark.createDataFrame([(1, None, 1), (None, None, None)], SCHEMA)).collect()
    assert sorted(map(tuple, only), key=str) == [(1, 0, 1, True), (None, 0, None, False)]
