import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import quality
from millrace.llm.quality import BUCKETS, PLACES, SIGNS, SIZE, WINDOW, add_contexts, buckets, fit, pooled, train, word_vectors

WORDS = [f"{a}{b}" for a in ("ther", "an", "lin", "ka", "sel") for b in ("um", "bra", "ve", "qua", "fen", "")]


def test_contexts_equal_brute_force():
    texts = [buckets(t) for t in ("a b c a b", "", "x", "a !! b !! c", "b " * 30)]
    sums = np.zeros((BUCKETS + 1, SIZE))
    add_contexts(sums, texts)
    expected = np.zeros((BUCKETS + 1, SIZE))
    for row in texts:
        for i, own in enumerate(row):
            for j in range(max(0, i - WINDOW), min(len(row), i + WINDOW + 1)):
                if j != i:
                    for place, sign in zip(PLACES[row[j]], SIGNS[row[j]], strict=True):
                        expected[own, place] += sign
    assert (sums[:BUCKETS] == expected[:BUCKETS]).all()


def test_vectors_do_not_depend_on_partitions(documents):
    rng = random.Random(1)
    docs = documents(*((i, " ".join(rng.choice(WORDS) for _ in range(30))) for i in range(200)), (None, None))
    one, many = word_vectors(docs.repartition(1)), word_vectors(docs.repartition(23))
    assert np.array_equal(one, many)
    norms = np.linalg.norm(one, axis=1)
    assert np.allclose(norms[norms > 0], 1, atol=1e-5) and (norms > 0).sum() > 20


def test_memory_stays_bounded(monkeypatch):
    before = [buckets(t).tolist() for t in ("a b c", "d e f g", "a d")]
    monkeypatch.setattr(quality, "CACHED_TOKENS", 3)
    assert [buckets(t).tolist() for t in ("a b c", "d e f g", "a d")] == before


def test_pooling():
    vectors = np.random.default_rng(0).normal(size=(BUCKETS, SIZE)).astype(np.float32)
    text = "a b !! a " * 9000
    rows = vectors[buckets(text)].astype(float)
    alike = np.einsum("ij,ij->i", rows[1:], rows[:-1]).mean()
    assert np.allclose(pooled(text, vectors), [*rows.mean(axis=0), *rows.std(axis=0), alike], atol=1e-3)
    assert not pooled(None, vectors).any() and not pooled(" \n", vectors).any()


def _corpus(rng, n):
    rows = []
    for i in range(n):
        words = [rng.choice(WORDS) for _ in range(rng.randrange(10, 80))]
        good = i % 4 != 0
        if not good:
            kind = i % 3
            words = [w.upper() + "!!" for w in words] if kind == 0 else [w + rng.choice(["***", "%%%", "$$$"]) for w in words] if kind == 1 else [f"{w} |" for w in words]
        rows.append((i, " ".join(words), int(good)))
    return rows


def test_held_out_accuracy_and_odd_rows(documents, labels):
    rows = _corpus(random.Random(4), 600)
    docs = documents(*((i, text) for i, text, _ in rows), (900, None), (901, ""), (None, "ther um"), (902, "ther " * 60_000), (0, rows[0][1]))
    docs = docs.withColumn("label", F.lit("own"))
    model = fit(docs, labels(*((i, good, 0) for i, _, good in rows), (None, 1, 1), (3, None, None), (4, 9, 0)))
    found = docs.select("doc_id", model.score(F.col("text")).alias("p")).collect()
    assert len(found) == len(rows) + 5 and all(0 <= row.p <= 1 for row in found)
    chance = {row.doc_id: row.p for row in found}
    assert np.mean([(chance[i] >= 0.3) == bool(good) for i, _, good in rows]) > 0.97
    assert chance[900] == chance[901]


def test_temperature_softens_a_network_that_is_too_sure():
    random_ = np.random.default_rng(3)
    inputs = random_.normal(size=(400, 30))
    noisy = ((inputs[:, 0] + random_.normal(size=400) * 2) > 0).astype(int)
    network = train(inputs, noisy)
    assert network.temperature > 1


@pytest.mark.parametrize("known", [[], [(1, 1, 0), (2, 1, 0)], [(1, 0, 0)]])
def test_too_few_labels(documents, labels, known):
    docs = documents((1, "a text"), (2, None), (3, "b"))
    model = fit(docs, labels(*known))
    scores = [row.p for row in docs.select(model.score(F.col("text")).alias("p")).collect()]
    assert len(set(scores)) == 1 and 0 < scores[0] < 1


def test_empty_table(documents, labels):
    docs = documents()
    assert docs.select(fit(docs, labels((1, 1, 1))).score(F.col("text"))).count() == 0
