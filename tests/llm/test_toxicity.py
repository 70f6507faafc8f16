import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import toxicity
from millrace.llm.toxicity import DECAY, Landmarks, Machine, Scorer, fit, train, words_of

INSULTS = ["idiot", "moron", "stupid"]
SYLLABLES = ["ther", "an", "lin", "ka", "sel", "um", "bra", "ve", "qua", "fen"]


def _features(word):
    found = {}
    for places in combinations(range(len(word)), 3):
        key = tuple(word[i] for i in places)
        found[key] = found.get(key, 0.0) + DECAY ** (places[-1] - places[0] + 1)
    return found


def _kernel(a, b):
    a, b = _features(a), _features(b)
    norms = [sum(v * v for v in x.values()) ** 0.5 for x in (a, b)]
    return sum(v * b.get(k, 0.0) for k, v in a.items()) / (norms[0] * norms[1]) if all(norms) else 0.0


def test_kernel_equals_its_features():
    rng = random.Random(1)
    words = ["".join(rng.choice("idotmrn") for _ in range(rng.randrange(3, 11))) for _ in range(300)]
    words += ["idiot", "idxiot", "mooron", "réeuxñ", "ab", ""]
    marks = ["idiot", "moron$", "trim", "réeux"]
    known = Landmarks(marks)
    found = known.kernel(words, known.weights)
    for i, word in enumerate(words):
        for k, mark in enumerate(marks):
            assert found[i, k] == pytest.approx(_kernel(word, mark), abs=1e-5)


def test_many_letters_are_searched_in_a_list(monkeypatch):
    words, marks = ["idiot", "moron", "xidxiotx"], ["idiot", "moron", "été"]
    dense = Landmarks(marks)
    monkeypatch.setattr(toxicity, "DENSE", 0)
    sparse = Landmarks(marks)
    assert dense.places is not None and sparse.places is None
    assert np.allclose(dense.similarities(words), sparse.similarities(words))


def test_nothing_is_cut_off():
    near = ["idxixot", "stxuxpid", "lxosxer", "whataclown", "ixdxixoxt"]
    marks = ["idiot", "stupid", "loser", "clown", "idiot"]
    for word, mark in zip(near, marks, strict=True):
        whole = _kernel(word + "$", mark)
        assert Landmarks([mark]).similarities([word])[0, 0] >= whole - 1e-6 > 0
    assert not Landmarks(["idiot"]).similarities(["xyz", "it", ""]).any()


def test_words():
    assert words_of("I.D.I.O.T you i d i o t! s-t-u-p-i-d  1d10t") == ["idiot", "you", "i", "d", "i", "o", "t", "stupid", "dt", "idiot"]
    assert words_of(None) == words_of(" \n") == words_of("123 !!") == []
    assert words_of("ÉTÉ a b") == ["été", "a", "b"]


def test_long_words_are_compared_in_windows():
    found = Landmarks(["idiot"]).similarities(["thelongeverlasting" + "idiot" + "andevenlonger", "x" * 100, "lasting" * 1000 + "idiot"])
    assert (found[[0, 2], 0] > 0.5).all() and not found[1].any()


def test_a_margin_is_that_of_the_kernel_rows():
    rng = np.random.default_rng(3)
    machine = Machine(["idiot", "moron"], np.eye(2), rng.normal(size=2), 0.3, 1.0, 0.0)
    words = ["idiot", "moron", "idxiot", "ocean", "it"]
    rows = Landmarks(machine.landmarks).similarities(words)
    assert np.allclose(Scorer(machine).margins(words), rows @ machine.weights + 0.3, atol=1e-5)


def test_memory_of_words_stays_bounded(monkeypatch):
    machine = Machine(["idiot", "moron"], np.eye(2), np.ones(2), 0.0, 1.0, 0.0)
    texts = ["a lot of idiot words", "another set moron words", "idiot moron idiot", None, ""] * 300
    whole = list(Scorer(machine).each(texts))
    monkeypatch.setattr(toxicity, "CACHED_WORDS", 4)
    assert list(Scorer(machine).each(texts)) == whole


def _corpus(rng, n):
    rows = []
    for i in range(n):
        words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(5, 60))]
        toxic = i % 4 == 0
        if toxic:
            word = rng.choice(INSULTS)
            if rng.random() < 0.3:
                at = rng.randrange(1, len(word))
                word = word[:at] + rng.choice(["-", ".", word[at], "x"]) + word[at:]
            words.insert(rng.randrange(len(words)), word)
        rows.append((i, " ".join(words) + ".", int(toxic)))
    return rows


def test_held_out_accuracy_and_odd_rows(documents, labels):
    rows = _corpus(random.Random(4), 500)
    docs = documents(*((i, text) for i, text, _ in rows), (900, None), (901, ""), (None, "you idiot"), (902, "fine " * 50_000 + "idiot"), (0, rows[0][1]))
    docs = docs.withColumn("score", F.lit("own"))
    model = fit(docs, labels(*((i, 1, toxic) for i, _, toxic in rows), (None, 1, 1), (3, None, None), (4, 0, 7)))
    assert {"idiot", "moron", "stupid"} <= set(model.machine.landmarks)
    found = docs.select("doc_id", model.score(F.col("text")).alias("p")).collect()
    assert len(found) == len(rows) + 5 and all(0 <= row.p <= 1 for row in found)
    chance = {row.doc_id: row.p for row in found}
    right = [(chance[i] >= 0.5) == bool(toxic) for i, _, toxic in rows]
    assert np.mean(right) > 0.97
    assert chance[900] == chance[901] < 0.5
    assert chance[None] >= 0.5 and chance[902] >= 0.5


def test_altered_insults_are_predicted(documents, labels):
    rows = _corpus(random.Random(4), 500)
    model = fit(documents(*((i, text) for i, text, _ in rows)), labels(*((i, 1, toxic) for i, _, toxic in rows)))
    scorer, machine = Scorer(model.machine), model.machine

    def toxic(words):
        texts = [f"ther anlin {word} bra umsel." for word in words]
        return np.mean([machine.probability(margin) >= 0.5 for margin in scorer.each(texts)])

    inserted = [w[:i] + c + w[i:] for w in INSULTS for i in range(1, len(w)) for c in "xz"]
    twice = [w[:i] + "x" + w[i:j] + "z" + w[j:] for w in INSULTS for i in range(1, len(w)) for j in range(i + 1, len(w))]
    assert toxic(INSULTS) == 1.0
    assert toxic(inserted) >= 0.9
    assert toxic(twice) >= 0.5
    assert toxic([f"what{w}like" for w in INSULTS]) == 1.0
    assert toxic(["-".join(w) for w in INSULTS] + [" ".join(w) for w in INSULTS]) == 1.0
    assert toxic(["".join(pair) for pair in zip(SYLLABLES, SYLLABLES[1:])]) == 0.0


def test_without_evidence_nothing_is_toxic(documents, labels):
    docs = documents((1, "a text"), (2, None), (3, "you idiot"))
    for known in (labels(), labels((1, 1, 0), (2, 1, 0)), labels((None, 1, 1)), labels((77, 1, 1))):
        model = fit(docs, known)
        assert all(0 < row.p < 0.5 for row in docs.select(model.score(F.col("text")).alias("p")).collect())
    model = fit(docs, labels((1, 1, 1), (2, 1, 1), (3, 1, 1)))
    assert all(0.5 < row.p < 1 for row in docs.select(model.score(F.col("text")).alias("p")).collect())
    empty = documents()
    assert empty.select(fit(empty, labels((1, 1, 1))).score(F.col("text"))).count() == 0


def test_labels_of_other_documents_take_no_place_in_the_sample(spark, documents, labels):
    from millrace.llm.shared import labelled_sample

    known = labels(*((i, 1, i % 2) for i in range(2000)))
    docs = documents(*((i, f"text {i}") for i in range(1500, 1600)))
    assert labelled_sample(docs, known, "toxic", 50).count() == 50


def test_training_on_ties():
    machine = train(["idiot"], [["idiot"], []] * 20, np.array([1, 0] * 20))
    chance = [machine.probability(margin) for margin in Scorer(machine).each(["idiot", "", "ocean"])]
    assert chance[0] > 0.8 and chance[1] < 0.2 and chance[2] < 0.5
