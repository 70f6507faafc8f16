import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import simhash
from millrace.llm.simhash import fingerprint, fingerprint_links, first_of_groups, near_duplicates


def _plain_fingerprint(spark, text, n=4):
    """With Spark's own XXH64 of strings, seed 42."""
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w]
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    if not shingles:
        return 0
    rows = spark.createDataFrame([(s,) for s in shingles], "s string").select(F.xxhash64("s").alias("h")).collect()
    hashes = [row.h % 2**64 for row in rows]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \t\n", "one", "One TWO three", "a b c d", "Ärger É a\x0bb\x0cc\rd e\x1cf\xa0g h", "x " * 30, "to be or not to be or not to be"])
def test_fingerprint(spark, text):
    assert fingerprint(text) == _plain_fingerprint(spark, text)


def _components(ids_and_prints, distance=4):
    n = len(ids_and_prints)
    top = list(range(n))

    def root(i):
        return i if top[i] == i else root(top[i])

    for i in range(n):
        for j in range(i):
            if (ids_and_prints[i][1] ^ ids_and_prints[j][1]).bit_count() <= distance:
                top[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(ids_and_prints):
        known = [x for x in (least.get(root(i)), doc_id) if x is not None]
        least[root(i)] = min(known) if known else None
    return [least[root(i)] for i in range(n)]


def _texts(rng):
    words = [f"w{i}" for i in range(300)]
    rows = []
    for doc_id in range(0, 400, 2):
        if rng.random() < 0.5 or not rows:
            own = [rng.choice(words) for _ in range(rng.randrange(1, 120))]
        else:
            own = rng.choice(rows)[1].split()
            for _ in range(rng.randrange(3)):
                own[rng.randrange(len(own))] = rng.choice(words)
        rows.append((doc_id, " ".join(own)))
    return rows


def test_equals_brute_force(documents):
    rng = random.Random(5)
    rows = [*_texts(rng), (900, None), (901, ""), (902, " "), (3, "w1 w2 w3"), (3, "w1 w2 w3"), (None, "w1 w2 w3"), (None, "quite alone here now")]
    rng.shuffle(rows)
    frame = documents(*rows).withColumn("print", F.lit("own")).withColumn("component_id", F.lit(-1))
    found = near_duplicates(frame).collect()
    prints = [(i, fingerprint(text)) for i, text in rows]
    expected = [(i, f"{p:016x}", c) for (i, p), c in zip(prints, _components(prints), strict=True)]
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    assert len({c for _, _, c in expected}) < 180


@pytest.mark.parametrize("chunk", [4, 4096])
def test_dense_prints_in_chunks(spark, chunk, monkeypatch):
    """Many prints close to one another, in buckets above and below the chunk size."""
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    rng = random.Random(7)
    prints = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(40):
            value = centre
            for _ in range(rng.randrange(7)):
                value ^= 1 << rng.randrange(64)
            prints.add(value)
    prints = sorted(prints)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(x,) for x in signed], "print long").repartition(3)
    links = [(u % 2**64, v % 2**64) for u, v in fingerprint_links(frame).collect()]
    assert all(0 < (u ^ v).bit_count() <= 4 for u, v in links)
    top = {p: p for p in prints}

    def root(p):
        return p if top[p] == p else root(top[p])

    for u, v in links:
        a, b = root(u), root(v)
        top[max(a, b)] = min(a, b)
    assert [root(p) for p in prints] == _components([(p, p) for p in prints])
    if chunk == 4096:
        assert len(links) <= 15 * len(prints)  # a forest in each of 15 tables, not all pairs


def test_one_of_each_group_stays(documents):
    rng = random.Random(6)
    rows = [*_texts(rng), (900, None), (901, ""), (2, "w7 w8 w9"), (2, "w7 w8 w9"), (None, "w7 w8 w9"), (None, "quite alone here now"), (None, "quite alone here now")]
    frame = documents(*rows).withColumn("row", F.lit("own"))
    kept = first_of_groups(frame)
    assert kept.columns == frame.columns
    prints = [(i, fingerprint(text)) for i, text in rows]
    groups = _components(prints)
    expected = sorted({c for c in groups if c is not None})
    found = [row.doc_id for row in kept.collect()]
    assert sorted({i for i in found if i is not None}) == expected
    assert found.count(2) == 2  # two unlike documents with one id
    assert found.count(None) == 1


def test_empty_table(documents):
    assert near_duplicates(documents()).count() == 0
    assert first_of_groups(documents()).count() == 0


def test_one_row_of_each_component_whatever_the_ids(spark, documents):
    """Unlike texts that share an id stay, and near copies without ids are one."""
    apart = [f"{w} " * 3 + " ".join(f"{w}{i}" for i in range(40)) for w in ("iron", "wood", "glass", "stone")]
    frame = documents((1, apart[0]), (1, apart[1]), (2, apart[2]), (None, apart[3]), (None, apart[3]), (None, apart[0]), (3, apart[2]))
    kept = sorted(((row.doc_id, row.text) for row in first_of_groups(frame).collect()), key=str)
    assert kept == sorted([(1, apart[0]), (1, apart[1]), (2, apart[2]), (None, apart[3])], key=str)
