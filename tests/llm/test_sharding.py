import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm import sharding
from millrace.llm.sharding import assign_shards, jump_shard


def jump(key, shards):
    """The published algorithm, on unsigned 64-bit integers."""
    key, at, to = key % 2**64, -1, 0
    while to < shards:
        at = to
        key = (key * 2862933555777941757 + 1) % 2**64
        to = int((at + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return at


@pytest.mark.parametrize("shards", [1, 2, 24, 25, 100])
def test_equals_the_published_algorithm(spark, shards):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), 10863919174838991, 256, *range(-300, 300, 7), *(k * 7919**4 % 2**63 for k in range(300))]
    frame = spark.createDataFrame([(k,) for k in keys], "k long")
    found = {row.k: row.s for row in frame.select("k", jump_shard(F.col("k"), shards).alias("s")).collect()}
    assert found == {k: jump(k, shards) for k in keys}


def test_plan_has_no_python(spark, documents, capsys):
    assign_shards(documents((1, "a"))).explain("formatted")
    plan = capsys.readouterr().out
    assert "== Physical Plan ==" in plan and not any(node in plan for node in ("EvalPython", "InArrow", "InPandas"))


@pytest.mark.parametrize("slot_rows", [3, 50_000])
def test_sizes_slots_and_growth(documents, spark, monkeypatch, slot_rows):
    monkeypatch.setattr(sharding, "SLOT_ROWS", slot_rows)
    rows = [(i, f"text é {i % 50}") for i in range(700)] + [(5, None), (None, "no id"), (None, None), (6, "")] + [(7, "hot")] * 300
    frame = documents(*rows).repartition(5).withColumn("shard", F.lit("own")).withColumn("range", F.lit(0))
    found = assign_shards(frame).collect()
    assert len(found) == len(rows)
    expected = sorted(
        ((i, len((text or "").encode()) + 8, zlib.crc32((text or "").encode())) for i, text in rows), key=str
    )
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in found), key=str) == expected
    slots = defaultdict(list)
    shard_of = defaultdict(set)
    for row in found:
        assert row.law == "key" and 0 <= row.shard < 24 and row.grown_shard in (row.shard, 24)
        slots[row.shard].append(row.slot)
        shard_of[row.doc_id].add((row.shard, row.grown_shard))
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    assert all(len(places) == 1 for places in shard_of.values())
    grown = [row for row in found if row.grown_shard == 24 and row.doc_id != 7]
    assert 0 < len(grown) < 0.12 * 700


def test_empty_table(documents):
    assert assign_shards(documents()).count() == 0
