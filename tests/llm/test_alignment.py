from collections import Counter, defaultdict
from hashlib import sha256

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import alignment
from millrace.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def brute():
    """The contract, word by word: every token pair of a text is looked at."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    odd = [i for i in range(256) if not (33 <= i <= 126 or 161 <= i <= 172 or 174 <= i <= 255)]
    letters = {chr(256 + odd.index(i)) if i in odd else chr(i): i for i in range(256)}

    def piece(i):
        name = b.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if b.is_byte(i) else name.replace("▁", " ").encode()

    def one(text):
        text = text or ""
        enc = a.encode(" " + text, add_special_tokens=False)
        a_ids, b_ids = enc.ids, b.encode(text)
        a_bytes = [bytes(letters[c] for c in token) for token in enc.tokens]
        b_bytes = [piece(i) for i in b_ids]
        if not text or not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            return [], [], [], []

        def ends(parts):
            return [sum(map(len, parts[: i + 1])) for i in range(len(parts))]

        a_ends, b_ends = ends(a_bytes), ends(b_bytes)
        cuts = [end for end in a_ends if end in b_ends]
        groups = [
            ([i for i, e in zip(a_ids, a_ends) if lo < e <= hi], [i for i, e in zip(b_ids, b_ends) if lo < e <= hi])
            for lo, hi in zip([0, *cuts], cuts)
        ]
        pairs = [
            (x, y)
            for x, xe, xb in zip(a_ids, a_ends, a_bytes)
            for y, ye, yb in zip(b_ids, b_ends, b_bytes)
            if xe - len(xb) < ye and ye - len(yb) < xe
        ]
        return a_ids, b_ids, groups, pairs

    def table(rows):
        done = [(i, *one(text)) for i, text in rows]
        counts = Counter(pair for *_, pairs in done for pair in set(pairs))
        highest = defaultdict(int)
        for (x, _), n in counts.items():
            highest[x] = max(highest[x], n)
        found = []
        for i, a_ids, b_ids, groups, pairs in done:
            text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
            digest = sha256(text.encode()).hexdigest() if a_ids else ""
            best = sum(counts[p] == highest[p[0]] for p in pairs)
            found.append((i, len(a_ids), len(b_ids), len(groups), len(pairs), digest, best, sum(counts[p] for p in pairs)))
        return sorted(found, key=str)

    return table


def rows_of(frame):
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")
    return sorted((tuple(row[name] for name in names) for row in frame.collect()), key=str)


TEXTS = [
    (1, "The cat sat on the mat."), (2, "The cat sat on the mat."), (3, None), (4, ""), (5, " "), (6, "a  b\n\nc\t d "), (7, "naïve Überraschung 漢字 🙂🙂"),
    (8, "<|endoftext|> <s> <unk> <0x41>"), (9, "▁marked"), (10, "fiﬁ   nbsp"), (None, "no id, the cat"), (None, None), (11, "x" * 500 + " the" * 300),
    (12, "don't can't 1234567 --- !!!"), (12, "the repeated id"), (13, "\x00 nul"), (14, "\r\n"), (15, "é combining"),
]


def test_equals_brute_force(spark, documents, brute):
    frame = documents(*TEXTS).repartition(3).withColumn("block", F.lit("own")).withColumn("pairs", F.lit(1))
    assert rows_of(alignment.align_corpus(frame, A, B).documents) == brute(TEXTS)


def test_blocks_change_nothing(spark, documents, brute, monkeypatch):
    monkeypatch.setattr(alignment, "TOGETHER", 2)
    monkeypatch.setattr(alignment, "BLOCK_WORDS", 5)
    assert rows_of(alignment.align_corpus(documents(*TEXTS).coalesce(1), A, B).documents) == brute(TEXTS)


def test_query_equals_brute_force(spark, brute):
    texts = [tuple(row) for row in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    few = [(i, text if text is None or len(text) < 1500 else None) for i, text in texts]
    short = spark.createDataFrame(few, "doc_id long, text string")
    assert rows_of(alignment.align_corpus(short, A, B).documents) == brute(few)
    found = QUERIES["op11_alignment"](spark, SMALL)
    assert {row.doc_id for row in found.collect()} == {i for i, _ in texts}


def test_words_equal_whole_texts(spark):
    """Cut at single spaces, texts have the tokens that they have as a whole."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(400).select("text").collect()
    odd = ["a b\u00a0 c", "x  y z", "it 's 'll", "1 2 ,3", "e\u0301 a", "\u2003 a b", "q\n r s\t t", "🙂 a 🙂", "\u200b a b", "ﬁ a ½ b"]
    texts = [row.text for row in rows] + odd
    aligner = alignment.Aligner(A, B)
    block = alignment._Block(aligner)
    n_a, n_b, n_groups, n_links, hashes, places, times = (column.to_pylist() for column in block.add(texts))
    pairs = list(block.pairs)
    for i, one in enumerate(aligner.align(texts)):
        digest = sha256(one.written().encode()).hexdigest() if one.a else ""
        assert (n_a[i], n_b[i], n_groups[i], n_links[i], hashes[i]) == (len(one.a), len(one.b), len(one.groups), len(one.pairs), digest)
        assert Counter(one.pairs) == {pairs[p]: n for p, n in zip(places[i], times[i])}


def test_pairs_are_those_of_the_corpus(spark, documents):
    pairs = alignment.align_corpus(documents((1, "the cat"), (2, "the the dog")), A, B).pairs.collect()
    assert Counter(row["count"] for row in pairs) == {2: 1, 1: 2} and all(row.best for row in pairs)


def test_documents_keep_ids_and_groups(spark, documents):
    row = alignment.align_documents(documents((1, "naïve cats"), (2, None)), A, B).where("doc_id = 1").first()
    covered = [(g.a_start, g.a_end) for g in row.groups]
    assert covered[0][0] == 0 and covered[-1][1] == len(row.a_ids)
    assert all(x[1] == y[0] for x, y in zip(covered, covered[1:]))


def test_empty_table(spark, documents):
    found = alignment.align_corpus(documents(), A, B)
    assert found.documents.count() == 0 and found.pairs.count() == 0


ENDS = st.lists(st.integers(1, 4), min_size=1, max_size=12)


@settings(max_examples=200, deadline=None)
@given(ENDS, ENDS)
def test_groups_and_links_equal_all_overlaps(a, b):
    from itertools import accumulate

    b = b + [max(0, sum(a) - sum(b))] if sum(b) < sum(a) else b
    a = a + [sum(b) - sum(a)] if sum(a) < sum(b) else a
    x, y = list(accumulate(a)), list(accumulate(b))
    groups = alignment.align(x, y)
    found = {pair for group in groups for pair in alignment.links(group, x, y)}
    assert found == {(i, j) for i in range(len(a)) for j in range(len(b)) if x[i] - a[i] < y[j] and y[j] - b[j] < x[i]}
    assert [x[g.a_end - 1] for g in groups] == sorted(set(x) & set(y))


def test_words_are_aligned_without_a_step_for_each_group(monkeypatch):
    texts = ["naïve Überraschung thinsterha, unlike onthesur 漢字 x9y!! don't", "the cat  sat <0x41> 🙂🙂 ofwhshed", None, "fiﬁ", "x" * 300]
    aligner = alignment.Aligner(A, B)
    expected = aligner.align(texts)
    assert any(len(one.pairs) > len(one.groups) for one in expected)
    monkeypatch.setattr(alignment, "links", None)
    block = alignment._Block(aligner)
    n_a, n_b, n_groups, n_links, hashes, places, times = (column.to_pylist() for column in block.add(texts))
    pairs = list(block.pairs)
    for i, one in enumerate(expected):
        digest = sha256(one.written().encode()).hexdigest() if one.a else ""
        assert (n_a[i], n_b[i], n_groups[i], n_links[i], hashes[i]) == (len(one.a), len(one.b), len(one.groups), len(one.pairs), digest)
        assert Counter(one.pairs) == {pairs[p]: n for p, n in zip(places[i], times[i])}
