import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from millrace.llm import pieces
from millrace.llm.pieces import MARK, Vocabulary, decoded, encode_documents

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", " ", "  lead and  trail  ", "a ▁ b▁", "▁", "▁ ▁", "\n\n x  y\t é 漢字 😀 \x00", "\r\n", "The the THE then", "naïve ﬁ ĳ", "x" * 300, "tab\there", " private", "<0x0A> <s> </s> <unk>",
]


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(PATH)


@pytest.fixture(scope="module")
def model():
    return SentencePieceProcessor(model_file=PATH)


def _ids(vocabulary, text):
    return np.frombuffer(vocabulary.encode([text])[0], "<i4").tolist()


def _best(vocabulary, model, word):
    """The largest score of any segmentation, by trying every piece at every place."""
    scores = {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    best = [0.0]
    for end in range(1, len(word) + 1):
        values = [best[a] + scores[word[a:end]] for a in range(end) if word[a:end] in scores]
        if word[end - 1] not in scores:
            values.append(best[end - 1] + vocabulary.unknown)
        best.append(max(values))
    return best[-1]


@pytest.mark.parametrize("text", TEXTS)
def test_round_trip(vocabulary, text):
    assert vocabulary.decode(np.array(_ids(vocabulary, text))) == text


def test_best_score_and_shared_prefixes(vocabulary, model):
    rng = random.Random(1)
    words = {MARK * rng.randrange(3) + "".join(rng.choice("thentiosé漢") for _ in range(rng.randrange(1, 12))) for _ in range(400)}
    together = dict(vocabulary.segment(sorted(words)))
    for word in list(words)[:150]:
        alone = next(vocabulary.segment([word]))[1]
        assert together[word] == alone
        plain = [i for i in alone if not model.is_byte(i)]
        unknown = sum(char not in vocabulary.root or "" not in vocabulary.root[char] for char in word)
        spelled = sum(len(c.encode()) for c in word if c not in vocabulary.root or "" not in vocabulary.root[c])
        assert len(alone) - len(plain) == spelled
        assert sum(model.get_score(i) for i in plain) + unknown * vocabulary.unknown == pytest.approx(_best(vocabulary, model, word))


def _as_unigram():
    """The library's own Viterbi: the same file with another kind of model."""
    data = bytearray(open(PATH, "rb").read())

    def number(i):
        value = shift = 0
        while True:
            value |= (data[i] & 127) << shift
            i, shift = i + 1, shift + 7
            if data[i - 1] < 128:
                return value, i

    def fields(i, end):
        while i < end:
            tag, i = number(i)
            start = i
            if tag & 7 == 2:
                size, start = number(i)
                i = start + size
            elif tag & 7 == 0:
                _, i = number(i)
            else:
                i += 4 if tag & 7 == 5 else 8
            yield tag >> 3, start, i

    for field, start, end in fields(0, len(data)):
        if field == 2:
            for inner, at, _ in fields(start, end):
                if inner == 3:
                    data[at] = 1
    return SentencePieceProcessor(model_proto=bytes(data))


def test_never_worse_than_the_library(vocabulary, model, spark):
    library = _as_unigram()
    texts = [row.text for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).collect()]
    words = sorted({word for text in texts for word in text.split()})
    equal = 0
    for word in words:
        own, other = _ids(vocabulary, word), library.encode(word)
        equal += own == other
        score = [sum(model.get_score(i) if not model.is_byte(i) else 0 for i in ids) for ids in (own, other)]
        assert score[0] >= score[1]
        assert library.decode(own) == word
    assert equal > 0.9 * len(words)


def test_memory_stays_bounded(monkeypatch, vocabulary):
    before = [_ids(vocabulary, text) for text in TEXTS]
    monkeypatch.setattr(pieces, "CACHED_WORDS", 2)
    assert [_ids(Vocabulary(PATH), text) for text in TEXTS] == before


def test_documents(documents):
    rows = [*enumerate(TEXTS), (50, None), (None, "no id"), (None, "no id"), (51, "long " * 60_000)]
    frame = documents(*rows).withColumn("ids", F.lit("own")).withColumn("back", F.lit("own"))
    found = encode_documents(frame, PATH).collect()
    assert len(found) == len(rows) and all(row.round_trip for row in found)
    assert all(row.n_ids == len(row.ids) for row in found)
    assert {row.doc_id: row.n_ids for row in found}[50] == 0
    assert encode_documents(documents(), PATH).count() == 0


def test_decoding_a_slice_and_null(spark):
    frame = spark.createDataFrame([(1, [29871, 13]), (2, None), (3, [])], "k int, ids array<int>")
    found = {row.k: row.t for row in frame.select("k", decoded(PATH)("ids").alias("t")).collect()}
    assert found[2] is None and found[3] == ""
