import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm.token_files import WordEncoder, digests, read_documents, write_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "", " ", "\n\n", "Hello, world. It's   fine!!", "don't 'twas x'. a). (b, $5.00 #tag&&& 100%", "Don’t “stop” — now…",
    "A\x85b\xa0c <|endoftext|>x <|endoftext|>. <|ENDOFTEXT|>", "ΑΣ ΣΑΣ İI", "é ́x 漢字 😀😀", "\tI'm\r\nok \x1c\x1dz",
    "word, word. WORD! word", "a" * 3000, "12,345.67", "fin.́ fin.x ..?! ,a",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def _expected(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def test_words_give_the_ids_of_whole_texts(library):
    encoder = WordEncoder(PATH, 1)
    for _ in range(2):  # the second time from memory
        for text, ids in zip(TEXTS, encoder.encode(TEXTS), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == _expected(library, text), text


def test_memory_stays_bounded(monkeypatch, library):
    monkeypatch.setattr("millrace.llm.token_files.CACHED_WORDS", 3)
    encoder = WordEncoder(PATH, 1)
    for text in TEXTS * 2:
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == _expected(library, text)


def test_files_hold_documents_in_order(documents, library, spark):
    rows = [(i * 7 % 101, f"{text} {i}") for i, text in enumerate(TEXTS * 7)]
    rows += [(5, None), (None, "no id"), (None, "no id"), (200, "x y"), (200, "x y"), (200, "a")]
    files = write_token_files(documents(*rows).withColumn("ids", F.lit("own")), PATH, 1)
    found = sorted(digests(files).collect(), key=lambda row: row.start)
    assert len(found) == len(rows)
    keys = [-1 if row.doc_id is None else row.doc_id for row in found]
    assert keys == sorted(keys)
    start = 0
    for row in found:
        assert row.start == start
        start += row.n_tokens
    expected = sorted(
        (-1 if i is None else i, len(ids := _expected(library, text)), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, text in rows
    )
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == expected
    read = {row.start: row.ids for row in read_documents(files).collect()}
    assert all(zlib.crc32(np.array(read[row.start], "<u4").tobytes()) == row.ids_crc32 for row in found)


@pytest.mark.parametrize(("delta", "encoding"), [(False, "RLE_DICTIONARY"), (True, "DELTA_BINARY_PACKED")])
def test_format_of_the_files(documents, delta, encoding):
    docs = documents(*((i, f"some words {i} " * 50) for i in range(300)))
    files = write_token_files(docs, PATH, 1, delta)
    paths = [path.removeprefix("file:") for path in files.tokens.inputFiles()]
    meta = pq.ParquetFile(paths[0]).metadata
    columns = {meta.row_group(0).column(i).path_in_schema: meta.row_group(0).column(i) for i in range(meta.num_columns)}
    ids = next(column for name, column in columns.items() if name.startswith("ids"))
    assert encoding in ids.encodings
    assert all(column.has_offset_index and column.has_column_index for column in columns.values())


def test_a_reader_of_counts_reads_no_ids(documents, capsys):
    files = write_token_files(documents((1, "a b"), (2, "c")), PATH, 1)
    files.tokens.where("doc_id = 2").select("doc_id", "n_tokens").explain("formatted")
    plan = capsys.readouterr().out
    schema = next(line for line in plan.splitlines() if line.startswith("ReadSchema"))
    assert "ids" not in schema and "EqualTo(doc_id,2)" in plan


def test_empty_table(documents):
    assert digests(write_token_files(documents(), PATH, 1)).count() == 0


def test_a_word_is_kept_once_for_all_its_spellings(library):
    texts = ["Étage étage ÉTAGE étage, Étage?! straße STRASSE ÿÖ, naïveté.", "x9y, X9Y. x9y", "word Word word; WORD..."]
    encoder = WordEncoder(PATH, 1)
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == _expected(library, text), text
    assert {word for word in encoder.known if word.isalnum()} == {"étage", "straße", "strasse", "ÿö", "naïveté", "x9y", "word"}


def test_added_tokens_of_letters_are_found_within_words(library, tmp_path):
    library = Tokenizer.from_file(PATH)
    library.add_tokens(["dog"])
    library.save(str(tmp_path / "own.json"))
    texts = ["hotdog, dogs Dog. hot DOG", "cat dog"]
    encoder = WordEncoder(str(tmp_path / "own.json"), 1)
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == _expected(library, text), text
