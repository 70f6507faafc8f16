"""Token ids as Parquet files: sorted, delta or dictionary encoded, page-indexed."""

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain, pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from pyspark.sql.window import Window

from millrace.llm.shared import map_batches, written

#: Bytes of ids in one file, about; of a row group; of a page; rows of a page.
FILE_BYTES, GROUP_BYTES, PAGE_BYTES, PAGE_ROWS = 64 << 20, 16 << 20, 256 << 10, 512
#: Words that a worker keeps the ids of, some 200 bytes each.
CACHED_WORDS = 900_000
#: Bytes of texts that are split into words together, about; one text may be longer.
TEXT_BYTES = 4 << 20
#: Marks that a tokenizer never joins with a letter or digit before them.
TAIL = ".,!?;:%&*$#"
#: Words of letters that have one small form each and don't change beside each other.
PLAIN = re.compile("[a-zA-ZÀ-ÖØ-öø-ÿ]+").fullmatch
CAPITALS, SMALL = ("".join(map(chr, chain(*spans))) for spans in (
    (range(0x41, 0x5B), range(0xC0, 0xD7), range(0xD8, 0xDF)),
    (range(0x61, 0x7B), range(0xDF, 0xF7), range(0xF8, 0x100)),
))
#: What a word may consist of that is cut before its last marks.
JOINED = CAPITALS + SMALL + "0123456789"
#: Words that go to the tokenizer at once.
WORD_BATCH = 20_000
#: Words put into one text, with a special token between them, which keeps them apart.
CHAIN, SEPARATOR = 500, "<|startoftext|>"


class TokenFiles(NamedTuple):
    """``tokens``: doc_id, n_tokens, file, place, before (ids in the file before the
    document), ids. ``files``: file, start (ids in all files before it)."""

    tokens: DataFrame
    files: DataFrame


class WordEncoder:
    """Ids of whole texts, by a tokenizer that drops white space between words.

    Such a tokenizer never looks across a space, so each different word is encoded
    once and a text is the ids of its words. Special tokens in a text have no space
    inside and are found within a word, as in the whole text.

    Words are taken without the marks behind them and, where the tokenizer folds case,
    in small letters. One of plain letters, which is most words, goes to the tokenizer's
    model at once, as the piece that the steps before the model would make of it.
    """

    def __init__(self, path: str, end: int | None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives out the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = b"" if end is None else np.array([end], "<u4").tobytes()
        self.apart = self.tokenizer.token_to_id(SEPARATOR)
        self.known: dict[str, bytes] = {}
        self.model = self.tokenizer.model
        self.letters = self._letters()

    def _letters(self) -> dict[int, str] | None:
        """How each plain letter reaches the model; None if a word of them may be cut,
        hold an added token or change otherwise on the way."""
        normalizer, splitter = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        added = (token.content for token in self.tokenizer.get_added_tokens_decoder().values())
        if normalizer is None or splitter is None or any(map(PLAIN, added)):
            return None
        if any(normalizer.normalize_str(text) != text.lower() for text in (CAPITALS, SMALL, SMALL[::-1])):
            return None
        pieces = {text: splitter.pre_tokenize_str(text) for text in (*SMALL, SMALL, SMALL[::-1])}
        if any(len(found) != 1 for found in pieces.values()):
            return None
        spelled = {text: found[0][0] for text, found in pieces.items()}
        if any(spelled[text] != "".join(map(spelled.get, text)) for text in (SMALL, SMALL[::-1])):
            return None
        return {ord(letter): spelled[letter] for letter in SMALL}

    def _encode_words(self, words: list[str]) -> None:
        for start in range(0, len(words), WORD_BATCH):
            some = words[start : start + WORD_BATCH]
            chained = [word for word in some if "<|" not in word]
            alone = [word for word in some if "<|" in word]
            if self.apart is None or len(chained) < 2:
                chained, alone = [], some
            for first in range(0, len(chained), CHAIN):
                part = chained[first : first + CHAIN]
                (found,) = self.tokenizer.encode_batch_fast([SEPARATOR.join(part)], add_special_tokens=False)
                ids = np.array(found.ids, "<u4")
                cuts = np.flatnonzero(ids == self.apart)
                text, starts, ends = ids.tobytes(), [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)]
                self.known.update({word: text[4 * a : 4 * b] for word, a, b in zip(part, starts, ends, strict=True)})
            found = self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)
            self.known.update(zip(alone, (array("I", f.ids).tobytes() for f in found), strict=True))

    def _learn(self, words: list[str]) -> None:
        others = []
        for word in words:
            if self.letters is not None and PLAIN(word) and word.islower():
                tokens = self.model.tokenize(word.translate(self.letters))
                self.known[word] = array("I", [token.id for token in tokens]).tobytes()
            else:
                others.append(word)
        self._encode_words(others)

    def _parts(self, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Words as their stems and the marks behind them. Other words are stems."""
        stems = pc.utf8_rtrim(words, TAIL)
        cut = pc.and_(pc.equal(pc.utf8_ltrim(stems, JOINED), ""), pc.not_equal(stems, ""))
        small = stems if self.letters is None else pc.utf8_lower(stems)
        return pc.if_else(cut, small, words), pc.if_else(cut, pc.utf8_ltrim(words, JOINED), "")

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers, with the end id."""
        counts, ids = self.encode_texts(pa.array(texts, pa.string()))
        return [part.tobytes() for part in np.split(ids, np.cumsum(counts)[:-1])]

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each text has, with the end id, and the ids of all texts."""
        words = pc.split_pattern(pc.replace_substring(texts.fill_null(""), "\n", " "), " ")
        coded = words.flatten().dictionary_encode()
        parts = pa.concat_arrays(self._parts(coded.dictionary)).dictionary_encode()
        names = parts.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.known.get, names))
        unknown = [place for place, ids in enumerate(found) if ids is None]
        if len(self.known) + len(unknown) > CACHED_WORDS:
            self.known.clear()
        self._learn([names[place] for place in unknown])
        for place in unknown:
            found[place] = self.known[names[place]]
        # the ids of each different word, then of the texts
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        codes = parts.indices.to_numpy().reshape(2, -1).T.ravel()
        ends, ids = _strung(codes, lengths, np.frombuffer(b"".join(found), "<u4"))
        lengths = np.append(np.diff(ends[1::2], prepend=0), len(self.end) // 4)
        ids = np.append(ids, np.frombuffer(self.end, "<u4"))
        text_ends = np.cumsum(words.value_lengths().to_numpy()) + np.arange(len(texts))
        codes = np.full(len(coded) + len(texts), len(lengths) - 1, np.int32)
        inside = np.ones(len(codes), bool)
        inside[text_ends] = False
        codes[inside] = coded.indices.to_numpy()
        ends, ids = _strung(codes, lengths, ids)
        return np.diff(ends[text_ends], prepend=0), ids


def _strung(codes: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lists of ids, one after another, in the order of ``codes``: where each ends, and
    all ids. ``ids`` holds the lists themselves, of these ``lengths``."""
    starts = np.cumsum(lengths) - lengths
    counts = lengths[codes]
    ends = np.cumsum(counts)
    at = np.repeat(starts[codes] - ends + counts, counts)
    at += np.arange(len(at))
    return ends, ids[at]


_ENCODERS: dict[tuple, WordEncoder] = {}


def encoder(path: str, end: int | None) -> WordEncoder:
    """The encoder of this worker process; it lives on from task to task."""
    if (path, end) not in _ENCODERS:
        _ENCODERS[path, end] = WordEncoder(path, end)
    return _ENCODERS[path, end]


def _encode(path: str, end: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, before, place = TaskContext.get().partitionId(), 0, 0
        encoder(path, end).known.clear()  # of an earlier task
        for batch in batches:
            sizes = pc.binary_length(batch["text"]).fill_null(0).to_numpy()
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // TEXT_BYTES)) + 1
            for start, stop in pairwise(sorted({0, *cuts.tolist(), len(batch)})):
                part = batch.slice(start, stop - start)
                counts, ids = encoder(path, end).encode_texts(part["text"])
                ends = np.cumsum(counts)
                values = pa.array(ids.view("<i4"))
                offsets = pa.array(np.append(0, ends).astype(np.int32))
                n = len(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        pa.array(counts),
                        pa.array(np.full(n, file, np.int32)),
                        pa.array(np.arange(place, place + n)),
                        pa.array(before + ends - counts),
                        pa.ListArray.from_arrays(offsets, values),
                    ],
                    names=["doc_id", "n_tokens", "file", "place", "before", "ids"],
                )
                before, place = before + int(ends[-1]), place + n

    return encode


def write_token_files(documents: DataFrame, tokenizer: str, end: int = 1, delta: bool = False) -> TokenFiles:
    """Encode whole texts and write their ids in ascending doc_id order.

    The texts are dealt out by ranges of the id, so each file holds a range, sorted;
    ids are the column ``ids``, a list of ints, dictionary encoded (``delta``: delta
    encoded, for ids that rise). Row groups and pages are small and pages carry
    their smallest and largest doc_id, so a reader of a few documents reads their
    pages, and a reader of ``doc_id`` and ``n_tokens`` reads no ids. A second table
    has the number of ids before each file.

    A null or empty text is the end id alone. Rows without an id come first; rows
    with one id stand in the order of their texts, and may fill several files.
    Other columns are ignored. An empty table gives empty files.
    """
    tie = F.xxhash64("text")
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(1, -(-size // FILE_BYTES), documents.sparkSession.sparkContext.defaultParallelism if size > 8 << 20 else 1)
    texts = documents.select("doc_id", "text", tie.alias("tie"))
    texts = texts.repartitionByRange(files, F.col("doc_id").asc_nulls_first(), "tie")
    texts = texts.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie", "text")
    schema = f"doc_id {dict(documents.dtypes)['doc_id']}, n_tokens long, file int, place long, before long, ids array<int>"
    options = {
        "parquet.block.size": str(GROUP_BYTES),
        "parquet.page.size": str(PAGE_BYTES),
        "parquet.page.row.count.limit": str(PAGE_ROWS),
        "parquet.enable.dictionary": str(not delta).lower(),
        "parquet.writer.version": "v2",
        "compression": "zstd",
    }
    tokens = written(map_batches(texts.select("doc_id", "text"), _encode(tokenizer, end), schema), "tokens", **options)
    totals = tokens.groupBy("file").agg(F.sum("n_tokens").alias("ids"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"))
    return TokenFiles(tokens, written(starts, "token-starts"))


@F.arrow_udf(LongType())
def _crc32(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in lists:
        values = np.asarray(batch.values).astype("<u4")
        offsets = np.asarray(batch.offsets)
        sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.array(sums, pa.int64())


def read_documents(files: TokenFiles) -> DataFrame:
    """From the files: doc_id, start (ids of all documents before), n_tokens, ids."""
    rows = files.tokens.join(files.files, "file")
    return rows.select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids")


def digests(files: TokenFiles) -> DataFrame:
    """From the files: doc_id, start, n_tokens and the crc32 of the ids."""
    tokens = files.tokens.select("doc_id", "file", "before", "n_tokens", _crc32("ids").alias("ids_crc32"))
    rows = tokens.join(files.files, "file")
    return rows.select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
