"""Tokens of two tokenizers over the same text, matched by the bytes they cover."""

import re
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache
from hashlib import sha256
from itertools import accumulate, chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType
from tokenizers import Tokenizer

from millrace.llm.shared import map_batches, written

#: Texts encoded together; letters of such texts, unless one text alone is longer.
TOGETHER, LETTERS_TOGETHER = 64, 1 << 18
#: A block of documents ends with the texts that reach so many distinct words or links.
#: Blocks are units of work; no count depends on them.
BLOCK_WORDS, BLOCK_LINKS = 400_000, 8_000_000
#: Where both tokenizers begin a new token: at a single space between two characters
#: that surely are no white space. What is on its left has no say in what follows.
CUT = re.compile(r"(?<=[\w!-~]) (?=[\w!-~])")
CHAINED = re.compile(r"[\w!-~](?:.*[\w!-~])?", re.S)
#: Letters of words that are put together and aligned as one text.
CHAIN_LETTERS = 1 << 14
#: Bits of an id pair that hold the second id.
LOW_BITS = 32


class Group(NamedTuple):
    """Tokens a[a_start:a_end] and b[b_start:b_end] cover the same bytes."""

    a_start: int
    a_end: int
    b_start: int
    b_end: int


def align(a_ends: Sequence[int], b_ends: Sequence[int]) -> list[Group]:
    """The finest groups of two token sequences over one text.

    ``a_ends`` and ``b_ends`` are the byte offsets at which the tokens end. Each side
    becomes a dictionary from end to index; the offsets in both, found as a hash-set
    intersection, cut the two sequences into groups. Tokens without bytes belong to
    the group that ends where they do. Without a common end there is no group.
    """
    a_cuts, b_cuts = cuts(a_ends, b_ends)
    return list(map(Group, [0, *a_cuts], a_cuts, [0, *b_cuts], b_cuts))


def cuts(a_ends: Sequence[int], b_ends: Sequence[int]) -> tuple[list[int], list[int]]:
    """How many tokens of each side end by each common offset."""
    a_index = dict(zip(a_ends, range(1, len(a_ends) + 1), strict=True))
    b_index = dict(zip(b_ends, range(1, len(b_ends) + 1), strict=True))
    common = sorted(a_index.keys() & b_index.keys())
    return list(map(a_index.__getitem__, common)), list(map(b_index.__getitem__, common))


def links(group: Group, a_ends: Sequence[int], b_ends: Sequence[int]) -> Iterator[tuple[int, int]]:
    """Index pairs of the tokens in a group whose byte ranges overlap."""
    i, a_end, j, b_end = group
    while i < a_end and j < b_end:
        yield i, j
        ends = a_ends[i], b_ends[j]
        if ends[0] <= ends[1]:
            i += 1
        if ends[1] <= ends[0]:
            j += 1


# The two tokenizers


@lru_cache(1)
def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    Latin-1 characters stand for themselves, the others for those from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + n): b for n, b in enumerate(others)}


class ByteLevel:
    """A byte-level BPE file. Special tokens' strings in a text are plain text."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters = _byte_letters()
        size = self.tokenizer.get_vocab_size()
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        # A token that is no byte-level word (an added one) stands for its own text.
        self.bytes = [
            bytes(map(letters.__getitem__, t)) if letters.keys() >= set(t) else t.encode() for t in tokens
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces:
    """A SentencePiece file, which itself puts a space before a text."""

    def __init__(self, path: str):
        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.processor.get_piece_size())
        self.bytes = [
            bytes([int(piece[3:-1], 16)]) if self.processor.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in zip(ids, self.processor.id_to_piece(list(ids)), strict=True)
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.processor.encode(texts, num_threads=1)


@lru_cache(1)
def _tokenizers(a_path: str, b_path: str) -> tuple[ByteLevel, Pieces]:
    return ByteLevel(a_path), Pieces(b_path)


@lru_cache(1)
def _digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids below ``size`` as decimals, each with a comma behind it, and where each
    begins and the last ends."""
    texts = [b"%d," % i for i in range(size)]
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])


class Alignment(NamedTuple):
    """One aligned text. ``pairs`` holds ``a id << 32 | b id`` for each link."""

    a: list[int]
    b: list[int]
    groups: list[Group]
    pairs: list[int]

    def written(self) -> str:
        """The groups as ``a1,a2|b1;a3|b2,b3``."""
        a, b = list(map(str, self.a)), list(map(str, self.b))
        return ";".join(
            [f"{a[i]}|{b[k]}" if m - i == 1 == n - k else f"{','.join(a[i:m])}|{','.join(b[k:n])}" for i, m, k, n in self.groups]
        )


NOTHING = Alignment([], [], [], [])


class Aligner:
    """Aligns texts under a byte-level file A and a SentencePiece file B."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = _tokenizers(a_path, b_path)
        self.digits = _digits(max(len(self.a.bytes), len(self.b.bytes)))

    def align(self, texts: Sequence[str | None]) -> list[Alignment]:
        """One alignment for each text, the same for equal texts in any order. A null
        or empty text, and one that either side's tokens do not spell out, has no
        tokens."""
        texts = [text or "" for text in texts]
        found: list[Alignment] = []
        start = 0
        while start < len(texts):
            end, letters = start, 0
            while end < len(texts) and end - start < TOGETHER and (end == start or letters < LETTERS_TOGETHER):
                letters += len(texts[end])
                end += 1
            some = texts[start:end]
            a_ids = self.a.encode([" " + text for text in some])
            b_ids = self.b.encode(some)
            found += map(self._align, some, a_ids, b_ids)
            start = end
        return found

    def ends(self, text: str, a: list[int], b: list[int]) -> tuple[list[int], list[int]] | None:
        """Where the tokens of both sides end, or None if they don't spell the text out."""
        whole = b" " + text.encode()
        a_parts = list(map(self.a.bytes.__getitem__, a))
        b_parts = list(map(self.b.bytes.__getitem__, b))
        if not text or b"".join(a_parts) != whole or b"".join(b_parts) != whole:
            return None
        return list(accumulate(map(len, a_parts))), list(accumulate(map(len, b_parts)))

    def _align(self, text: str, a: list[int], b: list[int]) -> Alignment:
        ends = self.ends(text, a, b)
        if ends is None:
            return NOTHING
        a_ends, b_ends = ends
        groups = align(a_ends, b_ends)
        pairs = [a[i] << LOW_BITS | b[j] for group in groups for i, j in links(group, a_ends, b_ends)]
        return Alignment(a, b, groups, pairs)


# Over a table

FIELDS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
HELD = "place array<int>, times array<int>, pairs array<long>, documents array<long>"
LISTS = "a_ids array<int>, b_ids array<int>, groups array<struct<a_start:int,a_end:int,b_start:int,b_end:int>>"


def _lists(alignments: Sequence[Alignment]) -> list[pa.Array]:
    """Ids of both sides and the groups, one list for each text."""
    cuts = pa.struct([(name, pa.int32()) for name in Group._fields])
    groups = [[g._asdict() for g in one.groups] for one in alignments]
    ids = pa.list_(pa.int32())
    return [
        pa.array([one.a for one in alignments], ids),
        pa.array([one.b for one in alignments], ids),
        pa.array(groups, pa.list_(cuts)),
    ]


def align_documents(documents: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id and the alignment of each whole text: a_ids, b_ids, and groups as index
    ranges [a_start, a_end), [b_start, b_end) of tokens over the same bytes.

    A null or empty text has empty lists, as has one that the tokens of either side
    do not spell out (B folds some characters). Rows without an id and repeated rows
    are rows like any other; other columns are ignored; an empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_path, b_path)
        for batch in batches:
            for start in range(0, len(batch), TOGETHER):
                part = batch.slice(start, TOGETHER)
                columns = _lists(aligner.align(part["text"].to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], *columns], names=["doc_id", "a_ids", "b_ids", "groups"]
                )

    rows = documents.select("doc_id", "text")
    return map_batches(rows, run, f"doc_id {dict(documents.dtypes)['doc_id']}, {LISTS}")


class _Block:
    """Some documents, word by word: each different word is aligned once.

    ``pairs`` are the distinct id pairs of all words, ``documents`` how many documents
    hold each. Of the words it keeps the number of tokens and groups, the groups as
    text, and the places of their pairs, one after another.
    """

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        self.words: dict[str, int] = {}
        self.pairs: dict[int, int] = {}
        self.documents = np.zeros(0, np.int64)
        self.links = 0
        self.sizes = array("i")
        self.texts: list[bytes] = []
        self.places, self.ends = array("i"), array("q", [0])

    @property
    def full(self) -> bool:
        return len(self.words) >= BLOCK_WORDS or self.links >= BLOCK_LINKS

    def _learn(self, words: set[str]) -> None:
        """Align words, many at a time as one text where they can stand beside others."""
        chain, letters = [], 0
        for word in words:
            if CHAINED.fullmatch(word) is None:
                self._keep([word])
                continue
            chain.append(word)
            letters += len(word) + 1
            if letters >= CHAIN_LETTERS:
                self._keep(chain)
                chain, letters = [], 0
        if chain:
            self._keep(chain)

    def _keep(self, words: list[str]) -> None:
        text, aligner = " ".join(words), self.aligner
        (a,), (b,) = aligner.a.encode([" " + text]), aligner.b.encode([text])
        both = aligner.ends(text, a, b)
        if both is None:
            if len(words) == 1:
                self.words[words[0]] = -1
            else:  # some word is not spelled out
                half = len(words) // 2
                self._keep(words[:half])
                self._keep(words[half:])
            return
        a, b, a_ends, b_ends = (np.array(column, np.int64) for column in (a, b, *both))
        every = np.union1d(a_ends, b_ends)  # one pair of tokens covers the bytes up to each
        first, second = np.searchsorted(a_ends, every), np.searchsorted(b_ends, every)
        common = every[(a_ends[first] == every) & (b_ends[second] == every)]
        pairs, places = np.unique(a[first] << LOW_BITS | b[second], return_inverse=True)
        known = [self.pairs.setdefault(pair, len(self.pairs)) for pair in pairs.tolist()]
        self.places.frombytes(np.array(known, np.int32)[places].tobytes())
        word_ends = np.cumsum([len(word.encode()) + 1 for word in words])
        i, j = (np.searchsorted(ends, word_ends, "right") for ends in (a_ends, b_ends))
        n_groups, n_links = (np.searchsorted(ends, word_ends, "right") for ends in (common, every))
        sizes = np.diff(np.stack([i, j, n_groups, n_links], axis=1), axis=0, prepend=0)
        self.sizes.frombytes(sizes.astype(np.int32).tobytes())
        self.ends.frombytes((self.ends[-1] + n_links).tobytes())
        self.words.update(zip(words, range(len(self.texts), len(self.texts) + len(words)), strict=True))
        text, ends = self._written(a, b, a_ends, b_ends, common)
        stops = ends[i + j - 1].tolist()
        self.texts += [text[start : stop - 1] for start, stop in zip([0, *stops], stops)]

    def _written(self, a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray, common: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The groups as ``a1,a2|b1;a3|b2,b3;``, and where the text of each id ends."""
        a_cuts, b_cuts = (np.searchsorted(ends, common, "right") for ends in (a_ends, b_ends))
        a_place = np.arange(len(a)) + np.append(0, b_cuts)[np.searchsorted(common, a_ends)]
        b_place = np.arange(len(b)) + a_cuts[np.searchsorted(common, b_ends)]
        ids = np.empty(len(a) + len(b), np.int64)
        ids[a_place], ids[b_place] = a, b
        marks = np.full(len(ids), ord(","), np.uint8)
        marks[a_place[a_cuts - 1]], marks[b_place[b_cuts - 1]] = ord("|"), ord(";")
        digits, stops = self.aligner.digits
        lengths = stops[ids + 1] - stops[ids]
        ends = np.cumsum(lengths)
        text = digits[np.repeat(stops[ids + 1] - ends, lengths) + np.arange(ends[-1])]
        text[ends - 1] = marks
        return text.tobytes(), ends

    def add(self, texts: list[str | None]) -> list[pa.Array]:
        """For each text its digest, the places of its pairs and how often it holds each."""
        split = [CUT.split(text) if text else [] for text in texts]
        self._learn(set().union(*split) - self.words.keys())
        of = self.words.__getitem__
        rows = [list(map(of, words)) for words in split]
        rows = [[] if -1 in words else words for words in rows]
        strings = [b";".join(map(self.texts.__getitem__, words)) for words in rows]
        ids = np.fromiter(chain.from_iterable(rows), np.int64)
        n_words = list(map(len, rows))
        doc = np.repeat(np.arange(len(rows)), n_words)
        table = np.frombuffer(self.sizes, np.int32).reshape(-1, 4) if self.sizes else np.zeros((0, 4), np.int32)
        running = np.vstack([np.zeros(4, np.int64), np.cumsum(table[ids], axis=0, dtype=np.int64)])
        bounds = np.cumsum([0, *n_words])
        sums = running[bounds[1:]] - running[bounds[:-1]]
        ends = np.frombuffer(self.ends, np.int64)
        lengths = ends[ids + 1] - ends[ids]
        at = np.repeat(ends[ids + 1] - np.cumsum(lengths), lengths) + np.arange(lengths.sum())
        places = np.frombuffer(self.places, np.int32) if self.places else np.zeros(0, np.int32)
        held, times = np.unique(np.repeat(doc, lengths) << LOW_BITS | places[at], return_counts=True)
        place = (held & ((1 << LOW_BITS) - 1)).astype(np.int32)
        grown = np.zeros(len(self.pairs), np.int64)
        grown[: len(self.documents)] = self.documents
        self.documents = grown + np.bincount(place, minlength=len(grown))
        self.links += len(at)
        cuts = pa.array(np.searchsorted(held >> LOW_BITS, np.arange(len(rows) + 1)), pa.int32())
        hashes = [sha256(text).hexdigest() if text else "" for text in strings]
        lists = (pa.ListArray.from_arrays(cuts, pa.array(values)) for values in (place, times.astype(np.int32)))
        return [*(pa.array(column) for column in sums.T.copy()), pa.array(hashes, pa.string()), *lists]


def _blocks(a_path: str, b_path: str, schema: StructType):
    """Per document its digest and its pairs as places in its block's list of pairs;
    per block one more row, with that list and the number of documents for each."""
    names, arrow = schema.names, to_arrow_schema(schema)
    longs = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_path, b_path)
        number, block = 0, _Block(aligner)
        task = TaskContext.get().partitionId()

        def end() -> pa.RecordBatch:
            row = {"block": f"{task}-{number}", "pairs": list(block.pairs), "documents": block.documents.tolist()}
            return pa.RecordBatch.from_arrays([pa.array([row.get(f.name)], f.type) for f in arrow], names=names)

        for batch in batches:
            for start in range(0, len(batch), TOGETHER):
                part = batch.slice(start, TOGETHER)
                n = len(part)
                columns = block.add(part["text"].to_pylist())
                columns = [part["doc_id"], pa.array([f"{task}-{number}"] * n), *columns, pa.nulls(n, longs), pa.nulls(n, longs)]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                if block.full:
                    yield end()
                    number, block = number + 1, _Block(aligner)
        if block.pairs:
            yield end()

    return run


def _totals(documents: pa.Table, counts: pa.Table) -> pa.Table:
    """For the documents of one block, links that are the best of their first id and
    the sum of counts over all links."""
    place = counts["place"].to_numpy()
    size = int(place.max()) + 1 if len(place) else 0
    places, times = (pa.concat_arrays(documents[name].chunks) for name in ("place", "times"))
    held, often = places.flatten().to_numpy(), times.flatten().to_numpy()
    ends = np.cumsum(places.value_lengths().to_numpy())
    starts = np.append(0, ends[:-1])
    table = documents.select(["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
    for name, column in (("n_best", "best"), ("count_sum", "count")):
        weights = np.zeros(size, np.int64)
        weights[place] = counts[column].to_numpy()
        sums = np.append(0, np.cumsum(weights[held] * often))
        table = table.append_column(name, pa.array(sums[ends] - sums[starts]))
    return table


class CorpusAlignment(NamedTuple):
    """``documents``: see ``align_corpus``. ``pairs``: a_id, b_id, count (documents
    with such a link), best (whether no other b_id has a larger count)."""

    documents: DataFrame
    pairs: DataFrame


def align_corpus(documents: DataFrame, a_path: str, b_path: str) -> CorpusAlignment:
    """Align all texts and count, over the whole corpus, which ids meet.

    Per document: doc_id, n_a and n_b tokens, n_groups, n_links (token pairs whose
    bytes overlap), groups_sha256 (of ``a1,a2|b1;a3|b2,b3``), n_best (links whose id
    pair has the highest count of its A id, ties included) and count_sum (counts
    added over links). A pair counts once in a document.

    A text is cut at single spaces, where both sides begin a new token whatever is on
    the left, and each different word of a block is encoded and aligned once. A task
    writes documents with their pairs as places in a list of the block's distinct
    pairs, and that list with its counts: only lists are shuffled to add up counts, and the counts return to the
    block that asked for them, so no table of all pairs is held or broadcast.

    A null or empty text, or one that the tokens do not spell out, has zeros and the
    empty string. Repeated rows are documents each; rows without an id too; other
    columns are ignored; an empty table gives no rows.
    """
    by_id = StructType([StructField("doc_id", documents.schema["doc_id"].dataType)])
    digest = StructType.fromDDL(FIELDS).fields
    schema = StructType([*by_id, StructField("block", StringType()), *digest, *StructType.fromDDL(HELD)])
    encoded = map_batches(documents.select("doc_id", "text"), _blocks(a_path, b_path, schema), schema)
    rows = written(encoded, "aligned", compression="zstd")
    lists = rows.where(F.col("pairs").isNotNull())
    asked = lists.select("block", F.posexplode(F.arrays_zip("pairs", "documents")).alias("place", "held"))
    asked = asked.select("block", "place", F.col("held.pairs").alias("pair"), F.col("held.documents").alias("n"))
    counts = asked.groupBy("pair").agg(F.sum("n").alias("count"))
    counts = written(counts.select("pair", F.shiftright("pair", LOW_BITS).alias("a_id"), "count"), "pair-counts")
    highest = counts.groupBy("a_id").agg(F.max("count").alias("highest"))
    best = (F.col("count") == F.col("highest")).alias("best")
    pairs = counts.join(highest, "a_id").select("pair", "a_id", "count", best)
    answers = asked.select("block", "place", "pair").join(pairs, "pair")
    answers = answers.select("block", "place", "count", F.col("best").cast("long").alias("best"))
    own = rows.where(F.col("pairs").isNull()).drop("pairs", "documents").withColumnRenamed("block", "of_block")
    result = StructType([*by_id, *digest, *StructType.fromDDL("n_best long, count_sum long")])
    totals = own.groupBy("of_block").cogroup(answers.groupBy("block")).applyInArrow(_totals, result)
    b_id = F.col("pair").bitwiseAND((1 << LOW_BITS) - 1).alias("b_id")
    return CorpusAlignment(totals, pairs.select("a_id", b_id, "count", "best"))
