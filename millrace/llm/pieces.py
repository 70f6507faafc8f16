"""SentencePiece encoding and decoding by shared-prefix Viterbi."""

import re
from array import array
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import releasing

MARK = "▁"
#: Spaces become marks. A mark that is in the text itself becomes a space, which no piece has.
SWAPPED = str.maketrans({" ": MARK, MARK: " "})
#: The marked words: marks with the characters behind them. A line break is in no piece.
WORDS = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
#: By how much an unknown character is worse than any piece.
UNKNOWN_PENALTY = 10.0
NOTHING: dict = {}
#: Words that a task keeps the ids of.
CACHED_WORDS = 200_000


class Vocabulary:
    """Pieces and scores of a model file, and Viterbi over words.

    The best segmentation of a word has the largest sum of scores; of equal sums,
    the longest last piece. A character in no piece becomes its UTF-8 bytes.
    """

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        count = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(count)]
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(count) if model.is_byte(i)}
        if len(self.bytes) != 256:
            raise ValueError("the vocabulary must have a piece for each byte")
        self.text = [p.replace(MARK, " ").encode() for p in self.pieces]
        for value, i in self.bytes.items():
            self.text[i] = bytes([value])
        scores: dict[str, tuple[float, int]] = {}
        for i, piece in enumerate(self.pieces):
            if model.is_control(i) or model.is_unknown(i):
                self.text[i] = b""
            elif not (model.is_unused(i) or model.is_byte(i)):
                if MARK in piece.lstrip(MARK):
                    raise ValueError(f"piece {i} has a mark behind other characters")
                scores[piece] = (model.get_score(i), i)
        self.unknown = min(score for score, _ in scores.values()) - UNKNOWN_PENALTY
        self.root: dict = {}
        for piece, found in scores.items():
            node = self.root
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = found
        self.known: dict[str, bytes] = {}

    def _spelled(self, char: str) -> list[int]:
        char = MARK if char == " " else char
        return [self.bytes[value] for value in char.encode()]

    def segment(self, words: list[str]) -> Iterator[tuple[str, list[int]]]:
        """The ids of each word. ``words`` are different and sorted.

        Sorted words are a trie walked depth first. At each depth of the current
        path stand the best score, the last piece with its start, and the places in
        the vocabulary's trie that begin at earlier depths. A word keeps all depths
        of the prefix that it shares with the word before it.
        """
        best: list[float] = [0.0]
        last: list[tuple[int, int]] = [(0, -1)]
        open_at: list[list[tuple[int, dict]]] = [[]]
        before = ""
        for word in words:
            depth = len(commonprefix((before, word)))
            del best[depth + 1 :], last[depth + 1 :], open_at[depth + 1 :]
            for at in range(depth, len(word)):
                char = word[at]
                score, piece, nodes = float("-inf"), (at, -1), []
                for start, node in open_at[at]:
                    if (node := node.get(char)) is not None:
                        nodes.append((start, node))
                        if (found := node.get("")) and best[start] + found[0] > score:
                            score, piece = best[start] + found[0], (start, found[1])
                alone = self.root.get(char, NOTHING)
                if alone:
                    nodes.append((at, alone))
                value, i = alone.get("", (self.unknown, -1))
                if best[at] + value > score:
                    score, piece = best[at] + value, (at, i)
                best.append(score)
                last.append(piece)
                open_at.append(nodes)
            ids: list[int] = []
            at = len(word)
            while at:
                start, i = last[at]
                if i < 0:
                    ids += reversed(self._spelled(word[start:at]))
                else:
                    ids.append(i)
                at = start
            ids.reverse()
            yield word, ids
            before = word

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        rows = [self._marked(text or "") for text in texts]
        encoded = []
        for start in range(0, len(rows), 64):
            some = rows[start : start + 64]
            new = set().union(*some).difference(self.known)
            if len(self.known) + len(new) > CACHED_WORDS:
                self.known.clear()
                new = set().union(*some)
            for word, ids in self.segment(sorted(new)):
                self.known[word] = array("i", ids).tobytes()
            get = self.known.__getitem__
            encoded += [b"".join(map(get, words)) for words in some]
        return encoded

    @staticmethod
    def _marked(text: str) -> list[str]:
        """The marked words of a text: marks, then characters; line breaks alone."""
        if not text:
            return []
        text = text.translate(SWAPPED) if MARK in text else text.replace(" ", MARK)
        return WORDS.findall(MARK + text)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        text = b"".join(map(self.text.__getitem__, ids.tolist()))
        return text[1:].decode("utf-8", "replace") if text[:1] == b" " else text.decode("utf-8", "replace")


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of this worker process; it lives on from task to task."""
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]


def _parts(batch: pa.Array, rows: int = 256) -> Iterator[pa.Array]:
    for start in range(0, len(batch), rows):
        yield batch.slice(start, rows)


def encoded(path: str):
    """A column function: text to ``ids``, the list of its ids, and ``round_trip``, whether
    they decode to the text. One pass does both, so the text goes to Python once."""
    kinds = pa.struct([("ids", pa.list_(pa.int32())), ("round_trip", pa.bool_())])

    @F.arrow_udf("struct<ids: array<int>, round_trip: boolean>")
    @releasing
    def encode(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = vocabulary(path)
        try:
            for batch in texts:
                done = [pa.array([], kinds)]
                for part in _parts(batch):
                    given = [text or "" for text in part.to_pylist()]
                    rows = [np.frombuffer(ids, "<i4") for ids in own.encode(given)]
                    offsets = np.append(0, np.cumsum([len(ids) for ids in rows])).astype(np.int32)
                    ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows)))
                    same = pa.array([own.decode(ids) == text for ids, text in zip(rows, given, strict=True)])
                    done.append(pa.StructArray.from_arrays([ids, same], fields=list(kinds)))
                yield pa.concat_arrays(done)
        finally:
            own.known.clear()  # a worker that goes on with other work needs its memory
            _VOCABULARIES.clear()

    return encode.asNondeterministic()


def decoded(path: str):
    """A column function: list of ids to its text; null for null."""

    @F.arrow_udf("string")
    def decode(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in lists:
            values, offsets = np.asarray(batch.values), np.asarray(batch.offsets)
            spans = zip(offsets[:-1], offsets[1:], batch.is_valid().to_pylist(), strict=True)
            yield pa.array([vocabulary(path).decode(values[a:b]) if known else None for a, b, known in spans], pa.string())

    return decode.asNondeterministic()


def encode_documents(documents: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` (of the whole text), ``n_ids``, ``round_trip``.

    ``round_trip`` tells whether decoding the ids gives the text again, which is so
    for every text. A null or empty text has no ids and decodes to the empty text.
    Repeated rows and null ids are kept; other columns are ignored; an empty table
    gives an empty result.
    """
    rows = documents.select("doc_id", encoded(path)("text").alias("coded"))
    ids = F.col("coded.ids")
    return rows.select("doc_id", ids.alias("ids"), F.size(ids).cast("long").alias("n_ids"), "coded.round_trip")
