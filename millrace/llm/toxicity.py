"""Toxic texts by a subsequence string kernel, Nyström landmarks and a linear SVM."""

import random
import re
from collections.abc import Callable, Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import labelled_sample, releasing

#: Letters of a common subsequence; weight of each letter it spans, gaps included.
LETTERS, DECAY = 3, 0.75
#: Landmark words; labelled documents to learn from, at most.
LANDMARKS, MOST_LABELLED = 96, 20_000
#: Words of one labelled document to learn from, at most: those most like landmarks;
#: of a clean one the words that count as not toxic in a round.
MOST_WORDS, CLEAN_WORDS = 16, 8
#: Words up to here are compared whole. Longer ones, and those longer than a window,
#: are compared in windows of so many letters, a step apart.
WHOLE, WINDOW, STEP = 16, 8, 2
#: Beginnings of words that may be landmarks, in letters; letters of a landmark.
BEGINNINGS, LONGEST = range(4, 10), 24
#: What the presence of a landmark tells at least, in nats over all documents: among a
#: hundred thousand words without meaning hardly one tells as much by chance.
LEAST_GAIN = 10.0
#: Share of the documents with a beginning that makes a word stand for it.
MOSTLY = 0.6
#: Share of toxic documents among those with a landmark that makes it an insult, of
#: which altered copies are made; copies of each.
INSULT, ALTERED = 0.9, 24
#: Altered copies for each that counts as a document when margins become probabilities.
COPIES_OF_ONE = 4
#: Words that a task keeps in mind; words compared together; texts split together.
CACHED_WORDS, TOGETHER, TEXTS = 300_000, 20_000, 256
#: Texts whose lists of words are held at once while learning.
SLICE = 64
#: Entries of a table of all three letters; with more letters, a sorted list is searched.
DENSE = 1 << 22
#: Rows of one kernel table.
ROWS = 4096
COST, ROUNDS = 30.0, 6

#: Marks and digits are left out of words.
LEFT_OUT = dict.fromkeys(i for i in range(128) if not (chr(i).isalpha() or chr(i).isspace()))
#: Single letters with spaces between.
SPACED = re.compile(r"(?<!\S)[a-z](?:\s+[a-z]){2,}(?!\S)")
#: Behind a word that is compared, as one more letter: beginnings of words lack it.
END = "$"


def words_of(text: str | None) -> list[str]:
    """The words of a text: lower case, without marks and digits inside them. Letters
    spelled out with spaces are one word."""
    plain = (text or "").lower().translate(LEFT_OUT)
    words = plain.split()
    found = SPACED.findall(plain)
    return words + ["".join(run.split()) for run in found] if found else words


def _parts(word: str) -> list[str]:
    """The word with its end, if it isn't very long, and its windows, if it isn't short."""
    if len(word) < LETTERS:
        return [""]
    if len(word) <= WINDOW:
        return [word + END]
    windows = [word[i : i + WINDOW] for i in range(0, len(word) - WINDOW + 1, STEP)]
    windows.append(word[-WINDOW:] + END)
    return [word + END, *windows] if len(word) <= WHOLE else windows


def _all_parts(words: list[str]) -> tuple[list[str], np.ndarray]:
    """The parts of all words, and where those of each word begin."""
    parts = [_parts(word) for word in words]
    return [part for own in parts for part in own], np.cumsum([0, *map(len, parts[:-1])])


def _table(words: list[str]) -> np.ndarray:
    """Code points, one row a word, padded with zeros."""
    return np.array(words).view(np.uint32).reshape(len(words), -1)


def _kernel(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sums over common subsequences of LETTERS letters of DECAY to the letters that
    they span on both sides. Rows of padded words; ``right`` has one row or as many."""
    rows = max(len(left), len(right))
    if rows > ROWS:
        parts = [slice(start, start + ROWS) for start in range(0, rows, ROWS)]
        return np.concatenate([_kernel(left[part], right[part] if len(right) > 1 else right) for part in parts])
    width, length = left.shape[1], right.shape[1]
    same = [[(left[:, i] == right[:, j]) & (left[:, i] > 0) for j in range(length)] for i in range(width)]
    # ends[i][j]: chains of so many letters that end at i and j, without trailing gaps
    ends = [[DECAY**2 * same[i][j] for j in range(length)] for i in range(width)]
    for _ in range(LETTERS - 1):
        longer = [[None] * length for _ in range(width)]
        above = [np.zeros(rows)] * (length + 1)  # decayed sums over all earlier i, j
        for i in range(width):
            row = np.zeros(rows)
            now = [np.zeros(rows)] * (length + 1)
            for j in range(length):
                longer[i][j] = DECAY**2 * same[i][j] * above[j]
                row = DECAY * row + ends[i][j]
                now[j + 1] = DECAY * above[j + 1] + row
            above = now
        ends = longer
    return sum(value for row in ends for value in row) + np.zeros(rows)


def own_kernel(words: list[str]) -> np.ndarray:
    """The kernel of each word with itself."""
    found = np.zeros(len(words))
    by_length: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        by_length.setdefault(len(word), []).append(i)
    by_length.pop(0, None)
    for places in by_length.values():
        table = _table([words[i] for i in places])
        found[places] = _kernel(table, table)
    return found


class Landmarks:
    """Landmark words with the weights of their subsequences, by three letters."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        letters = sorted(set("".join(words)))
        self.size = len(letters) + 1
        self.codes = {ord(letter): i for i, letter in enumerate(letters, 1)}
        held: dict[int, np.ndarray] = {}
        for k, word in enumerate(words):
            own = [self.codes[ord(letter)] for letter in word]
            for i, j, last in combinations(range(len(own)), LETTERS):
                row = held.setdefault((own[i] * self.size + own[j]) * self.size + own[last], np.zeros(len(words)))
                row[k] += DECAY ** (last - i + 1)
        self.keys = np.array(sorted(held), np.int64)
        self.known = np.array(sorted(self.codes), np.uint32)
        self.places = None
        if self.size**3 <= DENSE:
            self.places = np.full(self.size**3, -1, np.int32)
            self.places[self.keys] = np.arange(len(self.keys))
        weights = np.array([held[key] for key in self.keys.tolist()]).reshape(len(held), len(words))
        norms = np.sqrt((weights**2).sum(axis=0))
        self.weights = (weights / np.where(norms > 0, norms, 1)).astype(np.float32)

    def _codes(self, table: np.ndarray) -> np.ndarray:
        places = np.searchsorted(self.known, table).clip(max=len(self.known) - 1)
        return np.where(self.known[places] == table, places + 1, 0).astype(np.int32 if self.places is not None else np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each three letters in ``keys``, or -1."""
        if self.places is not None:
            return self.places[keys]
        places = np.searchsorted(self.keys, keys).clip(max=len(self.keys) - 1)
        return np.where(self.keys[places] == keys, places, -1)

    def kernel(self, parts: list[str], weights: np.ndarray) -> np.ndarray:
        """Sums of ``weights`` (one row for each three letters in ``keys``) over the
        subsequences of each part, decayed, by the norm of the part. With ``self.weights``
        that is the normalised kernel with each landmark."""
        found = np.zeros((len(parts), *weights.shape[1:]), np.float32)
        by_length: dict[int, list[int]] = {}
        for i, part in enumerate(parts):
            by_length.setdefault(len(part), []).append(i)
        padded = np.concatenate([weights, np.zeros_like(weights[:1])])  # place -1 has none
        for length, places in by_length.items():
            if length < LETTERS or not len(self.keys):
                continue
            table = _table([parts[i] for i in places]).reshape(len(places), length)
            columns = np.ascontiguousarray(self._codes(table).T)
            sums = np.zeros((len(places), *weights.shape[1:]), np.float32)
            for i, j in combinations(range(length), 2):
                pair = (columns[i] * self.size + columns[j]) * self.size
                for last in range(j + 1, length):
                    sums += np.float32(DECAY ** (last - i + 1)) * padded[self._find(pair + columns[last])]
            norms = np.sqrt(_kernel(table, table)).astype(np.float32)
            found[places] = (sums.T / norms).T
        return found

    def similarities(self, words: list[str]) -> np.ndarray:
        """The normalised kernel of each word with each landmark, the largest of those
        of its parts. A word of fewer than three letters is like none."""
        parts, starts = _all_parts(words)
        rows = self.kernel(parts, self.weights)
        return np.maximum.reduceat(rows, starts, axis=0) if words else rows


class Machine(NamedTuple):
    """The SVM on Nyström features of words, and the slope and shift of probabilities."""

    landmarks: list[str]
    features: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, margin: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30))))


class Scorer:
    """The margins of words, remembered by a task. A word is as toxic as its worst part,
    a text as its worst word; one without words has only the bias."""

    def __init__(self, machine: Machine) -> None:
        self.machine, self.marks = machine, Landmarks(machine.landmarks)
        # The margin is linear in the kernel rows, so one weight for each three letters does.
        self.weights = (self.marks.weights @ (machine.features @ machine.weights)).astype(np.float32)
        self.known: dict[str, float] = {}

    def margins(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros(0)
        parts, starts = _all_parts(words)
        return np.maximum.reduceat(self.marks.kernel(parts, self.weights), starts) + self.machine.bias

    def _learn(self, words: set[str]) -> None:
        new = list(words.difference(self.known))
        if len(self.known) + len(new) > CACHED_WORDS:
            self.known = {}
            new = list(words)
        for start in range(0, len(new), TOGETHER):
            part = new[start : start + TOGETHER]
            self.known.update(zip(part, self.margins(part).tolist(), strict=True))

    def each(self, texts: list[str | None]) -> Iterator[float]:
        for start in range(0, len(texts), TEXTS):
            some = [set(words_of(text)) for text in texts[start : start + TEXTS]]
            self._learn(set().union(*some))
            for words in some:
                yield max(map(self.known.__getitem__, words), default=self.machine.bias)


def _svm(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """A linear SVM with squared hinge loss, by Newton steps; the last weight is the bias."""
    inputs = np.hstack([x, np.ones((len(x), 1))])
    weights = np.zeros(inputs.shape[1])
    ridge = np.eye(len(weights)) / COST
    ridge[-1, -1] = 1e-6
    for _ in range(30):
        inside = y * (inputs @ weights) < 1
        own = inputs[inside]
        new = np.linalg.solve(own.T @ own + ridge, own.T @ y[inside])
        if np.abs(new - weights).max() < 1e-9:
            break
        weights = new
    return weights[:-1], float(weights[-1])


def _logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make margins probabilities; targets are smoothed a little."""
    good, bad = labels.sum(), (1 - labels).sum()
    goal = np.where(labels > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    inputs, found = np.stack([margins, np.ones(len(margins))], axis=1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(inputs @ found, -30, 30)))
        curve = (inputs * (p * (1 - p))[:, None]).T @ inputs + 1e-6 * np.eye(2)
        found = found - np.linalg.solve(curve, inputs.T @ (p - goal) + 1e-6 * found)
        found = np.clip(found, -50, 50)
    return float(max(found[0], 0.0)), float(found[1])


def altered(word: str, others: list[str], rng: random.Random) -> str:
    """The word as it is, with one or two letters put in, or inside a longer word."""
    kind = rng.randrange(5)
    if kind == 4:
        return word
    if kind == 3 and others:
        return rng.choice(others)[:4] + word + rng.choice(others)[:4]
    letters = "".join(others) or "abcdefghijklmnopqrstuvwxyz"
    for _ in range(1 if kind < 2 else 2):
        at = rng.randrange(1, len(word))
        word = word[:at] + rng.choice(letters) + word[at:]
    return word


#: Scores without anything to tell by: no label, or one label only and that clean.
UNKNOWN = 0.05


def train(landmarks: list[str], rows: list[list[str]], labels: np.ndarray, insults: list[str] | None = None) -> Machine:
    """Fit on the worst words of each document, found anew after each round.

    ``rows`` has the words of each document that may be the worst. Labels mark
    documents: a toxic one is taken to have one toxic word at least, a clean one none.
    Altered copies of insults are toxic words, too, so that the margin leaves room for
    what such copies lose in likeness.

    With labels of one kind, or without landmarks, all texts score alike: as the
    labels are, or ``UNKNOWN`` without any, which is not toxic.
    """
    size = len(landmarks)
    if not size or not len(labels) or labels.min() == labels.max():
        base = (labels.sum() + 1) / (len(labels) + 2) if len(labels) else UNKNOWN
        return Machine(landmarks, np.eye(size), np.zeros(size), 0.0, 1.0, float(np.log(base / (1 - base))))
    marks = Landmarks(landmarks)
    values, vectors = np.linalg.eigh(marks.weights.T.astype(float) @ marks.weights + 1e-6 * np.eye(size))
    features = vectors @ np.diag(np.maximum(values, 1e-2) ** -0.5) @ vectors.T
    rng = random.Random(7)
    others = sorted({word for words, label in zip(rows, labels, strict=True) if not label for word in words})
    copies = [altered(word, others, rng) for word in insults or [] if len(word) >= LETTERS for _ in range(ALTERED)]
    in_row = [list(dict.fromkeys(part for word in words for part in _parts(word))) for words in rows]
    known = sorted({part for parts in in_row for part in parts})
    places = {part: i for i, part in enumerate(known)}
    held = [np.array([places[part] for part in parts], int) for parts in in_row]
    likeness = marks.kernel(known, marks.weights)
    kernel, margins = likeness @ features, likeness.max(axis=1, initial=0)
    toxic = labels > 0
    parts, starts = _all_parts(copies)
    likeness = marks.kernel(parts, marks.weights)
    ends = np.append(starts[1:], len(parts))
    best = [int(a + likeness[a:b].max(axis=1).argmax()) for a, b in zip(starts, ends, strict=True)] if copies else []
    virtual = likeness[best] @ features
    for _ in range(ROUNDS):
        worst = [own[np.argsort(-margins[own], kind="stable")[: 1 if bad else CLEAN_WORDS]] for own, bad in zip(held, toxic, strict=True)]
        bad = np.concatenate([own for own, t in zip(worst, toxic, strict=True) if t])
        good = np.unique(np.concatenate([own for own, t in zip(worst, toxic, strict=True) if not t]))
        none = np.zeros((1, size))  # what is like no landmark is clean
        x = np.concatenate([kernel[bad], virtual, kernel[good], none])
        y = np.append(np.ones(len(bad) + len(virtual)), -np.ones(len(good) + 1))
        weights, bias = _svm(x, y)
        margins = kernel @ weights + bias
    final = np.array([margins[own].max(initial=bias) for own in held])
    some = (virtual @ weights + bias)[::COPIES_OF_ONE]
    return Machine(landmarks, features, weights, bias, *_logistic(np.append(final, some), np.append(labels, np.ones(len(some))).astype(float)))


def _word_sets():
    """The words of a text, whole, and the beginnings of its longer words."""

    def begun(text: str | None) -> list[str]:
        words = {word[:LONGEST] for word in words_of(text) if len(word) >= LETTERS}
        begin = {word[:n] for word in words for n in BEGINNINGS if len(word) > n}
        return [word + END for word in sorted(words)] + sorted(begin)

    return _by_slices(lambda texts: [begun(text) for text in texts])


def _by_slices(words_of_texts: Callable[[list[str | None]], list[list[str]]]):
    """A column function from texts to words, a few texts at a time: lists of words as
    Python objects take many times the room of their texts."""
    kind = pa.list_(pa.string())

    @F.arrow_udf("array<string>")
    @releasing
    def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            slices = (batch.slice(start, SLICE).to_pylist() for start in range(0, len(batch), SLICE))
            yield pa.concat_arrays([pa.array([], kind), *(pa.array(words_of_texts(some), kind) for some in slices)])

    return of.asNondeterministic()


class Landmark(NamedTuple):
    word: str
    documents: int
    toxic: int


def choose_landmarks(sample: DataFrame, count: int) -> list[Landmark]:
    """The words, or beginnings of words, whose presence tells most about the label,
    commoner in toxic texts. Of several beginnings of one word in nearly the same
    documents, the longest counts, and a word itself instead of its beginning if most
    documents with the beginning have the word."""
    totals = sample.agg(F.count("*").alias("n"), F.sum("label").alias("toxic")).first()
    n, toxic = totals.n, totals.toxic or 0
    if not toxic or toxic == n:
        return []
    words = sample.select("label", F.explode(_word_sets()("text")).alias("word"))
    counts = words.groupBy("word").agg(F.sum("label").alias("a"), F.count("*").alias("df"))
    a, df = F.col("a").cast("double"), F.col("df").cast("double")

    def part(seen: Column, total: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / total)).otherwise(0.0)

    rate = toxic / n
    gain = part(a, df * rate) + part(df - a, df * (1 - rate))
    gain = gain + part(toxic - a, (n - df) * rate) + part(n - df - (toxic - a), (n - df) * (1 - rate))
    best = counts.where((a > df * rate) & (gain >= LEAST_GAIN)).select("word", "df", "a", gain.alias("gain"))
    rows = best.orderBy(F.desc(F.round("gain", 6)), F.desc(F.length("word")), "word").limit(8 * count).collect()
    chosen: list[Landmark] = []
    for row in rows:
        word, mark = row.word.removesuffix(END), Landmark(row.word, row.df, row.a)
        same = [m for m in chosen if m.word.startswith(word) or word.startswith(m.word.removesuffix(END))]
        begun = [m for m in same if not m.word.endswith(END) and mark.documents >= MOSTLY * m.documents]
        if begun and row.word.endswith(END):
            chosen[chosen.index(begun[0])] = mark
        elif len(chosen) < count and not any(abs(m.documents - row.df) <= 0.1 * m.documents for m in same):
            chosen.append(mark)
    return chosen


def _nearest_words(landmarks: list[str], most: int):
    """The different words of a text that are most like some landmark."""
    marks = Landmarks(landmarks)

    def nearest(texts: list[str | None]) -> list[list[str]]:
        rows = [sorted(set(words_of(text))) for text in texts]
        known = sorted(set().union(*rows))
        likeness: dict[str, float] = {}
        for start in range(0, len(known), ROWS):
            part = known[start : start + ROWS]
            likeness.update(zip(part, marks.similarities(part).max(axis=1).tolist(), strict=True))
        return [sorted(words, key=lambda word: -likeness[word])[:most] for words in rows]

    return _by_slices(nearest)


class Model(NamedTuple):
    """What scores texts; ``shared`` is its copy on the executors."""

    machine: Machine
    shared: object

    def score(self, text: Column) -> Column:
        """The probability that a text is toxic, from all its words, whatever its length. A null text is an empty one; equal texts score alike."""
        shared = self.shared

        @F.arrow_udf("double")
        @releasing
        def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            machine = shared.value
            known = Scorer(machine)
            for batch in texts:
                parts = (batch.slice(start, TEXTS).to_pylist() for start in range(0, len(batch), TEXTS))
                margins = [margin for part in parts for margin in known.each(part)]
                yield pa.array([machine.probability(margin) for margin in margins], pa.float64())

        return score.asNondeterministic()(text)


def fit(
    documents: DataFrame,
    labels: DataFrame,
    most: int = MOST_LABELLED,
    landmarks: int = LANDMARKS,
    words: int = MOST_WORDS,
) -> Model:
    """Learn from at most ``most`` labelled documents outside the held-out fold, and of
    each from the ``words`` that are most like landmarks.

    Other labels than 0 and 1 are no labels. A document that is repeated or has
    several labels counts once, with the larger one. Without labels, documents or a
    toxic label no text is judged toxic. Other columns are ignored.
    """
    sample = labelled_sample(documents, labels, "toxic", most)
    marks = choose_landmarks(sample, landmarks)
    names = [mark.word.removesuffix(END) for mark in marks]
    # A beginning stands beside the word that is no longer: that may be a clean one.
    names += [mark.word + END for mark in marks if not mark.word.endswith(END)]
    names = list(dict.fromkeys(names))
    insults = [mark.word[:-1] for mark in marks if mark.toxic >= INSULT * mark.documents and mark.word.endswith(END)]
    nearest = _nearest_words(names, words)("text") if marks else F.array().cast("array<string>")
    found = sample.select("label", nearest.alias("words")).toArrow()
    machine = train(names, found["words"].to_pylist(), np.asarray(found["label"]), insults)
    return Model(machine, documents.sparkSession.sparkContext.broadcast(machine))
