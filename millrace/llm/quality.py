"""Quality classifier: random-indexing word vectors, pooled, and a small network."""

import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import ARROW_ROWS, TEXT_ROWS, labelled_sample, map_batches, releasing
from millrace.sources.session import session_settings

#: Words and runs of marks are tokens. Each falls into one of these buckets by a hash.
TOKEN = re.compile(r"\w+|[^\w\s]+")
BUCKETS, SIZE, SPARSE, WINDOW = 16_384, 64, 2, 2
#: Numbers that a document is pooled to.
POOLED = 2 * SIZE + 1
#: Labelled documents that the network may learn from, at most.
MOST_LABELLED = 20_000
#: Tokens that a task keeps the buckets of.
CACHED_TOKENS = 200_000
HIDDEN, ROUNDS, STEP, DECAY, SHARE = 32, 15, 0.01, 1e-3, 0.85
#: Tasks that first add up the vectors of all others, for each bucket.
SALTS = 16


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the few components of each bucket's index vector."""
    random = np.random.default_rng(6)
    places = np.argsort(random.random((BUCKETS + 1, SIZE)), axis=1)[:, :SPARSE]
    signs = random.choice([-1.0, 1.0], (BUCKETS + 1, SPARSE))
    signs[BUCKETS] = 0  # the end of a text
    return places, signs


PLACES, SIGNS = _index_vectors()
_BUCKET_OF: dict[str, int] = {}


def buckets(text: str | None) -> np.ndarray:
    """The bucket of each token of a text."""
    tokens = TOKEN.findall(text or "")
    new = set(tokens).difference(_BUCKET_OF)
    if len(_BUCKET_OF) + len(new) > CACHED_TOKENS:
        _BUCKET_OF.clear()
        new = set(tokens)
    for token in new:
        _BUCKET_OF[token] = zlib.crc32(token.encode()) % BUCKETS
    return np.fromiter(map(_BUCKET_OF.__getitem__, tokens), np.int64, len(tokens))


def add_contexts(sums: np.ndarray, texts: list[np.ndarray]) -> None:
    """Add to each token's vector the index vectors of the tokens around it."""
    gap = np.full(WINDOW, BUCKETS)
    row = np.concatenate([part for text in texts for part in (text, gap)])
    for step in range(1, WINDOW + 1):
        for own, other in ((row[:-step], row[step:]), (row[step:], row[:-step])):
            for k in range(SPARSE):
                flat = own * SIZE + PLACES[other, k]
                sums += np.bincount(flat, SIGNS[other, k], sums.size).reshape(sums.shape)


def _texts(batches: Iterator[pa.Array]) -> Iterator[list[str | None]]:
    """The texts of each batch. When they end, a task forgets the buckets of tokens, so
    that a worker that goes on with other work has the memory."""
    try:
        for batch in batches:
            yield batch.to_pylist()
    finally:
        _BUCKET_OF.clear()


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = np.zeros((BUCKETS + 1, SIZE))
    waiting, size = [], 0
    for texts in _texts(batch["text"] for batch in batches):
        for text in texts:
            waiting.append(buckets(text))
            size += len(waiting[-1])
            if size > 200_000:
                add_contexts(sums, waiting)
                waiting, size = [], 0
    if waiting:
        add_contexts(sums, waiting)
    yield from _rows_of(sums)


def _rows_of(sums: np.ndarray) -> Iterator[pa.RecordBatch]:
    salt = TaskContext.get().partitionId() % SALTS
    some = np.flatnonzero(sums[:BUCKETS].any(axis=1))
    for start in range(0, len(some), 2000):
        part = some[start : start + 2000]
        vectors = [row.tobytes() for row in sums[part].astype("<i8")]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(np.full(len(part), salt, np.int32)), pa.array(vectors, pa.binary())],
            names=["bucket", "salt", "vector"],
        )


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = np.zeros((BUCKETS + 1, SIZE))
    for batch in batches:
        if len(batch):
            rows = np.frombuffer(b"".join(batch["vector"].to_pylist()), "<i8").reshape(-1, SIZE)
            np.add.at(sums, np.asarray(batch["bucket"]), rows)
    yield from _rows_of(sums)


def word_vectors(documents: DataFrame) -> np.ndarray:
    """A unit vector for each bucket, from the contexts of all tokens of all texts.

    The table has a fixed size. Tasks add up their part of it; the parts meet in two
    steps, so that no task reads the parts of all others.
    """
    schema = "bucket int, salt int, vector binary"
    parts = map_batches(documents.select("text"), _contexts, schema)
    parts = map_batches(parts.repartition("salt", "bucket"), _summed, schema)
    parts = map_batches(parts.repartition("bucket"), _summed, schema)
    sums = np.zeros((BUCKETS, SIZE))
    with session_settings(documents.sparkSession, {ARROW_ROWS: str(TEXT_ROWS)}):
        table = parts.select("bucket", "vector").toArrow()
    if len(table):
        rows = np.frombuffer(b"".join(table["vector"].to_pylist()), "<i8").reshape(-1, SIZE)
        sums[np.asarray(table["bucket"])] = rows
    vectors = np.sign(sums) * np.log1p(np.abs(sums))
    return (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(text: str | None, vectors: np.ndarray) -> np.ndarray:
    """The vectors of a text's tokens as one: their mean, their spread in each
    component, and how alike neighbours are. Zero without tokens."""
    own = buckets(text)
    n = len(own)
    if not n:
        return np.zeros(POOLED, np.float32)
    total, squares, alike = np.zeros(SIZE), np.zeros(SIZE), 0.0
    for start in range(0, n, 10_000):
        part = vectors[own[start : start + 10_001]]  # one more, for the last neighbour
        alike += float(np.einsum("ij,ij->", part[1:], part[:-1]))
        part = part[:10_000]
        total += part.sum(axis=0, dtype=np.float64)
        squares += np.einsum("ij,ij->j", part, part)
    mean = total / n
    spread = np.sqrt(np.maximum(squares / n - mean**2, 0))
    return np.concatenate([mean, spread, [alike / max(1, n - 1)]]).astype(np.float32)


class Network(NamedTuple):
    """Two layers on standardised inputs; probabilities divided by a temperature."""

    centre: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    temperature: float

    def logits(self, inputs: np.ndarray) -> np.ndarray:
        inner = np.tanh((inputs - self.centre) / self.scale @ self.hidden + self.hidden_bias)
        return inner @ self.out + self.out_bias

    def probabilities(self, inputs: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(inputs) / self.temperature, -30, 30)))


def train(inputs: np.ndarray, labels: np.ndarray, seed: int = 6) -> Network:
    """Fit the weights on most rows and the temperature on the rest.

    Rows of one kind only, or no rows, give the share of good rows, one half if
    there are none, as every probability.
    """
    n, size = inputs.shape
    good = (labels.sum() + 1) / (n + 2)
    bias = float(np.log(good / (1 - good)))
    if n < 10 or labels.min() == labels.max():
        return Network(np.zeros(size), np.ones(size), np.zeros((size, 1)), np.zeros(1), np.zeros(1), bias, 1.0)
    random = np.random.default_rng(seed)
    order = random.permutation(n)
    fit, rest = order[: int(n * SHARE)], order[int(n * SHARE) :]
    centre, scale = inputs[fit].mean(axis=0), inputs[fit].std(axis=0) + 1e-6
    x, y = (inputs[fit] - centre) / scale, labels[fit].astype(float)
    weights = [random.normal(0, size**-0.5, (size, HIDDEN)), np.zeros(HIDDEN), random.normal(0, HIDDEN**-0.5, HIDDEN), np.array(bias)]
    slow, square, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(ROUNDS):
        shuffled = random.permutation(len(x))
        for start in range(0, len(x), 128):
            part = shuffled[start : start + 128]
            inner = np.tanh(x[part] @ weights[0] + weights[1])
            wrong = 1 / (1 + np.exp(-np.clip(inner @ weights[2] + weights[3], -30, 30))) - y[part]
            back = np.outer(wrong, weights[2]) * (1 - inner**2)
            slopes = [x[part].T @ back, back.sum(axis=0), inner.T @ wrong, wrong.sum()]
            step += 1
            for i, slope in enumerate(slopes):
                slope = slope / len(part) + DECAY * weights[i]
                slow[i] = 0.9 * slow[i] + 0.1 * slope
                square[i] = 0.999 * square[i] + 0.001 * slope**2
                weights[i] = weights[i] - STEP * (slow[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.999**step)) + 1e-8)
    net = Network(centre, scale, weights[0], weights[1], weights[2], float(weights[3]), 1.0)
    logits, y = net.logits(inputs[rest]), labels[rest]
    heats = np.geomspace(0.25, 8, 61)
    losses = [np.logaddexp(0, np.where(y > 0, -1, 1) * logits / heat).mean() for heat in heats]
    return net._replace(temperature=float(heats[int(np.argmin(losses))]))



class Model(NamedTuple):
    """What scores texts; ``shared`` is its copy on the executors."""

    vectors: np.ndarray
    network: Network
    shared: object

    def score(self, text: Column) -> Column:
        """The probability that a text is good. A null text is an empty one."""
        shared = self.shared

        @F.arrow_udf("double")
        @releasing
        def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            vectors, network = shared.value
            for batch in _texts(texts):
                rows = [pooled(text, vectors) for text in batch]
                yield pa.array(network.probabilities(np.array(rows).reshape(-1, POOLED).astype(float)))

        return score.asNondeterministic()(text)


def _features(shared):
    @F.arrow_udf("array<float>")
    @releasing
    def features(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in _texts(texts):
            yield pa.array([pooled(text, shared.value) for text in batch], pa.list_(pa.float32()))

    return features.asNondeterministic()


def fit(documents: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Model:
    """Word vectors from all documents, the network from at most ``most`` labelled ones
    outside the held-out fold. Other labels than 0 and 1 are no labels."""
    context = documents.sparkSession.sparkContext
    vectors = word_vectors(documents)
    sample = labelled_sample(documents, labels, "quality", most)
    table = sample.select("label", _features(context.broadcast(vectors))("text").alias("x")).toArrow()
    inputs = np.array(table["x"].to_pylist(), float).reshape(-1, POOLED)
    order = np.lexsort(inputs.T)  # rows come in any order; learning doesn't depend on it
    network = train(inputs[order], np.asarray(table["label"])[order] if len(table) else np.zeros(0))
    return Model(vectors, network, context.broadcast((vectors, network)))
