"""URL filter: rules first, then a ratio of character language models."""

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import map_batches

#: Symbols of the models: padding, end, any digit, any other, letters, marks.
MARKS = "/.-_:?#=&%+~"
SYMBOLS = 4 + 26 + len(MARKS)
#: Longest context, in characters. All contexts fit in SYMBOLS ** (ORDER + 1) numbers.
ORDER = 3
#: Ranges of the score that are counted to set the threshold.
BINS = 2000


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


def _codes() -> np.ndarray:
    table = np.full(256, 3, np.int64)
    for digit in b"0123456789":
        table[digit] = 2
    for i in range(26):
        table[ord("a") + i] = table[ord("A") + i] = 4 + i
    for i, mark in enumerate(MARKS):
        table[ord(mark)] = 30 + i
    return table


CODES = _codes()


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z) and path; both empty for null or without ``://``."""
    whole = F.coalesce(url, F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.regexp_extract(whole, pattern, 1), upper, lower), F.regexp_extract(whole, pattern, 2)


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The place in ``rules`` of the longest rule that fits, or null."""
    order = sorted(range(len(rules)), key=lambda i: -len(rules[i].host + rules[i].path))
    chosen = F.lit(None).cast("int")
    for i in reversed(order):
        rule = rules[i]
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chosen = F.when(fits, F.lit(i)).otherwise(chosen)
    return chosen


def grams(url: str | None) -> np.ndarray:
    """The place of each character of a url with its context, in a table of counts."""
    codes = CODES[np.frombuffer((url or "").encode(), np.uint8)]
    codes = np.concatenate([np.zeros(ORDER, np.int64), codes, [1]])
    place = codes[: len(codes) - ORDER]
    for k in range(1, ORDER + 1):
        place = place * SYMBOLS + codes[k : len(codes) - ORDER + k]
    return place


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, SYMBOLS ** (ORDER + 1)), np.int64)
    for batch in batches:
        for url, accepted in zip(batch["url"].to_pylist(), batch["accepted"].to_pylist(), strict=True):
            np.add.at(counts[int(accepted)], grams(url), 1)
    kind, place = np.nonzero(counts)
    for start in range(0, len(kind), 100_000):
        part = slice(start, start + 100_000)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind[part]), pa.array(place[part]), pa.array(counts[kind[part], place[part]])],
            names=["kind", "place", "n"],
        )


def smoothed(counts: np.ndarray) -> np.ndarray:
    """Log probabilities of a symbol behind each longest context.

    A context's own frequencies are mixed with those of the next shorter context,
    the more the fewer different symbols it has been followed by (Witten and Bell),
    down to even chances: unseen contexts count as long as they are known.
    """
    chances = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in range(ORDER + 1):
        own = counts.reshape(-1, SYMBOLS**order, SYMBOLS).sum(axis=0)
        total, kinds = own.sum(axis=1, keepdims=True), (own > 0).sum(axis=1, keepdims=True)
        # the shorter context is the longer one without its first symbol
        shorter = np.tile(chances.reshape(-1, SYMBOLS), (SYMBOLS if order else 1, 1))
        chances = np.where(total > 0, (own + kinds * shorter) / np.maximum(total + kinds, 1), shorter)
    return np.log(chances).astype(np.float32).reshape(-1)


def _score(ratio):
    @F.arrow_udf("double")
    def score(urls: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in urls:
            yield pa.array([float(ratio.value[grams(url)].mean(dtype=np.float64)) for url in batch.to_pylist()], pa.float64())

    return score.asNondeterministic()


class UrlModel(NamedTuple):
    """log P(accepted) - log P(rejected) for each context and character, and the
    mean of it from which a url is accepted."""

    ratio: np.ndarray
    threshold: float


def fit(urls: DataFrame) -> UrlModel:
    """Learn from the columns ``url`` and ``accepted``.

    Every url is counted, a fifth of them (by a hash of the url) only for the
    threshold: the one at which the shares of accepted and of rejected urls that are
    judged right add up to most. Without urls of both kinds the ratio is what is
    known of the one, and the threshold 0. The table of counts has a fixed size.
    """
    spark = urls.sparkSession
    # copies of a url are one url, so one hot url doesn't outweigh the rest
    urls = urls.where(F.col("url").isNotNull() & F.col("accepted").isNotNull()).distinct()
    fold = F.pmod(F.xxhash64("url"), F.lit(5)) == 0
    counted = map_batches(urls.where(~fold), _count, "kind long, place long, n long")
    counts = np.zeros((2, SYMBOLS ** (ORDER + 1)), np.int64)
    table = counted.groupBy("kind", "place").agg(F.sum("n").alias("n")).toArrow()
    counts[np.asarray(table["kind"]), np.asarray(table["place"])] = np.asarray(table["n"])
    ratio = smoothed(counts[1]) - smoothed(counts[0])
    shared = spark.sparkContext.broadcast(ratio)
    scored = urls.where(fold).select("accepted", _score(shared)("url").alias("score"))
    low, high = -8.0, 8.0
    bin_ = F.least(F.greatest(F.floor((F.col("score") - low) * BINS / (high - low)), F.lit(0)), F.lit(BINS - 1))
    seen = np.zeros((2, BINS))
    for row in scored.groupBy("accepted", bin_.alias("bin")).count().collect():
        seen[int(row.accepted), row.bin] = row["count"]
    totals = seen.sum(axis=1)
    if not totals.all():
        return UrlModel(ratio, 0.0)
    below = np.append(0, np.cumsum(seen[0])) / totals[0]
    above = 1 - np.append(0, np.cumsum(seen[1])) / totals[1]
    best = np.flatnonzero(below + above >= (below + above).max() - 1e-12)
    return UrlModel(ratio, low + float(best.mean()) * (high - low) / BINS)


def judge_urls(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``score`` per page.

    A rule fits its host and all subdomains if the path starts with the rule's; the
    longest rule decides. Other urls are allowed if the mean log-likelihood ratio of
    their characters, from models of the urls that rules allow and block, reaches
    the calibrated threshold. A null or empty url has no host and path, and is
    judged by the models as an empty text. Repeated rows and null ids are kept,
    other columns ignored; an empty table gives an empty result.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("number", best_rule(F.col("host"), F.col("path"), rules))
    names = F.array(*(F.lit(rule.host + rule.path) for rule in rules))
    verdicts = F.array(*(F.lit(rule.verdict) for rule in rules))
    ruled = rows.withColumn("ruled", F.get(verdicts, "number"))
    model = fit(ruled.where("ruled is not null").select("url", (F.col("ruled") == "allow").alias("accepted")))
    shared = pages.sparkSession.sparkContext.broadcast(model.ratio)
    scored = ruled.withColumn("score", _score(shared)("url"))
    by_model = F.when(F.col("score") >= model.threshold, "allow").otherwise("block")
    return scored.select(
        "page_id",
        "host",
        "path",
        F.get(names, "number").alias("rule"),
        F.coalesce("ruled", by_model).alias("verdict"),
        "score",
    )
