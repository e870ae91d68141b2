"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

A text is its set of different words; its features count, for each hashed character
n-gram (2 to 5 characters, word ends marked), the words that hold it, divided by the
square root of all counts. Each feature is scaled by the log ratio of its presence in
toxic and other labelled texts, and a logistic regression is fitted on the scaled
features. As a score is a sum over words, a worker remembers the sums of words.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from armorica.llm.common import named, octets, slices
from armorica.llm.langid import WORD, _spark_context

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 1 << 18
SHORTEST, LONGEST = 2, 5
# Labelled texts the classifier is fitted on, half of them toxic if there are as many.
SAMPLE_DOCS = 4_000
STEPS = 120
RATE = 0.5
PENALTY = 1e-5
CACHED_WORDS = 150_000
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def different_words(text: bytes) -> set[str]:
    return set(WORD.findall(text.decode("utf-8", "ignore").lower()))


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of words, and the word each belongs to; each bucket once a word."""
    text = "".join(f"<{word}>" for word in words)
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    sizes = np.array([len(word) + 2 for word in words])
    owner = np.repeat(np.arange(len(words)), sizes)
    found, whose = [], []
    rolled = np.zeros(len(codes), np.uint64)
    for n in range(1, LONGEST + 1):
        if len(codes) < n:
            break
        rolled = rolled[: len(codes) - n + 1] * _MULTIPLIER + codes[n - 1 :] + np.uint64(1)
        if n >= SHORTEST:
            inside = np.flatnonzero(owner[: len(rolled)] == owner[n - 1 :])
            mixed = (rolled[inside] ^ (rolled[inside] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            found.append((mixed >> np.uint64(46)).astype(np.int64))
            whose.append(owner[inside])
    pairs = np.unique(np.concatenate(whose) * BUCKETS + np.concatenate(found))
    return pairs % BUCKETS, pairs // BUCKETS


@dataclass
class Model:
    """Weight of each bucket (log ratio included) and the intercept."""

    weights: np.ndarray
    intercept: float


def _fit(group: pd.DataFrame) -> pd.DataFrame:
    """Texts and labels of the sample to one row of weights."""
    group = group.sort_values(["text", "label"], kind="stable")
    label = group["label"].to_numpy(float)
    places: dict[str, int] = {}
    sets = [[places.setdefault(word, len(places)) for word in different_words(text)] for text in group["text"]]
    row_of = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    word_of = np.array([x for words in sets for x in words], np.int64)
    bucket, owner = features(list(places)) if places else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    in_word = np.bincount(owner, minlength=len(places))
    # Presence of a bucket in a text: a word of the text holds it.
    starts = np.concatenate([[0], np.cumsum(in_word)])
    present = np.ones((2, BUCKETS))
    for row, words in enumerate(sets):
        if words:
            held = np.unique(np.concatenate([bucket[starts[w] : starts[w + 1]] for w in words]))
            present[int(label[row]), held] += 1
    toxic, other = label.sum(), len(label) - label.sum()
    ratio = np.log(present[1] / (toxic + 2)) - np.log(present[0] / (other + 2))
    scale = 1 / np.sqrt(np.maximum(1, np.bincount(row_of, in_word[word_of], minlength=len(sets))))
    balance = np.where(label > 0, len(label) / max(1, 2 * toxic), len(label) / max(1, 2 * other))
    weights, intercept = np.zeros(BUCKETS), 0.0
    squares, square = np.full(BUCKETS, 1e-8), 1e-8
    for _ in range(STEPS):
        by_word = np.bincount(owner, (weights * ratio)[bucket], minlength=len(places))
        margin = np.bincount(row_of, by_word[word_of], minlength=len(sets)) * scale + intercept
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - label) * balance / len(label)
        of_word = np.bincount(word_of, (error * scale)[row_of], minlength=len(places))
        slope = np.bincount(bucket, of_word[owner], minlength=BUCKETS) * ratio + PENALTY * weights
        squares += slope**2
        square += error.sum() ** 2
        weights -= RATE * slope / np.sqrt(squares)
        intercept -= RATE * error.sum() / np.sqrt(square)
    steep, shift = _calibrated(margin, label)
    return pd.DataFrame({"weights": [(weights * ratio * steep).astype("<f4").tobytes()], "intercept": [intercept * steep + shift]})


def _calibrated(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the margins whose logistic fits the labels best, by Newton steps with a slight penalty."""
    at = np.array([1.0, 0.0])
    terms = np.column_stack([margin, np.ones(len(margin))])
    for _ in range(30):
        chance = 1 / (1 + np.exp(-np.clip(terms @ at, -30, 30)))
        slope = terms.T @ (chance - label) + 1e-2 * (at - [1.0, 0.0])
        bend = (terms * (chance * (1 - chance))[:, None]).T @ terms + 1e-2 * np.eye(2)
        at = at - np.clip(np.linalg.solve(bend, slope), -2, 2)
    return float(at[0]), float(at[1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_docs: int = SAMPLE_DOCS,
) -> Model:
    """Model of a bounded sample of the documents with a text and a label of 0 or 1.

    The sample holds the labels of up to ``sample_docs`` ids, at most half of them of
    each label unless a label has fewer, in the order of a hash of the id; the ids, so
    bounded, are broadcast to the documents. Without documents of both labels every
    text gets the score 0.5.
    """
    rows = labels.select(named(id_col).alias("id"), named(label_col).cast("int").alias("label"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isin(0, 1)).distinct()
    numbers = {row["label"]: row["count"] for row in rows.groupBy("label").count().collect()}
    if len(numbers) < 2:
        return Model(np.zeros(BUCKETS, np.float32), 0.0)
    place = F.xxhash64(F.lit(7), "id")
    parts = []
    for label, other in ((0, 1), (1, 0)):
        bound = max(sample_docs // 2, sample_docs - numbers[other])
        parts.append(rows.filter(F.col("label") == label).orderBy(place, "id").limit(bound))
    sample = F.broadcast(parts[0].unionByName(parts[1]))
    texts = docs.select(named(id_col).alias("id"), octets(named(text_col)).alias("text")).filter(F.col("text").isNotNull())
    texts = texts.join(sample, "id").select("text", "label")
    fitted = texts.groupBy(F.lit(1).alias("one")).applyInPandas(_fit, "weights binary, intercept double").first()
    if fitted is None:
        return Model(np.zeros(BUCKETS, np.float32), 0.0)
    return Model(np.frombuffer(fitted["weights"], "<f4"), fitted["intercept"])


class Scorer:
    def __init__(self, model: Model) -> None:
        self._model = model
        self._places: dict[str, int] = {}
        self._all = np.zeros((0, 2))

    def _learn(self, words: list[str]) -> None:
        bucket, owner = features(words)
        sums = np.bincount(owner, self._model.weights[bucket].astype(np.float64), minlength=len(words))
        self._places.update(zip(words, range(len(self._all), len(self._all) + len(words)), strict=True))
        self._all = np.vstack([self._all, np.column_stack([sums, np.bincount(owner, minlength=len(words))])])

    def score(self, texts: list[bytes]) -> list[float]:
        found = [different_words(text) for text in texts]
        new = set().union(*found) - self._places.keys()
        if len(self._places) + len(new) > CACHED_WORDS:
            self.__init__(self._model)
            new = set().union(*found)
        if new:
            self._learn(sorted(new))
        out = []
        for words in found:
            at = np.sort(np.fromiter(map(self._places.__getitem__, words), np.int64, len(words)))
            total, number = self._all[at].sum(axis=0)
            margin = total / max(1.0, number) ** 0.5 + self._model.intercept
            out.append(float(1 / (1 + np.exp(-np.clip(margin, -30, 30)))))
        return out


def toxicity(text: Column, model: Model) -> Column:
    """Probability (0 to 1) that a text is toxic; null and empty texts get that of a text without words."""
    sent = _spark_context().broadcast(Scorer(model))

    @arrow_udf("double")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = sent.value
        for batch in batches:
            yield pa.array([x for texts in slices(batch, 1 << 20) for x in scorer.score(texts)], pa.float64())

    return compute(octets(text))


def score(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """All rows and columns, with the score in ``out_col`` (replaced if it exists)."""
    return docs.withColumn(out_col, toxicity(named(text_col), model))
