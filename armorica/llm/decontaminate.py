"""Benchmark passages in documents: a BM25 index of test items, searched with block-max bounds.

Test items are cut into units of at most 64 words and indexed once: per term, the units
that hold it and what it adds to their BM25 score, as part of the score a unit gives
itself; so a passage that holds a whole unit scores 1 or more. Units form blocks, and of
each term the index keeps the most it adds in a block.

Every document is cut into overlapping passages, so that any 64 consecutive words lie in
one. Passages whose terms cannot reach the threshold together are left out, then blocks
whose maxima cannot; only what is left is scored. An item found is confirmed if most of
the 5-word shingles of its question and of its answer stand in the document, an item of
fewer words if all of them stand there in a row.
"""

from __future__ import annotations

import io
import re
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from armorica.llm.common import give_back_memory, named, octets, slices
from armorica.llm.langid import _spark_context
from armorica.workspace import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNIT_WORDS = 64
PASSAGE_WORDS, STRIDE_WORDS = 128, 64
BLOCK_UNITS = 8
SHINGLE_WORDS = 5
THRESHOLD = 0.6
LEAST_OVERLAP = 0.5
K1, B = 1.2, 0.75
# Postings of one index, about; more make several, of which a worker opens one at a time.
POSTINGS_PER_INDEX = 2_000_000
# Postings looked at in one step; a passage has no more than its index.
POSTINGS_AT_ONCE = 1 << 21
_WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def shingles(words: list[str], size: int = SHINGLE_WORDS) -> set[tuple[str, ...]]:
    n = max(1, len(words) - size + 1) if words else 0
    return {tuple(words[i : i + size]) for i in range(n)}


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """Words up to the last question mark and after it; without both, the first and the second half of the words."""
    asked, mark, answered = text.rpartition("?")
    question, answer = words_of(asked), words_of(answered)
    if not (mark and question and answer):
        words = question + answer
        question, answer = words[: -(-len(words) // 2)], words[-(-len(words) // 2) :]
    return question, answer


def units_of(text: str) -> list[list[str]]:
    """The words of an item in parts of nearly equal length, at most 64 words each."""
    words = words_of(text)
    parts = -(-len(words) // UNIT_WORDS)
    return [words[len(words) * i // parts : len(words) * (i + 1) // parts] for i in range(parts)]


@dataclass
class Index:
    """Terms numbered by the most they add, ascending; postings by term, for units and for blocks."""

    terms: dict[str, int]
    most: np.ndarray  # of each term
    starts: np.ndarray  # of each term in units and gains, one more than terms
    units: np.ndarray  # ascending for each term
    gains: np.ndarray
    block_starts: np.ndarray
    blocks: np.ndarray
    block_gains: np.ndarray
    items: np.ndarray  # of each unit, a place in ids and texts
    ids: list
    texts: list[str]

    def candidates(self, texts: list[list[int]]) -> list[dict[int, float]]:
        """Of each text (numbers of its terms, -1 for others): items whose unit reaches the threshold in a passage, with the greatest score."""
        found: list[dict[int, float]] = [{} for _ in texts]
        passage_text, pairs = self._passages(texts)
        if not len(pairs):
            return found
        terms = len(self.most)
        passage, term = pairs // terms, pairs % terms
        # Only passages whose terms can reach the threshold together.
        bound = np.bincount(passage, self.most[term], minlength=len(passage_text))
        keep = bound[passage] >= THRESHOLD
        passage, term = passage[keep], term[keep]
        if len(passage):
            # Steps of whole passages, by the postings of their terms.
            postings = (np.diff(self.starts) + np.diff(self.block_starts))[term]
            starts = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
            step = np.cumsum(np.add.reduceat(postings, starts)) // POSTINGS_AT_ONCE
            borders = [*starts[np.r_[True, step[1:] != step[:-1]]], len(passage)]
            for first, last in zip(borders, borders[1:], strict=False):
                self._score(passage[first:last], term[first:last], passage_text, found)
        return found

    def _passages(self, texts: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """The text of each passage, and its different terms as passage * terms + term, ascending."""
        sizes = np.array([len(text) for text in texts], np.int64)
        number = np.maximum(1, -(-(sizes - PASSAGE_WORDS) // STRIDE_WORDS) + 1)
        base = np.cumsum(number) - number
        owner = np.repeat(np.arange(len(texts)), sizes)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        flat = np.fromiter((term for text in texts for term in text), np.int64, len(owner))
        known = flat >= 0
        flat, at, owner = flat[known], at[known], owner[known]
        pairs = []
        for back in range(-(-PASSAGE_WORDS // STRIDE_WORDS)):
            # A word lies in the passage that starts at its stride, and in those that start before.
            own = at // STRIDE_WORDS - back
            good = (own >= 0) & (own < number[owner])
            pairs.append((base[owner[good]] + own[good]) * max(1, len(self.most)) + flat[good])
        return np.repeat(np.arange(len(texts)), number), np.unique(np.concatenate(pairs))

    def _score(self, passage: np.ndarray, term: np.ndarray, passage_text: np.ndarray, found: list[dict[int, float]]) -> None:
        blocks = -(-len(self.items) // BLOCK_UNITS)
        # Terms are in the order of what they add: those before the first one at which the
        # sum reaches the threshold cannot make a unit reach it without a later one.
        sums = np.cumsum(self.most[term])
        starts = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
        before = np.repeat((sums - self.most[term])[starts], np.diff(np.r_[starts, len(passage)]))
        essential = sums - before >= THRESHOLD - 1e-6
        place, at = _expand(self.block_starts, term[essential])
        wanted = np.unique(passage[essential][place] * blocks + self.blocks[at])
        # The most the passage can get in these blocks, over all its terms.
        place, at = _expand(self.block_starts, term)
        spot, among = _find(wanted, passage[place] * blocks + self.blocks[at])
        most = np.bincount(spot[among], self.block_gains[at[among]], minlength=len(wanted))
        open_blocks = wanted[most >= THRESHOLD - 1e-6]
        _, hopeful = _find(np.unique(open_blocks // blocks), passage)
        passage, term = passage[hopeful], term[hopeful]
        place, at = _expand(self.starts, term)
        unit = self.units[at]
        _, good = _find(open_blocks, passage[place] * blocks + unit // BLOCK_UNITS)
        keys, inverse = np.unique(passage[place[good]] * len(self.items) + unit[good], return_inverse=True)
        scores = np.bincount(inverse, self.gains[at[good]], minlength=len(keys))
        for key, score in zip(keys[scores >= THRESHOLD], scores[scores >= THRESHOLD], strict=True):
            item = int(self.items[key % len(self.items)])
            text = found[passage_text[key // len(self.items)]]
            text[item] = max(text.get(item, 0.0), float(score))

    def hits(self, texts: list[bytes]) -> list[list[dict]]:
        """Confirmed items of each text, by place of the item."""
        plain = [words_of(text.decode("utf-8", "replace")) for text in texts]
        number = self.terms.get
        out = []
        for words, items in zip(plain, self.candidates([[number(word, -1) for word in words] for words in plain]), strict=True):
            held: dict[int, set] = {}
            sure = []
            for item in sorted(items):
                parts = self._parts(item)
                # All shingles of an item are of one length: five words, or all its words if they are fewer.
                size = len(next(iter(parts[0])))
                if size not in held:
                    held[size] = shingles(words, size)
                overlap = [len(part & held[size]) / len(part) if part else 1.0 for part in parts]
                if min(overlap) >= LEAST_OVERLAP:
                    row = {"item_id": self.ids[item], "score": items[item], "question": overlap[0], "answer": overlap[1]}
                    sure.append(row)
            out.append(sure)
        return out

    def _parts(self, item: int) -> tuple[set, set]:
        """Shingles that begin in the question and in the answer of an item."""
        question, answer = question_and_answer(self.texts[item])
        words = question + answer
        last = max(1, len(words) - SHINGLE_WORDS + 1)
        every = [tuple(words[i : i + SHINGLE_WORDS]) for i in range(last)]
        cut = min(len(question), max(1, last - 1))
        return set(every[:cut]), set(every[cut:])


def _expand(starts: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of the terms its postings: the place of the term, and of the posting."""
    sizes = starts[term + 1] - starts[term]
    place = np.repeat(np.arange(len(term)), sizes)
    within = np.arange(len(place)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return place, starts[term][place] + within


def _find(ordered: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each key among different ordered ones, and whether it is one of them."""
    if not len(ordered):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    spot = np.minimum(np.searchsorted(ordered, keys), len(ordered) - 1)
    return spot, ordered[spot] == keys


def _pack(group: pd.DataFrame) -> pd.DataFrame:
    """Rows (unit of an item, term, gain) of one index to its arrays."""
    group = group.sort_values(["item", "part", "term"], kind="stable")
    keys = list(zip(group["item"], group["part"], strict=True))
    unit_keys = dict.fromkeys(keys)
    numbers = {key: n for n, key in enumerate(unit_keys)}
    unit = np.array([numbers[key] for key in keys])
    most = group.groupby("term")["gain"].max().sort_values(kind="stable")
    term = group["term"].map({t: n for n, t in enumerate(most.index)}).to_numpy()
    ranked = np.lexsort((unit, term))
    unit, term, gain = unit[ranked], term[ranked], group["gain"].to_numpy()[ranked]
    keyed = term.astype(np.int64) * (1 << 32) + unit // BLOCK_UNITS
    first = np.flatnonzero(np.r_[True, keyed[1:] != keyed[:-1]])
    buffer = io.BytesIO()
    np.savez(
        buffer,
        most=most.to_numpy(),
        starts=np.searchsorted(term, np.arange(len(most) + 1)),
        units=unit,
        gains=gain,
        block_starts=np.searchsorted(keyed[first] >> 32, np.arange(len(most) + 1)),
        blocks=unit[first] // BLOCK_UNITS,
        block_gains=np.maximum.reduceat(gain, first),
        unit_items=np.array([item for item, _ in unit_keys]),
    )
    return pd.DataFrame({"terms": [list(most.index)], "arrays": [buffer.getvalue()]})


def _unit_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [
            (item, part, term, unit.count(term), len(unit))
            for item, text in zip(batch["item"], batch["text"], strict=True)
            for part, unit in enumerate(units_of(text))
            for term in sorted(set(unit))
        ]
        yield pd.DataFrame(rows, columns=["item", "part", "term", "n", "words"])


def indexes(
    benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", postings_per_index: int = POSTINGS_PER_INDEX
) -> Iterator[Broadcast]:
    """Broadcast indexes of all items with words, each of about ``postings_per_index`` postings.

    BM25's document counts and lengths are those of the whole benchmark. Equal texts of
    different ids are different items; rows without text or words give none. The driver
    holds one index at a time.
    """
    rows = benchmark.select(named(id_col).alias("id"), named(text_col).alias("text")).filter(F.col("text").isNotNull()).distinct()
    rows = rows.withColumn("item", F.xxhash64("id", "text"))
    terms = materialise(rows.select("item", "text").mapInPandas(_unit_terms, "item bigint, part int, term string, n int, words int"))
    whole = terms.select("item", "part", "words").distinct().agg(F.count(F.lit(1)).alias("units"), F.avg("words").alias("words")).first()
    if not whole["units"]:
        return
    parts = max(1, -(-terms.count() // postings_per_index))
    among = terms.groupBy("term").agg(F.count(F.lit(1)).alias("held"))
    rarity = F.log1p((F.lit(whole["units"]) - F.col("held") + 0.5) / (F.col("held") + 0.5))
    length = 1 - B + B * F.col("words") / whole["words"]
    gains = terms.join(among, "term").withColumn("gain", rarity * F.col("n") * (K1 + 1) / (F.col("n") + K1 * length))
    own = gains.groupBy("item", "part").agg(F.sum("gain").alias("own"))
    gains = materialise(gains.join(own, ["item", "part"]).select("item", "part", "term", (F.col("gain") / F.col("own")).alias("gain")))
    for part in range(parts):
        mine = F.pmod(F.xxhash64("item"), F.lit(parts)) == part
        packed = gains.filter(mine).groupBy(F.lit(part).alias("index")).applyInPandas(_pack, "terms array<string>, arrays binary").first()
        if packed is None:
            continue
        items = {row["item"]: (row["id"], row["text"]) for row in rows.filter(mine).select("item", "id", "text").collect()}
        with np.load(io.BytesIO(packed["arrays"])) as arrays:
            held = dict(arrays)
        places = {item: n for n, item in enumerate(sorted(items))}
        held["items"] = np.array([places[item] for item in held.pop("unit_items").tolist()])
        yield _spark_context().broadcast(
            Index(
                {term: n for n, term in enumerate(packed["terms"])},
                ids=[items[item][0] for item in sorted(items)],
                texts=[items[item][1] for item in sorted(items)],
                **held,
            )
        )


def _search(parts: list[Broadcast], id_type: DataType) -> Callable:
    @arrow_udf(_hits_type(id_type))
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(
            pa.struct([("item_id", to_arrow_type(id_type)), ("score", pa.float64()), ("question", pa.float64()), ("answer", pa.float64())])
        )
        for batch in batches:
            rows: list[list[dict]] = [[] for _ in range(len(batch))]
            for part in parts:
                index, at = part.value, 0
                for texts in slices(batch, 1 << 20):
                    for hits in index.hits(texts):
                        rows[at].extend(hits)
                        at += 1
                if len(parts) > 1 and hasattr(part, "_path"):
                    # Forget it: the next use opens it again from the executor's copy on disk (none if encrypted).
                    del index, part._value
            yield pa.array(rows, kind)
        give_back_memory()

    return search


def _hits_type(id_type: DataType) -> str:
    return f"array<struct<item_id:{id_type.simpleString()},score:double,question:double,answer:double>>"


def contamination(text: Column, benchmark: DataFrame, id_col: str = "item_id", **options) -> Column:
    """Array of the test items a text holds: ``item_id``, ``score``, ``question``, ``answer`` (overlaps, 0 to 1).

    ``score`` is the greatest BM25 score of a passage for a part of the item, 1 for one
    that holds the part. Null and empty texts, and an empty benchmark, give an empty
    array. Ids of items keep their type, numbers or texts. Items come in the order of a
    hash. A benchmark of several indexes is searched one index after the other, for
    each batch of documents.
    """
    id_type = benchmark.select(named(id_col)).schema[0].dataType
    parts = list(indexes(benchmark, id_col, **options))
    return _search(parts, id_type)(octets(text)) if parts else F.array().cast(_hits_type(id_type))


def contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", out_col: str = "items", **options) -> DataFrame:
    """All rows and columns, with the test items each text holds in ``out_col`` (replaced if it exists)."""
    return docs.withColumn(out_col, contamination(named(text_col), benchmark, **options))
