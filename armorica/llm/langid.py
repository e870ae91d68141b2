"""Language identification by interpolated Kneser-Ney models of characters.

Per language: counts of 5-character sequences over all labelled texts, words padded on
the left and closed on the right; below the highest order, the number of different
characters seen before a sequence. Probabilities are interpolated down to a uniform
distribution and kept, with the weight each context leaves to the next lower order. Every
sequence is kept; all of this is joins and aggregates.

A model of bounded size is sent to the workers as arrays of 64-bit hashes in ascending
order. A larger one stays in the shared folder: the different words of the texts are
scored by joins with it, and summed back per text. Results are the same, to rounding.

A text gets the language of lowest cross-entropy per character, and is rejected if that
is beyond what labelled texts of this language show.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from armorica.llm.common import give_back_memory, named, octets, slices
from armorica.workspace import materialise, new_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ORDER = 5
PAD, END = "\x02", "\x03"
# Sequences and contexts of all orders and languages, 12 bytes each, up to which workers get the model.
SENT_ENTRIES = 4_000_000
# Keys with more than this part of the rows are joined by broadcast: no more than its inverse.
HOT_PART = 1e-4
# Beyond the calibrated quantile, in nats a character, plus more for short texts.
QUANTILE, MARGIN, SHORT_MARGIN = 0.999, 0.8, 6.0
# Characters after which the score of a language is no longer sharpened.
SCORED_CHARS = 40
CACHED_WORDS = 150_000
# Different words, and sequences, that a task counts before it hands them on.
COUNTED_WORDS, COUNTED_SEQUENCES = 100_000, 300_000
UNKNOWN = "und"
# Runs of word characters that are no decimal digits.
WORD = re.compile(r"[^\W\d_]+")
_MULTIPLIER = 0x9E3779B97F4A7C15


def words_of(text: bytes) -> list[str]:
    """Runs of letters, in lower case."""
    found = WORD.findall(text.decode("utf-8", "ignore").lower())
    if "".join(found).isalpha():
        return found
    # Some word characters are neither letters nor decimal digits, such as "½".
    return [part for word in found for part in "".join([char if char.isalpha() else " " for char in word]).split()]


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def hashed(codes: np.ndarray) -> list[np.ndarray]:
    """Hash of the last k characters for k = 0 ... n, of rows of n code points."""
    out = [np.zeros(len(codes), np.uint64)]
    for k in range(1, codes.shape[1] + 1):
        out.append(_mixed(out[-1] * np.uint64(_MULTIPLIER) + codes[:, codes.shape[1] - k].astype(np.uint64) + np.uint64(k)))
    return out


def sequences(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All 5-character sequences of padded words as code points, and the word each belongs to."""
    text = "".join(PAD * (ORDER - 1) + word + END for word in words)
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    rows = np.lib.stride_tricks.sliding_window_view(codes, ORDER)
    ends = np.array([len(word) + 1 for word in words])
    at = np.repeat(np.cumsum(ends + ORDER - 1) - ends - ORDER + 1, ends) + _counting(ends)
    return rows[at], np.repeat(np.arange(len(words)), ends)


def _counting(sizes: np.ndarray) -> np.ndarray:
    """0 ... n - 1 for each size n, one after the other."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


@dataclass
class Model:
    """Per language and order: ascending hashes with log probabilities, and of contexts with log weights of the lower order."""

    languages: list[str]
    grams: list[list[tuple[np.ndarray, np.ndarray]]]
    contexts: list[list[tuple[np.ndarray, np.ndarray]]]
    uniform: float
    limits: dict[str, float]

    def log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        """Of the last character of each sequence given those before: a column per language."""
        whole, before = hashed(codes), hashed(codes[:, :-1])
        out = np.zeros((len(codes), len(self.languages)))
        for place in range(len(self.languages)):
            left = np.arange(len(codes))
            weight = np.zeros(len(codes))
            for k in range(ORDER, 0, -1):
                known, at = _find(self.grams[place][k - 1][0], whole[k][left])
                out[left[known], place] = weight[left[known]] + self.grams[place][k - 1][1][at[known]]
                left = left[~known]
                if not len(left):
                    break
                known, at = _find(self.contexts[place][k - 1][0], before[k - 1][left])
                weight[left[known]] += self.contexts[place][k - 1][1][at[known]]
            out[left, place] = weight[left] + self.uniform
        return out


def _find(ascending: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(ascending):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(ascending, wanted), len(ascending) - 1)
    return ascending[at] == wanted, at


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (language, text) to counts of 5-character sequences, summed over as many rows as memory allows."""
    words: dict[str, Counter] = {}
    sums: dict[tuple[str, str], int] = {}

    def fold() -> None:
        for language, counts in words.items():
            for word, n in counts.items():
                padded = PAD * (ORDER - 1) + word + END
                for i in range(len(word) + 1):
                    key = (language, padded[i : i + ORDER])
                    sums[key] = sums.get(key, 0) + n
        words.clear()

    def counted() -> pa.RecordBatch:
        languages, found = zip(*sums.keys(), strict=True) if sums else ((), ())
        columns = [pa.array(languages, pa.string()), pa.array(found, pa.string()), pa.array(sums.values(), pa.int64())]
        sums.clear()
        return pa.RecordBatch.from_arrays(columns, names=["language", "sequence", "n"])

    for batch in batches:
        for language, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            words.setdefault(language, Counter()).update(words_of(text.as_py()))
            if sum(map(len, words.values())) > COUNTED_WORDS:
                fold()
            if len(sums) > COUNTED_SEQUENCES:
                yield counted()
    fold()
    yield counted()
    give_back_memory()


@dataclass
class StoredModel:
    """A model beyond what workers are sent: per order rows (sequence, logs by place of the language)."""

    languages: list[str]
    grams: list[DataFrame]
    contexts: list[DataFrame]
    uniform: float
    limits: dict[str, float]

    def log_probabilities(self, wanted: DataFrame) -> DataFrame:
        """Rows (sequence, logs) of different 5-character sequences, logs in the order of the languages."""
        levels = [wanted.select("sequence")]
        for _ in range(ORDER - 1):
            levels.insert(0, materialise(levels[0].select(F.substring("sequence", 2, ORDER).alias("sequence")).distinct()))
        places = F.sequence(F.lit(0), F.lit(len(self.languages) - 1))
        known = None
        for k, level in enumerate(levels, 1):
            shorter = F.substring("sequence", 2, ORDER).alias("shorter")
            rows = level.select("sequence", F.substring("sequence", 1, k - 1).alias("context"), shorter)
            rows = rows.join(self.grams[k - 1].withColumnRenamed("logs", "gram"), "sequence", "left")
            rows = rows.join(self.contexts[k - 1].select(F.col("sequence").alias("context"), F.col("logs").alias("weight")), "context", "left")
            if known is not None:
                rows = rows.join(known.select(F.col("sequence").alias("shorter"), F.col("logs").alias("below")), "shorter")
            else:
                rows = rows.withColumn("below", F.transform(places, lambda _: F.lit(self.uniform)))

            def log(at: Column) -> Column:
                weight = F.coalesce(F.try_element_at("weight", at), F.lit(0.0))
                return F.coalesce(F.try_element_at("gram", at), weight + F.get("below", at))

            known = materialise(rows.select("sequence", F.transform(places, log).alias("logs")))
        return known


def _levels(counts: DataFrame) -> list[DataFrame]:
    """Rows (language, sequence, n) of each order, the first one first."""
    levels = [counts]
    for _ in range(ORDER - 1):
        # What begins at the padding is preceded by nothing else: counts stay as they are.
        n = F.when(F.substring("sequence", 2, 1) == PAD, F.col("n")).otherwise(1)
        shorter = levels[0].select("language", F.substring("sequence", 2, ORDER).alias("sequence"), n.alias("n"))
        levels.insert(0, materialise(shorter.groupBy("language", "sequence").agg(F.sum("n").alias("n"))))
    return levels


def _smoothed(levels: list[DataFrame], alphabet: float) -> tuple[list[DataFrame], list[DataFrame]]:
    """Of each order probabilities and weights of contexts, as rows (language, sequence, p)."""
    grams: list[DataFrame] = []
    contexts: list[DataFrame] = []
    for k, level in enumerate(levels, 1):
        ones, twos = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
        share = F.when((ones > 0) & (twos > 0), F.least(F.lit(0.95), ones / (ones + 2 * twos))).otherwise(0.5)
        discounts = F.broadcast(level.groupBy("language").agg(share.alias("discount")))
        rows = level.withColumn("context", F.substring("sequence", 1, k - 1))
        weights = rows.groupBy("language", "context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        weights = materialise(weights.join(discounts, "language").withColumn("weight", F.col("discount") * F.col("kinds") / F.col("total")))
        # Of the first order there is one context in a language.
        rows = rows.join(F.broadcast(weights) if k == 1 else weights, ["language", "context"])
        if grams:
            below = grams[-1].select("language", F.col("sequence").alias("shorter"), F.col("p").alias("below"))
            rows = rows.withColumn("shorter", F.substring("sequence", 2, ORDER)).join(below, ["language", "shorter"])
        else:
            rows = rows.withColumn("below", F.lit(1.0 / alphabet))
        own = (F.col("n") - F.least("discount", "n")) / F.col("total")
        grams.append(materialise(rows.select("language", "sequence", (own + F.col("weight") * F.col("below")).alias("p"))))
        contexts.append(weights.select("language", F.col("context").alias("sequence"), F.col("weight").alias("p")))
    return grams, contexts


def _log() -> Column:
    return F.log(F.greatest(F.col("p"), F.lit(1e-300))).cast("float")


def _place(languages: list[str]) -> Column:
    return (F.array_position(F.array(*map(F.lit, languages)), F.col("language")) - 1).cast("int")


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (place, sequence, log), sequences of one length, with hashes for sequences."""
    for batch in batches:
        if not batch.num_rows:
            continue
        text = "".join(batch.column(1).to_pylist())
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4").reshape(batch.num_rows, -1)
        hashes = hashed(codes)[-1] if codes.size else np.zeros(batch.num_rows, np.uint64)
        columns = [batch.column(0), pa.array(hashes.view(np.int64)), batch.column(2)]
        yield pa.RecordBatch.from_arrays(columns, names=["place", "hash", "log"])


def _arrays(level: DataFrame, languages: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each language the hashes in ascending order, and their logs."""
    rows = level.select(_place(languages).alias("place"), "sequence", _log().alias("log"))
    found = rows.mapInArrow(_hash, "place int, hash bigint, log float").toArrow()
    place, hashes, logs = (found.column(name).to_numpy() for name in ("place", "hash", "log"))
    hashes = hashes.view(np.uint64)
    order = np.lexsort((hashes, place))
    borders = np.searchsorted(place[order], np.arange(len(languages) + 1))
    return [(hashes[order[a:b]], logs[order[a:b]]) for a, b in zip(borders[:-1], borders[1:], strict=True)]


def _by_sequence(level: DataFrame, languages: list[str]) -> DataFrame:
    """Rows (sequence, logs), logs a map from the places of the languages."""
    entry = F.struct(_place(languages).alias("place"), _log().cast("double").alias("log"))
    return materialise(level.groupBy("sequence").agg(F.map_from_entries(F.collect_list(entry)).alias("logs")))


def fit(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    most_languages: int = 256,
    sent_entries: int = SENT_ENTRIES,
    calibrate: bool = True,
) -> Model | StoredModel:
    """Model of all rows with a text and a language.

    All sequences are kept, and limits of rejection come from all rows; without ``calibrate`` there are none. A model of more than ``sent_entries`` sequences and contexts
    is a ``StoredModel``, which is joined instead of sent to workers.
    """
    rows = labelled.select(named(lang_col).alias("language"), octets(named(text_col)).alias("text")).filter(
        F.col("language").isNotNull() & F.col("text").isNotNull()
    )
    counts = rows.mapInArrow(_count, "language string, sequence string, n bigint")
    counts = materialise(counts.groupBy("language", "sequence").agg(F.sum("n").alias("n")))
    languages = [row[0] for row in counts.select("language").distinct().orderBy("language").limit(most_languages + 1).collect()]
    if len(languages) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    alphabet = counts.select(F.substring("sequence", -1, 1)).distinct().count() + 1
    if not languages:
        return Model([], [], [], -math.log(alphabet), {})
    grams, contexts = _smoothed(_levels(counts), float(alphabet))
    if sum(level.count() for level in [*grams, *contexts]) <= sent_entries:
        by_order = [[_arrays(level, languages) for level in part] for part in (grams, contexts)]
        by_language = [[list(orders) for orders in zip(*part, strict=True)] for part in by_order]
        model = Model(languages, *by_language, -math.log(alphabet), {})
    else:
        stored = [[_by_sequence(level, languages) for level in part] for part in (grams, contexts)]
        model = StoredModel(languages, *stored, -math.log(alphabet), {})
    if calibrate:
        # No filter: it would judge every row a second time.
        model.limits = _limits(identify(rows, model, out_col="found"))
    return model


class Judge:
    """Languages of texts; remembers the sums of words, up to ``CACHED_WORDS``, from task to task of a worker."""

    def __init__(self, model: Model) -> None:
        self._model = model
        self._places: dict[str, int] = {}
        self._sums = np.zeros((0, len(model.languages)))
        self._chars = np.zeros(0, np.int64)

    def _learn(self, words: list[str]) -> None:
        rows, owner = sequences(words)
        codes, inverse = _unique_rows(rows)
        each = self._model.log_probabilities(codes)[inverse]
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        self._places.update(zip(words, range(len(self._chars), len(self._chars) + len(words)), strict=True))
        self._sums = np.vstack([self._sums, np.add.reduceat(each, starts)])
        self._chars = np.concatenate([self._chars, np.array([len(word) + 1 for word in words])])

    def judge(self, texts: list[bytes]) -> tuple[list[str], list[float], list[float | None], list[bool], list[int]]:
        model = self._model
        found = [words_of(text) for text in texts]
        if not model.languages:
            found = [[] for _ in texts]
        new = set().union(*found) - self._places.keys()
        if len(self._places) + len(new) > CACHED_WORDS:
            self.__init__(model)
            new = set().union(*found)
        if new:
            self._learn(list(new))
        languages, scores, entropies, rejected, sizes = [], [], [], [], []
        for words in found:
            if not words:
                languages.append(UNKNOWN), scores.append(0.0), entropies.append(None), rejected.append(True), sizes.append(0)
                continue
            at = np.fromiter(map(self._places.__getitem__, words), np.int64, len(words))
            chars = int(self._chars[at].sum())
            entropy = -self._sums[at].sum(axis=0) / chars
            best = int(np.argmin(entropy))
            language = model.languages[best]
            limit = model.limits.get(language, math.inf) + MARGIN + SHORT_MARGIN / chars**0.5
            languages.append(language)
            scores.append(float(1 / np.exp((entropy[best] - entropy) * min(chars, SCORED_CHARS)).sum()))
            entropies.append(float(entropy[best]))
            rejected.append(bool(entropy[best] > limit))
            sizes.append(chars)
        return languages, scores, entropies, rejected, sizes


def _unique_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different rows, and the place of each row among them."""
    _, first, inverse = np.unique(hashed(rows)[rows.shape[1]], return_index=True, return_inverse=True)
    return rows[first], inverse


_JUDGED = "struct<language:string,score:double,cross_entropy:double,rejected:boolean,chars:bigint>"


def judge(text: Column, model: Model) -> Column:
    """Struct of ``language``, ``score`` (0 to 1), ``cross_entropy`` (nats a character), ``rejected`` and ``chars`` (that were scored).

    The score is the share of the language among all languages at equal prior odds,
    over 40 characters at most. Text that is null or has no letter: ``und``, 0, null, rejected. Ties go to the
    first language by code point. Without labelled rows every text is ``und``.
    """
    sent = _spark_context().broadcast(Judge(model))

    @arrow_udf(_JUDGED)
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        judging = sent.value
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            for texts in slices(batch, 1 << 20):
                for column, values in zip(columns, judging.judge(texts), strict=True):
                    column.extend(values)
            kinds = [pa.string(), pa.float64(), pa.float64(), pa.bool_(), pa.int64()]
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
            yield pa.StructArray.from_arrays(arrays, ["language", "score", "cross_entropy", "rejected", "chars"])
        give_back_memory()

    return compute(octets(text))


def _spark_context():
    from pyspark import SparkContext

    return SparkContext._active_spark_context


def identify(docs: DataFrame, model: Model | StoredModel, text_col: str = "text", out_col: str = "identified") -> DataFrame:
    """All rows and columns, with the struct of ``judge`` in ``out_col`` (replaced if it exists)."""
    if isinstance(model, Model):
        return docs.withColumn(out_col, judge(named(text_col), model))
    row = F.struct(*[named(name) for name in docs.columns]).alias("_row")
    keyed = docs.select(row, F.sha2(octets(named(text_col)), 256).alias("_key"))
    found = keyed.join(_judged(docs.select(octets(named(text_col)).alias("text")), model), "_key", "left")
    nothing = {"language": F.lit(UNKNOWN), "score": F.lit(0.0), "cross_entropy": F.lit(None).cast("double"), "rejected": F.lit(True), "chars": F.lit(0).cast("bigint")}
    judged = F.coalesce("_judged", F.struct(*[value.alias(name) for name, value in nothing.items()]))
    # The row is one column here: its names clash with no other.
    columns = {name: F.col("_row")[name] for name in docs.columns} | {out_col: judged}
    return found.select(*[value.alias(name) for name, value in columns.items()])


def fit_and_identify(docs: DataFrame, labelled: Column, text_col: str = "text", lang_col: str = "lang", out_col: str = "identified") -> DataFrame:
    """``identify`` with a model and limits from the ``labelled`` rows, each row judged once; all columns but the text.

    The struct is that of ``judge``; limits are found among what was judged, in the shared folder.
    """
    labelled = F.coalesce(labelled, F.lit(False))
    model = fit(docs.filter(labelled).select(named(text_col).alias("text"), named(lang_col).alias("lang")), calibrate=False)
    kept = [name for name in docs.columns if name not in (text_col, out_col)]
    # The row is one column here: its names clash with no other.
    row = F.struct(*[named(name) for name in kept], F.lit(True).alias("_")) if kept else F.struct(F.lit(True).alias("_"))
    language = F.when(labelled & named(text_col).isNotNull(), named(lang_col)).alias("language")
    judged = identify(docs.select(row.alias("row"), language, named(text_col).alias("text")), model, out_col="found")
    folder = new_folder(docs.sparkSession, "judged")
    judged.select("row", "language", "found").write.parquet(folder)
    judged = docs.sparkSession.read.parquet(folder)
    limit = F.lit(math.inf)
    for language, value in _limits(judged).items():
        limit = F.when(F.col("found.language") == language, F.lit(value)).otherwise(limit)
    beyond = F.col("found.cross_entropy") > limit + MARGIN + SHORT_MARGIN / F.sqrt("found.chars")
    found = F.col("found").withField("rejected", F.coalesce(beyond, F.lit(True)))
    return judged.select(*[F.col("row")[name].alias(name) for name in kept], found.alias(out_col))


def _limits(judged: DataFrame) -> dict[str, float]:
    """Limits of cross-entropy by language, from all rows (language, found) of known language that were judged right."""
    right = F.when(F.col("language") == F.col("found.language"), F.col("found.cross_entropy"))
    spread = judged.groupBy("language").agg(F.percentile_approx(right, QUANTILE, 10_000).alias("limit"))
    return {row["language"]: row["limit"] for row in spread.collect() if row["limit"] is not None}


def _text_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, text) to rows (key, word, n)."""
    for batch in batches:
        for key, text in zip(batch.column(0), batch.column(1), strict=True):
            words = Counter(words_of(text.as_py()))
            if words:
                keys = pa.array([key.as_py()] * len(words), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], names=["_key", "word", "n"]
                )


def _word_sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (word) to rows (word, sequence, n)."""
    for batch in batches:
        for word in batch.column(0).to_pylist():
            padded = PAD * (ORDER - 1) + word + END
            found = Counter(padded[i : i + ORDER] for i in range(len(word) + 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array([word] * len(found), pa.string()), pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())],
                names=["word", "sequence", "n"],
            )


def _looked_up(rows: DataFrame, sizes: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Rows joined with the table by key; of hot keys, which ``sizes`` tells, by broadcast."""
    hot = sizes.filter(F.col("rows") > HOT_PART * (sizes.agg(F.sum("rows")).first()[0] or 0)).select(key)
    hot_table = table.join(F.broadcast(hot), key, "left_semi")
    often = rows.join(F.broadcast(hot_table), key)
    return often.unionByName(rows.join(F.broadcast(hot), key, "left_anti").join(table, key))


def _summed(rows: DataFrame, by: str, languages: int, *more: Column) -> DataFrame:
    """Sums of n times logs, place by place."""
    sums = [F.sum(F.col("n") * F.get("logs", F.lit(place))).alias(f"_{place}") for place in range(languages)]
    summed = rows.groupBy(by).agg(*sums, *more)
    return summed.withColumn("logs", F.array(*[F.col(f"_{place}") for place in range(languages)])).drop(*[f"_{place}" for place in range(languages)])


def _judged(texts: DataFrame, model: StoredModel) -> DataFrame:
    """Rows (_key, _judged) of the different texts that have words."""
    number = len(model.languages)
    keyed = texts.filter(F.col("text").isNotNull()).select(F.sha2("text", 256).alias("_key"), "text")
    pairs = keyed.mapInArrow(_text_words, "_key string, word string, n bigint")
    # Of equal texts one.
    pairs = materialise(pairs.groupBy("_key", "word").agg(F.first("n").alias("n")))
    words = materialise(pairs.groupBy("word").agg(F.count(F.lit(1)).alias("rows")))
    parts = materialise(words.select("word").mapInArrow(_word_sequences, "word string, sequence string, n bigint"))
    sizes = materialise(parts.groupBy("sequence").agg(F.count(F.lit(1)).alias("rows")))
    scored = _looked_up(parts, sizes, model.log_probabilities(sizes), "sequence")
    table = materialise(_summed(scored, "word", number))
    chars = F.sum(F.col("n") * (F.length("word") + 1)).alias("chars")
    found = _summed(_looked_up(pairs, words, table, "word"), "_key", number, chars)
    found = found.withColumn("entropies", F.transform("logs", lambda x: -x / F.col("chars")))
    found = found.withColumn("least", F.array_min("entropies"))
    found = found.withColumn("language", F.get(F.array(*map(F.lit, model.languages)), (F.array_position("entropies", F.col("least")) - 1).cast("int")))
    limit = F.lit(math.inf)
    for language, value in model.limits.items():
        limit = F.when(F.col("language") == language, F.lit(value)).otherwise(limit)
    limit = limit + MARGIN + SHORT_MARGIN / F.sqrt("chars")
    odds = F.transform("entropies", lambda x: F.exp((F.col("least") - x) * F.least("chars", F.lit(SCORED_CHARS))))
    score = 1 / F.aggregate(odds, F.lit(0.0), lambda total, x: total + x)
    judged = F.struct(
        "language", score.alias("score"), F.col("least").alias("cross_entropy"), (F.col("least") > limit).alias("rejected"), F.col("chars").cast("bigint").alias("chars")
    )
    return found.select("_key", judged.alias("_judged"))


def held_out(id_column: Column, parts: int, part: int) -> Column:
    """Whether the CRC-32 of the id as text falls into this part."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % parts == part, F.lit(False))


