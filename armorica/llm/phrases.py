"""Removal of repeated passages: every word of a window of 35 words that also starts elsewhere.

1. Windows are found by anchors. The anchor of a window is its 8-word sequence of least
   hash, so equal windows have equal anchors, and the windows of one anchor are few and
   adjacent. A segment is the words these windows span. Only anchors that occur more
   than once can hold a repeated window.
2. Equal segments, by 128 bits of XXH3 over their words, are represented by one, with
   their number. Its text goes to the shard of its anchor.
3. In a shard, windows that occur twice are confirmed word by word, the borders of each
   stretch of confirmed windows become the patterns of an Aho-Corasick automaton over
   words, and all segments of the shard are streamed through it. No repeated window is
   missed: it is a stretch, or a part of one, of its own segment.
4. What is found in a segment holds for all equal segments, and goes back to the documents.

Segments of an anchor that has more different ones than a task should hold are cut into
pieces by finer anchors first, the four least sequences of a window, and go through
automata under these.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from armorica.llm.common import named, octets, slices, text_key
from armorica.workspace import materialise, new_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW_WORDS = 35
ANCHOR_WORDS = 8
# Different segments of one anchor that one task takes.
SEGMENTS_AT_ONCE = 1_500
# Least sequences of a window that make a finer anchor.
FINE_ANCHORS = 4
# Words of the segments of one automaton, unless one anchor has more.
AUTOMATON_WORDS = 200_000
CHUNK_BYTES = 1 << 20
NO_ID = -(1 << 63)
_M2 = 0xD6E8FEB86659FD93
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_POWERS: dict[int, np.ndarray] = {}


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 ... base^(n - 1), modulo 2^64."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        powers = np.full(max(n, 1 << 16), base, np.uint64)
        powers[0] = 1
        known = _POWERS[base] = np.cumprod(powers, dtype=np.uint64)
    return known[:n]


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word, and the byte after it."""
    edges = np.flatnonzero(np.diff(np.r_[True, _SPACE[data], True].view(np.int8)))
    return edges[0::2], edges[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hashes of words: the sum of a mixed number for each byte at its place in the word."""
    hashes = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        # Words of about 1 MiB at a time.
        last = max(first + 1, int(np.searchsorted(stops, starts[first] + CHUNK_BYTES, "right")))
        sizes = stops[first:last] - starts[first:last]
        ends = np.cumsum(sizes)
        place = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
        octets = data[place + np.repeat(starts[first:last], sizes)]
        values = _mixed((octets.astype(np.uint64) + np.uint64(1)) + (place.astype(np.uint64) << np.uint64(8)))
        hashes[first:last] = _mixed(np.add.reduceat(values, ends - sizes))
        first = last
    return hashes


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the first least value of every window of this width."""
    at, span = np.arange(len(values)), 1

    def both(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where(values[right] < values[left], right, left)

    while span * 2 <= width:
        at = both(at[: len(at) - span], at[span:])
        span *= 2
    if span < width:
        at = both(at[: len(at) - (width - span)], at[width - span :])
    return at


def runs_of(texts: list[bytes], window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """The segments of texts: text, first word, number of windows, hash of the anchor, 128-bit hash of the words."""
    none = tuple(np.zeros(0, kind) for kind in (np.int64, np.int64, np.int64, np.uint64))
    # One space between words, so that equal words are equal bytes.
    flat = b"\n".join([b" ".join(text.split()) for text in texts]) + b"\n"
    data = np.frombuffer(flat, np.uint8)
    starts, stops = words_of(data)
    if len(starts) < window:
        return *none, []
    ends = np.flatnonzero(data == 10)
    numbers = np.diff(np.r_[0, np.searchsorted(starts, ends)])
    words = word_hashes(data, starts, stops)
    grams = np.zeros(len(words) - anchor + 1, np.uint64)
    for j in range(anchor):
        grams += words[j : j + len(grams)] * _powers(_M2, anchor)[j]
    grams = _mixed(grams)
    at = _least(grams, window - anchor + 1)
    owner = np.repeat(np.arange(len(texts)), numbers)
    windows = np.flatnonzero(owner[: len(at)] == owner[window - 1 :])
    if not len(windows):
        return *none, []
    new = np.r_[True, (np.diff(at[windows]) != 0) | (np.diff(windows) != 1)]
    first = windows[new]
    number = np.diff(np.r_[np.flatnonzero(new), len(windows)])
    bytes_of = zip(starts[first].tolist(), stops[first + number + window - 2].tolist(), strict=True)
    content = [xxhash.xxh3_128_digest(flat[low:high]) for low, high in bytes_of]
    begin = np.cumsum(numbers) - numbers
    return owner[first], first - begin[owner[first]], number, grams[at[first]], content


def _find_runs(window: int, anchor: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            done = 0
            for texts in slices(batch.column(2), CHUNK_BYTES):
                text, start, number, anchors, content = runs_of(texts, window, anchor)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[done + text], pa.int64()),
                        pa.array(keys[done + text], pa.int64()),
                        pa.array(start, pa.int32()),
                        pa.array(number, pa.int32()),
                        pa.array(anchors.view(np.int64)),
                        pa.array(content, pa.binary()),
                    ],
                    names=["id", "key", "start", "n", "anchor", "content"],
                )
                done += len(texts)

    return find


_RUNS = "id bigint, key bigint, start int, n int, anchor bigint, content binary"
_SEGMENTS = "anchor bigint, content binary, copies bigint, salt int, text binary"


def _cut_segments(window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, runs in zip(batch.column("text"), batch.column("runs"), strict=True):
                words = (text.as_py() or b"").split()
                rows = runs.as_py()
                for at in range(0, len(rows), 4096):
                    some = rows[at : at + 4096]
                    columns = [
                        pa.array([row["anchor"] for row in some], pa.int64()),
                        pa.array([row["content"] for row in some], pa.binary()),
                        pa.array([row["copies"] for row in some], pa.int64()),
                        pa.array([row["salt"] for row in some], pa.int32()),
                        pa.array([b" ".join(words[row["start"] : row["start"] + row["n"] + window - 1]) for row in some], pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["anchor", "content", "copies", "salt", "text"])

    return cut


class Shard:
    """Segments of whole anchors: confirms windows, compiles the automaton, streams the segments."""

    def __init__(self, window: int) -> None:
        self._window = window
        self._numbers: dict[bytes, int] = {}
        self._segments: list[tuple[int, bytes, tuple[int, ...]]] = []
        self._patterns: set[tuple[int, ...]] = set()
        self.words = 0

    def add(self, anchor: int, segments: dict[bytes, tuple[int, bytes]]) -> None:
        """The different segments of an anchor: content to copies and text."""
        window = self._window
        number = self._numbers
        own = []
        counts: dict[tuple[int, ...], int] = {}
        for content, (copies, text) in segments.items():
            words = tuple([number.setdefault(word, len(number)) for word in text.split()])
            own.append((content, words))
            for i in range(len(words) - window + 1):
                key = words[i : i + window]
                counts[key] = counts.get(key, 0) + copies
        for content, words in own:
            sure = [counts[words[i : i + window]] > 1 for i in range(len(words) - window + 1)]
            # The first and the last window of a stretch cover it: a segment has fewer windows than a window has words.
            for i, yes in enumerate(sure):
                if yes and (i == 0 or not sure[i - 1] or i == len(sure) - 1 or not sure[i + 1]):
                    self._patterns.add(words[i : i + window])
            self._segments.append((anchor, content, words))
            self.words += len(words)

    def found(self) -> pa.RecordBatch:
        """Rows of segments with the stretches of words that repeat."""
        import ahocorasick

        rows: list[tuple[int, bytes, list[dict]]] = []
        if self._patterns:
            automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
            for pattern in self._patterns:
                automaton.add_word(pattern, 1)
            automaton.make_automaton()
            for anchor, content, words in self._segments:
                spans: list[list[int]] = []
                for last, _ in automaton.iter(words):
                    first = last - self._window + 1
                    if spans and first <= spans[-1][1]:
                        spans[-1][1] = last + 1
                    else:
                        spans.append([first, last + 1])
                if spans:
                    rows.append((anchor, content, [{"first": a, "words": b - a} for a, b in spans]))
        self.__init__(self._window)
        kind = pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32())]))
        arrays = [pa.array([row[0] for row in rows], pa.int64()), pa.array([row[1] for row in rows], pa.binary())]
        return pa.RecordBatch.from_arrays([*arrays, pa.array([row[2] for row in rows], kind)], names=["anchor", "content", "spans"])


def _search(window: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, anchor, group = Shard(window), None, {}
        for batch in batches:
            batch = batch.filter(pc.less(batch.column("salt"), 0))
            for row in zip(*(batch.column(name).to_pylist() for name in ("anchor", "content", "copies", "text")), strict=True):
                if row[0] != anchor:
                    if group:
                        shard.add(anchor, group)
                    if shard.words > AUTOMATON_WORDS:
                        yield shard.found()
                    anchor, group = row[0], {}
                group[row[1]] = (row[2], row[3])
        if group:
            shard.add(anchor, group)
        yield shard.found()

    return search


def _refine(window: int, anchor: int):
    """Segments of crowded anchors, cut where the ``FINE_ANCHORS`` least sequences of a window change.

    Equal windows have these in common too, so the pieces of equal ones are found under one finer anchor.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                yield pieces(batch.slice(at, 1024))

    def pieces(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows: list[tuple] = []
        for coarse, whole, copies, text in zip(
            *(batch.column(name).to_pylist() for name in ("anchor", "content", "copies", "text")), strict=True
        ):
            words = text.split()
            grams = [xxhash.xxh3_64_intdigest(b" ".join(words[i : i + anchor])) for i in range(len(words) - anchor + 1)]
            span = window - anchor + 1
            keys = [tuple(sorted(set(grams[i : i + span]))[:FINE_ANCHORS]) for i in range(len(words) - window + 1)]
            first = 0
            for i in range(1, len(keys) + 1):
                if i == len(keys) or keys[i] != keys[first]:
                    piece = b" ".join(words[first : i - 1 + window])
                    fine = xxhash.xxh3_64_intdigest(np.array(keys[first], "<u8").tobytes()) - (1 << 63)
                    rows.append((coarse, whole, first, fine, xxhash.xxh3_128_digest(piece), copies, piece))
                    first = i
        columns = zip(*rows, strict=True) if rows else [()] * 7
        kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.binary()]
        arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["coarse", "whole", "start", "anchor", "content", "copies", "text"])

    return cut


_PIECES = "coarse bigint, whole binary, start int, anchor bigint, content binary, copies bigint, text binary"


def _windows(window: int):
    """Windows of the segments of crowded anchors, as 128-bit hashes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            batch = batch.filter(pc.greater_equal(batch.column("salt"), 0))
            for anchor, content, copies, text in zip(
                *(batch.column(name).to_pylist() for name in ("anchor", "content", "copies", "text")), strict=True
            ):
                words = text.split()
                for i in range(len(words) - window + 1):
                    rows.append((xxhash.xxh3_128_digest(b" ".join(words[i : i + window])), anchor, content, i, copies))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = [pa.binary(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["window", "anchor", "content", "first", "copies"])

    return cut


_WINDOWS = "window binary, anchor bigint, content binary, first int, copies bigint"
_FOUND = "anchor bigint, content binary, spans array<struct<first:int,words:int>>"


def repeated_passages(
    docs: DataFrame,
    window_words: int = WINDOW_WORDS,
    anchor_words: int = ANCHOR_WORDS,
    segments_at_once: int = SEGMENTS_AT_ONCE,
) -> DataFrame:
    """Rows ``id``, ``key``, ``spans`` of documents ``id``, ``key``, ``text`` (binary) that hold repeated windows.

    A span has the first word and the number of words; spans may overlap.
    """
    if not 1 <= anchor_words <= window_words:
        raise ValueError("an anchor is a part of a window")
    runs = docs.mapInArrow(_find_runs(window_words, anchor_words), _RUNS)
    recurring = materialise(runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("occurrences")).filter("occurrences > 1").select("anchor"))
    folder = new_folder(docs.sparkSession, "segments")
    runs.join(recurring, "anchor").write.parquet(folder)
    held = docs.sparkSession.read.schema(_RUNS).parquet(folder)

    # One document stands for all equal segments.
    place = F.min(F.struct("id", "key", "start", "n")).alias("place")
    different = materialise(held.groupBy("anchor", "content").agg(F.count(F.lit(1)).alias("copies"), place))
    crowded = materialise(
        different.groupBy("anchor").agg(F.count(F.lit(1)).alias("segments")).filter(F.col("segments") > segments_at_once)
    )
    salt = F.pmod(F.xxhash64("content"), F.ceil(F.col("segments") / segments_at_once))
    dealt = different.join(crowded, "anchor", "left").withColumn("salt", F.coalesce(salt, F.lit(-1)).cast("int"))
    run = F.struct("anchor", "content", "copies", "salt", F.col("place.start").alias("start"), F.col("place.n").alias("n"))
    of_text = dealt.groupBy(F.col("place.id").alias("id"), F.col("place.key").alias("key")).agg(F.collect_list(run).alias("runs"))
    texts = new_folder(docs.sparkSession, "segments")
    docs.join(of_text, ["id", "key"]).mapInArrow(_cut_segments(window_words), _SEGMENTS).write.parquet(texts)
    segments = docs.sparkSession.read.schema(_SEGMENTS).parquet(texts)
    every = segments.filter("salt < 0").repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_search(window_words), _FOUND)
    if not crowded.isEmpty():
        every = every.unionByName(_in_pieces(segments.filter("salt >= 0"), window_words, anchor_words, segments_at_once))
    in_text = F.transform("spans", lambda x: F.struct((x["first"] + F.col("start")).alias("first"), x["words"].alias("words")))
    back = held.join(every, ["anchor", "content"]).select("id", "key", in_text.alias("spans"))
    # Rows of equal id and text find the same spans: each is kept once.
    return back.groupBy("id", "key").agg(F.flatten(F.collect_set("spans")).alias("spans"))


def _in_pieces(segments: DataFrame, window_words: int, anchor_words: int, segments_at_once: int) -> DataFrame:
    """Rows of ``_FOUND`` for segments of crowded anchors, by way of finer anchors.

    A finer anchor that is crowded again is spread over tasks, and its windows are counted by an aggregation.
    """
    spark = segments.sparkSession
    folder = new_folder(spark, "pieces")
    segments.mapInArrow(_refine(window_words, anchor_words), _PIECES).write.parquet(folder)
    pieces = spark.read.schema(_PIECES).parquet(folder)
    different = pieces.groupBy("anchor", "content").agg(F.sum("copies").alias("copies"), F.any_value("text").alias("text"))
    crowded = pieces.select("anchor", "content").distinct().groupBy("anchor").agg(F.count(F.lit(1)).alias("segments"))
    crowded = materialise(crowded.filter(F.col("segments") > segments_at_once))
    salt = F.pmod(F.xxhash64("content"), F.ceil(F.col("segments") / segments_at_once))
    dealt = different.join(crowded, "anchor", "left").withColumn("salt", F.coalesce(salt, F.lit(-1)).cast("int"))
    fine = dealt.select("anchor", "content", "copies", "salt", "text").repartition("anchor", "salt")
    # Both ways read the same exchange; each function passes over the rows of the other.
    found = fine.sortWithinPartitions("anchor").mapInArrow(_search(window_words), _FOUND)
    if not crowded.isEmpty():
        single = fine.mapInArrow(_windows(window_words), _WINDOWS)
        twice = single.groupBy("window").agg(F.sum("copies").alias("total")).filter("total > 1").select("window")
        span = F.struct("first", F.lit(window_words).alias("words"))
        counted = single.join(twice, "window").groupBy("anchor", "content").agg(F.collect_set(span).alias("spans"))
        found = found.unionByName(counted)
    in_segment = F.transform("spans", lambda x: F.struct((x["first"] + F.col("start")).alias("first"), x["words"].alias("words")))
    back = pieces.select("coarse", "whole", "start", "anchor", "content").join(found, ["anchor", "content"])
    back = back.select(F.col("coarse").alias("anchor"), F.col("whole").alias("content"), in_segment.alias("spans"))
    return back.groupBy("anchor", "content").agg(F.flatten(F.collect_set("spans")).alias("spans"))


_REMOVED = "id bigint, n_words bigint, n_removed bigint, kept string"


def _strip(batches: Iterator[pa.RecordBatch], digest: bool = False) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            n_words, n_removed, kept = [], [], []
            for text, spans in zip(part.column("text"), part.column("spans"), strict=True):
                words = (text.as_py() or b"").split()
                number = len(words)
                if spans.is_valid:
                    gone = np.zeros(number + 1, np.int64)
                    for span in spans.as_py():
                        gone[span["first"]] += 1
                        gone[span["first"] + span["words"]] -= 1
                    stays = np.cumsum(gone[:-1]) == 0
                    words = [words[i] for i in np.flatnonzero(stays)]
                n_words.append(number)
                n_removed.append(number - len(words))
                joined = b" ".join(words)
                kept.append(hashlib.sha256(joined).hexdigest() if digest else joined.decode("utf-8", "replace"))
            columns = [part.column("id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "n_removed", "kept"])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _strip(batches, digest=True)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window_words: int = WINDOW_WORDS,
    anchor_words: int = ANCHOR_WORDS,
    segments_at_once: int = SEGMENTS_AT_ONCE,
    digest: bool = False,
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_removed``, ``kept``.

    A word goes if a window of ``window_words`` words that covers it has the same words
    as a window that starts anywhere else, in the same document too; all windows are
    judged on the input. ``kept`` holds the words left, joined by one space, or with
    ``digest`` their SHA-256 in hexadecimal.

    Null and empty texts have no words. Documents shorter than a window keep all words.
    Repeated rows repeat each other's windows. Rows without an id are kept (ids are
    above -2^63). Other columns are not read. An empty table gives no rows.
    """
    source = docs.select(
        F.coalesce(named(id_col).cast("bigint"), F.lit(NO_ID)).alias("id"),
        text_key(named(text_col)).alias("key"),
        octets(named(text_col)).alias("text"),
    )
    spans = repeated_passages(source, window_words, anchor_words, segments_at_once)
    stripped = source.join(spans, ["id", "key"], "left").select("id", "text", "spans").mapInArrow(_digested if digest else _strip, _REMOVED)
    return stripped.select(F.nullif("id", F.lit(NO_ID)).alias("doc_id"), "n_words", "n_removed", "kept")
