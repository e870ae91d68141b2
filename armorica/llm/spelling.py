"""Spelling variants: words that differ by one inserted, deleted or replaced character.

A word is described by how many of its letters fall into each of ``GROUPS`` letter groups.
Words are arranged in a trie by these counts, one group a level. One edit adds at most one
letter to one group and takes at most one from one group, so the search of a word descends
depth first with a budget of one surplus and one deficit; the words of the leaves it gets
to are verified letter by letter.

The trie is spread over tasks. Counts that begin more words than a task should hold are
crowded; a cell is the words below the shortest counts that are not. Every word is stored
in its own cell and visits the cells its budget gets to that come after its own, so each
pair meets once. Cells with many visitors, or with many words of equal counts, are dealt to
several tasks: each task holds a part of the words, and sees a part of the visitors.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armorica.llm.common import named
from armorica.workspace import materialise, new_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A run of Latin letters.
LETTERS = r"A-Za-zÀ-ÿ"
GROUPS = 11
# Words that a task holds, and visitors it takes; more words in a large vocabulary, so that
# there are at most CROWDED crowded counts of each length.
HELD_WORDS, VISITORS, CROWDED = 16_384, 32_768, 8_192
# A node of the trie with more words is no leaf; pairs of words that are verified at once.
LEAF_WORDS, PAIRS = 16, 200_000
# Words up to this length are verified as rows of arrays.
ROW_CHARS = 30
# How much commoner a form is than its variants.
RATIO = 10
# Distinct counts that a task sums before it hands them on.
COUNTED = 200_000
ROWS, GUESTS_AT_ONCE = 8_192, 16_384


class Features:
    """Of words: code points, length, letters of each group, and which letters there are (one bit each, modulo 64)."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        # A closing zero keeps empty words in sight.
        codes = np.frombuffer("".join([word + "\0" for word in words]).encode("utf-32-le"), "<u4")
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(self.lengths + 1) - self.lengths - 1
        owner = np.repeat(np.arange(len(words)), self.lengths + 1)
        letter = codes != 0
        at = owner[letter] * GROUPS + codes[letter] % GROUPS
        self.counts = np.bincount(at, minlength=len(words) * GROUPS).reshape(len(words), GROUPS)
        bits = np.left_shift(np.uint64(1), codes.astype(np.uint64) & np.uint64(63))
        self.letters = np.bitwise_or.reduceat(bits, starts) if len(words) else np.zeros(0, np.uint64)
        # Code points in rows of 16-bit numbers, closed by zeros; words that do not fit are left out.
        self.in_rows = self.lengths <= ROW_CHARS
        self.in_rows[owner[codes > 0xFFFF]] = False
        short = letter & self.in_rows[owner]
        self.codes = np.zeros((len(words), ROW_CHARS + 1), np.uint16)
        self.codes[owner[short], (np.arange(len(codes)) - starts[owner])[short]] = codes[short]


def one_apart(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced character leads from one to the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    at = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        at += 1
    if len(a) == len(b):
        return at < len(a) and a[at + 1 :] == b[at + 1 :]
    return a[at:] == b[at + 1 :]


def pairs_apart(a: Features, at_a: np.ndarray, b: Features, at_b: np.ndarray) -> np.ndarray:
    """``one_apart`` of pairs of words, given by their places in a and in b."""
    longer = a.lengths[at_a] - b.lengths[at_b]
    # One edit changes two letters at the most.
    near = (np.abs(longer) <= 1) & (np.bitwise_count(a.letters[at_a] ^ b.letters[at_b]) <= 2)
    place = np.flatnonzero(near)
    at_a, at_b, longer = at_a[place], at_b[place], longer[place]
    x, y = a.codes[at_a], b.codes[at_b]
    swap = longer > 0
    x[swap], y[swap] = y[swap], x[swap]
    differ = x != y
    same_length = longer == 0
    good = np.zeros(len(place), bool)
    good[same_length] = differ[same_length].sum(axis=1) == 1
    # x is one shorter: behind the first difference it goes on like y does one place later.
    other = ~same_length
    first = differ[other].argmax(axis=1)
    late = np.arange(ROW_CHARS) >= first[:, None]
    good[other] = ~((x[other, :-1] != y[other, 1:]) & late).any(axis=1)
    for i in np.flatnonzero(~(a.in_rows[at_a] & b.in_rows[at_b])):
        good[i] = one_apart(a.words[at_a[i]], b.words[at_b[i]])
    near[place] = good
    return near


class Trie:
    """Words in the order of their group counts: a node is a range of words of equal first counts."""

    def __init__(self, words: Features) -> None:
        self._words = words
        self._order = np.lexsort(words.counts.T[::-1])
        self._counts = words.counts[self._order]

    def near(self, wanted: Features) -> tuple[np.ndarray, np.ndarray]:
        """Places of wanted words and of words of the trie that are one edit apart.

        The words wanted descend together, depth first; at each node those stay that can
        pay for its count from what is left of their surplus and deficit.
        """
        pairs: list[tuple[np.ndarray, np.ndarray]] = []
        leaves: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def verify() -> None:
            if leaves:
                at, places = (np.concatenate(part) for part in zip(*leaves, strict=True))
                good = pairs_apart(wanted, at, self._words, places)
                pairs.append((at[good], places[good]))
                leaves.clear()

        start = np.ones(len(wanted.words), bool)
        stack = [(0, len(self._order), 0, np.arange(len(start)), start, start)]
        while stack:
            low, high, level, at, more, less = stack.pop()
            if high - low <= LEAF_WORDS or level == GROUPS:
                step = max(1, PAIRS // max(1, high - low))
                for some in range(0, len(at), step):
                    part = at[some : some + step]
                    leaves.append((np.repeat(part, high - low), np.tile(self._order[low:high], len(part))))
                    size += len(part) * (high - low)
                    if size >= PAIRS:
                        verify()
                        size = 0
                continue
            column = self._counts[low:high, level]
            borders = np.r_[0, np.flatnonzero(np.diff(column)) + 1, high - low]
            own = wanted.counts[at, level]
            for first, last in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
                over = column[first] - own
                surplus, deficit = over == 1, over == -1
                stay = np.flatnonzero((over == 0) | surplus & more | deficit & less)
                if len(stay):
                    left = more[stay] & ~surplus[stay], less[stay] & ~deficit[stay]
                    stack.append((low + first, low + last, level + 1, at[stay], *left))
        verify()
        if not pairs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(part) for part in zip(*pairs, strict=True))


def _cell(counts: tuple[int, ...]) -> str:
    return ".".join(map(str, counts))


def cells(counts: tuple[int, ...], crowded: set[tuple[int, ...]]) -> list[str]:
    """The cells a word gets to with its budget, its own first. ``crowded`` counts are gone through."""
    found = []
    stack = [((), True, True)]
    while stack:
        prefix, more, less = stack.pop()
        if prefix not in crowded or len(prefix) == GROUPS:
            found.append(prefix)
            continue
        own = counts[len(prefix)]
        if less and own:
            stack.append(((*prefix, own - 1), more, False))
        if more:
            stack.append(((*prefix, own + 1), False, less))
        stack.append(((*prefix, own), more, less))
    home = next(cell for cell in found if cell == counts[: len(cell)])
    return [_cell(home), *(_cell(cell) for cell in found if cell != home)]


def _count_prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words to how many of them each beginning of counts has."""
    sums: Counter[tuple[int, ...]] = Counter()

    def counted() -> pa.RecordBatch:
        columns = [pa.array(list(map(_cell, sums)), pa.string()), pa.array(sums.values(), pa.int64())]
        sums.clear()
        return pa.RecordBatch.from_arrays(columns, names=["prefix", "words"])

    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            for counts in map(tuple, Features(batch.column(0).slice(start, ROWS).to_pylist()).counts.tolist()):
                for length in range(GROUPS):
                    sums[counts[:length]] += 1
            if len(sums) > COUNTED:
                yield counted()
    yield counted()


def _place(crowded: Broadcast):
    """Words (word, n) to rows of their own cell and of those they visit."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                rows = []
                words, ns = (column.to_pylist() for column in part.columns)
                for word, n, counts in zip(words, ns, map(tuple, Features(words).counts.tolist()), strict=True):
                    own, *others = cells(counts, crowded.value)
                    rows.append((own, 0, word, n))
                    rows += [(cell, 1, word, n) for cell in others if cell > own]
                columns = [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), _PLACED_TYPES, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["cell", "visits", "word", "n"])

    return place


_PLACED_TYPES = [pa.string(), pa.int32(), pa.string(), pa.int64()]
_PLACED = "cell string, visits int, word string, n bigint"
_NEAR = "word string, n_near bigint, near_n bigint, near string"


def _best(at: list[int], others: list[int], words: list[str], ns: list[int]) -> dict[int, tuple[int, int, str]]:
    """By place of a word, given the places of words near to it: their number, the n of the commonest and that word, of equally common ones the smallest."""
    found: dict[int, tuple[int, int, str]] = {}
    for place, other in zip(at, others, strict=True):
        word, n = words[other], ns[other]
        number, most, best = found.get(place, (0, 0, ""))
        if not number or n > most or n == most and word < best:
            most, best = n, word
        found[place] = (number + 1, most, best)
    return found


class _Block:
    """Words held by a task, as they come; visitors are looked for together."""

    def __init__(self, first_share: bool) -> None:
        self._first_share = first_share
        self.held: list[tuple[str, int]] = []
        self.guests: list[tuple[str, int]] = []
        self._trie: Trie | None = None
        self._features: Features | None = None

    def found(self) -> Iterator[pa.RecordBatch]:
        """Rows of ``_NEAR`` for words that have met since the last call."""
        if not self.held:
            self.guests.clear()
            return
        words, ns = map(list, zip(*self.held, strict=True))
        if self._trie is None:
            self._features = Features(words)
            self._trie = Trie(self._features)
            if self._first_share:
                # Each finds the other.
                at, others = self._trie.near(self._features)
                yield _near_rows(words, _best(at.tolist(), others.tolist(), words, ns))
        if self.guests:
            guests, guest_ns = map(list, zip(*self.guests, strict=True))
            self.guests.clear()
            at, others = (part.tolist() for part in self._trie.near(Features(guests)))
            yield _near_rows(guests, _best(at, others, words, ns))
            yield _near_rows(words, _best(others, at, guests, guest_ns))


def _near_rows(words: list[str], found: dict[int, tuple[int, int, str]]) -> pa.RecordBatch:
    rows = [(words[place], *row) for place, row in found.items()]
    columns = zip(*rows, strict=True) if rows else [()] * 4
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["word", "n_near", "near_n", "near"])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cell, part, share, visits, word, n), the words of a block before its visitors, to rows of ``_NEAR``."""
    at, block = None, _Block(True)
    for batch in batches:
        for cell, part, share, visits, word, n in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if (cell, part, share) != at:
                yield from block.found()
                at, block = (cell, part, share), _Block(share == 0)
            (block.guests if visits else block.held).append((word, n))
            if len(block.guests) >= GUESTS_AT_ONCE:
                yield from block.found()
    yield from block.found()


def near_words(words: DataFrame, held_words: int = HELD_WORDS, visitors: int = VISITORS) -> DataFrame:
    """Rows (word, n_near, near_n, near) of the different words (word, n) that have a word one edit away.

    ``n_near`` is the number of those, ``near`` the one of largest n (ties: the smallest in
    code-point order), ``near_n`` its n.
    """
    spark = words.sparkSession
    held_words = max(held_words, words.count() // CROWDED)
    begun = words.select("word").mapInArrow(_count_prefixes, "prefix string, words bigint")
    begun = begun.groupBy("prefix").agg(F.sum("words").alias("words")).filter(F.col("words") > held_words)
    # At most CROWDED of each length.
    crowded = {tuple(int(x) for x in row["prefix"].split(".") if x) for row in begun.collect()}
    folder = new_folder(spark, "spelling")
    words.select("word", "n").mapInArrow(_place(spark.sparkContext.broadcast(crowded)), _PLACED).write.parquet(folder)
    placed = spark.read.schema(_PLACED).parquet(folder)
    sizes = placed.groupBy("cell").agg(F.count_if(F.col("visits") == 0).alias("held"), F.count_if(F.col("visits") == 1).alias("guests"))
    split = sizes.select(
        "cell",
        F.ceil(F.col("held") / held_words).cast("int").alias("parts"),
        # Guests see every part.
        F.ceil(F.col("guests") / visitors).cast("int").alias("shares"),
    ).filter("parts > 0 and (parts > 1 or shares > 1)")
    dealt = placed.join(split, "cell", "left").select(
        "cell",
        "visits",
        "word",
        "n",
        F.coalesce("parts", F.lit(1)).alias("parts"),
        F.greatest(F.coalesce("shares", F.lit(1)), F.lit(1)).alias("shares"),
    )
    own_part = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    own_share = F.pmod(F.hash("word"), F.col("shares")).cast("int")

    def numbers(first: Column, last: Column) -> Column:
        return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))

    first, last_part, last_share = F.lit(0), F.col("parts") - 1, F.col("shares") - 1
    block = dealt.withColumns({"own_part": own_part, "own_share": own_share})
    held = block.filter("visits = 0").select(
        "cell", F.col("own_part").alias("part"), F.explode(numbers(first, last_share)).alias("share"), "visits", "word", "n"
    )
    guest_parts = F.when(F.col("visits") == 1, numbers(first, last_part)).otherwise(numbers(F.col("own_part") + 1, last_part))
    guests = block.select(
        "cell", F.explode(guest_parts).alias("part"), F.col("own_share").alias("share"), F.lit(1).alias("visits"), "word", "n"
    )
    blocks = held.unionByName(guests).repartition("cell", "part", "share")
    found = blocks.sortWithinPartitions("cell", "part", "share", "visits").mapInArrow(_search, _NEAR)
    # The commonest first, of equally common ones the smallest.
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("word"))).alias("best")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", (-F.col("best.less")).alias("near_n"), F.col("best.word").alias("near"))


def _roots(forms: DataFrame) -> DataFrame:
    """Rows (word, root) of rows (word, form): forms are followed to the last, doubling the steps each round.

    A form is commoner than its word, so there is no circle.
    """
    steps = materialise(forms.select("word", F.col("form").alias("root")))
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = materialise(steps.join(further, "root", "left"))
        if joined.filter("further is not null").isEmpty():
            return steps
        steps = joined.select("word", F.coalesce("further", "root").alias("root"))


def spelling_variants(
    words: DataFrame,
    word_col: str = "word",
    n_col: str = "n",
    ratio: int = RATIO,
    held_words: int = HELD_WORDS,
    visitors: int = VISITORS,
) -> DataFrame:
    """Rows ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``, one per different word.

    Two words are near if exactly one inserted, deleted or replaced code point leads from one
    to the other. The form of a word is its near word of largest n (ties: the smallest in
    code-point order) if that is at least ``ratio`` (over 1) times its own n, else null; ``root`` is the
    word one gets to by following forms, the word itself without a form.

    Rows of one word count together. Null words and null or non-positive n take no part, the
    empty word is a word like any other. Other columns are not read. An empty table gives no rows.
    """
    if ratio <= 1:
        raise ValueError("a form is commoner than its variants")
    counted = words.select(named(word_col).alias("word"), named(n_col).cast("bigint").alias("n"))
    counted = materialise(counted.filter("word is not null and n > 0").groupBy("word").agg(F.sum("n").alias("n")))
    near = near_words(counted, held_words, visitors)
    is_form = F.col("near_n") >= F.col("n") * ratio
    known = materialise(
        counted.join(near, "word", "left").select(
            "word",
            "n",
            F.when(is_form, F.col("near")).alias("form"),
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(is_form, F.col("near_n")).alias("form_n"),
        )
    )
    roots = _roots(known.filter("form is not null"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def letter_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 1) -> DataFrame:
    """Rows (id, run): maximal runs of at least ``min_chars`` Latin letters of whole texts, A-Z lower-cased.

    A null or empty text has none. The id is kept as it is.
    """
    runs = F.regexp_extract_all(named(text_col), F.lit(f"[{LETTERS}]{{{min_chars},}}"), F.lit(0))
    lower = F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return docs.select(named(id_col).alias("id"), F.explode(runs).alias("run")).select("id", lower.alias("run"))
