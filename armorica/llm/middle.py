"""Fill-in-middle transformation: two cuts at line ends, found in an indexable skip list.

The lines of a text are the units of a skip list. Lane 0 links all line ends; each express
lane keeps about a quarter of the ends of the lane below. A link carries two widths, the
units and the code points it passes. A cut asks for a number of units: descending from the
highest lane, links are followed as long as the accumulated units do not exceed it, and the
accumulated code points are then the exact place of the cut.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from armorica.llm.common import named, octets

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Signs before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"
# Of a hundred texts: those that are cut, and of these those that begin with the suffix.
CUT_PERCENT, SPM_PERCENT = 100, 50
SEED = 7
# An express lane keeps one of so many links.
SPACING_BITS = 2


class SkipList:
    """Ends of units in order, with lanes from the sparsest to the one of all ends.

    A lane is three lists: units and code points that each of its links passes, and the
    link of the lane below that leaves from the same end.
    """

    def __init__(self, points: np.ndarray) -> None:
        """``points``: code points of each unit."""
        before = np.concatenate([np.zeros(1, np.int64), np.cumsum(points, dtype=np.int64)])
        ends = np.arange(len(before))
        # The height of an end is drawn from its place, so a text always gives the same lanes.
        drawn = ends.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        drawn ^= drawn >> np.uint64(29)
        self.units, self.points = len(points), int(before[-1])
        self._lanes: list[tuple[list[int], list[int], list[int]]] = []
        kept, below = ends, ends
        level = 0
        while True:
            # The last link of a lane ends at the end of the text.
            stops = np.append(kept[1:], len(points))
            down = np.searchsorted(below, kept)
            self._lanes.insert(0, ((stops - kept).tolist(), (before[stops] - before[kept]).tolist(), down.tolist()))
            level += 1
            mask = np.uint64((1 << SPACING_BITS * level) - 1)
            below, kept = kept, ends[((drawn & mask) == 0) | (ends == 0)]
            if len(kept) < 2 or len(kept) == len(below):
                break

    def points_before(self, rank: int) -> int:
        """Code points of the first ``rank`` units."""
        if not 0 <= rank <= self.units:
            raise IndexError(rank)
        units = points = at = 0
        for unit_widths, point_widths, down in self._lanes:
            while at < len(unit_widths) and 0 < unit_widths[at] <= rank - units:
                units += unit_widths[at]
                points += point_widths[at]
                at += 1
            if units == rank:
                break
            at = down[at]
        return points


def lines_of(text: str) -> np.ndarray:
    """Code points of each line, its line feed included."""
    sizes = np.array([len(line) + 1 for line in text.split("\n")], np.int64)
    sizes[-1] -= 1
    return sizes if sizes[-1] else sizes[:-1]


def transform(
    text: str, draws: list[int], cut_percent: int = CUT_PERCENT, spm_percent: int = SPM_PERCENT, marks: tuple[str, str, str] = MARKS
) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, code points of prefix and middle, and the output, given four random numbers."""
    first, second, cut, order = draws
    lanes = SkipList(lines_of(text))
    n = lanes.units
    if not text or cut % 100 >= cut_percent or any(mark in text for mark in marks):
        return n, PLAIN, None, None, text
    low, high = sorted((first % (n + 1), second % (n + 1)))
    start, stop = lanes.points_before(low), lanes.points_before(high)
    prefix, middle, suffix = text[:start], text[start:stop], text[stop:]
    p, s, m = marks
    if order % 100 < spm_percent:
        return n, SPM, start, stop - start, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return n, PSM, start, stop - start, f"{p}{prefix}{s}{suffix}{m}{middle}"


_CUT = "struct<n:bigint,form:string,prefix_chars:bigint,middle_chars:bigint,output:string>"


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    out_col: str = "fim",
    cut_percent: int = CUT_PERCENT,
    spm_percent: int = SPM_PERCENT,
    seed: int = SEED,
    marks: tuple[str, str, str] = MARKS,
) -> DataFrame:
    """All rows and columns, with a struct in ``out_col`` (replaced if it exists).

    ``n``: lines of the text. ``form``: ``plain``, ``psm`` or ``spm``. ``prefix_chars`` and
    ``middle_chars``: code points, null if plain. ``output``: the text if plain; else prefix,
    suffix and middle, or suffix, prefix and middle, each after its mark. The parts are whole
    lines and may be empty. A text that is empty or holds a mark is plain.

    What is drawn depends on seed and id only, so rows of one id are cut by the same numbers
    and reruns agree. A null text is empty, a null id counts as empty text. No row meets
    another one: map-only.
    """
    if len(set(marks)) != 3 or not all(marks) or any(a != b and a in b for a in marks for b in marks):
        raise ValueError("three marks, none a part of another")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(named(id_col).cast("string"), F.lit(""))).cast("binary"), 256)

    @arrow_udf(_CUT)
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, digests in batches:
            rows = []
            for text, drawn in zip(texts, digests, strict=True):
                draws = [int(drawn.as_py()[at : at + 8], 16) for at in (0, 8, 16, 24)]
                rows.append(transform((text.as_py() or b"").decode("utf-8", "replace"), draws, cut_percent, spm_percent, marks))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
            yield pa.StructArray.from_arrays(arrays, ["n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.withColumn(out_col, cut(octets(named(text_col)), digest))


def restore(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text an output was made from: no part holds a mark, so the marks alone tell the parts."""
    parts = F.split(output, "|".join(re.escape(mark) for mark in marks), -1)
    psm, spm = F.concat(parts[1], parts[3], parts[2]), F.concat(parts[2], parts[3], parts[1])
    return F.when(form == PLAIN, output).when(form == PSM, psm).otherwise(spm)
