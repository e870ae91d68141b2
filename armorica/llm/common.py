"""Shared by the corpus operators: words, slices of Arrow columns, row keys."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A word: a run of bytes that are no ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def named(name: str) -> Column:
    """Column of exactly this name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def octets(text: Column) -> Column:
    """UTF-8 bytes of a text, so that Python sees texts that are no valid UTF-8 too."""
    return text.cast("binary")


def count_words(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def slices(texts: pa.Array, max_bytes: int = 4 << 20) -> Iterator[list[bytes]]:
    """The texts of a binary column in lists of bounded bytes (one text at least); null as empty."""
    taken: list[bytes] = []
    size = 0
    for scalar in texts:
        text = scalar.as_py() or b""
        if taken and size + len(text) > max_bytes:
            yield taken
            taken, size = [], 0
        taken.append(text)
        size += len(text)
    if taken:
        yield taken


def text_key(text: Column) -> Column:
    """Hash that, next to the id, tells rows of a repeated id apart; null counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))




def give_back_memory() -> None:
    """At the end of a task: free pages that a reused worker would keep, as far as the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)
