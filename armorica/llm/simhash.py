"""SimHash near-duplicates by anchor points.

A 64-bit fingerprint is cut into two halves of 32 bits. Two fingerprints that differ
in at most 3 bits differ in at most 1 bit in one half. On a half, the codewords of the
perfect Hamming code of length 31 (with the highest bit free) are the anchors: each
half lies within 1 bit of its home anchor, so a half that differs from it by 1 bit lies
within 2 bits of that anchor. Every distinct fingerprint is sent home once per half and
replicated to the anchors within 2 bits (17 at most per half); an equi-join on the
anchor compares homes with replicas.

Copies collapse into one fingerprint before anything is replicated, and links are kept
between fingerprints, never between documents.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from armorica.llm.common import give_back_memory, named, octets, slices, text_key
from armorica.llm.components import components
from armorica.workspace import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

COVERING_RADIUS = 1
LENGTH = 31  # of the code; a half has one bit more
SEED = 42
SHINGLES_AT_ONCE = 1 << 16


def _fingerprint(words: list[bytes], k: int) -> int:
    """Majority of each bit over the hashes of all k-word shingles; no words: 0."""
    if not words:
        return 0
    n = max(1, len(words) - k + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, SHINGLES_AT_ONCE):
        stop = min(n, start + SHINGLES_AT_ONCE)
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), SEED) for i in range(start, stop)), np.dtype("<u8"), stop - start
        )
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little", signed=True)


def fingerprint(text: Column, shingle_words: int = 3) -> Column:
    """64-bit SimHash of a text as a signed number; null as empty.

    Lower case for A-Z only; a text with fewer words is one shingle; no words give 0.
    """

    @arrow_udf("bigint")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [_fingerprint(text.lower().split(), shingle_words) for part in slices(batch) for text in part]
            yield pa.array(found, pa.int64())
        give_back_memory()

    return compute(octets(text))


def _places(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of fingerprints (unsigned): index of the fingerprint, anchor, whether it is the home."""
    index, anchor, home = [], [], []
    every = np.arange(len(fingerprints))
    for half in (0, 1):
        bits = (fingerprints >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
        free, word = bits >> np.uint64(LENGTH), bits & np.uint64((1 << LENGTH) - 1)
        syndrome = np.zeros(len(word), np.uint64)
        for position in range(1, LENGTH + 1):
            syndrome ^= ((word >> np.uint64(position - 1)) & np.uint64(1)) * np.uint64(position)
        flip = np.where(syndrome > 0, np.uint64(1) << (np.maximum(syndrome, 1) - np.uint64(1)), np.uint64(0))
        nearest = word ^ flip

        def put(who: np.ndarray, bit: np.ndarray, codeword: np.ndarray, is_home: bool, half: int = half) -> None:
            index.append(who)
            anchor.append((np.uint64(half) << np.uint64(32)) | (bit << np.uint64(LENGTH)) | codeword)
            home.append(np.full(len(who), is_home))

        put(every, free, nearest, True)
        # Within 2 bits: the home, the home with the free bit flipped, and codewords two flips away.
        put(every, free, nearest, False)
        put(every, free ^ np.uint64(1), nearest, False)
        for i in range(1, LENGTH + 1):
            j = syndrome ^ np.uint64(i)
            who = np.flatnonzero((syndrome > 0) & (j > i))
            two = (np.uint64(1) << np.uint64(i - 1)) | (np.uint64(1) << (j[who] - np.uint64(1)))
            put(who, free[who], word[who] ^ two, False)
    return np.concatenate(index), np.concatenate(anchor), np.concatenate(home)


def _send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of distinct fingerprints to rows of anchors."""
    for batch in batches:
        values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for start in range(0, len(values), 4096):
            part = values[start : start + 4096]
            index, anchor, home = _places(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.astype(np.int64)), pa.array(part[index]), pa.array(home)], names=["anchor", "fingerprint", "home"]
            )


def links(fingerprints: DataFrame, max_distance: int = 2) -> DataFrame:
    """Pairs ``a`` < ``b`` of distinct fingerprints that differ in at most ``max_distance`` (0 to 3) bits."""
    if not 0 <= max_distance <= 3:
        raise ValueError("anchors within 2 bits of a half cover distances up to 3")
    sent = fingerprints.select("fingerprint").mapInArrow(_send, "anchor bigint, fingerprint bigint, home boolean")
    homes = sent.filter("home").select("anchor", F.col("fingerprint").alias("a"))
    replicas = sent.filter("not home").select("anchor", F.col("fingerprint").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
    # Each pair is met at the home of either side, so one direction is enough.
    return homes.join(replicas, "anchor").filter((F.col("a") < F.col("b")) & near).select("a", "b").distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, max_distance: int = 2
) -> DataFrame:
    """One row per document: ``doc_id``, ``text_key``, ``fingerprint``, ``root``, ``component_id``.

    Fingerprints are signed 64-bit numbers; ``root`` is the smallest one of the component,
    ``component_id`` the smallest id reachable over links, the document's own included.
    Null and empty texts have fingerprint 0 and link like any other. Rows without an id
    take part and get the component of the others (null if none has an id). Repeated
    rows stay, each with the same result. Other columns are not read. An empty table
    gives no rows.
    """
    text = named(text_col)
    prints = docs.select(
        named(id_col).alias("doc_id"), text_key(text).alias("text_key"), fingerprint(text, shingle_words).alias("fingerprint")
    )
    prints = materialise(prints)
    classes = materialise(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id")))
    roots = components(links(classes, max_distance)).withColumnRenamed("vertex", "fingerprint")
    rooted = classes.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    smallest = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_class = materialise(rooted.join(smallest, "root").select("fingerprint", "root", "component_id"))
    return prints.join(of_class, "fingerprint").select("doc_id", "text_key", "fingerprint", "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: int) -> DataFrame:
    """The document of the smallest id of each component, all columns; one row of it if it is repeated.

    Rows without an id stay only where no other of their component has one.
    """
    no_id = (1 << 63) - 1
    found = near_duplicates(docs, id_col, text_col, **options)
    least = F.min(F.struct(F.coalesce("doc_id", F.lit(no_id)).alias("_id"), F.col("text_key").alias("_key"))).alias("least")
    kept = found.groupBy("root").agg(least).select("least.*")
    keys = [F.coalesce(named(id_col), F.lit(no_id)).alias("_id"), text_key(named(text_col)).alias("_key")]
    rows = docs.select(F.struct(*[named(name) for name in docs.columns]).alias("_row"), *keys)
    first = F.row_number().over(Window.partitionBy("_id", "_key").orderBy(F.xxhash64("_row")))
    chosen = rows.join(kept, ["_id", "_key"]).withColumn("_n", first).filter("_n = 1")
    return chosen.select(*[F.col("_row")[name].alias(name) for name in docs.columns])
