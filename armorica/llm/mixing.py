"""Mixing sources to target weights by Sainte-Laguë apportionment.

Targets follow the weights, capped at a multiple of what a source holds. The total is
cut into equal-token blocks; blocks go to sources by the highest quotients
target / (2 k + 1), then, by the same rule, a source's blocks go to its shards. In a
shard, documents are put in seeded order as one stream of words, and its blocks are
read from a seeded block on, around the stream, as often as the quota lasts.
"""

from __future__ import annotations

import re
import sys
from functools import reduce
from itertools import islice

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import StringType

from armorica.llm.common import count_words, named, octets, text_key
from armorica.workspace import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_WORD = re.compile(rb"[^\x20\x09-\x0d]+")

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_REPEATS = 2
DOCS_PER_SHARD = 4096
BLOCKS_PER_SHARD = 1024
# Blocks of the source with the smallest target, at the least, while a block is a word or more.
BLOCKS_PER_SOURCE = 50


def _in_order(rows: DataFrame, order: list[Column], sums: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` with their ``place`` (from 1) in an ``order`` without ties and the whole numbers ``<name>_before``, sums of what comes before.

    Rows are sorted by ranges; a range learns from the driver what the ranges before it
    add up to, so no task sees all rows and the driver a row per range.
    """
    dealt = materialise(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    held = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("n"), *[F.sum(name).alias(name) for name in sums])
    bases, before = [], [0] * (1 + len(sums))
    for found, *numbers in sorted(map(tuple, held.collect())):
        bases.append((found, *before))
        before = [x + (y or 0) for x, y in zip(before, numbers, strict=True)]
    schema = "_range int, _base bigint" + "".join(f", `_base_{name}` bigint" for name in sums)
    dealt = dealt.join(F.broadcast(rows.sparkSession.createDataFrame(bases, schema)), "_range")
    here = Window.partitionBy("_range").orderBy(*order)
    earlier = here.rowsBetween(Window.unboundedPreceding, -1)
    found = dealt.withColumn("place", F.row_number().over(here) + F.col("_base"))
    for name in sums:
        found = found.withColumn(f"{name}_before", F.coalesce(F.sum(name).over(earlier), F.lit(0)) + F.col(f"_base_{name}"))
    return found.drop("_range", "_base", *[f"_base_{name}" for name in sums])


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_REPEATS) -> DataFrame:
    """Rows ``source``, ``source_size`` with the source's ``target`` in words added.

    Sources weigh ``weights`` in turn, by code point, null last. A target stops at
    ``most`` times its size; what is over goes to the others by weight. With the sources
    in order of cap per weight those that reach their cap come first, and the level of
    the others follows from what is left: no iteration is needed.
    """
    ranked = _in_order(sources, [F.col("source").asc_nulls_last()]).withColumnRenamed("place", "rank")
    turn = ((F.col("rank") - 1) % len(weights)).cast("int")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)
    cap = F.col("source_size") * F.lit(float(most))
    weighed = ranked.withColumn("weight", weight).withColumn("cap", cap).withColumn("fill", F.col("cap") / F.col("weight"))
    # Sources of each weight are counted, so that sums do not depend on their order.
    turns = tuple(f"_turn_{i}" for i in range(len(weights)))
    weighed = weighed.withColumns({name: (turn == i).cast("bigint") for i, name in enumerate(turns)})
    filled = _in_order(weighed, [F.col("fill"), F.col("rank")], ("source_size", *turns))
    whole = weighed.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("source_size", *turns)]).first()
    left = F.lit(whole["source_size"] * float(share)) - F.col("source_size_before") * F.lit(float(most))
    after = [F.lit(float(w)) * (F.lit(whole[name]) - F.col(f"{name}_before")) for w, name in zip(weights, turns, strict=True)]
    level = left / reduce(Column.__add__, after)
    # The first source that does not fill up sets the level for itself and all after it.
    free = filled.withColumn("level", level).filter("level < fill")
    common = free.agg(F.min(F.struct("fill", "rank", "level"))["level"].alias("common")).first()["common"]
    goal = F.col("cap") if common is None else F.least("cap", F.lit(common) * F.col("weight"))
    return ranked.select("source", "source_size", "rank", cap.alias("cap"), weight.alias("weight")).select(
        "source", "source_size", "rank", goal.alias("target")
    )


def apportion(shares: DataFrame, group: list[str], seats: Column, order: list[Column]) -> DataFrame:
    """Rows with ``share`` get ``quota``: ``seats`` of their group by the highest quotients share / (2 k + 1).

    ``seats`` must be one number per group. Ties go to the first row by ``order``, which tells
    the rows of a group apart. Only quotients near the proportional share can decide:
    moving the divisor until the seats add up moves a row by at most its part of half the
    group's rows. The seats below are granted outright, so a group costs a few rows per
    row, whatever the number of seats. Quotients are ranked by ranges, a group of any size by many tasks.
    """
    columns = shares.columns
    rows = shares.withColumn("_seats", seats.cast("bigint")).withColumn("_all", F.lit(0))
    group = group or ["_all"]
    # A group is told by its columns, no nulls among them.
    whole = rows.groupBy(*group).agg(F.sum("share").alias("_sum"), F.count(F.lit(1)).alias("_rows"))
    exact = F.col("_seats") * F.col("share") / F.col("_sum")
    reach = F.ceil(F.col("share") / F.col("_sum") * F.col("_rows") / 2) + 1
    near = (
        rows.join(whole, group)
        .filter("share > 0")
        .withColumn("_low", F.greatest(F.lit(0), F.floor(exact) - reach).cast("bigint"))
        .withColumn("_high", (F.floor(exact) + reach + 1).cast("bigint"))
    )
    candidates = near.withColumn("_k", F.explode(F.sequence("_low", "_high")))
    quotient = F.col("share") / (2 * F.col("_k") + 1)
    placed = _in_order(candidates, [*map(F.col, group), quotient.desc(), *order, F.col("_k")])
    granted = F.sum(F.when(F.col("_k") == F.col("_low"), F.col("_low")))
    opened = placed.groupBy(*group).agg(F.min("place").alias("_first"), (F.first("_seats") - granted).alias("_open"))
    won = placed.join(opened, group).withColumn("_won", F.when(F.col("place") - F.col("_first") < F.col("_open"), 1).otherwise(0))
    return won.groupBy(*columns).agg((F.first("_low") + F.sum("_won")).cast("bigint").alias("quota"))


def _overlap(start: Column, stop: Column, low: Column, high: Column) -> Column:
    return F.greatest(F.lit(0), F.least(stop, high) - F.greatest(start, low)).cast("bigint")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most_repeats: int = MOST_REPEATS,
    docs_per_shard: int = DOCS_PER_SHARD,
    blocks_per_shard: int = BLOCKS_PER_SHARD,
    seed: int = 42,
) -> DataFrame:
    """One row per document with what the mix takes of it.

    ``doc_id``, ``text_key``, ``source``, ``size`` (words), ``source_size``, ``target`` (of
    the source), ``taken`` (words, repeats counted), ``whole`` (how often the whole text
    is taken) and ``parts``, up to two further ranges of words (``first`` from 0, ``words``).

    Null and empty texts have size 0 and nothing is taken. Null is a source, the last
    one. Documents of equal id and text are interchangeable; the order of all others is
    seeded, so reruns agree. Other columns are not read. An empty table gives no rows.
    """
    each = docs.select(
        named(id_col).alias("doc_id"),
        named(source_col).alias("source"),
        text_key(named(text_col)).alias("text_key"),
        count_words(named(text_col)).alias("size"),
    )
    # Equal rows are one with a number of copies; more copies than a shard has documents are several.
    counted = each.groupBy("doc_id", "source", "text_key", "size").agg(F.count(F.lit(1)).alias("copies"))
    chunks = counted.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / docs_per_shard))))
    copies = F.least(F.col("copies") - F.col("chunk") * docs_per_shard, F.lit(docs_per_shard)).cast("bigint")
    slim = materialise(chunks.withColumn("copies", copies).withColumn("words", F.col("size") * F.col("copies")))
    sources = slim.groupBy("source").agg(F.sum("words").alias("source_size"), F.sum("copies").alias("docs"))
    shard_counts = sources.select("source", F.ceil(F.col("docs") / docs_per_shard).cast("int").alias("shards"))
    goals = targets(sources.select("source", "source_size"), weights, share, most_repeats)
    joined = goals.alias("g").join(shard_counts.alias("c"), F.col("g.source").eqNullSafe(F.col("c.source")))
    planned = materialise(joined.select("g.source", "source_size", "rank", "target", "shards"))
    least = F.min(F.when(F.col("target") > 0, F.col("target"))).alias("least")
    # Added as decimals, so that the order of sources does not matter.
    target = F.sum(F.col("target").cast("decimal(38,6)")).alias("target")
    whole = planned.agg(target, F.sum("shards").alias("shards"), least).first()
    total = float(whole["target"] or 0)
    # Rare sources need smaller blocks; more blocks cost no more rows.
    block = max(1, int(min(total / (blocks_per_shard * (whole["shards"] or 1)), (whole["least"] or 0) / BLOCKS_PER_SOURCE)))
    quotas = apportion(planned.withColumn("share", F.col("target")), [], F.lit(round(total / block)), [F.col("rank")])
    quotas = materialise(quotas.select("rank", F.col("quota").alias("source_quota")))

    seeded = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text_key"))
    placed = slim.alias("d").join(planned.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
    placed = placed.select(
        "doc_id",
        "text_key",
        "d.source",
        "size",
        "copies",
        "words",
        "chunk",
        "source_size",
        "rank",
        "target",
        seeded.alias("place"),
        F.pmod(F.xxhash64(seeded, "chunk", F.lit("shard")), F.col("shards")).cast("int").alias("shard"),
    )
    held = placed.groupBy("rank", "shard").agg(F.sum("words").alias("held"))
    shares = held.join(quotas, "rank").withColumn("share", F.col("held").cast("double"))
    shard_quotas = apportion(shares, ["rank"], F.col("source_quota"), [F.col("shard")])
    # Words to take of a shard, and the block its reading starts at.
    words = F.least(F.col("quota") * block, F.col("held") * most_repeats)
    rest = words % F.col("held")
    first = F.pmod(F.xxhash64(F.lit(seed), F.col("rank"), F.col("shard")), F.ceil(F.col("held") / block)) * block
    reading = materialise(
        shard_quotas.select(
            "rank", "shard", "held", F.floor(words / F.col("held")).cast("int").alias("whole"), rest.alias("rest"), first.alias("first")
        )
    )
    read = placed.join(reading, ["rank", "shard"], "left")
    order = Window.partitionBy("rank", "shard").orderBy("place", "doc_id", "text_key", "chunk")
    end = F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0))
    read = read.withColumn("end", end).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    # Copies stand one after the other in the stream.
    start = F.col("end") - F.col("words") + (F.col("copy") - 1) * F.col("size")
    read = read.withColumn("start", start).withColumn("stop", F.col("start") + F.col("size"))
    # The reading covers [first, last) of the stream and, beyond its end, [0, over).
    last = F.least(F.col("first") + F.col("rest"), F.col("held"))
    over = F.greatest(F.lit(0), F.col("first") + F.col("rest") - F.col("held"))
    read = read.withColumn("first_words", F.coalesce(_overlap(F.col("start"), F.col("stop"), F.col("first"), last), F.lit(0)))
    read = read.withColumn("second_words", F.coalesce(_overlap(F.col("start"), F.col("stop"), F.lit(0), over), F.lit(0)))
    begin = F.greatest(F.lit(0), F.col("first") - F.col("start")).cast("bigint")
    parts = F.array(
        F.struct(begin.alias("first"), F.col("first_words").alias("words")),
        F.struct(F.lit(0).cast("bigint").alias("first"), F.col("second_words").alias("words")),
    )
    return read.select(
        "doc_id",
        "text_key",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.coalesce("whole", F.lit(0)) + F.col("first_words") + F.col("second_words")).cast("bigint").alias("taken"),
        F.coalesce("whole", F.lit(0)).alias("whole"),
        F.filter(parts, lambda x: x["words"] > 0).alias("parts"),
    )


def _cut(text: bytes, first: int, words: int) -> bytes:
    """From the first of some words to the last, with the white space between."""
    spans = [match.span() for match in islice(_WORD.finditer(text), first, first + words)]
    return text[spans[0][0] : spans[-1][1]]


@arrow_udf(StringType())
def _cut_text(text: pa.Array, first: pa.Array, words: pa.Array) -> pa.Array:
    rows = zip(text.to_pylist(), first.to_pylist(), words.to_pylist(), strict=True)
    return pa.array([None if t is None else _cut(t, f, n).decode("utf-8", "replace") for t, f, n in rows], pa.string())


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars", **options) -> DataFrame:
    """The mix itself: all columns, a row for each time a document is taken whole, and one for each part of it.

    A part's text runs from its first word to its last; ``length_col``, if there is one, is
    set to its characters.
    """
    no_id = F.lit(-(1 << 63))
    keys = ["_id", "_key"]

    def numbered(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy("_order")))

    taken = mix(docs, id_col, text_col, **options).select(
        F.coalesce("doc_id", no_id).alias("_id"), F.col("text_key").alias("_key"), F.xxhash64("source").alias("_order"), "size", "whole", "parts"
    )
    source = options.get("source_col", "source")
    row = F.struct(*[named(name) for name in docs.columns]).alias("_row")
    key = [F.coalesce(named(id_col), no_id).alias("_id"), text_key(named(text_col)).alias("_key")]
    rows = docs.select(row, *key, F.xxhash64(named(source)).alias("_order"))
    # Rows of one id and text are paired by their number, in the order of their source.
    paired = numbered(rows).join(numbered(taken).drop("_order"), [*keys, "_n"])
    whole = F.array_repeat(F.struct(F.lit(0).cast("bigint").alias("first"), F.col("size").alias("words")), F.col("whole"))
    pieces = paired.withColumn("_piece", F.explode(F.concat(whole, "parts")))
    part = F.col("_piece.words") < F.col("size")
    text = F.col("_row")[text_col]
    cut = _cut_text(F.when(part, octets(text)), F.col("_piece.first"), F.col("_piece.words"))
    pieces = pieces.withColumn("_cut", cut)
    columns = []
    for name in docs.columns:
        value = F.col("_row")[name]
        if name == text_col:
            value = F.coalesce("_cut", value)
        elif name == length_col:
            value = F.when(F.col("_cut").isNotNull(), F.length("_cut").cast(docs.schema[name].dataType)).otherwise(value)
        columns.append(value.alias(name))
    return pieces.select(*columns)
