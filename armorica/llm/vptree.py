"""Nearest neighbours by inner product: a vantage-point tree per shard, shards by a vantage-point tree.

With one more component, sqrt(M^2 - |x|^2) for a greatest norm M, the nearest vector by
Euclidean distance is the one of largest inner product, so the triangle inequality
applies. A subtree is left out if its least possible distance times ``factor`` exceeds
that of the k-th neighbour found: factor 1 is exact, more is faster.

A first tree, fitted on a bounded sample, divides the space into regions. Every row goes to
its region; a region of more rows than a shard has is dealt to several shards by hash, so
that many equal vectors spread. Each shard is indexed once, its tree kept in the shared
folder. A query first searches its own region. Its k-th neighbour there then tells which
other regions can hold a nearer one; only those are searched, and the neighbours from
all shards are ranked at the end. Queries travel in blocks of neighbouring regions.
"""

from __future__ import annotations

import io
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from armorica.llm.common import named
from armorica.workspace import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHARD_ROWS = 4096
BLOCK_ROWS = 1024
LEAF_ROWS = 64
# Rows the division into regions is fitted on, at about; regions of one vector length, at most.
SAMPLE_ROWS = 16_384
MOST_REGIONS = 1024
# Blocks that one task searches a shard with, at about; tasks of a search, at most.
BLOCKS_AT_ONCE = 8
MOST_TASKS = 20_000
SLACK = 1e-12  # of the squares, for rounding, so that ties are never pruned


def _lift(vectors: np.ndarray, most: float) -> np.ndarray:
    """One more component, so that all have the squared norm ``most``."""
    norms = np.einsum("ij,ij->i", vectors, vectors)
    return np.column_stack([vectors, np.sqrt(np.maximum(most - norms, 0.0))])


def _can_hold(least: np.ndarray, factor: float, radius: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Whether a vector at the ``least`` distance can have an inner product of ``bound``; ``radius`` is the sum of both squared norms."""
    reach = np.maximum(0.0, radius - 2 * bound) + SLACK * radius
    return ~((least * factor) ** 2 > reach)


def _least(distance: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least distance to vectors whose distances to a vantage point lie from ``low`` to ``high``."""
    return np.maximum(0.0, np.maximum(low - distance, distance - high))


def build_tree(vectors: np.ndarray, leaf_rows: int = LEAF_ROWS, most: float | None = None) -> dict[str, np.ndarray]:
    """Arrays of a tree over the rows: a node is a leaf (``first``, ``last`` in ``order``) or has a vantage row, two children and their ranges of distances."""
    if most is None:
        most = np.einsum("ij,ij->i", vectors, vectors).max(initial=0.0)
    lifted = _lift(vectors, most)
    order = np.arange(len(vectors))
    nodes: list[list[float]] = []
    random = np.random.default_rng(len(vectors))

    def grow(first: int, last: int) -> int:
        at = len(nodes)
        nodes.append([-1, first, last, -1, -1, 0, 0, 0, 0])
        if last - first <= leaf_rows:
            return at
        rows = order[first:last]
        vantage = int(rows[random.integers(len(rows))])
        distances = np.sqrt(((lifted[rows] - lifted[vantage]) ** 2).sum(axis=1))
        ranked = np.argsort(distances, kind="stable")
        order[first:last] = rows[ranked]
        distances = distances[ranked]
        middle = (last - first) // 2
        ranges = [distances[0], distances[middle - 1], distances[middle], distances[-1]]
        nodes[at] = [vantage, first, last, grow(first, first + middle), grow(first + middle, last), *ranges]
        return at

    if len(vectors):
        grow(0, len(vectors))
    return {"nodes": np.array(nodes, np.float64).reshape(-1, 9), "order": order, "lifted": lifted}


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products, summed in the order of the components: equal vectors get equal scores."""
    out = np.zeros((len(queries), len(rows)))
    for d in range(queries.shape[1]):
        out += queries[:, d, None] * rows[None, :, d]
    return out


def search_tree(
    tree: dict[str, np.ndarray],
    ids: np.ndarray,
    rows: np.ndarray,
    query_rows: np.ndarray,
    queries: np.ndarray,
    floor: np.ndarray,
    k: int,
    factor: float = 1.0,
) -> tuple[np.ndarray, np.ndarray]:
    """The k best (id, score) of each query among other rows: scores descending, ties by smaller id; -inf where there are fewer.

    Scores below a query's ``floor`` may be left out.
    """
    nodes, order, lifted = tree["nodes"], tree["order"], tree["lifted"]
    plain = lifted[:, :-1]
    best = np.full((len(queries), k), -np.inf)
    best_ids = np.full((len(queries), k), np.iinfo(np.int64).max)
    floor = floor.copy()
    if not len(nodes) or not len(queries):
        return best_ids, best
    radius = np.einsum("ij,ij->i", queries, queries) + np.einsum("ij,ij->i", lifted[:1], lifted[:1])[0]
    raised = np.column_stack([queries, np.zeros(len(queries))])

    def scores(node: np.ndarray, who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        held = order[int(node[1]) : int(node[2])]
        held = held[np.argsort(ids[held], kind="stable")]
        found = _products(queries[who], plain[held])
        found[query_rows[who][:, None] == rows[held][None, :]] = -np.inf
        return found, ids[held]

    def to_vantage(node: np.ndarray, who: np.ndarray) -> np.ndarray:
        return np.sqrt(((raised[who] - lifted[int(node[0])]) ** 2).sum(axis=1))

    def descend(at: int, who: np.ndarray) -> None:
        """A first bound: the k-th best of the leaf a query falls into."""
        node = nodes[at]
        if node[0] < 0:
            found, _ = scores(node, who)
            if found.shape[1] >= k:
                kth = np.partition(found, found.shape[1] - k, axis=1)[:, found.shape[1] - k]
                floor[who] = np.maximum(floor[who], kth)
            return
        inside = to_vantage(node, who) <= (node[6] + node[7]) / 2
        for child, part in ((3, who[inside]), (4, who[~inside])):
            if len(part):
                descend(int(node[child]), part)

    def visit(at: int, who: np.ndarray) -> None:
        node = nodes[at]
        if node[0] < 0:
            found, found_ids = scores(node, who)
            better = found.max(axis=1) >= np.maximum(best[who, -1], floor[who])
            who, found = who[better], found[better]
            if len(who):
                merged = np.column_stack([best[who], found])
                merged_ids = np.column_stack([best_ids[who], np.broadcast_to(found_ids, found.shape)])
                ranked = np.lexsort((merged_ids, -merged), axis=1)[:, :k]
                best[who] = np.take_along_axis(merged, ranked, 1)
                best_ids[who] = np.take_along_axis(merged_ids, ranked, 1)
            return
        distance = to_vantage(node, who)
        for child, low, high in ((3, node[5], node[6]), (4, node[7], node[8])):
            bound = np.maximum(best[who, -1], floor[who])
            open_to = who[_can_hold(_least(distance, low, high), factor, radius[who], bound)]
            if len(open_to):
                visit(int(node[child]), open_to)

    everyone = np.arange(len(queries))
    descend(0, everyone)
    visit(0, everyone)
    return best_ids, best


def build_router(vectors: np.ndarray, most: float, leaf_rows: int) -> dict[str, np.ndarray]:
    """A tree whose leaves are regions: ``nodes`` with two children or a region each, their vantage ``points``, ``most``."""
    tree = build_tree(vectors, leaf_rows, most)
    nodes = tree["nodes"]
    inner = np.flatnonzero(nodes[:, 0] >= 0)
    region = np.full(len(nodes), -1.0)
    leaves = np.flatnonzero(nodes[:, 0] < 0)
    region[leaves[np.argsort(nodes[leaves, 1], kind="stable")]] = np.arange(len(leaves))
    points = np.zeros((len(nodes), tree["lifted"].shape[1]))
    points[inner] = tree["lifted"][nodes[inner, 0].astype(int)]
    split = (nodes[:, 6] + nodes[:, 7]) / 2
    return {"nodes": np.column_stack([nodes[:, 3], nodes[:, 4], region, split]), "points": points, "most": np.array(most)}


def _distances(lifted: np.ndarray, point: np.ndarray) -> np.ndarray:
    return np.sqrt(((lifted - point) ** 2).sum(axis=1))


def route(router: dict[str, np.ndarray] | None, vectors: np.ndarray) -> np.ndarray:
    """The region of each vector; 0 without a router."""
    found = np.zeros(len(vectors), np.int32)
    if router is None:
        return found
    lifted = _lift(vectors, float(router["most"]))
    waiting = [(0, np.arange(len(vectors)))]
    while waiting:
        at, who = waiting.pop()
        left, right, region, split = router["nodes"][at]
        if region >= 0:
            found[who] = int(region)
        elif len(who):
            inside = _distances(lifted[who], router["points"][at]) <= split
            waiting += [(int(left), who[inside]), (int(right), who[~inside])]
    return found


def paths(router: dict[str, np.ndarray]) -> dict[int, list[int]]:
    """The inner nodes above each region, the root first."""
    found = {}
    waiting: list[tuple[int, list[int]]] = [(0, [])]
    while waiting:
        at, above = waiting.pop()
        left, right, region, _ = router["nodes"][at]
        if region >= 0:
            found[int(region)] = above
        else:
            waiting += [(int(left), [*above, at]), (int(right), [*above, at])]
    return found


def _spans(router: dict[str, np.ndarray] | None, region: int, vectors: np.ndarray) -> tuple[list[float], list[float]]:
    """Least and greatest distance of the vectors of a region to each vantage point above it."""
    if router is None:
        return [], []
    lifted = _lift(vectors, float(router["most"]))
    distances = [_distances(lifted, router["points"][at]) for at in paths(router)[region]]
    return [float(d.min()) for d in distances], [float(d.max()) for d in distances]


def regions_to_search(
    router: dict[str, np.ndarray] | None,
    spans: dict[int, tuple[list[float], list[float]]],
    home: np.ndarray,
    queries: np.ndarray,
    floor: np.ndarray,
    factor: float,
) -> list[int]:
    """Regions, of those with ``spans``, that can hold a row of at least ``floor`` for a query of another region."""
    if router is None:
        return []
    raised = np.column_stack([queries, np.zeros(len(queries))])
    radius = np.einsum("ij,ij->i", queries, queries) + float(router["most"])
    to_point: dict[int, np.ndarray] = {}
    above = paths(router)
    wanted = []
    for region, (lows, highs) in spans.items():
        least = np.zeros(len(queries))
        for at, low, high in zip(above[region], lows, highs, strict=True):
            if at not in to_point:
                to_point[at] = _distances(raised, router["points"][at])
            least = np.maximum(least, _least(to_point[at], low, high))
        if (_can_hold(least, factor, radius, floor) & (home != region)).any():
            wanted.append(region)
    return wanted


def _pack(arrays: dict[str, np.ndarray]) -> bytes:
    buffer = io.BytesIO()
    np.savez(buffer, **arrays)
    return buffer.getvalue()


def _unpack(blob: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(blob)) as arrays:
        return dict(arrays)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), np.float64).reshape(len(vectors), -1)


def _router_of(most: dict[int, float], leaf_rows: int) -> Callable:
    def fit(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        router = build_router(_matrix(group["vector"]), most[int(key[0])], leaf_rows)
        return pd.DataFrame({"size": [key[0]], "blob": [_pack(router)]})

    return fit


def _route_rows(routers: Broadcast) -> Callable:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            regions = np.zeros(len(sizes), np.int32)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                values = batch.column("vector").take(pa.array(at)).flatten()
                vectors = values.to_numpy(zero_copy_only=False).reshape(len(at), int(size))
                regions[at] = route(routers.value.get(int(size)), vectors)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(regions)], names=[*batch.schema.names, "region"])

    return add


def _plant(routers: Broadcast) -> Callable:
    """The tree of a shard and the spans of its distances."""

    def plant(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id", kind="stable")
        vectors = _matrix(group["vector"])
        lows, highs = _spans(routers.value.get(int(key[0])), int(key[1]), vectors)
        arrays = {"ids": group["id"].to_numpy(np.int64), "rows": group["row"].to_numpy(np.int64)} | build_tree(vectors)
        tree = {"size": [key[0]], "region": [key[1]], "piece": [key[2]], "tree": [_pack(arrays)]}
        return pd.DataFrame(tree | {"lows": [lows], "highs": [highs]})

    return plant


def _gather(routers: Broadcast, spans: Broadcast | None, factor: float) -> Callable:
    """A block of queries and the regions to search: their own, or with ``spans`` the others that can hold nearer rows."""

    def gather(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        vectors, size = _matrix(group["vector"]), int(key[0])
        home = group["region"].to_numpy(np.int64)
        floor = group["floor"].to_numpy(np.float64)
        if spans is None:
            wanted = np.unique(home).tolist()
        else:
            wanted = regions_to_search(routers.value.get(size), spans.value[size], home, vectors, floor, factor)
        arrays = {"ids": group["id"].to_numpy(np.int64), "rows": group["row"].to_numpy(np.int64)}
        blob = _pack(arrays | {"vectors": vectors, "home": home, "floor": floor})
        return pd.DataFrame({"size": [key[0]], "block": [key[1]], "part": [key[2]], "blob": [blob], "regions": [wanted]})

    return gather


def _searcher(k: int, factor: float, at_home: bool) -> Callable:
    """Searches one shard with the blocks sent to it, with the queries of its region or with the others."""

    def search(key: tuple, trees: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        none = np.zeros(0, np.int64)
        out = [pd.DataFrame({"query": none, "query_id": none, "id": none, "score": np.zeros(0)})]
        tree = _unpack(trees["tree"].iloc[0]) if len(trees) else {}
        for blob in blocks["blob"] if tree else ():
            block = _unpack(blob)
            who = np.flatnonzero((block["home"] == key[1]) == at_home)
            ids, rows, floor = block["ids"][who], block["rows"][who], block["floor"][who]
            found, scores = search_tree(tree, tree["ids"], tree["rows"], rows, block["vectors"][who], floor, k, factor)
            real = np.isfinite(scores) & (scores >= floor[:, None])
            query, query_id = (np.broadcast_to(x[:, None], found.shape)[real] for x in (rows, ids))
            out.append(pd.DataFrame({"query": query, "query_id": query_id, "id": found[real], "score": scores[real]}))
        return pd.concat(out)

    return search


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows ``id``, ``vector`` (double), ``size`` with an id and a finite vector that is not zero."""
    column = named(vector_col).cast("array<double>")
    infinite = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(named(id_col).cast("bigint").alias("id"), column.alias("vector"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("vector").isNotNull())
    return rows.filter(~infinite & F.exists("vector", lambda x: x != 0)).withColumn("size", F.size("vector"))


def _fit_routers(rows: DataFrame, shard_rows: int) -> dict[int, dict[str, np.ndarray]]:
    """A router for each vector length that needs one, from a sample of about ``SAMPLE_ROWS`` rows of all lengths."""
    norm = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    lengths = rows.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("most")).collect()
    total = sum(row["n"] for row in lengths)
    # A hair more, as Python adds the squares in another order.
    most = {row["size"]: row["most"] * (1 + 1e-12) for row in lengths if row["n"] > shard_rows}
    if not most:
        return {}
    fraction = min(1.0, SAMPLE_ROWS / total)
    leaf_rows = max(1, SAMPLE_ROWS // MOST_REGIONS, int(shard_rows * fraction))
    sample = rows.filter(F.col("size").isin(list(most)) & (F.rand(len(most)) < fraction))
    fitted = sample.groupBy("size").applyInPandas(_router_of(most, leaf_rows), "size int, blob binary").collect()
    return {row["size"]: _unpack(row["blob"]) for row in fitted}


def _plan_regions(counts: list[Row], shard_rows: int, block_rows: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (size, region, shards, block, parts): neighbouring regions share a block of queries, a larger one has parts."""
    plan: list[tuple[int, int, int, int, int]] = []
    open_block: list[tuple[int, int, int]] = []
    held, block = 0, 0

    def close() -> None:
        nonlocal held, block
        plan.extend((*region, block, max(1, -(-held // block_rows))) for region in open_block)
        open_block.clear()
        held, block = 0, block + 1

    for row in sorted(counts, key=lambda row: (row["size"], row["region"])):
        if open_block and (open_block[-1][0] != row["size"] or held + row["queries"] > block_rows):
            close()
        open_block.append((row["size"], row["region"], -(-row["n"] // shard_rows)))
        held += row["queries"]
    if open_block:
        close()
    return plan


def nearest(
    vectors: DataFrame,
    is_query: Callable[[Column], Column],
    k: int = 20,
    factor: float = 1.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The k nearest of each query row: ``query_id``, ``rank`` (from 1), ``id``, ``score``.

    ``is_query`` tells from the id whether a row is a query; candidates are all other
    rows of equal length. Nearest first by inner product in double precision, ties
    to the smaller id; all candidates if there are fewer than k.

    Rows without an id, and vectors that are null, zero, or hold null or non-finite
    components, take no part. Of rows that repeat an id, each is a row of its own: a
    candidate of the others, and a query with neighbours of its own if its id makes it
    one. Other columns are not read. An empty table gives no rows.

    The driver holds a row per vector length and region (``MOST_REGIONS`` a length).
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    fitted = _fit_routers(rows, shard_rows)
    routers = spark.sparkContext.broadcast(fitted)
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    kept = materialise(rows.mapInArrow(_route_rows(routers), "id bigint, vector array<double>, size int, row bigint, region int"))

    asked = F.coalesce(is_query(F.col("id")), F.lit(False))
    counts = kept.groupBy("size", "region").agg(F.count(F.lit(1)).alias("n"), F.sum(asked.cast("int")).alias("queries")).collect()
    plan = _plan_regions(counts, shard_rows, block_rows)
    lanes = max(1, -(-sum({block: parts for *_, block, parts in plan}.values()) // BLOCKS_AT_ONCE))
    tasks = min(MOST_TASKS, max(1, 2 * lanes * sum(shards for _, _, shards, _, _ in plan)))
    planned = F.broadcast(spark.createDataFrame(plan, "size int, region int, shards int, block int, parts int"))
    regions = kept.join(planned, ["size", "region"])

    piece = F.pmod(F.xxhash64("row", F.lit("shard")), "shards").cast("int").alias("piece")
    schema = "size int, region int, piece int, tree binary, lows array<double>, highs array<double>"
    dealt = regions.select("size", "region", piece, "id", "row", "vector")
    trees = materialise(dealt.groupBy("size", "region", "piece").applyInPandas(_plant(routers), schema))
    queries = regions.filter(asked).select(
        "size", "block", F.pmod(F.xxhash64("row", F.lit("block")), "parts").cast("int").alias("part"), "region", "id", "row", "vector"
    )
    shard = ["size", "region", "piece", "lane"]
    pieces = planned.select("size", "region", "shards")

    def searched(queries: DataFrame, spans: Broadcast | None) -> DataFrame:
        """The best of the searched shards: ``query``, ``query_id``, ``id``, ``score``."""
        schema = "size int, block int, part int, blob binary, regions array<int>"
        blocks = materialise(queries.groupBy("size", "block", "part").applyInPandas(_gather(routers, spans, factor), schema))
        lane = F.pmod(F.xxhash64("block", "part"), F.lit(lanes)).cast("int").alias("lane")
        sent = blocks.select("size", F.explode("regions").alias("region"), lane, "blob")
        # Trees go where blocks wait for them.
        lanes_of = sent.select("size", "region", "lane").distinct()
        planted = trees.select("size", "region", "piece", "tree").join(lanes_of, ["size", "region"]).select(*shard, "tree")
        # Columns of its own, as both sides stem from the blocks.
        planted = planted.toDF(*planted.columns).repartition(tasks, *shard)
        one_each = F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("piece")
        sent = sent.join(pieces, ["size", "region"]).select("size", "region", one_each, "lane", "blob").repartition(tasks, *shard)
        search = _searcher(k, factor, spans is None)
        grouped = planted.groupBy(*shard).cogroup(sent.groupBy(*shard))
        return grouped.applyInPandas(search, "query bigint, query_id bigint, id bigint, score double")

    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    unknown = F.lit(float("-inf"))
    found = ranked(searched(queries.withColumn("floor", unknown), None))
    if fitted:
        found = materialise(found)
        reach = trees.groupBy("size", "region").agg(*[_every_place(F.min, "lows"), _every_place(F.max, "highs")])
        spans: dict[int, dict[int, tuple[list[float], list[float]]]] = {row[0]: {} for row in plan}
        for row in reach.collect():
            spans[row["size"]][row["region"]] = row["lows"], row["highs"]
        floors = found.filter(F.col("rank") == k).select(F.col("query").alias("row"), F.col("score").alias("floor"))
        bounded = queries.join(floors, "row", "left").withColumn("floor", F.coalesce("floor", unknown))
        others = searched(bounded, spark.sparkContext.broadcast(spans))
        found = ranked(found.drop("rank").unionByName(others))
    return found.select("query_id", "rank", "id", "score")


def _every_place(best: Callable[[Column], Column], name: str, places: int = 64) -> Column:
    """The least or greatest of an array column at each of its places."""
    held = F.array(*[best(F.get(name, F.lit(place))) for place in range(places)])
    return F.filter(held, lambda x: x.isNotNull()).alias(name)
