"""Near duplicates among vectors by sorted projection passes.

A pass hashes every vector by the signs of 64 random projections, concatenated, and orders the vectors by that
value: vectors at a small angle agree in long prefixes and come to stand near each other.  The order is cut into blocks
of ``BLOCK`` places that also hold the ``OVERLAP`` places before them, so any two vectors at most that far apart
are compared by their exact cosine.  A run of vectors that agree in the first log2(vectors / BLOCK) signs is also compared
as a whole, however long: where it is wider than the overlap, its blocks meet pair by pair, each such
pair of blocks a group of its own.  So a pair at the threshold meets in one pass with probability
(1 - angle/pi) ^ log2(vectors / BLOCK) at least, wherever the other vectors lie, and the passes together must reach ``RECALL``.

Equal vectors are compared once, with their number.  A group reports a count of links for each vector and a spanning
forest, never its pairs; a pair is counted in the first group where it meets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.sources.scratch import materialise

from .common import whole_groups
from .components import components
from .ranking import ranked

THRESHOLD = 0.95
RECALL = 0.999
BLOCK = 4096
OVERLAP = 512
BITS = 64
SEED = 20261202
#: Rows whose cosines are taken at once.
CHUNK = 512
#: What the key of a group has room for.
MAX_BLOCKS, MAX_PASSES, MAX_LENGTH = 1 << 20, 1 << 8, 1 << 15


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    infinite = F.lit(float("inf"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def pass_count(n: int, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK) -> int:
    meet = (1 - math.acos(threshold) / math.pi) ** max(0.0, math.log2(max(n, 1) / block))
    return 1 if meet >= recall else math.ceil(math.log(1 - recall) / math.log(1 - meet))


def prefix_bits(n: int, block: int = BLOCK) -> int:
    """Signs that a run shares; evenly spread, it holds one to two blocks."""
    return int(max(0.0, math.log2(max(n, 1) / block)))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of equal length without nulls as rows."""
    parts = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    return np.concatenate([p.flatten().to_numpy(zero_copy_only=False) for p in parts]).reshape(len(column), -1)


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    m = vectors.astype(np.float64)
    m /= np.abs(m).max(axis=1, keepdims=True)
    m /= np.sqrt((m * m).sum(axis=1, keepdims=True))
    return m


def _signatures(nodes: DataFrame, passes: int) -> DataFrame:
    """``dim``, ``pass``, ``sign`` (64 projection signs as a bigint) and ``node``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            vectors = batch.column("vector")
            dims = vectors.value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                rows = unit_rows(_matrix(vectors.take(pa.array(at))))
                names = batch.column("node").to_numpy()[at]
                if dim not in planes:
                    planes[dim] = np.random.default_rng((SEED, int(dim))).standard_normal((dim, passes * BITS))
                signs = (rows @ planes[dim] > 0).reshape(len(at), passes, BITS)
                packed = np.packbits(signs, axis=2).view(">u8").reshape(len(at), passes)
                # Signed order of the shifted value is the lexicographic order of the signs.
                order = (packed.astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)
                n = len(at) * passes
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, dim, dtype=np.int32)),
                        pa.array(np.tile(np.arange(passes, dtype=np.int32), len(at))),
                        pa.array(order.ravel()),
                        pa.array(np.repeat(names, passes)),
                    ],
                    names=["dim", "pass", "sign", "node"],
                )

    return nodes.select("node", "vector").mapInArrow(run, "dim int, pass int, sign bigint, node bigint")


def _places(signatures: DataFrame, bits: int) -> DataFrame:
    """``node`` and ``spots``: for each pass in order, its ``place`` (twice its block, plus one if the next block
    holds it too), its ``run`` (the first ``bits`` signs), and the first and last block to compare it with."""
    run = F.shiftright("sign", BITS - bits).cast("int") if bits else F.lit(0)
    placed = materialise(ranked(signatures, "dim", "pass", "sign", "node").withColumn("run", run), "projection-order")
    runs = placed.groupBy("dim", "pass", "run").agg(F.min("__rank").alias("__low"), F.max("__rank").alias("__high"))
    starts = runs.groupBy("dim", "pass").agg(F.min("__low").alias("__first"))
    runs = materialise(runs.join(starts, ["dim", "pass"]), "sign-runs")
    at = F.col("__rank") - F.col("__first")
    home = F.floor(at / BLOCK)
    over = (at % BLOCK >= BLOCK - OVERLAP).cast("bigint")
    # A run within the overlap has all its pairs in common blocks.
    wide = F.col("__high") - F.col("__low") > OVERLAP
    low, high = (F.when(wide, F.floor((F.col(c) - F.col("__first")) / BLOCK)).otherwise(home) for c in ("__low", "__high"))
    place = placed.join(runs, ["dim", "pass", "run"]).select(
        "node", F.struct("pass", (home * 2 + over).alias("place"), "run", low.alias("low"), high.alias("high")).alias("p")
    )
    # One entry per pass.
    return place.groupBy("node").agg(F.array_sort(F.collect_list("p")).alias("spots"))


def _compare(table: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vector, other or -1, links) rows of one block or pair of blocks: link counts, then edges of a spanning forest."""
    key = table.column("key")[0].as_py()
    step, left_block, right_block = key >> 40 & 0xFF, key >> 20 & 0xFFFFF, key & 0xFFFFF
    places = _matrix(table.column("places")).astype(np.int64)
    runs = _matrix(table.column("runs")).astype(np.int64)
    # Rows that were together before stand together, so that chunks of them are passed over.
    order = np.lexsort((*runs[:, :step].T[::-1], places[:, step] >> 1))
    places, runs = places[order], runs[order]
    node = table.column("node").to_numpy()[order]
    copies = table.column("copies").to_numpy()[order]
    home, over = places >> 1, places & 1
    rows = unit_rows(_matrix(table.column("vector"))[order])
    n = len(rows)
    links = np.zeros(n, dtype=np.int64)
    top = np.arange(n)  # the root of each row so far
    left, right = [], []

    def in_block(i: np.ndarray, j: np.ndarray, q: int) -> np.ndarray:
        a, b = home[i, q], home[j, q]
        return (a == b) | ((a + 1 == b) & (over[i, q] == 1)) | ((b + 1 == a) & (over[j, q] == 1))

    borders = [0, *(np.flatnonzero(np.diff(home[:, step])) + 1).tolist(), n]
    chunks = []
    for a, b in zip(borders, borders[1:]):
        for start in range(a, b, CHUNK):
            end = min(b, start + CHUNK)
            same = np.where((runs[start:end, :step] == runs[start, :step]).all(axis=0), runs[start, :step], -(1 << 62))
            chunks.append((start, end, home[start, step], same))
    for c, (a, a_end, a_home, a_same) in enumerate(chunks):
        for b, b_end, b_home, b_same in chunks[c:]:
            wanted = max(a_home, b_home) == right_block if left_block == right_block else a_home != b_home
            if not wanted or ((a_same == b_same) & (a_same > -(1 << 62))).any():
                continue
            i, j = np.nonzero(rows[a:a_end] @ rows[b:b_end].T >= threshold)
            i, j = i + a, j + b
            fresh = i < j
            if left_block != right_block:
                fresh &= ~in_block(i, j, step)
            for q in range(step):
                i, j = i[fresh], j[fresh]
                fresh = ~(in_block(i, j, q) | (runs[i, q] == runs[j, q]))
            i, j = i[fresh], j[fresh]
            if not len(i):
                continue
            links += np.bincount(i, copies[j], n).astype(np.int64) + np.bincount(j, copies[i], n).astype(np.int64)
            while True:
                apart = top[i] != top[j]
                i, j = i[apart], j[apart]
                if not len(i):
                    break
                high, low = np.maximum(top[i], top[j]), np.minimum(top[i], top[j])
                high, first = np.unique(high, return_index=True)
                top[high] = low[first]
                left.append(i[first])
                right.append(j[first])
                while (top != top[top]).any():
                    top = top[top]
    some = np.flatnonzero(links)
    none = [np.zeros(0, dtype=np.int64)]
    left, right = np.concatenate(left or none), np.concatenate(right or none)
    return (
        np.concatenate([node[some], node[left]]),
        np.concatenate([np.full(len(some), -1, dtype=np.int64), node[right]]),
        np.concatenate([links[some], np.zeros(len(left), dtype=np.int64)]),
    )


def near_duplicates(
    vectors: DataFrame,
    vector: str = "embedding",
    name: str = "vec_id",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
) -> DataFrame:
    """``name``, ``n_links``, ``component_id`` and ``kept`` of each row.

    Vectors of different length never link; nor do null, zero and non-finite ones, which are components of their
    own.  Rows that repeat a vector link with each other, also where the id is repeated.  A component's id is its
    smallest id; it is null, and its rows are kept, only where no row of it has one.  An empty table gives no rows, and
    other columns play no part.  More vectors than the key of a group can number are refused.
    """
    v = F.col(vector)
    good = vectors.filter(usable(v)).select(F.col(name).alias("id"), v.alias("vector"))
    grouped = good.groupBy("vector").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("first_id"))
    nodes = materialise(grouped.withColumn("node", F.monotonically_increasing_id()), "distinct-vectors")
    n_nodes = nodes.count()
    passes = pass_count(n_nodes, threshold, recall, BLOCK)
    longest = nodes.agg(F.coalesce(F.max(F.size("vector")), F.lit(0))).first()[0]
    if n_nodes // BLOCK + 2 > MAX_BLOCKS or passes > MAX_PASSES or longest >= MAX_LENGTH:
        raise ValueError(f"{n_nodes} vectors of up to {longest} components in {passes} passes do not fit the group key")
    spots = _places(_signatures(nodes, passes), prefix_bits(n_nodes, BLOCK))

    carried = ["node", "vector", "copies", "places", "runs"]
    joined = nodes.join(spots, "node").select(
        "node", "vector", "copies", F.col("spots.place").alias("places"), F.col("spots.run").alias("runs"), F.explode("spots").alias("s")
    )
    home = F.floor(F.col("s.place") / 2)

    def pair(a: Column, b: Column) -> Column:
        return F.shiftleft(F.least(a, b), 20) + F.greatest(a, b)

    blocks = F.when(F.col("s.place") % 2 == 1, F.array(pair(home, home), pair(home + 1, home + 1))).otherwise(F.array(pair(home, home)))
    others = F.filter(F.sequence("s.low", "s.high"), lambda b: b != home)
    groups = F.concat(blocks, F.transform(others, lambda b: pair(home, b)))
    dim_pass = F.shiftleft(F.size("vector").cast("bigint"), 48) + F.shiftleft(F.col("s.pass").cast("bigint"), 40)
    dealt = joined.select(*carried, dim_pass.alias("dp"), F.explode(groups).alias("group")).select(
        (F.col("dp") + F.col("group")).alias("key"), *carried
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches, "key"):
            keys = part.column("key").to_numpy()
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if b - a > 1:
                    columns = _compare(part.slice(a, b - a), threshold)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b", "n"])

    found = dealt.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a bigint, b bigint, n bigint")
    found = materialise(found, "projection-links")
    degree = found.filter("b < 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    groups = components(found.filter("b >= 0").select("a", "b"))
    placed = (
        nodes.join(degree, "node", "left")
        .join(groups, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    placed = materialise(placed.select("vector", "copies", "first_id", "links", "component"), "linked-vectors")
    lowest = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    known = placed.join(lowest, "component").select(
        F.col("vector").alias("__vector"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        "component_id",
    )
    known = materialise(known, "vector-components")
    linked = good.join(known, F.col("vector") == F.col("__vector")).select("id", "n_links", "component_id")
    alone = vectors.filter(~usable(v) | v.isNull()).select(
        F.col(name).alias("id"), F.lit(0).cast("bigint").alias("n_links"), F.col(name).alias("component_id")
    )
    return linked.unionByName(alone).select(
        F.col("id").alias(name), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
