"""Near duplicates by SimHash fingerprints, found through pivot distance tables.

The Hamming distance to a reference fingerprint, also when counted over a block of the bits only, differs
between two fingerprints by at most the number of bits in which they differ there.  So a table of distances
to many references bounds the distance of a pair from below by the largest coordinate difference:

* Two fingerprints at up to three differing bits agree in all but three of the blocks they are cut into.
  All their coordinates for those blocks are equal, and these coordinates are the join key.
* Pairs under one key go on only if no coordinate of any block differs by more than the allowed bits.
* What is left is verified with the exact distance.

Fingerprints are compared once each, whatever the number of documents that carry them.  A bucket that holds
more than ``MAX_BUCKET`` fingerprints is dealt anew by blocks of the bits that its key leaves open, which
loses no pair and ends because fingerprints that agree on 52 bits are at most 4,096.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.sources.scratch import discard, materialise

from .common import pieces, whole_groups
from .components import components
from .ranking import ranked

BITS = 64
MAX_DISTANCE = 3
SHINGLE = 3
SEED = 42
#: References per block, and the seed that they are drawn from.
REFERENCES = 16
REFERENCE_SEED = 20261201
MAX_BUCKET = 4096
#: Wide fingerprints, for texts that are alike by five-word shingles: 64-bit words, similarity, chance to meet a pair at it.
WORDS = 4
WIDE = [f"f{i}" for i in range(WORDS)]
#: Blocks of a word whose distances to the references are compared.
WIDE_CUTS = 2
#: What tells texts apart: the wide fingerprint and a digest of the set of shingles.
MARKS = [*WIDE, "digest"]
#: Documents whose shingles are compared in one block.
SET_BLOCK = 512
WIDE_SHINGLE = 5
SIMILARITY = 0.8
WIDE_RECALL = 0.98
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)
#: Wanted number of fingerprints under one key; decides how many blocks there are.
BUCKET = 16


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of one text; see ``fingerprints``."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    grams = zip(*[words[i:] for i in range(shingle)]) if len(words) >= shingle else [words]
    digest, join = xxhash.xxh64_intdigest, b" ".join
    hashes = np.fromiter((digest(join(g), seed) for g in grams), dtype="<u8")
    counts = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and ``fingerprint`` (64 bits as a bigint) of each document.

    A-Z are lowered, words are runs of anything but space, tab and line breaks, and shingles of
    ``SHINGLE`` words are hashed with repeats; a shorter text is one shingle, one without words has fingerprint 0.
    """
    kept = [c for c in keep if c.lower() != "fingerprint"]
    rows = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias("__text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            values = [fingerprint(x.as_py()) for x in batch.column("__text")]
            signed = pa.array(np.array(values, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], signed], names=[*kept, "fingerprint"]
            )

    schema = rows.select(*kept, F.lit(0).cast("bigint").alias("fingerprint")).schema
    return rows.mapInArrow(hashed, schema)


def block_masks(n: int, free: int = (1 << BITS) - 1) -> list[int]:
    """The set bits of ``free`` dealt into ``n`` blocks of about equal size."""
    bits = [i for i in range(BITS) if free >> i & 1]
    return [sum(1 << b for b in bits[len(bits) * i // n : len(bits) * (i + 1) // n]) for i in range(n)]


def references() -> np.ndarray:
    return np.random.default_rng(REFERENCE_SEED).integers(0, 1 << 63, REFERENCES, dtype=np.uint64) * np.uint64(2) + np.arange(
        REFERENCES, dtype=np.uint64
    ) % np.uint64(2)


def pivot_distances(fps: np.ndarray, masks: Sequence[int]) -> np.ndarray:
    """Distances to every reference within every block: fingerprints x blocks x references."""
    apart = fps[:, None] ^ references()[None, :]
    return np.bitwise_count(apart[:, None, :] & np.array(masks, dtype=np.uint64)[None, :, None])


def block_count(n_fingerprints: int, distance: int = MAX_DISTANCE) -> int:
    """Fewest blocks whose key is long enough that a bucket of evenly spread fingerprints holds ``BUCKET``."""
    n = distance + 1
    while n < 12 and n_fingerprints > BUCKET * 2 ** (BITS * (n - distance) // n):
        n += 1
    return n


def _fold(tables: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """One 64-bit key of each row of coordinates and a salt; two rows may share a key by chance, which only
    adds a candidate pair."""
    key = salt.astype(np.uint64)
    for column in tables.T:
        key = (key ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _keyed(rows: DataFrame, n_blocks: int, distance: int, level: int) -> DataFrame:
    """Bucket entries (``key``, ``agreed``, ``fp``) of fingerprints; ``agreed`` are the bits the key fixes.

    At level 0 a key takes all but ``distance`` blocks of the whole fingerprint; below, one of ``distance`` + 1
    blocks of the bits that the bucket's earlier key left open.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            old_key = batch.column("key").to_numpy().view(np.uint64)
            old = batch.column("agreed").to_numpy().view(np.uint64)
            for agreed in np.unique(old):
                at = old == agreed
                free = ~int(agreed) & ((1 << BITS) - 1)
                masks = block_masks(n_blocks if level == 0 else distance + 1, free)
                picks = list(combinations(range(len(masks)), len(masks) - distance))
                table = pivot_distances(fps[at], masks)
                for i, pick in enumerate(picks):
                    fixed = int(agreed) | sum(masks[b] for b in pick)
                    key = _fold(table[:, list(pick), :].reshape(at.sum(), -1), old_key[at] + np.uint64(i + 1))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(key),
                            pa.array(np.full(len(key), fixed, dtype=np.uint64).view(np.int64)),
                            pa.array(fps[at].view(np.int64)),
                        ],
                        names=["key", "agreed", "fp"],
                    )

    return rows.mapInArrow(deal, "key bigint, agreed bigint, fp bigint")


def _linked(table: pa.Table, n_blocks: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the buckets of a table that is sorted by key, as a spanning forest of each bucket."""
    key = table.column("key").to_numpy()
    fps = table.column("fp").to_numpy().view(np.uint64)
    n = len(fps)
    new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    end = np.repeat(np.r_[new[1:], n], np.diff(np.r_[new, n]))
    pivots = pivot_distances(fps, block_masks(n_blocks)).reshape(n, -1).astype(np.int8)
    parent = np.arange(n)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    left, right = [], []
    rows = np.flatnonzero(end - np.arange(n) > 1)
    step = 1
    while len(rows):
        at = rows
        for c in range(pivots.shape[1]):
            at = at[np.abs(pivots[at, c] - pivots[at + step, c]) <= distance]
            if not len(at):
                break
        if len(at):
            at = at[np.bitwise_count(fps[at] ^ fps[at + step]) <= distance]
        for i in at:
            a, b = root(i), root(i + step)
            if a != b:
                parent[max(a, b)] = min(a, b)
                left.append(i)
                right.append(i + step)
        step += 1
        rows = rows[end[rows] - rows > step]
    signed = fps.view(np.int64)
    return signed[np.array(left, dtype=np.int64)], signed[np.array(right, dtype=np.int64)]


def links(prints: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """Edges (``a``, ``b``) between distinct values of ``fp`` that connect all at most ``distance`` bits apart.

    Every pair within the distance is compared; edges that close a circle in their bucket are left out.
    """
    n_blocks = block_count(prints.count(), distance)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches, "key"):
            a, b = _linked(part, n_blocks, distance)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    start = prints.select(F.lit(0).cast("bigint").alias("key"), F.lit(0).cast("bigint").alias("agreed"), "fp")
    entries, level, parts = start, 0, []
    while True:
        entries = materialise(_keyed(entries, n_blocks, distance, level), "pivot-keys")
        sizes = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("agreed").alias("agreed"))
        # Beyond 52 agreed bits a bucket cannot outgrow the bound.
        crowded = sizes.filter((F.col("n") > MAX_BUCKET) & (F.bit_count("agreed") < BITS - 12)).select("key")
        crowded = materialise(crowded, "crowded-keys")
        fits = entries.join(crowded, "key", "left_anti") if not crowded.isEmpty() else entries
        spread = fits.select("key", "fp").repartition("key").sortWithinPartitions("key", "fp")
        parts.append(materialise(spread.mapInArrow(found, "a bigint, b bigint"), "pivot-links"))
        if crowded.isEmpty():
            break
        entries = entries.join(crowded, "key", "left_semi").select("key", "agreed", "fp")
        level += 1
    edges = parts[0]
    for p in parts[1:]:
        edges = edges.unionByName(p)
    return edges.distinct()


def _members(docs: DataFrame, text: str, distance: int) -> DataFrame:
    """``doc_id``, ``fingerprint``, ``component`` (its lowest fingerprint) and ``component_id`` of each row."""
    marked = materialise(fingerprints(docs, text), "fingerprints")
    carried = marked.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("first_id"))
    carried = materialise(carried, "distinct-fingerprints")
    groups = components(links(carried, distance))
    placed = carried.join(groups, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component")
    )
    lowest = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_print = materialise(
        placed.join(lowest, "component").select("fp", "component", "component_id"), "fingerprint-components"
    )
    return marked.join(by_print, F.col("fingerprint") == F.col("fp")).drop("fp")


def near_duplicates(docs: DataFrame, text: str = "text", distance: int = MAX_DISTANCE) -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``component_id`` of each row.

    A component is what links between fingerprints reach; its id is the smallest doc_id in it, null only
    if it has none.  Rows without words share fingerprint 0; repeated rows stay repeated.
    """
    return _members(docs, text, distance).select("doc_id", "fingerprint", "component_id")


# --- documents that are alike --------------------------------------------------------


def shingle_hashes(text: str | None, shingle: int = WIDE_SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct shingles; a shorter text is one, one without words has none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype="<u8")
    grams = set(zip(*[words[i:] for i in range(shingle)])) if len(words) >= shingle else {tuple(words)}
    digest, join = xxhash.xxh64_intdigest, b" ".join
    return np.unique(np.fromiter((digest(join(g), SEED) for g in grams), dtype="<u8", count=len(grams)))


def wide_fingerprint(text: str | None, shingle: int = WIDE_SHINGLE) -> list[int]:
    """``WORDS`` fingerprints of 64 bits from independent hashes of each distinct shingle."""
    return _wide(shingle_hashes(text, shingle))


def _wide(hashes: np.ndarray) -> list[int]:
    if not len(hashes):
        return [0] * WORDS
    out = []
    for factor in _FACTORS:
        counts = np.zeros(BITS, dtype=np.int64)
        for start in range(0, len(hashes), 1 << 16):
            part = hashes[start : start + (1 << 16)] * factor
            part ^= part >> np.uint64(32)
            part *= _FACTORS[0]
            part ^= part >> np.uint64(29)
            counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
        out.append(int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0]))
    return out


def wide_fingerprints(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and ``MARKS`` of each document."""
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sets = [shingle_hashes(x.as_py()) for x in batch.column("__text")]
            values = [[*_wide(g), xxhash.xxh64_intdigest(g.tobytes())] for g in sets]
            values = np.array(values, dtype=np.uint64).view(np.int64)
            columns = [pa.array(values[:, i]) for i in range(len(MARKS))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *columns], names=[*keep, *MARKS])

    marks = [F.lit(0).cast("bigint").alias(c) for c in MARKS]
    return rows.mapInArrow(hashed, rows.select(*keep, *marks).schema)


def shingle_sets(docs: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """Columns ``keep``, ``digest`` and ``grams`` (the sorted shingle hashes) of each document."""
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            grams = [shingle_hashes(x.as_py()).tobytes() for x in batch.column("__text")]
            digests = np.array([xxhash.xxh64_intdigest(g) for g in grams], dtype=np.uint64).view(np.int64)
            columns = [*[batch.column(c) for c in keep], pa.array(digests), pa.array(grams, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "digest", "grams"])

    added = [F.lit(0).cast("bigint").alias("digest"), F.lit(b"").alias("grams")]
    return rows.mapInArrow(hashed, rows.select(*keep, *added).schema)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sets as sorted arrays; of two empty ones it is 1."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common) if len(a) + len(b) else 1.0


def _verified(edges: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The edges whose ends reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            pairs = zip(batch.column("grams_a"), batch.column("grams_b"))
            close = [jaccard(*(np.frombuffer(g.as_py(), dtype="<u8") for g in p)) >= similarity for p in pairs]
            yield batch.select(["a", "b"]).filter(pa.array(close, pa.bool_()))

    left, right = (sets.select(F.col("node").alias(c), F.col("grams").alias(f"grams_{c}")) for c in "ab")
    return edges.join(left, "a").join(right, "b").select("a", "b", "grams_a", "grams_b").mapInArrow(run, "a bigint, b bigint")


def _settled(table: pa.Table, distance: int, similarity: float) -> list[tuple[int, int]]:
    """Edges that join the labels of one group wherever two of its texts reach the similarity."""
    node, block, lone = (table.column(c).to_numpy() for c in ("node", "block", "lone"))
    _, top = np.unique(table.column("label").to_numpy(), return_inverse=True)
    words = [table.column(c).to_numpy().view(np.uint64) for c in WIDE]
    pivots = wide_distances(np.stack(words, axis=1), wide_blocks()).astype(np.int8)
    sets = [np.frombuffer(g.as_py(), dtype="<u8") for g in table.column("grams")]
    out = []
    for i in range(len(node)):
        later = i + 1 + np.flatnonzero((top[i + 1 :] != top[i]) & ((block[i + 1 :] != block[i]) | lone[i]))
        later = later[least_distance(pivots[later], pivots[i]) <= distance]
        apart = sum(np.bitwise_count(w[later] ^ w[i]).astype(np.int32) for w in words)
        for j in later[apart <= distance]:
            few, many = sorted((len(sets[i]), len(sets[j])))
            if top[i] != top[j] and few >= similarity * many and jaccard(sets[i], sets[j]) >= similarity:
                out.append((int(node[i]), int(node[j])))
                top[top == top[j]] = top[i]
    return out


def similar_links(nodes: DataFrame, sets: DataFrame, candidates: DataFrame, similarity: float) -> DataFrame:
    """Edges between nodes whose shingle sets reach the similarity.

    The candidates, a forest of pairs, are verified first.  A group of candidates that this does not join
    wholly is then compared pair by pair, block against block, but for pairs that are joined already.
    """
    sure = materialise(_verified(candidates, sets, similarity), "verified-links")
    near = components(candidates).select("node", F.col("component").alias("key"))
    joined = components(sure).withColumnRenamed("component", "label")
    members = near.join(joined, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    members = materialise(members, "candidate-groups")
    # A group of two has its only pair verified.
    sizes = members.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n"))
    parted = materialise(sizes.filter("low < high AND n > 2").select("key"), "open-groups")
    if parted.isEmpty():
        return sure
    distance = differing_bits(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches, "key"):
            keys = part.column("key").to_numpy()
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            found = [e for a, b in zip(cuts, cuts[1:]) for e in _settled(part.slice(a, b - a), distance, similarity)]
            columns = [pa.array([e[k] for e in found], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    rows = members.join(parted, "key", "left_semi").join(nodes.select("node", *WIDE), "node")
    # By label, so that most blocks hold one label only, and two blocks of the same need not meet.
    dealt = _block_pairs(rows.select("key", "node", "label", *WIDE), SET_BLOCK, "label").join(sets, "node")
    more = dealt.repartition("key").sortWithinPartitions("key", "node").mapInArrow(run, "a bigint, b bigint")
    return sure.unionByName(materialise(more, "settled-links"))


def differing_bits(similarity: float) -> int:
    """Bits of a wide fingerprint that texts of this Jaccard similarity, and equal size, differ by: the mean and
    three deviations, so that the bound only proposes pairs and refuses about one in a thousand at the similarity."""
    shared = 2 * similarity / (1 + similarity)
    p, n = math.acos(shared) / math.pi, BITS * WORDS
    return math.floor(n * p + 3 * math.sqrt(n * p * (1 - p)))


def sampled_bits(n_fingerprints: int, similarity: float) -> tuple[int, int]:
    """Bits of a key, so that evenly spread fingerprints share it with few, and the number of keys after which
    a pair at the similarity is missed with probability ``1 - WIDE_RECALL``."""
    bits = max(8, math.ceil(math.log2(max(1, n_fingerprints) / BUCKET)))
    agree = (1 - math.acos(2 * similarity / (1 + similarity)) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - WIDE_RECALL) / math.log(1 - agree))


def wide_distances(words: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Distances to every reference within every block of the bits: wide fingerprints x blocks x references.

    ``masks`` holds the bits of each block by word.  A word of a reference is one of ``references``, so that no two words of one are alike.
    """
    refs = np.stack([np.roll(references(), w) for w in range(WORDS)])
    out = np.zeros((len(words), len(masks), REFERENCES), dtype=np.int16)
    for w in range(WORDS):
        apart = words[:, w, None] ^ refs[w][None, :]
        for b in np.flatnonzero(masks[:, w]):
            out[:, b] += np.bitwise_count(apart & masks[b, w])
    return out


def wide_blocks() -> np.ndarray:
    """Masks of the blocks whose distances bound that of two wide fingerprints."""
    masks = np.zeros((WORDS * WIDE_CUTS, WORDS), dtype=np.uint64)
    for w in range(WORDS):
        masks[w * WIDE_CUTS : (w + 1) * WIDE_CUTS, w] = block_masks(WIDE_CUTS)
    return masks


def least_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A bound from below of the distances of fingerprints with these ``wide_distances``: in each block they differ by at least
    the largest difference of a coordinate, and the blocks have no bit in common."""
    return np.abs(a - b).max(axis=-1).sum(axis=-1, dtype=np.int32)


def _sampled(rows: DataFrame, bits: int, n_keys: int) -> DataFrame:
    """Entries (``key``, ``node``, the words): distances to all references in samples of the bits, folded.

    Fingerprints that agree in a sample have all its distances in common.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng((REFERENCE_SEED, 0))
        masks = np.zeros((n_keys, WORDS), dtype=np.uint64)
        for mask in masks:
            pick = rng.choice(BITS * WORDS, size=bits, replace=False)
            np.bitwise_or.at(mask, pick // BITS, np.uint64(1) << (pick % BITS).astype(np.uint64))
        for batch in pieces(batches, 10_000):
            words = np.stack([batch.column(c).to_numpy() for c in WIDE], axis=1).view(np.uint64)
            old = batch.column("key").to_numpy().view(np.uint64)
            for i in range(n_keys):
                key = _fold(wide_distances(words, masks[i : i + 1])[:, 0], old + np.uint64(i + 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), *[batch.column(c) for c in ("node", *WIDE)]], names=["key", "node", *WIDE]
                )

    return rows.select("key", "node", *WIDE).mapInArrow(deal, f"key bigint, node bigint, {', '.join(f'{c} bigint' for c in WIDE)}")


def _block_pairs(entries: DataFrame, size: int, label: str | None = None) -> DataFrame:
    """Entries (``key``, ``node``, ...) dealt so that any two of a key share a new key, each pair of blocks of ``size`` its own.

    ``block`` is the row's block and ``lone`` says that the new key holds that block only; elsewhere only rows of
    different blocks are to be compared.  With ``label``, rows of one label need not meet, and blocks that hold nothing else are
    sent to blocks with others only.
    """
    placed = materialise(ranked(entries, "key", *([label] if label else []), "node"), "crowded-entries")
    starts = placed.groupBy("key").agg(F.min("__rank").alias("__first"), F.max("__rank").alias("__last"))
    starts = materialise(starts, "crowded-starts")
    block = F.floor((F.col("__rank") - F.col("__first")) / size)
    kept = [c for c in entries.columns if c != "key"]
    if label is None:
        last = F.floor((F.col("__last") - F.col("__first")) / size)
        dealt = placed.join(starts, "key").select(
            "key", *kept, block.alias("block"), F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("with")
        )
    else:
        blocked = placed.join(starts, "key").select("key", *kept, block.alias("block"))
        blocks = blocked.groupBy("key", "block").agg(F.min(label).alias("__low"), F.max(label).alias("__high"))
        blocks = materialise(blocks, "label-blocks")
        others = blocks.select("key", F.col("block").alias("with"), F.col("__low").alias("__l"), F.col("__high").alias("__h"))
        pairs = blocks.join(others, "key").filter("least(__low, __l) < greatest(__high, __h)").select("key", "block", "with")
        dealt = blocked.join(pairs, ["key", "block"])
    new = F.xxhash64("key", F.least("block", "with"), F.greatest("block", "with"))
    return dealt.select(new.alias("key"), *kept, "block", (F.col("block") == F.col("with")).alias("lone"))


def _alike(table: pa.Table, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs within ``distance`` in each bucket of a table sorted by key."""
    dealt = "block" in table.column_names
    if dealt:
        block, lone = table.column("block").to_numpy(), table.column("lone").to_numpy()
    key, node = table.column("key").to_numpy(), table.column("node").to_numpy()
    words = [table.column(c).to_numpy().view(np.uint64) for c in WIDE]
    pivots = wide_distances(np.stack(words, axis=1), wide_blocks()).astype(np.int8)
    n = len(key)
    new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    end = np.repeat(np.r_[new[1:], n], np.diff(np.r_[new, n]))
    top = np.arange(n)  # the root of each row so far
    left, right, step = [], [], 1
    rows = np.flatnonzero(end - np.arange(n) > 1)
    while len(rows):
        # Rows that are joined already need no comparison.
        at = rows[top[rows] != top[rows + step]]
        if dealt:
            at = at[(block[at] != block[at + step]) | lone[at]]
        # The pivots refuse most, the distance itself decides on the rest.
        at = at[least_distance(pivots[at], pivots[at + step]) <= distance]
        apart = sum(np.bitwise_count(w[at] ^ w[at + step]).astype(np.int32) for w in words)
        at = at[apart <= distance]
        while len(at):
            a, b = top[at], top[at + step]
            high, low = np.maximum(a, b), np.minimum(a, b)
            high, first = np.unique(high, return_index=True)
            top[high] = low[first]
            left.append(node[at[first]])
            right.append(node[at[first] + step])
            while (top != top[top]).any():
                top = top[top]
            at = at[top[at] != top[at + step]]
        step += 1
        rows = rows[end[rows] - rows > step]
    none = [np.zeros(0, dtype=np.int64)]
    return np.concatenate(left or none), np.concatenate(right or none)


def alike_links(nodes: DataFrame, similarity: float = SIMILARITY, used: list[str] | None = None) -> DataFrame:
    """Edges (``a``, ``b``) between nodes (``node``, the words) whose fingerprints say they are alike.

    A bucket of more than ``MAX_BUCKET`` is compared block against block over several tasks, which loses no pair.
    """
    bits, n_keys = sampled_bits(nodes.count(), similarity)
    distance = differing_bits(similarity)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches, "key"):
            a, b = _alike(part, distance)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    entries = materialise(_sampled(nodes.withColumn("key", F.lit(0).cast("bigint")), bits, n_keys), "sampled-keys", used)
    sizes = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    crowded = materialise(sizes.filter(F.col("n") > MAX_BUCKET).select("key"), "crowded-keys")
    some = not crowded.isEmpty()
    fits = entries.join(crowded, "key", "left_anti") if some else entries

    def compared(rows: DataFrame) -> DataFrame:
        spread = rows.repartition("key").sortWithinPartitions("key", "node")
        return materialise(spread.mapInArrow(found, "a bigint, b bigint"), "alike-links")

    edges = compared(fits)
    if some:
        edges = edges.unionByName(compared(_block_pairs(entries.join(crowded, "key", "left_semi"), MAX_BUCKET // 2)))
    return edges.distinct()


def _unclear_ids(marked: DataFrame) -> DataFrame:
    """Ids that are repeated or null, which a clean table does not have, as ``__id``."""
    seen = marked.groupBy("doc_id").agg(F.count(F.lit(1)).alias("__n"))
    return materialise(seen.filter("__n > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("__id")), "repeated-ids")


def _sets_of(docs: DataFrame, text: str, wanted: DataFrame, unclear: DataFrame) -> DataFrame:
    """``node`` and ``grams`` of the ``wanted`` nodes (``node``, ``digest``, ``first_id``), from one row of each.

    Texts are read again for this, so that no shingles are stored but those of candidates.
    """
    rows = docs.select("doc_id", text)
    clear = wanted.join(unclear, F.col("first_id").eqNullSafe(F.col("__id")), "left_anti").drop("digest")
    mine = rows.join(clear.withColumnRenamed("first_id", "doc_id"), "doc_id")
    sets = shingle_sets(mine, text, ["node"]).select("node", "grams")
    if unclear.isEmpty():
        return sets
    # Where an id says nothing, the digest of the shingles tells which row is meant.
    mixed = wanted.join(unclear, F.col("first_id").eqNullSafe(F.col("__id")), "left_semi").select("node", "digest")
    odd = shingle_sets(rows.join(unclear, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi"), text)
    return sets.unionByName(odd.groupBy("digest").agg(F.first("grams").alias("grams")).join(mixed, "digest").select("node", "grams"))


def _alike_members(docs: DataFrame, text: str, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Members of the components as ``_members`` gives them, by ``MARKS``, and the unclear ids; both are written."""
    used: list[str] = []
    marked = materialise(wide_fingerprints(docs, text), "wide-fingerprints", used)
    unclear = _unclear_ids(marked)
    carried = marked.groupBy(*MARKS).agg(F.min("doc_id").alias("first_id"))
    nodes = materialise(carried.withColumn("node", F.monotonically_increasing_id()), "distinct-fingerprints", used)
    keys: list[str] = []
    candidates = materialise(alike_links(nodes, similarity, keys).filter("a <> b"), "candidate-links", used)
    discard(docs.sparkSession, keys)
    ends = candidates.select(F.col("a").alias("node")).union(candidates.select("b")).distinct()
    wanted = materialise(nodes.join(ends, "node").select("node", "digest", "first_id"), "candidate-nodes", used)
    sets = materialise(_sets_of(docs, text, wanted, unclear), "candidate-sets", used)
    groups = components(similar_links(nodes, sets, candidates, similarity))
    placed = nodes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    known = materialise(placed.join(lowest, "component").select(*MARKS, "component", "component_id"), "wide-components", used)
    found = materialise(marked.join(known, MARKS), "members")
    # What is left are one row per document and one per unclear id.
    discard(docs.sparkSession, used)
    return found, unclear


def drop_near_duplicates(docs: DataFrame, text: str = "text", similarity: float | None = None) -> DataFrame:
    """One document of each component, one with its smallest doc_id, with its own columns.

    Components come from fingerprints at up to ``MAX_DISTANCE`` bits, or, with a Jaccard similarity of five-word shingles,
    from exact comparison of the shingles of texts that wide fingerprints propose: those that have the distances to all
    references in a sample of the bits in common, and whose distances in the blocks of all bits bound theirs by no more than
    the allowed bits.  Rows that repeat an id are told apart by their
    fingerprints; of rows with equal id and component, and of the rows of a component that has no id at all, one stays.
    """
    if similarity is None:
        found, marks = materialise(_members(docs, text, MAX_DISTANCE), "members"), ["fingerprint"]
        unclear = _unclear_ids(found)
    else:
        (found, unclear), marks = _alike_members(docs, text, similarity), MARKS
    kept = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    once = kept.join(unclear, F.col("doc_id").eqNullSafe(F.col("__id")), "left_anti").select("doc_id")
    out = docs.join(once, "doc_id", "left_semi").select(*docs.columns)
    if unclear.isEmpty():
        return out
    rest = docs.join(unclear, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
    rows = rest.select(F.struct("*").alias("__row"), "doc_id", text)
    marked = (fingerprints if similarity is None else wide_fingerprints)(rows, text, ["__row", "doc_id"])
    wanted = kept.select(F.col("doc_id").alias("__id"), *[F.col(m).alias(f"__{m}") for m in marks], "component").distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__id"))
    for m in marks:
        same = same & (F.col(m) == F.col(f"__{m}"))
    single = marked.join(wanted, same).dropDuplicates(["doc_id", "component"]).select("__row.*")
    return out.unionByName(single)
