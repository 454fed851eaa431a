"""Trie of conversation prefixes, with totals rolled up band by band.

A node is a distinct sequence of first turns.  Its key is the exclusive or of two 64-bit hashes of each of its turns, which
take in the turn's place; so keys of prefixes are running figures that can be computed band by band and completed by the
figures of the bands before, and no conversation has to be read from start to end by one task.

Depths are cut into bands of one height: 8, or the square root of the greatest depth where that is more.  A node knows its
ancestors within its band, at most ``height``.  Totals of subtrees come from the deepest band up: every node sends its figures to its ancestors in its band only, the total of a node at the top
of a band is then complete and goes to its parent in the band above.  So there are as many rounds as bands, and no
row is copied more often than a band is high, however many conversations pass through a node.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.sources.scratch import materialise

from .ranking import ranked

BAND = 8
#: Ids of one chunk of a list that is hashed.
CHUNK = 4096
KEY = "struct<a:bigint,b:bigint>"


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``pos`` (0-based place by turn, null first), and of the turn its hashes ``t1``, ``t2`` and ``length``.

    Equal turn numbers are ordered by role and text, nulls as empty.  Rows without a conv_id belong to no conversation.  One range sort places
    all turns, so a conversation of any length is spread over tasks.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        "conv_id", F.col("turn").isNotNull().alias("known"), "turn", role.alias("role"), text.alias("text")
    )
    placed = ranked(rows, "conv_id", "known", "turn", "role", "text").select(
        "conv_id",
        "__rank",
        F.xxhash64("role", "text").alias("t1"),
        F.xxhash64(F.lit(1), "text", "role").alias("t2"),
        F.length("text").alias("length"),
    )
    placed = materialise(placed, "placed-turns")
    starts = placed.groupBy("conv_id").agg(F.min("__rank").alias("__first"))
    rows = placed.join(materialise(starts, "conversation-starts"), "conv_id")
    return rows.select("conv_id", (F.col("__rank") - F.col("__first")).alias("pos"), "t1", "t2", "length")


def rebuilt(turns: DataFrame, block: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations (``conv_id``, ``n_turns``) and their turns (``conv_id``, ``depth`` from 1, ``t1``, ``t2``, ``length``) as rebuilt.

    A conversation takes its first h turns from the first of its block of ids (all of them if there are fewer), h being its
    id's CRC-32 modulo ``heads``, and its own turns after its first h.
    """
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("taken")
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_own"))
    own = own.select("conv_id", "n_own", (F.col("conv_id") - F.col("conv_id") % block).alias("base"), taken)
    own = materialise(own, "own-turn-counts")
    bases = own.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    head = F.least("taken", F.coalesce("n_base", F.lit(0))).cast("bigint")
    rest = F.greatest(F.col("n_own") - F.col("taken"), F.lit(0))
    plans = own.join(bases, "base", "left").select("conv_id", "base", "taken", head.alias("head"), (head + rest).alias("n_turns"))
    plans = materialise(plans, "rebuilt-conversations")
    kept = turns.join(plans.select("conv_id", "taken", "head"), "conv_id").filter("pos >= taken")
    kept = kept.select("conv_id", (F.col("head") + F.col("pos") - F.col("taken") + 1).alias("depth"), "t1", "t2", "length")
    # A base lends at most heads - 1 turns to each of at most block conversations.
    lent = turns.filter(F.col("pos") < heads - 1).withColumnRenamed("conv_id", "base").join(plans.select("conv_id", "base", "head"), "base")
    lent = lent.filter("pos < head").select("conv_id", (F.col("pos") + 1).alias("depth"), "t1", "t2", "length")
    return plans.select("conv_id", "n_turns"), kept.unionByName(lent)


def _xor(x: Column, a: Column, b: Column) -> Column:
    return F.struct(x["a"].bitwiseXOR(a).alias("a"), x["b"].bitwiseXOR(b).alias("b"))


def prefixes(convs: DataFrame, turns: DataFrame, height: int = BAND) -> DataFrame:
    """A row per conversation and depth: ``conv_id``, ``depth``, ``key`` of the prefix, ``parent``, ``band``, ``ancestors`` in the band
    (itself included), ``length`` of the last text and ``ends`` where the conversation ends there.

    Bands start at depths 0, ``height``, ...; the root is the only node at depth 0.
    """
    a, b = F.xxhash64("depth", "t1", "t2"), F.xxhash64(F.lit(2), "t2", "t1", "depth")
    hashed = turns.select(
        "conv_id", "depth", F.expr(f"depth div {height}").cast("int").alias("band"), a.alias("a"), b.alias("b"), "length"
    )
    hashed = materialise(hashed, "hashed-turns")
    totals = hashed.groupBy("conv_id", "band").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    before = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        "conv_id", "band", *[F.coalesce(F.bit_xor(c).over(before), F.lit(0).cast("bigint")).alias(f"{c}0") for c in "ab"]
    )
    # The first band starts from nothing.
    carried = materialise(carried.filter("band > 0"), "carried-keys")
    # At most ``height`` turns of a conversation are in a band.
    so_far = Window.partitionBy("conv_id", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    running = hashed.select(
        "conv_id", "depth", "band", "length", *[F.bit_xor(c).over(so_far).alias(c) for c in "ab"]
    ).withColumn("ancestors", F.collect_list(F.struct("a", "b")).over(so_far))
    joined = running.join(carried, ["conv_id", "band"], "left").na.fill(0, ["a0", "b0"])
    key = _xor(F.struct("a", "b"), F.col("a0"), F.col("b0"))
    ancestors = F.transform("ancestors", lambda x: _xor(x, F.col("a0"), F.col("b0")))
    start = F.struct(F.col("a0").alias("a"), F.col("b0").alias("b"))
    root = F.struct(F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"))
    # Before the first turn of a band stands the last of the one above; in the first band that is the root, which is in it.
    parent = F.when(F.size("ancestors") > 1, F.element_at("ancestors", -2)).otherwise(start)
    placed = joined.withColumn("key", key).withColumn("ancestors", ancestors)
    placed = placed.withColumn("parent", parent)
    whole = F.when(F.col("band") == 0, F.concat(F.array(root), F.col("ancestors"))).otherwise(F.col("ancestors"))
    last = convs.select("conv_id", "n_turns")
    rows = placed.join(last, "conv_id").select(
        "conv_id", "depth", "key", "parent", "band", whole.alias("ancestors"), "length", (F.col("depth") == F.col("n_turns")).alias("ends")
    )
    tops = convs.select(
        "conv_id",
        F.lit(0).cast("bigint").alias("depth"),
        root.alias("key"),
        F.lit(None).cast(KEY).alias("parent"),
        F.lit(0).alias("band"),
        F.array(root).alias("ancestors"),
        F.lit(0).alias("length"),
        (F.col("n_turns") == 0).alias("ends"),
    )
    return rows.unionByName(tops)


def _ends(rows: DataFrame) -> DataFrame:
    """``key`` and ``ends_sha256``: hash of the ids of the conversations that end at a node, ascending and comma-joined.

    Ids are sorted over all tasks and joined in chunks; a node's chunks, one row for ``CHUNK`` ids, are then hashed in a stream.
    """
    placed = ranked(rows.filter("ends").select("key.a", "key.b", "conv_id"), "a", "b", "conv_id")
    chunk = F.expr(f"__rank div {CHUNK}")
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string"))
    chunks = placed.groupBy("a", "b", chunk.alias("chunk")).agg(F.array_join(ids, ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            for a, b, text in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids"))):
                if (a, b) == now:
                    state.update(b"," + text.encode())
                    continue
                if now is not None:
                    done.append((*now, state.hexdigest()))
                now, state = (a, b), hashlib.sha256(text.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(("a", "b", "ends_sha256"), r)) for r in done], schema=schema)
        if now is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(("a", "b", "ends_sha256"), (*now, state.hexdigest())))], schema=schema)

    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("ends_sha256", pa.string())])
    dealt = chunks.repartition("a", "b").sortWithinPartitions("a", "b", "chunk")
    return dealt.mapInArrow(run, "a bigint, b bigint, ends_sha256 string").select(F.struct("a", "b").alias("key"), "ends_sha256")


def rolled_up(nodes: DataFrame, figures: list[str]) -> DataFrame:
    """``key`` and the sums of ``figures`` over the subtree of each node (``key``, ``parent``, ``band``, ``ancestors``).

    Deepest band first; ``ancestors`` ends in the node itself and starts at the top of its band.
    """
    deepest = nodes.agg(F.max("band")).first()[0]
    if deepest is None:
        return nodes.select("key", *figures)
    sent, done = None, []
    for band in range(deepest, -1, -1):
        own = nodes.filter(F.col("band") == band)
        rows = own.select("ancestors", *figures)
        if sent is not None:
            # Totals of the band below meet their parents here; its siblings are summed first.
            ways = own.select("key", "ancestors").join(sent, "key").select("ancestors", *figures)
            rows = rows.unionByName(ways)
        sums = rows.select(F.explode("ancestors").alias("key"), *figures).groupBy("key").agg(*[F.sum(f).alias(f) for f in figures])
        sums = materialise(sums, "band-totals")
        done.append(sums)
        if band:
            tops = own.filter(F.size("ancestors") == 1).select("key", "parent")
            up = sums.join(tops, "key").groupBy("parent").agg(*[F.sum(f).alias(f) for f in figures])
            sent = materialise(up.withColumnRenamed("parent", "key"), "band-tops")
    return reduce(DataFrame.unionByName, done)


def band_height(convs: DataFrame) -> int:
    """Least height of a band that keeps the number of bands from outgrowing it."""
    return max(BAND, math.isqrt(convs.agg(F.max("n_turns")).first()[0] or 0))


def trie(convs: DataFrame, turns: DataFrame, height: int | None = None) -> DataFrame:
    """A row per node of the trie of conversations (``conv_id``, ``n_turns``) and their turns (``conv_id``, ``depth``, ``t1``, ``t2``, ``length``).

    ``conv_id`` is the smallest member, ``n_convs`` the number of members, ``n_children`` that of longer sequences by one turn,
    ``n_leaves`` that of childless nodes below or at the node, ``saved_tokens`` the sum below and at it of the members but one times
    the length of the last text, ``ends_sha256`` the hash of the ids that end there.  Without conversations there is no node.
    """
    rows = materialise(prefixes(convs, turns, height or band_height(convs)), "prefixes")
    nodes = rows.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        *[F.any_value(c).alias(c) for c in ("depth", "parent", "band", "ancestors", "length")],
    )
    nodes = materialise(nodes, "trie-nodes")
    children = nodes.filter("depth > 0").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = nodes.join(children, "key", "left").na.fill(0, ["n_children"])
    counted = counted.withColumns(
        {
            "n_leaves": (F.col("n_children") == 0).cast("bigint"),
            "saved_tokens": (F.col("n_convs") - 1) * F.col("length"),
        }
    )
    # Sorted, so that a round reads little beside its own band.
    counted = materialise(counted.sortWithinPartitions("band"), "trie-figures")
    totals = rolled_up(counted, ["n_leaves", "saved_tokens"])
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    rest = counted.select("key", "conv_id", "depth", "parent", "n_convs", "n_children")
    return (
        rest.join(totals, "key")
        .join(_ends(rows), "key", "left")
        .join(parents, "parent", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )
