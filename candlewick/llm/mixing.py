"""Mixing sources to target weights.

Sizes are summed per source, targets follow from weights with a ceiling on repetition, and each document is
taken floor(rate) times, plus once more if a hash of its id and the seed falls below the fraction; rows that
repeat an id draw by their place among such rows as well.  All of
it is DataFrame expressions: a source with a third of the documents is summed before the shuffle, and its
documents are joined to one row per source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.sources.scratch import materialise

from .common import text_or_empty
from .ranking import ranked

WEIGHTS = (5, 2, 1)
MAX_RATE = 3
SEED = 7


def word_count(c: Column | str) -> Column:
    return F.regexp_count(text_or_empty(c), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def uniform(key: Column, seed: int = SEED, place: Column | None = None) -> Column:
    """A number in [0, 1) that depends on the key, the seed and a place if there is one; a null key is a key of its own."""
    parts = [F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("null"))]
    # A null place is left out.
    digest = F.md5(F.concat_ws(":", *parts, *([] if place is None else [place.cast("string")])))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint") / F.lit(float(1 << 48))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_rate: float = MAX_RATE) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from ``sizes`` (``source``, ``source_size``).

    The weights repeat over the sources in their order.  Targets share the sum of all sizes; a target
    stops at ``max_rate`` times its source, and what is left is shared again by weight among the others until none
    is above.  Sources of size 0 have target 0.
    """
    number = F.pmod("__rank", F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (number + 1).cast("int"))
    placed = materialise(ranked(sizes, "source").withColumn("__w", weight).drop("__rank"), "weighted-sources")
    cap = F.col("source_size") * float(max_rate)
    total = placed.agg(F.sum(F.col("source_size").cast("double")).alias("t")).first()["t"] or 0.0
    # The common level (target per weight) only rises from round to round, so capped sources stay capped.
    top, bottom, n_capped = total, None, None
    while True:
        is_capped = F.lit(False) if bottom is None else cap * F.lit(bottom) < F.col("__w") * F.lit(top)
        held = placed.agg(
            F.count_if(is_capped).alias("n"),
            F.coalesce(F.sum(F.when(is_capped, cap)), F.lit(0.0)).alias("capped"),
            F.coalesce(F.sum(F.when(~is_capped, F.col("__w"))), F.lit(0.0)).alias("open"),
        ).first()
        if held["n"] == n_capped:
            break
        n_capped, top, bottom = held["n"], total - held["capped"], held["open"]
    target = F.when(cap * F.lit(bottom) < F.col("__w") * F.lit(top), cap).otherwise(
        F.try_divide(F.col("__w") * F.lit(top), F.lit(bottom))
    )
    return placed.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def _told_apart(sized: DataFrame) -> DataFrame:
    """``sized`` with ``__place``: null, but for rows that repeat an id their number among all such rows.

    They are ordered by id, source, size and text, so it does not matter how equal ones are stored.
    """
    ids = sized.groupBy("doc_id").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select(F.col("doc_id").alias("__id"))
    ids = materialise(ids, "repeated-ids")
    if ids.isEmpty():
        return sized.withColumn("__place", F.lit(None).cast("bigint"))
    is_repeated = F.col("doc_id").eqNullSafe(F.col("__id"))
    text = next((F.xxhash64(c) for c in ("__text", "text") if c in sized.columns), F.lit(0))
    # The last sort key lets a range sort cut through equal rows.
    rows = sized.join(ids, is_repeated, "left_semi").withColumns({"__hash": text, "__at_row": F.monotonically_increasing_id()})
    numbered = ranked(materialise(rows, "repeated-rows"), "doc_id", "source", "size", "__hash", "__at_row")
    numbered = numbered.withColumnRenamed("__rank", "__place").drop("__hash", "__at_row")
    others = sized.join(ids, is_repeated, "left_anti").withColumn("__place", F.lit(None).cast("bigint"))
    return others.unionByName(numbered)


def plan(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_rate: float = MAX_RATE, seed: int = SEED) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies``.

    A null text has size 0, a null source is a source of its own and the last one; rows that repeat an id are
    drawn each for itself.  ``docs`` needs ``doc_id``, ``source`` and either ``text`` or a ``size`` counted before; other
    columns named like the added ones are replaced.
    """
    sized = docs if "size" in docs.columns else docs.withColumn("size", word_count("text"))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = targets(sizes, weights, max_rate)
    goals = materialise(goals.withColumnRenamed("source", "__source"), "source-targets")
    columns = [c for c in sized.columns if c.lower() not in ("source_size", "target", "copies")]
    rate = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    extra = uniform(F.col("doc_id"), seed, F.col("__place")) < rate - F.floor(rate)
    joined = _told_apart(sized.select(*columns)).join(goals, F.col("source").eqNullSafe(F.col("__source")))
    return joined.withColumn("copies", (F.floor(rate) + extra.cast("int")).cast("int")).drop("__source", "__place")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_rate: float = MAX_RATE, seed: int = SEED) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with their own columns."""
    columns = docs.columns
    rows = docs.select(F.struct("*").alias("__row"), "doc_id", "source", word_count("text").alias("size"), F.xxhash64("text").alias("__text"))
    planned = plan(rows, weights, max_rate, seed)
    taken = planned.filter("copies > 0").select("__row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return taken.select(*[F.col(f"__row.`{c}`") for c in columns])
