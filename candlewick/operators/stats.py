"""Grouped statistics that hold when one group has most of the rows.

Nothing here gathers a group in one task.  Group figures come from partial aggregates; where a row
needs the figure of its group, the aggregate is written and joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from candlewick.sources.scratch import materialise


def moments(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Number (``n``), mean and summed squared deviations (``m2``) of a value per key: figures that can be merged."""
    x = F.col(value).cast("double")
    return df.groupBy(*keys).agg(
        F.count(x).cast("double").alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2")
    )


def merge_moments(a: Column, b: Column) -> Column:
    """Chan's rule: the moments of two sets of values from those of each."""
    n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
    share = b["n"] / F.nullif(n, F.lit(0.0))
    return F.struct(
        n.alias("n"),
        (a["mean"] + F.coalesce(apart * share, F.lit(0.0))).alias("mean"),
        (a["m2"] + b["m2"] + F.coalesce(apart * apart * a["n"] * share, F.lit(0.0))).alias("m2"),
    )


def merged_moments(parts: DataFrame, key: str) -> DataFrame:
    """``key``, ``n``, ``mean`` and ``m2`` of whole groups from the moments of their parts, which are few per key."""
    none = F.struct(*[F.lit(0.0).alias(c) for c in ("n", "mean", "m2")])
    found = parts.filter("n > 0").groupBy(key).agg(F.sort_array(F.collect_list(F.struct("n", "mean", "m2"))).alias("parts"))
    return found.select(key, F.aggregate("parts", none, merge_moments).alias("all")).select(key, "all.*")


def with_zscore(df: DataFrame, key: str, value: str, out: str = "z_score", stored: DataFrame | None = None) -> DataFrame:
    """Add ``(value - group mean) / group sample deviation``.

    A group of one row, or one without spread, gets null.  A window over ``key`` would put a whole
    group in one task; here each group is one row of a written lookup.  With ``stored`` moments (``key``, ``n``, ``mean``,
    ``m2``) the rows are not read for the group figures.
    """
    x = F.col(value).cast("double")
    if stored is None:
        stats = df.groupBy(F.col(key).alias("_group")).agg(F.avg(x).alias("_mean"), F.stddev_samp(x).alias("_std"))
    else:
        spread = F.sqrt(F.col("m2") / F.nullif(F.col("n") - 1, F.lit(0.0)))
        stats = stored.select(F.col(key).alias("_group"), F.col("mean").alias("_mean"), spread.alias("_std"))
    stats = materialise(stats, "group-stats")
    score = (x - F.col("_mean")) / F.nullif(F.col("_std"), F.lit(0.0))
    joined = df.join(stats, F.col(key).eqNullSafe(F.col("_group")), "left")
    return joined.withColumn(out, score).drop("_group", "_mean", "_std")


def share_of_total(df: DataFrame, key: str, value: str, out: str = "share") -> DataFrame:
    """Sum per group and its part of the total, the total as a scalar subquery."""
    sums = df.groupBy(key).agg(F.sum(value).alias(value))
    total = sums.select(F.sum(value).cast("double")).scalar()
    return sums.withColumn(out, F.col(value).cast("double") / F.nullif(total, F.lit(0.0)))


def grouped_quantiles(
    df: DataFrame,
    key: str,
    value: str,
    probs: Sequence[float] = (0.25, 0.5, 0.75),
) -> DataFrame:
    """Exact interpolated quantiles of a decimal column, with min, max and count per group.

    Rows collapse to counts per distinct value first.  A first pass finds, from totals per value
    range, which ranges hold the wanted ranks; only those are ordered value by value.  A decimal has a
    finite number of values between the extremes of its group; the ranges are as many as the values in each, so
    neither pass orders more than the square root of that number for one group.
    """
    dtype = df.schema[value].dataType
    if not isinstance(dtype, T.DecimalType):
        raise TypeError(f"{value} must be a decimal; its scale bounds the values in a range")
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(F.col(key).alias("_key"), F.col(value).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    counts = materialise(counts, "value-counts")
    # Each group has ranges of its own, so an outlier in one leaves the others as they are.
    step = 10.0**-dtype.scale
    extent = (F.max("_value") - F.min("_value")).cast("double") / F.lit(step) + 1
    extremes = counts.groupBy(F.col("_key").alias("_k")).agg(
        F.min("_value").cast("double").alias("_lowest"), ((F.floor(F.sqrt(extent)) + 1) * F.lit(step)).alias("_width")
    )
    extremes = materialise(extremes, "group-extremes")
    # Doubles are enough here: each step keeps the order of the values, and equal values stay together.
    offset = F.col("_value").cast("double") - F.col("_lowest")
    counts = counts.join(extremes, F.col("_key").eqNullSafe(F.col("_k"))).select(
        "_key", "_value", "_n", F.floor(offset / F.col("_width")).cast("bigint").alias("_range")
    )

    ranges = counts.groupBy("_key", "_range").agg(
        F.sum("_n").alias("_in_range"), F.min("_value").alias("_low"), F.max("_value").alias("_high")
    )
    by_key = Window.partitionBy("_key")
    running = by_key.orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        ranges.withColumn("_total", F.sum("_in_range").over(by_key))
        .withColumn("_before", F.sum("_in_range").over(running) - F.col("_in_range"))
        .withColumn("_min", F.min("_low").over(by_key))
        .withColumn("_max", F.max("_high").over(by_key))
    )
    wanted = F.array(
        *[
            F.struct(
                F.lit(i).alias("prob"), F.lit(upper).alias("upper"), (F.ceil(pos) if upper else F.floor(pos)).alias("rank")
            )
            for i, p in enumerate(probs)
            for pos in [F.lit(float(p)) * (F.col("_total") - 1)]
            for upper in (False, True)
        ]
    )
    hit = (F.col("want.rank") >= F.col("_before")) & (F.col("want.rank") < F.col("_before") + F.col("_in_range"))
    targets = materialise(placed.select("*", F.explode(wanted).alias("want")).filter(hit), "rank-targets")

    needed = targets.select(F.col("_key").alias("_k"), F.col("_range").alias("_r")).distinct()
    same_range = F.col("_key").eqNullSafe(F.col("_k")) & F.col("_range").eqNullSafe(F.col("_r"))
    in_range = Window.partitionBy("_k", "_r").orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    ordered = (
        counts.join(needed, same_range, "inner")
        .select("_k", "_r", "_value", "_n")
        .withColumn("_upto", F.sum("_n").over(in_range))
    )
    rank = F.col("want.rank") - F.col("_before")
    found = targets.join(ordered, same_range, "inner").filter(
        (rank < F.col("_upto")) & (rank >= F.col("_upto") - F.col("_n"))
    )

    def at(i: int, upper: bool):
        mine = (F.col("want.prob") == i) & (F.col("want.upper") == F.lit(upper))
        return F.max(F.when(mine, F.col("_value").cast("double")))

    picked = found.groupBy("_key").agg(
        F.max("_total").alias("n"),
        F.max("_min").cast("double").alias("min"),
        F.max("_max").cast("double").alias("max"),
        *[at(i, upper).alias(f"_q{i}_{int(upper)}") for i in range(len(probs)) for upper in (False, True)],
    )
    names = [f"q{p * 100:g}".replace(".", "_") for p in probs]
    quantiles = []
    for i, (p, name) in enumerate(zip(probs, names, strict=True)):
        pos = F.lit(float(p)) * (F.col("n") - 1)
        low, high = F.col(f"_q{i}_0"), F.col(f"_q{i}_1")
        quantiles.append((low + (high - low) * (pos - F.floor(pos))).alias(name))
    return picked.select(F.col("_key").alias(key), "n", "min", *quantiles, "max")

