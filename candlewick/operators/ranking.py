"""First-per-key choice, insert-or-ignore, and small sorted selections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewick.sources.scratch import materialise

_RANK = "__rank"


def rows_where(df: DataFrame, flag: Column | str) -> DataFrame:
    """Rows whose flag is true, for a flag that costs much to compute.

    The optimizer would push a plain filter below the projection that computes the flag and copy the
    whole expression, payload parsing included, once per reference.  It does not look into a generator,
    so here the flag is computed once per row.
    """
    flag = F.col(flag) if isinstance(flag, str) else flag
    kept = F.explode(F.when(flag, F.array(F.lit(True))))
    return df.select("*", kept.alias("__kept")).drop("__kept")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first under ``order``, which should be total.

    ``row_number() = 1`` lets the optimizer keep one row per key in every map task before the
    shuffle, so even a key that holds most rows sends at most one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(_RANK, rank).filter(F.col(_RANK) == 1).drop(_RANK)


def insert_or_ignore(
    existing: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    used: list[str] | None = None,
) -> DataFrame:
    """Rows of ``batch`` to append: the first per key, and only keys not stored yet.

    Stored keys are never updated.  The batch holds one row per key before the join, so no key is
    hot in it.  It is written first: with its real size known, stored keys stream past the batch's where those can be
    broadcast, and are neither shuffled nor sorted; the few hits are then taken out of the batch.
    """
    fresh = materialise(first_per_key(batch, keys, order), "first-per-key", used)
    hits = existing.select(*keys).join(fresh.select(*keys), list(keys), "left_semi")
    return fresh.join(hits, list(keys), "left_anti").select(*batch.columns)


def upserted(
    existing: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """The whole table as it stands after the load."""
    return existing.unionByName(insert_or_ignore(existing, batch, keys, order).select(*existing.columns))


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """Values offered by a selector."""
    return df.select(column).distinct().orderBy(column)


def first_n(df: DataFrame, column: str, n: int = 3) -> DataFrame:
    """The first ``n`` distinct values: a selector's default choice."""
    return distinct_sorted(df, column).limit(n)
