"""Global row numbers without a window over all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.sources.scratch import materialise


def ranked(rows: DataFrame, *columns: str) -> DataFrame:
    """``rows`` with ``__rank``, the 0-based place in the order by ``columns``, nulls last.

    The range sort numbers rows within each partition; only one count per partition meets in a window.
    """
    ordered = rows.orderBy(*[F.col(c).asc_nulls_last() for c in columns])
    placed = materialise(ordered.withColumn("__at", F.monotonically_increasing_id()), "sorted-rows")
    part = F.shiftright("__at", 33)
    counts = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")
    starts = counts.select("__part", before.alias("__start"))
    return (
        placed.withColumn("__part", part)
        .join(starts, "__part")
        .withColumn("__rank", F.col("__start") + F.col("__at").bitwiseAND((1 << 33) - 1))
        .drop("__part", "__start", "__at")
    )
