"""Shards of bounded size by extendible hashing.

Every row has a string of hash bits, and a bucket is a prefix of it.  The root holds everything; only a bucket above
the byte limit splits on its next bit, so a shard is the shortest prefix whose rows fit.  Bytes are
summed per prefix of one chosen depth and rolled up from there; rows of prefixes that are still too large
at that depth go on to the next round, alone.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.sources.scratch import materialise

from .common import text_or_empty

#: A shard that one request fetches whole.
LIMIT_BYTES = 1 << 20
#: Bits taken from the content of a row; further ones come from its place, and tell equal rows apart.
BITS = 60
#: Bits that a round looks beyond the depth of evenly filled shards.
SPARE_BITS = 4


def content_digest(key: Column, text: Column) -> Column:
    return F.md5(F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("null")), text_or_empty(text)))


def _bits(digest: Column) -> Column:
    return F.lpad(F.conv(F.substring(digest, 1, BITS // 4), 16, 2), BITS, "0")


def prefix(depth: int) -> Column:
    """The first ``depth`` bits of a row with ``__digest`` and ``__row``."""
    bits = _bits(F.col("__digest"))
    if depth > BITS:
        bits = F.concat(bits, _bits(F.md5(F.col("__row").cast("string"))))
    return F.substring(bits, 1, depth)


def assign(
    docs: DataFrame,
    limit: int = LIMIT_BYTES,
    text: str = "text",
    key: str = "doc_id",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Columns ``keep`` (all by default), ``n_bytes``, ``shard`` (its prefix), ``depth``, ``shard_bytes`` and ``shard_rows``.

    Equal rows are dealt by their place once their content's bits are used up.  A row that is larger than the limit is a
    shard of its own; a null text has no bytes, a null key is a key like others.  Columns named like the
    added ones are replaced.
    """
    added = ("n_bytes", "shard", "depth", "shard_bytes", "shard_rows")
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in added]
    rows = materialise(
        docs.select(
            *kept,
            F.octet_length(text_or_empty(docs[text])).cast("bigint").alias("n_bytes"),
            content_digest(docs[key], docs[text]).alias("__digest"),
            F.monotonically_increasing_id().alias("__row"),
        ),
        "hashed-rows",
    )
    total = rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    top, depth = 0, max(0, math.ceil(math.log2(max(1, total / limit)))) + SPARE_BITS
    pending, out = rows, []
    while True:
        cells = pending.groupBy(prefix(depth).alias("cell")).agg(
            F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("n")
        )
        cells = materialise(cells, "hash-cells")
        paths = cells.select("*", F.explode(F.sequence(F.lit(top), F.lit(depth))).alias("depth")).select(
            "cell", "bytes", "n", "depth", F.col("cell").substr(F.lit(1), F.col("depth")).alias("shard")
        )
        buckets = paths.groupBy("shard", "depth").agg(F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("shard_rows"))
        full = depth >= 2 * BITS
        fits = buckets.filter((F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1) | F.lit(full) & (F.col("depth") == depth))
        # The shortest prefix that fits; all shorter ones are too large, as sums only fall.
        # Both sides grow with the number of shards, and lie by prefix already: no broadcast.
        best = paths.select("cell", "shard", "depth").join(fits.hint("merge"), ["shard", "depth"]).groupBy("cell").agg(
            F.min(F.struct("depth", "shard", "shard_bytes", "shard_rows")).alias("s")
        )
        directory = materialise(best.select(F.col("cell").alias("__cell"), "s.*"), "shard-directory")
        named = pending.withColumn("__cell", prefix(depth))
        out.append(
            named.join(directory, "__cell").select(
                *kept, "n_bytes", "shard", "depth", "shard_bytes", "shard_rows"
            )
        )
        open_cells = materialise(cells.join(directory.hint("merge"), F.col("cell") == F.col("__cell"), "left_anti").select(F.col("cell").alias("__open")), "open-cells")
        if open_cells.isEmpty():
            break
        pending = materialise(named.join(open_cells, F.col("__cell") == F.col("__open"), "left_semi").drop("__cell"), "open-rows")
        top, depth = depth + 1, min(depth + 8, 2 * BITS) if depth != BITS else depth + 8
    shards = out[0]
    for part in out[1:]:
        shards = shards.unionByName(part)
    return shards


def write(docs: DataFrame, path: str, limit: int = LIMIT_BYTES) -> DataFrame:
    """Write one folder of documents per shard; returns ``assign``'s list of shards."""
    dealt = assign(docs, limit)
    columns = ["n_bytes", "depth", "shard_bytes", "shard_rows"]
    dealt = materialise(dealt, "dealt-rows")
    named = dealt.withColumn("shard", F.concat(F.lit("b"), "shard")).drop(*columns)
    named.repartition("shard").write.partitionBy("shard").parquet(path)
    return dealt.select("shard", "depth", "shard_bytes", "shard_rows").distinct()
