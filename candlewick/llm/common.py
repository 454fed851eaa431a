"""What several operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def word_list(c: Column | str) -> Column:
    """Words of a text: runs of characters other than space, tab and line breaks; null gives none."""
    return F.array_remove(F.split(text_or_empty(c), SPACES), "")


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 200) -> Iterator[pa.RecordBatch]:
    """Batches cut into short ones, so that what a worker makes of each stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Regroup Arrow batches that are sorted by ``key`` so that no run of equal keys is cut.

    Holds one batch and the run that is still open, which the callers bound beforehand.
    """
    held: pa.Table | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        keys = held.column(key).to_numpy()
        cut = int((keys != keys[-1]).nonzero()[0][-1]) + 1 if (keys != keys[-1]).any() else 0
        if cut:
            yield held.slice(0, cut)
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield held
