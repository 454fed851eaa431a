"""Delimited files: the metadata seed and general scans with or without tolerance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from candlewick import schemas as S


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    tolerant: bool = True,
    corrupt_column: str | None = None,
) -> DataFrame:
    """CSV scan with a header and a fixed schema.

    Tolerant: a value that does not fit its type becomes null, and the row's text is kept in
    ``corrupt_column`` when one is named.  Otherwise the first bad value fails the job.
    """
    reader = spark.read.option("header", True).option("encoding", "UTF-8")
    if not tolerant:
        return reader.option("mode", "FAILFAST").schema(schema).csv(path)
    reader = reader.option("mode", "PERMISSIVE")
    if corrupt_column is not None:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(schema).csv(path)


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """Metadata seed: symbol, company_name, sector, industry."""
    return read_csv(spark, path, S.SEED_SCHEMA, tolerant=False)


def default_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(S.STOCK_METADATA, S.SEED_SCHEMA)
