"""Raw payload files under ``symbol=<s>/date=<d>/run=<HHMMSS>/``.

One run lands a symbol in one folder, however many files it takes, so the newest landing of a symbol is the greatest
(date, run) and all of its files.

A folder and a file for each symbol cost more than their payloads where symbols are many and small.  Such a source is landed
packed: JSON lines of symbol and payload under ``date=<d>/run=<HHMMSS>/``, with as many files as its size asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.utils import AnalysisException

from candlewick.functions import strict_date

from .scratch import discard, materialise

# Given, never inferred: a folder of numeric tickers would turn `symbol` into an integer.
BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("payload", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("run", T.StringType()),
    ]
)


# Characters that Spark writes as %XX in the names of partition folders.
_ESCAPED = {*"\"#%'*/:=?\\{[]^\x7f", *map(chr, range(1, 32))}


def folder_name(value: str) -> str:
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in value)


def _run_names(run_time: str) -> tuple[Column, Column]:
    """Date and run, as the folders of a landing have them."""
    at = F.lit(run_time).cast("timestamp_ntz")
    return F.date_format(at, "yyyy-MM-dd"), F.date_format(at, "HHmmss")


def _lines(payloads: DataFrame, run_time: str) -> DataFrame:
    day, run = _run_names(run_time)
    text = F.regexp_replace("payload", r"[\r\n]+", " ")
    return payloads.select(text.alias("payload"), "symbol", day.alias("date"), run.alias("run"))


def write_bronze(payloads: DataFrame, path: str, run_time: str) -> DataFrame:
    """Land payloads (``symbol``, ``payload``) of one run; returns ``symbol`` and ``key`` of what it wrote.

    The folder of a symbol and run holds what its last landing wrote, so a repeated run, also after one that died half way,
    leaves each payload once.  Folders of other symbols and runs stay.

    One line per payload.  JSON has no raw line breaks inside strings, so those between tokens are
    replaced by blanks and the document stays the same.
    """
    day, run = _run_names(run_time)
    (
        _lines(payloads, run_time)
        # A few files per symbol instead of one per task; a large symbol is split again.
        .hint("rebalance", "symbol")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("symbol", "date", "run")
        .text(path)
    )
    key = F.concat(F.lit("symbol="), "symbol", F.lit("/date="), day, F.lit("/run="), run)
    return payloads.select("symbol").distinct().select("symbol", key.alias("key"))


def write_packed(payloads: DataFrame, path: str, run_time: str) -> None:
    """Land payloads (``symbol``, ``payload``) of one run in files that many symbols share.

    As in ``write_bronze`` a repeated run leaves each payload once and other symbols and runs stay: what the run has landed of
    other symbols is written again beside the new payloads.  The folder of the run is replaced in one piece.
    """
    spark, rows, used = payloads.sparkSession, _lines(payloads, run_time), []
    day, run = _run_names(run_time)
    try:
        landed = _packed(spark.read, path).filter((F.col("date") == day) & (F.col("run") == run))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        landed = None
    if landed is not None and not landed.isEmpty():
        rows = materialise(rows, "packed-payloads", used)
        new = rows.select(F.col("symbol").alias("__symbol")).distinct()
        others = landed.join(new, F.col("symbol").eqNullSafe(F.col("__symbol")), "left_anti")
        rows = rows.unionByName(materialise(others, "packed-others", used))
    (
        rows.hint("rebalance", "symbol")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "run")
        .json(path)
    )
    discard(spark, used)


def _packed(reader: DataFrameReader | DataStreamReader, path: str) -> DataFrame:
    return reader.schema(BRONZE_SCHEMA).json(path)


def with_origin(df: DataFrame, whole_files: bool = False) -> DataFrame:
    """Add landing time and file of each payload; the time orders payloads of one symbol.

    Blank lines are no payloads; a blank file is one, and unreadable.
    """
    rows = df if whole_files else df.filter(F.length(F.trim("payload")) > 0)
    landed = F.try_to_timestamp(F.concat_ws(" ", "date", F.coalesce("run", F.lit("000000"))), F.lit("yyyy-MM-dd HHmmss"))
    return rows.select(
        "symbol",
        strict_date("date").alias("date"),
        "run",
        "payload",
        landed.alias("loaded_at"),
        F.col("_metadata.file_path").alias("file_path"),
    )


def landed_lines(reader: DataFrameReader | DataStreamReader, path: str, whole_files: bool = False, packed: bool = False) -> DataFrame:
    """Payloads under ``path`` with their origin, from a batch or a stream reader; packed files have no whole documents to read."""
    if packed and whole_files:
        raise ValueError("packed files hold a payload a line")
    rows = _packed(reader, path) if packed else reader.schema(BRONZE_SCHEMA).text(path, wholetext=whole_files)
    return with_origin(rows, whole_files)


def _scan(spark: SparkSession, path: str, whole_files: bool, symbol: str | None = None) -> DataFrame:
    """Payload lines or files, of one symbol's folder only when one is named."""
    reader = spark.read.schema(BRONZE_SCHEMA).option("basePath", path)
    return reader.text(path if symbol is None else f"{path}/symbol={folder_name(symbol)}", wholetext=whole_files)


def read_bronze(spark: SparkSession, path: str, whole_files: bool = False, packed: bool = False) -> DataFrame:
    """All payloads: one per line, or one per file for documents printed over several lines; ``packed`` as ``write_packed`` lands them."""
    return landed_lines(spark.read.option("basePath", path), path, whole_files, packed)


FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def landings(files: DataFrame) -> DataFrame:
    """``symbol`` and ``at`` (date and run) of each payload file, from its path."""
    # Folder names escape special characters, but leave a plus as it is.
    name = F.replace(F.regexp_extract("path", r"/symbol=([^/]+)/", 1), F.lit("+"), F.lit("%2B"))
    placed = files.select(
        F.url_decode(name).alias("symbol"),
        F.struct(
            F.regexp_extract("path", r"/date=([^/]+)/", 1).alias("date"),
            F.regexp_extract("path", r"/run=([^/]+)/", 1).alias("run"),
        ).alias("at"),
    )
    return placed.filter("symbol <> ''")


def newest_landings(spark: SparkSession, path: str, symbol: str | None = None) -> DataFrame:
    """Symbol, date and run of the newest landing of each symbol, from the listing alone.

    ``content`` is pruned from the binary scan, so no payload is read for this.
    """
    folder = path if symbol is None else f"{path}/symbol={folder_name(symbol)}"
    listing = landings(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder))
    return listing.groupBy("symbol").agg(F.max("at").alias("at")).select("symbol", "at.*")


def latest_bronze(
    spark: SparkSession, path: str, whole_files: bool = False, symbol: str | None = None
) -> DataFrame:
    """Payloads of the newest landing of each symbol, or of one symbol; finding none is an error.

    The written list is small beside the payloads, and its dates, runs and symbols prune the partitions that
    the payload scan opens.  With a symbol, nothing but its folder is listed.
    """
    try:
        newest = materialise(newest_landings(spark, path, symbol), "newest-landings")
    except AnalysisException as e:
        if symbol is None or "PATH_NOT_FOUND" not in str(e):
            raise
        raise ValueError(f"no payload files for {symbol} under {path}") from e
    if newest.isEmpty():
        raise ValueError(f"no payload files for {symbol or 'any symbol'} under {path}")
    located = _scan(spark, path, whole_files, symbol).select("*", "_metadata")
    # The optimizer prunes partitions by a table that it sees a predicate on.
    chosen = located.join(newest.filter("symbol <> ''"), ["symbol", "date", "run"], "left_semi")
    return with_origin(chosen, whole_files)
