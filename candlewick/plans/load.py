"""Payloads to bronze, and bronze to silver."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick import schemas as S
from candlewick.operators.checks import Watch, raise_on_error
from candlewick.operators.payload import PARSED, classify, screen, validate
from candlewick.operators.ranking import insert_or_ignore
from candlewick.operators.series import load_counts, standardise, typed_rows
from candlewick.sources.bronze import write_bronze
from candlewick.sources.scratch import discard, materialise
from candlewick.sources.tables import append_audit, append_changes, append_quarantine, append_silver, stored_years

from .contracts import SILVER_ROW_CONTRACTS

ORIGIN = ("loaded_at", "file_path")


@dataclass(frozen=True)
class Landing:
    """What one landing run left out of bronze, and symbol and key of what it wrote."""

    failed: DataFrame
    invalid: DataFrame
    written: DataFrame


def land_payloads(payloads: DataFrame, path: str, run_time: str) -> Landing:
    """Classify, drop failures, validate and write the rest to bronze.

    ``payloads`` has ``symbol`` and ``payload``.  They are judged once, into a table that all the rest reads, so a
    source that cannot be read twice alike gives one answer.  The run stops when no extraction succeeded.
    """
    judged = materialise(validate(classify(payloads, keep_parsed=True)).drop(*PARSED), "judged-payloads")
    ok, failed = judged.filter("success"), judged.filter("NOT success")
    if ok.isEmpty():
        raise ValueError("no extraction was successful")
    written = write_bronze(ok.filter("is_valid"), path, run_time)
    return Landing(failed.drop("is_valid", "failed_check", "detail"), ok.filter("NOT is_valid"), written)


@dataclass(frozen=True)
class Load:
    """Counts per symbol and the payloads that were turned away; both are stored as well.

    ``totals`` are the figures of the whole load and ``report`` its row contracts, both measured by the writes themselves.
    ``release`` deletes the scratch tables that the frames are read from.
    """

    counts: DataFrame
    rejected: DataFrame
    totals: dict[str, int]
    report: DataFrame
    scratch: list[str] = field(default_factory=list)

    def release(self) -> None:
        discard(self.counts.sparkSession, self.scratch)


class PayloadsRejected(Exception):
    """A load that must be clean met payloads it had to turn away."""


TOTALS = ("rows_processed", "rows_loaded", "n_rejected", "rows_new")


def _batch_watch() -> Watch:
    """What the later steps ask of a typed batch: counts, years of the kept rows, days of the rejected ones.

    The calendar bounds the number of years and days.
    """
    turned_away = F.col("reject_reason").isNotNull()
    return Watch(
        rows_processed=F.count("price_date"),
        rows_loaded=F.count_if("is_kept"),
        n_rejected=F.count_if(turned_away),
        n_undated=F.count_if(turned_away & F.col("loaded_at").isNull()),
        days=F.collect_set(F.when(turned_away, F.to_date("loaded_at"))),
        years=F.collect_set(F.when(F.col("is_kept"), F.year("price_date"))),
    )


def bronze_to_silver(
    payloads: DataFrame, schema: str, run_time: str, raise_on_reject: bool = False, check: bool = False
) -> Load:
    """Load payloads (``symbol``, ``payload``, ``loaded_at``, ``file_path``) into silver.

    Rejected payloads go to the quarantine table with their reason; ``raise_on_reject`` stops the run after that, before
    silver is touched.  Running it again, also after a failure half way, adds nothing twice.  One writer per table.  ``check``
    stops it, likewise, where new rows break the row contracts of silver.
    """
    started = time.monotonic()
    used: list[str] = []
    screened = screen(payloads).withColumn("rejected_text", F.when(F.col("reject_reason").isNotNull(), F.col("payload")))
    # Payload text is parsed once, into this table: kept rows, counts and rejects all read it.
    watch, new_watch = _batch_watch(), Watch(SILVER_ROW_CONTRACTS, rows_new=F.count(F.lit(1)))
    typed = materialise(watch.on(typed_rows(screened, ("symbol", *ORIGIN, "rejected_text"))), "typed-batch", used)
    rejected = typed.filter("reject_reason IS NOT NULL").select(
        "symbol", *ORIGIN, "reject_reason", F.col("rejected_text").alias("payload")
    )
    if watch["n_rejected"]:
        append_quarantine(rejected, schema, [*watch["days"], *([None] if watch["n_undated"] else [])])
        if raise_on_reject:
            first = rejected.first()
            raise PayloadsRejected(f"payload of {first['symbol']} in {first['file_path']}: {first['reject_reason']}")
    batch = standardise(typed, run_time, keep=ORIGIN)
    # Landing time, then values: file names are random and only tell equal rows apart.
    order = ["loaded_at", *S.PRICE_COLUMNS, "volume", "file_path"]
    stored = stored_years(batch, schema, watch["years"])
    fresh = materialise(new_watch.on(insert_or_ignore(stored, batch, S.SILVER_KEY, order, used)), "new-rows", used)
    report = new_watch.report(payloads.sparkSession)
    if check:
        raise_on_error(report)
    if new_watch["rows_new"]:
        append_changes(fresh, schema)
        append_silver(fresh, schema)
    counts = materialise(load_counts(typed, fresh), "load-counts", used)
    append_audit(counts, schema, time.monotonic() - started)
    totals = {name: (new_watch if name == "rows_new" else watch)[name] for name in TOTALS}
    return Load(counts, rejected, totals, report, used)
