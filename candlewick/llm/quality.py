"""Quality rules whose cutoffs carry a risk guarantee.

Every rule scores a document from 0 to 1000 and rejects scores at or above its cutoff.  Half of the
labelled documents (by a hash of their id) say which cutoff separates bad from good best; the other
half, the holdout, must certify it: with ``n`` good documents of a stratum of which ``k`` would go,
the exact binomial tail ``P(Bin(n, risk) <= k)`` has to stay below the level left by Bonferroni over all
strata and rules.  Rejections only grow as a cutoff falls, so testing from the loosest cutoff down
needs no further correction, and the strictest certified cutoff bounds the choice.  A rule without a certified
cutoff in a stratum rejects nothing there: few labels mean few rejections, never the other way round.

All of it is DataFrame expressions; only counts per stratum, rule and score are shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.sources.scratch import materialise

from .common import text_or_empty, word_list

SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Share of good documents that all rules together may reject in a stratum, and the chance that
#: any of the guarantees fails.
RISK = 0.04
ERROR_LEVEL = 0.05
#: Rejecting a good document costs as much as keeping this many bad ones.
GOOD_WEIGHT = 5

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")

#: Rule name to what it counts and out of how many.
RULES: dict[str, tuple[str, str]] = {
    "symbols": ("n_symbols", "word_chars"),
    "capitals": ("n_capitals", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
}


def measure(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all by default) and the ``MEASURES`` of each document.

    A null text counts as empty, and an empty one measures zero everywhere.  Input columns named like
    a measure are replaced.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in MEASURES]
    split = docs.select(*kept, text_or_empty(docs[text]).alias("__text"), word_list(docs[text]).alias("__words"))
    n = F.size("__words")
    room = F.greatest(n - 2, F.lit(0))
    windows = F.arrays_zip(
        F.slice("__words", F.lit(1), room).alias("a"),
        F.slice("__words", F.lit(2), room).alias("b"),
        F.slice("__words", F.lit(3), room).alias("c"),
        F.when(room > 0, F.sequence(F.lit(1), room)).otherwise(F.array().cast("array<int>")).alias("at"),
    )
    listed = split.select(
        *kept,
        "__text",
        "__words",
        # Equal windows become neighbours.
        F.sort_array(windows).alias("__windows"),
        F.filter(F.split("__text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("__lines"),
    )
    neighbours = F.arrays_zip(
        F.col("__windows").alias("x"), F.slice("__windows", F.lit(2), F.size("__windows")).alias("y")
    )
    same = F.filter(
        neighbours,
        lambda p: (p["x"]["a"] == p["y"]["a"]) & (p["x"]["b"] == p["y"]["b"]) & (p["x"]["c"] == p["y"]["c"]),
    )
    covered = F.transform(same, lambda p: F.array(*[p[side]["at"] + i for side in ("x", "y") for i in range(3)]))
    return listed.select(
        *kept,
        F.size("__words").cast("bigint").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("__text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint").alias("n_dup_lines"),
        F.size(F.array_distinct(F.flatten(covered))).cast("bigint").alias("n_repeat_words"),
        F.size("__lines").cast("bigint").alias("n_lines"),
        F.regexp_count("__text", F.lit("[A-Z]")).cast("bigint").alias("n_capitals"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def score(rule: str, rules: Mapping[str, tuple[str, str]] = RULES) -> Column:
    """Whole thousandths, so that every engine agrees; an empty base scores 0."""
    part, whole = rules[rule]
    share = F.try_divide(1000 * F.col(part), F.col(whole))
    return F.coalesce(F.floor(share), F.lit(0)).cast("bigint")


def log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1 by Stirling's series at x + 10; the error is below 1e-10."""
    z = x + 10
    low = sum((F.ln(x + i) for i in range(1, 10)), F.ln(x))
    series = 1 / (12 * z) - 1 / (360 * F.pow(z, 3)) + 1 / (1260 * F.pow(z, 5))
    return (z - 0.5) * F.ln(z) - z + 0.918938533204672742 + series - low


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), 1 where k is not below the mean.

    The last term comes from logarithms, the others from their ratio to the next one; ratios stay below one on
    this side of the mean, and the terms beyond twelve deviations are smaller than a double can add.
    """
    n, k = n.cast("double"), k.cast("double")
    chosen = log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1)
    last = chosen + k * math.log(p) + (n - k) * math.log1p(-p)
    reach = F.least(k, 12 * F.sqrt(n * p) + 50).cast("int")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def add(acc: Column, i: Column) -> Column:
        term = acc["term"] * (k - i + 1) * (1 - p) / ((n - k + i) * p)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    steps = F.when(reach >= 1, F.sequence(F.lit(1), reach)).otherwise(F.array().cast("array<int>"))
    total = F.aggregate(steps, start, add, lambda acc: acc["total"])
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(last) * total))


def cutoffs(
    measured: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    rules: Mapping[str, tuple[str, str]] = RULES,
    risk: float = RISK,
    level: float = ERROR_LEVEL,
) -> DataFrame:
    """One row per stratum: ``__stratum`` and, per rule, the cutoff (null where none is certified).

    ``measured`` has ``doc_id``, the stratum and the measures; ``labels`` has ``doc_id`` and ``quality`` (1 good,
    0 bad).  Repeated label rows count once; a document with contradicting labels, or none, is not
    used; nor is one that the base rules reject anyway.  A null stratum is a stratum of its own.
    """
    agreed = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("__low"), F.max("quality").alias("__good"))
        .filter("__low = __good")
        .select("doc_id", "__good")
    )
    digest = F.md5(F.col("doc_id").cast("string"))
    holdout = F.substring(digest, 1, 1) < "8"
    pairs = F.array(*[F.struct(F.lit(r).alias("rule"), score(r, rules).alias("score")) for r in rules])
    scored = (
        measured.filter(~base_failed())
        .select("doc_id", F.col(stratum).alias("__stratum"), pairs.alias("__scores"))
        .join(agreed, "doc_id")
        .select("__stratum", "__good", holdout.alias("__holdout"), F.inline("__scores"))
    )

    def of(good: int, held: bool) -> Column:
        return F.count_if((F.col("__good") == good) & (F.col("__holdout") == F.lit(held)))

    # At most 1001 rows for each stratum and rule from here on.
    bins = scored.groupBy("__stratum", "rule", "score").agg(
        of(1, True).alias("held"), of(1, False).alias("good"), of(0, False).alias("bad")
    )
    group = Window.partitionBy("__stratum", "rule")
    above = group.orderBy(F.desc("score"))
    cumulated = bins.select(
        "__stratum",
        "rule",
        "score",
        *[F.sum(c).over(above).alias(f"{c}_out") for c in ("held", "good", "bad")],
        *[F.sum(c).over(group).alias(f"{c}_all") for c in ("held", "good", "bad")],
    )
    n_tests = F.greatest(F.lit(1), bins.select("__stratum").distinct().agg(F.count(F.lit(1))).scalar()) * len(rules)
    tested = cumulated.withColumns(
        {
            "tail": binomial_tail(F.col("held_all"), F.col("held_out"), risk / len(rules)),
            "gain": F.try_divide("bad_out", "bad_all") - GOOD_WEIGHT * F.try_divide("good_out", "good_all"),
        }
    )
    certified = (F.col("held_all") > 0) & (F.col("tail") * n_tests <= level) & (F.col("score") > 0)
    useful = (F.col("gain") > 0) & (F.col("score") > 0)
    chosen = tested.groupBy("__stratum", "rule").agg(
        F.min(F.when(certified, F.col("score"))).alias("strictest"),
        # The best gain; of equal ones the loosest cutoff.
        F.max(F.when(useful, F.struct("gain", "score"))).alias("best"),
    )
    limit = F.when(
        F.col("strictest").isNotNull() & F.col("best").isNotNull(), F.greatest("strictest", F.col("best.score"))
    )
    return chosen.groupBy("__stratum").agg(
        *[F.max(F.when(F.col("rule") == r, limit)).alias(f"__cut_{r}") for r in rules]
    )


def judge(
    measured: DataFrame, labels: DataFrame, stratum: str = "lang", rules: Mapping[str, tuple[str, str]] = RULES
) -> DataFrame:
    """``measured`` with ``base_failed`` and ``kept``.

    ``measured`` should be a written table: it is read once for the cutoffs and once for the verdict.
    Without labels, or for an empty table, only the base rules decide.
    """
    limits = materialise(cutoffs(measured, labels, stratum, rules), "quality-cutoffs")
    strict = [F.coalesce(score(r, rules) >= F.col(f"__cut_{r}"), F.lit(False)) for r in rules]
    rejected = strict[0]
    for s in strict[1:]:
        rejected = rejected | s
    columns = [c for c in measured.columns if c.lower() not in ("base_failed", "kept")]
    joined = measured.alias("m").join(limits, F.col(f"m.{stratum}").eqNullSafe(F.col("__stratum")), "left")
    return joined.select(
        *[F.col(f"m.`{c}`") for c in columns],
        base_failed().alias("base_failed"),
        (~base_failed() & ~rejected).alias("kept"),
    )


def reject_low_quality(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The documents that pass base rules and cutoffs, with their own columns.

    The measures are stored beside the documents, so texts are read and measured once.
    """
    measured = materialise(measure(docs.select(F.struct("*").alias("__row"), "doc_id", "text", F.col(stratum).alias("__lang")), keep=["__row", "doc_id", "__lang"]), "quality-measures")
    return judge(measured, labels, "__lang").filter("kept").select("__row.*")
