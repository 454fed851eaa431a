from .checks import (
    Check,
    ContractViolation,
    accepted_values,
    between,
    has_type,
    matches,
    not_null,
    raise_on_error,
    relationship,
    run_checks,
    unique,
    unique_combination,
)
from .payload import (
    classify,
    failure_counts,
    pack_series,
    parse,
    quality_rule,
    screen,
    split_outcomes,
    validate,
)
from .ranking import distinct_sorted, first_n, first_per_key, insert_or_ignore, rows_where, upserted
from .series import flatten, kept_rows, load_counts, standardise, tolerant_casts, typed_rows
from .stats import grouped_quantiles, share_of_total, with_zscore
from .universe import in_universe, request_fields, universe

__all__ = [
    "Check",
    "ContractViolation",
    "accepted_values",
    "between",
    "classify",
    "distinct_sorted",
    "failure_counts",
    "first_n",
    "first_per_key",
    "flatten",
    "grouped_quantiles",
    "has_type",
    "in_universe",
    "insert_or_ignore",
    "kept_rows",
    "load_counts",
    "matches",
    "not_null",
    "pack_series",
    "parse",
    "quality_rule",
    "raise_on_error",
    "relationship",
    "request_fields",
    "rows_where",
    "run_checks",
    "screen",
    "share_of_total",
    "split_outcomes",
    "standardise",
    "tolerant_casts",
    "typed_rows",
    "unique",
    "unique_combination",
    "universe",
    "upserted",
    "validate",
    "with_zscore",
]
