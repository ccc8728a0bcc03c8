"""Relational operators over DataFrames: filters, dedup, aggregates, top-k, joins, unions."""

from strata.operators.aggregate import (
    count_by,
    counts_with_conditions,
    frequency,
    high_water_mark,
    rounded_mean,
    totals,
)
from strata.operators.clean import (
    col_or_null,
    drop_null,
    first_present,
    in_box,
    in_period,
    is_one_of,
    require_not_null,
    with_period,
)
from strata.operators.dedup import distinct_rows, distinct_values, latest_per_key
from strata.operators.join import join_on, keys_absent_from
from strata.operators.rank import newest, next_page, relative_to_max, relative_to_table_max, top_k
from strata.operators.union import union_by_name, union_tagged

__all__ = [
    "col_or_null",
    "count_by",
    "counts_with_conditions",
    "distinct_rows",
    "distinct_values",
    "drop_null",
    "first_present",
    "frequency",
    "high_water_mark",
    "in_box",
    "in_period",
    "is_one_of",
    "join_on",
    "keys_absent_from",
    "latest_per_key",
    "newest",
    "next_page",
    "relative_to_max",
    "relative_to_table_max",
    "require_not_null",
    "rounded_mean",
    "top_k",
    "totals",
    "union_by_name",
    "union_tagged",
    "with_period",
]
