"""Column-level helpers: dates, text predicates, money, measure specs."""

from blendwise.functions.aggs import Agg, count_, count_distinct, max_, min_, sum_
from blendwise.functions.columns import any_positive, as_col, safe_div, typed_null, zero
from blendwise.functions.dates import (
    GRAINS, calendar_spine, date_lit, days_in_month, days_in_quarter, days_in_year,
    period_start, to_date, with_date_parts,
)
from blendwise.functions.numeric import (
    as_double, count_unparsed, exact_sum, merge_shared_items, micro_units, parse_money,
    scale_estimate, tax_net,
)
from blendwise.functions.text import (
    any_imatch, as_text, imatch, not_imatch, replace_all, split_part,
)

__all__ = [
    "Agg", "sum_", "count_", "count_distinct", "min_", "max_",
    "any_positive", "as_col", "safe_div", "typed_null", "zero",
    "GRAINS", "calendar_spine", "date_lit", "days_in_month", "days_in_quarter",
    "days_in_year", "period_start", "to_date", "with_date_parts",
    "as_double", "count_unparsed", "exact_sum", "merge_shared_items", "micro_units",
    "parse_money", "scale_estimate", "tax_net",
    "any_imatch", "as_text", "imatch", "not_imatch", "replace_all", "split_part",
]
