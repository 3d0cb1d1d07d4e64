"""Column functions: name matching, exclusion, checks, target typing."""

from blockload.functions.columns import check_request, exclude_columns, resolve_columns
from blockload.functions.target_types import fit_report, target_columns, to_target_values

__all__ = ["check_request", "exclude_columns", "resolve_columns", "fit_report", "target_columns",
           "to_target_values"]
