"""Column expressions shared by the operators; everything here stays inside codegen."""
from .numeric import clean_string, finite_or_null, is_finite, is_missing, safe_div, to_double, to_whole_number
from .reasons import REASON_SEPARATOR, evaluate_once, failed_reasons, list_reasons
from .tails import normal_quantile, quantile_from_parts, quantile_parts, two_sided_p

__all__ = [
    "REASON_SEPARATOR", "clean_string", "evaluate_once", "failed_reasons", "finite_or_null", "is_finite", "is_missing",
    "list_reasons", "normal_quantile", "quantile_from_parts", "quantile_parts", "safe_div", "to_double", "to_whole_number", "two_sided_p",
]
