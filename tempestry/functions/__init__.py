"""Column expressions: coercion of messy text and event rules."""

from tempestry.functions.coerce import (
    amount_measure,
    bare_suffix,
    blank_to_null,
    int_measure,
    label_or,
    measure_parses,
    parse_amount,
    safe_float,
    safe_int,
)
from tempestry.functions.distributions import correlation_p_value, log_gamma, regularized_beta
from tempestry.functions.rules import (
    band_names,
    magnitude_band,
    severe_by_impact,
    severe_by_scale,
    valid_magnitude,
)

__all__ = [
    "amount_measure",
    "band_names",
    "bare_suffix",
    "blank_to_null",
    "correlation_p_value",
    "int_measure",
    "label_or",
    "log_gamma",
    "magnitude_band",
    "measure_parses",
    "parse_amount",
    "regularized_beta",
    "safe_float",
    "safe_int",
    "severe_by_impact",
    "severe_by_scale",
    "valid_magnitude",
]
