"""Scalar column functions (built-in Spark expressions only)."""

from .columns import (
    eq_flag,
    mean_,
    nan_to_null,
    required,
    round6,
    sum0,
    value_flag,
)

__all__ = [
    "eq_flag",
    "mean_",
    "nan_to_null",
    "required",
    "round6",
    "sum0",
    "value_flag",
]
