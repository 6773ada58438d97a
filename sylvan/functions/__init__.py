"""Column-level functions (pure expressions, JVM-side, codegen friendly)."""

from sylvan.functions.names import clean_name, clean_name_list
from sylvan.functions.nulls import (
    in_values,
    is_missing,
    not_in_values,
)
from sylvan.functions.numeric import (
    if_else_na,
    nan_to_null,
    reciprocal,
    to_number_or_null,
)

__all__ = [
    "clean_name",
    "clean_name_list",
    "in_values",
    "not_in_values",
    "is_missing",
    "to_number_or_null",
    "reciprocal",
    "if_else_na",
    "nan_to_null",
]
