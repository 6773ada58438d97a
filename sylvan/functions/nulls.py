"""Two-valued membership and equality, where NULL is an ordinary value.

R's ``%in%`` and dplyr's join keys treat NA as a value that matches NA and
never yield NA. Spark's ``IN`` and ``=`` are three-valued, so these helpers
spell the two-valued forms out with built-in column expressions.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_values(c: str | Column, values: Iterable) -> Column:
    """``c %in% values``: never NULL; a None in ``values`` matches NULL rows."""
    c = as_col(c)
    values = list(values)
    concrete = [v for v in values if v is not None]
    test = F.coalesce(c.isin(concrete), F.lit(False)) if concrete else F.lit(False)
    if len(concrete) != len(values):
        test = test | c.isNull()
    return test


def not_in_values(c: str | Column, values: Iterable) -> Column:
    """``!c %in% values``: NULL rows are kept unless None is in ``values``."""
    return ~in_values(c, values)


def is_missing(df: DataFrame, name: str) -> Column:
    """R's ``is.na``: TRUE for NULL and, on floating columns, for NaN."""
    c = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()
