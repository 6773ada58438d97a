"""Lenient numeric conversion, reciprocal with infinities, NA-propagating if/else."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sylvan.functions.nulls import as_col

# Accepted number spellings, checked on the trimmed text before try_cast so
# that Spark-only literals such as "1.0d" or "1f" do not parse: a decimal
# number with optional exponent, or inf / infinity / nan in any case.
DECIMAL_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
SPECIAL_PATTERN = r"^[+-]?(inf|infinity|nan)$"


def to_number_or_null(c: str | Column) -> Column:
    """``as.double``: parse text to double, NULL where it is not a number."""
    text = F.trim(as_col(c).cast("string"))
    parsable = text.rlike(DECIMAL_PATTERN) | F.lower(text).rlike(SPECIAL_PATTERN)
    return F.when(parsable, text.try_cast("double"))


def reciprocal(c: str | Column) -> Column:
    """``1 / x`` with R's results for zero: ``1/0 = Inf``, ``1/-0 = -Inf``."""
    x = as_col(c).cast("double")
    negative_zero = F.format_string("%s", x).startswith("-")
    return F.when(
        x == 0, F.when(negative_zero, F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    ).otherwise(F.try_divide(F.lit(1.0), x))


def if_else_na(condition: Column, yes, no) -> Column:
    """R's ``ifelse``: a NULL condition gives NULL, not the ``no`` branch."""
    yes = yes if isinstance(yes, Column) else F.lit(yes)
    no = no if isinstance(no, Column) else F.lit(no)
    return F.when(condition.isNull(), F.lit(None)).when(condition, yes).otherwise(no)


def nan_to_null(c: str | Column) -> Column:
    """NaN becomes NULL, so aggregates skip it like R's ``na.rm = TRUE``."""
    return F.nanvl(as_col(c).cast("double"), F.lit(None).cast("double"))
