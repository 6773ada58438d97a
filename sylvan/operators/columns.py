"""Projections: tolerant select, relocate, name cleaning, enframe."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from sylvan.functions.names import clean_name_list


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def select_any_of(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Keep the listed columns that exist, in list order (``any_of``)."""
    present = set(df.columns)
    return df.select(*[quoted(c) for c in wanted if c in present])


def relocate(
    df: DataFrame,
    columns: Sequence[str],
    before: str | None = None,
    after: str | None = None,
) -> DataFrame:
    """Move ``columns`` (in the given order) before or after another column."""
    if (before is None) == (after is None):
        raise ValueError("give exactly one of before= or after=")
    moved = list(columns)
    rest = [c for c in df.columns if c not in moved]
    anchor = before if before is not None else after
    if anchor not in rest:
        raise ValueError(f"anchor column {anchor!r} is missing or moved")
    at = rest.index(anchor) + (0 if before is not None else 1)
    order = rest[:at] + moved + rest[at:]
    return df.select(*[quoted(c) for c in order])


def clean_names(df: DataFrame) -> DataFrame:
    """Unique snake_case names, renamed by position so duplicates are fine."""
    return df.toDF(*clean_name_list(df.columns))


def enframe(df: DataFrame, column: str, name: str = "name", value: str = "value") -> DataFrame:
    """A column re-tabled as (name = value as text, value)."""
    return df.select(quoted(column).cast("string").alias(name), quoted(column).alias(value))


def convert_columns(
    df: DataFrame, of_type: type[DataType], convert: Callable[[Column], Column]
) -> DataFrame:
    """Apply ``convert`` to every column whose type is ``of_type`` (``across``)."""
    return df.select(
        *[
            convert(quoted(f.name)).alias(f.name) if isinstance(f.dataType, of_type) else quoted(f.name)
            for f in df.schema.fields
        ]
    )


def column_names(df: DataFrame) -> list[str]:
    """Names of a table; analysis only, no job (``names(slice(1:1000))``)."""
    return list(df.columns)
