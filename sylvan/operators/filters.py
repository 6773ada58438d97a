"""Row filters: complete cases, exclusion lists, empty sources."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvan.functions.nulls import in_values, is_missing
from sylvan.operators.keysets import KeySet


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``drop_na``: rows with a missing value (NULL, or NaN on floats) go."""
    columns = list(df.columns if columns is None else columns)
    if not columns:
        return df
    missing = reduce(lambda a, b: a | b, [is_missing(df, c) for c in columns])
    return df.where(~missing)


def exclude_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Rows whose value is not in a constant list; NULL survives."""
    return df.where(~in_values(F.col(f"`{column}`"), values))


def has_data(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """TRUE when at least one of ``columns`` is not missing on the row."""
    columns = list(df.columns if columns is None else columns)
    if not columns:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [~is_missing(df, c) for c in columns])


def is_empty_source(df: DataFrame) -> bool:
    """R's ``all(is.na(x))``: TRUE for no rows, no columns or all missing.

    Stops at the first row with a value (a bounded fetch, no full count).
    """
    if not df.columns:
        return True
    return len(df.where(has_data(df)).limit(1).collect()) == 0


def discard_empty(frames: Iterable[DataFrame]) -> list[DataFrame]:
    """Drop sources that hold no value at all."""
    return [f for f in frames if not is_empty_source(f)]


def discard_empty_sources(df: DataFrame, source: str, columns: Sequence[str] | None = None) -> DataFrame:
    """F11 on a combined table: keep rows of sources with some value.

    The per-source test is a partial aggregate; the surviving sources are
    joined back (null-safe semi join).
    """
    columns = [c for c in (df.columns if columns is None else columns) if c != source]
    flagged = df.groupBy(source).agg(F.max(has_data(df, columns)).alias("_any")).where("_any")
    return KeySet.of(flagged, source).keep(df, source)


def any_true(c: str | Column) -> Column:
    """``any()``; FALSE on no rows."""
    return F.coalesce(F.bool_or(F.col(c) if isinstance(c, str) else c), F.lit(False))


def all_true(c: str | Column) -> Column:
    """``all()``; TRUE on no rows."""
    return F.coalesce(F.bool_and(F.col(c) if isinstance(c, str) else c), F.lit(True))
