"""Deterministic keep-first dedup and distinct values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__sylvan_rn"


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key in ``order`` (``distinct(..., .keep_all = TRUE)``).

    ``order`` must be a total order (a file ordinal), otherwise the choice is
    arbitrary. ``row_number() == 1`` plans a WindowGroupLimit on both sides of
    the shuffle, so a hot key is cut to one row per map task before it moves.
    NULL keys form their own group, as in R.
    """
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(
        *[F.col(f"`{o}`") if isinstance(o, str) else o for o in order]
    )
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations; NULL is a value (``distinct``)."""
    return df.select(*[F.col(f"`{c}`") for c in columns]).distinct()
