"""Membership in a key set (the kept data items, the sources with data).

A constant list becomes an ``InSet`` literal inside the scan's codegen stage.
A key set derived from data is a plain null-safe semi / anti join with no
hint, whatever its size: Spark's own size estimate and AQE choose between a
broadcast and a shuffle, and AQE splits a hot key of the probed side.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.functions.nulls import in_values


@dataclass(frozen=True)
class KeySet:
    values: tuple | None
    frame: DataFrame | None

    @classmethod
    def of(cls, keys: DataFrame, column: str) -> KeySet:
        return cls(None, keys.select(F.col(f"`{column}`").alias("_key")).distinct())

    @classmethod
    def literal(cls, values: Sequence) -> KeySet:
        return cls(tuple(values), None)

    def keep(self, df: DataFrame, column: str) -> DataFrame:
        """Rows whose ``column`` is in the set (NULL matches NULL)."""
        return self._filter(df, column, anti=False)

    def drop(self, df: DataFrame, column: str) -> DataFrame:
        """Rows whose ``column`` is not in the set (NULL matches NULL)."""
        return self._filter(df, column, anti=True)

    def _filter(self, df: DataFrame, column: str, anti: bool) -> DataFrame:
        if self.values is not None:
            test = in_values(F.col(f"`{column}`"), self.values)
            return df.where(~test if anti else test)
        cond = F.col(f"`{column}`").eqNullSafe(F.col("_key"))
        return df.join(self.frame, cond, "left_anti" if anti else "left_semi")

    def mark(self, df: DataFrame, column: str, into: str) -> DataFrame:
        """Every row, with ``into`` telling whether its ``column`` is in the set."""
        keys = self.frame.withColumn("_in", F.lit(True))
        joined = df.join(keys, F.col(f"`{column}`").eqNullSafe(F.col("_key")), "left")
        return joined.withColumn(into, F.coalesce("_in", F.lit(False))).drop("_key", "_in")
