"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

# Rows handed to Python at a time: a batch of long texts stays small.
BATCH_ROWS = 1000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of one Arrow batch for this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


@contextmanager
def arrow_rows(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Bound the rows of one Arrow batch for the jobs run inside; the session's
    own setting comes back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def texts_of(column: pd.Series) -> list[str]:
    """The column's texts; a null text is empty."""
    return ["" if t is None else t for t in column.tolist()]


def frames(rows: Iterator[tuple], columns: list[str], size: int = 4096) -> Iterator[pd.DataFrame]:
    """Rows as pandas frames of at most ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pd.DataFrame(held, columns=columns)
            held = []
    if held:
        yield pd.DataFrame(held, columns=columns)


def word_counts(words: list[list]) -> np.ndarray:
    return np.fromiter(map(len, words), dtype=np.int64, count=len(words))
