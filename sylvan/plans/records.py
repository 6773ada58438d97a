"""Trait records: combine sources, conform, report, write in chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan.functions.numeric import to_number_or_null
from sylvan.operators.columns import clean_names, select_any_of
from sylvan.operators.ordering import assign_chunks, cut_chunks
from sylvan.operators.summaries import describe_dates, describe_logical, describe_numeric, describe_strings, null_profile
from sylvan.session import Scratch
from sylvan.sources.catalog import RECORD_COLUMNS, RECORD_NEST_ORDER
from sylvan.sources.snapshots import PART, has_values, newest, open_versions, save_parts

#: Rows that ``write_record_chunks`` gives a task: what it sorts, and compresses
#: into a file.
FILE_ROWS = 1 << 19


def combine_sources(spark: SparkSession, root: str, names: Sequence[str] | None = None, ordinal: str | None = None) -> DataFrame:
    """Newest snapshot of every source under ``root`` (or of ``names``),
    sources without any value left out (the manifest counts the rows with
    one: no pass over the data), unioned by column name, names cleaned.
    The source name stays in column ``snapshot_name``; ``ordinal`` (a clean
    name) adds the rows' order in the files."""
    chosen = newest(spark, root, names)
    if not chosen:
        raise FileNotFoundError(f"no snapshots under {root}")
    kept = [v for v in chosen.values() if has_values(spark, v)]
    data = open_versions(spark, kept or chosen.values(), ordinal=ordinal)
    return clean_names(data if kept else data.where(F.lit(False)))


def conform_records(df: DataFrame, ordinal: str | None = None) -> DataFrame:
    """Keep the known record columns that exist, id as text, value as a
    number (NULL when not a number), ``trait_name`` first, then the per-trait
    columns in their fixed order, then ``ordinal``. The original's
    nest-by-trait / unnest pair reorders columns (a projection here) and puts
    the rows of a trait together, traits in order of first appearance:
    see ``write_record_chunks``."""
    kept = select_any_of(df, [*RECORD_COLUMNS, *([ordinal] if ordinal else [])])
    typed = kept
    if "id" in kept.columns:
        typed = typed.withColumn("id", F.col("id").cast("string"))
    if "trait_value" in kept.columns:
        typed = typed.withColumn("trait_value", to_number_or_null("trait_value"))
    order = ["trait_name", *RECORD_NEST_ORDER, *([ordinal] if ordinal else [])]
    return typed.select(*[c for c in order if c in typed.columns])


def quality_report(df: DataFrame, maxsum: int = 7, scratch: Scratch | None = None) -> dict[str, DataFrame]:
    """C14: the table summary (numbers, text as factors, logical values, dates)
    and the percent of missing values per column."""
    return {
        "numeric": describe_numeric(df, scratch=scratch),
        "strings": describe_strings(df, maxsum=maxsum, scratch=scratch),
        "logical": describe_logical(df),
        "dates": describe_dates(df, scratch=scratch),
        "missing": null_profile(df),
    }


def write_chunks(
    df: DataFrame,
    root: str,
    name: str,
    order: Sequence[str | Column],
    n_chunks: int = 4,
    mode: str = "lossless",
    preset: str = "archive",
    drop: Sequence[str] = (),
) -> dict[str, str]:
    """Write the rows in ``order`` as ``n_chunks`` consecutive chunks, in
    one job: snapshots ``<name>_0``, ``<name>_1`` ... under ``root``, each
    skipped if its newest version holds the same rows. ``drop``: columns that
    only order the rows. Returns the versions published."""
    position, chunk = "__sylvan_pos", PART
    chunked = assign_chunks(df, order, n_chunks, mode, chunk=chunk, position=position).drop(position, *drop)
    return save_parts(chunked, root, {k: f"{name}_{k}" for k in range(n_chunks)}, preset)


def write_record_chunks(
    df: DataFrame, root: str, name: str, ordinal: str, key: str = "trait_name", n_chunks: int = 4, mode: str = "lossless",
    preset: str = "archive", file_rows: int = FILE_ROWS,
) -> dict[str, str]:
    """The original's chunks: traits in order of first appearance, rows in file
    order inside each; the ordinal is not written. Chunks come from counts of
    (trait, file) blocks (``cut_chunks``); the rows are moved once, to be written
    in order, in tasks of about ``file_rows`` rows whatever the session's
    number of shuffle partitions."""
    first = "__sylvan_first"
    with Scratch(df.sparkSession, "chunks") as scratch:
        rows, total = cut_chunks(df, key, ordinal, n_chunks, mode, PART, first, scratch)
        order = [F.col(c) for c in (PART, first, f"`{ordinal}`")]
        ranged = rows.repartitionByRange(max(n_chunks, -(-total // file_rows)), *order).sortWithinPartitions(*order)
        return save_parts(ranged.drop(first, ordinal), root, {k: f"{name}_{k}" for k in range(n_chunks)}, preset)
