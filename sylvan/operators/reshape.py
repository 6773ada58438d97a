"""Pivot, nest / unnest and tolerant union."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylvan.operators.ordering import with_run_position

# Column that numbers the pieces of a nested group; ``unnest`` drops it.
PIECE = "__sylvan_piece"
# Rows of a piece, unless the caller says otherwise.
PIECE_ROWS = 10_000
# Columns that looked-up names may become; further names stay in a map.
MAX_COLUMNS = 2_000


def pivot_to_map(
    df: DataFrame,
    keys: Sequence[str],
    names_from: str,
    values_from: str,
    into: str = "covariates",
) -> DataFrame:
    """One row per key with a ``map<name, value>`` (the scalable pivot).

    Names must be unique per key (dedup first). ``collect_list`` is a typed
    imperative aggregate, so this plans as a hash aggregate with a partial
    step; a group's list holds one entry per distinct name of that key.
    """
    entries = F.collect_list(F.struct(F.col(f"`{names_from}`").alias("k"), F.col(f"`{values_from}`").alias("v")))
    return df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.map_from_entries(entries).alias(into))


def pivot_names(df: DataFrame, names_from: str, order: Sequence[str | Column], limit: int | None = None) -> list[str]:
    """Distinct names in order of first appearance under ``order``, the first
    ``limit`` of them (each task sends its first ``limit``): the columns form
    needs them before its schema can exist."""
    first = F.min(F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])).alias("_first")
    names = df.groupBy(F.col(f"`{names_from}`").alias("_name")).agg(first).orderBy("_first")
    return [r["_name"] for r in (names if limit is None else names.limit(limit)).select("_name").collect()]


def map_to_columns(df: DataFrame, map_col: str, names: Iterable[str], rest: str | None = None) -> DataFrame:
    """Project map entries to columns named after the keys; with ``rest``, the
    entries of all other keys stay in a map column of that name."""
    m, names = F.col(f"`{map_col}`"), list(names)
    others = [F.map_filter(m, lambda k, _: ~k.isin(names)).alias(rest)] if rest else []
    kept = [F.col(f"`{c}`") for c in df.columns if c != map_col]
    return df.select(*kept, *[m.getItem(n).alias(n) for n in names], *others)


def map_to_first_columns(df: DataFrame, map_col: str, found: Sequence[str], max_columns: int, rest: str) -> DataFrame:
    """``map_to_columns`` for names looked up with ``limit=max_columns + 1``:
    where there are more than ``max_columns``, a map column ``rest`` holds the
    entries of the others, so no value is lost and the width is bounded."""
    return map_to_columns(df, map_col, found[:max_columns], rest if len(found) > max_columns else None)


def pivot_wider(
    df: DataFrame,
    keys: Sequence[str],
    names_from: str,
    values_from: str,
    names: Sequence[str] | None = None,
    order: Sequence[str | Column] | None = None,
    into: str = "covariates",
    max_columns: int = MAX_COLUMNS,
    rest: str = "others",
) -> DataFrame:
    """Long -> wide: one map column, or, with ``names``, one column per name.
    ``order`` looks the names up first (``pivot_names``): the first
    ``max_columns`` become columns, any others a map column ``rest``."""
    wide = pivot_to_map(df, keys, names_from, values_from, into)
    if names is not None:
        return map_to_columns(wide, into, names)
    if order is None:
        return wide
    return map_to_first_columns(wide, into, pivot_names(df, names_from, order, max_columns + 1), max_columns, rest)


def nest_by(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    into: str = "data",
    order: str | None = None,
    max_items: int = PIECE_ROWS,
) -> DataFrame:
    """Each key's other columns as ``array<struct>`` (A7), in pieces of at most
    ``max_items`` rows.

    Pieces are consecutive runs in ``order`` (without it, in the order of the
    columns), numbered by a reserved column that ``unnest`` drops; a group of
    at most ``max_items`` rows is one row. Rows are sorted by range of
    (keys, order), what a partition's edge cuts of a run of one key is carried
    over it, and a piece is a run of positions inside the group, so no task ever
    holds more than that and no group is joined with its own rows.
    """
    fields = [F.col(f"`{c}`") for c in columns]
    by = [F.col(f"`{k}`") for k in keys]
    sort = [order] if order else list(columns)
    positioned = with_run_position(df, keys, sort, position="_pos")
    cut = positioned.withColumn(PIECE, F.floor(F.col("_pos") / max_items).cast("long"))
    items = F.sort_array(F.collect_list(F.struct(F.col("_pos").alias("_o"), F.struct(*fields).alias("_v"))))
    return cut.groupBy(*by, F.col(PIECE)).agg(F.transform(items, lambda x: x["_v"]).alias(into))


def unnest(df: DataFrame, column: str) -> DataFrame:
    """Rows back out of an ``array<struct>``; empty arrays drop the row."""
    rest = [F.col(f"`{c}`") for c in df.columns if c not in (column, PIECE)]
    return df.select(*rest, F.inline(F.col(f"`{column}`")))


def _family(dtype: T.DataType) -> str:
    if isinstance(dtype, T.NullType):
        return "null"
    if isinstance(dtype, T.NumericType):
        return "numeric"
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return "string"
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    return dtype.typeName()


def check_union_types(frames: Sequence[DataFrame]) -> None:
    """Fail early, naming both types, when a column's types cannot be bound
    together (R refuses integer + character; Spark would coerce silently)."""
    seen: dict[str, tuple[str, T.DataType]] = {}
    for i, frame in enumerate(frames):
        for field in frame.schema.fields:
            family = _family(field.dataType)
            if family == "null":
                continue
            if field.name in seen and seen[field.name][0] != family:
                raise TypeError(
                    f"column {field.name!r}: cannot combine {seen[field.name][1].simpleString()} "
                    f"with {field.dataType.simpleString()} (input {i})"
                )
            seen.setdefault(field.name, (family, field.dataType))


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """``bind_rows``: union by column name, missing columns filled with NULL,
    columns in first-appearance order, after the type-family check (U1)."""
    frames = list(frames)
    if not frames:
        raise ValueError("nothing to union")
    check_union_types(frames)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
