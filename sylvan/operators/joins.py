"""Joins where NULL keys match NULL keys, lookups and the presence test."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.session import Scratch, write_intermediate


def null_safe_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    not_null: Sequence[str] = (),
) -> DataFrame:
    """Equi-join on ``on`` with dplyr's NA-matches-NA rule.

    The result keeps one copy of each key column (the left one, or the right
    one where only the right side matched). ``<=>`` still plans as an equi
    sort-merge / hash join, never a nested loop. Columns are addressed by
    position, so names that differ only in case (``Lat``/``lat``) are fine.
    """
    lcols, rcols = list(left.columns), list(right.columns)
    l = left.toDF(*[f"_l{i}" for i in range(len(lcols))])
    r = right.toDF(*[f"_r{i}" for i in range(len(rcols))])
    li = {k: f"_l{lcols.index(k)}" for k in on}
    ri = {k: f"_r{rcols.index(k)}" for k in on}
    parts = [
        (l[li[k]] == r[ri[k]]) if k in not_null else l[li[k]].eqNullSafe(r[ri[k]])
        for k in on
    ]
    joined = l.join(r, reduce(lambda a, b: a & b, parts), how)
    if how in ("left_semi", "semi", "leftsemi", "left_anti", "anti", "leftanti"):
        return joined.toDF(*lcols)
    outer_right = how in ("right", "right_outer", "full", "outer", "full_outer")
    keys = [F.coalesce(F.col(li[k]), F.col(ri[k])) if outer_right else F.col(li[k]) for k in on]
    rest_l = [(F.col(f"_l{i}"), c) for i, c in enumerate(lcols) if c not in on]
    rest_r = [(F.col(f"_r{i}"), c) for i, c in enumerate(rcols) if c not in on]
    names = list(on) + [c for _, c in rest_l] + [c for _, c in rest_r]
    return joined.select(*keys, *[c for c, _ in rest_l], *[c for c, _ in rest_r]).toDF(*names)


def null_safe_semi(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key tuple occurs in ``right`` (``%in%``)."""
    return null_safe_join(left, right.select(*on).distinct(), on, "left_semi")


def null_safe_anti(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key tuple does not occur in ``right`` (``!%in%``)."""
    return null_safe_join(left, right.select(*on).distinct(), on, "left_anti")


def lookup_join(df: DataFrame, lookup: DataFrame, left_key: str, right_key: str, fixed: bool = False) -> DataFrame:
    """Left join on ``cast(left_key as string) = right_key`` (J2). Only a
    ``fixed`` table (one that the library states itself) gets a broadcast
    hint; the size of any other is left to Spark."""
    side = F.broadcast(lookup) if fixed else lookup
    cond = df[left_key].cast("string") == side[right_key]
    return df.join(side, cond, "left").drop(side[right_key])


def missing_items(
    requested: DataFrame,
    present: DataFrame,
    item: str = "item",
    present_col: str = "name",
    match: str = "exact",
    scratch: Scratch | None = None,
) -> DataFrame:
    """Requested items with no present counterpart.

    ``match="exact"``: equality (an anti equi-join).
    ``match="contains"``: the item occurs as a substring of some present name,
    the original workflow's substring test: an exact equi-join on each item's
    rarest 3-gram (every 3-gram of an item occurs in any name that contains
    it), then ``instr`` verifies the pairs that are left.
    """
    items = requested.select(F.col(item).alias("_item")).where(F.col("_item").isNotNull()).distinct()
    names = present.select(F.col(present_col).alias("_name")).where(F.col("_name").isNotNull())
    if match == "exact":
        found = names.select(F.col("_name").alias("_item")).distinct()
    elif match == "contains":
        found = _contained_items(items, names, scratch)
    else:
        raise ValueError("match must be 'exact' or 'contains'")
    return items.join(found, "_item", "left_anti").select(F.col("_item").alias(item))


def _grams(df: DataFrame, text: str, length: int) -> DataFrame:
    n = F.length(F.col(text))
    starts = F.sequence(F.lit(1), F.greatest(n - length + 1, F.lit(1)))
    return df.where(n >= length).select(
        F.col(text), F.explode(F.array_distinct(F.transform(starts, lambda i: F.substring(F.col(text), i, length)))).alias("_gram")
    )


def _contained_items(items: DataFrame, names: DataFrame, scratch: Scratch | None) -> DataFrame:
    found = []
    distinct_names = names.distinct()
    # items shorter than 3 characters: join on the whole item as the gram
    for length in (1, 2):
        short = items.where(F.length("_item") == length).select("_item", F.col("_item").alias("_gram"))
        hits = short.join(_grams(distinct_names, "_name", length).select("_gram").distinct(), "_gram")
        found.append(hits.select("_item"))
    # the empty item is contained in any name
    found.append(names.limit(1).select(F.lit("").alias("_item")))
    long_items = items.where(F.length("_item") >= 3)
    # written first, so the join below reads it as a plain shuffle stage and
    # AQE can split a very frequent gram across tasks
    name_grams = write_intermediate(_grams(distinct_names, "_name", 3), "name-grams", scratch)
    frequency = name_grams.groupBy("_gram").agg(F.count(F.lit(1)).alias("_freq"))
    item_grams = _grams(long_items, "_item", 3)
    rarest = (
        item_grams.join(frequency, "_gram", "left")
        .groupBy("_item")
        .agg(F.min_by("_gram", F.coalesce("_freq", F.lit(0))).alias("_gram"))
    )
    verified = rarest.join(name_grams, "_gram").where(F.instr(F.col("_name"), F.col("_item")) > 0)
    found.append(verified.select("_item"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.distinct()
