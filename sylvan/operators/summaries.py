"""Grouped summaries and exact quantiles.

Quantiles follow R's default (type 7): for sorted x[0..n-1] and probability
p, h = (n-1)p, lo = floor(h), hi = ceil(h), and the value is
(1-(h-lo))*x[lo] + (h-lo)*x[hi] when x[hi] != x[lo], else x[lo].
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylvan.functions.nulls import is_missing
from sylvan.functions.numeric import nan_to_null
from sylvan.session import Scratch, write_intermediate

QUARTILES = (0.25, 0.5, 0.75)


def group_summary(
    df: DataFrame,
    by: Sequence[str],
    value: str,
) -> DataFrame:
    """``n, mean, sd, min, max`` per group (A4).

    ``n`` counts every row (``n()``); the statistics skip NULL and NaN like
    ``na.rm = TRUE``. A group without values gives NULL (R: NaN / Inf / -Inf).
    Hash aggregate with a partial step: a hot group is pre-reduced map-side.
    """
    v = nan_to_null(value)
    return df.groupBy(*[F.col(f"`{b}`") for b in by]).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("sd"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    )


#: Steps that a power of two is cut into by the first pass, and equal steps that
#: each later pass cuts a bracket into.
PER_OCTAVE = 1024
STEPS = 1 << 16


def _same(by: Sequence[str], names: Sequence[str], *more: Column) -> Column:
    return reduce(lambda x, y: x & y, [*[F.col(f"`{b}`").eqNullSafe(F.col(n)) for b, n in zip(by, names)], *more])


def _long(df: DataFrame, by: Sequence[str], columns: Sequence[str], numbers: Sequence[int]) -> DataFrame:
    """(by..., _i, _v): the values of the columns with these numbers, as
    doubles, missing ones NULL."""
    values = F.posexplode(F.array(*[nan_to_null(F.col(f"`{columns[i]}`")).cast("double") for i in numbers])).alias("_at", "_v")
    number = F.col("_at") if list(numbers) == list(range(len(numbers))) else F.element_at(F.array(*[F.lit(i) for i in numbers]), F.col("_at") + 1)
    return df.select(*[F.col(f"`{b}`") for b in by], values).select(*[F.col(f"`{b}`") for b in by], number.alias("_i"), "_v")


def _magnitude(v: Column) -> Column:
    """A value's step on a logarithmic scale with sign, in the order of the
    values: some 10,000 for data over ten powers of two, and no more than 4.3
    million for all doubles."""
    steps = F.floor((F.least(F.log2(F.abs(v)), F.lit(1100.0)) + 1075) * PER_OCTAVE).cast("int")
    return F.when(v == 0, 0).when(v < 0, -steps).otherwise(steps)


def _step(v: Column, low: Column, high: Column) -> Column:
    """A value's step between the ends of its bracket, in the order of the
    values. Halves keep the span finite; infinite ends have their own steps."""
    low, high = F.greatest(low, F.lit(-sys.float_info.max)), F.least(high, F.lit(sys.float_info.max))
    at = (v / 2 - low / 2) / (high / 2 - low / 2) * (STEPS - 1)
    return F.when(v < low, -1).when(v > high, STEPS).when(low < high, F.floor(at).cast("int")).otherwise(0)


def _counted(rows: DataFrame, by: Sequence[str | Column], step: Column) -> DataFrame:
    """Rows, least, largest and summed value per step: a partial aggregate, so
    no more than the steps are shuffled, however many rows a group has."""
    return rows.groupBy(*by, step.alias("_s")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"), F.sum("_v").alias("_sum")
    )


def _profile(df: DataFrame, by: Sequence[str], columns: Sequence[str], scratch: Scratch | None) -> DataFrame:
    """The first pass: every column's values counted per group and step of the
    logarithmic scale, missing ones too."""
    keys = [F.col(f"`{b}`") for b in by]
    counts = _counted(_long(df, by, columns, range(len(columns))), [*keys, "_i"], F.when(F.col("_v").isNotNull(), _magnitude(F.col("_v"))))
    return write_intermediate(counts, "profile", scratch)


def select_ranks(
    df: DataFrame, by: Sequence[str], columns: Sequence[str], profile: DataFrame, probs: Sequence[float], scratch: Scratch | None = None
) -> DataFrame:
    """The values at the ranks that ``probs`` need: (by..., _i, _size, _rank,
    _value), ``_i`` the number of the column.

    Radix selection: the first pass (``_profile``) has counted the values per
    step of a scale that keeps their order; running counts over the steps of a
    group show the one that holds a rank. A step whose least and largest value
    are equal is the answer. Any other is the next pass's bracket, between these
    two values, and is counted in ``STEPS`` equal steps; most data end there.
    Every pass parts the two ends, so the result is exact whatever the values.
    Only counts are shuffled: nothing is sorted, range partitioned or
    checkpointed."""
    keys = [F.col(f"`{b}`") for b in by]
    names = [f"_b{i}" for i in range(len(by))]
    group = Window.partitionBy(*keys, "_i")
    earlier = group.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    held = profile.where(F.col("_s").isNotNull()).withColumns(
        {"_size": F.sum("_n").over(group), "_before": F.coalesce(F.sum("_n").over(earlier), F.lit(0))}
    )
    ends = F.array_distinct(F.array(*[f((F.col("_size") - 1) * F.lit(float(p))).cast("long") for p in probs for f in (F.floor, F.ceil)]))
    inside = lambda r: (F.col("_before") <= r) & (r < F.col("_before") + F.col("_n"))
    found = held.select(*keys, "_i", "_size", "_min", "_max", "_before", F.explode(F.filter(ends, inside)).alias("_rank"))
    found = found.select(*keys, "_i", "_size", "_rank", F.col("_min").alias("_lo"), F.col("_max").alias("_hi"), (F.col("_rank") - F.col("_before")).alias("_at"))
    done = None
    while True:
        if done is not None:  # a pass over the data: once
            found = write_intermediate(found, "ranks", scratch)
        settled = found.where("_lo = _hi").select(*keys, "_i", "_size", "_rank", F.col("_lo").alias("_value"))
        done = settled if done is None else done.unionByName(settled)
        left = found.where("_lo < _hi")
        open_ = [r["_i"] for r in left.select("_i").distinct().collect()]  # numbers of columns
        if not open_:
            return done
        brackets = left.select(*keys, "_i", "_lo", "_hi").distinct().toDF(*names, "_bi", "_lo", "_hi")
        rows = _long(df, by, columns, sorted(open_)).join(
            brackets, _same(by, names, F.col("_i") == F.col("_bi"), F.col("_lo") <= F.col("_v"), F.col("_v") <= F.col("_hi"))
        )
        counts = _counted(rows, [*keys, "_i", "_lo", "_hi"], _step(F.col("_v"), F.col("_lo"), F.col("_hi")))
        earlier = Window.partitionBy(*keys, "_i", "_lo", "_hi").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        counts = counts.select(*[F.col(f"`{b}`").alias(n) for b, n in zip(by, names)], F.struct("_i", "_lo", "_hi").alias("_c"), "_n", "_min", "_max", "_before")
        same = [F.col(c) == F.col(f"_c.{c}") for c in ("_i", "_lo", "_hi")]
        found = left.join(counts, _same(by, names, *same, inside(F.col("_at")))).select(
            *keys, "_i", "_size", "_rank", F.col("_min").alias("_lo"), F.col("_max").alias("_hi"), (F.col("_at") - F.col("_before")).alias("_at")
        )


def _type7(by: Sequence[str], selected: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(by..., _i, _q): the quantiles, from the few selected values of each group."""
    keys = [*[F.col(f"`{b}`") for b in by], F.col("_i")]
    value_at = F.map_from_entries(F.collect_list(F.struct("_rank", "_value")))
    groups = selected.groupBy(*keys).agg(F.first("_size").alias("_size"), value_at.alias("_at"))

    def quantile(p: float) -> Column:
        h = (F.col("_size") - 1) * F.lit(float(p))
        x, y = F.element_at("_at", F.floor(h).cast("long")), F.element_at("_at", F.ceil(h).cast("long"))
        frac = h - F.floor(h)
        return F.when((frac == 0) | (x == y), x).otherwise((1 - frac) * x + frac * y)

    return groups.select(*keys, F.array(*[quantile(p) for p in probs]).alias("_q"))


def exact_quantiles(
    long: DataFrame, group: str, value: str, probs: Sequence[float] = QUARTILES, scratch: Scratch | None = None
) -> DataFrame:
    """Exact type-7 quantiles of ``value`` per ``group``: (group, prob,
    quantile); see ``select_ranks``. ``long`` is read once per pass."""
    profile = _profile(long, [group], [value], scratch)
    quantiles = _type7([group], select_ranks(long, [group], [value], profile, probs, scratch), probs)
    named = F.map_from_arrays(F.array(*[F.lit(float(p)) for p in probs]), F.col("_q"))
    return quantiles.select(F.col(f"`{group}`"), F.explode(named).alias("prob", "quantile"))


def _summary(df: DataFrame, by: Sequence[str], columns: Sequence[str], scratch: Scratch | None, approx: bool = False) -> DataFrame:
    """R ``summary()`` of each column per group: (by..., column, length, min,
    q1, median, mean, q3, max, n_na). With ``approx`` the quartiles have a rank
    error of 1/10000."""
    keys = [F.col(f"`{b}`") for b in by]
    profile = _profile(df, by, columns, scratch)
    known = F.when(F.col("_s").isNotNull(), F.col("_n"))
    stats = profile.groupBy(*keys, "_i").agg(
        F.sum("_n").alias("length"), F.min("_min").alias("min"), F.max("_max").alias("max"),
        F.try_divide(F.sum("_sum"), F.sum(known)).alias("mean"), (F.sum("_n") - F.coalesce(F.sum(known), F.lit(0))).alias("n_na"),
    )
    if approx:
        rank = F.percentile_approx("_v", list(QUARTILES), 10000)
        quartiles = _long(df, by, columns, range(len(columns))).groupBy(*keys, "_i").agg(rank.alias("_q"))
    else:
        quartiles = _type7(by, select_ranks(df, by, columns, profile, QUARTILES, scratch), QUARTILES)
    names = [f"_b{i}" for i in range(len(by))]
    quartiles = quartiles.toDF(*names, "_qi", "_q")
    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("_i") + 1)
    return stats.join(quartiles, _same(by, names, F.col("_i") == F.col("_qi")), "left").select(
        *keys, name.alias("column"), "length", "min", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"), "mean",
        F.col("_q")[2].alias("q3"), "max", "n_na",
    )


def _one_row_each(df: DataFrame, columns: Sequence[str], stats: DataFrame) -> DataFrame:
    """A summary row for every column, also of a table without rows."""
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return names.join(stats.drop("length"), "column", "left").fillna(0, ["n_na"])


def summary_of_summaries(
    summary: DataFrame,
    by: str = "trait_domain",
    min_n: int = 50,
    n_col: str = "n",
    scratch: Scratch | None = None,
    approx: bool = False,
) -> DataFrame:
    """R ``summary()`` of each group's rows, for groups of ``summary`` with
    ``n > min_n`` and a non-missing ``by`` (``split`` drops NA) (A5).

    One row per (group, column): ``length`` (rows), and for numeric columns
    ``min, q1, median, mean, q3, max, n_na``. ``approx=True`` uses
    ``percentile_approx`` for the quartiles.
    """
    # read once per pass: written, as it is usually an aggregate itself
    kept = write_intermediate(summary.where((F.col(n_col) > min_n) & F.col(f"`{by}`").isNotNull()), "kept", scratch)
    numeric = [f.name for f in kept.schema.fields if f.name != by and isinstance(f.dataType, T.NumericType)]
    others = [f.name for f in kept.schema.fields if f.name != by and f.name not in numeric]
    stats = _summary(kept, [by], numeric, scratch, approx)
    if others:
        text = kept.select(by, F.explode(F.array(*[F.lit(c) for c in others])).alias("column"))
        text = text.groupBy(by, "column").agg(F.count(F.lit(1)).alias("length"))
        stats = stats.unionByName(text, allowMissingColumns=True)
    return stats


def describe_numeric(
    df: DataFrame, columns: Sequence[str] | None = None, method: str = "exact", scratch: Scratch | None = None
) -> DataFrame:
    """``summary()`` of numeric columns: one row per column with
    ``min, q1, median, mean, q3, max, n_na`` (A10, numeric part).

    One pass over the table gives all but the quartiles, which take another
    one for most data (``select_ranks``): give a table that is cheap to read
    again. ``method="approx"`` uses ``percentile_approx`` for the quartiles.
    """
    if method not in ("exact", "approx"):
        raise ValueError("method must be 'exact' or 'approx'")
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    if not columns:
        return df.sparkSession.createDataFrame([], SUMMARY_SCHEMA)
    return _one_row_each(df, columns, _summary(df, [], list(columns), scratch, method == "approx"))


SUMMARY_SCHEMA = "column string, min double, q1 double, median double, mean double, q3 double, max double, n_na long"


def describe_dates(df: DataFrame, columns: Sequence[str] | None = None, scratch: Scratch | None = None) -> DataFrame:
    """``summary()`` of date and timestamp columns, as timestamps (A10)."""
    kinds = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]
    seconds = df.select(*[(F.unix_micros(F.col(f"`{c}`").cast("timestamp")) / 1e6).alias(c) for c in columns])
    out = describe_numeric(seconds, columns, scratch=scratch)
    moments = ["min", "q1", "median", "mean", "q3", "max"]
    return out.withColumns({m: F.timestamp_micros(F.round(F.col(m) * 1e6).cast("long")) for m in moments})


def describe_logical(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``summary()`` of boolean columns: (column, value, n) with the values
    FALSE, TRUE and NA's that occur (A10)."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, value string, n long")
    items = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")) for c in columns]
    long = df.select(F.explode(F.array(*items)).alias("_x")).select("_x.column", "_x.value")
    shown = F.when(F.col("value").isNull(), "NA's").otherwise(F.upper(F.col("value").cast("string")))
    return long.groupBy("column", shown.alias("value")).agg(F.count(F.lit(1)).alias("n"))


def describe_strings(
    df: DataFrame, columns: Sequence[str] | None = None, maxsum: int = 7, scratch: Scratch | None = None
) -> DataFrame:
    """``summary()`` of text columns as factors (A10, string part).

    Per column: all levels in level order when they fit, else the ``maxsum-1``
    most frequent (ties by level) and ``(Other)`` with the rest; ``NA's``
    when there are missing values (one line less then). Rows
    (column, value, n, rank). The level counts are computed once and written
    to the checkpoint folder; the top-k uses ``row_number() <= k``, which
    Spark limits map-side, so a column with millions of levels stays cheap.
    """
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    items = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")) for c in columns]
    long = df.select(F.explode(F.array(*items)).alias("_x")).select("_x.column", "_x.value")
    # one pass over the input; levels, NA counts and top levels all read the
    # written (column, value, n) table
    counts = write_intermediate(long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")), "level-counts", scratch)
    levels = counts.where(F.col("value").isNotNull()).groupBy("column").agg(
        F.count(F.lit(1)).alias("_levels"), F.sum("n").alias("_total")
    )
    nas = counts.where(F.col("value").isNull()).select("column", F.col("n").alias("_na"))
    info = levels.join(nas, "column", "full").fillna(0, ["_levels", "_total", "_na"])
    ranked = counts.where(F.col("value").isNotNull()).withColumn(
        "rank", F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), F.asc("value")))
    ).where(F.col("rank") <= maxsum)
    fit = F.col("_levels") <= (maxsum - F.when(F.col("_na") > 0, 1).otherwise(0))
    shown = F.when(fit, F.col("_levels")).otherwise(maxsum - 1 - F.when(F.col("_na") > 0, 1).otherwise(0))
    info = F.broadcast(info)  # one row per text column
    top = ranked.join(info, "column").where(F.col("rank") <= shown)
    # in level order when all levels fit: rank by value instead of count
    by_level = F.row_number().over(Window.partitionBy("column").orderBy("value"))
    top = top.withColumn("rank", F.when(fit, by_level).otherwise(F.col("rank")))
    shown_rows = top.select("column", "value", "n", "rank")
    other = (
        top.where(~fit)
        .groupBy("column", "_total")
        .agg(F.sum("n").alias("_shown"), F.max("rank").alias("_r"))
        .select("column", F.lit("(Other)").alias("value"), (F.col("_total") - F.col("_shown")).alias("n"), (F.col("_r") + 1).alias("rank"))
    )
    na_rows = info.where(F.col("_na") > 0).select(
        "column", F.lit("NA's").alias("value"), F.col("_na").alias("n"),
        (F.least(F.col("_levels"), F.lit(maxsum - 1)) + 1).cast("int").alias("rank"),
    )
    out = shown_rows.unionByName(other.withColumn("rank", F.col("rank").cast("int"))).unionByName(na_rows)
    return out.withColumn("n", F.col("n").cast("long"))


def null_profile(df: DataFrame) -> DataFrame:
    """Percent of missing values per column (A9): rows (column, pct).

    One aggregate pass; ``pct = missing / rows * 100`` (NULL on no rows).
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(is_missing(df, c)).alias(f"_m{i}") for i, c in enumerate(df.columns)],
    )
    items = [
        F.struct(
            F.lit(c).alias("column"),
            (F.try_divide(F.col(f"_m{i}").cast("double"), F.col("_rows")) * 100).alias("pct"),
        )
        for i, c in enumerate(df.columns)
    ]
    return counts.select(F.explode(F.array(*items)).alias("_x")).select("_x.column", "_x.pct")


def count_rows(df: DataFrame) -> DataFrame:
    """``nrow`` (A11): one row, ``n``."""
    return df.agg(F.count(F.lit(1)).alias("n"))
