"""Sorting, ordered head, global row positions and chunk assignment.

Global positions never go through a single partition: the rows are range
partitioned on the order, sorted inside each partition and checkpointed to
the shared checkpoint folder (so a lost executor cannot re-sample different
range bounds), then each row's position is the row count of all earlier
partitions plus its index inside its own partition.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylvan.session import Scratch, checkpoint_dir

#: Consecutive row numbers that ``cut_chunks`` counts as one block: 2 to this power.
BLOCK_BITS = 16


def _cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(f"`{o}`") if isinstance(o, str) else o for o in order]


def arrange(df: DataFrame, *order: str | Column) -> DataFrame:
    """``arrange``: ascending with missing values last."""
    return df.orderBy(*[c.asc_nulls_last() for c in _cols(order)])


def head_ordered(df: DataFrame, order: Sequence[str | Column], n: int = 1000) -> DataFrame:
    """First ``n`` rows in ``order`` (``slice(1:n)``): a distributed top-k."""
    return df.orderBy(*_cols(order)).limit(n)


def first_group(df: DataFrame, key: str) -> DataFrame:
    """Rows of the first group in key order (``[[1]]`` of a per-group list,
    O4): a join with the one smallest key."""
    first = df.agg(F.min(F.col(f"`{key}`")).alias("_k"))
    return df.join(F.broadcast(first), F.col(f"`{key}`") == F.col("_k"), "left_semi")  # one row


def _range_sorted_checkpoint(
    df: DataFrame, order: Sequence[str | Column], num_partitions: int | None
) -> tuple[DataFrame, int]:
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = _cols(order)
    # rows that are equal under the order spread by the hash of the whole row
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if not _holds_map(f.dataType)]
    cols = [*cols, F.xxhash64(*plain)] if plain else cols
    # a user-given partition count is kept as is by AQE (no coalescing)
    return df.repartitionByRange(n, *cols).sortWithinPartitions(*cols).checkpoint(eager=True), n


def _holds_map(dtype: T.DataType) -> bool:
    return "map<" in dtype.simpleString()


def _partition_offsets(ranged: DataFrame, partitions: int, weight: Column) -> tuple[list[int], int]:
    """Prefix sums of ``weight`` over the partitions, in partition order."""
    totals = {
        r["_pid"]: r["_n"]
        for r in ranged.groupBy(F.spark_partition_id().alias("_pid")).agg(F.sum(weight).alias("_n")).collect()
    }
    offsets, running = [], 0
    for pid in range(max(partitions, max(totals, default=-1) + 1)):
        offsets.append(running)
        running += int(totals.get(pid) or 0)
    return offsets, running


def with_global_position(
    df: DataFrame,
    order: Sequence[str | Column],
    position: str = "pos",
    num_partitions: int | None = None,
) -> tuple[DataFrame, int]:
    """Add the 1-based position of each row under ``order`` (a total order).

    Returns the positioned frame and the row count.
    """
    ranged, partitions = _range_sorted_checkpoint(df, order, num_partitions)
    offsets, total = _partition_offsets(ranged, partitions, F.lit(1))
    pid = F.spark_partition_id()
    inside = F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)
    offset = F.element_at(F.array(*[F.lit(o).cast("long") for o in offsets]), pid + 1)
    return ranged.withColumn(position, offset + inside + 1), total


def with_run_position(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    position: str = "pos",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add the 0-based position of each row among the rows of its ``keys``, in
    ``order`` (rows that are equal under it: by the hash of the row).

    The rows are shuffled once, by range on (keys, order), so a key that holds
    a third of all rows is spread over many tasks. What crosses a partition's
    edge is carried: each partition reports its rows, its first and last key
    (as a hash; neighbours in the order are told apart by it) and the length of
    its last run, one row per partition through the driver."""
    ranged, partitions = _range_sorted_checkpoint(df, [*keys, *order], num_partitions)
    marked = ranged.withColumn("__key", F.xxhash64(*[F.struct(F.col(f"`{k}`").isNull(), F.col(f"`{k}`")) for k in keys]))
    ends = {r["pid"]: r for r in marked.select("__key").mapInArrow(_run_ends, "pid int, first long, last long, rows long, tail long").collect()}
    carried, open_key, open_rows = {}, None, 0
    for pid in sorted(ends):
        r = ends[pid]
        carried[pid] = open_rows if r["first"] == open_key else 0
        # a partition of a single run hands on what it was handed
        open_rows = r["tail"] + (carried[pid] if r["tail"] == r["rows"] else 0)
        open_key = r["last"]
    schema = T.StructType([*ranged.schema.fields, T.StructField(position, T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n = None, carried.get(TaskContext.get().partitionId(), 0)
        for batch in batches:
            key = batch.column("__key").to_numpy()
            if not len(key):
                continue
            at, last, n = _run_positions(key, last, n)
            columns = [c for c, name in zip(batch.columns, batch.schema.names) if name != "__key"]
            names = [name for name in batch.schema.names if name != "__key"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(at, pa.int64())], [*names, position])

    return marked.mapInArrow(place, schema)


def _run_positions(key: np.ndarray, last: int | None, n: int) -> tuple[np.ndarray, int, int]:
    """Positions in runs of equal keys, after a run of ``last`` that is at
    position ``n`` now (``last`` None: the run before the first batch has the
    first key); the key and position that the next batch goes on from."""
    index = np.arange(len(key), dtype=np.int64)
    change = np.flatnonzero(key[1:] != key[:-1]) + 1
    starts = np.concatenate(([0], change))
    at = index - np.repeat(starts, np.diff(np.append(starts, len(key))))
    if last is None or key[0] == last:
        at[: change[0] if len(change) else len(key)] += n
    return at, int(key[-1]), int(at[-1]) + 1


def _run_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = last = None
    rows = n = 0
    for batch in batches:
        key = batch.column("__key").to_numpy()
        if len(key):
            first = int(key[0]) if first is None else first
            _, last, n = _run_positions(key, last, n)
            rows += len(key)
    if rows:
        values = [[TaskContext.get().partitionId()], [first], [last], [rows], [n]]
        types = [pa.int32(), *[pa.int64()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], ["pid", "first", "last", "rows", "tail"])


def chunk_bounds(total: int, n_chunks: int) -> list[tuple[int, int]]:
    """Truncating rule of the original workflow: chunk k covers the 1-based positions
    ``floor(k*N/n) + 1`` .. ``floor(k*N/n) + max(N div n, 1)``; for N = 0
    every chunk is empty. Rows past a chunk end are lost when N mod n > 0."""
    if total == 0:
        return [(1, 0)] * n_chunks
    q = max(total // n_chunks, 1)
    return [((k * total) // n_chunks + 1, (k * total) // n_chunks + q) for k in range(n_chunks)]


def assign_chunks(
    df: DataFrame,
    order: Sequence[str | Column],
    n_chunks: int = 4,
    mode: str = "lossless",
    chunk: str = "chunk",
    position: str = "pos",
) -> DataFrame:
    """Split rows, in ``order``, into ``n_chunks`` consecutive chunks.

    ``mode="lossless"``: every row in exactly one chunk, sizes differ by at
    most one (as ``ntile``). ``mode="truncating"``: the original bounds,
    which drop ``N mod n`` rows and, for N < n, repeat rows.
    """
    positioned, total = with_global_position(df, order, position)
    pos = F.col(position)
    if mode == "lossless":
        q, r = divmod(total, n_chunks)
        big = r * (q + 1)
        value = F.when(pos <= big, F.floor((pos - 1) / (q + 1))).otherwise(
            F.lit(r) + F.floor((pos - 1 - big) / max(q, 1))
        )
        return positioned.withColumn(chunk, value.cast("int"))
    if mode == "truncating":
        bounds = chunk_bounds(total, n_chunks)
        starts = F.array(*[F.lit(s).cast("long") for s, _ in bounds])
        ends = F.array(*[F.lit(e).cast("long") for _, e in bounds])
        hits = F.filter(
            F.sequence(F.lit(0), F.lit(n_chunks - 1)),
            lambda k: (pos >= F.element_at(starts, k + 1)) & (pos <= F.element_at(ends, k + 1)),
        )
        return positioned.withColumn(chunk, F.explode(hits))
    raise ValueError("mode must be 'lossless' or 'truncating'")


def with_running_total(df: DataFrame, order: Sequence[str | Column], weight: str, into: str) -> tuple[DataFrame, int]:
    """Add the sum of ``weight`` over the rows before each row under ``order``
    (a total order); also returns the sum over all rows."""
    ranged, partitions = _range_sorted_checkpoint(df, order, None)
    offsets, total = _partition_offsets(ranged, partitions, F.col(f"`{weight}`"))
    numbered = ranged.withColumn("__pid", F.spark_partition_id())
    earlier = Window.partitionBy("__pid").orderBy(*_cols(order)).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.element_at(F.array(*[F.lit(o).cast("long") for o in offsets]), F.col("__pid") + 1)
    inside = F.coalesce(F.sum(F.col(f"`{weight}`")).over(earlier), F.lit(0))
    return numbered.withColumn(into, offset + inside).drop("__pid"), total


def _block(df: DataFrame, ordinal: str) -> Column:
    """Ordinals of one block of consecutive row numbers, in the ordinals' order:
    the last integer of the ordinal without its low bits (an ordinal without
    one is a block of its own)."""
    dtype, c = df.schema[ordinal].dataType, F.col(f"`{ordinal}`")
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    shift = lambda x: F.shiftright(x.cast("long"), BLOCK_BITS)
    if isinstance(dtype, whole):
        return shift(c)
    if isinstance(dtype, T.StructType) and dtype.fields and isinstance(dtype.fields[-1].dataType, whole):
        last = dtype.names[-1]
        return F.struct(*[c[n].alias(n) for n in dtype.names[:-1]], shift(c[last]).alias(last))
    return c


def _literal(value, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StructType) and value is not None:
        return F.struct(*[_literal(value[f.name], f.dataType).alias(f.name) for f in dtype.fields])
    return F.lit(value).cast(dtype)


def cut_chunks(
    df: DataFrame, key: str, ordinal: str, n_chunks: int, mode: str, chunk: str, first: str, scratch: Scratch
) -> tuple[DataFrame, int]:
    """Split the rows into ``n_chunks`` consecutive chunks (modes as in
    ``assign_chunks``), groups of ``key`` in order of first appearance, rows in
    the order of ``ordinal`` inside each. Adds ``chunk`` and ``first`` (the
    group's smallest ordinal) and returns the row count as well.

    No row gets a position and no row is moved. Rows are counted by key and
    block of 65,536 row numbers of a file (one pass over key and ordinal); prefix
    sums of those counts show which block holds the first row of a chunk, and
    only those blocks (at most two a chunk) are read again for it. A row's chunk
    is then a comparison of its (first, ordinal) with these few rows.

    ``ordinal`` is unique (rows that share one stay together) and is an integer
    or a struct that ends in one; ordinals of other types are right too, but
    counted one by one. A NULL key is a group, a NULL ordinal the smallest.
    """
    k, o = F.col(f"`{key}`"), F.col(f"`{ordinal}`")
    narrow = df.select(k.alias("_key"), _block(df, ordinal).alias("_block"), o.alias("_at"))
    counted = narrow.groupBy("_key", "_block").agg(F.min("_at").alias("_low"), F.count(F.lit(1)).alias("_n"))
    blocks = scratch.save(counted, "blocks")
    firsts = scratch.save(blocks.groupBy(F.col("_key").alias("_of")).agg(F.min("_low").alias(first)), "firsts")
    ordered = blocks.join(firsts, F.col("_key").eqNullSafe(F.col("_of"))).select(first, "_key", "_block", "_n")
    placed, total = with_running_total(ordered, [first, "_block"], "_n", "_before")
    if mode == "lossless":
        q, r = divmod(total, n_chunks)
        bounds = [(i * q + min(i, r) + 1, None) for i in range(1, n_chunks)]
    elif mode == "truncating":
        bounds = chunk_bounds(total, n_chunks)
    else:
        raise ValueError("mode must be 'lossless' or 'truncating'")
    wanted = sorted({p for pair in bounds for p in pair if p and p <= total})
    cuts = _rows_at(narrow, placed, wanted, first, scratch)
    at = F.struct(F.col(first).alias("first"), o.alias("at"))
    types = {"first": firsts.schema[first].dataType, "at": df.schema[ordinal].dataType}
    cut = {p: F.struct(*[_literal(v, types[name]).alias(name) for name, v in zip(types, row)]) for p, row in cuts.items()}
    rows = df.join(firsts, k.eqNullSafe(F.col("_of"))).drop("_of")
    if mode == "lossless":
        value = sum((F.when(at >= cut[p], 1).otherwise(0) for p, _ in bounds if p in cut), F.lit(0))
    else:
        inside = [F.when((at >= cut[s]) & (at <= cut[e]), i) for i, (s, e) in enumerate(bounds) if s in cut and e in cut]
        value = F.explode(F.array_compact(F.array(*inside, F.lit(None).cast("int"))))
    return rows.withColumn(chunk, value.cast("int") if mode == "lossless" else value), total


def _rows_at(narrow: DataFrame, placed: DataFrame, positions: list[int], first: str, scratch: Scratch) -> dict[int, tuple]:
    """(first, ordinal) of the rows at the given positions, one row each."""
    if not positions:
        return {}
    here = F.filter(F.array(*[F.lit(p).cast("long") for p in positions]), lambda p: (p > F.col("_before")) & (p <= F.col("_before") + F.col("_n")))
    hit = placed.select(first, F.col("_key").alias("_hk"), F.col("_block").alias("_hb"), "_before", F.explode(here).alias("_p"))
    hit = scratch.save(hit, "hit")  # a row for each position
    same = F.col("_key").eqNullSafe(F.col("_hk")) & F.col("_block").eqNullSafe(F.col("_hb"))
    inside = F.row_number().over(Window.partitionBy("_p").orderBy("_at"))
    rows = narrow.join(hit, same).withColumn("_i", inside).where(F.col("_i") == F.col("_p") - F.col("_before"))
    return {r["_p"]: (r[first], r["_at"]) for r in rows.select("_p", first, "_at").collect()}
