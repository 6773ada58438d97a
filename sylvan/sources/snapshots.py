"""Versioned snapshots: save a named, dated table; read the newest.

Layout:

    <root>/data/<id>/part-*.parquet        the rows of one version
    <root>/manifest/part-<n>.parquet       commit n: one row per version, published last
    <root>/staged/<id>/                    a manifest file that is being written

A manifest row holds the name, version, path, schema, row count, hash and the
number of rows with a value of a version, all as plain columns (nothing passes
through partition names, which would guess types). A version exists once its
manifest row does, also without rows; a reader opens the paths it has chosen
and no others, with one scan for each schema among them.

A save writes the data once. The row count, an order-independent hash and the
rows with a value are observed during the write of a single name; of a write
of several names they are one aggregate, keyed by name, over what was written.
If they and the schema (names and types) equal the newest version of the name,
the staged data is deleted and nothing is published.

Commits are numbered. A saver looks at the manifest, writes its manifest file
aside and renames it to the next number, which fails where that number is taken
(``session.rename_new``): another saver came first, so the manifest is looked
at again. Versions are therefore ordered by commit, not by the clocks of the
machines that wrote them, and of two savers of one name the second always
compares with what the first published; ``expect`` makes it stop instead. A
crash before the rename leaves only files that no manifest row names; module
``upkeep`` removes them and merges manifest files.
"""

from __future__ import annotations

import datetime as _dt
import json
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylvan.functions.names import entry_version, logical_name
from sylvan.operators.filters import has_data, is_empty_source
from sylvan.operators.reshape import union_by_name
from sylvan.session import delete_path, list_folder, rename_new

# zstd levels of the named compression presets
PRESETS = {"fast": 1, "balanced": 3, "high": 9, "archive": 19}

MANIFEST = "name string, version string, path string, columns string, rows long, hash string, written long, filled long, commit long"
# Name of the manifest file of a commit, also of one that merges all up to it.
COMMIT_FILE = re.compile(r"part-(\d{20})(-merged-[0-9a-f]+)?\.parquet")
# Times that a saver looks again because another one took its number.
PUBLISH_ATTEMPTS = 100
# Reserved column that splits one write into several named tables.
PART = "__sylvan_part"
# Order of the versions of a name (manifests of before have no commit).
NEWEST = ["commit", "written", "version"]
# Value of ``expect`` for a saver that takes any newest version.
ANY = "*"
# Column of ``read_latest`` that names the source.
SNAPSHOT = "snapshot_name"
# A row's place in the order of the sources: name, writing task, file, row.
ORDINAL = "struct<source:int,task:bigint,file:string,row:bigint>"


class SnapshotConflict(RuntimeError):
    """The newest version of a name is not the one that the saver expected."""


@dataclass(frozen=True)
class Version:
    name: str
    version: str
    path: str
    columns: str
    rows: int
    hash: str
    filled: int | None = None  # rows with a value; None in manifests of before

    @property
    def layout(self) -> tuple:
        return tuple((f["name"], json.dumps(f["type"])) for f in json.loads(self.columns)["fields"])

    @property
    def content(self) -> tuple:
        return self.layout, self.rows, self.hash

    @property
    def place(self) -> str:
        """The end of the path, the same in every spelling of the root."""
        return "/".join(self.path.split("/")[-2:])


def new_version() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d%H%M%S%f")


def _hashable(c: Column, dtype: T.DataType) -> Column:
    """Maps have no stable hash in Spark: use their entries, sorted."""
    if isinstance(dtype, T.MapType):
        entries = F.map_entries(c)
        inner = T.StructType([T.StructField("key", dtype.keyType), T.StructField("value", dtype.valueType)])
        return F.array_sort(F.transform(entries, lambda e: _hashable(e, inner)))
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda e: _hashable(e, dtype.elementType))
    if isinstance(dtype, T.StructType):
        return F.struct(*[_hashable(c[f.name], f.dataType).alias(f.name) for f in dtype.fields])
    return c


def row_hash(schema: T.StructType) -> Column:
    """Hash of a row. Each column enters as (position, is null, value), so a
    NULL that changes its place changes the hash."""
    parts = []
    for i, f in enumerate(schema.fields):
        c = F.col(f"`{f.name}`")
        parts += [F.lit(i), c.isNull(), _hashable(c, f.dataType)]
    return F.xxhash64(*parts) if parts else F.lit(0).cast("long")


def _measures(df: DataFrame, columns: list[str]) -> list[Column]:
    """Rows, order-independent hash and rows with a value, of ``columns``."""
    h = row_hash(df.select(*[F.col(f"`{c}`") for c in columns]).schema).cast("decimal(38,0)")
    total = F.coalesce(F.sum(h), F.lit(0).cast("decimal(38,0)")).cast("string")
    return [F.count(F.lit(1)).alias("rows"), total.alias("hash"), F.count_if(has_data(df, columns)).alias("filled")]


def fingerprint(df: DataFrame) -> tuple[int, str]:
    """Order-independent (rows, hash sum) of a table, as the manifest has it."""
    row = df.agg(*_measures(df, df.columns)).first()
    return row["rows"], row["hash"]


def manifest_rows(spark: SparkSession, root: str) -> DataFrame | None:
    if not list_folder(spark, f"{root}/manifest"):  # no version was ever published here
        return None
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")


def newest(spark: SparkSession, root: str, names=None) -> dict[str, Version]:
    """Newest version of each logical name (one row per name)."""
    manifest = manifest_rows(spark, root)
    if manifest is None:
        return {}
    if names is not None:
        manifest = manifest.where(F.col("name").isin([str(n) for n in names]))
    row = F.struct("name", "version", "path", "columns", "rows", "hash", "filled")
    rows = manifest.groupBy("name").agg(F.max_by(row, F.struct(*NEWEST)).alias("r")).select("r.*").collect()
    return {r["name"]: Version(**r.asDict()) for r in rows}


def latest_versions(spark: SparkSession, root: str, names=None) -> dict[str, str]:
    """Newest version string of each logical name under ``root``."""
    return {n: v.version for n, v in newest(spark, root, names).items()}


def last_commit(spark: SparkSession, root: str) -> int:
    """Number of the last commit, from the names of the manifest files (0: none)."""
    found = [COMMIT_FILE.fullmatch(e.name) for e in list_folder(spark, f"{root}/manifest")]
    return max((int(m[1]) for m in found if m), default=0)


def place_manifest(spark: SparkSession, root: str, rows: DataFrame, file: str) -> bool:
    """Write manifest rows aside as one file and rename it to ``file`` in the
    manifest; False, and nothing placed, where that file is there already."""
    staged = f"{root}/staged/{uuid.uuid4().hex}"
    rows.coalesce(1).write.parquet(staged)
    try:
        part = next(e.path for e in list_folder(spark, staged) if e.name.endswith(".parquet"))
        return rename_new(spark, part, f"{root}/manifest/{file}")
    finally:
        delete_path(spark, staged)


def _publish(spark: SparkSession, root: str, versions: list[Version], commit: int) -> bool:
    """Publish versions as commit number ``commit``; False where it is taken."""
    written = int(_dt.datetime.now(_dt.timezone.utc).timestamp() * 1e6)
    rows = [(v.name, v.version, v.path, v.columns, v.rows, v.hash, written, v.filled, commit) for v in versions]
    return place_manifest(spark, root, spark.createDataFrame(rows, MANIFEST), f"part-{commit:020d}.parquet")


def _writer(df: DataFrame, preset: str):
    return df.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", str(PRESETS[preset]))


def save_snapshot(
    df: DataFrame,
    root: str,
    name: str,
    preset: str = "high",
    skip_unchanged: bool = True,
    version: str | None = None,
    expect: str | None = ANY,
) -> str | None:
    """Write ``df`` as a new version of ``name``; return the version, or None
    when skipped because the newest snapshot holds the same rows. ``expect``:
    the version that ``df`` was made from (None: there is none); if the newest
    is another one when ``df`` is published, ``SnapshotConflict`` is raised and
    nothing is."""
    expected = None if expect == ANY else {name: expect}
    saved = save_parts(df.withColumn(PART, F.lit(0)), root, {0: name}, preset, skip_unchanged, version, expect=expected)
    return saved.get(name)


def save_parts(
    df: DataFrame,
    root: str,
    names: dict[int, str],
    preset: str = "high",
    skip_unchanged: bool = True,
    version: str | None = None,
    keep_empty: bool = True,
    balance: bool = False,
    expect: dict[str, str | None] | None = None,
) -> dict[str, str]:
    """Write the rows of each number in column ``PART`` as a new version of
    ``names[number]``, all in one job and one commit. Returns the versions
    published: not those that equal the newest one, nor, without
    ``keep_empty``, those without rows. ``balance`` shuffles the rows by number
    first, in partitions of about equal size (a large name in several, many
    small ones in one), so files do not number tasks times names; without it
    rows stay in their tasks and in order. ``expect``: as in ``save_snapshot``,
    by name; a conflict of one name publishes none."""
    spark = df.sparkSession
    staged = f"{root}/data/{uuid.uuid4().hex}"
    plain = T.StructType([f for f in df.schema.fields if f.name != PART])
    got = _write_measured(df.hint("rebalance", F.col(PART)) if balance else df, staged, plain, list(names), preset)
    version = version or new_version()
    made = [Version(name, version, f"{staged}/{PART}={k}", plain.json(), *got.get(k, (0, "0", 0))) for k, name in names.items()]
    for _ in range(PUBLISH_ATTEMPTS):
        commit = last_commit(spark, root) + 1  # before the look at the versions
        old = newest(spark, root, names.values()) if skip_unchanged or expect else {}
        for name, wanted in (expect or {}).items():
            found = old[name].version if name in old else None
            if found != wanted:
                delete_path(spark, staged)
                raise SnapshotConflict(f"newest version of {name!r} is {found}, not {wanted}")
        same = {v.name for v in made if skip_unchanged and v.name in old and old[v.name].content == v.content}
        fresh = [v for v in made if v.name not in same and (v.rows or keep_empty)]
        if not fresh:
            delete_path(spark, staged)
            return {}
        if _publish(spark, root, fresh, commit):
            break
    else:
        raise SnapshotConflict(f"no commit of {root} was free in {PUBLISH_ATTEMPTS} attempts")
    published = {v.path for v in fresh}
    for v in made:
        if v.rows and v.path not in published:
            delete_path(spark, v.path)
    return {v.name: v.version for v in fresh}


def _write_measured(
    df: DataFrame, staged: str, plain: T.StructType, numbers: list[int], preset: str
) -> dict[int, tuple[int, str, int]]:
    """Write ``df`` by ``PART``; (rows, hash, rows with a value) of each number."""
    columns = plain.names
    if len(numbers) == 1:  # no key: measured in passing
        seen = Observation(f"snapshot-{uuid.uuid4().hex}")
        _writer(df.observe(seen, *_measures(df, columns)), preset).partitionBy(PART).parquet(staged)
        return {numbers[0]: (seen.get["rows"], seen.get["hash"], seen.get["filled"])}
    _writer(df, preset).partitionBy(PART).parquet(staged)
    written = df.sparkSession.read.schema(T.StructType([*plain.fields, T.StructField(PART, T.IntegerType())])).parquet(staged)
    found = written.groupBy(PART).agg(*_measures(written, columns)).collect()  # one row a name
    return {r[PART]: (r["rows"], r["hash"], r["filled"]) for r in found}


def open_version(spark: SparkSession, found: Version) -> DataFrame:
    """The rows of one version; a version without rows is an empty table."""
    schema = T.StructType.fromJson(json.loads(found.columns))
    if found.rows == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(found.path)


def read_latest(spark: SparkSession, root: str, names=None, name_col: str = SNAPSHOT, ordinal: str | None = None) -> DataFrame:
    """All newest snapshots under ``root`` as one table, with the logical name
    in ``name_col`` (S6). Only the chosen versions are opened; they are unioned
    by column name with the type check of ``union_by_name``. ``ordinal`` adds a
    total order: (place of the name, writing task, file, row in the file)."""
    chosen = newest(spark, root, names)
    if not chosen:
        raise FileNotFoundError(f"no snapshots under {root}")
    return open_versions(spark, chosen.values(), name_col, ordinal)


def has_values(spark: SparkSession, found: Version) -> bool:
    """Whether a version holds any value, from the manifest (a manifest row of
    before it was counted: by looking for a first row that has one)."""
    return not is_empty_source(open_version(spark, found)) if found.filled is None else found.filled > 0


def open_versions(spark: SparkSession, versions: Iterable[Version], name_col: str = SNAPSHOT, ordinal: str | None = None) -> DataFrame:
    """Versions of different names as one table, in the order of the names:
    one scan for each schema, a row's name found by joining its file's folder
    with the chosen versions (a local table whose size Spark knows)."""
    groups: dict[tuple, list[tuple[int, Version]]] = {}
    for place, found in enumerate(sorted(versions, key=lambda v: v.name)):
        taken = {name_col, ordinal} & {column for column, _ in found.layout}
        if taken:
            raise ValueError(f"snapshot {found.name!r} has a column {sorted(taken)[0]!r}; give another name")
        groups.setdefault(found.layout, []).append((place, found))
    return union_by_name([_open_group(spark, group, name_col, ordinal) for group in groups.values()])


def _open_group(spark: SparkSession, group: list[tuple[int, Version]], name_col: str, ordinal: str | None) -> DataFrame:
    """Versions of one schema, by one scan of their folders."""
    schema = T.StructType.fromJson(json.loads(group[0][1].columns))
    columns = [F.col(f"`{c}`") for c in schema.names]
    opened = [(place, v) for place, v in group if v.rows]
    if not opened:
        extra = [F.lit(None).cast("string").alias(name_col)] + ([F.lit(None).cast(ORDINAL).alias(ordinal)] if ordinal else [])
        return spark.createDataFrame([], schema).select(*extra, *columns)
    files = spark.read.schema(schema).parquet(*[v.path for _, v in opened])
    file = files.metadataColumn("_metadata")
    folder = F.substring_index(F.substring_index(file["file_path"], "/", -3), "/", 2)
    at = F.struct(
        F.regexp_extract(file["file_name"], r"^part-(\d+)", 1).try_cast("long").alias("task"),
        file["file_path"].alias("file"),
        file["row_index"].alias("row"),
    )
    rows = files.select(folder.alias("__sylvan_folder"), *([at.alias("__sylvan_at")] if ordinal else []), *columns)
    keys = pa.table({
        "__sylvan_in": pa.array([v.place for _, v in opened], pa.string()),
        "__sylvan_name": pa.array([v.name for _, v in opened], pa.string()),
        "__sylvan_source": pa.array([place for place, _ in opened], pa.int32()),
    })
    named = rows.join(spark.createDataFrame(keys), F.col("__sylvan_folder") == F.col("__sylvan_in"))
    extra = [F.col("__sylvan_name").alias(name_col)]
    if ordinal:
        order = F.struct(F.col("__sylvan_source").alias("source"), *[F.col("__sylvan_at")[c].alias(c) for c in ("task", "file", "row")])
        extra.append(order.alias(ordinal))
    return named.select(*extra, *columns)


def read_latest_files(spark: SparkSession, folder: str, names=None, name_col: str = SNAPSHOT) -> DataFrame:
    """Newest version of every logical name in a flat folder whose entries
    are named ``<name>[_<date>[_<n>]].parquet`` (files or parquet folders),
    as one table with the name in ``name_col`` (S6 for an existing folder).

    The listing is a ``binaryFile`` scan without the file contents; the name /
    version split and the newest-per-name choice run in Spark, by date and
    number (an entry without a date is the oldest); only the chosen entries
    (one per name) come to the driver. They are read and unioned by column
    name with the type check of ``union_by_name``.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(folder)
        .select("path")
    )
    # the entry is what follows the folder's path (without its scheme)
    here = folder.split("://")[-1].rstrip("/") + "/"
    length = F.instr(F.col("path"), here) + len(here) - 1
    entry = F.substring_index(F.substring(F.col("path"), length + 1, F.length("path")), "/", 1)
    entries = listing.select(
        F.concat(F.substring(F.col("path"), F.lit(1), length), entry).alias("entry_path"),
        logical_name(entry).alias("name"), entry_version(entry).alias("version"),
    )
    if names is not None:
        entries = entries.where(F.col("name").isin([str(n) for n in names]))
    chosen = entries.groupBy("name").agg(F.max_by("entry_path", "version").alias("entry_path")).collect()
    if not chosen:
        raise FileNotFoundError(f"no entries in {folder}")
    frames = []
    for r in sorted(chosen, key=lambda r: r["name"]):
        frame = spark.read.parquet(r["entry_path"])
        if name_col in frame.columns:
            raise ValueError(f"entry {r['name']!r} has a column {name_col!r}; give another name")
        frames.append(frame.select(F.lit(r["name"]).alias(name_col), "*"))
    return union_by_name(frames)
