"""Upkeep of a snapshot root: merge manifest files, forget old versions, remove
what no manifest row names (S7).

Neither step stops savers or readers. A merge writes one file with the rows of
all manifest files it has read and only then removes them; in between rows are
there twice, which changes no answer (a reader takes the newest row of a name).
A file younger than ``grace`` seconds stays, so that a saver or reader that has
listed the folder still finds what it listed; the next merge removes it.
``grace`` must be longer than a look at the manifest takes, the ``older_than``
of ``remove_unnamed`` longer than the longest write.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from sylvan.session import delete_path, list_folder
from sylvan.sources.snapshots import COMMIT_FILE, MANIFEST, NEWEST, PART, manifest_rows, place_manifest

GRACE = 3600.0
OLDER_THAN = 7 * 86400.0


def compact_manifest(spark: SparkSession, root: str, keep: int | None = None, grace: float = GRACE) -> int:
    """Merge the manifest files into one; with ``keep``, only the newest
    ``keep`` versions of each name stay. Returns the files removed.

    A crash leaves files whose rows are there twice (or a merged file that is
    not yet in place): nothing is lost and the next merge cleans up."""
    if keep is not None and keep < 1:
        raise ValueError("keep must be 1 or more")
    found = [e for e in list_folder(spark, f"{root}/manifest") if e.name.endswith(".parquet")]
    if not found or (len(found) == 1 and keep is None):
        return 0
    rows = spark.read.schema(MANIFEST).parquet(*[e.path for e in found]).distinct()  # each version once
    if keep is not None:
        place = F.row_number().over(Window.partitionBy("name").orderBy(*[F.desc(c) for c in NEWEST]))
        rows = rows.withColumn("_place", place).where(F.col("_place") <= keep).drop("_place")
    numbers = [COMMIT_FILE.fullmatch(e.name) for e in found]
    last = max((int(m[1]) for m in numbers if m), default=0)
    if not place_manifest(spark, root, rows, f"part-{last:020d}-merged-{uuid.uuid4().hex}.parquet"):
        raise RuntimeError(f"a merged manifest of {root} is there already")
    removed = [e for e in found if e.modified <= time.time() - grace]
    for entry in removed:
        delete_path(spark, entry.path)
    return len(removed)


def unnamed_folders(spark: SparkSession, root: str, older_than: float = OLDER_THAN) -> list[str]:
    """Folders under ``data`` and ``staged`` that no manifest row names and
    that are at least ``older_than`` seconds old: what crashed saves and
    forgotten versions left. One listing of each save's folder; names are
    compared with the manifest by a join."""
    limit = time.time() - older_than
    saves = [e for e in list_folder(spark, f"{root}/data") if e.is_folder and e.modified <= limit]
    left = [e.path for e in list_folder(spark, f"{root}/staged") if e.modified <= limit]
    # a save's folder holds one folder for each of its names
    parts = [(s.name, e.name, s.path, e.path) for s in saves for e in list_folder(spark, s.path) if e.name.startswith(f"{PART}=")]
    bare = {s.path for s in saves} - {p[2] for p in parts}
    if parts:
        listed = spark.createDataFrame(parts, "save string, part string, save_path string, path string")
        place = F.substring_index("path", "/", -2)
        manifest = manifest_rows(spark, root)
        if manifest is None:  # nothing was ever published
            manifest = spark.createDataFrame([], MANIFEST)
        named = manifest.select(F.substring_index(place, "/", 1).alias("save"), F.substring_index(place, "/", -1).alias("part"))
        counted = listed.join(named.distinct().withColumn("named", F.lit(1)), ["save", "part"], "left")
        folders = counted.groupBy("save_path").agg(
            F.count("named").alias("named"), F.collect_list(F.when(F.col("named").isNull(), F.col("path"))).alias("gone")
        )
        for row in folders.where(F.size("gone") > 0).collect():  # only what is to go
            left += row["gone"] if row["named"] else [row["save_path"]]
    # a version without rows has no folder of its own, so an old empty save's folder goes too
    return sorted([*left, *bare])


def remove_unnamed(spark: SparkSession, root: str, older_than: float = OLDER_THAN) -> list[str]:
    """Delete the folders of ``unnamed_folders``; returns them."""
    gone = unnamed_folders(spark, root, older_than)
    for path in gone:
        delete_path(spark, path)
    return gone
