"""Numbered commits, two savers, crashes, merged manifests, removal."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from sylvan.sources import snapshots, upkeep
from sylvan.sources.snapshots import PART, SnapshotConflict, newest, read_latest, save_parts, save_snapshot


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="sylvan-upkeep-")


def ids(spark, n):
    return spark.range(n).select("id")


def manifest_files(root):
    return sorted(f for f in os.listdir(f"{root}/manifest") if f.endswith(".parquet"))


def data_folders(root):
    return sorted(f for f in os.listdir(f"{root}/data"))


def meanwhile(monkeypatch, other):
    """Run ``other`` once, after a saver's look and before it publishes."""
    publish, turns = snapshots._publish, []

    def late(*args):
        turns.append(None)
        if len(turns) == 1:
            other()
        return publish(*args)

    monkeypatch.setattr(snapshots, "_publish", late)
    return turns


def test_commits_are_numbered(spark, root):
    for n in (1, 2, 3):
        save_snapshot(ids(spark, n), root, "t")
    assert manifest_files(root) == [f"part-{n:020d}.parquet" for n in (1, 2, 3)]
    assert newest(spark, root)["t"].rows == 3 and os.listdir(f"{root}/staged") == []


def test_two_savers_of_one_name_are_both_kept_in_order(spark, root, monkeypatch):
    save_snapshot(ids(spark, 1), root, "t", version="1")
    turns = meanwhile(monkeypatch, lambda: save_snapshot(ids(spark, 2), root, "t", version="9"))
    # the later commit is the newest, whatever the versions and clocks say
    assert save_snapshot(ids(spark, 3), root, "t", version="5") == "5"
    assert len(turns) == 3  # own try, the other's, own second try
    assert newest(spark, root)["t"].version == "5" and read_latest(spark, root).count() == 3
    rows = spark.read.parquet(f"{root}/manifest").orderBy("commit").collect()
    assert [(r["version"], r["commit"]) for r in rows] == [("1", 1), ("9", 2), ("5", 3)]


def test_second_saver_of_equal_rows_publishes_nothing(spark, root, monkeypatch):
    save_snapshot(ids(spark, 1), root, "t")
    meanwhile(monkeypatch, lambda: save_snapshot(ids(spark, 2), root, "t"))
    assert save_snapshot(ids(spark, 2), root, "t") is None
    assert len(manifest_files(root)) == 2 and len(data_folders(root)) == 2


def test_saver_that_expects_a_version_stops(spark, root, monkeypatch):
    first = save_snapshot(ids(spark, 1), root, "t")
    with pytest.raises(SnapshotConflict):
        save_snapshot(ids(spark, 2), root, "t", expect=None)
    meanwhile(monkeypatch, lambda: save_snapshot(ids(spark, 2), root, "t", version="between"))
    with pytest.raises(SnapshotConflict):
        save_snapshot(ids(spark, 3), root, "t", expect=first)
    assert newest(spark, root)["t"].version == "between" and len(data_folders(root)) == 2
    assert save_snapshot(ids(spark, 3), root, "t", expect="between") is not None
    assert save_snapshot(ids(spark, 3), root, "new", expect=None) is not None


def test_savers_of_different_names_do_not_disturb_each_other(spark, root, monkeypatch):
    meanwhile(monkeypatch, lambda: save_snapshot(ids(spark, 2), root, "other"))
    assert save_snapshot(ids(spark, 3), root, "t", expect=None) is not None
    assert {n: v.rows for n, v in newest(spark, root).items()} == {"t": 3, "other": 2}


def test_crash_between_data_and_manifest(spark, root, monkeypatch):
    save_snapshot(ids(spark, 1), root, "t")
    with monkeypatch.context() as broken:
        broken.setattr(snapshots, "rename_new", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            save_snapshot(ids(spark, 2), root, "t")
    # the old version stands, the lost one is only a folder that no row names
    assert read_latest(spark, root).count() == 1 and len(data_folders(root)) == 2
    assert upkeep.unnamed_folders(spark, root) == []  # too young
    assert len(upkeep.remove_unnamed(spark, root, older_than=0)) == 1
    assert len(data_folders(root)) == 1 and read_latest(spark, root).count() == 1
    assert save_snapshot(ids(spark, 2), root, "t") is not None and read_latest(spark, root).count() == 2


def test_merge_keeps_every_version_and_the_numbering(spark, root):
    for n in (1, 2, 3):
        save_snapshot(ids(spark, n), root, "t")
    save_snapshot(ids(spark, 0), root, "empty")
    before = newest(spark, root)
    assert upkeep.compact_manifest(spark, root) == 0  # all younger than the grace: rows twice
    assert len(manifest_files(root)) == 5 and newest(spark, root) == before
    assert upkeep.compact_manifest(spark, root, grace=0) == 5
    assert len(manifest_files(root)) == 1 and newest(spark, root) == before
    assert spark.read.parquet(f"{root}/manifest").count() == 4
    save_snapshot(ids(spark, 5), root, "t")
    assert manifest_files(root)[-1] == f"part-{5:020d}.parquet" and newest(spark, root)["t"].rows == 5


def test_crash_after_the_merged_file_is_placed(spark, root, monkeypatch):
    for n in (1, 2):
        save_snapshot(ids(spark, n), root, "t")
    before = newest(spark, root)
    with monkeypatch.context() as broken:
        broken.setattr(upkeep, "delete_path", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            upkeep.compact_manifest(spark, root, grace=0)
    assert newest(spark, root) == before and len(manifest_files(root)) == 3
    assert upkeep.compact_manifest(spark, root, grace=0) == 3
    assert newest(spark, root) == before and spark.read.parquet(f"{root}/manifest").count() == 2


def test_a_save_during_a_merge_is_not_lost(spark, root, monkeypatch):
    for n in (1, 2):
        save_snapshot(ids(spark, n), root, "t")
    place = upkeep.place_manifest
    monkeypatch.setattr(upkeep, "place_manifest", lambda *a: save_snapshot(ids(spark, 7), root, "t") and place(*a))
    upkeep.compact_manifest(spark, root, grace=0)
    assert newest(spark, root)["t"].rows == 7 and len(manifest_files(root)) == 2


def test_old_versions_are_forgotten_and_their_data_removed(spark, root):
    both = ids(spark, 10).withColumn(PART, (F.col("id") % 2).cast("int"))
    save_parts(both, root, {0: "even", 1: "odd"})
    for n in (1, 2, 3):
        save_snapshot(ids(spark, n), root, "even")
    upkeep.compact_manifest(spark, root, keep=2, grace=0)
    rows = spark.read.parquet(f"{root}/manifest")
    assert sorted((r["name"], r["rows"]) for r in rows.collect()) == [("even", 2), ("even", 3), ("odd", 5)]
    gone = upkeep.remove_unnamed(spark, root, older_than=0)
    # the folder of even in the first save, whose odd part stays, and the save of one row
    assert len(gone) == 2 and sum(f"{PART}=0" in p for p in gone) == 1
    assert {r["snapshot_name"]: r["count"] for r in read_latest(spark, root).groupBy("snapshot_name").count().collect()} == {"even": 3, "odd": 5}
    with pytest.raises(ValueError):
        upkeep.compact_manifest(spark, root, keep=0)


def test_manifest_of_before_has_no_commits(spark, root):
    save_snapshot(ids(spark, 1), root, "t")
    old = spark.read.parquet(f"{root}/manifest").drop("commit").collect()
    spark.createDataFrame(old).coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest")
    assert newest(spark, root)["t"].rows == 1
    save_snapshot(ids(spark, 2), root, "t")
    assert newest(spark, root)["t"].rows == 2
    upkeep.compact_manifest(spark, root, grace=0)
    assert newest(spark, root)["t"].rows == 2 and spark.read.parquet(f"{root}/manifest").count() == 2


def test_nothing_to_keep_up(spark, root):
    assert upkeep.compact_manifest(spark, root) == 0 and upkeep.remove_unnamed(spark, root, older_than=0) == []


def test_crash_of_the_first_save(spark, root, monkeypatch):
    with monkeypatch.context() as broken:
        broken.setattr(snapshots, "rename_new", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            save_snapshot(ids(spark, 2), root, "t")
    assert newest(spark, root) == {} and len(upkeep.remove_unnamed(spark, root, older_than=0)) == 1
    assert data_folders(root) == []
