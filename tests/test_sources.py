import tempfile

import pytest
from pyspark.sql import functions as F

from sylvan.plans.records import combine_sources, conform_records, write_chunks
from sylvan.sources.records import ingest_traits, read_trait_records
from sylvan.sources.snapshots import fingerprint, latest_versions, read_latest, save_snapshot


def test_snapshot_roundtrip_and_skip(spark):
    root = tempfile.mkdtemp(prefix="sylvan-snap-")
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    b = spark.createDataFrame([(2, "y"), (1, "x")], "id int, v string")
    assert fingerprint(a) == fingerprint(b)
    v1 = save_snapshot(a, root, "t", version="20240101000000000000")
    assert v1 is not None
    assert save_snapshot(b, root, "t") is None  # same rows in another order
    c = spark.createDataFrame([(3, "z")], "id int, v string")
    v2 = save_snapshot(c, root, "t", version="20240102000000000000")
    assert latest_versions(spark, root) == {"t": v2}
    got = read_latest(spark, root).collect()
    assert [(r.snapshot_name, r.id, r.v) for r in got] == [("t", 3, "z")]


def test_ingest_combine_conform(spark):
    root = tempfile.mkdtemp(prefix="sylvan-ingest-")
    source = spark.createDataFrame(
        [
            ("leaf area", 1, "Abies alba", "2.5", "mm2", "cite", "Pinaceae"),
            ("seed mass", 2, "Abies alba", "n/a", "mg", None, "Pinaceae"),
            ("leaf area per leaf dry mass", 3, "Picea abies", "12", "mm2 mg-1", "c", "Pinaceae"),
            ("stem wood density", 4, None, None, None, None, None),
        ],
        "trait_name string, id long, scrubbed_species_binomial string, trait_value string, unit string, "
        "source_citation string, verbatim_family string",
    )
    records = read_trait_records(source, "leaf area", taxonomy=False, citation=False)
    assert "verbatim_family" not in records.columns and "source_citation" not in records.columns
    written = ingest_traits(source, ["leaf area", "seed mass"], root)
    assert written == ["leaf area", "seed mass"]
    assert ingest_traits(source, ["leaf area", "seed mass"], root) == []
    # the substring test finds "leaf area" inside the stored name ... nothing
    # stored contains the longer name, so it is still missing
    assert ingest_traits(source, ["leaf area per leaf dry mass"], root, match="contains") == ["leaf area per leaf dry mass"]
    combined = combine_sources(spark, root)
    conformed = conform_records(combined)
    assert conformed.columns == ["trait_name", "id", "scrubbed_species_binomial", "trait_value", "unit", "source_citation"]
    got = sorted((r.trait_name, r.id, r.trait_value) for r in conformed.collect())
    assert got == [("leaf area", "1", 2.5), ("leaf area per leaf dry mass", "3", 12.0), ("seed mass", "2", None)]


def test_write_chunks(spark):
    out = tempfile.mkdtemp(prefix="sylvan-chunks-") + "/chunks"
    df = spark.range(11).withColumnRenamed("id", "k")
    assert sorted(write_chunks(df, out, "c", ["k"], 4, "lossless")) == ["c_0", "c_1", "c_2", "c_3"]
    back = read_latest(spark, out)
    assert back.columns == ["snapshot_name", "k"]
    sizes = [r["count"] for r in back.groupBy("snapshot_name").count().orderBy("snapshot_name").collect()]
    assert sizes == [3, 3, 3, 2]
    assert write_chunks(df, out, "c", ["k"], 4, "lossless") == {}  # unchanged
    assert list(write_chunks(df.withColumn("k", F.when(F.col("k") < 10, F.col("k")).otherwise(99)), out, "c", ["k"], 4)) == ["c_3"]


def test_equal_order_keys_spread(spark):
    from sylvan.operators.ordering import with_global_position

    df = spark.range(20_000).selectExpr("1 as k", "id as v")
    placed, total = with_global_position(df, ["k"], num_partitions=8)
    sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    assert total == 20_000 and len(sizes) > 1 and max(sizes) < 10_000
    assert placed.select("pos").distinct().count() == 20_000


def test_scratch_scope_leaves_nothing(spark):
    import os

    from sylvan.operators.summaries import describe_numeric, describe_strings
    from sylvan.plans.traits import trait_table
    from sylvan.session import Scratch
    from test_trait_table import SCHEMA, golden_rows

    with Scratch(spark, "scope") as scratch:
        assert trait_table(spark.createDataFrame(golden_rows(), SCHEMA), scratch=scratch).count() == 7
        table = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "v double, s string")
        assert describe_numeric(table, scratch=scratch).count() == 1
        assert describe_strings(table, scratch=scratch).count() == 2
        root = scratch.root.removeprefix("file:")
        assert len(os.listdir(root)) >= 4
    assert not os.path.exists(root)


def test_streaming_landing(spark):
    import os

    from sylvan.plans.traits import trait_table
    from sylvan.streaming import land_exports
    from test_trait_table import GOLDEN

    base = tempfile.mkdtemp(prefix="sylvan-stream-")
    src = os.path.join(base, "in")
    os.makedirs(src)
    header = ["Dataset", "AccSpeciesName", "ObservationID", "TraitID", "DataID", "DataName", "OrigValueStr", "UnitName"]
    lines = ["\t".join(header)]
    for line in GOLDEN.strip().splitlines():
        t, o, d, n, ds, sp, v, u = line.split("|")
        lines.append("\t".join([ds, sp, o, t, d, n, v, u]))
    half = len(lines) // 2
    with open(os.path.join(src, "a.txt"), "w") as fh:
        fh.write("\n".join(lines[:half]) + "\n")
    with open(os.path.join(src, "b.txt"), "w") as fh:
        fh.write("\n".join([lines[0]] + lines[half:]) + "\n")
    schema = ", ".join(f"`{c}` string" for c in header)
    q = land_exports(spark, src, os.path.join(base, "out"), os.path.join(base, "ckpt"), schema)
    q.awaitTermination(120)
    landed = spark.read.parquet(os.path.join(base, "out"))
    assert landed.count() == 25 and landed.select("ord").distinct().count() == 25
    assert trait_table(landed).count() == 7
    # a restart processes only new files: nothing twice, the new one once
    land_exports(spark, src, os.path.join(base, "out"), os.path.join(base, "ckpt"), schema).awaitTermination(120)
    assert spark.read.parquet(os.path.join(base, "out")).count() == 25
    with open(os.path.join(src, "c.txt"), "w") as fh:
        fh.write("\n".join([lines[0], lines[1]]) + "\n")
    land_exports(spark, src, os.path.join(base, "out"), os.path.join(base, "ckpt"), schema).awaitTermination(120)
    assert spark.read.parquet(os.path.join(base, "out")).count() == 26


def test_workflow_jobs(spark):
    import os

    from sylvan.plans.jobs import ingest_job, records_job, trait_export_job
    from test_trait_table import GOLDEN

    base = tempfile.mkdtemp(prefix="sylvan-jobs-")
    header = ["Dataset", "AccSpeciesName", "ObservationID", "TraitID", "DataID", "DataName", "OrigValueStr", "UnitName"]
    lines = ["\t".join(header)]
    for line in GOLDEN.strip().splitlines():
        t, o, d, n, ds, sp, v, u = line.split("|")
        lines.append("\t".join([ds, sp, o, t, d, n, v, u]))
    export = os.path.join(base, "export.txt")
    with open(export, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    out = trait_export_job(spark, export, os.path.join(base, "e1"))
    assert out["table"].count() == 7
    assert out["species"].count() == 7
    assert out["domains"].count() == 0  # no species has more than 50 rows

    source = spark.createDataFrame(
        [("leaf area", i, f"sp{i % 3}", str(i), "mm2", "cite") for i in range(10)]
        + [("seed mass", 100 + i, "sp1", "n/a" if i == 0 else str(i), "mg", None) for i in range(5)]
        + [("other trait", 200, "sp1", "1", "u", None)],
        "trait_name string, id long, scrubbed_species_binomial string, trait_value string, unit string, source_citation string",
    )
    source_path = os.path.join(base, "source")
    source.write.parquet(source_path)
    root = os.path.join(base, "records")
    from sylvan.sources.catalog import WANTED_TRAITS

    assert ingest_job(spark, source_path, root) == sorted(WANTED_TRAITS)
    e3 = records_job(spark, root, os.path.join(base, "e3"))
    assert e3["records"].count() == 15
    chunks = read_latest(spark, os.path.join(base, "e3"))
    assert sorted(r["count"] for r in chunks.groupBy("snapshot_name").count().collect()) == [3, 4, 4, 4]
    assert "ord" not in chunks.columns
    assert {r.column for r in e3["missing"].collect()} == set(e3["records"].columns)


def test_fingerprint_of_maps_ignores_entry_order(spark):
    a = spark.sql("select 1 as k, map('x', 1, 'y', 2) as m, array(map('p', 'q')) as am")
    b = spark.sql("select 1 as k, map('y', 2, 'x', 1) as m, array(map('p', 'q')) as am")
    c = spark.sql("select 1 as k, map('y', 3, 'x', 1) as m, array(map('p', 'q')) as am")
    assert fingerprint(a) == fingerprint(b) != fingerprint(c)


def test_combine_sources_input_variations(spark):
    """Sources without ``method``, with an extra column, empty, all missing,
    and an unparsable value: union by name, empty ones dropped."""
    root = tempfile.mkdtemp(prefix="sylvan-combine-")
    base = "trait_name string, id long, scrubbed_species_binomial string, trait_value string, unit string, longitude double"
    full = spark.createDataFrame(
        [("leaf area", 1, "Abies alba", "2.5", "mm2", 16.2, "m1"), ("leaf area", 2, "Abies alba", "x1", "mm2", None, "m2")],
        base + ", method string",
    )
    no_method = spark.createDataFrame([("seed mass", 3, "Picea abies", "1e-3", "mg", 10.0)], base)
    extra = spark.createDataFrame([("stem wood density", 4, "Picea abies", "0.4", "g/cm3", None, "x")], base + ", `Extra Col` string")
    empty = spark.createDataFrame([], base)
    all_missing = spark.createDataFrame([(None, None, None, None, None, None)], base)
    for name, df in [("leaf area", full), ("seed mass", no_method), ("stem wood density", extra), ("empty", empty), ("blank", all_missing)]:
        save_snapshot(df, root, name)
    combined = combine_sources(spark, root)
    assert set(combined.columns) >= {"snapshot_name", "method", "extra_col", "longitude"}
    assert sorted(r.snapshot_name for r in combined.select("snapshot_name").distinct().collect()) == ["leaf area", "seed mass", "stem wood density"]
    conformed = {r.id: r for r in conform_records(combined).collect()}
    assert conformed["1"].trait_value == 2.5 and conformed["1"].method == "m1"
    assert conformed["2"].trait_value is None  # "x1" does not parse
    assert conformed["3"].trait_value == 0.001 and conformed["3"].method is None
    assert conformed["4"].longitude is None and "extra_col" not in conform_records(combined).columns


def test_read_latest_files_flat_folder(spark):
    import os

    from sylvan.sources.snapshots import read_latest_files

    folder = os.path.join(tempfile.mkdtemp(prefix="sylvan-flat-"), "store")
    entries = {
        "leaf area_2023-01-01.parquet": [(1, "old")],
        "leaf area_2023-05-01.parquet": [(2, "new"), (3, "new")],
        "seed mass_2023-02-01.parquet": [(4, "only")],
        "notes.parquet": [(9, "no version")],
    }
    for entry, rows in entries.items():
        spark.createDataFrame(rows, "id int, v string").write.parquet(os.path.join(folder, entry))
    got = sorted((r.snapshot_name, r.id, r.v) for r in read_latest_files(spark, folder).collect())
    # every name of the folder is read, also one without a version
    assert got == [("leaf area", 2, "new"), ("leaf area", 3, "new"), ("notes", 9, "no version"), ("seed mass", 4, "only")]


def test_snapshot_changes_that_a_plain_hash_misses(spark):
    root = tempfile.mkdtemp(prefix="sylvan-snap-")
    first = spark.createDataFrame([("x", None)], "a string, b string")
    moved = spark.createDataFrame([(None, "x")], "a string, b string")
    assert fingerprint(first) != fingerprint(moved)
    for table in (first, moved, moved.toDF("c", "d"), moved.toDF("c", "d").where("false")):
        assert save_snapshot(table, root, "t") is not None
        assert save_snapshot(table, root, "t") is None
    assert read_latest(spark, root).columns == ["snapshot_name", "c", "d"] and read_latest(spark, root).count() == 0


def test_snapshot_key_column_never_overwrites(spark):
    root = tempfile.mkdtemp(prefix="sylvan-snap-")
    save_snapshot(spark.createDataFrame([(1, "x")], "snapshot_name int, v string"), root, "t")
    with pytest.raises(ValueError):
        read_latest(spark, root)
    assert read_latest(spark, root, name_col="source").columns == ["source", "snapshot_name", "v"]


def test_record_chunks_keep_file_order(spark):
    from sylvan.plans.records import write_record_chunks

    out = tempfile.mkdtemp(prefix="sylvan-chunks-")
    rows = [("b", "9", 0), ("a", "10", 1), ("b", None, 2), ("a", "9", 3), ("b", "9", 4), (None, "1", 5), ("a", "9", 6), ("c", "2", 7)]
    df = spark.createDataFrame(rows, "trait_name string, id string, ord int")
    write_record_chunks(df, out, "data", "ord")
    got = {}
    for r in read_latest(spark, out).collect():
        got.setdefault(r.snapshot_name, []).append((r.trait_name, r.id))
    # b first, then a, then NULL, then c
    want = [[("b", "9"), ("b", None)], [("b", "9"), ("a", "10")], [("a", "9"), ("a", "9")], [(None, "1"), ("c", "2")]]
    assert {k: sorted(v, key=str) for k, v in got.items()} == {f"data_{k}": sorted(v, key=str) for k, v in enumerate(want)}


def test_many_names_one_scan_per_schema(spark, capsys):
    """1,000 names of two schemas: two scans, joins that Spark broadcasts by
    itself, and far fewer files than tasks x names."""
    import os

    from sylvan.sources.snapshots import PART, save_parts

    root = tempfile.mkdtemp(prefix="sylvan-many-")
    rows = spark.range(0, 4000, 1, 8)
    part = (F.col("id") % 500).cast("int").alias(PART)
    assert len(save_parts(rows.select("id", part), root, {k: f"a {k}" for k in range(500)}, balance=True)) == 500
    assert len(save_parts(rows.select(F.col("id").cast("string").alias("text"), part), root, {k: f"b {k}" for k in range(500)}, balance=True)) == 500
    files = sum(f.endswith(".parquet") for _, _, fs in os.walk(os.path.join(root, "data")) for f in fs)
    assert files <= 1100  # 8 tasks x 1,000 names were 8,000
    table = read_latest(spark, root, ordinal="ord")
    table.explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan parquet") == 2 and "SortMergeJoin" not in plan
    got = table.collect()
    assert len(got) == 8000 and len({tuple(r["ord"]) for r in got}) == 8000
    assert {(r["snapshot_name"], r["id"], r["text"]) for r in got} == {
        row for i in range(4000) for row in ((f"a {i % 500}", i, None), (f"b {i % 500}", None, str(i)))
    }
    # the places follow the names
    names = sorted({r["snapshot_name"] for r in got})
    assert all(names[r["ord"].source] == r["snapshot_name"] for r in got)


def test_empty_sources_from_the_manifest(spark):
    """Sources without a value are left out by the counts of the manifest; a
    manifest of before (no count) is answered from the data."""
    from sylvan.sources.snapshots import has_values, newest

    root = tempfile.mkdtemp(prefix="sylvan-filled-")
    save_snapshot(spark.createDataFrame([(1.0, None), (None, None)], "a double, b string"), root, "some")
    save_snapshot(spark.createDataFrame([(float("nan"), None), (None, None)], "a double, b string"), root, "nothing")
    save_snapshot(spark.createDataFrame([], "a double, c int"), root, "no rows")
    found = newest(spark, root)
    assert {n: (v.rows, v.filled) for n, v in found.items()} == {"some": (2, 1), "nothing": (2, 0), "no rows": (0, 0)}
    assert combine_sources(spark, root).columns == ["snapshot_name", "a", "b"]
    assert combine_sources(spark, root).count() == 2
    assert combine_sources(spark, root, ["nothing", "no rows"]).count() == 0
    old = {n: v.__class__(v.name, v.version, v.path, v.columns, v.rows, v.hash) for n, v in found.items()}
    assert [has_values(spark, old[n]) for n in ("some", "nothing", "no rows")] == [True, False, False]


def test_measures_of_one_and_of_many_names_agree(spark):
    """A table saved alone and as one of several has the same manifest content."""
    from sylvan.sources.snapshots import PART, newest, save_parts

    root = tempfile.mkdtemp(prefix="sylvan-measures-")
    table = spark.sql(
        "select id, cast(id as double) / 3 as d, if(id % 2 = 0, null, map('k', id)) as m, array(struct(id as x)) as s, "
        "timestamp_seconds(id) as t, cast(id as decimal(20, 3)) as n from range(50)"
    )
    save_snapshot(table, root, "alone")
    save_parts(table.withColumn(PART, F.lit(0)), root, {0: "one of two", 1: "the other"})
    found = newest(spark, root)
    assert found["alone"].content == found["one of two"].content and found["the other"].rows == 0


def test_record_chunks_are_written_in_order(spark):
    """Rows of a chunk in order, over several tasks, whatever the session's
    number of shuffle partitions."""
    import os

    import pyarrow.parquet as pq

    from sylvan.plans.records import write_record_chunks
    from sylvan.sources.snapshots import newest

    out = tempfile.mkdtemp(prefix="sylvan-chunks-")
    rows = spark.range(0, 1000, 1, 5).select(F.concat(F.lit("t"), F.col("id") % 3).alias("trait_name"), F.col("id").alias("v"), F.col("id").alias("ord"))
    write_record_chunks(rows, out, "data", "ord", file_rows=100)
    want = sorted(((f"t{i % 3}", i) for i in range(1000)), key=lambda r: (r[0], r[1]))
    got = []
    for name, version in sorted(newest(spark, out).items()):
        files = sorted(f for f in os.listdir(version.path) if f.endswith(".parquet"))
        assert len(files) > 1
        for f in files:
            got += [(r["trait_name"], r["v"]) for r in pq.ParquetFile(os.path.join(version.path, f)).read().to_pylist()]
    assert got == want


def test_chunk_query_sorts_in_tasks_of_bounded_rows(spark, monkeypatch):
    """the records were sorted and stored in three tasks, however many there are."""
    from sylvan.plans import queries

    parts = []

    def save(df, *args):
        parts.append(df.rdd.getNumPartitions())
        return save_snapshot(df, *args)

    monkeypatch.setattr(queries, "FILE_ROWS", 150)
    monkeypatch.setattr(queries, "save_snapshot", save)
    folder = "/root/testdata/sf0.001"
    rows = queries.q_chunks_written_lossless(spark, folder).count()
    assert rows == spark.read.parquet(f"{folder}/events.parquet").count() > 450
    assert parts == [-(-rows // 150)]
