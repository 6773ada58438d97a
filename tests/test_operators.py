import math
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from sylvan.operators import ordering, summaries
from sylvan.operators.columns import relocate, select_any_of
from sylvan.operators.dedup import keep_first
from sylvan.operators.filters import all_true, any_true, discard_empty, is_empty_source
from sylvan.operators.joins import missing_items, null_safe_join
from sylvan.operators.keysets import KeySet
from sylvan.operators.ordering import assign_chunks, chunk_bounds, with_global_position
from sylvan.operators.reshape import PIECE, nest_by, pivot_wider, union_by_name, unnest
from sylvan.operators.summaries import describe_strings, exact_quantiles, null_profile


def r_chunk_positions(total, n=4):
    """Literal emulation of ``as.integer((k*cs+1):((k+1)*cs))`` with R's ``:``."""
    cs = total / n
    out = []
    for k in range(n):
        a, b = k * cs + 1, (k + 1) * cs
        if a <= b:
            count = math.floor(b - a + 1e-10) + 1
            seq = [a + j for j in range(count)]
        else:
            count = math.floor(a - b + 1e-10) + 1
            seq = [a - j for j in range(count)]
        out.append([int(x) for x in seq])
    return out


@pytest.mark.parametrize("total", list(range(0, 21)) + [4003])
def test_chunk_bounds_match_r(total):
    expected = r_chunk_positions(total)
    got = [list(range(s, e + 1)) for s, e in chunk_bounds(total, 4)]
    if total == 0:  # R's 1:0 slices nothing from an empty table
        assert got == [[], [], [], []]
    else:
        assert got == expected


@pytest.mark.parametrize("total", [0, 1, 3, 4, 10, 11, 37])
def test_assign_chunks(spark, total):
    df = spark.range(total).select((F.col("id") * 7 % 101).alias("k"))
    order = sorted(r.k for r in df.collect())
    lossless = assign_chunks(df, ["k"], 4, "lossless").collect()
    assert sorted(r.pos for r in lossless) == list(range(1, total + 1))
    by_pos = {r.pos: r for r in lossless}
    assert [by_pos[p].k for p in range(1, total + 1)] == order
    sizes = [sum(1 for r in lossless if r.chunk == c) for c in range(4)]
    assert sum(sizes) == total and (max(sizes) - min(sizes) <= 1)
    assert [by_pos[p].chunk for p in range(1, total + 1)] == sorted(by_pos[p].chunk for p in range(1, total + 1))
    trunc = assign_chunks(df, ["k"], 4, "truncating").collect()
    got = sorted((r.chunk, r.pos) for r in trunc)
    want = sorted((c, p) for c, ps in enumerate(r_chunk_positions(total)) for p in ps) if total else []
    assert got == want


def test_global_position_has_no_single_partition(spark, capsys):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"))
    positioned, total = with_global_position(df, ["k"])
    assert total == 1000
    assert sorted((r.k, r.pos) for r in positioned.collect()) == [(k, k + 1) for k in range(1000)]
    positioned.explain()
    assert "SinglePartition" not in capsys.readouterr().out


def test_exact_quantiles_type7(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", 10.0), ("b", 5.0)], "g string, v double")
    got = {(r.g, r.prob): r.quantile for r in exact_quantiles(df, "g", "v").collect()}
    assert got[("a", 0.25)] == 1.75 and got[("a", 0.5)] == 2.5 and got[("a", 0.75)] == 4.75
    assert got[("b", 0.5)] == 5.0


def test_keep_first_uses_order(spark):
    df = spark.createDataFrame([(1, "k", None), (2, "k", "x"), (3, None, "y"), (4, None, "z")], "o int, k string, v string")
    got = sorted((r.o, r.v) for r in keep_first(df, ["k"], ["o"]).collect())
    assert got == [(1, None), (3, "y")]


def test_null_safe_join_and_semi(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, x int")
    right = spark.createDataFrame([(None, 10), ("a", 20), ("b", 30)], "k string, y int")
    inner = null_safe_join(left, right, ["k"]).collect()
    assert sorted(map(tuple, inner), key=repr) == sorted([(None, 1, 10), ("a", 2, 20)], key=repr)
    full = null_safe_join(left, right, ["k"], "full").collect()
    assert sorted(map(tuple, full), key=repr) == sorted([(None, 1, 10), ("a", 2, 20), ("b", None, 30)], key=repr)


def test_keyset_constant_and_data(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    keys = spark.createDataFrame([(1,), (None,), (1,)], "x int")
    for ks in (KeySet.literal([1, None]), KeySet.of(keys, "x")):
        assert sorted(map(repr, (r.x for r in ks.keep(df, "x").collect()))) == ["1", "None"]
        assert [r.x for r in ks.drop(df, "x").collect()] == [2]
    marked = KeySet.of(keys, "x").mark(df, "x", "in")
    assert sorted(map(repr, map(tuple, marked.collect()))) == sorted(map(repr, [(1, True), (2, False), (None, True)]))


def test_missing_items(spark):
    requested = spark.createDataFrame([(w,) for w in ["leaf area", "seed mass", "ab", "z", "", "whole plant height"]], "item string")
    present = spark.createDataFrame([("leaf area per leaf dry mass_2023",), ("seed mass",), ("cab",)], "name string")
    exact = sorted(r.item for r in missing_items(requested, present, match="exact").collect())
    assert exact == ["", "ab", "leaf area", "whole plant height", "z"]
    contains = sorted(r.item for r in missing_items(requested, present, match="contains").collect())
    assert contains == ["whole plant height", "z"]
    nothing = present.where("false")
    assert missing_items(requested, nothing, match="contains").count() == 6


def test_pivot_first_appearance_order(spark):
    df = spark.createDataFrame(
        [(1, "o", "b", "1"), (2, "o", "a", "2"), (3, "p", "c", "3"), (4, "p", "b", "4")], "ord int, key string, n string, v string"
    )
    wide = pivot_wider(df, ["key"], "n", "v", order=["ord"])
    assert wide.columns == ["key", "b", "a", "c"]
    assert sorted(map(tuple, wide.collect()), key=repr) == [("o", "1", "2", None), ("p", "4", None, "3")]


def test_nest_unnest_roundtrip(spark):
    df = spark.createDataFrame([(1, "x", 3), (1, "y", 1), (2, "z", 2)], "g int, s string, o int")
    nested = nest_by(df, ["g"], ["s", "o"], "items", order="o")
    assert {r.g: [i.s for i in r["items"]] for r in nested.collect()} == {1: ["y", "x"], 2: ["z"]}
    assert sorted(map(tuple, unnest(nested, "items").collect())) == [(1, "x", 3), (1, "y", 1), (2, "z", 2)]


def test_union_by_name_checks_types(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([(2.5, "extra")], "id double, other string")
    out = union_by_name([a, b])
    assert out.columns == ["id", "name", "other"]
    bad = spark.createDataFrame([("3",)], "id string")
    with pytest.raises(TypeError, match="id"):
        union_by_name([a, bad])


def test_discard_empty_sources(spark):
    full = spark.createDataFrame([(1, "a")], "x int, y string")
    nulls = spark.createDataFrame([(None, None)], "x int, y string")
    empty = spark.createDataFrame([], "x int, y string")
    nan = spark.createDataFrame([(float("nan"),)], "x double")
    assert [is_empty_source(f) for f in (full, nulls, empty, nan)] == [False, True, True, True]
    assert len(discard_empty([full, nulls, empty])) == 1


def test_any_all_on_empty(spark):
    empty = spark.createDataFrame([], "b boolean")
    row = empty.agg(any_true("b").alias("a"), all_true("b").alias("l")).first()
    assert (row.a, row.l) == (False, True)


def test_select_any_of_and_relocate(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int")
    assert select_any_of(df, ["d", "zz", "a"]).columns == ["d", "a"]
    assert relocate(df, ["d", "c"], before="b").columns == ["a", "d", "c", "b"]
    assert relocate(df, ["a"], after="d").columns == ["b", "c", "d", "a"]


def test_null_profile_counts_nan(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), "x"), (None, "y"), (2.0, "z")], "v double, s string")
    assert {r.column: r.pct for r in null_profile(df).collect()} == {"v": 50.0, "s": 25.0}


def test_describe_strings_top_and_other(spark):
    values = ["a"] * 5 + ["b"] * 4 + ["c"] * 3 + list("defgh") + [None]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    rows = {r.value: (r.n, r.rank) for r in describe_strings(df).collect()}
    # 8 levels and NAs: 5 most frequent, (Other), NA's
    assert rows == {"a": (5, 1), "b": (4, 2), "c": (3, 3), "d": (1, 4), "e": (1, 5), "(Other)": (3, 6), "NA's": (1, 7)}
    small = spark.createDataFrame([(v,) for v in ["b", "a", "b"]], "s string")
    assert {r.value: (r.n, r.rank) for r in describe_strings(small).collect()} == {"a": (1, 1), "b": (2, 2)}


def test_text_export_scan(spark):
    from sylvan.plans.traits import trait_table
    from sylvan.sources.export import land_export, read_landed, read_trait_export
    from test_trait_table import GOLDEN

    header = "LastName\tDataset\tAccSpeciesName\tObservationID\tTraitID\tDataID\tDataName\tOrigValueStr\tUnitName\tComment"
    lines = [header]
    for line in GOLDEN.strip().splitlines():
        t, o, d, n, ds, sp, v, u = line.split("|")
        lines.append("\t".join(["Doe", ds, sp, o, t, d, n, v, u, 'say "hi"']))
    folder = tempfile.mkdtemp(prefix="sylvan-test-")
    path = os.path.join(folder, "export.txt")
    with open(path, "w", encoding="latin-1") as fh:
        fh.write("\n".join(lines) + "\n")
    raw = read_trait_export(spark, path)
    assert dict(raw.dtypes)["TraitID"] == "int" and dict(raw.dtypes)["ObservationID"] == "bigint"
    land_export(raw, os.path.join(folder, "landed"))
    landed = read_landed(spark, os.path.join(folder, "landed"))
    assert [r.Comment for r in landed.orderBy("ord").limit(1).collect()] == ['say "hi"']
    out = trait_table(landed)
    assert out.count() == 7


def test_describe_numeric_against_percentile(spark):
    from sylvan.operators.summaries import describe_numeric

    lineitem = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    exact = {r.column: r for r in describe_numeric(lineitem).collect()}
    names = list(exact)
    row = lineitem.agg(*[F.percentile(c, [0.25, 0.5, 0.75]) for c in names]).first()
    assert [[exact[c].q1, exact[c].median, exact[c].q3] for c in names] == [list(q) for q in row]
    approx = {r.column: r for r in describe_numeric(lineitem, method="approx").collect()}
    assert approx.keys() == exact.keys()
    assert all(exact[c].q1 <= approx[c].median <= exact[c].q3 for c in names)


def test_exact_quantiles_with_hot_value(spark):
    rows = [("g", 7.0)] * 300 + [("g", float(i)) for i in range(600)] + [("h", float(i % 13)) for i in range(101)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r.g, r.prob): r.quantile for r in exact_quantiles(df, "g", "v").collect()}
    want = df.groupBy("g").agg(F.percentile("v", [0.25, 0.5, 0.75]).alias("q")).collect()
    for r in want:
        assert [got[(r.g, p)] for p in (0.25, 0.5, 0.75)] == list(r.q)


def test_nest_in_bounded_pieces(spark):
    rows = [(1, f"x{i:03d}", i) for i in range(25)] + [(2, "y", 0)]
    df = spark.createDataFrame(rows, "g int, s string, o int")
    nested = nest_by(df, ["g"], ["s", "o"], "items", order="o", max_items=4).collect()
    assert max(len(r["items"]) for r in nested) <= 4
    pieces = sorted((r.g, r[PIECE], [i.o for i in r["items"]]) for r in nested)
    assert [len(os) for g, _, os in pieces] == [4, 4, 4, 4, 4, 4, 1, 1]
    assert [o for g, _, os in pieces if g == 1 for o in os] == list(range(25))
    back = unnest(spark.createDataFrame(nested), "items")
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_convert_columns_and_quality_report(spark):
    from pyspark.sql import types as T

    from sylvan.operators.columns import convert_columns
    from sylvan.plans.records import quality_report

    df = spark.createDataFrame([("a", 1.0, "x"), ("b", None, None), ("a", 3.0, "y")], "s string, v double, t string")
    upper = convert_columns(df, T.StringType, F.upper)
    assert upper.columns == df.columns and [r.s for r in upper.collect()] == ["A", "B", "A"]
    report = quality_report(df)
    numeric = report["numeric"].collect()[0]
    assert (numeric.column, numeric.min, numeric.median, numeric.max, numeric.n_na) == ("v", 1.0, 2.0, 3.0, 1)
    assert {(r.column, r.value): r.n for r in report["strings"].collect()}[("t", "NA's")] == 1
    assert {r.column: r.pct for r in report["missing"].collect()} == {"s": 0.0, "v": 1 / 3 * 100, "t": 1 / 3 * 100}


def test_export_ordinal_follows_file_order_across_splits(spark):
    from sylvan.sources.export import read_trait_export

    folder = tempfile.mkdtemp(prefix="sylvan-splits-")
    header = "ObservationID\tTraitID\tDataID\tOrigValueStr"
    for name, start in (("a.txt", 0), ("b.txt", 5000)):
        with open(os.path.join(folder, name), "w") as fh:
            fh.write(header + "\n" + "\n".join(f"{i}\t\t1\tv{i}" for i in range(start, start + 5000)) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df = read_trait_export(spark, folder)
        assert df.rdd.getNumPartitions() > 4
        got = [r.ObservationID for r in df.orderBy("ord").select("ObservationID").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == list(range(10000))


def test_summary_of_summaries_exact_and_approx(spark):
    from sylvan.operators.summaries import summary_of_summaries

    rows = [("d", f"s{i}", 60 + i, float(i), 1.0, 0.0, 2.0 * i) for i in range(9)] + [("e", "x", 10, 1.0, None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "trait_domain string, acc_species_name string, n long, mean double, sd double, min double, max double")
    exact = {(r.trait_domain, r.column): r for r in summary_of_summaries(df).collect()}
    approx = {(r.trait_domain, r.column): r for r in summary_of_summaries(df, approx=True).collect()}
    assert exact.keys() == approx.keys() and {k[0] for k in exact} == {"d"}
    m = exact[("d", "mean")]
    assert (m.min, m.q1, m.median, m.q3, m.max, m.n_na, m.length) == (0.0, 2.0, 4.0, 6.0, 8.0, 0, 9)
    assert exact[("d", "acc_species_name")].length == 9
    assert approx[("d", "mean")].median == 4.0


def test_missing_contains_matches_brute_force(spark):
    import random

    rng = random.Random(7)
    word = lambda lo, hi: "".join(rng.choice("abc ") for _ in range(rng.randint(lo, hi)))
    items = sorted({word(0, 5) for _ in range(80)})
    names = [word(3, 12) for _ in range(60)]
    expected = sorted(i for i in items if not any(i in n for n in names))
    requested = spark.createDataFrame([(i,) for i in items], "item string")
    present = spark.createDataFrame([(n,) for n in names], "name string")
    assert sorted(r.item for r in missing_items(requested, present, match="contains").collect()) == expected


def _r_factor_summary(values, maxsum=7):
    """Literal emulation of R's summary() of a factor as called by
    summary.data.frame: levels sorted; if there are more than fit, the most
    frequent ones (stable on level order), then (Other), then NA's."""
    nas = sum(v is None for v in values)
    levels = sorted({v for v in values if v is not None})
    counts = [(lvl, sum(v == lvl for v in values)) for lvl in levels]
    limit = maxsum - 1 if nas else maxsum
    if len(levels) > limit:
        ordered = sorted(range(len(counts)), key=lambda i: -counts[i][1])  # stable
        keep = ordered[: limit - 1]
        shown = [counts[i] for i in keep] + [("(Other)", sum(counts[i][1] for i in ordered[limit - 1:]))]
    else:
        shown = counts
    if nas:
        shown.append(("NA's", nas))
    return [(name, n, rank) for rank, (name, n) in enumerate(shown, start=1)]


def test_describe_strings_matches_r_emulation(spark):
    import random

    rng = random.Random(3)
    columns = {}
    for c, n_levels in enumerate([1, 5, 6, 7, 8, 12]):
        pool = [f"l{j:02d}" for j in range(n_levels)]
        columns[f"c{c}"] = [rng.choice(pool + [None] * (c % 2)) for _ in range(60)]
    names = sorted(columns)
    rows = list(zip(*[columns[n] for n in names]))
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    got = {}
    for r in describe_strings(df).collect():
        got.setdefault(r.column, []).append((r.value, r.n, r.rank))
    for n in names:
        assert sorted(got[n], key=lambda x: x[2]) == _r_factor_summary(columns[n]), n


def test_describe_numeric_matches_numpy_type7(spark):
    import random

    import numpy as np

    from sylvan.operators.summaries import describe_numeric

    rng = random.Random(5)
    a = [rng.choice([None, float("nan")]) if rng.random() < 0.1 else rng.uniform(-50, 50) for _ in range(257)]
    b = [rng.choice([None, 1.0, 2.0, 2.0, 3.0]) for _ in range(257)]
    df = spark.createDataFrame(list(zip(a, b)), "a double, b double")
    got = {r.column: r for r in describe_numeric(df).collect()}
    for name, col in (("a", a), ("b", b)):
        vals = np.array([v for v in col if v is not None and not math.isnan(v)])
        q = np.percentile(vals, [25, 50, 75], method="linear")
        r = got[name]
        assert np.allclose([r.q1, r.median, r.q3], q, rtol=1e-12, atol=1e-12)
        assert (r.min, r.max, r.n_na) == (vals.min(), vals.max(), len(col) - len(vals))
        assert math.isclose(r.mean, vals.mean(), rel_tol=1e-12)


def test_describe_dates_logical_and_no_rows(spark):
    import datetime as dt

    from sylvan.operators.summaries import describe_dates, describe_logical, describe_numeric

    rows = [(dt.date(2024, 1, d), True if d % 2 else None) for d in (1, 2, 3, 5)] + [(None, False)]
    df = spark.createDataFrame(rows, "d date, b boolean")
    r = describe_dates(df).first()
    assert (r.column, r.min, r.median, r.max, r.n_na) == ("d", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 12), dt.datetime(2024, 1, 5), 1)
    assert {x.value: x.n for x in describe_logical(df).collect()} == {"TRUE": 3, "FALSE": 1, "NA's": 1}
    empty = describe_numeric(spark.createDataFrame([], "a int, b double")).collect()
    assert sorted((x.column, x.min, x.n_na) for x in empty) == [("a", None, 0), ("b", None, 0)]


def test_drop_incomplete_of_no_columns_and_odd_order_names(spark):
    from sylvan.operators.filters import drop_incomplete

    df = spark.createDataFrame([(None, 1), (2, None), (2, 0)], ["k", "a.b"])
    assert drop_incomplete(df, []).count() == 3 and drop_incomplete(df).count() == 1
    assert sorted(map(str, map(tuple, keep_first(df, ["k"], ["a.b"]).collect()))) == ["(2, None)", "(None, 1)"]


def test_group_summary_missing_rules(spark):
    from sylvan.operators.summaries import group_summary

    rows = [("g", 1.0), ("g", float("nan")), ("g", None), ("g", 3.0), ("h", None), ("h", float("nan")), ("k", 5.0)]
    got = {r.k: r for r in group_summary(spark.createDataFrame(rows, "k string, v double"), ["k"], "v").collect()}
    assert (got["g"].n, got["g"].mean, got["g"].min, got["g"].max) == (4, 2.0, 1.0, 3.0)
    assert math.isclose(got["g"].sd, math.sqrt(2.0))
    assert (got["h"].n, got["h"].mean, got["h"].sd, got["h"].min) == (2, None, None, None)
    assert (got["k"].n, got["k"].sd) == (1, None)  # sd of one value is NA in R


def test_first_group(spark):
    from sylvan.operators.ordering import first_group

    df = spark.createDataFrame([(3116, "a"), (4, "b"), (4, "c"), (None, "d")], "t int, v string")
    assert sorted(r.v for r in first_group(df, "t").collect()) == ["b", "c"]
    assert first_group(spark.createDataFrame([], "t int"), "t").count() == 0


def test_export_scan_decodes_latin1(spark):
    from sylvan.sources.export import read_trait_export

    folder = tempfile.mkdtemp(prefix="sylvan-latin1-")
    text = "ObservationID\tAccSpeciesName\tOrigValueStr\n1\tGröße Pflanze\t5\n2\tNA\t6\n"
    with open(os.path.join(folder, "e.txt"), "wb") as fh:
        fh.write(text.encode("latin-1"))
    rows = read_trait_export(spark, folder).orderBy("ord").collect()
    assert [r.AccSpeciesName for r in rows] == ["Größe Pflanze", None]


@pytest.mark.parametrize("partitions", [1, 3, 50])
def test_run_position(spark, partitions):
    """Positions inside each key, also of a key that spans partitions."""
    import random

    rnd = random.Random(partitions)
    rows = [(rnd.choice([None, 1, 1, 1, 1, 2, 3]), rnd.choice(["a", "b", None]), i) for i in range(600)]
    df = spark.createDataFrame(rows, "k long, s string, i long")
    got = {r["i"]: r["pos"] for r in ordering.with_run_position(df, ["k", "s"], ["i"], num_partitions=partitions).collect()}
    seen = {}
    for k, s, i in rows:
        assert got[i] == seen.get((k, s), 0)
        seen[k, s] = got[i] + 1
    assert ordering.with_run_position(df.where("false"), ["k"], ["i"], num_partitions=partitions).count() == 0


def test_rank_selection(spark, monkeypatch):
    """Values that differ in their last bits only, over all magnitudes, in
    groups of one row, of equal rows and of a third of all; counts of prefixes
    are all that is shuffled."""
    import random

    import numpy as np

    rnd = random.Random(2)
    rows = [("near", 1.0 + i * 2.0**-52) for i in range(300)] + [("wide", rnd.choice([-1, 1]) * 10.0 ** rnd.uniform(-300, 300)) for _ in range(400)]
    rows += [("one", 3.5), (None, 1.0), (None, 2.0), ("none", None)] + [("same", 7.25)] * 600 + [("ends", math.inf), ("ends", -math.inf), ("ends", 0.0)]
    rnd.shuffle(rows)
    plans = []
    write = summaries.write_intermediate

    def watched(df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, *args)

    monkeypatch.setattr(summaries, "write_intermediate", watched)
    probs = (0.0, 0.25, 0.5, 0.9, 1.0)
    found = exact_quantiles(spark.createDataFrame(rows, "g string, v double"), "g", "v", probs)
    got = {(r["g"], r["prob"]): r["quantile"] for r in found.collect()}
    for group in ("near", "wide", "one", "same", None):
        values = np.array([v for g, v in rows if g == group])
        for p in probs:
            assert got[group, p] == pytest.approx(np.quantile(values, p), rel=1e-15), (group, p)
    assert (got["ends", 0.0], got["ends", 0.5], got["ends", 1.0]) == (-math.inf, 0.0, math.inf)
    assert not any(g == "none" for g, _ in got)
    assert len(plans) >= 2 and not any("rangepartitioning" in p for p in [*plans, found._jdf.queryExecution().executedPlan().toString()])


def test_rank_selection_in_many_passes(spark, monkeypatch):
    """Coarse steps cost passes, not exactness."""
    import numpy as np

    rnd = np.random.default_rng(4)
    values = np.concatenate([rnd.normal(size=300), np.exp(rnd.normal(size=200) * 100), np.repeat(0.5, 200)])
    rows = [(int(i % 3 > 0), float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "g int, v double")
    monkeypatch.setattr(summaries, "STEPS", 40)
    monkeypatch.setattr(summaries, "PER_OCTAVE", 0.05)
    got = {(r["g"], r["prob"]): r["quantile"] for r in exact_quantiles(df, "g", "v").collect()}
    assert len(got) == 6
    for (g, p), q in got.items():
        assert q == pytest.approx(np.quantile([v for h, v in rows if h == g], p), rel=1e-15)


def test_column_names(spark):
    from sylvan.operators.columns import column_names

    df = spark.range(3).selectExpr("id as b", "id as a", "cast(id as string) as `odd name`")
    assert list(column_names(df)) == ["b", "a", "odd name"]


@pytest.mark.parametrize("mode", ["lossless", "truncating"])
@pytest.mark.parametrize("total", [0, 1, 3, 10, 37, 1003])
def test_cut_chunks_match_positions(spark, monkeypatch, capsys, total, mode):
    """Chunks from block counts against positions by the whole order: groups of
    unlike size, a NULL group, blocks of four rows, ordinals of both forms."""
    import random

    from sylvan.operators import ordering
    from sylvan.session import Scratch

    monkeypatch.setattr(ordering, "BLOCK_BITS", 2)
    rnd = random.Random(total)
    rows = [(rnd.choice(["a", "a", "a", "b", None, f"r{i % 7}"]), i) for i in range(total)]
    rnd.shuffle(rows)
    first = {}
    for key, i in sorted(rows, key=lambda r: r[1]):
        first.setdefault(key, i)
    ordered = sorted(rows, key=lambda r: (first[r[0]], r[1]))
    if mode == "lossless":
        q, r = divmod(total, 4)
        want = sorted((i, c) for c in range(4) for _, i in ordered[c * q + min(c, r) : (c + 1) * q + min(c + 1, r)])
    else:
        want = sorted((ordered[p - 1][1], c) for c, (s, e) in enumerate(chunk_bounds(total, 4)) for p in range(s, e + 1))
    plain = spark.createDataFrame(rows, "k string, o int")
    nested = plain.withColumn("o", F.struct((F.col("o") / 100).cast("int").alias("f"), (F.col("o") % 100).cast("long").alias("r")))
    for df, back in ((plain, F.col("o")), (nested, F.col("o.f") * 100 + F.col("o.r"))):
        with Scratch(spark, "cuts") as scratch:
            cut, n = ordering.cut_chunks(df, "k", "o", 4, mode, "c", "first", scratch)
            cut.explain()
            assert n == total and sorted((r[0], r[1]) for r in cut.select(back, "c").collect()) == want
    plan = capsys.readouterr().out
    assert "rangepartitioning" not in plan and "SinglePartition" not in plan


def test_nest_moves_rows_by_one_range_and_one_key_exchange(spark, capsys):
    """No join: a hot key, a NULL key and small ones, pieces in order, numbered
    from 0 in each group."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 2 > 0, F.concat(F.lit("k"), F.col("id") % 50)).alias("g"), F.col("id").alias("o"))
    nested = nest_by(df, ["g"], ["o"], "items", order="o", max_items=128)
    nested.explain()
    plan = capsys.readouterr().out
    assert "Join" not in plan and plan.count("Exchange") == 1
    groups = {}
    for r in sorted(nested.collect(), key=lambda r: r[PIECE]):
        groups.setdefault(r.g, []).append([i.o for i in r["items"]])
    want = {}
    for r in df.collect():
        want.setdefault(r.g, []).append(r.o)
    assert groups == {g: [sorted(v)[i : i + 128] for i in range(0, len(v), 128)] for g, v in want.items()}


def test_pivot_width_is_bounded(spark, monkeypatch):
    """100,000 names: the driver sees ``max_columns + 1`` of them, and no value
    is lost."""
    from sylvan.operators import reshape

    rows = spark.range(100_000).select(
        (F.col("id") % 50).alias("key"), F.concat(F.lit("n"), F.col("id")).alias("name"), F.col("id").cast("string").alias("v"), "id"
    )
    seen = []
    look = reshape.pivot_names
    monkeypatch.setattr(reshape, "pivot_names", lambda *a: seen.append(look(*a)) or seen[-1])
    wide = reshape.pivot_wider(rows, ["key"], "name", "v", order=["id"], max_columns=30)
    assert seen == [[f"n{i}" for i in range(31)]]
    assert wide.columns == ["key", *[f"n{i}" for i in range(30)], "others"]
    got = {r["key"]: r.asDict() for r in wide.collect()}
    for key, row in got.items():
        assert {n: v for n, v in row.items() if n.startswith("n") and v is not None} == ({f"n{key}": str(key)} if key < 30 else {})
        assert row["others"] == {f"n{i}": str(i) for i in range(100_000) if i % 50 == key and i >= 30}


def test_pivot_with_room_for_all_names_has_no_map(spark):
    from sylvan.operators.reshape import pivot_wider

    rows = spark.createDataFrame([(1, "a", "x", 1), (1, "b", None, 2), (2, None, "z", 3)], "key int, n string, v string, ord int")
    rows = rows.fillna({"n": "NA"})
    assert pivot_wider(rows, ["key"], "n", "v", order=["ord"], max_columns=3).columns == ["key", "a", "b", "NA"]
    two = pivot_wider(rows, ["key"], "n", "v", order=["ord"], max_columns=2)
    assert sorted(map(tuple, two.collect())) == [(1, "x", None, {}), (2, None, None, {"NA": "z"})]
    assert pivot_wider(rows, ["key"], "n", "v", order=["ord"], max_columns=0).columns == ["key", "others"]
    assert pivot_wider(rows.limit(0), ["key"], "n", "v", order=["ord"], max_columns=2).columns == ["key"]
