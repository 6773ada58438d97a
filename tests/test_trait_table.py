"""The flagship chain: golden mini-fixture, emulation property test, plan shape."""

import math
import random

import pytest
from pyspark.sql import types as T

from emulation import emulate_trait_table
from sylvan.plans import traits as tr
from sylvan.sources.catalog import EXCLUDED_DATA_IDS, INVERTED_DOMAINS, TRAIT_CATALOG

SCHEMA = T.StructType(
    [
        T.StructField("ord", T.LongType(), False),
        T.StructField("TraitID", T.IntegerType()),
        T.StructField("ObservationID", T.LongType()),
        T.StructField("DataID", T.IntegerType()),
        T.StructField("DataName", T.StringType()),
        T.StructField("Dataset", T.StringType()),
        T.StructField("AccSpeciesName", T.StringType()),
        T.StructField("OrigValueStr", T.StringType()),
        T.StructField("UnitName", T.StringType()),
    ]
)

# TraitID|ObservationID|DataID|DataName|Dataset|AccSpeciesName|OrigValueStr|UnitName
GOLDEN = """\
4|100|4|SSD|DS1|Abies alba|0.45|g/cm3
|100|59|Latitude|DS1|Abies alba|48.1|
|100|60|Longitude|DS1|Abies alba|16.2|
|100|59|Latitude|DS1|Abies alba|99|
26|100|30|Seed mass|DS1|Abies alba|3.5|mg
3116|101|6582|SLA|DS1|Abies alba|20|mm2 mg-1
|101|59|Latitude|DS1|Abies alba||
|101|59|Latitude|DS1|Abies alba|50|
|101|413|Maturity|DS1|Abies alba|adult|
3116|102|6582|SLA|DS1|Picea abies|0|mm2 mg-1
|102|60|Longitude|DS1|Picea abies|10|
14|103|15|Leaf N|DS1|Picea abies|12.5|mg/g
4|104|2221|Excluded|DS1|Picea abies|1|g/cm3
|104|59|Latitude|DS1|Picea abies|1|
999|105|9000|Other|DS2||7|m
|105|59|Latitude|DS2||5|
3106|106|18|Height|DS2|Quercus robur|n/a|m
|106|59|Latitude|DS2|Quercus robur|7|
4|107|4|SSD|DS2|Quercus robur||g/cm3
4|107|4|SSD|DS2|Quercus robur|0.9|g/cm3
|107|59|Latitude|DS2|Quercus robur|8|
|108|4|SSD|DS2|Quercus robur|0.7|g/cm3
|109|4|SSD|DS2|Quercus robur|0.6|g/cm3
3117|109|6584|SLA undef|DS2|Quercus robur|25|mm2 mg-1
|109|60|Longitude|DS2|Quercus robur|11|
"""


def golden_rows():
    rows = []
    for i, line in enumerate(GOLDEN.strip().splitlines(), start=1):
        f = [x if x != "" else None for x in line.split("|")]
        rows.append(
            (i, int(f[0]) if f[0] else None, int(f[1]), int(f[2]), f[3], f[4], f[5], f[6], f[7])
        )
    return rows


def test_golden_fixture(spark):
    df = spark.createDataFrame(golden_rows(), SCHEMA)
    out = tr.trait_table(df)
    assert out.columns == [
        "dataset", "acc_species_name", "trait_value", "trait_domain", "trait_full_name",
        "observation_id", "orig_value_str", "unit_name", "latitude", "longitude", "maturity",
    ]
    got = {(r.observation_id, r.orig_value_str): r for r in out.collect()}
    assert len(got) == 7
    r = got[(100, "0.45")]
    assert (r.trait_value, r.unit_name, r.latitude, r.longitude, r.maturity) == (0.45, "g/cm3", "48.1", "16.2", None)
    r = got[(100, "3.5")]
    assert (r.trait_value, r.unit_name, r.latitude, r.longitude) == (3.5, "mg", "48.1", "16.2")
    r = got[(101, "20")]
    assert (r.trait_value, r.unit_name, r.latitude, r.maturity) == (0.05, "mg/mm2", None, "adult")
    r = got[(102, "0")]
    assert r.trait_value == math.inf and r.unit_name == "mg/mm2" and r.longitude == "10"
    r = got[(105, "7")]
    assert r.trait_value is None and r.unit_name is None and r.trait_domain is None
    assert r.acc_species_name is None and r.latitude == "5"
    r = got[(106, "n/a")]
    assert r.trait_value is None and r.unit_name == "m" and r.latitude == "7"
    assert r.trait_domain == "Plant heigh" and r.trait_full_name.endswith("\t")
    r = got[(109, "0.6")]
    assert r.trait_value == 1 / 0.6 and r.unit_name == "mg/mm2" and r.longitude == "11"
    assert not {103, 104, 107, 108} & {k[0] for k in got}


def test_golden_map_form_equals_columns(spark):
    df = spark.createDataFrame(golden_rows(), SCHEMA)
    wide = {(r.observation_id, r.orig_value_str): r for r in tr.trait_table(df).collect()}
    mapped = {(r.observation_id, r.orig_value_str): r for r in tr.trait_table(df, as_="map").collect()}
    assert wide.keys() == mapped.keys()
    for k, r in mapped.items():
        cov = {n: v for n, v in (r.covariates or {}).items()}
        cols = {n: getattr(wide[k], n.lower()) for n in ("Latitude", "Longitude", "Maturity")}
        assert cov == {n: v for n, v in cols.items() if v is not None}


def _random_rows(seed, n=300):
    rng = random.Random(seed)
    rows = []
    for i in range(1, n + 1):
        trait = rng.choice([None, None, None, 4, 26, 3116, 77])
        # trait rows and covariate rows mostly use different item ids; item 1
        # and NULL occur on both, so the global keep set captures covariates
        items = [None, 1, 2, 2221] if trait is not None else [None, 1, 10, 11, 12, 3646]
        rows.append(
            (
                i,
                trait,
                rng.choice([None, 1, 2, 3, 4, 5, 6, 7, 8]),
                rng.choice(items),
                rng.choice([None, "a", "b", "Lat", "lat"]),
                rng.choice([None, "d1", "d2"]),
                rng.choice([None, "s1", "s2"]),
                rng.choice([None, "1", "2.5", "0", "n/a", "-3", "1e2", " 4 ", "inf", "1.0d", "7", "8"]),
                rng.choice([None, "u", "mm2 mg-1"]),
            )
        )
    return rows


def _canon(rec):
    v = rec["trait_value"]
    v = "nan" if isinstance(v, float) and math.isnan(v) else v
    cov = tuple(sorted((rec["covariates"] or {}).items()))
    return (rec["dataset"], rec["acc_species_name"], rec["observation_id"], rec["orig_value_str"],
            v, rec["trait_domain"], rec["unit_name"], cov)


def test_matches_literal_emulation(spark):
    catalog = {a: (b, c) for a, b, c in TRAIT_CATALOG}
    for seed in range(5):
        rows = _random_rows(seed)
        dicts = [dict(zip(SCHEMA.names, r)) for r in rows]
        expected = sorted(map(_canon, emulate_trait_table(dicts, EXCLUDED_DATA_IDS, catalog, INVERTED_DOMAINS)), key=repr)
        df = spark.createDataFrame(rows, SCHEMA)
        got = sorted((_canon(r.asDict()) for r in tr.trait_table(df, as_="map").collect()), key=repr)
        assert got == expected, f"seed {seed}"
        assert len(expected) > 0


def test_per_trait_loop_equals_set_plan(spark):
    df = spark.createDataFrame(_random_rows(11), SCHEMA)
    a = sorted(map(tuple, tr.trait_table(df).collect()), key=repr)
    from tools.naive_loop import trait_table_per_trait_loop

    b = sorted(map(tuple, trait_table_per_trait_loop(df).collect()), key=repr)
    assert a == b


def test_plan_shuffles_only_on_observation(spark, capsys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame(golden_rows(), SCHEMA)
        capsys.readouterr()
        tr.trait_table(df, names=["Latitude", "Longitude", "Maturity"]).explain()
        plan = capsys.readouterr().out
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # without broadcasts the rows meet the kept items on the item id, else all goes by the observation
    items = [line for line in exchanges if "hashpartitioning(coalesce(DataID" in line or "hashpartitioning(coalesce(_key" in line]
    rest = [line for line in exchanges if line not in items]
    assert len(items) == 2 and rest and all("hashpartitioning(ObservationID" in line for line in rest), exchanges
    assert "SinglePartition" not in plan


def test_rows_are_reduced_before_the_fan_out(spark, capsys):
    """Default settings: the kept items are broadcast (their written size is
    known), and each key is cut to one row before the shuffle."""
    df = spark.createDataFrame(golden_rows(), SCHEMA)
    capsys.readouterr()
    tr.trait_table(df, as_="map").explain()
    plan = capsys.readouterr().out
    limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert any("Partial" in line for line in limits) and any("Final" in line for line in limits)
    assert plan.index("Generate explode") < plan.index("WindowGroupLimit")  # plans print from the result down
    assert plan.count("Scan ExistingRDD[ord") == 1  # the export is scanned once besides the index


def test_hot_observation(spark, capsys):
    """One observation holds a third of the rows: with default settings its
    rows are cut to one per key before they are shuffled, and the result equals
    the plan that fans out first."""
    from pyspark.sql import functions as F

    n = 60000
    df = spark.range(n).select(
        F.col("id").alias("ord"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000 + 1).alias("ObservationID"),
        F.when(F.col("id") % 7 == 0, F.lit(4)).when(F.col("id") % 11 == 0, F.lit(3116)).cast("int").alias("TraitID"),
        F.when(F.col("id") % 7 == 0, F.lit(1)).when(F.col("id") % 11 == 0, F.lit(2))
        .otherwise((F.col("id") % 5 + 10)).cast("int").alias("DataID"),
        F.concat(F.lit("n"), (F.col("id") % 13).cast("string")).alias("DataName"),
        F.concat(F.lit("d"), (F.col("id") % 2).cast("string")).alias("Dataset"),
        F.lit("sp").alias("AccSpeciesName"),
        (F.col("id") % 100).cast("string").alias("OrigValueStr"),
        F.lit("u").alias("UnitName"),
    )
    out = tr.trait_table(df, as_="map")
    rows = out.collect()
    capsys.readouterr()
    out.explain()
    plan = capsys.readouterr().out
    exploded = tr.explode_observations_by_trait(df, skew_safe=False)
    keep = tr.kept_items(tr.select_data_items(tr.data_item_overview(df)))
    plain = tr.standardise_traits(
        tr.combine_values_covariates(
            tr.extract_trait_values(exploded, keep), tr.extract_covariates(exploded, keep), as_="map"
        )
    ).collect()
    assert "WindowGroupLimit" in plan
    canon = lambda r: (r.observation_id, r.dataset, r.orig_value_str, r.trait_domain, tuple(sorted(r.covariates.items())))
    assert sorted(map(canon, rows)) == sorted(map(canon, plain))
    assert len(rows) > 0


def test_keep_scope_per_trait(spark):
    """Golden fixture: item 4 is kept for trait 4 only, so the covariate row
    23 (item 4) is no value for trait 3117 any more: trait 3117 on
    observation 109 takes its own row (25 -> 1/25) and row 23 becomes a
    covariate named SSD."""
    df = spark.createDataFrame(golden_rows(), SCHEMA)
    got = {(r.observation_id, r.orig_value_str): r for r in tr.trait_table(df, as_="map", keep_scope="per_trait").collect()}
    r = got[(109, "25")]
    assert r.trait_value == 1 / 25 and r.covariates == {"Longitude": "11", "SSD": "0.6"}
    assert (100, "0.45") in got and (109, "0.6") not in got


def test_colliding_covariate_names(spark):
    """Covariates named like fixed columns, or differing only in case, get
    ``_2`` suffixes after cleaning, as in the original (N15)."""
    rows = golden_rows()
    extra = [
        (26, None, 100, 70, "Dataset", "DS1", "Abies alba", "site A", None),
        (27, None, 100, 71, "name", "DS1", "Abies alba", "n1", None),
        (28, None, 100, 72, "LATITUDE", "DS1", "Abies alba", "48", None),
    ]
    df = spark.createDataFrame(rows + extra, SCHEMA)
    out = tr.trait_table(df)
    assert out.columns == [
        "dataset", "acc_species_name", "trait_value", "trait_domain", "trait_full_name",
        "observation_id", "orig_value_str", "unit_name",
        "latitude", "longitude", "dataset_2", "name_2", "latitude_2", "maturity",
    ]
    r = {(x.observation_id, x.orig_value_str): x for x in out.collect()}[(100, "0.45")]
    assert (r.dataset, r.dataset_2, r.name_2, r.latitude, r.latitude_2) == ("DS1", "site A", "n1", "48.1", "48")


def test_empty_export(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert tr.trait_table(df, as_="map").count() == 0
    assert tr.trait_table(df).columns[:8] == [
        "dataset", "acc_species_name", "trait_value", "trait_domain", "trait_full_name",
        "observation_id", "orig_value_str", "unit_name",
    ]


def test_left_join_keeps_values_without_covariates(spark):
    df = spark.createDataFrame(golden_rows(), SCHEMA)
    got = {(r.observation_id, r.orig_value_str): r for r in tr.trait_table(df, how="left").collect()}
    assert len(got) == 8
    r = got[(103, "12.5")]
    assert r.trait_domain == "Leaf nitrogen content per unit mass" and r.latitude is None and r.maturity is None


def test_per_trait_scope_matches_emulation(spark):
    catalog = {a: (b, c) for a, b, c in TRAIT_CATALOG}
    for seed in (21, 22):
        rows = _random_rows(seed)
        dicts = [dict(zip(SCHEMA.names, r)) for r in rows]
        expected = emulate_trait_table(dicts, EXCLUDED_DATA_IDS, catalog, INVERTED_DOMAINS, scope="per_trait")
        df = spark.createDataFrame(rows, SCHEMA)
        got = tr.trait_table(df, as_="map", keep_scope="per_trait").collect()
        assert sorted((_canon(r.asDict()) for r in got), key=repr) == sorted(map(_canon, expected), key=repr)
        assert expected


def test_custom_catalog(spark):
    df = spark.createDataFrame(golden_rows(), SCHEMA)
    catalog = spark.createDataFrame(
        [("4", "Wood density", "SSD"), ("999", "Other domain", "Other trait")], "id string, domain string, label string"
    )
    out = tr.trait_table(df, catalog=catalog, as_="map")
    assert out.columns[:6] == ["dataset", "acc_species_name", "trait_value", "domain", "label", "observation_id"]
    got = {(r.observation_id, r.orig_value_str): r for r in out.collect()}
    assert got[(105, "7")].trait_value == 7.0 and got[(105, "7")].domain == "Other domain"
    assert got[(101, "20")].domain is None and got[(101, "20")].trait_value is None  # now unmapped


def test_no_inversion_when_invert_is_empty(spark):
    df = spark.createDataFrame(golden_rows(), SCHEMA)
    got = {(r.observation_id, r.orig_value_str): r for r in tr.trait_table(df, as_="map", invert={}).collect()}
    assert got[(101, "20")].trait_value == 20.0 and got[(101, "20")].unit_name == "mm2 mg-1"


@pytest.mark.parametrize("scope", ["global", "per_trait"])
def test_columns_beyond_the_width_stay_in_a_map(spark, scope):
    """Every covariate is in a column or in the map, as in the full table."""
    df = spark.createDataFrame(golden_rows(), SCHEMA)
    whole, narrow = (tr.trait_table(df, as_="columns", keep_scope=scope, max_columns=n) for n in (2000, 1))
    assert "other_covariates" not in whole.columns and narrow.columns == [*whole.columns[:9], "other_covariates"]
    fixed = whole.columns[:8]
    names = whole.columns[8:]

    def entries(row):
        from sylvan.functions.names import clean_name_list

        found = row.asDict()
        rest = found.pop("other_covariates", None) or {}
        found |= dict(zip(clean_name_list(list(rest)), rest.values()))
        return tuple(str(found[c]) for c in fixed), {n: found.get(n) for n in names}

    assert sorted(map(entries, whole.collect()), key=repr) == sorted(map(entries, narrow.collect()), key=repr)
