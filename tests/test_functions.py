import math

from pyspark.sql import functions as F

from sylvan.functions import (
    clean_name,
    clean_name_list,
    if_else_na,
    in_values,
    not_in_values,
    reciprocal,
    to_number_or_null,
)
from sylvan.functions.names import entry_version, logical_name


def test_clean_name_cases():
    assert clean_name("AccSpeciesName") == "acc_species_name"
    assert clean_name("ObservationID") == "observation_id"
    assert clean_name("OrigValueStr") == "orig_value_str"
    assert clean_name("Light Level") == "light_level"
    assert clean_name("NA") == "na"
    assert clean_name("HTTPServer") == "http_server"
    assert clean_name("Order#Date") == "order_number_date"
    assert clean_name("priority%") == "priority_percent"
    assert clean_name("1st value") == "x1st_value"
    assert clean_name("Größe (cm)") == "grosse_cm"
    assert [clean_name(n) for n in ("µmol", "Ørsted", "Straße", "δ13C", "Łódź")] == ["umol", "orsted", "strasse", "delta13_c", "lodz"]
    assert clean_name("  --weird--  ") == "weird"
    assert clean_name("") == "x"


def test_clean_name_list_suffixes_repeats():
    assert clean_name_list(["Lat", "lat", "LAT", "x"]) == ["lat", "lat_2", "lat_3", "x"]
    assert clean_name_list(["name", "Dataset", "name"]) == ["name", "dataset", "name_2"]


def test_logical_name_and_version(spark):
    entries = ["leaf area_2023-05-01.qs", "seed mass.parquet", "x_2023-05-01_9.qs", "x_2023-05-01_10.qs", "a_2023", "x.y_2023-01-02"]
    df = spark.createDataFrame([(e,) for e in entries], "e string")
    rows = df.select(logical_name(F.col("e")).alias("n"), entry_version(F.col("e")).alias("v")).collect()
    assert [(r.n, r.v.date, r.v.number) for r in rows] == [
        ("leaf area", "2023-05-01", 0), ("seed mass", "", 0), ("x", "2023-05-01", 9), ("x", "2023-05-01", 10), ("a_2023", "", 0),
        ("x.y", "2023-01-02", 0),
    ]
    assert rows[3].v > rows[2].v


def test_to_number_or_null(spark):
    texts = ["1", " 2.5 ", "-3e2", ".5", "5.", "inf", "-Infinity", "NaN", "n/a", "1.0d", "1f", "0x1A", "", None, "1_0"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(to_number_or_null("t").alias("v")).collect()
    got = [r.v for r in rows]
    assert got[:5] == [1.0, 2.5, -300.0, 0.5, 5.0]
    assert got[5] == math.inf and got[6] == -math.inf and math.isnan(got[7])
    assert got[8:] == [None] * 7


def test_reciprocal_and_ifelse(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (4.0,), (None,)], "x double")
    got = [r.r for r in df.select(reciprocal("x").alias("r")).collect()]
    assert got == [math.inf, -math.inf, 0.25, None]
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "d string, v int")
    out = [r.o for r in df.select(if_else_na(F.col("d") == "a", F.lit(-1), F.col("v")).alias("o")).collect()]
    assert out == [-1, 2, None]


def test_membership_is_two_valued(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert [r.x for r in df.where(in_values("x", [1])).collect()] == [1]
    assert [r.x for r in df.where(not_in_values("x", [1])).collect()] == [2, None]
    assert [r.x for r in df.where(in_values("x", [1, None])).collect()] == [1, None]
    assert [r.x for r in df.where(not_in_values("x", [])).collect()] == [1, 2, None]
