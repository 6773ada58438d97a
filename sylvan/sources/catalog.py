"""Fixed lookup values of the trait workflow.

These values must equal the original workflow's for identical results, so
they are stated here verbatim and in their original order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---- fixed values -------------------------------------------------------
# Trait catalog: trait id (as text), trait domain, trait full name. The
# domain "Plant heigh" and the TAB that ends the 3106 full name are kept
# byte-exact on purpose.
TRAIT_CATALOG = [
    ("4", "Stem specific density", "Stem specific density (SSD, stem dry mass per stem fresh volume) or wood density"),
    ("14", "Leaf nitrogen content per unit mass", "Leaf nitrogen (N) content per leaf dry mass"),
    ("26", "Diaspore mass", "Seed dry mass"),
    ("3106", "Plant heigh", "Plant height vegetative\t"),
    ("3108", "Leaf Area", "Leaf area (in case of compound leaves: leaf, petiole excluded)"),
    ("3110", "Leaf Area", "Leaf area (in case of compound leaves: leaf, petiole included)"),
    ("3112", "Leaf Area", "Leaf area (in case of compound leaves: leaf, undefined if petiole in- or excluded)"),
    ("3114", "Leaf Area", "Leaf area (in case of compound leaves undefined if leaf or leaflet, undefined if petiole is in- or exluded)"),
    ("3116", "Leaf mass per area", "Leaf area per leaf dry mass (specific leaf area, SLA or 1/LMA): petiole included"),
    ("3117", "Leaf mass per area", "Leaf area per leaf dry mass (specific leaf area, SLA or 1/LMA): undefined if petiole is in- or excluded)"),
]

# Data items excluded after review (2221:2225 expanded).
EXCLUDED_DATA_IDS = [
    2221, 2222, 2223, 2224, 2225, 3646, 3647, 3698, 3699, 3727, 3728, 3730, 3731, 3849, 3850, 4029, 4030,
]

# Domains whose values are inverted, with the unit they get.
INVERTED_DOMAINS = {"Leaf mass per area": "mg/mm2"}

# Trait names taken from the trait-record database.
WANTED_TRAITS = [
    "whole plant height",
    "stem wood density",
    "leaf area",
    "leaf area per leaf dry mass",
    "leaf nitrogen content per leaf dry mass",
    "seed mass",
]

# Columns kept from trait records, in selection order, and the order of the
# per-trait columns after conforming.
RECORD_COLUMNS = [
    "trait_name", "trait_value", "unit", "id", "longitude", "latitude", "method",
    "url_source", "source_citation", "project_pi", "scrubbed_species_binomial", "access",
]
RECORD_NEST_ORDER = [
    "id", "scrubbed_species_binomial", "trait_value", "unit", "longitude", "latitude",
    "method", "url_source", "source_citation", "project_pi", "access",
]
# ---- end of fixed values ------------------------------------------------

CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("trait_id_value", T.StringType(), False),
        T.StructField("trait_domain", T.StringType(), False),
        T.StructField("trait_full_name", T.StringType(), False),
    ]
)


def trait_catalog(spark: SparkSession, rows=None) -> DataFrame:
    """The catalog as a DataFrame (fixed size: safe to broadcast)."""
    return spark.createDataFrame(rows if rows is not None else TRAIT_CATALOG, CATALOG_SCHEMA)
