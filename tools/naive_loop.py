"""The original's literal per-trait loop, kept only as the benchmark

One filtered rescan of the export per trait id, unioned: 2k+1 scans for k
traits and a driver loop. Not part of the library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.plans.traits import (
    COLS,
    TRAIT,
    ExportColumns,
    _c,
    covariates_wide,
    data_item_overview,
    extract_covariates,
    extract_trait_values,
    kept_items,
    merge_values_covariates,
    select_data_items,
    standardise_traits,
)


def trait_table_per_trait_loop(df: DataFrame, catalog: DataFrame | None = None, cols: ExportColumns = COLS) -> DataFrame:
    """Same result as ``trait_table``, computed the slow, literal way."""
    trait_ids = [r[0] for r in df.where(_c(cols.trait).isNotNull()).select(cols.trait).distinct().orderBy(cols.trait).collect()]
    parts = []
    for t in trait_ids:
        obs = df.where((_c(cols.trait) == t) & _c(cols.obs).isNotNull()).select(cols.obs).distinct()
        sel = df.join(obs, cols.obs, "left_semi").where(_c(cols.trait).isNull() | (_c(cols.trait) == t))
        parts.append(sel.select(F.lit(t).cast(df.schema[cols.trait].dataType).alias(TRAIT), *[_c(c) for c in df.columns]))
    exploded = parts[0]
    for p in parts[1:]:
        exploded = exploded.unionByName(p)
    keep = kept_items(select_data_items(data_item_overview(df, cols), cols=cols), cols)
    values = extract_trait_values(exploded, keep, cols)
    covariates = extract_covariates(exploded, keep, cols=cols)
    wide = covariates_wide(covariates, "columns", None, cols)
    return standardise_traits(merge_values_covariates(values, wide, "inner", cols), catalog, cols=cols)
