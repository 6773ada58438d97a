"""Long trait export -> one wide, unit-harmonised trait table.

Physical shape of the whole chain (check with ``trait_table(...).explain()``):

* a small observation index (one row per observation: trait set and item
  ids, partial aggregates) is written to the checkpoint folder; it gives
  the fan-out join its right side and the global kept-item set;
* the export is scanned once more: rows are marked as kept or not and reduced
  to the first row of each key before the fan-out. The reduction is cut to one
  row per key on the map side, so a hot observation needs no session setting;
* what is left is joined to the index on the observation id, and one aggregate
  pairs values with covariates (no further exchange: its keys contain the
  observation id);
* the catalog is the library's own fixed table and is broadcast; the sizes of
  data-derived key sets are left to Spark;
* the columns form writes the grouped measurements once and reads them for the
  names and for the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.functions.names import clean_name_list
from sylvan.functions.nulls import in_values
from sylvan.functions.numeric import if_else_na, reciprocal, to_number_or_null
from sylvan.operators.dedup import keep_first
from sylvan.operators.filters import exclude_values
from sylvan.operators.joins import lookup_join, null_safe_join
from sylvan.operators.keysets import KeySet
from sylvan.operators.reshape import MAX_COLUMNS, map_to_columns, map_to_first_columns, pivot_names, pivot_to_map
from sylvan.session import Scratch, write_intermediate
from sylvan.sources.catalog import EXCLUDED_DATA_IDS, INVERTED_DOMAINS, trait_catalog


@dataclass(frozen=True)
class ExportColumns:
    """Column names of the long export."""

    trait: str = "TraitID"
    obs: str = "ObservationID"
    data_id: str = "DataID"
    data_name: str = "DataName"
    dataset: str = "Dataset"
    species: str = "AccSpeciesName"
    value: str = "OrigValueStr"
    unit: str = "UnitName"
    order: str = "ord"


COLS = ExportColumns()
TRAIT = "trait"  # the fan-out key added by C1
OTHER_COVARIATES = "other_covariates"  # the map of those that became no column


def _c(name: str):
    return F.col(f"`{name}`")


def observation_index(
    df: DataFrame, cols: ExportColumns = COLS, write: bool = True, scratch: Scratch | None = None
) -> DataFrame:
    """One row per observation that carries a trait: its trait set, the item
    ids of its trait rows, and whether one of them is NULL. Partial
    aggregates (sets bounded by the number of distinct traits and items).

    With ``write`` the table is written to the shared checkpoint folder and
    read back, so a join on it is a plain shuffle stage (AQE can then split a
    hot observation of the other side) and later steps read it cheaply.
    """
    index = (
        df.where(_c(cols.trait).isNotNull() & _c(cols.obs).isNotNull())
        .groupBy(_c(cols.obs))
        .agg(
            F.collect_set(_c(cols.trait)).alias("_traits"),
            F.collect_set(_c(cols.data_id)).alias("_items"),
            F.max(_c(cols.data_id).isNull()).alias("_null_item"),
        )
    )
    return write_intermediate(index, "observation-index", scratch) if write else index


def explode_observations_by_trait(
    df: DataFrame,
    cols: ExportColumns = COLS,
    into: str = TRAIT,
    skew_safe: bool = True,
    index: DataFrame | None = None,
) -> DataFrame:
    """For every trait t, the rows of t plus every covariate row
    (trait NULL) of the observations that carry t, tagged ``into = t``.

    One equi-join replaces the per-trait rescans: each observation's trait
    set (``observation_index``) is joined on the observation id and
    covariate rows are exploded over it. NULL observations never match.
    ``skew_safe`` writes the index first (see ``observation_index``).
    """
    if index is None:
        index = observation_index(df, cols, write=skew_safe)
    traits_of_obs = index.select(_c(cols.obs), "_traits")
    rows = df.where(_c(cols.obs).isNotNull()).join(traits_of_obs, cols.obs)
    tags = F.when(_c(cols.trait).isNull(), F.col("_traits")).otherwise(F.array(_c(cols.trait)))
    return rows.select(F.explode(tags).alias(into), *[_c(c) for c in df.columns])


def data_item_overview(df: DataFrame, cols: ExportColumns = COLS, into: str = TRAIT) -> DataFrame:
    """Distinct (trait, data id, data name) of trait rows on a known
    observation, the list a person reviews before excluding items."""
    return (
        df.where(_c(cols.trait).isNotNull() & _c(cols.obs).isNotNull())
        .select(_c(cols.trait).alias(into), _c(cols.data_id), _c(cols.data_name))
        .distinct()
    )


def select_data_items(overview: DataFrame, exclude: Sequence[int] = EXCLUDED_DATA_IDS, cols: ExportColumns = COLS) -> DataFrame:
    """The overview minus the excluded items; a NULL item id stays."""
    return exclude_values(overview, cols.data_id, exclude)


def kept_items(selected: DataFrame, cols: ExportColumns = COLS) -> KeySet:
    """The global set of kept data item ids."""
    return KeySet.of(selected, cols.data_id)


def kept_items_from_index(
    index: DataFrame,
    exclude: Sequence[int] = EXCLUDED_DATA_IDS,
    cols: ExportColumns = COLS,
    scratch: Scratch | None = None,
) -> KeySet:
    """The same set as ``kept_items(select_data_items(data_item_overview(df)))``
    read from the written observation index instead of the export. The set is
    written too: Spark then knows its size before it plans the join that marks
    the export's rows, and broadcasts it only below its own threshold."""
    item_type = index.schema["_items"].dataType.elementType
    items = F.when(
        F.col("_null_item"), F.array_union("_items", F.array(F.lit(None).cast(item_type)))
    ).otherwise(F.col("_items"))
    ids = index.select(F.explode(items).alias(cols.data_id))
    kept = exclude_values(ids, cols.data_id, exclude).distinct()
    return KeySet(None, write_intermediate(kept.select(_c(cols.data_id).alias("_key")), "kept-items", scratch))


class PerTraitKeep:
    """Kept items per trait: a (trait, item) pair is kept
    only for its own trait, so a covariate row becomes a value only where the
    same item was measured for that trait."""

    def __init__(self, selected: DataFrame, cols: ExportColumns = COLS, into: str = TRAIT):
        self.into = into
        self.pairs = selected.select(into, cols.data_id).distinct()

    def keep(self, df: DataFrame, column: str) -> DataFrame:
        return null_safe_join(df, self.pairs, [self.into, column], "left_semi")

    def drop(self, df: DataFrame, column: str) -> DataFrame:
        return null_safe_join(df, self.pairs, [self.into, column], "left_anti")


def extract_trait_values(exploded: DataFrame, keep: KeySet, cols: ExportColumns = COLS, into: str = TRAIT) -> DataFrame:
    """C4: rows whose item is kept (also covariate rows: the set is global),
    first row per (trait, dataset, species, observation) in file order, then
    rows without a value are dropped (after the choice, as in the original)."""
    rows = keep.keep(exploded, cols.data_id)
    first = keep_first(rows, [into, cols.dataset, cols.species, cols.obs], [_c(cols.order)])
    return first.where(_c(cols.value).isNotNull()).select(
        into, cols.dataset, cols.species, cols.obs, cols.value, cols.unit
    )


def extract_covariates(
    exploded: DataFrame,
    keep: KeySet,
    exclude: Sequence[int] = EXCLUDED_DATA_IDS,
    cols: ExportColumns = COLS,
    into: str = TRAIT,
) -> DataFrame:
    """Covariate rows whose item is neither excluded nor kept as a value,
    first per (trait, dataset, species, observation, name), with a value.
    A NULL name is the name ``NA`` (before the dedup, so names stay unique)."""
    rows = exploded.where(_c(cols.trait).isNull())
    rows = keep.drop(exclude_values(rows, cols.data_id, exclude), cols.data_id)
    rows = rows.withColumn(cols.data_name, F.coalesce(_c(cols.data_name), F.lit("NA")))
    first = keep_first(rows, [into, cols.dataset, cols.species, cols.obs, cols.data_name], [_c(cols.order)])
    return first.where(_c(cols.value).isNotNull()).select(
        into, cols.dataset, cols.species, cols.obs, cols.data_name, cols.value, cols.order
    )


def covariate_names(covariates: DataFrame, cols: ExportColumns = COLS, into: str = TRAIT, limit: int | None = None) -> list[str]:
    """Pivot column order: by first trait (ascending), then file order."""
    return pivot_names(covariates, cols.data_name, [into, cols.order], limit)


def covariates_wide(
    covariates: DataFrame,
    as_: str = "columns",
    names: Sequence[str] | None = None,
    cols: ExportColumns = COLS,
    into: str = TRAIT,
    max_columns: int = MAX_COLUMNS,
) -> DataFrame:
    """One row per (trait, dataset, species, observation); covariates as
    a ``covariates`` map (``as_="map"``, the scalable form) or as columns. Of
    names that are looked up, those after the first ``max_columns`` stay in a
    map column ``other_covariates``; the driver sees no more than that."""
    wide = pivot_to_map(covariates, [into, cols.dataset, cols.species, cols.obs], cols.data_name, cols.value)
    if as_ == "map":
        return wide
    if names is not None:
        return map_to_columns(wide, "covariates", names)
    found = covariate_names(covariates, cols, into, max_columns + 1)
    return map_to_first_columns(wide, "covariates", found, max_columns, OTHER_COVARIATES)


def merge_values_covariates(
    values: DataFrame, wide: DataFrame, how: str = "inner", cols: ExportColumns = COLS, into: str = TRAIT
) -> DataFrame:
    """Values joined to covariates on (trait, dataset, species,
    observation); NULL dataset/species match. With ``inner`` a value without
    any covariate is dropped, as in the original."""
    keys = [into, cols.dataset, cols.species, cols.obs]
    return null_safe_join(values, wide, keys, how, not_null=[into, cols.obs])


def combine_values_covariates(
    values: DataFrame,
    covariates: DataFrame,
    how: str = "inner",
    as_: str = "columns",
    names: Sequence[str] | None = None,
    cols: ExportColumns = COLS,
    into: str = TRAIT,
    max_columns: int = MAX_COLUMNS,
) -> DataFrame:
    """C6 + C7 fused: pivot the covariates and join them to the values in one
    aggregate over the union of both, grouped by (trait, dataset, species,
    observation). Grouping treats NULL keys as equal, which is the null-safe
    join; both inputs are already clustered by the observation id, so this
    adds no exchange. ``how`` keeps keys with a value (``left``), with
    covariates (``right``), with both (``inner``) or either (``full``).
    """
    keys = [into, cols.dataset, cols.species, cols.obs]
    none = F.lit(None).cast("string")
    tagged = values.select(
        *keys, F.lit(True).alias("_is_value"), _c(cols.value), _c(cols.unit), none.alias("_name")
    ).unionByName(
        covariates.select(
            *keys, F.lit(False).alias("_is_value"), _c(cols.value), none.alias(cols.unit), _c(cols.data_name).alias("_name")
        )
    )
    is_value = F.col("_is_value")
    grouped = tagged.groupBy(*keys).agg(
        F.collect_list(F.when(is_value, F.struct(_c(cols.value).alias("v"), _c(cols.unit).alias("u")))).alias("_value"),
        F.map_from_entries(
            F.collect_list(F.when(~is_value, F.struct(F.col("_name").alias("k"), _c(cols.value).alias("v"))))
        ).alias("covariates"),
    )
    has_value, has_cov = F.size("_value") > 0, F.size("covariates") > 0
    keep = {"inner": has_value & has_cov, "left": has_value, "right": has_cov, "full": F.lit(True)}[how]
    wide = grouped.where(keep).select(
        *keys, F.col("_value")[0]["v"].alias(cols.value), F.col("_value")[0]["u"].alias(cols.unit), "covariates"
    )
    if as_ == "map":
        return wide
    if names is not None:
        return map_to_columns(wide, "covariates", names)
    found = covariate_names(covariates, cols, into, max_columns + 1)
    return map_to_first_columns(wide, "covariates", found, max_columns, OTHER_COVARIATES)


def standardise_traits(
    merged: DataFrame,
    catalog: DataFrame | None = None,
    invert: dict[str, str] | None = None,
    cols: ExportColumns = COLS,
    into: str = TRAIT,
) -> DataFrame:
    """Numeric value, catalog lookup, clean names, inversion, order.

    Output: dataset, acc_species_name, trait_value, trait_domain,
    trait_full_name, observation_id, orig_value_str, unit_name, covariates...
    For a trait missing from the catalog, value and unit become NULL.
    Columns are handled by position, so covariates named like a fixed column
    (``Dataset``, ``name``) or differing only in case get ``_2`` suffixes.
    """
    spark = merged.sparkSession
    invert = INVERTED_DOMAINS if invert is None else invert
    fixed = catalog is None  # the library's own short table
    catalog = trait_catalog(spark) if fixed else catalog
    original = list(merged.columns)
    # fixed columns come first in the merged layout, covariates after them
    i_key, i_obs = original.index(into), original.index(cols.obs)
    i_value, i_unit = original.index(cols.value), original.index(cols.unit)
    tmp = [f"_c{i}" for i in range(len(original))]
    step = merged.toDF(*tmp).withColumn("_value", to_number_or_null(F.col(tmp[i_value])))
    lookup = catalog.toDF("_id", "_domain", "_full")
    step = lookup_join(step, lookup, tmp[i_key], "_id", fixed=fixed)
    # the key is called "name" while names are cleaned (as in the original),
    # so a covariate "name" becomes "name_2"; then the key is dropped
    names = ["name" if i == i_key else n for i, n in enumerate(original)]
    names += ["trait_value", catalog.columns[1], catalog.columns[2]]
    final = dict(zip([*tmp, "_value", "_domain", "_full"], clean_name_list(names)))
    domain, value, unit = F.col("_domain"), F.col("_value"), F.col(tmp[i_unit])
    for dom, new_unit in invert.items():
        value = if_else_na(domain == dom, reciprocal(value), value)
        unit = if_else_na(domain == dom, F.lit(new_unit), unit)
    step = step.withColumns({"_value": value, tmp[i_unit]: unit})
    moved = ["_value", "_domain", "_full"]
    rest = [t for i, t in enumerate(tmp) if i != i_key]
    at = rest.index(tmp[i_obs])
    return step.select(*[F.col(t).alias(final[t]) for t in rest[:at] + moved + rest[at:]])


def first_measurements(
    df: DataFrame,
    index: DataFrame,
    keep: KeySet,
    exclude: Sequence[int] = EXCLUDED_DATA_IDS,
    cols: ExportColumns = COLS,
    into: str = TRAIT,
) -> DataFrame:
    """C1 and C4-C6 in one pass over the export: one row per (trait, dataset,
    species, observation) with the first value row (``_value``: value, unit)
    and the first row of each covariate name (``_covariates``: name, value,
    order), null covariates left out.

    Which row comes first does not depend on the trait that a covariate row is
    fanned out to, so rows are reduced before the fan-out: one ``row_number``
    over (observation, dataset, species, own trait, is-value, name), which
    Spark cuts to one row per key on the map side. Only what is left meets the
    observation's trait set, so an observation with very many rows costs one
    task no more than its distinct names and traits.
    """
    known = df.where(_c(cols.obs).isNotNull())
    marked = keep.mark(known, cols.data_id, "_kept")
    is_covariate = _c(cols.trait).isNull()
    not_excluded = ~in_values(_c(cols.data_id), exclude)
    marked = marked.where(F.col("_kept") | (is_covariate & not_excluded))
    name = F.when(~F.col("_kept"), F.coalesce(_c(cols.data_name), F.lit("NA")))
    rows = marked.select(
        *[_c(c) for c in (cols.obs, cols.dataset, cols.species, cols.trait, cols.value, cols.unit, cols.order)],
        F.col("_kept"), name.alias("_name"),
    )
    first = keep_first(rows, [cols.obs, cols.dataset, cols.species, cols.trait, "_kept", "_name"], [_c(cols.order)])
    traits = index.select(_c(cols.obs), "_traits")
    tags = F.when(is_covariate, F.col("_traits")).otherwise(F.array(_c(cols.trait)))
    tagged = first.join(traits, cols.obs).withColumn(into, F.explode(tags))
    value = F.struct(_c(cols.order).alias("o"), _c(cols.value).alias("v"), _c(cols.unit).alias("u"))
    covariate = F.struct(F.col("_name").alias("k"), _c(cols.value).alias("v"), _c(cols.order).alias("o"))
    return tagged.groupBy(into, _c(cols.dataset), _c(cols.species), _c(cols.obs)).agg(
        F.min_by(F.when(F.col("_kept"), value), F.when(F.col("_kept"), _c(cols.order))).alias("_value"),
        F.collect_list(F.when(~F.col("_kept") & _c(cols.value).isNotNull(), covariate)).alias("_covariates"),
    )


def trait_table(
    df: DataFrame,
    catalog: DataFrame | None = None,
    exclude: Sequence[int] = EXCLUDED_DATA_IDS,
    as_: str = "columns",
    how: str = "inner",
    names: Sequence[str] | None = None,
    cols: ExportColumns = COLS,
    keep_scope: str = "global",
    invert: dict[str, str] | None = None,
    scratch: Scratch | None = None,
    max_columns: int = MAX_COLUMNS,
) -> DataFrame:
    """The whole chain C1..C8 on a long export (the flagship query).

    ``as_="map"`` needs no names and is the form for large exports. The columns
    form looks the names up; the first ``max_columns`` become columns, any
    others stay in a map column ``other_covariates``.

    ``keep_scope="global"`` is the original's rule (an item kept for any
    trait is a value item for all); ``"per_trait"`` keeps it per trait, which
    makes the choice of rows depend on the trait, so it runs on the fan-out."""
    if keep_scope == "per_trait":
        exploded = explode_observations_by_trait(df, cols, index=observation_index(df, cols, scratch=scratch))
        pairs = PerTraitKeep(select_data_items(data_item_overview(df, cols), exclude, cols), cols)
        values = extract_trait_values(exploded, pairs, cols)
        covariates = extract_covariates(exploded, pairs, exclude, cols)
        if as_ == "columns" and names is None:
            covariates = write_intermediate(covariates, "covariates", scratch)
        merged = combine_values_covariates(values, covariates, how, as_, names, cols, max_columns=max_columns)
        return standardise_traits(merged, catalog, invert, cols=cols)
    if keep_scope != "global":
        raise ValueError("keep_scope must be 'global' or 'per_trait'")
    index = observation_index(df, cols, scratch=scratch)
    grouped = first_measurements(df, index, kept_items_from_index(index, exclude, cols, scratch), exclude, cols)
    if as_ == "columns" and names is None:
        # the schema needs the names first: write the groups, read them twice
        grouped = write_intermediate(grouped, "measurements", scratch)
        each = grouped.select(TRAIT, F.explode("_covariates").alias("c")).select(TRAIT, F.col("c.k").alias("k"), F.col("c.o").alias("o"))
        found = pivot_names(each, "k", [TRAIT, "o"], max_columns + 1)
    has_value, has_cov = F.col("_value.v").isNotNull(), F.size("_covariates") > 0
    wanted = {"inner": has_value & has_cov, "left": has_value, "right": has_cov, "full": has_value | has_cov}[how]
    entries = F.map_from_entries(F.transform("_covariates", lambda c: F.struct(c["k"], c["v"])))
    merged = grouped.where(wanted).select(
        TRAIT, _c(cols.dataset), _c(cols.species), _c(cols.obs),
        F.when(has_value, F.col("_value.v")).alias(cols.value), F.when(has_value, F.col("_value.u")).alias(cols.unit),
        entries.alias("covariates"),
    )
    if as_ == "columns" and names is None:
        merged = map_to_first_columns(merged, "covariates", found, max_columns, OTHER_COVARIATES)
    elif as_ == "columns":
        merged = map_to_columns(merged, "covariates", names)
    return standardise_traits(merged, catalog, invert, cols=cols)
