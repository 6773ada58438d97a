"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the given tables (or the EAV view Spark derives from
``events``) whole. Their DuckDB counterparts are in ``sylvan.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sylvan.functions.names import entry_version, logical_name
from sylvan.operators.columns import clean_names, convert_columns, enframe, relocate, select_any_of
from sylvan.operators.dedup import distinct_values, keep_first
from sylvan.operators.filters import all_true, any_true, discard_empty_sources, drop_incomplete
from sylvan.operators.joins import missing_items, null_safe_anti, null_safe_semi
from sylvan.operators.ordering import arrange, assign_chunks, first_group, head_ordered
from sylvan.operators.reshape import nest_by, union_by_name, unnest
from sylvan.operators.summaries import (
    count_rows,
    describe_numeric,
    describe_strings,
    group_summary,
    null_profile,
    summary_of_summaries,
)
from sylvan.plans import traits as tr
from sylvan.plans.eav_view import eav_view, read_table
from sylvan.plans.records import FILE_ROWS, combine_sources, conform_records, quality_report, write_record_chunks
from sylvan.session import Scratch, shared_scratch
from sylvan.sources.export import land_export, read_landed, read_trait_export
from sylvan.sources.records import ingest_traits, trait_names
from sylvan.sources.snapshots import read_latest, read_latest_files, save_snapshot
from sylvan.sources.upkeep import compact_manifest, remove_unnamed

Query = Callable[[SparkSession, str], DataFrame]

# ---- the trait export (events-derived EAV view) --------------------------


def q_trait_ids(spark, sf_dir):
    t = eav_view(spark, sf_dir)
    ids = drop_incomplete(distinct_values(t, ["TraitID"]))
    return arrange(enframe(ids, "TraitID"), "value")


def q_explode_by_trait(spark, sf_dir):
    return tr.explode_observations_by_trait(eav_view(spark, sf_dir))


def q_item_overview(spark, sf_dir):
    return tr.data_item_overview(eav_view(spark, sf_dir))


def q_item_selected(spark, sf_dir):
    return tr.select_data_items(tr.data_item_overview(eav_view(spark, sf_dir)))


def _values_and_covariates(spark, sf_dir):
    t = eav_view(spark, sf_dir)
    exploded = tr.explode_observations_by_trait(t)
    keep = tr.kept_items(tr.select_data_items(tr.data_item_overview(t)))
    return tr.extract_trait_values(exploded, keep), tr.extract_covariates(exploded, keep)


def q_trait_values(spark, sf_dir):
    return _values_and_covariates(spark, sf_dir)[0]


def q_covariates_long(spark, sf_dir):
    return _values_and_covariates(spark, sf_dir)[1].drop("ord")


def q_covariates_wide(spark, sf_dir):
    return tr.covariates_wide(_values_and_covariates(spark, sf_dir)[1], as_="columns")


def q_trait_merged(spark, sf_dir):
    values, covariates = _values_and_covariates(spark, sf_dir)
    return tr.combine_values_covariates(values, covariates, how="inner", as_="columns")


def q_trait_merged_join(spark, sf_dir):
    """C6 then C7 as separate operators (pivot, then null-safe join)."""
    values, covariates = _values_and_covariates(spark, sf_dir)
    return tr.merge_values_covariates(values, tr.covariates_wide(covariates, as_="columns"))


def q_trait_table(spark, sf_dir):
    return tr.trait_table(eav_view(spark, sf_dir), as_="columns")


def q_trait_table_from_export(spark, sf_dir):
    """S1, S1a, S5 -> C9: the long table written as tab-separated files in file
    order, scanned, landed and turned into the trait table."""
    scratch = Scratch(spark, "export")
    text = eav_view(spark, sf_dir).repartitionByRange(4, "ord").sortWithinPartitions("ord").drop("ord")
    (
        text.write.option("sep", "\t").option("header", "true").option("nullValue", "NA").option("encoding", "ISO-8859-1")
        .option("quote", "").csv(scratch.path("text"))
    )
    land_export(read_trait_export(spark, scratch.path("text")), scratch.path("landed"))
    return tr.trait_table(read_landed(spark, scratch.path("landed")), as_="columns")


def q_trait_table_long(spark, sf_dir):
    """The map form of the trait table (the scalable one), one row per
    measurement and covariate (maps are flattened for the comparison)."""
    wide = tr.trait_table(eav_view(spark, sf_dir), as_="map")
    fixed = [c for c in wide.columns if c != "covariates"]
    return wide.select(*fixed, F.explode("covariates").alias("covariate", "covariate_value"))


def q_trait_table_overflow(spark, sf_dir):
    """The columns form with room for two covariates: what the others hold,
    one row per measurement and covariate."""
    wide = tr.trait_table(eav_view(spark, sf_dir), as_="columns", max_columns=2)
    return wide.select(*wide.columns[:8], F.explode("other_covariates").alias("covariate", "covariate_value"))


def q_species_summary(spark, sf_dir):
    # the summary needs the rows, not covariate columns: the map form has the
    # same rows and skips the column-name pass
    table = tr.trait_table(eav_view(spark, sf_dir), as_="map")
    return group_summary(table, ["trait_domain", "acc_species_name"], "trait_value")


def q_domain_summary(spark, sf_dir):
    return summary_of_summaries(q_species_summary(spark, sf_dir), "trait_domain", min_n=50)


def q_null_safe_semi(spark, sf_dir):
    t = eav_view(spark, sf_dir)
    keys = t.where(F.col("TraitID") == 3116).select("Dataset", "OrigValueStr")
    return null_safe_semi(t, keys, ["Dataset", "OrigValueStr"])


def q_null_safe_anti(spark, sf_dir):
    t = eav_view(spark, sf_dir)
    keys = t.where(F.col("TraitID") == 3116).select("Dataset", "OrigValueStr")
    return null_safe_anti(t, keys, ["Dataset", "OrigValueStr"])


def q_conform_records(spark, sf_dir):
    t = eav_view(spark, sf_dir)
    records = t.select(
        F.col("DataName").alias("trait_name"),
        F.col("ord").alias("id"),
        F.col("AccSpeciesName").alias("scrubbed_species_binomial"),
        F.col("OrigValueStr").alias("trait_value"),
        F.col("UnitName").alias("unit"),
        F.col("Dataset").alias("project_pi"),
        F.col("TraitID").alias("trait_id"),
    )
    return conform_records(records)


def q_null_profile(spark, sf_dir):
    return null_profile(eav_view(spark, sf_dir))


# ---- generic operators on the driver tables -------------------------------


def q_keep_first(spark, sf_dir):
    events = read_table(spark, sf_dir, "events")
    return keep_first(events, ["user_id", "event_type"], ["event_id"])


def q_group_summary_part(spark, sf_dir):
    return group_summary(read_table(spark, sf_dir, "part"), ["p_brand", "p_type"], "p_retailprice")


def _type_words(spark, sf_dir):
    part = read_table(spark, sf_dir, "part")
    return part.select(F.lower("p_type").alias("item")), part.select(F.col("p_name").alias("name"))


def q_missing_exact(spark, sf_dir):
    requested, present = _type_words(spark, sf_dir)
    return missing_items(requested, present, match="exact")


def q_missing_contains(spark, sf_dir):
    requested, present = _type_words(spark, sf_dir)
    return missing_items(requested, present, match="contains")


def _strip_prefix(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.split("_", 1)[1] for c in df.columns])


def q_union_tolerant(spark, sf_dir):
    customer = _strip_prefix(read_table(spark, sf_dir, "customer"))
    supplier = _strip_prefix(read_table(spark, sf_dir, "supplier"))
    return union_by_name([customer, supplier])


def q_discard_empty(spark, sf_dir):
    customer = read_table(spark, sf_dir, "customer")
    blank = F.col("c_mktsegment") == "BUILDING"
    sources = customer.select(
        F.col("c_mktsegment").alias("source"),
        F.when(~blank, F.col("c_custkey")).alias("custkey"),
        F.when(~blank, F.col("c_name")).alias("name"),
        F.when(~blank, F.col("c_acctbal")).alias("acctbal"),
    )
    return discard_empty_sources(sources, "source")


def q_select_any_of(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return select_any_of(orders, ["o_orderkey", "o_comment", "o_totalprice", "o_shippriority", "o_custkey"])


def q_relocate(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return relocate(orders, ["o_totalprice", "o_orderdate"], before="o_custkey")


def q_clean_names(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    renamed = orders.toDF("OrderKey", "CustomerID", "orderStatus", "Total Price", "Order#Date", "priority%")
    return clean_names(renamed)


def q_clean_names_letters(spark, sf_dir):
    """Letters outside ASCII, some of which do not decompose."""
    orders = read_table(spark, sf_dir, "orders")
    return clean_names(orders.toDF("µmol", "Ørsted", "Straße", "δ13C", "Größe (m²)", "año"))


def q_nest_roundtrip(spark, sf_dir):
    nation = read_table(spark, sf_dir, "nation")
    nested = nest_by(nation, ["n_regionkey"], ["n_nationkey", "n_name"], into="nations", order="n_nationkey")
    return unnest(nested, "nations")


def q_nest_pieces_roundtrip(spark, sf_dir):
    """Orders nested per customer in pieces of at most 4, then unnested."""
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    nested = nest_by(orders, ["o_custkey"], ["o_orderkey", "o_totalprice"], into="orders", order="o_orderkey", max_items=4)
    return unnest(nested, "orders")


def q_nest_user_piece(spark, sf_dir):
    """A table with a column called ``piece`` keeps it."""
    orders = read_table(spark, sf_dir, "orders").selectExpr("o_custkey", "o_custkey % 3 as piece", "o_orderkey")
    return unnest(nest_by(orders, ["o_custkey", "piece"], ["o_orderkey"], into="orders", max_items=3), "orders")


def q_describe_numeric(spark, sf_dir):
    return describe_numeric(read_table(spark, sf_dir, "lineitem"))


def q_describe_strings(spark, sf_dir):
    return describe_strings(read_table(spark, sf_dir, "orders"))


def q_describe_strings_part(spark, sf_dir):
    return describe_strings(read_table(spark, sf_dir, "part"))


def q_chunks_lossless(spark, sf_dir):
    return assign_chunks(read_table(spark, sf_dir, "labels"), ["doc_id"], 4, "lossless")


def q_chunks_truncating(spark, sf_dir):
    return assign_chunks(read_table(spark, sf_dir, "labels"), ["doc_id"], 4, "truncating")


def q_head_ordered(spark, sf_dir):
    return head_ordered(read_table(spark, sf_dir, "events"), ["event_id"], 1000)


def q_latest_snapshot(spark, sf_dir):
    """Save the customer table, save it again (skipped: unchanged), save the
    enriched table as a newer version, read the newest."""
    root = shared_scratch(spark, "snapshots")
    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    save_snapshot(customer, root, "customer")
    save_snapshot(customer, root, "customer")
    enriched = customer.join(nation.select("n_nationkey", "n_name"), customer.c_nationkey == nation.n_nationkey).drop("n_nationkey")
    save_snapshot(enriched, root, "customer")
    return read_latest(spark, root, ["customer"])


def q_snapshot_upkeep(spark, sf_dir):
    """Three versions of customer and one of orders; the manifest merged with
    the newest version of each, the rest removed; what is left, counted by
    name beside the versions that the manifest and the folders hold."""
    root = shared_scratch(spark, "snapshots")
    customer = read_table(spark, sf_dir, "customer")
    for table in (customer, customer.drop("c_acctbal"), customer.where("c_acctbal > 0")):
        save_snapshot(table, root, "customer")
    save_snapshot(read_table(spark, sf_dir, "orders"), root, "orders")
    compact_manifest(spark, root, keep=1, grace=0)
    remove_unnamed(spark, root, older_than=0)
    versions = spark.read.parquet(f"{root}/manifest").groupBy("name").agg(F.count("*").alias("versions"), F.max("rows").alias("rows"))
    # every data file there still is, by its name's folder
    kept = read_latest(spark, root).groupBy("snapshot_name").agg(
        F.count("*").alias("rows_read"), F.sum(F.round(F.col("c_acctbal") * 100).cast("long")).alias("cents"), F.max("o_orderkey").alias("orderkey")
    )
    return kept.join(versions, F.col("snapshot_name") == F.col("name")).drop("name")


def _saved_in_turn(spark, name, *tables):
    root = shared_scratch(spark, "snapshots")
    for table in tables:
        save_snapshot(table, root, name)
    return root


def q_snapshot_null_shift(spark, sf_dir):
    """A NULL that moves to another column is a change."""
    nation = read_table(spark, sf_dir, "nation")
    first = nation.selectExpr("n_name as x", "cast(null as string) as y")
    return read_latest(spark, _saved_in_turn(spark, "t", first, first.select(F.col("y").alias("x"), F.col("x").alias("y"))))


def q_snapshot_renamed_column(spark, sf_dir):
    """So is another column name with the same values."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return read_latest(spark, _saved_in_turn(spark, "t", nation, nation.toDF("key", "label")))


def q_snapshot_empty_newest(spark, sf_dir):
    """A version without rows hides the older one; other names stay."""
    region = read_table(spark, sf_dir, "region")
    root = _saved_in_turn(spark, "emptied", region, region.where("false"))
    save_snapshot(region, root, "full")
    return read_latest(spark, root)


def q_snapshot_type_change(spark, sf_dir):
    """An older version of another type does not matter."""
    region = read_table(spark, sf_dir, "region")
    return read_latest(spark, _saved_in_turn(spark, "t", region, region.withColumn("r_regionkey", F.concat(F.lit("r"), "r_regionkey"))))


def q_snapshot_own_name_column(spark, sf_dir):
    """A table's own columns ``name`` and ``version`` are kept."""
    nation = read_table(spark, sf_dir, "nation").selectExpr("n_nationkey as version", "n_name as name")
    return read_latest(spark, _saved_in_turn(spark, "nations", nation))


def q_snapshot_numeric_name(spark, sf_dir):
    """Names that look like numbers are text."""
    region = read_table(spark, sf_dir, "region")
    root = _saved_in_turn(spark, "007", region)
    save_snapshot(region, root, "7")
    return read_latest(spark, root, ["007"])


def q_snapshot_version_order(spark, sf_dir):
    """S6 on a flat folder: version 10 of a day is newer than 9; an entry
    without a date is read where there is no other."""
    folder = shared_scratch(spark, "folder.v1")
    region = read_table(spark, sf_dir, "region")
    nation = read_table(spark, sf_dir, "nation")
    region.write.parquet(f"{folder}/x.parquet")
    region.where("r_regionkey = 0").write.parquet(f"{folder}/x_2023-05-01_9.parquet")
    region.where("r_regionkey > 0").write.parquet(f"{folder}/x_2023-05-01_10.parquet")
    nation.selectExpr("n_nationkey as r_regionkey", "n_name as r_name").write.parquet(f"{folder}/undated.parquet")
    return read_latest_files(spark, folder)


def _record_source(spark, sf_dir):
    events = read_table(spark, sf_dir, "events")
    return events.select(
        F.col("event_type").alias("trait_name"),
        F.col("event_id").alias("id"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("scrubbed_species_binomial"),
        F.col("value").cast("string").alias("trait_value"),
        F.lit("u").alias("unit"),
        F.col("props").alias("source_citation"),
        F.lit("fam").alias("verbatim_family"),
    )


def q_available_traits(spark, sf_dir):
    """S3: trait names available at the record source."""
    return trait_names(_record_source(spark, sf_dir))


def q_ingest_selected(spark, sf_dir):
    """Ingest three traits from a record source derived from ``events``
    (one partitioned write), ingest again (nothing missing, nothing
    written), then combine the stored sources and conform them."""
    source = _record_source(spark, sf_dir)
    root = shared_scratch(spark, "records")
    wanted = ["purchase", "signup", "view"]
    ingest_traits(source, wanted, root)
    ingest_traits(source, wanted, root)
    return conform_records(combine_sources(spark, root))


def q_ingest_unchanged(spark, sf_dir):
    """Two forced ingests of the same records make one version each."""
    source = _record_source(spark, sf_dir)
    root = shared_scratch(spark, "records")
    for _ in range(2):
        ingest_traits(source, ["purchase", "signup", "view", "no such trait"], root, force=True)
    manifest = spark.read.parquet(f"{root}/manifest")
    return manifest.groupBy(F.col("name").alias("trait_name")).agg(F.count(F.lit(1)).alias("versions"), F.max("rows").alias("n"))


def _chunked_records(spark, sf_dir, mode):
    """E3's last part: sources ingested, combined in file order, conformed,
    written as chunks, read back. Ids repeat or are NULL."""
    source = _record_source(spark, sf_dir)
    events = source.repartitionByRange(max(3, -(-source.count() // FILE_ROWS)), "id").sortWithinPartitions("id")
    odd = events.withColumn("url_source", F.col("id").cast("string")).withColumn("id", F.when(F.col("id") % 5 > 0, F.col("id") % 7))
    root, out = shared_scratch(spark, "records"), shared_scratch(spark, "chunks")
    save_snapshot(odd, root, "all")
    records = conform_records(combine_sources(spark, root, ordinal="ord"), ordinal="ord")
    write_record_chunks(records, out, "data_traits", "ord", mode=mode)
    write_record_chunks(records, out, "data_traits", "ord", mode=mode)  # unchanged
    return read_latest(spark, out)


def q_chunks_written_lossless(spark, sf_dir):
    return _chunked_records(spark, sf_dir, "lossless")


def q_chunks_written_truncating(spark, sf_dir):
    return _chunked_records(spark, sf_dir, "truncating")


def q_quality_report(spark, sf_dir):
    """C14 as one long table: (part, column, item, value)."""
    orders = read_table(spark, sf_dir, "orders").withColumn("large", F.when(F.col("o_custkey") % 10 > 0, F.col("o_totalprice") > 150000))
    report = quality_report(orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date")))
    stats = ["min", "q1", "median", "mean", "q3", "max"]

    def long(part, df, items):
        pairs = F.array(*[F.struct(F.lit(i).alias("item"), v.cast("double").alias("value")) for i, v in items])
        return df.select(F.lit(part).alias("part"), "column", F.explode(pairs).alias("_x")).select("part", "column", "_x.item", "_x.value")

    named = lambda part, df: df.select(F.lit(part).alias("part"), "column", F.col("value").alias("item"), F.col("n").cast("double").alias("value"))
    seconds = [(c, F.unix_micros(c) / 1e6) for c in stats]
    return (
        long("numeric", report["numeric"], [(c, F.col(c)) for c in [*stats, "n_na"]])
        .unionByName(named("strings", report["strings"]))
        .unionByName(named("logical", report["logical"]))
        .unionByName(long("dates", report["dates"], [*seconds, ("n_na", F.col("n_na"))]))
        .unionByName(long("missing", report["missing"], [("pct", F.col("pct"))]))
    )


def q_convert_columns(spark, sf_dir):
    """Every text column upper-cased (``across``)."""
    return convert_columns(read_table(spark, sf_dir, "customer"), StringType, F.upper)


def q_row_count(spark, sf_dir):
    """A11."""
    return count_rows(read_table(spark, sf_dir, "lineitem"))


def q_any_all(spark, sf_dir):
    """A12 per group, with a group of NULLs only."""
    part = read_table(spark, sf_dir, "part")
    test = F.when(F.col("p_brand") != "Brand#11", F.col("p_retailprice") > 1000)
    return part.groupBy("p_brand").agg(any_true(test).alias("any_large"), all_true(test).alias("all_large"))


def q_first_group(spark, sf_dir):
    """O4."""
    return first_group(read_table(spark, sf_dir, "part"), "p_brand")


def q_logical_names(spark, sf_dir):
    """X10 on entry names derived from the part names."""
    part = read_table(spark, sf_dir, "part")
    entry = F.concat("p_name", F.when(F.col("p_partkey") % 3 > 0, F.concat(F.lit("_2023-05-0"), F.col("p_partkey") % 3)).otherwise(""), F.when(F.col("p_partkey") % 6 == 1, "_12").otherwise(""), F.lit(".qs"))
    version = entry_version(entry)
    return part.select("p_partkey", logical_name(entry).alias("name"), version["date"].alias("date"), version["number"].alias("number"))


QUERIES: dict[str, Query] = {
    "trait_ids": q_trait_ids,
    "explode_by_trait": q_explode_by_trait,
    "item_overview": q_item_overview,
    "item_selected": q_item_selected,
    "keep_first": q_keep_first,
    "trait_values": q_trait_values,
    "covariates_long": q_covariates_long,
    "covariates_wide": q_covariates_wide,
    "trait_merged": q_trait_merged,
    "trait_merged_join": q_trait_merged_join,
    "trait_table": q_trait_table,
    "trait_table_long": q_trait_table_long,
    "trait_table_overflow": q_trait_table_overflow,
    "species_summary": q_species_summary,
    "group_summary_part": q_group_summary_part,
    "domain_summary": q_domain_summary,
    "null_safe_semi": q_null_safe_semi,
    "null_safe_anti": q_null_safe_anti,
    "missing_exact": q_missing_exact,
    "missing_contains": q_missing_contains,
    "union_tolerant": q_union_tolerant,
    "discard_empty": q_discard_empty,
    "select_any_of": q_select_any_of,
    "relocate": q_relocate,
    "clean_names": q_clean_names,
    "conform_records": q_conform_records,
    "nest_roundtrip": q_nest_roundtrip,
    "nest_pieces_roundtrip": q_nest_pieces_roundtrip,
    "null_profile": q_null_profile,
    "describe_numeric": q_describe_numeric,
    "describe_strings": q_describe_strings,
    "describe_strings_part": q_describe_strings_part,
    "chunks_lossless": q_chunks_lossless,
    "chunks_truncating": q_chunks_truncating,
    "head_ordered": q_head_ordered,
    "latest_snapshot": q_latest_snapshot,
    "snapshot_upkeep": q_snapshot_upkeep,
    "available_traits": q_available_traits,
    "ingest_selected": q_ingest_selected,
    "trait_table_from_export": q_trait_table_from_export,
    "clean_names_letters": q_clean_names_letters,
    "nest_user_piece": q_nest_user_piece,
    "snapshot_null_shift": q_snapshot_null_shift,
    "snapshot_renamed_column": q_snapshot_renamed_column,
    "snapshot_empty_newest": q_snapshot_empty_newest,
    "snapshot_type_change": q_snapshot_type_change,
    "snapshot_own_name_column": q_snapshot_own_name_column,
    "snapshot_numeric_name": q_snapshot_numeric_name,
    "snapshot_version_order": q_snapshot_version_order,
    "ingest_unchanged": q_ingest_unchanged,
    "chunks_written_lossless": q_chunks_written_lossless,
    "chunks_written_truncating": q_chunks_written_truncating,
    "quality_report": q_quality_report,
    "convert_columns": q_convert_columns,
    "row_count": q_row_count,
    "any_all": q_any_all,
    "first_group": q_first_group,
    "logical_names": q_logical_names,
}
