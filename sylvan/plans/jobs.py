"""The three workflows of the original as Spark jobs.

    spark-submit --py-files sylvan.zip sylvan/plans/jobs.py traits  <export path> <output root>
    spark-submit --py-files sylvan.zip sylvan/plans/jobs.py ingest  <record source parquet> <record root>
    spark-submit --py-files sylvan.zip sylvan/plans/jobs.py records <record root> <output root>

Each job reads, transforms and writes on the executors; the driver only
receives small results (key sets, names, summaries it prints).
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession

from sylvan.operators.summaries import group_summary, summary_of_summaries
from sylvan.plans.records import combine_sources, conform_records, quality_report, write_record_chunks
from sylvan.plans.traits import trait_table
from sylvan.session import Scratch
from sylvan.sources.catalog import WANTED_TRAITS
from sylvan.sources.export import land_export, read_trait_export
from sylvan.sources.records import ingest_traits, read_record_source
from sylvan.sources.snapshots import SNAPSHOT, read_latest, save_snapshot


def trait_export_job(
    spark: SparkSession, export_path: str, out_root: str, as_: str = "map", min_n: int = 50
) -> dict[str, DataFrame]:
    """Text export -> landed parquet -> trait table -> snapshot
    ``data_trait`` (preset ``high``) -> species and domain summaries, saved as
    snapshots as well. Intermediates are gone when the job returns."""
    landed = f"{out_root}/landed_export"
    snapshots = f"{out_root}/snapshots"
    land_export(read_trait_export(spark, export_path), landed)
    stored = lambda name: read_latest(spark, snapshots, [name]).drop(SNAPSHOT)
    with Scratch(spark, "trait-export") as scratch:
        save_snapshot(trait_table(spark.read.parquet(landed), as_=as_, scratch=scratch), snapshots, "data_trait", preset="high")
        species = group_summary(stored("data_trait"), ["trait_domain", "acc_species_name"], "trait_value")
        save_snapshot(species, snapshots, "species_summary")
        domains = summary_of_summaries(stored("species_summary"), "trait_domain", min_n, scratch=scratch)
        save_snapshot(domains, snapshots, "domain_summary")
    return {"table": stored("data_trait"), "species": stored("species_summary"), "domains": stored("domain_summary")}


def ingest_job(spark: SparkSession, source_path: str, record_root: str, force: bool = False) -> list[str]:
    """Store the wanted traits that are not stored yet (one write)."""
    source = read_record_source(spark, path=source_path)
    return ingest_traits(source, WANTED_TRAITS, record_root, force=force, preset="archive")


def records_job(spark: SparkSession, record_root: str, out_root: str, n_chunks: int = 4) -> dict[str, DataFrame]:
    """Newest stored sources -> drop empty ones -> union -> conform ->
    quality report -> chunks ``data_traits_<k>`` under ``out_root``, traits in
    order of first appearance and rows in file order inside each."""
    records = conform_records(combine_sources(spark, record_root, ordinal="ord"), ordinal="ord")
    write_record_chunks(records, out_root, "data_traits", "ord", n_chunks=n_chunks)
    records = records.drop("ord")
    return {"records": records, **quality_report(records)}


def main(argv: list[str]) -> None:
    from sylvan import get_session

    spark = get_session()
    kind, src, dst = argv[1], argv[2], argv[3]
    if kind == "traits":
        out = trait_export_job(spark, src, dst)
        out["domains"].show(truncate=False)
    elif kind == "ingest":
        print(ingest_job(spark, src, dst))
    elif kind == "records":
        out = records_job(spark, src, dst)
        out["missing"].show(truncate=False)
    else:
        raise SystemExit("usage: jobs (traits|ingest|records) <input> <output>")


if __name__ == "__main__":
    main(sys.argv)
