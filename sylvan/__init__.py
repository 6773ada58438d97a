"""sylvan: Spark DataFrame operators for entity-attribute-value trait exports.

Every operator is a plain function ``DataFrame -> DataFrame`` built from the
DataFrame API, so Catalyst plans, prunes and pushes down the whole chain.
"""

from sylvan.session import checkpoint_dir, get_session
from sylvan.operators.summaries import describe_numeric, describe_strings, group_summary, null_profile, summary_of_summaries
from sylvan.plans.records import combine_sources, conform_records, quality_report, write_chunks
from sylvan.plans.traits import trait_table
from sylvan.sources.export import land_export, read_trait_export

__all__ = [
    "get_session",
    "checkpoint_dir",
    "read_trait_export",
    "land_export",
    "trait_table",
    "group_summary",
    "summary_of_summaries",
    "describe_numeric",
    "describe_strings",
    "null_profile",
    "combine_sources",
    "conform_records",
    "quality_report",
    "write_chunks",
]
