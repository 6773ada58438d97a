"""Long trait export: tab-separated text scan with a file ordinal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ID_COLUMNS = {"TraitID": "int", "DataID": "int", "ObservationID": "bigint"}


def read_trait_export(
    spark: SparkSession,
    path: str | list[str],
    ordinal: str = "ord",
    encoding: str = "ISO-8859-1",
) -> DataFrame:
    """Scan a tab-separated export with a header; all columns as text, the id
    columns as integers (NULL when blank or not a number).

    ``ordinal`` is a total order equal to file order: (file path, split start,
    row id inside the split). It is exact across splits of one file and
    across files, but it is only stable for one scan, so land the export as
    parquet (``land_export``) before using it in several jobs.
    """
    raw = (
        spark.read.option("sep", "\t")
        .option("header", "true")
        .option("quote", "")
        .option("encoding", encoding)
        .option("nullValue", "NA")
        .option("inferSchema", "false")
        .csv(path)
    )
    order = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    casts = [
        F.col(f"`{c}`").try_cast(t).alias(c) if c in ID_COLUMNS else F.col(f"`{c}`")
        for c in raw.columns
        for t in [ID_COLUMNS.get(c)]
    ]
    return raw.select(order.alias(ordinal), *casts)


def land_export(df: DataFrame, path: str, ordinal: str = "ord") -> None:
    """Write the scanned export as parquet, ordinal included, so later jobs
    read a stable order (and get column pruning and predicate pushdown)."""
    df.write.mode("overwrite").parquet(path)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
