"""Incremental landing of long trait exports (S1 + S5 as a file stream).

The original workflow has no streaming. This is the batch scan of
``sylvan.sources.export`` run as a Structured Streaming file source, so
exports that arrive in a folder are landed as parquet exactly once (the
stream's checkpoint remembers which files were processed). The trait table
and summaries then run as batch jobs on the landed data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sylvan.sources.export import ID_COLUMNS


def export_stream(spark: SparkSession, source_dir: str, schema: str, encoding: str = "ISO-8859-1"):
    """Streaming DataFrame of new tab-separated exports in ``source_dir``.

    A stream needs its schema up front (``schema`` as DDL, all text columns);
    the id columns are cast like the batch reader does. The file path and
    split start are kept for the ordinal, completed per micro-batch.
    """
    raw = (
        spark.readStream.schema(schema)
        .option("sep", "\t")
        .option("header", "true")
        .option("quote", "")
        .option("encoding", encoding)
        .option("nullValue", "NA")
        .csv(source_dir)
    )
    cols = [F.col(f"`{c}`").try_cast(ID_COLUMNS[c]).alias(c) if c in ID_COLUMNS else F.col(f"`{c}`") for c in raw.columns]
    return raw.select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), *cols
    )


def _land_batch(target_dir: str, ordinal: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        # row ids are only available on a batch DataFrame; each file is in
        # one micro-batch, so (file, split start, row id) orders rows uniquely
        order = F.struct(F.col("_file").alias("file"), F.col("_block").alias("block"), F.monotonically_increasing_id().alias("row"))
        rows = batch.select(order.alias(ordinal), *[c for c in batch.columns if c not in ("_file", "_block")])
        # one folder per batch, overwritten on replay: landing is idempotent
        rows.write.mode("overwrite").parquet(f"{target_dir}/batch_id={batch_id}")

    return write


def land_exports(
    spark: SparkSession,
    source_dir: str,
    target_dir: str,
    checkpoint_location: str,
    schema: str,
    once: bool = True,
    ordinal: str = "ord",
) -> StreamingQuery:
    """Land new exports under ``target_dir`` as parquet (``batch_id=<n>``
    folders). With ``once`` the query processes what is there and stops
    (``availableNow``)."""
    writer = (
        export_stream(spark, source_dir, schema)
        .writeStream.foreachBatch(_land_batch(target_dir, ordinal))
        .option("checkpointLocation", checkpoint_location)
    )
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")
    return writer.start()
