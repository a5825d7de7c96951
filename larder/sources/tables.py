"""Landed document tables (``_id``, ``data``) and layer tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from larder.sources.lineage import REPLICATED, landed


def document_stream(spark: SparkSession, table: str, clock: Column | None = None) -> DataFrame:
    """New rows of a replicated table, with lineage."""
    return landed(spark.readStream.table(table), REPLICATED, clock)


def parquet_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """New files of an upstream append-only table; the schema is the table's own."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def overwrite(df: DataFrame, path: str, partition_by: tuple[str, ...] = (),
              dynamic: bool = False) -> None:
    """Write a recomputed table, with ``dynamic`` only the partitions that ``df`` has rows of.

    Partitioned output is shuffled by the partition columns with a rebalance first:
    adaptive execution then splits big partitions and merges small ones, so neither one
    writer per value nor one file per task and value comes out.
    """
    writer = df
    if partition_by:
        writer = df.hint("rebalance", *partition_by)
    writer.write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic" if dynamic else "static").partitionBy(
        *partition_by).parquet(path)
