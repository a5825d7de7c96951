"""Columns that say where a landed row came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from larder.functions.scalar import last_path_segment

# Source tags. Landed tables carry the tag of the replication tool.
FILES = "adls"
TOPICS = "kafka"
DOCUMENTS = "mongodb"
REPLICATED = "fivetran"
KNOWN_TAGS = (FILES, TOPICS, DOCUMENTS)


def landed(df: DataFrame, source: str, clock: Column | None = None) -> DataFrame:
    now = F.current_timestamp() if clock is None else clock
    return df.withColumns({"ingestion_timestamp": now, "_source_system": F.lit(source)})


def landed_file(df: DataFrame, source: str = FILES, clock: Column | None = None) -> DataFrame:
    """Adds path, file name, load time and tag; needs a file source's ``_metadata``."""
    path = F.col("_metadata.file_path")
    named = df.select("*", path.alias("source_file_path"),
                      last_path_segment(path).alias("source_file_name"))
    return landed(named, source, clock)
