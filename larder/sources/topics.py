"""Kafka topics as raw payload rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession

from larder.sources.lineage import TOPICS, landed


def kafka_stream(spark: SparkSession, servers: str, topic: str,
                 options: Mapping[str, str] | None = None) -> DataFrame:
    """One topic from its first retained offset on.

    Needs the spark-sql-kafka package on the session.  Credentials and other reader
    settings go in ``options``.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    return reader.options(**dict(options or {})).load()


def raw_payloads(records: DataFrame, clock: Column | None = None) -> DataFrame:
    """Value as text plus topic, partition, offset and broker time, with lineage."""
    rows = records.selectExpr(
        "CAST(value AS STRING) AS raw_payload", "topic", "partition", "offset", "timestamp")
    return landed(rows, TOPICS, clock)
