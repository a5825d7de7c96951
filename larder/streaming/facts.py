"""Deduplicated fact streams without state: a batch is compared with what has landed.

A fact's key holds its business date.  Landed rows lie in one folder per period of that date and
micro-batch, so a batch looks for its keys in the folders of its own periods only.  A period is
a day, or a month where days are many and small.  No state is carried from
batch to batch, however long the stream runs, and a copy is dropped however late it comes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from larder.operators import quality
from larder.operators.dedup import keep_first
from larder.plans import silver
from larder.streaming.jobs import run_batches

#: Partition columns of the landed table.
PERIOD, BATCH = "_period", "_landed_batch"
_KEY = "_key"
GRAINS = {"day": lambda date: date.cast("date"), "month": lambda date: F.trunc(date, "MONTH")}
DATES = {"transactions": "transaction_date", "returns": "return_date"}


def run_facts(bronze: DataFrame, table: str, path: str, checkpoint: str,
              order_by: Sequence[str | Column] = (), clock: Column | None = None,
              grain: str = "day", name: str | None = None, watch=None) -> StreamingQuery:
    """Clean all rows of a fact feed that have arrived and land the new keys, then stop.

    ``order_by`` says which copy within a batch survives; without it the least row.  ``watch``
    (``larder.streaming.watch.Watch``) logs counts and expectations of what is written.
    """
    keys, date = list(silver.KEYS[table]), DATES[table]

    def each(batch: DataFrame, batch_id: int) -> None:
        new = silver.stamp_csv(unseen(batch, batch_id, path, keys, date, order_by, grain), table, clock)
        if watch is None:
            land(new, batch_id, path, date, grain)
            return
        # counted where the rows are written: a batch's own plan runs more than once
        seen, rules = Observation(), quality.WARNINGS.get(table, {})
        land(quality.observe_rules(new, rules, seen), batch_id, path, date, grain)
        watch.record("silver", table, rules, seen.get, f"silver.{table}", batch_id)

    return run_batches(silver.conform_csv(bronze, table), each, checkpoint, path, name)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(PERIOD, BATCH)


def stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """New landed rows; the schema is the table's own."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).drop(PERIOD, BATCH)


def landed_keys(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str],
                periods: DataFrame, batch_id: int) -> DataFrame | None:
    """Keys that earlier batches landed in these ``periods``; other folders are not read."""
    shape = T.StructType([*(schema[k] for k in keys), T.StructField(PERIOD, T.DateType()),
                          T.StructField(BATCH, T.IntegerType())])
    dates = [r[0] for r in periods.collect()]  # those of one batch
    known = [F.lit(d) for d in dates if d is not None]
    wanted = F.col(PERIOD).isin(known) if known else F.lit(False)
    if None in dates:
        wanted = wanted | F.col(PERIOD).isNull()
    try:
        rows = spark.read.schema(shape).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return rows.where(wanted & (F.col(BATCH) < batch_id)).select(*keys)


def unseen(batch: DataFrame, batch_id: int, path: str, keys: Sequence[str], date: str,
           order_by: Sequence[str | Column] = (), grain: str = "day") -> DataFrame:
    """One row for each key of the batch that no earlier batch landed; NULL keys are equal.

    The key is one struct, whose equal NULL fields match, in both steps: rows that were shuffled and
    sorted by it to find the first of each key meet the landed keys where they are.
    """
    key = F.struct(*keys).alias(_KEY)
    first = keep_first(batch.select("*", key), [_KEY], order_by or [F.struct(*batch.columns)])
    periods = batch.select(GRAINS[grain](F.col(date)).alias(PERIOD)).distinct()
    seen = landed_keys(batch.sparkSession, path, batch.schema, keys, periods, batch_id)
    if seen is not None:
        first = first.join(seen.select(key), _KEY, "left_anti")
    return first.select(*batch.columns)


def land(rows: DataFrame, batch_id: int, path: str, date: str, grain: str = "day") -> None:
    """Write a batch's folders, one per period; a repeated batch overwrites just these."""
    placed = rows.withColumns({PERIOD: GRAINS[grain](F.col(date)), BATCH: F.lit(batch_id)})
    (placed.hint("rebalance", PERIOD).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(PERIOD, BATCH).parquet(path))
