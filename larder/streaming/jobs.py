"""Triggered streaming jobs: append, deduplicate, split."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from larder.operators.dedup import keep_first_seen
from larder.operators.quality import REASON, SET_ASIDE_AT, VERDICT, Rules, judge
from larder.plans import silver

WATERMARK = "10 minutes"  # fixed value: how late an event may be


class LostCheckpoint(RuntimeError):
    """A table and a checkpoint that do not belong together."""


def _line(spark: SparkSession, path: str) -> str | None:
    """The first line of a small text folder, nothing if there is none."""
    try:
        row = spark.read.text(path).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return row and row[0]


def tie(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Ties a table to the checkpoint that fills it; refuses any other one.

    Batch numbers start again with a new checkpoint: a table's folders would be overwritten
    one by one, or a sink would skip the first batches as done.  Both get the same mark before
    the first batch, and a start needs both marks to agree.  A table or checkpoint from before
    there were marks is taken over, and so is one left half marked before any batch.
    """
    table, own = _line(spark, f"{path}/_owner"), _line(spark, f"{checkpoint}/_owner")
    if table is not None and table == own:
        return
    if table is None and (own is None or _line(spark, f"{checkpoint}/commits") is None):
        mark = own or str(uuid.uuid4())
        for place in (checkpoint, path):
            spark.createDataFrame([(mark,)], "value STRING").coalesce(1).write.mode(
                "overwrite").text(f"{place}/_owner")
        return
    raise LostCheckpoint(
        f"{path} was filled from another checkpoint than {checkpoint}: restore that one, or "
        "start an empty table")


def run_append(stream: DataFrame, path: str, checkpoint: str,
               name: str | None = None) -> StreamingQuery:
    """Process everything that has arrived since the last run, then stop."""
    tie(stream.sparkSession, path, checkpoint)
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    query = writer.outputMode("append").trigger(availableNow=True).start(path)
    query.awaitTermination()
    return query


def run_batches(stream: DataFrame, each: Callable[[DataFrame, int], None],
                checkpoint: str, path: str | None = None,
                name: str | None = None) -> StreamingQuery:
    """Hand every micro-batch to ``each``, which must be safe to repeat for one batch id.

    ``path`` is the table that ``each`` writes; it is tied to the checkpoint.
    """
    if path:
        tie(stream.sparkSession, path, checkpoint)
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


# -- cleaned streams ---------------------------------------------------------------

def csv_table(bronze: DataFrame, table: str, clock: Column | None = None) -> DataFrame:
    """Cleaned CSV feed; keys stay in state, so the state store should be on disk."""
    rows = silver.conform_csv(bronze, table)
    if table in silver.KEYS:
        rows = keep_first_seen(rows, silver.KEYS[table])
    return silver.stamp_csv(rows, table, clock)


def orders(bronze: DataFrame, clock: Column | None = None) -> DataFrame:
    """Broker time is event time and part of the key: state goes with the watermark."""
    rows = keep_first_seen(silver.flatten_orders(bronze), silver.KEYS["orders"],
                           "event_timestamp", WATERMARK)
    return silver.stamp(rows, clock)


def inventory(bronze: DataFrame, clock: Column | None = None,
              bounded: bool = True) -> DataFrame:
    """Event time comes from the payload and is not part of the key.

    ``bounded`` forgets a key some time after its first event; ``bounded=False`` never
    lets the same id pass twice, at the price of state that only grows.
    """
    rows = keep_first_seen(silver.flatten_inventory(bronze), silver.KEYS["inventory"],
                           "event_timestamp", WATERMARK, bounded)
    return silver.enrich_inventory(rows, clock)


def documents(bronze: DataFrame, table: str, clock: Column | None = None) -> DataFrame:
    """Flattened customer or product documents, the first one seen per key."""
    conform = {"customers": silver.conform_customers, "products": silver.conform_products}
    rows = keep_first_seen(conform[table](bronze), silver.KEYS[table])
    return silver.stamp(rows, clock)


# -- split -------------------------------------------------------------------------

def run_split(stream: DataFrame, rules: Rules, path: str, checkpoint: str,
              clock: Column | None = None) -> StreamingQuery:
    """Valid and quarantined rows from one pass over the stream.

    Valid rows get their stamps and status here, others the time they were set aside, so
    that every later read sees the same.  Each micro-batch overwrites its own folder, partitioned by the verdict, so a batch
    that is repeated after a failure leaves no copies.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        judged, now = judge(batch, rules), F.current_timestamp() if clock is None else clock
        stamps = {"pipeline_run_id": now, "processing_timestamp": now,
                  "record_status": F.lit("valid")}
        judged = judged.withColumns({
            **{c: F.when(F.col(VERDICT), v).otherwise(
                F.col(c) if c in batch.columns else F.lit(None)) for c, v in stamps.items()},
            SET_ASIDE_AT: F.when(~F.col(VERDICT), now)})
        judged.write.mode("overwrite").partitionBy(VERDICT).parquet(f"{path}/batch={batch_id}")

    return run_batches(stream, write, checkpoint, path)


def read_split(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The two sides of ``run_split``; the verdict prunes partitions."""
    rows = spark.read.parquet(path).withColumn(VERDICT, F.col(VERDICT).cast("boolean"))
    valid = rows.where(F.col(VERDICT)).drop(VERDICT, REASON, SET_ASIDE_AT, "batch")
    return valid, rows.where(~F.col(VERDICT)).drop(VERDICT, "batch")
