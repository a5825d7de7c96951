"""One row per key, in batch and in streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def keep_first(df: DataFrame, keys: Sequence[str],
               order_by: Sequence[str | Column]) -> DataFrame:
    """The first row of each key under ``order_by``; NULL keys count as equal.

    Spark turns the rank filter into a group limit that runs before the shuffle, so
    each map task sends at most one row per key and a hot key costs no more than any
    other one.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order_by)
    return (
        df.withColumn("_rank", F.row_number().over(ranked))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def keep_first_seen(stream: DataFrame, keys: Sequence[str], event_time: str | None = None,
                    delay: str = "10 minutes", bounded: bool = True) -> DataFrame:
    """Deduplicate a stream.

    * no ``event_time``: every key stays in state for ever (reference tables only);
    * ``event_time`` among the keys: state is dropped once the watermark passes it;
    * ``event_time`` outside the keys: ``bounded`` keeps each key for ``delay`` after
      its first event; without it the state is never dropped.
    """
    keys = list(keys)
    if event_time is None:
        return stream.dropDuplicates(keys)
    marked = stream.withWatermark(event_time, delay)
    if event_time in keys or not bounded:
        return marked.dropDuplicates(keys)
    return marked.dropDuplicatesWithinWatermark(keys)
