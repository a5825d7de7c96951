"""Token ids as ORC: run-length coded integers, row indexes, Bloom filters on document ids.

Files follow each other in ascending id order and so do the rows in them.  Each row knows how
many ids stand before it in its file, so the place of any document needs the files' totals only.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.llm.common import lists, reachable
from larder.llm.segments import memo

SCHEMA = "doc_id long, part int, before long, ids array<int>"


def encoded(docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text",
            end_id: int = 2) -> DataFrame:
    """``doc_id, part, before, ids``: the ids of each text and ``end_id``, ranges of ascending
    ids.  A null text is empty; a null id comes first; rows of one id, repeated ones too, go by
    their place in the input, so that a very common id is dealt to many ranges.  Ranges are
    sampled from ids and places alone, texts are read once.  A text of any length is one row;
    other columns are left out, and an empty table gives no rows."""
    reachable(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    rows = rows.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row")

    def encode(batches):
        known, before, part = memo(tokenizer), 0, TaskContext.get().partitionId()
        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            made = [known.ids(t or "") + end for t in batch.column("text").to_pylist()]
            sizes = [len(x) // 4 for x in made]
            starts = before + np.concatenate(([0], np.cumsum(sizes[:-1], dtype=np.int64)))
            before += sum(sizes)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"),
                "part": pa.array(np.full(len(made), part, np.int32)),
                "before": pa.array(starts[:len(made)].astype(np.int64)),
                "ids": lists(np.frombuffer(b"".join(made), "<i4"), sizes, pa.int32())})

    return rows.select("doc_id", "text").mapInArrow(encode, SCHEMA)


def write(rows: DataFrame, path: str, *, stripe_bytes: int = 16 << 20, stride: int = 10_000,
          false_positives: float = 0.01) -> None:
    """One file per range.  Readers split files between stripes; the row index keeps the least
    and greatest id of every ``stride`` rows and a Bloom filter of them."""
    (rows.write.option("orc.stripe.size", stripe_bytes)
     .option("orc.row.index.stride", stride)
     .option("orc.bloom.filter.columns", "doc_id")
     .option("orc.bloom.filter.fpp", false_positives)
     .option("orc.dictionary.key.threshold", 0)
     .option("compression", "zstd").orc(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids``: start counts the ids of all documents before, over all files.

    The files' totals are one row a file; only these are put in one order.  They are broadcast:
    files are the partitions of one shuffle, and a million of those would be 24 MB.
    """
    rows = spark.read.schema(SCHEMA).orc(path)
    totals = rows.groupBy("part").agg(F.sum(F.size("ids")).alias("total"))
    base = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total"))
                         .alias("base"))
    return rows.join(F.broadcast(base), "part").select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "ids")


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The rows of some documents; stripes and row groups that cannot hold them are not read."""
    return spark.read.schema(SCHEMA).orc(path).filter(F.col("doc_id").isin(doc_ids))


def crc32(ids):
    """Unsigned crc32 of a list's ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("long")
    def made(column: pa.Array) -> pa.Array:
        values = column.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        ends = np.cumsum([0, *column.value_lengths().to_pylist()])
        return pa.array([zlib.crc32(values[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.int64())

    return made(ids)
