"""Sharding by sampled splitters: size-weighted samples, quantile boundaries, range partition."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import reachable, stored

#: Rows of a range, and sampled rows for each range.
RANGE_ROWS, SAMPLED = 200_000, 64


def _packed(k, d, row) -> np.ndarray:
    """Sortable 24-byte keys: content hash, id, row number."""
    cols = [np.asarray(x, np.int64).view(np.uint64) ^ np.uint64(1 << 63) for x in (k, d, row)]
    return np.ascontiguousarray(np.stack(cols, 1).astype(">u8")).view("S24").ravel()


def _range_of(splitters: np.ndarray):
    """The number of splitters at or before a row's key."""

    @F.arrow_udf("int")
    def made(k: pa.Array, d: pa.Array, row: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(splitters, _packed(k, d, row), "right").astype(np.int32))

    return made("k", "d", "row")


def _splitters(sample: list, target: float) -> list[bytes]:
    """Quantile boundaries of a weighted sample, one for each ``target`` bytes."""
    if not sample:
        return []
    keys = _packed(*(np.array([r[c] for r in sample], np.int64) for c in ("k", "d", "row")))
    weight = np.array([r["weight"] for r in sample], float)
    order = np.argsort(keys)
    keys, run = keys[order], np.cumsum(weight[order])
    steps = np.arange(target, run[-1], target)
    return [bytes(x) for x in np.unique(keys[np.minimum(np.searchsorted(run, steps), len(keys) - 1)])]


def rows_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32`` and the sort key ``k, d, row`` of every row."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(body) + F.lit(1)).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"), F.xxhash64(body).alias("k"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))).alias("d"),
        F.monotonically_increasing_id().alias("row"))


def shards(docs: DataFrame, n: int = 8, *, doc_id: str = "doc_id", text: str = "text",
           slack: float = 0.002, range_rows: int = RANGE_ROWS, seed: int = 11) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot, at_range`` per row; shards of near equal bytes.

    Rows are ordered by content hash, id and row number.  Splitters from a sample, drawn in
    proportion to size, cut that order into ranges; a range that turns out over twice its share
    is sampled again and subdivided, down to single rows.  Exact range totals then place every
    row on one line of bytes, which is cut into ``n`` equal parts.  Rows of equal text stay in
    one shard if all of them make up at most ``slack`` of a shard; a larger group is cut where
    the line is cut.  A row or group goes where its middle lies, so a shard's bytes differ from
    the mean by a ``slack`` and a document at most.  Null text has size 1, null and repeated ids are kept, an empty table gives no rows.
    """
    reachable(docs.sparkSession)
    rows = stored(rows_of(docs, doc_id, text), "shard-rows")
    count, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = max(8 * n, -(-count // range_rows))
    target, cuts = max(total / ranges, 1.0), []
    sampled = lambda df, share: (df.withColumn("p", F.least(F.lit(1.0), F.col("size") * share))
                                 .filter(F.rand(seed) < F.col("p"))
                                 .select("k", "d", "row", (F.col("size") / F.col("p")).alias("weight"))
                                 .collect())
    cuts = _splitters(sampled(rows, SAMPLED / target), target)
    for _ in range(8):
        placed = rows.withColumn("range", _range_of(np.array(cuts, "S24")))
        totals = placed.groupBy("range").agg(F.sum("size").alias("b"), F.count("*").alias("c"))
        large = [r["range"] for r in totals.filter((F.col("b") > 2 * target) & (F.col("c") > 1))
                 .collect()]
        if not large:
            break
        again = sampled(placed.filter(F.col("range").isin(large)), 4 * SAMPLED / target)
        more = sorted({*cuts, *_splitters(again, target)})
        if more == cuts:
            break
        cuts = more
    placed = stored(placed, "shard-ranges")
    each = placed.groupBy("range").agg(F.sum("size").alias("b"))
    base = each.select("range", (F.sum("b").over(Window.orderBy("range")) - F.col("b")).alias("base"))
    line = Window.partitionBy("range").orderBy("k", "d", "row")
    at = placed.join(base, "range").withColumn(
        "at", F.col("base") + F.sum("size").over(line) - F.col("size"))
    at = stored(at.select("doc_id", "size", "text_crc32", "k", "d", "row", "range", "at"), "shard-line")
    group = at.groupBy("k").agg(F.sum("size").alias("g"), F.min("at").alias("from"),
                                F.count("*").alias("c")).filter(
        (F.col("c") > 1) & (F.col("g") <= slack * total / n)).select("k", "from", "g")
    middle = F.coalesce(F.col("from") + F.col("g") / 2, F.col("at") + F.col("size") / 2)
    share = middle * F.lit(n) / F.lit(max(total, 1))
    dealt = at.join(group, "k", "left").withColumn(
        "shard", F.least(F.lit(n - 1), F.floor(share)).cast("int"))
    dealt = stored(dealt.drop("from", "g"), "shard-dealt")
    parts = dealt.groupBy("shard", "range").agg(F.count("*").alias("c"))
    before = parts.select("shard", "range", (F.sum("c").over(
        Window.partitionBy("shard").orderBy("range")) - F.col("c")).alias("before"))
    place = Window.partitionBy("shard", "range").orderBy("k", "d", "row")
    return dealt.join(before, ["shard", "range"]).select(
        "doc_id", "size", "text_crc32", "shard",
        (F.row_number().over(place) - 1 + F.col("before")).cast("long").alias("slot"),
        F.col("range").alias("at_range"))
