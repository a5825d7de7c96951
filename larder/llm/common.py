"""Work folder, worker imports, bounded membership filters and connected components."""

from __future__ import annotations

import ctypes
import gc
import os
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS, BATCH_BYTES = 2_000, 4 << 20
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def reachable(spark: SparkSession) -> None:
    """Lets Python workers that share this machine's files import the package, and bounds
    what they hold at once.

    On a cluster the package is installed or sent with ``--py-files``; there the extra
    entry of the search path names nothing and changes nothing.  Arrow batches of whole
    texts get ``BATCH_ROWS`` rows and ``BATCH_BYTES`` at most, unless the session has less.
    """
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        digits, unit = re.fullmatch(r"(\d+)(\w*)", spark.conf.get(key)).groups()
        if int(digits) << {"k": 10, "m": 20, "g": 30}.get(unit[:1].lower(), 0) > most:
            spark.conf.set(key, str(most))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, *paths) if p)


_held: dict = {}
#: Gives freed memory back to the system, where the C library can.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def held(name, make):
    """What ``make`` gives, kept by this Python worker until another name is asked for.

    Workers outlive a stage.  So that the caches of the stages a worker has served do not add
    up, it keeps one at a time: the next operator's takes the place of the last one's.
    """
    if name not in _held:
        forget()
        _held[name] = make()
    return _held[name]


def forget() -> None:
    """Drops what this worker keeps, as operators do that keep nothing, and what its last task left."""
    if _held:
        _held.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def lean(made: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task that keeps nothing: it drops what the worker kept before, and gives
    back what it took itself, so that workers that wait for their next task are small."""
    forget()
    yield from made
    forget()


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names.

    A local session without that setting (a test) gets a temporary folder, a cluster an error.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read from there: cuts the lineage, so a
    lost executor repeats no finished step and no Python code runs a second time."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bitmap(keys: DataFrame, bits: int = 1 << 22) -> np.ndarray:
    """Which of ``bits`` hash positions the one column of ``keys`` takes, as packed bits.

    The driver gets distinct positions only, so at most ``bits`` integers however many keys
    there are.  With more keys than positions the filter lets more rows through, never fewer.
    """
    place = F.pmod(F.xxhash64(keys.columns[0]), F.lit(bits)).cast("int")
    found = keys.select(place.alias("at")).distinct().toArrow()["at"].to_numpy()
    flags = np.zeros(bits, np.uint8)
    flags[found] = 1
    return np.packbits(flags, bitorder="little")


def maybe_in(column, packed: np.ndarray):
    """True for every value among the keys of ``bitmap`` and for few others."""
    bits = len(packed) * 8

    @F.arrow_udf("boolean")
    def look(at: pa.Array) -> pa.Array:
        i = at.to_numpy(zero_copy_only=False)
        return pa.array((packed[i >> 3] >> (i & 7)) & 1 == 1)

    return look(F.pmod(F.xxhash64(column), F.lit(bits)).cast("int"))


def components(edges: DataFrame, label: str) -> DataFrame:
    """``node, root`` for all nodes of ``edges`` (a, b: long), root the smallest node reachable.

    Alternating large and small stars, each round written to the shared folder.  A round
    groups by node with map-side minima and joins the minima (one row per node) back, so a
    node with very many edges is split by adaptive execution.  Ends when a round changes
    nothing; loops and repeated edges do no harm.
    """
    now = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, seen = stored(now, label), None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if mark == seen:
            return _with_roots(now)
        seen = mark
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(
            F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b <> m").select(
            F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), label)


def _with_roots(stars: DataFrame) -> DataFrame:
    roots = stars.select(F.col("b").alias("node")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root")))


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text, nothing for null."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def lists(values: np.ndarray, lengths: list[int], kind: pa.DataType) -> pa.Array:
    """An Arrow list array from all values in a row and the length of each list."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
