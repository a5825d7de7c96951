"""CSV feeds whose headers change while the stream runs.

Files are read as lines, and every line is taken apart by the header of its own file, so columns
may be added, left out or change place from file to file.  Below the table's path lie

* ``rows``    -- the landed rows, one folder per micro-batch, all columns text;
* ``files``   -- one row per file: its header and which field goes to which column;
* ``columns`` -- the registry: the columns that each micro-batch brought, in order.

A micro-batch overwrites its own folders only, so a repeated one changes nothing, and the
registry depends on the batches alone.  The driver sees names of columns and two numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from larder.sources.lineage import FILES, landed
from larder.functions.scalar import last_path_segment
from larder.streaming.jobs import run_batches

RESCUED = "_rescued_data"
MAX_FILES = 1_000  # of one micro-batch; their headers are broadcast

_LINEAGE = (("source_file_path", T.StringType()), ("source_file_name", T.StringType()),
            ("ingestion_timestamp", T.TimestampType()), ("_source_system", T.StringType()))
_RESERVED = {RESCUED, "batch", *(n for n, _ in _LINEAGE)}


def run_landing(spark: SparkSession, folder: str, path: str, checkpoint: str,
                columns: Sequence[str] = (), evolve: bool = True, sep: str = ",",
                max_files: int = MAX_FILES, source: str = FILES,
                clock: Column | None = None) -> StreamingQuery:
    """Land all CSV files that have arrived below ``folder``, then stop.

    ``columns`` are there from the start.  A header's further columns are added to the table,
    NULL in other files' rows; with ``evolve=False`` the table keeps its columns and the fields
    of others go to ``_rescued_data`` by name.  So do, in either case, fields beyond the header
    (``_c5`` is the sixth field) and those whose name the lineage columns have.  Names are
    compared without case; a second column of one name gets its position added, a nameless one
    is called ``_c`` and its position.  Short lines end in NULLs, blank lines are left out.
    """
    lines = (spark.readStream.format("text").option("maxFilesPerTrigger", max_files).load(folder)
             .select("value", F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("block")))

    def each(batch: DataFrame, batch_id: int) -> None:
        _land(batch, batch_id, path, list(columns), evolve, sep, source, clock)

    return run_batches(lines, each, checkpoint, path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The landed rows under all columns that the registry knows."""
    return spark.read.schema(_schema(spark, path)).parquet(f"{path}/rows").drop("batch")


def stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """New landed rows under the columns known when the stream starts."""
    reader = spark.readStream.schema(_schema(spark, path))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{path}/rows").drop("batch")


def files(spark: SparkSession, path: str) -> DataFrame:
    """``file, header, rows`` of every landed file; ``rows`` counts its lines below the header."""
    return spark.read.parquet(f"{path}/files").select("file", "header", "rows", "batch")


def known_columns(spark: SparkSession, path: str, before: int | None = None) -> list[str]:
    """The registered columns in the order they came, of the batches ``before`` one."""
    rows = spark.read.schema("place INT, name STRING, batch INT").parquet(f"{path}/columns")
    if before is not None:
        rows = rows.where(F.col("batch") < before)
    return [r["name"] for r in rows.orderBy("batch", "place").collect()]  # one row a column


# -- parts -------------------------------------------------------------------------

def _schema(spark: SparkSession, path: str) -> T.StructType:
    named = [(c, T.StringType()) for c in (*known_columns(spark, path), RESCUED)]
    return T.StructType([T.StructField(n, t) for n, t in (
        *named, *_LINEAGE, ("batch", T.IntegerType()))])


def _fields(width: int) -> str:
    return ", ".join(f"c{i} STRING" for i in range(width))


def _array(parsed: str, width: int) -> Column:
    return F.array(*(F.col(f"{parsed}.c{i}") for i in range(width)))


def _options(sep: str, width: int) -> dict[str, str]:
    return {"sep": sep, "maxColumns": str(max(20_480, width + 1))}


def _land(batch: DataFrame, batch_id: int, path: str, columns: list[str], evolve: bool,
          sep: str, source: str, clock: Column | None) -> None:
    spark = batch.sparkSession
    # ids ascend in a split, and a header is the first line of its file's first split
    lines = batch.withColumn("place", F.monotonically_increasing_id()).withColumn(
        "fields", F.length("value") - F.length(F.replace("value", F.lit(sep))) + 1)
    heads = _headers(lines, sep)
    known = _registered(spark, path, batch_id, columns)
    if evolve:
        known += _new_columns(heads, known)
    _register(spark, path, batch_id, known)
    own = f"{path}/files/batch={batch_id}"
    _mapped(heads, known).write.mode("overwrite").parquet(own)
    mapped = spark.read.parquet(own)
    width, most = mapped.agg(F.max(F.size("header")), F.max("most")).first()
    if width is None:
        return
    kept = lines.join(F.broadcast(mapped), "file").where(
        (F.trim("value") != "") & ~((F.col("block") == 0) & (F.col("place") == F.col("first"))))
    parsed = kept.withColumns({
        "_p": F.from_csv("value", _fields(width), _options(sep, width)),
        "_w": F.when(F.col("fields") > F.size("header"),
                     F.from_csv("value", _fields(most), _options(sep, most)))})
    rows = parsed.withColumn("_f", _array("_p", width)).select(
        *(F.get("_f", F.col("at")[i] - 1).alias(c) for i, c in enumerate(known)),
        _rescued(most).alias(RESCUED), F.col("file").alias("source_file_path"),
        last_path_segment(F.col("file")).alias("source_file_name"))
    landed(rows, source, clock).write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")


def _headers(lines: DataFrame, sep: str) -> DataFrame:
    """``file, header, first, rows, most``: the header's names, its place, the file's lines
    below it and the most fields a line can have."""
    heads = lines.where(F.trim("value") != "").groupBy("file").agg(
        F.expr("min_by(struct(value, place, fields), place) FILTER (WHERE block = 0)").alias("h"),
        (F.count(F.lit(1)) - 1).alias("rows"), F.max("fields").alias("most"))
    width = heads.agg(F.max("h.fields")).first()[0] or 1
    text = F.regexp_replace("h.value", "^﻿", "")
    parsed = heads.withColumn("_p", F.from_csv(text, _fields(width), _options(sep, width)))
    cut = parsed.withColumn("_f", F.slice(_array("_p", width), 1, F.col("h.fields")))
    named = F.transform("_f", lambda n, i: F.coalesce(
        F.when(F.trim(n) != "", F.trim(n)), F.concat(F.lit("_c"), i.cast("string"))))
    low = F.transform("_n", lambda n: F.lower(n))
    single = F.transform("_n", lambda n, i: F.when(
        F.array_position("_l", F.lower(n)) == i + 1, n).otherwise(F.concat(n, i.cast("string"))))
    return cut.withColumn("_n", named).withColumn("_l", low).select(
        "file", single.alias("header"), F.col("h.place").alias("first"), "rows",
        F.greatest("most", F.col("h.fields")).alias("most"))


def _registered(spark: SparkSession, path: str, batch_id: int, columns: list[str]) -> list[str]:
    if batch_id == 0:
        return list(columns)
    known = known_columns(spark, path, batch_id)
    low = {c.lower() for c in known}
    return known + [c for c in columns if c.lower() not in low]


def _new_columns(heads: DataFrame, known: list[str]) -> list[str]:
    """Names that no column has yet, by their place in the headers, then by name."""
    seen = [c.lower() for c in known] + [c.lower() for c in _RESERVED]
    new = (heads.select(F.posexplode("header").alias("place", "name"))
           .where(~F.lower("name").isin(seen)).groupBy(F.lower("name").alias("low"))
           .agg(F.min(F.struct("place", "name")).alias("m")).orderBy("m").select("m.name").collect())
    return [r["name"] for r in new]


def _register(spark: SparkSession, path: str, batch_id: int, known: list[str]) -> None:
    before = known_columns(spark, path, batch_id) if batch_id else []
    new = [(i, c) for i, c in enumerate(known[len(before):])]
    spark.createDataFrame(new, "place INT, name STRING").coalesce(1).write.mode(
        "overwrite").parquet(f"{path}/columns/batch={batch_id}")


def _mapped(heads: DataFrame, known: list[str]) -> DataFrame:
    """Adds ``at``, the 1-based field of each known column in the file (0: none), and ``spare``,
    the fields that no column takes."""
    low = F.transform("header", lambda n: F.lower(n))
    at = F.array(*(F.array_position("_l", F.lit(c.lower())).cast("int") for c in known))
    taken = F.array(*(F.lit(c.lower()) for c in known)) if known else F.expr("array('')")
    pairs = F.transform("header", lambda n, i: F.struct(n.alias("name"), i.alias("at")))
    spare = F.filter(pairs, lambda p: ~F.array_contains(taken, F.lower(p["name"])))
    return heads.withColumn("_l", low).withColumn(
        "at", at if known else F.expr("CAST(array() AS ARRAY<INT>)")).withColumn(
        "spare", spare).drop("_l")


def _rescued(most: int) -> Column:
    """Fields without a column as JSON, by name; NULL where there is none."""
    spare = F.transform("spare", lambda s: F.struct(
        s["name"].alias("name"), F.get("_f", s["at"]).alias("value")))

    def surplus(i: Column) -> Column:
        name = F.concat(F.lit("_c"), i.cast("string"))
        return F.struct(F.when(F.array_contains("header", name), F.concat(name, F.lit("_")))
                        .otherwise(name).alias("name"), F.get(_array("_w", most), i).alias("value"))

    beyond = F.when(F.col("_w").isNotNull(), F.transform(
        F.sequence(F.size("header"), F.lit(most - 1)), surplus)).otherwise(
        F.expr("CAST(array() AS ARRAY<STRUCT<name: STRING, value: STRING>>)"))
    found = F.filter(F.concat(spare, beyond), lambda p: p["value"].isNotNull())
    return F.when(F.size(found) > 0, F.to_json(F.map_from_entries(found)))
