"""CSV feeds: everything lands as text, new columns are added, bad lines are kept."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from larder.sources.lineage import FILES, landed_file

CORRUPT = "_corrupt_record"


def text_schema(columns: Sequence[str], corrupt: bool = False) -> T.StructType:
    names = [*columns, CORRUPT] if corrupt else list(columns)
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# A header must name the declared columns in their order: Spark binds CSV columns by
# position and would otherwise swap values without a word.
_STRICT = {"header": "true", "enforceSchema": "false", "columnNameOfCorruptRecord": CORRUPT}


def csv_stream(spark: SparkSession, path: str, columns: Sequence[str],
               max_files: int | None = None, corrupt: bool = False, source: str = FILES,
               clock: Column | None = None) -> DataFrame:
    """New CSV files as a stream with lineage columns.

    A file with another header than ``columns`` stops the stream; read folders with
    several headers by ``csv_evolving``.  ``corrupt`` adds a column with the text of lines
    that do not fit the header.
    """
    reader = spark.readStream.options(**_STRICT).schema(text_schema(columns, corrupt))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return landed_file(reader.csv(path), source, clock)


def csv_batch(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str],
              corrupt: bool = False) -> DataFrame:
    """The same files in one go, without lineage."""
    return spark.read.options(**_STRICT).schema(text_schema(columns, corrupt)).csv(path)


def csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """A source folder with guessed types, for reconciliation against what landed."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def file_headers(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """(path, header) of every file below ``path``.

    The listing yields paths only; tasks then open each file for its first line.
    """
    def first_lines(batches: Iterable) -> Iterator:
        for batch in batches:
            lines = []
            for uri in batch["path"]:
                system, name = pyarrow.fs.FileSystem.from_uri(uri.replace("s3a://", "s3://"))
                with system.open_input_file(name) as handle:
                    lines.append(_first_line(handle))
            yield batch.assign(header=lines)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    listed = files.select("path").where(~F.col("path").rlike("/[_.][^/]*$"))
    return listed.mapInPandas(first_lines, "path string, header string").where(
        "header <> ''").select("path", F.split("header", sep).alias("header"))


def _first_line(handle, block: int = 4096) -> str:
    data = b""
    while b"\n" not in data:
        more = handle.read(block)
        if not more:
            break
        data += more
    return data.split(b"\n", 1)[0].decode("utf-8-sig").strip()


def csv_evolving(spark: SparkSession, path: str) -> DataFrame:
    """All CSV files below ``path`` under the union of their headers.

    Files are read in cohorts of equal header and united by name, so columns may be
    added or change place; a column a file does not have is NULL in its rows.  The
    driver holds file names and one plan branch per distinct header, no data.
    """
    cohorts = (
        file_headers(spark, path)
        .groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths"))
        .orderBy(F.size("header"), "header")
        .collect()
    )
    if not cohorts:
        raise FileNotFoundError(f"no CSV file with a header below {path}")
    frames = (csv_batch(spark, list(c["paths"]), list(c["header"])) for c in cohorts)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
