"""Exact deduplication by distributed most-significant-digit radix partitioning.

A document is its length followed by its bytes.  In each round every open group is split by its
documents' next bytes: groups are counted by (group, digit), those of one document drop out, and
a group whose bytes are used up holds equal texts.  Digits grow from round to round, so a text
of n bytes takes about log(n) rounds.  No digest of a text decides anything.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import bitmap, maybe_in, reachable, stored

#: Bytes of the first digit, the growth from digit to digit, and the widest digit.
FIRST, GROWTH, WIDEST = 64, 16, 4 << 20


def normalised(text: Column) -> Column:
    """The text with each run of white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _split(cut: DataFrame, salts: int, *kept: str) -> DataFrame:
    """One round: the rows of groups (g, digit) of two members or more, under the group's new
    number ``g``, with its size and smallest id so far and the columns ``kept``.

    A group may hold a third of all rows.  Rows are counted by group, digit and salt first, and
    meet their group's new number under their own salt, so no task gets a whole large group.
    """
    cut = cut.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int"))
    part = cut.groupBy("g", "digit", "salt").agg(F.count("*").alias("c"), F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("least"))
    met = part.groupBy("g", "digit").agg(
        F.sum("c").alias("size"), F.min("least").alias("least"),
        F.collect_list("salt").alias("salts")).filter("size > 1")  # <= salts entries
    met = stored(met.select(
        "g", "digit", F.explode("salts").alias("salt"), "size", F.col("least.row").alias("new"),
        F.col("least.doc_id").alias("keep_id")), "radix-groups")
    # both sides grow with the input: the plan is the same at every size
    return stored(cut.join(met.hint("merge"), ["g", "digit", "salt"]).select(
        "row", "doc_id", F.col("new").alias("g"), "keep_id", "size", *kept), "radix-round")


def classes(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
            outputs: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id, keep_id, group_size, kept`` for every row; rows of a class have equal texts.

    Texts are compared whole, white space normalised, null as empty.  Of a class the row of the
    smallest doc_id stays, null ids last, and of rows that share that id the first one.  An
    empty table gives no rows.  ``outputs`` adds columns made of ``body``, the normalised text,
    and of the rows' own columns, which are all in the struct ``own``.

    The first round sees lengths and first bytes only; later bytes move for the rows it left.
    """
    salts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    outputs = outputs or {}
    reachable(docs.sparkSession)
    own = docs.select(F.struct("*").alias("own"), F.col(doc_id).cast("long").alias("doc_id"),
                      normalised(F.col(text)).alias("body"))
    rows = stored(own.select(
        "doc_id", F.monotonically_increasing_id().alias("row"),
        F.octet_length("body").cast("long").alias("g"), F.col("body").cast("binary").alias("bytes"),
        *(c.alias(name) for name, c in outputs.items())).withColumns({
            "digit": F.expr(f"substring(bytes, 1, {FIRST})"),
            "bytes": F.expr(f"substring(bytes, {FIRST + 1})")}), "radix-rows")
    done = _split(rows.select("row", "doc_id", "g", "digit", (F.col("g") <= FIRST).alias("ended")),
                  salts, "ended")
    ended = [done.filter("ended").select("row", "g", "keep_id", "size")]
    left = done.filter("not ended").select(F.col("row").alias("_of"), F.col("g").alias("_to"))
    open_ = rows.filter(maybe_in(F.col("row"), bitmap(left.select("_of")))).join(
        left.hint("merge"), F.col("row") == F.col("_of")).select(
        "row", "doc_id", F.col("_to").alias("g"), F.col("bytes").alias("rest"))
    width = FIRST * GROWTH
    while not left.isEmpty():
        cut = open_.select("row", "doc_id", "g", F.expr(f"substring(rest, 1, {width})").alias("digit"),
                           F.expr(f"substring(rest, {width + 1})").alias("rest"),
                           (F.octet_length("rest") <= width).alias("ended"))
        done = _split(cut, salts, "rest", "ended")
        ended.append(done.filter("ended").select("row", "g", "keep_id", "size"))
        open_ = left = done.filter("not ended").select("row", "doc_id", "g", "rest")
        width = min(width * GROWTH, WIDEST)
    met = reduce(DataFrame.unionByName, ended).withColumnsRenamed({"row": "_of", "g": "_to"})
    return rows.join(met.hint("merge"), F.col("row") == F.col("_of"), "left").select(
        "doc_id", F.when(F.col("_to").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("_to") == F.col("row"), F.lit(True)).alias("kept"), *outputs)


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """One row of each class with all its columns."""
    return classes(docs, outputs={"_row": F.col("own")}, **options).filter("kept").select("_row.*")
