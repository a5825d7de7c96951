"""Corpus pipeline over ``documents``: each stage reads what its predecessor wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import byte_bpe, hyper_language, simhash, substring, templates
from larder.llm.common import bitmap, maybe_in, reachable, stored

#: Near copies share this part of their distinct five-word shingles.  Their fingerprints differ in
#: 39 of 256 bits on average at that similarity; those within ``NEAR_BLOCKS`` are looked at.
NEAR = (4, 5)
NEAR_BLOCKS = simhash.Blocks(distance=64, words=4, views=6)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those that are in no language learned from ``lang``
    beyond doubt: long enough to tell, and no nearer to any than noise.  Short documents stay,
    and so do all if there is nothing to learn from."""
    reachable(spark)
    return docs.filter(hyper_language.learned(F.col("text"), hyper_language.fit(docs)))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near copies the documents of smallest id; of rows equal in id and
    text one.  Documents without an id stay.  Fingerprints find the pairs, shingles verify them."""
    key = F.xxhash64("doc_id", "text")
    found = stored(simhash.groups(docs, width=5, blocks=NEAR_BLOCKS, key=key, least=NEAR), "near-copies")
    gone = found.filter("component_id <> doc_id").select("key").distinct()
    again = found.filter("doc_id is not null").groupBy("key").count().filter("count > 1")
    marked = stored(gone.withColumn("gone", F.lit(True)).unionByName(
        again.join(gone, "key", "left_anti").select("key", F.lit(False).alias("gone"))), "marked")
    held = docs.withColumn("_key", key).withColumn(
        "_maybe", maybe_in(F.col("_key"), bitmap(marked.select("key"))))
    judged = held.filter("_maybe").join(marked.selectExpr("key AS _marked", "gone AS _gone"),
                                        F.col("_key") == F.col("_marked"), "left")
    single = judged.filter("_gone is null").select(docs.columns)
    one = judged.filter("not _gone").dropDuplicates(["_key"]).select(docs.columns)
    return held.filter(~F.col("_maybe")).select(docs.columns).unionByName(single).unionByName(one)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 50 words or more that a smaller document has; what is left without
    words goes.  A text without such passages stays as it is."""
    return substring.cut(docs, window=50)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that ask a benchmark item again, word for word or with other values."""
    return templates.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids``; the ids decode to the text's bytes (checked in each row)."""
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    reachable(spark)
    made = docs.select("doc_id", "text", byte_bpe.encode(F.col("text"), ranks, pattern).alias("ids"))
    back = byte_bpe.decode(F.col("ids"), ranks, pattern)
    same = back == F.coalesce("text", F.lit("")).cast("binary")
    return made.withColumn("same", same).select(
        "doc_id", F.when(F.col("same"), F.size("ids").cast("long")).otherwise(F.raise_error(
            "ids do not decode to their text").cast("long")).alias("n_tokens"), "ids")


STAGES = [("language", language), ("near_copies", near_copies),
          ("repeated_passages", repeated_passages), ("benchmark_free", benchmark_free),
          ("encoded", encoded)]

#: No SQL states the trained language profiles; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
