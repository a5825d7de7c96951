"""Token counts of documents of any length: overlapping chunks, spliced where they agree.

A long text is cut into chunks that overlap.  Each chunk is encoded by itself, wherever Spark
puts it, and reports how many tokens stand before the places in its two overlaps where a token
run starts for certain: a step from a visible character to white space, or between two pieces
of the library's own split.  A place that both neighbours report is a true boundary of the
whole text: the left chunk has read the text from a true boundary on, and splitting looks no
further back than its last boundary and no further ahead than one character.  Places so near a
chunk's end that a cut special string could reach them do not count.  If two neighbours share
no place, the document is cut again with wider overlaps, at last into one chunk.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import reachable, stored
from larder.llm.segments import _LONGEST, memo

#: Longer than any special token of the vocabularies.
MARGIN = 64


def token_count(text, tokenizer: str):
    """Tokens of a text column in one piece; null counts as empty."""

    @F.arrow_udf("long")
    def made(texts: pa.Array) -> pa.Array:
        known = memo(tokenizer)
        return pa.array([len(known.ids(t)) // 4 if t else 0 for t in texts.to_pylist()], pa.int64())

    return made(text)


def boundaries(known, text: str) -> list[tuple[int, int]]:
    """(character, tokens before it) at every place in ``text`` where a token run starts."""
    at = tokens = 0
    out = []
    for segment in known.cut(text):
        if len(segment) > _LONGEST:
            made = known.library.encode(segment, add_special_tokens=False)
            word = object()
            for n, (w, span) in enumerate(zip(made.word_ids, made.offsets)):
                if w != word:
                    out.append((at + span[0], tokens + n))
                word = w
            tokens += len(made.ids)
        else:
            out.append((at, tokens))
            tokens += len(known[segment]) // 4
        at += len(segment)
    return [*out, (at, tokens)]


def _chunks(batches, chunk: int, overlap: int):
    for batch in batches:
        for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
            starts = range(0, max(1, len(text) - overlap), chunk)
            for n, start in enumerate(starts):
                end = len(text) if n == len(starts) - 1 else start + chunk + overlap
                yield pa.record_batch({
                    "key": pa.array([key], pa.int64()), "n": pa.array([n], pa.int32()),
                    "start": pa.array([start], pa.int64()), "text": pa.array([text[start:end]]),
                    "last": pa.array([n == len(starts) - 1])})


def _reports(batches, tokenizer: str, overlap: int):
    known = memo(tokenizer)
    place = pa.struct([("at", pa.int64()), ("tokens", pa.int64())])
    for batch in batches:
        rows = []
        for start, text, last, n in zip(*(batch.column(c).to_pylist()
                                          for c in ("start", "text", "last", "n"))):
            found = boundaries(known, text)
            head = [] if n == 0 else [(start + a, t) for a, t in found if MARGIN <= a <= overlap]
            tail = [] if last else [(start + a, t) for a, t in found
                                    if len(text) - overlap <= a < len(text) - MARGIN]
            rows.append((found[-1][1], head, tail))
        spots = lambda i: pa.array([[{"at": a, "tokens": t} for a, t in r[i]] for r in rows],
                                   pa.list_(place))
        yield pa.record_batch({
            "key": batch.column("key"), "n": batch.column("n"), "last": batch.column("last"),
            "tokens": pa.array([r[0] for r in rows], pa.int64()), "head": spots(1),
            "tail": spots(2)})


def spliced(reports: DataFrame) -> DataFrame:
    """``key, tokens, whole``: the sum over chunks of the tokens between their splices; not
    whole if two neighbours share no place."""
    beside = Window.partitionBy("key").orderBy("n")
    both = reports.withColumn("left", F.lag("tail").over(beside)).withColumn(
        "shared", F.array_max(F.array_intersect(F.transform("left", lambda p: p["at"]),
                                                F.transform("head", lambda p: p["at"]))))
    tokens = lambda side: F.get(
        F.filter(side, lambda p: p["at"] == F.col("shared")), F.lit(0))["tokens"]
    return both.select(
        "key", ((F.col("n") == 0) | F.col("shared").isNotNull()).alias("whole"),
        (F.when(F.col("last"), F.col("tokens")).otherwise(0)
         + F.when(F.col("n") == 0, 0).otherwise(tokens("left") - tokens("head"))).alias("tokens")
    ).groupBy("key").agg(F.sum("tokens").alias("tokens"), F.min("whole").alias("whole"))


def counts(docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text",
           chunk: int = 32_768, overlap: int = 1_024) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` per row.  Texts of up to ``chunk`` characters are encoded
    as they are.  Longer ones are numbered by their content's hash: equal texts are counted
    once, and any id (null, repeated) keeps its rows."""
    reachable(docs.sparkSession)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), body.alias("text"))
    sized = lambda df: df.withColumn("n_bytes", F.octet_length("text").cast("long"))
    short = sized(rows.filter(F.octet_length("text") <= chunk)).select(
        "doc_id", "n_bytes", token_count(F.col("text"), tokenizer).alias("n_tokens"))
    long = sized(rows.filter(F.octet_length("text") > chunk)).withColumn("key", F.xxhash64("text"))
    open_, done, wide = long.select("key", "text").dropDuplicates(["key"]), None, overlap
    while True:
        cut = open_.mapInArrow(
            lambda b, w=wide: _chunks(b, chunk, w),
            "key long, n int, start long, text string, last boolean")
        reports = cut.repartition("key", "n").mapInArrow(
            lambda b, w=wide: _reports(b, tokenizer, w),
            "key long, n int, last boolean, tokens long, "
            "head array<struct<at: long, tokens: long>>, tail array<struct<at: long, tokens: long>>")
        result = stored(spliced(reports), "token-counts")
        good = result.filter("whole").select("key", "tokens")
        done = good if done is None else done.unionByName(good)
        if result.filter("not whole").isEmpty():
            break
        open_ = open_.join(result.filter("not whole").select("key"), "key", "left_semi")
        wide *= 8
    return short.unionByName(long.select("doc_id", "n_bytes", "key").join(done, "key").select(
        "doc_id", "n_bytes", F.col("tokens").alias("n_tokens")))
