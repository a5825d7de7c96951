"""Near copies by the Jaccard similarity of their distinct shingles: all pairs, each verified.

All shingles have one order, those common in a bounded sample last.  Two sets of similarity s or
more share one of the first n - ceil(s n) + 1 shingles of either, so such sets meet in the bucket
of that shingle.  In a bucket everything is compared with a pivot first; what that connects is one
group, and only pairs of different groups are left to compare.

A pair is first judged by sketches, which count each set's shingles by the first bits of their
hashes: two sets share at most the sum of the lesser counts.  Texts travel for pairs that this
bound leaves, so for those that are near copies or almost.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import bitmap, components, forget, lean, lists, maybe_in, reachable, stored, text_bytes

#: Documents that common shingles are counted in, and how many of those are put last at most.
SAMPLE, COMMON = 2_000, 1 << 18
#: With more pairs than this for each bucket row other pivots come before all that are left.
PAIRS_A_ROW, PIVOTS = 4, 6


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted hashes of the distinct ``width``-word shingles; words as in ``simhash``."""
    parts = text.lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    made = map(b" ".join, zip(*(parts[i:] for i in range(width)))) if len(parts) > width \
        else [b" ".join(parts)]
    h = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((h(s, 42) for s in made), np.uint64))


def _common(texts: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles met in several documents of a sample, ascending, and in how many."""
    share = SAMPLE / max(texts.count(), 1)
    if share < 1:
        texts = texts.filter(F.pmod(F.xxhash64("text", F.lit(3)), F.lit(1 << 30)) < share * (1 << 30))

    def each(batches):
        forget()
        for batch in batches:
            for text in text_bytes(batch.column("text")):
                yield pa.record_batch({"h": pa.array(shingles(text, width).view(np.int64))})

    found = (texts.distinct().mapInArrow(each, "h long").groupBy("h").agg(F.count("*").alias("n"))
             .filter("n > 1").orderBy(F.desc("n"), "h").limit(COMMON).toArrow())
    h, n = found["h"].to_numpy().view(np.uint64), found["n"].to_numpy()
    order = np.argsort(h)
    return h[order], n[order]


def sketch(h: np.ndarray) -> bytes:
    """How many hashes have each value of their first bits: so many bits that four to eight
    hashes share a value, six at least.  Bits and the width of a count stand in front."""
    bits = max(6, len(h).bit_length() - 3)
    counts = np.bincount((h >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    width = next(w for w in (1, 2, 4) if counts.max() < 1 << 8 * w)
    return bytes((bits, width)) + counts.astype(f"<u{width}").tobytes()


def _counts(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[1]}", offset=2).astype(np.int64)


def shared_at_most(x: bytes, y: bytes) -> tuple[int, int]:
    """How many hashes the sets of two sketches share at most, and both sets' sizes in all."""
    x, y = _counts(x), _counts(y)
    while len(x) > len(y):
        x = x.reshape(-1, 2).sum(1)
    while len(y) > len(x):
        y = y.reshape(-1, 2).sum(1)
    return int(np.minimum(x, y).sum()), int(x.sum() + y.sum())


def _rough(batches, num: int, den: int):
    """The pairs whose sketches leave room for the similarity."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
            shared, sizes = shared_at_most(x, y)
            keep.append((num + den) * shared >= num * sizes)
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _prefixes(batches, width: int, num: int, den: int, common: np.ndarray, often: np.ndarray):
    forget()
    for batch in batches:
        node, size, first, sketches = [], [], [], []
        for text in text_bytes(batch.column("text")):
            h = shingles(text, width)
            node.append(xxhash.xxh3_64_intdigest(h.tobytes()))
            size.append(len(h))
            sketches.append(sketch(h))
            if len(common) and len(h):
                at = np.minimum(np.searchsorted(common, h), len(common) - 1)
                h = h[np.lexsort((h, np.where(common[at] == h, often[at], 0)))]
            first.append(h[:len(h) - -(-num * len(h) // den) + 1 if len(h) else 0])
        flat = np.concatenate(first) if first else np.empty(0, np.uint64)
        yield pa.record_batch({
            "doc_id": batch.column("doc_id"), "key": batch.column("key"),
            "node": pa.array(np.array(node, np.uint64).view(np.int64)),
            "n": pa.array(size, pa.int32()), "sketch": pa.array(sketches, pa.binary()),
            "prefix": lists(flat.view(np.int64), [len(f) for f in first], pa.int64())})


def _verified(batches, width: int, num: int, den: int):
    @lru_cache(256)
    def known(text: str) -> np.ndarray:
        return shingles(text.encode(), width)

    for batch in batches:
        same = []
        for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
            x, y = known(x or ""), known(y or "")
            both = len(np.intersect1d(x, y, assume_unique=True))
            same.append(den * both >= num * (len(x) + len(y) - both))
        yield pa.record_batch({"a": batch.column("a"), "b": batch.column("b"),
                               "same": pa.array(same, pa.bool_())})


def judged(pairs: DataFrame, first: DataFrame, own: DataFrame, width: int,
           least: tuple[int, int], label: str) -> DataFrame:
    """``a, b, same``: the pairs that sketches leave, each judged by its texts' shingles.

    ``first`` has ``node, key, sketch`` of every set, ``own`` the texts by ``key``."""
    num, den = least
    seen_of = lambda end, name: first.select(F.col("node").alias(end), F.col("sketch").alias(name))
    pairs = stored(pairs.join(seen_of("a", "x"), "a").join(seen_of("b", "y"), "b").select(
        "a", "b", "x", "y").mapInArrow(lambda b: lean(_rough(b, num, den)), "a long, b long"), f"{label}-pairs")
    ends = pairs.select(F.col("a").alias("of")).unionByName(
        pairs.select(F.col("b").alias("of"))).distinct()
    needs = stored(first.join(ends, F.col("node") == F.col("of")).select(
        "node", F.col("key").alias("_needs")), f"{label}-needs")
    bodies = stored(own.filter(maybe_in(F.col("key"), bitmap(needs.select("_needs")))).join(
        needs, F.col("key") == F.col("_needs")).select("node", "text").dropDuplicates(["node"]),
        f"{label}-texts")
    return stored(
        pairs.join(bodies.select(F.col("node").alias("a"), F.col("text").alias("x")), "a")
        .join(bodies.select(F.col("node").alias("b"), F.col("text").alias("y")), "b")
        .select("a", "b", "x", "y").mapInArrow(
            lambda b: lean(_verified(b, width, num, den)), "a long, b long, same boolean"), label)


def groups(docs: DataFrame, width: int = 5, least: tuple[int, int] = (4, 5), *,
           doc_id: str = "doc_id", text: str = "text", key=None) -> DataFrame:
    """``doc_id, key, component_id`` per row: the smallest doc_id that pairs of a similarity of
    ``least`` (a fraction) or more lead to.  ``key`` tells rows apart that differ in id or text.

    Documents without words are copies of each other.  Null ids take part but never name a group.
    """
    reachable(docs.sparkSession)
    num, den = least
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                      (F.xxhash64(doc_id, text) if key is None else key).alias("key"))
    common, often = _common(own.select("text"), width)
    rows = stored(own.mapInArrow(lambda b: _prefixes(b, width, num, den, common, often),
                                 "doc_id long, key long, node long, n int, sketch binary, prefix array<long>"),
                  "shingle-sets")
    first = stored(rows.groupBy("node").agg(
        F.min("doc_id").alias("first"), F.min("key").alias("key"), F.first("n").alias("n"),
        F.first("sketch").alias("sketch"), F.first("prefix").alias("prefix")), "shingle-first")
    met = first.select("node", "n", F.posexplode("prefix").alias("at", "h"))
    shared = stored(met.groupBy("h").agg(F.count("*").alias("c")).filter("c > 1").select("h"),
                    "shingle-shared")
    # most prefix shingles occur once; those the filter lets pass beyond it, the join drops
    buckets = stored(met.filter(maybe_in(F.col("h"), bitmap(shared))).join(shared, "h"),
                     "shingle-buckets")
    size = buckets.count()

    def possible(pairs: DataFrame) -> DataFrame:
        """``a, b`` of pairs whose sizes and places leave room for enough common shingles."""
        room = F.least("at", "at2") + 1 + F.least(F.col("n") - F.col("at"), F.col("n2") - F.col("at2")) - 1
        return pairs.filter((F.lit(den) * F.least("n", "n2") >= F.lit(num) * F.greatest("n", "n2"))
                            & (F.lit(num + den) * room >= F.lit(num) * (F.col("n") + F.col("n2")))
                            ).select(F.least("node", "node2").alias("a"),
                                     F.greatest("node", "node2").alias("b")).distinct()

    seen, now = None, buckets.withColumn("root", F.col("node"))
    for turn in range(PIVOTS + 1):
        by_root = now.groupBy("h", "root").agg(F.count("*").alias("c"))
        mixed = by_root.groupBy("h").agg(
            F.count("*").alias("roots"), F.sum("c").alias("c"),
            F.sum(F.col("c") * F.col("c")).alias("squares")).filter("roots > 1")
        left = mixed.agg(F.sum((F.col("c") * F.col("c") - F.col("squares")) / 2)).first()[0] or 0
        if not left:
            break
        last = turn == PIVOTS or left <= PAIRS_A_ROW * size
        open_ = now.join(mixed.select("h"), "h", "left_semi")
        if last:  # all pairs of different groups; rows of one group never meet
            roots = by_root.select("h", "root")
            meet = roots.join(roots.select("h", F.col("root").alias("root2")), "h").filter("root < root2")
            there = open_.select("h", F.col("root").alias("root2"), F.col("node").alias("node2"),
                                 F.col("n").alias("n2"), F.col("at").alias("at2"))
            pairs = open_.join(meet, ["h", "root"]).join(there, ["h", "root2"])
        else:
            pivot = open_.groupBy("h").agg(F.min(F.struct(
                F.xxhash64("node", F.lit(turn)).alias("by"), "node", "n", "at", "root")).alias("p")).select(
                "h", F.col("p.node").alias("node2"), F.col("p.n").alias("n2"),
                F.col("p.at").alias("at2"), F.col("p.root").alias("root2"))
            pairs = open_.join(pivot, "h").filter("root <> root2")
        pairs = possible(pairs)
        if seen is not None:
            pairs = pairs.join(seen.select("a", "b"), ["a", "b"], "left_anti")
        new = judged(pairs, first, own, width, least, "shingle-judged")
        seen = new if seen is None else seen.unionByName(new)
        if last:
            break
        tied = components(seen.filter("same").select("a", "b"), "shingle-star").withColumnRenamed(
            "node", "of")
        # a bucket of one group stays one: only those still open are looked at again
        now = stored(open_.drop("root").join(tied, F.col("node") == F.col("of"), "left").select(
            *buckets.columns, F.coalesce("root", "node").alias("root")), "shingle-roots")
    if seen is None:
        return rows.join(first.select("node", F.col("first").alias("component_id")), "node").select(
            "doc_id", "key", "component_id")
    tied = components(seen.filter("same").select("a", "b"), "shingle-star").withColumnRenamed(
        "node", "of")
    known = first.join(tied, F.col("node") == F.col("of"), "left").select(
        "node", "first", F.coalesce("root", "node").alias("root"))
    least_id = known.groupBy("root").agg(F.min("first").alias("component_id"))
    named = known.join(least_id, "root").select("node", "component_id")
    return rows.join(named, "node").select("doc_id", "key", "component_id")
