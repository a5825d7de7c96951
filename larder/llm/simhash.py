"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified Hamming distance, groups.

Fingerprints of 64 bits are cut into blocks so that two within the distance agree on some choice
of blocks for certain.  For loose similarities 64 bits are too coarse and no exact choice is
short enough; then 256 bits are used.  Seen as a square of 16 rows, columns and diagonals, they
give 48 blocks of 16 bits: up to 15 differing bits leave a block whole for certain, and of pairs
that differ in 26 (39) bits, as texts sharing 0.9 (0.8) of their shingles do, over 0.99 (0.97)
share a block.  With six views of the square there are 96 blocks: of pairs that differ in 39
bits over 0.999 share one, of pairs that share 0.8 of their shingles about 0.995.

``groups(least=...)`` takes fingerprints for candidates only and verifies each link by the
Jaccard similarity of the texts' distinct shingles.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm import set_join
from larder.llm.common import components, lean, lists, reachable, stored, text_bytes

#: Fingerprints of a bucket that one task compares each with each; a larger bucket is split again
#: (one word) or compared part by part (four words).
LARGE = 1024
#: The same where links are verified: a larger bucket is compared part by part.  Which ones are
#: large is counted on one node in ``COUNTED``; the pairs are the same however it turns out.
LARGE_VERIFIED, COUNTED = 8192, 16
#: Rounds that verify a spanning forest of each bucket before all pairs that are left.
FORESTS = 2
_FACTORS = (1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


@dataclass(frozen=True)
class Blocks:
    """``words``: 64-bit words of a fingerprint.  One word: every choice of ``blocks`` less
    ``distance`` blocks is a key.  Four words: 48 blocks of the square, or with ``finer`` all
    pairs of blocks that run the same way; ``views``: how many ways they run."""

    distance: int = 2
    words: int = 1
    blocks: int = 4
    finer: bool = False
    views: int = 3

    def keys(self, fps: np.ndarray) -> np.ndarray:
        """The keys of each fingerprint, one column a choice."""
        if self.words == 1:
            ends = [64 * i // self.blocks for i in range(self.blocks + 1)]
            masks = [sum(((1 << (b - a)) - 1) << a for a, b in chosen) for chosen in
                     combinations(list(zip(ends, ends[1:])), self.blocks - self.distance)]
            return (fps & np.array(masks, np.uint64)).view(np.int64)
        square = np.unpackbits(fps.view(np.uint8).reshape(len(fps), 32), axis=1).reshape(-1, 16, 16)
        i = np.arange(16)
        views = (square, square.transpose(0, 2, 1), *(
            square[:, i[None, :], (i[:, None] + slope * i) % 16] for slope in range(1, self.views - 1)))
        parts = [np.ascontiguousarray(np.packbits(v, axis=2)).view(np.uint16)[:, :, 0]
                 .astype(np.int64) for v in views]
        if not self.finer:
            return np.concatenate(parts, 1)
        a, b = np.triu_indices(16, 1)
        return np.concatenate([p[:, a] << 16 | p[:, b] for p in parts], 1)

    def split(self) -> Blocks:
        return Blocks(self.distance, self.words, 2 * self.blocks, True)


def simhash(text: bytes, width: int, words: int = 1) -> list[int]:
    parts = text.lower().split()  # of bytes: A-Z only, and cut at 20, 09 to 0D
    if not parts:
        return [0] * words
    shingles = map(b" ".join, zip(*(parts[i:] for i in range(width)))) if len(parts) > width \
        else [b" ".join(parts)]
    h = xxhash.xxh64_intdigest
    return _bits(np.array([h(s, 42) for s in shingles], "<u8"), words)


def _bits(hashes: np.ndarray, words: int) -> list[int]:
    """The bits that over half of the hashes have set, in ``words`` words."""
    out, total = [], len(hashes)
    for factor in _FACTORS[:words]:
        mixed = hashes if factor == 1 else (hashes ^ hashes >> np.uint64(29)) * np.uint64(factor)
        mixed = mixed if factor == 1 else mixed ^ mixed >> np.uint64(32)
        bits = np.unpackbits(mixed.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = total // 255 * 255  # sums of 255 fit a byte
        count = bits[:whole].reshape(-1, 255, 64).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
        count = count + bits[whole:].sum(0, dtype=np.uint8)
        out.append(int(np.packbits(count * 2 > total, bitorder="little").view("<u8")[0]))
    return out


def fingerprint(text, width: int, words: int = 1):
    """The fingerprint of a text column as an array of signed 64-bit words.  In the first one
    bit i is set if it is set in over half the XXH64 values (seed 42) of the ``width``-word
    shingles, repeats included; the others do the same with the values mixed anew.  Fewer words
    than ``width``: one shingle of all; null or no words: 0."""

    @F.arrow_udf("array<long>")
    def made(texts: pa.Array) -> pa.Array:
        found = [simhash(t, width, words) for t in text_bytes(texts)]
        return lists(np.array(found, np.uint64).reshape(-1).view(np.int64), [words] * len(found),
                     pa.int64())

    return made(text)


def _words(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(values.view(np.uint64).reshape(len(flat), -1))


def _spread(batches, blocks: Blocks):
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            keys = blocks.keys(_words(part.column("fp")))
            n, k = keys.shape
            row = np.repeat(np.arange(n), k)
            yield pa.record_batch({
                "choice": pa.array(np.tile(np.arange(k, dtype=np.int32), n)),
                "bits": pa.array(keys.reshape(-1)),
                **{c: part.column(c).take(row) for c in part.schema.names}})


def _by_bucket(batches, linked):
    """``linked`` of whole buckets; rows come sorted by bucket."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        choice, bits = (held[c].to_numpy() for c in ("choice", "bits"))
        last = np.flatnonzero((choice != choice[-1]) | (bits != bits[-1])) if len(held) else ()
        whole = int(last[-1]) + 1 if len(last) else 0
        if whole:
            yield linked(held.slice(0, whole))
            held = held.slice(whole)
    if held is not None and len(held):
        yield linked(held)


def _linked(rows: pa.Table, distance: int) -> pa.RecordBatch:
    choice, bits, node = (rows[c].to_numpy() for c in ("choice", "bits", "node"))
    fp = _words(rows["fp"])
    bucket = np.cumsum(np.concatenate(([0], (choice[1:] != choice[:-1]) | (bits[1:] != bits[:-1]))))
    root, live, lag = np.arange(len(fp)), np.arange(len(fp)), 1
    while True:
        live = live[live + lag < len(fp)]
        live = live[bucket[live] == bucket[live + lag]]
        if not len(live):
            break
        apart = np.bitwise_count(fp[live] ^ fp[live + lag]).sum(1, dtype=np.int32)
        near = live[apart <= distance]
        _join(root, near, near + lag)
        lag += 1
    tied = np.flatnonzero(root != np.arange(len(fp)))
    return pa.record_batch({"a": pa.array(node[tied]), "b": pa.array(node[root[tied]])})


def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unites the sets of a[i] and b[i]; ``root`` holds the smallest member of each set."""
    while len(a):
        x, y = root[a], root[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := root[root], root):
            root[:] = up


def _in_parts(rows: DataFrame, large: int, *also: str) -> DataFrame:
    """Rows of large buckets once for each pair of parts; ``bits`` tells the pairs apart."""
    parts = F.ceil(F.col("n") / max(large // 2, 1)).cast("int")
    own = F.pmod(F.xxhash64("node", "choice"), F.col("parts")).cast("int")
    each = rows.withColumn("parts", parts).withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return each.select("choice", F.xxhash64("bits", F.least("own", "other"),
                                            F.greatest("own", "other")).alias("bits"), "node", "fp", *also)


def links(fps: DataFrame, blocks: Blocks) -> DataFrame:
    """Edges ``a, b`` of nodes that connect those within the distance, directly or over others.

    ``fps`` has distinct fingerprints: node, fp.  They meet in the buckets of their keys.  A
    bucket of over ``LARGE`` goes through the buckets of longer keys instead where those lose
    nothing, so that no bucket's work grows with the square of a group of near copies.  With
    four words longer keys would lose pairs: there a large bucket is cut into numbered parts,
    and every two parts meet in a bucket of their own, so what one task holds stays bounded.
    """
    reachable(fps.sparkSession)
    kinds = ", ".join(f"{n} {t}" for n, t in (("choice", "int"), ("bits", "long"),
                                              ("node", "long"), ("fp", "array<long>")))
    keyed = lambda rows, how: rows.select("node", "fp").mapInArrow(
        lambda b: _spread(b, how), kinds)
    sizes = stored(keyed(fps, blocks).groupBy("choice", "bits").agg(F.count("*").alias("n"))
                   .filter(F.col("n") > LARGE), "simhash-large")

    def forest(rows: DataFrame) -> DataFrame:
        return (rows.repartition("choice", "bits").sortWithinPartitions("choice", "bits")
                .mapInArrow(lambda b: lean(_by_bucket(b, lambda rows: _linked(rows, blocks.distance))),
                            "a long, b long"))

    if sizes.isEmpty():
        return forest(keyed(fps, blocks))
    if blocks.words > 1:
        hot = keyed(fps, blocks).join(sizes, ["choice", "bits"])
        cold = keyed(fps, blocks).join(sizes, ["choice", "bits"], "left_anti")
        return forest(cold.select("choice", "bits", "node", "fp")).unionByName(
            forest(_in_parts(hot, LARGE)))
    hot = keyed(fps, blocks).join(sizes, ["choice", "bits"], "left_semi")
    cold = keyed(fps, blocks).join(sizes, ["choice", "bits"], "left_anti")
    wide = stored(hot.select("node", "fp").dropDuplicates(["node"]), "simhash-wide")
    return forest(cold.select("choice", "bits", "node", "fp")).unionByName(
        forest(keyed(wide, blocks.split())))


def groups(docs: DataFrame, width: int = 5, blocks: Blocks = Blocks(), *,
           doc_id: str = "doc_id", text: str = "text", key=None,
           least: tuple[int, int] | None = None) -> DataFrame:
    """``doc_id, fp, component_id`` per row: the smallest doc_id that links lead to; and
    ``key``, if that column of ``docs`` is given.

    Documents without words have fingerprint 0 and link like others.  Repeated rows are one
    fingerprint.  Null ids take part but never name a group (null if there is no other).

    With ``least``, a fraction, fingerprints are those of distinct shingles, and of two texts
    within the distance only those link that share so much of them.  ``key``, which tells rows
    apart that differ in id or text, is there in any case.
    """
    reachable(docs.sparkSession)
    if least is not None:
        return _verified_groups(docs.select(
            F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
            (F.xxhash64(doc_id, text) if key is None else key).alias("key")), width, blocks, least)
    rows = stored(docs.select(
        F.col(doc_id).alias("doc_id"), *(() if key is None else (key.alias("key"),)),
        fingerprint(F.col(text), width, blocks.words).alias("fp")).withColumn(
        "node", F.col("fp")[0] if blocks.words == 1 else F.xxhash64("fp")), "simhash")
    first = stored(rows.groupBy("node").agg(F.min("doc_id").alias("first"),
                                            F.first("fp").alias("fp")), "simhash-first")
    tied = components(links(first, blocks), "simhash-star").withColumnRenamed("node", "at")
    known = first.join(tied, F.col("node") == F.col("at"), "left").select(
        "node", "first", F.coalesce("root", "node").alias("root"))
    least = known.groupBy("root").agg(F.min("first").alias("component_id"))
    named = known.join(least, "root").select("node", "component_id")
    return rows.join(named, "node").drop("node")


# -- verified links ----------------------------------------------------------------

def _prints(batches, width: int, words: int):
    """Per row its distinct shingles' hash, sketch and fingerprint."""
    for batch in batches:
        node, sketches, fps = [], [], []
        for text in text_bytes(batch.column("text")):
            h = set_join.shingles(text, width)
            node.append(xxhash.xxh3_64_intdigest(h.tobytes()))
            sketches.append(set_join.sketch(h))
            fps.append(_bits(h, words))
        yield pa.record_batch({
            "doc_id": batch.column("doc_id"), "key": batch.column("key"),
            "node": pa.array(np.array(node, np.uint64).view(np.int64)),
            "sketch": pa.array(sketches, pa.binary()),
            "fp": lists(np.array(fps, np.uint64).reshape(-1).view(np.int64), [words] * len(fps), pa.int64())})


def _near(rows: pa.Table, distance: int, every: bool) -> pa.RecordBatch:
    """Pairs within the distance whose roots differ: a forest that connects them, or ``every``
    one.  A row of a bucket that keeps pairs back comes as a pair with itself."""
    choice, bits, node, root = (rows[c].to_numpy() for c in ("choice", "bits", "node", "root"))
    fp = _words(rows["fp"])
    bucket = np.cumsum(np.concatenate(([0], (choice[1:] != choice[:-1]) | (bits[1:] != bits[:-1]))))
    _, first, same = np.unique(np.stack([bucket, root]), axis=1, return_index=True, return_inverse=True)
    top, live, lag = first[same.reshape(-1)], np.arange(len(fp)), 1
    a, b, back = [], [], []
    while True:
        live = live[live + lag < len(fp)]
        live = live[bucket[live] == bucket[live + lag]]
        if not len(live):
            break
        near = live[root[live] != root[live + lag]]
        near = near[np.bitwise_count(fp[near] ^ fp[near + lag]).sum(1, dtype=np.int32) <= distance]
        apart = np.full(len(near), True) if every else top[near] != top[near + lag]
        back += [near[~apart], near[~apart] + lag]
        near = near[apart]
        a.append(node[near])
        b.append(node[near + lag])
        _join(top, near, near + lag)
        lag += 1
    kept = node[np.unique(np.concatenate(back))] if back else node[:0]
    a, b = np.concatenate([*a, kept]), np.concatenate([*b, kept])
    return pa.record_batch({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})


def _verified_groups(own: DataFrame, width: int, blocks: Blocks, least: tuple[int, int]) -> DataFrame:
    """Candidates are texts that share a block and lie within the distance; links are verified.

    Each round judges a forest of every bucket.  What that ties is one group; buckets in which
    more pairs are near are gone over again for pairs of different groups, in the end all.
    """
    rows = stored(own.mapInArrow(lambda b: lean(_prints(b, width, blocks.words)),
                                 "doc_id long, key long, node long, sketch binary, fp array<long>"), "simhash")
    first = stored(rows.groupBy("node").agg(
        F.min("doc_id").alias("first"), F.min("key").alias("key"), F.first("sketch").alias("sketch"),
        F.first("fp").alias("fp")), "simhash-first")
    kinds = "choice int, bits long, node long, fp array<long>"
    sampled = first.select("node", "fp").filter(F.pmod("node", F.lit(COUNTED)) == 0)
    sizes = stored(sampled.mapInArrow(lambda b: lean(_spread(b, blocks)), kinds).groupBy("choice", "bits").agg(
        (F.count("*") * COUNTED).alias("n")).filter(F.col("n") > LARGE_VERIFIED), "simhash-large")
    split, seen, tied = not sizes.isEmpty(), None, None
    now = first.select("node", "fp", F.col("node").alias("root"))
    for turn in range(FORESTS + 1):
        every = turn == FORESTS
        keyed = now.mapInArrow(lambda b: lean(_spread(b, blocks)), f"{kinds}, root long")
        if split:
            hot = keyed.join(sizes, ["choice", "bits"])
            keyed = keyed.join(sizes, ["choice", "bits"], "left_anti").select(
                *keyed.columns).unionByName(_in_parts(hot, LARGE_VERIFIED, "root"))
        found = stored(
            keyed.repartition("choice", "bits").sortWithinPartitions(
                "choice", "bits", F.xxhash64("node", F.lit(turn)))  # another forest each time
            .mapInArrow(lambda b, e=every: lean(_by_bucket(b, lambda t: _near(t, blocks.distance, e))),
                        "a long, b long").distinct(), "simhash-near")
        pairs = found.filter("a <> b")
        if seen is not None:
            pairs = pairs.join(seen.select("a", "b"), ["a", "b"], "left_anti")
        new = set_join.judged(pairs, first, own, width, least, "simhash-judged")
        seen = new if seen is None else seen.unionByName(new)
        tied = components(seen.filter("same").select("a", "b"), "simhash-star").withColumnRenamed("node", "at")
        open_ = found.filter("a = b").select(F.col("a").alias("node"))
        if every or open_.isEmpty():
            break
        now = stored(first.join(open_, "node", "left_semi").join(tied, F.col("node") == F.col("at"), "left").select(
            "node", "fp", F.coalesce("root", "node").alias("root")), "simhash-open")
    known = first.join(tied, F.col("node") == F.col("at"), "left").select(
        "node", "first", F.coalesce("root", "node").alias("root"))
    smallest = known.groupBy("root").agg(F.min("first").alias("component_id"))
    named = known.join(smallest, "root").select("node", "component_id")
    return rows.join(named, "node").select("doc_id", "key", "fp", "component_id")
