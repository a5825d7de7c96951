"""A Merkle manifest of a dataset by time-forward processing.

Nodes are labelled by tree, level and place.  A node's digest is a message to its parent; Spark's
sorted shuffle is the external priority queue that delivers messages in label order.  One sweep
upwards takes ``LEVELS`` levels: a chunk of ``FAN ** LEVELS`` neighbouring nodes, the largest
piece that any task holds, becomes one message.  The sweep downwards goes the same way in
reverse: a chunk's message is the end of its nodes' proofs, and each node adds its own siblings.
Trees of single groups have roots, which are the nodes of one tree above them.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import reachable, stored

FAN, LEVELS = 8, 5
CHUNK = FAN ** LEVELS
PROOF = "array<struct<place: int, siblings: string>>"
_KIND = pa.list_(pa.struct([("place", pa.int32()), ("siblings", pa.string())]))


def record(columns: list[Column]) -> Column:
    """Hex digest of the columns' values, each with its length in front; null is a dash."""
    parts = [F.when(c.isNull(), F.lit("-")).otherwise(F.concat(
        F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")))
        for c in columns]
    return F.sha2(F.concat(*parts), 256)


def folded(digest: Column, proof: Column) -> Column:
    """The root that follows from a leaf's digest and its proof."""
    def step(own: Column, s: Column) -> Column:
        at = F.lit(64) * s["place"]
        return F.sha2(F.concat(F.substring(s["siblings"], F.lit(1), at), own,
                               F.substring(s["siblings"], at + 1, F.length(s["siblings"]))), 256)
    return F.aggregate(proof, digest, step)


def _placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with ``pos``, their place in their tree by ``order``, and the tree's ``size``.

    Rows are dealt to ranges of the order, never a whole tree to one; the row number is part
    of it, so repeated rows are dealt too.  Only (range, tree) counts meet in a window.
    """
    keys = ["tree", *order, "row"]
    here = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = stored(nodes.repartitionByRange(*keys).sortWithinPartitions(*keys)
                  .withColumn("part", F.spark_partition_id()).withColumn("here", here), "merkle-rows")
    counts = rows.groupBy("part", "tree").agg(F.count("*").alias("c"), F.min("here").alias("first"))
    line = Window.partitionBy("tree")
    counts = counts.select(
        F.col("part").alias("_part"), F.col("tree").alias("_tree"), F.sum("c").over(line).alias("size"),
        (F.sum("c").over(line.orderBy("part")) - F.col("c") - F.col("first")).alias("base"))
    return rows.join(counts, (F.col("part") == F.col("_part")) & F.col("tree").eqNullSafe(
        F.col("_tree"))).withColumn("pos", F.col("here") + F.col("base")).drop(
        "_part", "_tree", "part", "here", "base", "row")


def _height(size: int) -> int:
    """Levels above ``size`` leaves."""
    height = 0
    while size > 1:
        size, height = -(-size // FAN), height + 1
    return height


def _levels(digests: list[str], height: int) -> list[list[str]]:
    """The digests of a chunk's nodes, level by level, each from its children's messages."""
    out = [digests]
    for _ in range(height):
        below = out[-1]
        out.append([sha256("".join(below[i:i + FAN]).encode()).hexdigest()
                    for i in range(0, len(below), FAN)])
    return out


def _chunks(batches):
    """A table for each chunk; the stream is sorted and ``first`` marks where chunks begin."""
    held = []
    for batch in batches:
        cuts = np.flatnonzero(batch.column("first").to_numpy(zero_copy_only=False))
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            if held and a in cuts:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            if b > a:
                held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _in_order(rows: DataFrame) -> DataFrame:
    """Delivers each chunk's rows to one task, sorted by label; a chunk is of bounded size."""
    return rows.repartition("tree", "chunk").sortWithinPartitions("tree", "chunk", "pos")


def _risen(nodes: DataFrame) -> DataFrame:
    """One sweep upwards: ``tree, pos, size, digest`` of the nodes ``LEVELS`` levels higher, or
    of the root where that comes first."""
    def sweep(batches):
        for chunk in _chunks(batches):
            size = chunk["size"][0].as_py()
            top = _levels(chunk["digest"].to_pylist(), min(LEVELS, _height(size)))[-1]
            yield pa.record_batch({
                "tree": pa.array(chunk["tree"][:1].to_pylist(), pa.string()),
                "pos": pa.array([chunk["pos"][0].as_py() // CHUNK], pa.int64()),
                "size": pa.array([-(-size // CHUNK)], pa.int64()), "digest": pa.array(top)})

    ready = nodes.select("tree", "pos", "size", "digest", F.expr(f"pos div {CHUNK}").alias("chunk"),
                         (F.col("pos") % CHUNK == 0).alias("first"))
    return _in_order(ready).mapInArrow(sweep, "tree string, pos long, size long, digest string")


def _fallen(nodes: DataFrame, messages: DataFrame, carried: list[str]) -> DataFrame:
    """One sweep downwards: ``carried`` columns, ``top`` and the whole ``proof`` of each node.

    ``messages`` (tree, chunk, top, proof) hold what all nodes of a chunk have in common; each
    arrives ahead of its chunk's nodes.
    """
    kinds = dict(nodes.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in carried) + f", top string, proof {PROOF}"

    def sweep(batches):
        for chunk in _chunks(batches):
            message, own = chunk.slice(0, 1), chunk.slice(1)
            last = message["proof"][0].as_py() or []
            levels = _levels(own["digest"].to_pylist(),
                             min(LEVELS, _height(own["size"][0].as_py())))
            proofs = {0: last}  # of the chunk's top; children get theirs from their parent
            for level in reversed(levels[:-1]):
                below = {}
                for i in range(len(level)):
                    a = i - i % FAN
                    others = "".join(level[a:i]) + "".join(level[i + 1:a + FAN])
                    below[i] = [(i - a, others), *proofs[i // FAN]]
                proofs = below
            for a in range(0, own.num_rows, 1_000):  # bounds a batch of whole proofs
                part = own.slice(a, 1_000)
                made = [proofs[i] for i in range(a, a + part.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [*(part[c].combine_chunks() for c in carried),
                     pa.array([message["top"][0].as_py()] * len(made), pa.string()),
                     _proof_array(made)], names=[*carried, "top", "proof"])

    ready = nodes.withColumn("chunk", F.expr(f"pos div {CHUNK}")).withColumn("first", F.lit(False))
    ahead = messages.withColumn("pos", F.lit(-1).cast("long")).withColumn("first", F.lit(True))
    return _in_order(ahead.unionByName(ready, allowMissingColumns=True)).mapInArrow(sweep, schema)


def _proof_array(proofs: list[list]) -> pa.Array:
    flat = [(s["place"], s["siblings"]) if isinstance(s, dict) else s for p in proofs for s in p]
    offsets = np.zeros(len(proofs) + 1, np.int32)
    np.cumsum([len(p) for p in proofs], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
        [pa.array([s[0] for s in flat], pa.int32()), pa.array([s[1] for s in flat], pa.string())],
        fields=list(_KIND.value_type)))


def _root_messages(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """All sweeps upwards: the nodes at each stage, and the trees' roots."""
    stages = [nodes]
    while (stages[-1].agg(F.max("size")).first()[0] or 1) > 1:
        stages.append(stored(_risen(stages[-1]), "merkle-nodes"))
    return stages[:-1] if len(stages) > 1 else stages, stages[-1]


def _proofs(stages: list[DataFrame], messages: DataFrame, carried: list[str]) -> DataFrame:
    """All sweeps downwards, from the roots' ``messages`` to the nodes of the first stage."""
    for nodes in reversed(stages[1:]):
        made = _fallen(nodes, messages, ["tree", "pos"])
        messages = stored(made.withColumnRenamed("pos", "chunk"), "merkle-proofs")
    return _fallen(stages[0], messages, carried)


def manifest(docs: DataFrame, fields: list[str], *, doc_id: str = "doc_id", tree: str = "lang",
             carry: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof`` of every row, and the columns ``carry`` makes.

    A leaf is the digest of ``fields``.  Leaves of one ``tree`` value ascend by id (nulls first;
    rows of one id by digest); eight neighbours at a time make the next level until one is left.
    The trees' roots, by tree value (null first, in byte order), likewise give the root.
    ``proof`` holds, level by level, the node's place in its run and the others' digests from
    left to right; ``folded`` follows it.  Repeated rows are leaves of their own, a null field is
    told from an empty one, other columns take no part, an empty table gives no rows.
    """
    reachable(docs.sparkSession)
    carry = carry or {}
    leaves = stored(docs.select(
        F.col(tree).cast("string").alias("tree"), F.col(doc_id).cast("long").alias("doc_id"),
        record([F.col(c) for c in fields]).alias("digest"),
        F.monotonically_increasing_id().alias("row"), *(c.alias(n) for n, c in carry.items())), "merkle-leaves")
    stages, tops = _root_messages(stored(_placed(leaves, ["doc_id", "digest"]), "merkle-nodes"))
    heads = tops.select(F.lit(None).cast("string").alias("tree"), F.col("tree").alias("name"), "digest",
                        F.lit(0).cast("long").alias("row"))
    above, root = _root_messages(stored(_placed(heads, ["name"]), "merkle-nodes"))
    one = root.select("tree", F.col("pos").alias("chunk"), F.col("digest").alias("top"),
                      F.lit(None).cast(PROOF).alias("proof"))
    found = root.select("digest").first()  # one row
    messages = stored(_proofs(above, one, ["name", "digest"]).select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("chunk"),
        F.col("digest").alias("top"), "proof"), "merkle-proofs")
    made = _proofs(stages, messages, ["doc_id", "digest", *carry])
    return made.select("doc_id", F.col("digest").alias("leaf"), F.col("top").alias("subroot"),
                       F.lit(found[0] if found else None).cast("string").alias("root"), "proof", *carry)
