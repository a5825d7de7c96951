"""Substring deduplication by relative Lempel-Ziv parsing of whole documents, in words.

1. *Anchors.*  Of every window of words the smallest hash of half as many words is an anchor,
   so equal windows have equal anchors at equal places.  For an anchor met in several
   documents its first place (smallest id, then position) is its reference.
2. *Reference blocks.*  The text around references is cut into blocks of bounded length with a
   window's margin on both sides.
3. *Parsing.*  Every document is factored against every block that shares an anchor with it:
   seeded by the anchors, factors grow word by word in both directions as far as they agree.
   A factor of at least ``window`` words from a smaller document is a duplicate span.
4. *Factor boundaries.*  A window at an anchor that its reference does not repeat, because it
   straddles the end of a factor, is looked up by its 128-bit hash among all such windows; if
   it starts in a smaller document, it is a duplicate as well.  A window that its reference
   repeats never needs the lookup, in whatever document it stands, so the result is exact.

Text moves only for documents that share anchors, found by a bitmap of bounded size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import bitmap, lean, lists, maybe_in, reachable, stored

BLOCK = 512
_BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def gram_of(window: int) -> int:
    """Words of an anchor.  Longer ones would be rarer by chance but stand more densely."""
    return max(1, window // 2)


def words_of(text: bytes | None) -> list[bytes]:
    return text.split() if text else []  # bytes: cut at 20 and 09 to 0D only


def word_hashes(words: list[bytes]) -> np.ndarray:
    h = xxhash.xxh3_64_intdigest
    return np.array([h(w) for w in words], np.uint64)


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    if base not in _powers or len(_powers[base][0]) < n:
        size = max(1 << 15, 1 << (n - 1).bit_length())
        inverse = pow(base, -1, 1 << 64)
        up, down = np.full(size, base, np.uint64), np.full(size, inverse, np.uint64)
        up[0] = down[0] = 1
        _powers[base] = np.cumprod(up), np.cumprod(down)
    return tuple(p[:n] for p in _powers[base])


def rolling(h: np.ndarray, n: int, base: int = _BASES[0]) -> np.ndarray:
    """A well mixed 64-bit hash of every run of ``n`` words."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    start = np.arange(len(h) - n + 1)
    return runs(h, start, start + n, base)


def runs(h: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = _BASES[0]) -> np.ndarray:
    """The same hash of the runs of words from ``start`` to ``end``."""
    up, down = _power(base, len(h) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * up[:-1], dtype=np.uint64)))
    return mixed((sums[end] - sums[start]) * down[start])


def mixed(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ x >> np.uint64(shift)) * np.uint64(factor)
    return x ^ x >> np.uint64(33)


def minimizers(grams: np.ndarray, window: int) -> np.ndarray:
    """For every window its anchor: the place of the leftmost smallest gram inside."""
    inside = window - gram_of(window) + 1
    if len(grams) < inside:
        return np.empty(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(grams, inside)
    return np.concatenate([view[at:at + 65536].argmin(1) for at in range(0, len(view), 65536)]
                          ) + np.arange(len(view))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """A row's key is its id and its text's hash: equal rows have equal answers."""
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn(
        "key", F.xxhash64("doc_id", "text"))


def anchors(rows: DataFrame, window: int) -> DataFrame:
    """``key, doc_id, at, h`` for the anchors of every document with an id."""

    def find(batches):
        for batch in batches:
            out = ([], [], [], [])
            for key, doc, text in zip(batch.column("key").to_pylist(),
                                      batch.column("doc_id").to_pylist(),
                                      batch.column("text").cast(pa.large_binary()).to_pylist()):
                grams = rolling(word_hashes(words_of(text)), gram_of(window))
                at = np.unique(minimizers(grams, window))
                for column, x in zip(out, (np.full(len(at), key), np.full(len(at), doc),
                                           at, _signed(grams[at]))):
                    column.append(x)
            if out[0]:
                key, doc, at, h = map(np.concatenate, out)
                yield pa.record_batch({"key": pa.array(key, pa.int64()),
                                       "doc_id": pa.array(doc, pa.int64()),
                                       "at": pa.array(at, pa.int32()), "h": pa.array(h, pa.int64())})

    return rows.filter("doc_id is not null and text is not null").select(
        "key", "doc_id", "text").mapInArrow(lambda b: lean(find(b)), "key long, doc_id long, at int, h long")


def _blocks(shared: DataFrame, rows: DataFrame, window: int) -> DataFrame:
    """``block, block_doc, start, body``: reference text, cut so that each reference has a
    window's margin in its block.  ``shared``: h, ref (doc_id, key, at)."""
    cut = shared.select(F.col("ref.key").alias("key"), F.col("ref.doc_id").alias("block_doc"),
                        F.col("ref.at").alias("at")).withColumn(
        "part", F.floor(F.col("at") / BLOCK)).groupBy("key", "block_doc", "part").agg(
        F.min("at").alias("low"), F.max("at").alias("high"))
    there = rows.filter(maybe_in(F.col("key"), bitmap(cut.select("key"))))
    margin = window - gram_of(window)
    each = cut.groupBy("key", "block_doc").agg(F.collect_list(F.struct("part", "low", "high"))
                                               .alias("parts"))

    def slices(batches):
        for batch in batches:
            out = []
            for key, doc, parts, text in zip(*(batch.column(c).to_pylist() for c in
                                               ("key", "block_doc", "parts", "text"))):
                words = words_of(text.encode())
                for p in parts:
                    start = max(0, p["low"] - margin)
                    out.append((key, p["part"], doc, start,
                                b" ".join(words[start:p["high"] + window])))
            names = ("key", "part", "block_doc", "start", "body")
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            for at in range(0, len(out), 2000):
                yield pa.record_batch({n: pa.array(c, t) for n, c, t in
                                       zip(names, zip(*out[at:at + 2000]), kinds)})

    return there.join(each, "key").select("key", "block_doc", "parts", "text").mapInArrow(
        lambda b: lean(slices(b)), "key long, part long, block_doc long, start int, body binary"
    ).dropDuplicates(["key", "part"])


def factors(h: np.ndarray, body: np.ndarray, seeds: list[tuple[int, int]], window: int):
    """Greedy factors of a document against a block: (start, end) for each seed diagonal where
    they agree on at least ``window`` words.  A seed inside a factor of its diagonal adds none."""
    reached: dict[int, int] = {}
    for at, there in seeds:
        shift = at - there
        if reached.get(shift, -1) >= at:
            continue
        low, high = max(0, shift), min(len(h), shift + len(body))
        differ = np.flatnonzero(h[low:high] != body[low - shift:high - shift]) + low
        i = np.searchsorted(differ, at)
        start = int(differ[i - 1]) + 1 if i else low
        end = int(differ[i]) if i < len(differ) else high
        reached[shift] = end
        if end - start >= window:
            yield start, end


def _covered(spans, n: int, window: int) -> np.ndarray:
    """Which window starts lie within one of the spans as a whole."""
    flags = np.zeros(n + 1, np.int32)
    for start, end in spans:
        flags[start] += 1
        flags[end - window + 1] -= 1
    return np.cumsum(flags)[:n] > 0


def _parse(batches, window: int):
    """Per document: spans of duplicate windows, and windows to look up by hash."""
    for batch in batches:
        out = []
        # one document at a time: as Python objects its blocks take many times their batch's bytes
        for key, doc, text, blocks in ((v.as_py() for v in row) for row in zip(
                *(batch.column(c) for c in ("key", "doc_id", "text", "blocks")))):
            h = word_hashes(words_of(text.encode()))
            own = minimizers(rolling(h, gram_of(window)), window)
            known = np.zeros(len(own), bool)
            removed = np.zeros(len(own), bool)
            seeded = np.zeros(len(h), bool)
            for block in blocks:
                seeds = sorted((s["at"], s["there"]) for s in block["seeds"])
                seeded[[s[0] for s in seeds]] = True
                body = word_hashes(words_of(block["body"]))
                by_diagonal = _covered(factors(h, body, seeds, window), len(own), window)
                # known: repeated by the reference of the window's own anchor
                diagonal = dict(seeds)
                for at in diagonal:
                    first, last = np.searchsorted(own, [at, at + 1])
                    known[first:last] |= by_diagonal[first:last]
                if block["block_doc"] < doc:
                    removed |= by_diagonal
            ask = np.flatnonzero(seeded[own] & ~known) if len(own) else np.empty(0, np.int64)
            out.append((key, doc, np.flatnonzero(removed),
                        *_once(ask, *(rolling(h, window, b)[ask] for b in _BASES))))
        if out:
            yield pa.record_batch({
                "key": pa.array([o[0] for o in out], pa.int64()),
                "doc_id": pa.array([o[1] for o in out], pa.int64()),
                "spans": _runs([o[2] for o in out], window),
                "asks": _asks(out)})


def _runs(starts: list[np.ndarray], window: int) -> pa.Array:
    """Window starts as spans of words."""
    kind, out = pa.struct([("start", pa.int32()), ("end", pa.int32())]), []
    for s in starts:
        cuts = np.flatnonzero(np.diff(s) > window) + 1
        out.append([{"start": int(p[0]), "end": int(p[-1]) + window}
                    for p in np.split(s, cuts) if len(p)])
    return pa.array(out, pa.list_(kind))


def _once(at: np.ndarray, w1: np.ndarray, w2: np.ndarray):
    """Each window of a document once: all its places, how many they are, and the hashes."""
    order = np.lexsort((at, w2, w1))
    at, w1, w2 = at[order], w1[order], w2[order]
    new = np.flatnonzero(np.concatenate(([True], (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])))
                         ) if len(at) else np.empty(0, np.int64)
    return at, np.diff(np.append(new, len(at))), w1[new], w2[new]


def _asks(out) -> pa.Array:
    at, sizes, w1, w2 = (np.concatenate([o[i] for o in out]) for i in (3, 4, 5, 6))
    values = pa.StructArray.from_arrays(
        [lists(at, sizes, pa.int32()), pa.array(_signed(w1.astype(np.uint64)), pa.int64()),
         pa.array(_signed(w2.astype(np.uint64)), pa.int64())], ["at", "w1", "w2"])
    return pa.ListArray.from_arrays(pa.array(
        np.cumsum([0, *(len(o[4]) for o in out)]).astype(np.int32)), values)


_PARSED = ("key long, doc_id long, spans array<struct<start: int, end: int>>, "
           "asks array<struct<at: array<int>, w1: long, w2: long>>")


def spans(docs: DataFrame, window: int = 50, *, doc_id: str = "doc_id",
          text: str = "text") -> DataFrame:
    """``key, spans``: the words of a document that windows of smaller documents cover."""
    reachable(docs.sparkSession)
    rows = _keyed(docs, doc_id, text)
    found = stored(anchors(rows, window), "anchors")
    shared = found.groupBy("h").agg(
        F.min(F.struct("doc_id", "at", "key")).alias("ref"), F.max("doc_id").alias("most")
    ).filter("ref.doc_id < most").select("h", "ref")
    shared = stored(shared, "references")
    seeds = found.join(shared, "h").filter(
        (F.col("key") != F.col("ref.key")) | (F.col("at") != F.col("ref.at"))).select(
        F.col("key").alias("of"), F.col("ref.key").alias("key"),
        F.floor(F.col("ref.at") / BLOCK).alias("part"), "at", F.col("ref.at").alias("there"))
    seeds = seeds.groupBy("of", "key", "part").agg(
        F.collect_set(F.struct("at", "there")).alias("seeds"))
    seeds = stored(seeds, "seeds")
    blocks = stored(_blocks(shared, rows, window), "reference-blocks")
    needs = seeds.join(blocks, ["key", "part"]).select(
        F.col("of").alias("key"), F.struct(
            "block_doc", "body", F.transform("seeds", lambda s: F.struct(
                s["at"].alias("at"), (s["there"] - F.col("start")).alias("there"))).alias("seeds")
        ).alias("block")).groupBy("key").agg(F.collect_list("block").alias("blocks"))
    asked = rows.filter(maybe_in(F.col("key"), bitmap(seeds.select("of"))))
    parsed = stored(asked.join(needs, "key").select("key", "doc_id", "text", "blocks").mapInArrow(
        lambda b: lean(_parse(b, window)), _PARSED), "factors")
    asks = parsed.select("key", "doc_id", F.explode("asks").alias("w")).select(
        "key", "doc_id", "w.at", "w.w1", "w.w2")
    first = stored(asks.groupBy("w1", "w2").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most")
        .select("w1", "w2", "least"), "first-windows")
    late = asks.join(first, ["w1", "w2"]).filter("least < doc_id").select(
        "key", F.explode("at").alias("at")).select("key", F.struct(
            F.col("at").alias("start"), (F.col("at") + window).alias("end")).alias("s"))
    return parsed.select("key", F.explode("spans").alias("s")).unionByName(late).groupBy("key").agg(
        F.collect_list("s").alias("spans"))


def _kept(batches, column: str, untouched: bool = False):
    """Batches with the kept words in ``column`` and how many words there were and went; with
    ``untouched`` a text that loses no word stays as it is."""
    for batch in batches:
        texts, counts, gone = [], [], []
        for text, found in zip(batch.column(column).cast(pa.large_binary()).to_pylist(),
                               batch.column("_spans").to_pylist()):
            words = words_of(text)
            keep = np.ones(len(words), bool)
            for s in found or ():
                keep[s["start"]:s["end"]] = False
            counts.append(len(words))
            gone.append(int(len(words) - keep.sum()))
            if untouched and not gone[-1]:
                texts.append(None if text is None else text.decode())
                continue
            if gone[-1]:
                words = [words[i] for i in np.flatnonzero(keep)]
            texts.append(b" ".join(words).decode())
        rest = {c: batch.column(c) for c in batch.schema.names if c not in (column, "_spans")}
        yield pa.record_batch(rest | {column: pa.array(texts, pa.string()),
                                      "_words": pa.array(counts, pa.int64()),
                                      "_removed": pa.array(gone, pa.int64())})


def _parted(docs: DataFrame, window: int, doc_id: str, text: str):
    """Rows of ``docs`` that no span touches, and the others with ``_spans``."""
    found = stored(spans(docs, window, doc_id=doc_id, text=text), "spans").select(
        F.col("key").alias("_found"), F.col("spans").alias("_spans"))
    key = F.xxhash64(doc_id, text)
    marked = docs.withColumn("_hit", maybe_in(key, bitmap(found.select("_found"))))
    none = F.lit(None).cast("array<struct<start: int, end: int>>").alias("_spans")
    cut = marked.filter("_hit").drop("_hit").join(found, key == F.col("_found"), "left")
    return marked.filter(~F.col("_hit")).select(*docs.columns, none), cut.drop("_found")


def deduplicated(docs: DataFrame, window: int = 50, *, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Every row as ``doc_id, text, n_words, n_removed``: the kept words, one space between.

    A null text has no words.  A null id is neither earlier nor later than any: such rows stay
    whole and remove nothing, and rows of one id do not remove each other's words.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    clean, cut = _parted(rows, window, "doc_id", "text")
    kind = "doc_id long, text string, _words long, _removed long"
    made = clean.unionByName(cut).mapInArrow(lambda b: lean(_kept(b, "text")), kind)
    return made.select("doc_id", "text", F.col("_words").alias("n_words"),
                       F.col("_removed").alias("n_removed"))


def cut(docs: DataFrame, window: int = 50, *, doc_id: str = "doc_id",
        text: str = "text") -> DataFrame:
    """``docs`` with its columns: untouched texts as they are, of others the kept words; rows of
    which nothing is left go.  Nulls as in ``deduplicated``."""
    clean, touched = _parted(docs, window, doc_id, text)
    order = [f for f in touched.schema.fields if f.name not in (text, "_spans")]
    kind = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in order),
                      f"`{text}` string", "_words long", "_removed long"])
    made = touched.mapInArrow(lambda b: lean(_kept(b, text, untouched=True)), kind)
    left = made.filter((F.col("_removed") == 0) | (F.col("_removed") < F.col("_words")))
    return clean.select(docs.columns).unionByName(left.select(docs.columns))
