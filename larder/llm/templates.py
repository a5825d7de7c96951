"""Benchmark decontamination by canonical templates.

Numbers, units and names become typed placeholders, so a question asked again with other values
has the same template.  Windows of template tokens are joined by hash; then the slots' values
must agree: where a document asks the item, one value of it stands for one value throughout.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import bitmap, held, maybe_in, reachable, stored
from larder.llm.substring import _BASES, mixed, rolling, runs

#: Units of measure that follow a number.
UNITS = frozenset("""
mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg lb lbs oz pound pounds ton
tons ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour
hours day days week weeks month months year years percent dollar dollars cent cents euro euros usd
eur degree degrees celsius fahrenheit hz khz mhz ghz w kw mw wh kwh v a j kj n pa kpa bytes kb mb gb
""".split())
_TOKEN = re.compile(r"\d+(?:[.,:/]\d+)*|[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?\n]+|[%$€£°]")
_NUMBER_WORDS = frozenset("""
two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen
seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand
million billion dozen half twice
""".split())
#: Words that start sentences and are no names, whatever the benchmark has in lower case.
FUNCTION_WORDS = frozenset("""
a an the this that these those he she it we you they i my your his her its our their who whom whose
what which when where why how is are was were do does did has have had can could will would shall
should may might must if then there here and or but so for from in on at by to of with as after
before not no each every all some any
""".split())
NUMBER, UNIT, NAME = "\x01number", "\x02unit", "\x03name"


#: Sorts of characters; those of one sort in a row are a token, but signs are one each.
_LETTER, _DIGIT, _MARK, _SIGN = 1, 2, 3, 4
#: What else there is to a character, as bits: it may stand within a number or a word, its lower case
#: is another, it is a digit to none but ``isdigit``, its lower case is longer or not its own affair.
_JOINS, _APOSTROPHE, _CAPITAL, _DIGIT_LIKE, _ODD = 1, 2, 4, 8, 16
_EVERY, _PLACES = 0x110000, 1 << 16


class _Characters:
    """By code point the sort, the bits, and a random number for the character in lower case."""

    def __init__(self):
        every = "".join(map(chr, range(_EVERY)))
        self.sort, self.bits = np.zeros(_EVERY, np.uint8), np.zeros(_EVERY, np.uint8)
        for sort, pattern in ((_LETTER, r"[^\W\d_]+"), (_DIGIT, r"\d+"), (_MARK, r"[.!?\n]"), (_SIGN, r"[%$€£°]")):
            for run in re.finditer(pattern, every):
                self.sort[run.start():run.end()] = sort
        for bit, which in ((_JOINS, ".,:/"), (_APOSTROPHE, "'’")):
            self.bits[[ord(c) for c in which]] = bit
        low = np.arange(_EVERY, dtype=np.uint64)
        for at in np.flatnonzero(self.sort == _LETTER).tolist():
            c = every[at].lower()
            if len(c) > 1 or every[at] == "Σ":
                self.bits[at] |= _ODD
            else:
                low[at] = ord(c)
            if every[at].isdigit():
                self.bits[at] |= _DIGIT_LIKE
        self.bits[low != np.arange(_EVERY, dtype=np.uint64)] |= _CAPITAL
        self.value = mixed((low + np.uint64(1)) * np.uint64(_BASES[1]))
        self.power = np.full(_PLACES, _BASES[0], np.uint64)
        self.power[0] = 1
        self.power = np.cumprod(self.power)

    def hashes(self, code: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Of each run of characters, in lower case."""
        place = np.arange(len(code)) - np.repeat(start, length)
        return mixed(np.add.reduceat(self.value[code] * self.power[place & _PLACES - 1], start))

    def hash(self, word: str) -> np.uint64:
        return self.hashes(_codes(word), np.zeros(1, np.int64), np.array([len(word)]))[0]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


class _Words:
    """Characters, and the hashes of the words that templates treat in a way of their own."""

    def __init__(self, words: frozenset[str] | None):
        self.of = _Characters()
        self.numbers, self.units, self.lower = (
            np.sort(np.array([self.of.hash(w) for w in some], np.uint64))
            for some in (_NUMBER_WORDS, UNITS, words or ()))
        self.all_lower = words is None


def _in(h: np.ndarray, some: np.ndarray) -> np.ndarray:
    if not len(some):
        return np.zeros(len(h), bool)
    return some[np.minimum(np.searchsorted(some, h), len(some) - 1)] == h


#: By a token's sort: the word itself, or a slot.
_SORTS = ("", NUMBER, UNIT, NAME)
_SORT_HASHES = np.array([xxhash.xxh3_64_intdigest(s) for s in _SORTS], np.uint64)


def _template(text: str, known: _Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each template token where its word starts and ends, the word's hash, and the sort.

    Cuts as ``_TOKEN`` does, by arrays and not word by word.
    """
    of, code = known.of, _codes(text)
    if not len(code):
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.uint64), np.empty(0, np.int64))
    sort, bits = of.sort[code], of.bits[code]
    inner = np.flatnonzero(bits[1:-1] & (_JOINS | _APOSTROPHE)) + 1
    for bit, both in ((_JOINS, _DIGIT), (_APOSTROPHE, _LETTER)):
        at = inner[bits[inner] & bit != 0]
        sort[at[(sort[at - 1] == both) & (sort[at + 1] == both)]] = both
    start = np.flatnonzero(np.concatenate(([True], (sort[1:] != sort[:-1]) | (sort[1:] == _SIGN))))
    length = np.diff(np.append(start, len(code)))
    h, kind = of.hashes(code, start, length), sort[start]
    capital = bits & _CAPITAL != 0
    shape = (np.add.reduceat(capital, start, dtype=np.int64) == 1) & capital[start] & (length > 1)
    if (bits & _ODD).any():
        for i in np.unique(np.searchsorted(start, np.flatnonzero(bits & _ODD), "right") - 1).tolist():
            word = text[start[i]:start[i] + length[i]]
            low = word.lower()
            h[i] = of.hash(low)
            shape[i] = bool(word[1:]) and word[0] != low[0] and word[1:] == low[1:]
    some = np.flatnonzero(kind)
    start, end, h, kind, shape = start[some], (start + length)[some], h[some], kind[some], shape[some]
    letters = kind == _LETTER
    number = (kind == _DIGIT) | letters & (_in(h, known.numbers) | (bits[start] & _DIGIT_LIKE != 0))
    unit, name = kind == _SIGN, letters & shape & ~number
    behind = np.flatnonzero(number[:-1] & letters[1:] & ~number[1:]) + 1
    unit[behind] = _in(h[behind], known.units)
    name &= ~unit
    first = np.flatnonzero(name & np.concatenate(([True], kind[:-1] == _MARK)))
    name[first] = False if known.all_lower else ~_in(h[first], known.lower)
    made = number * 1 + unit * 2 + name * 3
    words = kind != _MARK
    return start[words], end[words], h[words], made[words]


def canonical(text: str, words: frozenset[str] | None = None
              ) -> tuple[list[str], list[tuple[int, str]]]:
    """Template tokens, and the slots as (place, value).  A name is a capitalized word that does
    not start a sentence, or that starts one and is none of ``words`` (without them none is);
    a unit is a known one right behind a number; sentence marks go."""
    start, end, _, sort = _template(text, held(("template-words", words), lambda: _Words(words)))
    low = [text[a:b].lower() for a, b in zip(start.tolist(), end.tolist())]
    return ([_SORTS[s] or v for s, v in zip(sort.tolist(), low)],
            [(i, low[i]) for i in np.flatnonzero(sort).tolist()])


def _lower(batches):
    """Words that the texts have in lower case: capitalized at a sentence's start, no names."""
    for batch in batches:
        found = {w for t in batch.column("text").to_pylist() for w in _TOKEN.findall(t)
                 if w[0].isalpha() and w == w.lower()}
        yield pa.record_batch({"word": pa.array(sorted(found), pa.string())})


def _windows(batches, width: int, fixed: int, seen: dict[int, np.ndarray] | None,
             words: frozenset[str]):
    """Rows (id, windows, at, h, slots, width) of the windows from each place.

    A window of ``width`` tokens with fewer than ``fixed`` tokens that are no slots goes on until
    it holds so many; where the text ends before, its own tokens are hashed, values in place of
    slots.  Items (no ``seen``) give one window for each place, those shorter than ``width`` one
    of their own; documents give, for each width that items have, those windows of either sort
    that ``seen`` may hold.  Short items of slots alone give none.
    """
    kind = pa.list_(pa.struct([("at", pa.int32()), ("value", pa.string())]))
    known = held(("template-words", words), lambda: _Words(words))
    for batch in batches:
        rows = []
        for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
            begin, until, plain, sort = _template(text, known)
            if not len(plain):
                continue
            places, hashes = np.flatnonzero(sort), np.where(sort != 0, _SORT_HASHES[sort], plain)
            firm = np.ones(len(plain), bool)
            firm[places] = False
            before, firm = np.concatenate(([0], np.cumsum(firm))), np.flatnonzero(firm)
            for n in [min(width, len(plain))] if seen is None else seen:
                if len(plain) < n or seen is None and len(plain) < width and not len(firm):
                    continue
                start = np.arange(len(plain) - n + 1)
                nth = before[start] + min(fixed, n) - 1
                whole = nth < len(firm)
                end = np.maximum(start + n, np.append(firm, 0)[np.where(whole, nth, -1)] + 1)
                wide = end > start + n
                if n < width:  # a short item ends with its window: never longer
                    whole &= ~wide
                h = rolling(hashes, n)
                longer = np.flatnonzero(whole & wide)
                if len(longer):
                    h[longer] = runs(hashes, longer, end[longer])
                exactly = np.flatnonzero(~whole if seen is None else wide | ~whole)
                exact = rolling(plain, n, _BASES[1])[exactly] if len(exactly) else h[:0]
                # equal values agree, so those windows need no slots: end is where they start
                for at, h, end in ((start[whole], h[whole], end[whole]),
                                   (exactly, exact, exactly)):
                    if seen is not None:
                        bit = (h & np.uint64(len(seen[n]) * 8 - 1)).astype(np.int64)
                        keep = (seen[n][bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
                        at, h, end = at[keep], h[keep], end[keep]
                    low, high = np.searchsorted(places, [at, end])
                    rows += [(key, len(start), i, x, [
                        {"at": p - i, "value": text[begin[p]:until[p]].lower()} for p in places[a:b].tolist()], n)
                             for i, x, a, b in zip(at.tolist(), h.view(np.int64).tolist(),
                                                   low.tolist(), high.tolist())]
        names = ("id", "windows", "at", "h", "slots", "width")
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), kind, pa.int32())
        for start in range(0, len(rows), 20_000):
            yield pa.record_batch({k: pa.array(c, t) for k, c, t in
                                   zip(names, zip(*rows[start:start + 20_000]), kinds)})


_ROWS = ("id long, windows int, at int, h long, slots array<struct<at: int, value: string>>, "
         "width int")
_BITS = 1 << 22
#: Tokens that values of other lengths move what follows them by, within one occurrence.
_SLACK = 3


def _bits(h) -> np.ndarray:
    """Low bits of the window hashes as a bitmap; the driver gets at most ``_BITS`` places."""
    found = h.select(F.col("h").bitwiseAND(F.lit(_BITS - 1)).cast("int").alias("b")).distinct()
    flags = np.zeros(_BITS, np.uint8)
    flags[found.toArrow()["b"].to_numpy()] = 1
    return np.packbits(flags, bitorder="little")


def matches(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
            item_id: str = "item_id", item_text: str = "text", width: int = 8, fixed: int = 5,
            coverage: float = 0.5) -> DataFrame:
    """``doc_id, item_id, windows, coverage, changed`` for documents that ask an item again.

    ``windows`` counts the item's distinct windows of ``width`` template tokens or more, ``fixed``
    of them no slots, found in the document's best occurrence of it with agreeing slots, ``coverage``
    is their share of the item's windows, at least ``coverage``.  Windows that hold fewer such tokens up to the
    item's end are looked for with their values; a short item of slots alone is not looked for.
    ``changed`` counts the slots whose value differs.  Items shorter than ``width`` tokens are
    one window and are looked for at their own width.  Null texts match nothing; rows of one id
    count as one document; the benchmark's equal texts count as one item each.  Whole texts of any
    length are looked through; an empty table on either side gives no rows, other columns take no
    part.  Of several occurrences the one with most windows counts, then that with fewer changes.
    """
    reachable(docs.sparkSession)
    asks = benchmark.filter(F.col(item_text).isNotNull() & F.col(item_id).isNotNull()).select(
        F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text")).distinct()
    # of the benchmark alone, so that a question reads alike in the item and in each document
    words = FUNCTION_WORDS | {r["word"] for r in asks.mapInArrow(_lower, "word string").distinct().collect()}
    items = stored(asks.mapInArrow(lambda b: _windows(b, width, fixed, None, words), _ROWS), "items")
    rows = docs.filter(F.col(text).isNotNull() & F.col(doc_id).isNotNull()).select(
        F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    widths = sorted(r["width"] for r in items.select("width").distinct().collect())  # <= width
    seen = {n: _bits(items.filter(F.col("width") == n)) for n in widths}
    own = items.select(F.col("id").alias("item"), "windows", F.col("at").alias("item_at"), "h",
                       F.col("slots").alias("item_slots"), "width")
    found = stored(rows.mapInArrow(lambda b: _windows(b, width, fixed, seen, words), _ROWS).drop("windows")
                   .join(own, ["h", "width"]), "template-hits")
    # an occurrence: hits that lie alike in item and document, but for values of other lengths
    lies = Window.partitionBy("id", "item").orderBy("shift", "item_at")
    apart = F.coalesce(F.col("shift") - F.lag("shift").over(lies) > _SLACK, F.lit(True))
    found = stored(found.withColumn("shift", F.col("at") - F.col("item_at")).withColumn(
        "apart", apart.cast("int")).withColumn("occurrence", F.sum("apart").over(
            lies.rowsBetween(Window.unboundedPreceding, 0))), "template-occurrences")
    one = ["id", "item", "occurrence"]
    pairs = F.arrays_zip(F.col("item_slots.value").alias("a"), F.col("slots.value").alias("b"))
    # an item's value by what it most often stands for there; other uses disagree
    votes = found.select(*one, F.explode(pairs).alias("s")).groupBy(*one, "s.a", "s.b").agg(
        F.count("*").alias("n")).groupBy(*one, "a").agg(
        F.max(F.struct("n", "b")).alias("best")).groupBy(*one).agg(
        F.map_from_entries(F.collect_list(F.struct("a", "best.b"))).alias("stands"))
    judged = found.join(votes, one, "left").withColumn("agrees", F.coalesce(F.forall(
        pairs, lambda s: (s["a"] == s["b"]) | (F.element_at("stands", s["a"]) == s["b"])), F.lit(True)))
    best = judged.filter("agrees").groupBy(*one).agg(
        F.count_distinct("item_at").alias("windows"),
        (F.count_distinct("item_at") / F.max("windows")).alias("coverage"),
        F.max(F.size(F.filter(pairs, lambda s: s["a"] != s["b"]))).cast("long").alias("changed"))
    return best.groupBy(F.col("id").alias("doc_id"), F.col("item").alias("item_id")).agg(
        F.max(F.struct("windows", "coverage", -F.col("changed"))).alias("m")).select(
        "doc_id", "item_id", "m.windows", "m.coverage", (-F.col("m.col3")).alias("changed")).filter(
        F.col("coverage") >= coverage)


def decontaminated(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id",
                   **options) -> DataFrame:
    """The rows of ``docs`` that repeat no item, with all their columns; null ids stay.

    Flagged ids are marked by a bitmap of bounded size; only rows it may hold are joined."""
    flagged = stored(matches(docs, benchmark, doc_id=doc_id, **options)
                     .select("doc_id").distinct(), "flagged")
    maybe = F.coalesce(maybe_in(F.col(doc_id).cast("long"), bitmap(flagged)), F.lit(False))
    held = docs.withColumn("_maybe", maybe)
    return held.filter(~F.col("_maybe")).drop("_maybe").unionByName(
        held.filter("_maybe").drop("_maybe").join(
            flagged.withColumnRenamed("doc_id", "_flagged"),
            F.col(doc_id).cast("long") == F.col("_flagged"), "left_anti"))
