"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  A trigram is the product of its letters'
vectors, the first rolled by two places, the second by one.  A document is the sum of its
trigrams, a language the sum of its documents' unit vectors, and the nearest prototype by
cosine names the language.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import held, reachable

#: Below U+0300 there are no marks, and number signs are the only word characters to leave out.
_OTHER, _BEYOND = re.compile(r"[\W\d_²³¹¼½¾]+"), re.compile("[^\u0000-\u02ff]")
_KEPT, _BLOCK = 30_000, 1_000
#: How far below the bar clean texts of n trigrams were seen, times n (the four test languages).
DOUBT = 4.0


@cache
def _no_letters():
    """All but letters and the marks that follow them."""
    import regex

    return regex.compile(r"[^\p{L}\p{M}]+|(?<![\p{L}\p{M}])\p{M}+")


class Space:
    """Trigram vectors; those seen lately are kept, up to ``_KEPT`` of them."""

    def __init__(self, dims: int, seed: int):
        self.dims, self.seed, self.letters = dims, seed, {}
        self.row: dict[int, int] = {}
        self.vectors = np.zeros((1024, dims), np.int8)

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            flips = np.random.default_rng((self.seed, code)).integers(0, 2, self.dims)
            self.letters[code] = (flips * 2 - 1).astype(np.int8)
        return self.letters[code]

    def _rows(self, grams: list[int]) -> list[int]:
        if len(self.row) + len(grams) > _KEPT:
            self.row.clear()
        out = []
        for gram in grams:
            at = self.row.get(gram)
            if at is None:
                at = self.row[gram] = len(self.row)
                if at >= len(self.vectors):
                    self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
                a, b, c = gram >> 42, gram >> 21 & 0x1FFFFF, gram & 0x1FFFFF
                self.vectors[at] = (np.roll(self.letter(a), 2) * np.roll(self.letter(b), 1)
                                    * self.letter(c))
            out.append(at)
        return out

    @staticmethod
    def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """A text's distinct letter trigrams, words set apart by one space, and their counts;
        nothing for a text without letters."""
        low = (text or "").lower()
        plain = (_no_letters() if _BEYOND.search(low) else _OTHER).sub(" ", low).strip()
        if not plain:
            return None
        codes = np.frombuffer(f" {plain} ".encode("utf-32-le", "replace"), "<u4").astype(np.int64)
        return np.unique(codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:], return_counts=True)

    def profile(self, text: str | None) -> np.ndarray | None:
        """The unit vector of a text's trigrams; nothing for a text without letters."""
        found = self.trigrams(text)
        return None if found is None else self.bundle(*found)

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray | None:
        total = np.zeros(self.dims, np.float32)
        for at in range(0, len(grams), _BLOCK):
            rows = self._rows(grams[at:at + _BLOCK].tolist())
            total += counts[at:at + _BLOCK].astype(np.float32) @ self.vectors[rows].astype(np.float32)
        length = float(np.linalg.norm(total))
        return total / length if length else None


def space(dims: int, seed: int) -> Space:
    return held(("space", dims, seed), lambda: Space(dims, seed))


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    prototypes: np.ndarray
    dims: int
    seed: int


def fit(labelled: DataFrame, *, text: str = "text", lang: str = "lang", dims: int = 1024,
        seed: int = 7, most: int = 20_000) -> Model:
    """Prototypes of the non-null languages of ``labelled``.

    ``most`` bounds the rows learned from: with more labelled rows a random share of about
    that many is used.  So there are at most about ``most`` languages, and their sums, added
    up by Spark place by place, are all that reaches the driver.
    """
    reachable(labelled.sparkSession)
    rows = labelled.filter(F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"))
    share = most / max(rows.count(), 1)
    if share < 1:
        rows = rows.filter(F.pmod(F.xxhash64("text", F.lit(seed)), F.lit(1 << 30)) < share * (1 << 30))

    def bundle(batches):
        made, sums = space(dims, seed), {}
        for batch in batches:
            for name, body in zip(*(batch.column(c).to_pylist() for c in ("lang", "text"))):
                vector = made.profile(body)
                if vector is not None:
                    sums[name] = sums.get(name, 0) + vector.astype(np.float64)
        if sums:
            yield pa.record_batch({"lang": pa.array(list(sums)), "v": pa.array(
                [v.tolist() for v in sums.values()], pa.list_(pa.float64()))})

    sums = (rows.mapInArrow(bundle, "lang string, v array<double>")
            .select("lang", F.posexplode("v").alias("at", "x")).groupBy("lang", "at")
            .agg(F.sum("x").alias("x")).groupBy("lang").agg(F.transform(
                F.sort_array(F.collect_list(F.struct("at", "x"))), lambda s: s["x"]).alias("v"))
            .orderBy("lang").collect())  # one row a language
    names = tuple(r["lang"] for r in sums)
    table = np.array([r["v"] for r in sums]).reshape(len(names), dims)
    norms = np.linalg.norm(table, axis=1, keepdims=True)
    return Model(names, (table / np.where(norms > 0, norms, 1)).astype(np.float32), dims, seed)


def predict(text, model: Model):
    """(lang_pred, score) of a text column: the nearest language, ties to the first by name, and
    its cosine, negative ones as 0.  ``und`` and 0 for null, without letters (number signs such as
    ``²`` or ``Ⅷ`` are none; marks belong to the letter before them) or without a model.  Whole
    texts of any length count."""

    @F.arrow_udf("lang_pred string, score double")
    def made(texts: pa.Array) -> pa.Array:
        known, names, scores = space(model.dims, model.seed), [], []
        for body in texts.to_pylist():
            vector = known.profile(body) if model.languages else None
            near = [] if vector is None else model.prototypes @ vector
            best = int(np.argmax(near)) if len(near) else -1
            names.append(model.languages[best] if best >= 0 else "und")
            scores.append(min(1.0, max(0.0, float(near[best]))) if best >= 0 else 0.0)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()),
                                           pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return made(text)


def learned(text, model: Model):
    """False for null, for texts without letters, and for those that are in no learned language
    beyond doubt.  Of ``dims`` signs an unrelated text has a cosine of 0 with a deviation of
    1 / sqrt(dims); the greatest of k is sqrt(2 ln k) of those higher, and three are allowed on
    top.  The cosine of a text of n distinct trigrams with its own language is uncertain too, by
    about ``DOUBT`` / n: so much lower it has to lie.  The bar of a short text is below
    any cosine.  A model without languages tells nothing: all True."""
    count = max(len(model.languages), 1)
    noise = (3 + np.sqrt(2 * np.log(count))) / np.sqrt(model.dims)

    @F.arrow_udf("boolean")
    def made(texts: pa.Array) -> pa.Array:
        known, out = space(model.dims, model.seed), []
        for body in texts.to_pylist():
            found = known.trigrams(body) if model.languages else None
            if found is None:
                out.append(not model.languages)
            else:
                vector = known.bundle(*found)
                bar = noise - DOUBT / len(found[0])
                out.append(vector is not None and float((model.prototypes @ vector).max()) > bar)
        return pa.array(out, pa.bool_())

    return made(text)
