"""Byte-level BPE: encoding by merges and by longest matches with backtracking, and decoding.

Short pieces are merged by rank, many of them side by side: each step merges in every piece the
pair of lowest rank, the first of several, until no piece has a pair left.

In long pieces bytes are read as Latin-1 letters, so a trie of letters finds for every place that is reached
the longest token that starts there.  From the front the longest token is taken that fits its left
neighbour and does not end where the rest is known to be impossible; else a shorter one, else
the last token is given back.  Every place is given up once at most, so a piece of any length
takes linear time.  Two tokens fit if merging their bytes by rank gives just these two: a
sequence in which all neighbours fit is the merges' own result.
"""

from __future__ import annotations

import base64
from array import array
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from larder.llm.common import lists
from larder.llm.segments import _PLAIN, Memo, memo


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def merged(ranks: dict[bytes, int], data: bytes) -> list[int]:
    """Plain merging of the pair of lowest rank, again and again; for short strings."""
    parts = [data[i:i + 1] for i in range(len(data))]
    while len(parts) > 1:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i)
                       for i in range(len(parts) - 1))
        if rank == 1 << 60:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


class Merges:
    """All pairs of tokens that make a token, and the merging of many short strings at once."""

    NONE = (1 << 31) - 1
    ROWS = 8_192  # strings side by side

    def __init__(self, ranks: dict[bytes, int]):
        self.end = end = max(ranks.values(), default=-1) + 1  # stands beyond a string's ends
        self.single = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        get, keys, made = ranks.get, array("q"), array("i")
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = get(token[:i]), get(token[i:])
                if left is not None and right is not None:
                    keys.append(left * (end + 1) + right)
                    made.append(rank)
        keys, made = np.frombuffer(keys, np.int64), np.frombuffer(made, np.int32)
        order = np.argsort(keys)
        # the last entry is beyond all pairs, so that a search always ends on an entry
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.made = np.append(made[order], np.int32(self.NONE))

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token of each pair, ``NONE`` where two do not make one."""
        key = left.astype(np.int64) * (self.end + 1) + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.made[at], np.int32(self.NONE))

    def merged(self, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of the strings, one after the other, and how many each has."""
        sizes = np.array([len(s) for s in strings])
        width = int(sizes.max()) + 2
        tokens = np.full((len(strings), width), self.end, np.int32)
        inside = np.arange(-1, width - 1)
        inside = (inside >= 0) & (inside < sizes[:, None])
        tokens[inside] = self.single[np.frombuffer(b"".join(strings), np.uint8)]
        if (tokens < 0).any():
            raise ValueError("a byte without a token")
        pairs = np.full(tokens.shape, self.NONE, np.int32)
        pairs[:, :-1] = self.pair(tokens[:, :-1], tokens[:, 1:])
        token, made = tokens.reshape(-1), pairs.reshape(-1)
        after, before = np.arange(1, token.size + 1), np.arange(-1, token.size - 1)
        rows = np.arange(len(strings))
        while rows.size:
            at = rows * width + pairs[rows].argmin(axis=1)
            rank = made[at]
            some = rank != self.NONE
            rows, at, rank = rows[some], at[some], rank[some]
            gone, back = after[at], before[at]
            on = after[gone]
            token[at], token[gone], made[gone] = rank, -1, self.NONE
            after[at], before[on] = on, at
            made[at] = self.pair(rank, token[on])
            made[back] = self.pair(token[back], rank)
        left = inside & (tokens >= 0)
        return tokens[left], left.sum(axis=1)


class Codec:
    """One table of the vocabulary's bytes and one of its pairs; for long pieces a trie of the tokens
    that merges can give, and what was found out about neighbours, of bounded size."""

    FITS, EDGES = 400_000, 16_000
    SHORT = 64  # bytes of a piece that takes part in merging side by side

    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        self.bytes = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, i in self.ranks.items():
            self.bytes[i] = token
        self.table = pa.array(self.bytes, pa.binary())
        self.merges = Merges(self.ranks)
        self.fits: dict[int, bool] = {}
        self.edges: tuple[dict[int, list], dict[int, list]] = ({}, {})

    @cached_property
    def size(self) -> array:
        return array("I", [len(t) for t in self.bytes])

    @cached_property
    def longest(self) -> int:
        return max(self.size, default=0)

    @cached_property
    def unmade(self) -> set[int]:
        """Tokens that merges never give: such a one is only a whole piece."""
        return {i for t, i in self.ranks.items() if merged(self.ranks, t) != [i]}

    @cached_property
    def trie(self):
        import ahocorasick

        made = ahocorasick.Automaton()
        for token, i in self.ranks.items():
            if i not in self.unmade:
                made.add_word(token.decode("latin-1"), i)
        return made

    @cached_property
    def shorter(self) -> dict[int, int]:
        return {i: self.within(t[:-1]) for t, i in self.ranks.items() if i not in self.unmade}

    def within(self, data: bytes) -> int:
        """The longest token that ``data`` starts with, -1 for none."""
        ranks, unmade = self.ranks, self.unmade
        for n in range(len(data), 0, -1):
            token = ranks.get(data[:n])
            if token is not None and token not in unmade:
                return token
        return -1

    def edge(self, token: int, last: bool) -> list[tuple[bytes, int, float]]:
        """How the first (or last) part of a token grows while its bytes are merged: the part,
        and the levels at which it comes and goes.  A level is the highest rank merged so far:
        whatever can be merged at a lower rank is merged before the level rises."""
        if (known := self.edges[last].get(token)) is not None:
            return known
        data = self.bytes[token]
        parts, level, out = [data[i:i + 1] for i in range(len(data))], -1, []
        since, now = -1, parts[-1 if last else 0]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i)
                           for i in range(len(parts) - 1))
            level = max(level, rank)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            if parts[-1 if last else 0] != now:
                out.append((now, since, level))
                since, now = level, parts[-1 if last else 0]
        if len(self.edges[last]) >= self.EDGES:
            self.edges[last].clear()
        self.edges[last][token] = out = [*out, (now, since, float("inf"))]
        return out

    def apart(self, a: int, b: int) -> bool:
        """Whether merging never crosses from a to b.  Only the parts next to the seam matter;
        where two merges fall on one level, the plain merging decides."""
        i = j = 0
        left, right = self.edge(a, True), self.edge(b, False)
        while True:
            (x, x_from, x_to), (y, y_from, y_to) = left[i], right[j]
            rank, ends = self.ranks.get(x + y), min(x_to, y_to)
            crosses = float("inf") if rank is None else max(rank, x_from, y_from)
            if crosses < ends:
                return False
            if x_to == y_to == crosses == float("inf"):
                return True
            if crosses == ends or x_to == y_to:
                return merged(self.ranks, self.bytes[a] + self.bytes[b]) == [a, b]
            i, j = (i + 1, j) if x_to < y_to else (i, j + 1)

    def fit(self, a: int, b: int) -> bool:
        if len(self.fits) >= self.FITS:
            self.fits.clear()
        known = self.fits[a << 32 | b] = self.apart(a, b)
        return known

    def piece(self, data: bytes) -> list[int]:
        """The ids of one piece of the split pattern."""
        ranks = self.ranks
        if (whole := ranks.get(data)) is not None:
            return [whole]
        text, n, longest, prefix = data.decode("latin-1"), len(data), self.longest, self.trie.longest_prefix
        size, shorter, known, unmade = self.size, self.shorter, self.fits.get, self.unmade
        out, at, dead, last = [], 0, bytearray(n + 1), -1
        token = -2  # not looked for yet
        while at < n:
            if token == -2:  # the trie knows how far a token's letters go on from here
                end = at + prefix(text[at:at + longest])
                token = ranks.get(data[at:end], -1)
                if token < 0 or token in unmade:
                    token = self.within(data[at:end - 1])
            while token >= 0:
                if not dead[at + size[token]]:
                    if last < 0:
                        break
                    fits = known(last << 32 | token)
                    if fits or fits is None and self.fit(last, token):
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += size[token]
                last, token = token, -2
            else:
                if not out:
                    raise ValueError("a byte without a token")
                dead[at] = 1
                token = out.pop()
                at -= size[token]
                last, token = out[-1] if out else -1, shorter[token]
        return out


    def pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece as little-endian unsigned 32-bit integers."""
        out, short = [b""] * len(pieces), []
        for i, data in enumerate(pieces):
            whole = self.ranks.get(data)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(data) > self.SHORT:
                out[i] = array("I", self.piece(data)).tobytes()
            elif data:
                short.append(i)
        short.sort(key=lambda i: len(pieces[i]))  # side by side with others of their length
        for n in range(0, len(short), self.merges.ROWS):
            some = short[n:n + self.merges.ROWS]
            ids, sizes = self.merges.merged([pieces[i] for i in some])
            flat, at = ids.astype("<u4").tobytes(), 0
            for i, end in zip(some, (4 * np.cumsum(sizes)).tolist()):
                out[i], at = flat[at:end], end
        return out


class Pieces(Memo):
    """Segment to ids by the codec; ``path`` is the rank file and the split pattern."""

    def load(self, path) -> None:
        import regex

        file, pattern = path
        self.codec, self.split = Codec(file), regex.compile(pattern)
        self.spaced, self.lower = True, False

    def _merged(self, word: str) -> bytes:
        return self.codec.pieces([word.encode()])[0]

    def _whole(self, text: str) -> bytes:
        return b"".join(self.codec.pieces([p.encode() for p in self.split.findall(text)]))

    def _all(self, segments: list[str]) -> list[bytes]:
        plain, split = _PLAIN[True].fullmatch, self.split.findall
        parts = [(s,) if plain(s) else split(s) for s in segments]
        known = list(set().union(*parts))
        made = dict(zip(known, self.codec.pieces([p.encode() for p in known])))
        return [b"".join(map(made.__getitem__, p)) for p in parts]


def encode(text, ranks: str, pattern: str):
    """The ids (array of int) of a text column; null gives none.  Each match of ``pattern`` is
    merged by itself; strings of special tokens are ordinary text.  A text of any length is one
    row; a column expression, so rows, repeated or none, and other columns stay as they are."""

    @F.arrow_udf("array<int>")
    def made(texts: pa.Array) -> pa.Array:
        known = memo((ranks, pattern), Pieces)
        parts = known.many(texts.to_pylist())
        return lists(np.frombuffer(b"".join(parts), "<i4"), [len(p) // 4 for p in parts],
                     pa.int32())

    return made(text)


def decode(ids, ranks: str, pattern: str):
    """The bytes of a column of ids; null gives none."""

    @F.arrow_udf("binary")
    def made(column: pa.Array) -> pa.Array:
        taken = memo((ranks, pattern), Pieces).codec.table.take(column.flatten())
        if taken.null_count:
            raise ValueError("a null among the ids")
        ends = np.cumsum([0, *column.value_lengths().fill_null(0).to_pylist()])
        # the tokens' bytes lie one after the other: only the rows' ends are to be found
        starts = np.frombuffer(taken.buffers()[1], np.int32)[ends] if len(taken) else ends
        return pa.Array.from_buffers(pa.binary(), len(column), [
            None, pa.py_buffer(starts.astype(np.int32)), taken.buffers()[2]])

    return made(ids)
