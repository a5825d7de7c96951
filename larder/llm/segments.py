"""The tokenizers library over whole texts, one distinct segment at a time.

Both vocabularies never merge across the step from a visible character to white space: their
split patterns hold white space at the front of a match only.  A text cut at these steps gives,
segment by segment, the same ids as in one piece, and most segments have been seen before.
A segment that is one plain word goes to the library's merge model directly, without the
normalizing and splitting that would leave it as it is; any other one to the whole tokenizer.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable

from larder.llm.common import held

#: White space beyond ASCII, or characters on which libraries differ: such a text is cut nowhere.
_UNSURE = re.compile(
    "[\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -‍    ⁠　﻿]")
_SEGMENT = re.compile("[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
#: Texts of these hold nothing that normalizing changes, but for capitals.
_LATIN = re.compile("[!-~À-ÖØ-öø-ÿ ]+")
_LATIN_TEXT = re.compile("[\t\n\r -~À-ÖØ-öø-ÿ]*")
_MARK = re.compile("(?<=[a-zà-öø-ÿ])([,.;:!?])(?![^ \t\n\r])")
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: A plain word, where a blank before it belongs to it and where not.
_PLAIN = {True: re.compile(f" ?{_LETTERS.pattern}"), False: _LETTERS}
_MARKS = ",.;:!?"
_LONGEST = 96
#: Characters of texts whose new segments are encoded together.
_STRETCH = 1 << 18


def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


def byte_letters() -> dict[int, str]:
    """Latin-1 characters as the printable letters that byte-level vocabularies write for the
    bytes of their UTF-8 form: visible bytes stand for themselves, the others follow 255."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letter = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(256)}


class Memo(dict):
    """Segment to its ids as little-endian unsigned 32-bit integers.

    At most ``room`` entries in two generations: a full young one becomes the old one, and
    what is used again moves to the young one.
    """

    def __init__(self, path: str, room: int = 400_000):
        super().__init__()
        self.half, self.old = room // 2, {}
        self.load(path)

    def load(self, path: str) -> None:
        self.library = library(path)
        self.model, self.letters = self.library.model, byte_letters()
        self.spaced = self._whole(" a") != self._whole("a")
        self.lower = self._whole("A") == self._whole("a")

    def _whole(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _merged(self, word: str) -> bytes:
        made = self.model.tokenize(word.translate(self.letters))
        return array("I", [t.id for t in made]).tobytes()

    def __missing__(self, segment: str) -> bytes:
        if len(segment) > _LONGEST:
            return self._whole(segment)
        made = self.old.get(segment) if self.old else None
        if made is None:
            made = self._made(segment)
        self._room(1)
        self[segment] = made
        return made

    def _room(self, more: int) -> None:
        if len(self) + more > self.half:
            self.old = dict(self)
            self.clear()

    def learn(self, segments: list[str]) -> None:
        """Takes in distinct segments that the young generation lacks, new ones at once."""
        old = self.old
        known = {s: old[s] for s in segments if s in old} if old else {}
        found = [s for s in segments if len(s) <= _LONGEST and s not in known]
        made = self._all(found)
        self._room(len(known) + len(found))
        self.update(known)
        self.update(zip(found, made))

    def _all(self, segments: list[str]) -> list[bytes]:
        return [self._made(s) for s in segments]

    def _made(self, segment: str) -> bytes:
        if self.lower and not segment.islower() and "<|" not in segment:
            low = segment.lower()
            if low != segment and _LATIN.fullmatch(segment):
                return self[low]
        if segment[-1] in _MARKS and segment[-2:-1].isalpha() and _LATIN.fullmatch(segment):
            return self[segment[:-1]] + self[segment[-1]]
        word = segment[1:] if self.spaced and segment[0] == " " else segment
        if _LETTERS.fullmatch(word):
            return self._merged(segment)
        return self._whole(segment)

    def cut(self, text: str) -> list[str]:
        """The text's segments.  Of a Latin text that case does not matter for, capitals and the
        marks behind words are taken apart at once, so that a word has one entry."""
        if self.lower and not self.spaced and _LATIN_TEXT.fullmatch(text) and "<|" not in text:
            return _MARK.sub(r" \1", text.lower()).split()
        if _UNSURE.search(text):
            return [text]
        return _SEGMENT.findall(text) if self.spaced else text.split()

    def ids(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.cut(text)))

    def many(self, texts: Iterable[str | None]) -> list[bytes]:
        """The ids of each text, none for null; what a stretch of texts brings anew is encoded at once."""
        out, stretch, size = [], [], 0
        for text in texts:
            stretch.append(self.cut(text) if text else [])
            size += len(text or "")
            if size >= _STRETCH:
                out += self._stretch(stretch)
                stretch, size = [], 0
        return out + self._stretch(stretch)

    def _stretch(self, cuts: list[list[str]]) -> list[bytes]:
        self.learn([s for s in set().union(*cuts) if s not in self])
        return [b"".join(map(self.__getitem__, cut)) for cut in cuts]


def memo(path: str, kind: type[Memo] = Memo) -> Memo:
    """The worker's memo of a vocabulary."""
    return held((kind.__name__, path), lambda: kind(path))
