"""Splitting texts into pieces on whole arrays of code points, and 64-bit keys of the pieces.

A batch of texts becomes one array. Characters fall into letters, numbers, white space and others;
pieces are runs of a class, with the few exceptions that the tokenizers' patterns make. Only
characters that are as old as Unicode 3.2 and kept their class are split in this way. A text with
any other character is left to the caller, who splits it by the pattern itself.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

OTHER, LETTER, NUMBER, SPACE = range(4)

#: Words that a worker remembers the values of.
REMEMBERED = 400_000

#: The code points with the property White_Space.
WHITE_SPACE = (*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
               0x202F, 0x205F, 0x3000)

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9))


def _kind(category: str) -> int:
    return {"L": LETTER, "N": NUMBER}.get(category[0], OTHER)


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: its class; whether the class is the same in old and new tables."""
    table, steady = np.zeros(0x10000, np.uint8), np.zeros(0x10000, bool)
    for point in range(0x10000):
        char = chr(point)
        table[point] = _kind(unicodedata.category(char))
        old = unicodedata.ucd_3_2_0.category(char)
        steady[point] = (old not in ("Cn", "Cs") and _kind(old) == table[point]
                         and (old[0] == "Z") == (unicodedata.category(char)[0] == "Z"))
    table[list(WHITE_SPACE)] = SPACE
    return table, steady


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts in one array, and the bounds of the texts in it."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    return points, bounds


def kinds(points: np.ndarray) -> np.ndarray:
    """The class of each code point."""
    found = _tables()[0][np.minimum(points, 0xFFFF)]
    far = np.flatnonzero(points >= 0x10000)
    if len(far):
        some, back = np.unique(points[far], return_inverse=True)
        found[far] = np.array([_kind(unicodedata.category(chr(p))) for p in some], np.uint8)[back]
    return found


def steady_texts(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which texts hold only characters that ``split`` may treat."""
    _, steady = _tables()
    odd = (points >= 0x10000) | ~steady[np.minimum(points, 0xFFFF)]
    counts = np.zeros(len(points) + 1, np.int64)
    np.cumsum(odd, out=counts[1:])
    return counts[bounds[1:]] == counts[bounds[:-1]]


@dataclass
class Pieces:
    """Pieces ``points[start:end]`` in order, and the text each belongs to."""

    points: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray

    def keys(self) -> np.ndarray:
        """64-bit keys: the sum of a mixed value of each character with its place in the piece."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        size = self.end - self.start
        begins = np.cumsum(size) - size
        total = int(size.sum())
        flat = self.points
        if total < len(flat):
            flat = flat[np.arange(total) + np.repeat(self.start - begins, size)]
        # its place in the piece, from 1: that in all pieces less that of the piece's begin
        mixed = np.arange(1, total + 1, dtype=np.uint64)
        mixed -= np.repeat(begins.astype(np.uint64), size)
        mixed *= _B
        mixed += flat * _A
        mixed ^= mixed >> np.uint64(31)
        mixed *= _C
        mixed ^= mixed >> np.uint64(29)
        mixed *= _A
        mixed ^= mixed >> np.uint64(32)
        total = np.add.reduceat(mixed, begins)
        return (total ^ (total >> np.uint64(33))) * _C + size.astype(np.uint64)


def split(points: np.ndarray, bounds: np.ndarray, spaced: bool, digits: bool) -> Pieces:
    """Pieces of all texts.

    A short English ending after an apostrophe ('s 't 're 've 'm 'll 'd) is a piece of its own.
    ``spaced``: white space is kept, and a blank right before a run belongs to that run; else white
    space is left out. ``digits``: each number character stands alone.
    """
    n = len(points)
    if not n:
        none = np.zeros(0, np.int64)
        return Pieces(points, none, none, none)
    of_point = kinds(points)
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(of_point[1:], of_point[:-1], out=new[1:])
    if digits:
        new |= of_point == NUMBER
    begins_text = np.zeros(n + 1, bool)
    begins_text[bounds] = True
    new |= begins_text[:n]
    start = np.flatnonzero(new)
    end = np.append(start[1:], n)
    kind = of_point[start]
    first = begins_text[start]  # the run begins its text
    last = begins_text[end]
    if spaced:
        # the last character of white space before a run: joins it if blank, else stands alone
        before = np.flatnonzero((kind == SPACE) & ~last)
        joined = points[end[before] - 1] == 0x20
        alone = before[~joined]
        alone = alone[end[alone] - start[alone] > 1]
        joined = before[joined]
        cut = end[alone] - 1
        start[joined + 1] -= 1
        end[joined] -= 1
    # an apostrophe alone, at the start of a match, before letters
    quote = np.flatnonzero((kind[:-1] == OTHER) & (kind[1:] == LETTER) & (end[:-1] - start[:-1] == 1))
    quote = quote[(points[start[quote]] == 0x27) & ~last[quote] & ~first[quote + 1]]
    if len(quote):
        at, stop = start[quote] + 1, end[quote + 1]
        one = points[at]
        two = np.where(stop - at > 1, points[np.minimum(at + 1, n - 1)], 0)
        size = np.where(np.isin(one, [0x73, 0x74, 0x6D, 0x64]), 1, 0)
        pairs = [(0x72, 0x65), (0x76, 0x65), (0x6C, 0x6C)]
        size = np.where(np.logical_or.reduce([(one == a) & (two == b) for a, b in pairs]), 2, size)
        end[quote] += size
        start[quote + 1] += size
    if spaced and len(alone):
        end[alone] = cut
        start, end = np.concatenate([start, cut]), np.concatenate([end, cut + 1])
        order = np.argsort(start, kind="stable")
        start, end = start[order], end[order]
    elif not spaced:
        start, end = start[kind != SPACE], end[kind != SPACE]
    filled = end > start
    start, end = start[filled], end[filled]
    return Pieces(points, start, end, np.searchsorted(bounds, start, "right") - 1)


def word_pieces(texts: list[str]) -> tuple[Pieces, str]:
    """Runs of letters of the lower-cased texts; the texts joined."""
    lowered = [t.lower() for t in texts]
    points, bounds = code_points(lowered)
    pieces = split(points, bounds, spaced=False, digits=True)
    keep = kinds(points[pieces.start]) == LETTER
    return (Pieces(points, pieces.start[keep], pieces.end[keep], pieces.text[keep]),
            "".join(lowered))


def ngram_keys(spelled: list[str], order: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """For each letter and the end of each word: the word; the keys of the n-grams of 0, 1, ..
    letters that end there (0 where one would reach past the begin of the word)."""
    size = np.array([len(w) + 2 for w in spelled], np.int64)  # with begin and end marks
    points = np.frombuffer("".join(f"\x02{w}\x03" for w in spelled).encode("utf-32-le"), np.uint32)
    owner = np.repeat(np.arange(len(spelled)), size)
    place = np.arange(len(points)) - np.repeat(np.cumsum(size) - size, size)
    letters = points.astype(np.uint64)
    letters += np.uint64(1)
    letters *= _A
    letters ^= letters >> np.uint64(29)
    letters *= np.uint64(0xBF58476D1CE4E5B9)
    keys, key = [np.ones(len(points), np.uint64)], np.ones(len(points), np.uint64)
    for back in range(order):
        shifted = np.roll(letters, back)
        key = (key ^ shifted) * _A + np.uint64(back + 1)
        key ^= key >> np.uint64(32)
        keys.append(np.where(place >= back, key, np.uint64(0)))
    return owner, keys, place


class WordValues:
    """A value for each distinct word, remembered in a bounded table between batches."""

    def __init__(self, of: Callable[[list[str]], np.ndarray], width: int = 1,
                 most: int = REMEMBERED) -> None:
        self.of, self.width, self.most = of, width, most
        self._clear()

    def _clear(self) -> None:
        self.keys, self.values = np.zeros(0, np.uint64), np.zeros((0, self.width), np.float32)

    def __call__(self, pieces: Pieces, whole: str) -> np.ndarray:
        """The value of each piece, a row each."""
        keys, index, back = np.unique(pieces.keys(), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.most:
            self._clear()
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inner = place < len(self.keys)
        known[inner] = self.keys[place[inner]] == keys[inner]
        new = np.flatnonzero(~known)
        if len(new):
            spans = zip(pieces.start[index[new]].tolist(), pieces.end[index[new]].tolist())
            values = self.of([whole[a:b] for a, b in spans]).reshape(len(new), self.width)
            self.keys = np.insert(self.keys, place[new], keys[new])
            self.values = np.insert(self.values, place[new], values, axis=0)
            place = np.searchsorted(self.keys, keys)
        return self.values[place][back]
