"""Token ids of whole texts through their distinct pieces.

A worker meets the same pieces again and again. It encodes each distinct piece of a batch once,
keeps the ids of the frequent ones between batches and tasks in a bounded cache, and puts the ids
of the texts together by array lookups.
"""

from __future__ import annotations

import functools
import os
import unicodedata
from collections.abc import Callable

import numpy as np

from tidemark.llm import words

#: Pieces that a worker remembers; beyond them the ones met least often are forgotten.
REMEMBERED = 800_000


class PieceCache:
    """Ids by the key of a piece; ``encode`` gives the ids of a list of pieces and their counts."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
                 most: int = REMEMBERED) -> None:
        self.encode, self.most = encode, most
        self.keys = np.zeros(0, np.uint64)
        self.first = self.count = self.met = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _forget(self) -> None:
        best = np.sort(np.argsort(-self.met, kind="stable")[: self.most // 2])
        self.keys, first, self.count = self.keys[best], self.first[best], self.count[best]
        self.met = self.met[best] // 2
        self.ids = self.ids[ranges(first, self.count)]
        self.first = np.cumsum(self.count) - self.count

    def lookup(self, pieces: words.Pieces, whole: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces one after the other, and their number for each piece."""
        keys, index, back, times = np.unique(pieces.keys(), return_index=True, return_inverse=True,
                                             return_counts=True)
        if len(self.keys) > self.most:
            self._forget()
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inner = place < len(self.keys)
        known[inner] = self.keys[place[inner]] == keys[inner]
        new = np.flatnonzero(~known)
        if len(new):
            spans = zip(pieces.start[index[new]].tolist(), pieces.end[index[new]].tolist())
            ids, count = self.encode([whole[a:b] for a, b in spans])
            first = len(self.ids) + np.cumsum(count) - count
            self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])
            at = place[new]
            self.keys = np.insert(self.keys, at, keys[new])
            self.first = np.insert(self.first, at, first)
            self.count = np.insert(self.count, at, count)
            self.met = np.insert(self.met, at, 0)
            place = np.searchsorted(self.keys, keys)
        self.met[place] += times
        first, count = self.first[place][back], self.count[place][back]
        return self.ids[ranges(first, count)], count


def ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers first, first+1, .. of each range, all in one array."""
    if not len(count):
        return np.zeros(0, np.int64)
    ends = np.cumsum(count)
    return np.arange(ends[-1], dtype=np.int64) + np.repeat(first - ends + count, count)


@functools.cache
def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1
    characters for themselves, the other bytes in turn from U+0100."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(rest)}


class LibraryTokenizer:
    """Ids as the tokenizers library gives them for the whole text, without special tokens.

    Every distinct piece is encoded by the library's model. A text that cannot be split into pieces safely
    (see ``words``), or that the tokenizer would normalize in another way than by lower-casing,
    goes through the library whole. Strings of special tokens in a text are ordinary text.
    """

    def __init__(self, file: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(file)
        self.library.encode_special_tokens = True
        self.spaced = self.library.normalizer is None
        #: Type that holds every id, little-endian.
        self.type = "<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4"
        self.cache = PieceCache(self._encode_pieces)

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        tokenize, letters = self.library.model.tokenize, byte_letters()
        found = [[token.id for token in tokenize(p.encode().decode("latin-1").translate(letters))]
                 for p in pieces]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter((i for ids in found for i in ids), np.uint32, int(counts.sum()))
        return ids, counts

    def _plain(self, text: str) -> bool:
        return (unicodedata.is_normalized("NFC", text)
                and "İ" not in text and "Σ" not in text)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and their number for each text."""
        split = texts if self.spaced else [t.lower() if self._plain(t) else "\U0010ffff" for t in texts]
        points, bounds = words.code_points(split)
        good = words.steady_texts(points, bounds)
        if not good.all():
            split = [t if ok else "" for t, ok in zip(split, good)]
            points, bounds = words.code_points(split)
        pieces = words.split(points, bounds, self.spaced, digits=not self.spaced)
        ids, count = self.cache.lookup(pieces, "".join(split))
        counts = np.bincount(pieces.text, weights=count, minlength=len(texts)).astype(np.int64)
        if good.all():
            return ids, counts
        parts, ends = [], np.cumsum(counts)
        for place, ok in enumerate(good):
            if ok:
                parts.append(ids[ends[place] - counts[place]:ends[place]])
            else:
                parts.append(np.asarray(
                    self.library.encode(texts[place], add_special_tokens=False).ids, np.uint32))
                counts[place] = len(parts[-1])
        return np.concatenate(parts), counts


@functools.cache
def library_tokenizer(file: str) -> LibraryTokenizer:
    """One for each worker and file; its cache serves all tasks of the worker."""
    return LibraryTokenizer(file)
