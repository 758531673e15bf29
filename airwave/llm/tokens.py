"""Token ids of whole texts, by array operations and a cache of pieces.

A byte-level tokenizer first cuts a text by a pattern (words with the space before them, numbers,
other signs, white space) and encodes every piece by itself, so the ids of a piece can be kept.
Here the cuts are found on byte arrays, each distinct piece goes to the library's model once, and
the ids of a text are gathered from the kept ones. Texts with characters whose class isn't plain
(anything but ASCII and Latin letters) go to the library as a whole, so ids are always its own.
"""

from __future__ import annotations

import functools
from array import array

import numpy as np

from .words import _hashes

SPACE, LETTER, DIGIT, OTHER, UNUSUAL = range(5)
CLASS = np.full(256, UNUSUAL, np.uint8)
CLASS[0x21:0x7F] = OTHER
CLASS[[0x20, 0x09, 0x0A, 0x0D]] = SPACE
CLASS[[*range(48, 58)]] = DIGIT
CLASS[[*range(65, 91), *range(97, 123)]] = LETTER
CLASS[0x80:0xC0] = LETTER  # the second byte of a letter; any other character has an unusual first byte
CLASS[[0xC3, 0xC4, 0xC5]] = LETTER  # U+00C0 to U+017F
#: Pieces whose ids a worker keeps, about 150 bytes each.
MOST_KEPT = 350_000


def _byte_signs() -> dict[int, str]:
    """The sign by which a byte-level vocabulary writes each byte: itself if printable, else one above 255."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    signs = {b: chr(b) for b in plain}
    rest = (b for b in range(256) if b not in signs)
    return signs | {b: chr(256 + n) for n, b in enumerate(rest)}


def pieces(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions at which pieces begin, for texts without unusual characters."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    kind = CLASS[data]
    edge = np.zeros(n + 1, bool)  # a text begins here
    edge[offsets] = True
    start = edge[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    run = np.flatnonzero(start)
    run = run[(kind[run] != SPACE) & ~edge[run]]
    after_space = run[kind[run - 1] == SPACE]  # runs that follow white space in the same text
    start[after_space - 1] = True
    start[after_space[data[after_space - 1] == 0x20]] = False
    # 's 't 'm 'd 're 've 'll, where the apostrophe begins a piece
    sign = np.flatnonzero((data[:-1] == 0x27) & start[:-1] & (kind[1:] == LETTER) & ~edge[1:n])
    if len(sign):
        one, two = data[sign + 1], data[np.minimum(sign + 2, n - 1)]
        two = np.where((sign + 2 < n) & ~edge[np.minimum(sign + 2, n)], two, 0)
        long = (((one == 114) | (one == 118)) & (two == 101)) | ((one == 108) & (two == 108))
        short = np.isin(one, [115, 116, 109, 100])
        for at, length in ((sign[short], 2), (sign[long], 3)):
            start[at + 1] = False
            end = at + length
            start[end[end < n]] = True
    return np.flatnonzero(start)


class Tokenizer:
    """Ids of texts by a byte-level file of the ``tokenizers`` library; special strings are ordinary text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer as Library

        self.library = Library.from_file(path)
        self.library.encode_special_tokens = True
        self.signs = _byte_signs()
        self.clear()

    def clear(self) -> None:
        self.known: dict[int, int] = {}
        self.flat, self.begin = array("I"), array("q", [0])

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, np.uint32) for x in found]

    def _learn(self, key: int, piece: bytes) -> int:
        for token in self.library.model.tokenize(piece.decode("latin1").translate(self.signs)):
            self.flat.append(token.id)
        self.begin.append(len(self.flat))
        self.known[key] = len(self.begin) - 2
        return len(self.begin) - 2

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, n + 1 offsets into them) of the texts data[offsets[i]:offsets[i + 1]]."""
        n = len(offsets) - 1
        odd = np.concatenate([[0], np.cumsum(self._unusual(data))])
        odd = odd[offsets[1:]] > odd[offsets[:-1]]
        if odd.any():
            return self._mixed(data, offsets, odd)
        start = pieces(data, offsets)
        end = np.append(start[1:], len(data))
        keys = _hashes(data, start, end)
        unique, first, back = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.known) + len(unique) > MOST_KEPT:
            self.clear()
        raw, known = data.tobytes(), self.known
        places = [
            p if (p := known.get(k)) is not None else self._learn(k, raw[start[i] : end[i]])
            for k, i in zip(unique.tolist(), first.tolist(), strict=True)
        ]
        place = np.array(places, np.int64)
        flat, begin = np.array(self.flat, np.uint32), np.array(self.begin, np.int64)
        at, size = begin[place][back], (begin[place + 1] - begin[place])[back]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = flat[np.repeat(at - ends[:-1], size) + np.arange(ends[-1])]
        return ids, ends[np.searchsorted(start, offsets, "left")] if n else np.zeros(1, np.int64)

    @staticmethod
    def _unusual(data: np.ndarray) -> np.ndarray:
        odd = CLASS[data] == UNUSUAL
        odd[:-1] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))  # the signs U+00D7 and U+00F7
        return odd

    def _mixed(self, data: np.ndarray, offsets: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = np.diff(offsets)
        plain, at = self.encode(data[np.repeat(~odd, size)], np.concatenate([[0], np.cumsum(np.where(odd, 0, size))]))
        texts = [data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace") for i in np.flatnonzero(odd)]
        whole = iter(self.whole(texts))
        parts = [next(whole) if o else plain[at[i] : at[i + 1]] for i, o in enumerate(odd)]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


@functools.cache
def tokenizer(path: str) -> Tokenizer:
    """One tokenizer for each Python worker."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Tokenizer(path)
