"""Words of whole texts as 64-bit hashes, by array operations on UTF-8 bytes."""

from __future__ import annotations

import numpy as np

from .common import mixed

BLOCK = 1 << 21
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1

#: Space and \x09 to \x0D part words.
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True
#: A to Z become a to z; other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


#: Powers of the base and of its inverse, as many as the longest block so far asked for.
_POWERS = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            out = np.full(-(-n // 65536) * 65536, base, np.uint64)
            out[0] = 1
            _POWERS[i] = np.multiply.accumulate(out)
    return _POWERS


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run [start, end) of the bytes: a polynomial of them, mixed with the length."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    value = (sums[ends] - sums[starts]) * down[starts]
    return mixed(value ^ (ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def words(
    data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = BLANKS, fold: np.ndarray = LOWER
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, starts, ends, first): the words of all texts, in order.

    Words are runs of bytes that ``apart`` doesn't mark, folded by ``fold``; ``starts`` and
    ``ends`` are byte positions in ``data``; text i has the words first[i] to first[i + 1] - 1.
    Long inputs are cut at blanks into blocks, so memory doesn't follow a text's length.
    """
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    at, n = 0, len(data)
    while at < n:
        end = min(at + BLOCK, n)
        while end < n and not apart[data[end]]:  # on to the next blank, by growing windows
            window = apart[data[end : end + 4096]]
            end += int(window.argmax()) if window.any() else len(window)
        block = data[at:end]
        inner = offsets[(offsets > at) & (offsets < end)] - at
        is_word = ~apart[block]
        opens = is_word.copy()
        opens[1:] &= ~is_word[:-1]
        opens[inner] = is_word[inner]
        closes = is_word.copy()
        closes[:-1] &= ~is_word[1:]
        closes[inner - 1] = is_word[inner - 1]
        starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        found.append((_hashes(fold[block], starts, ends), starts + at, ends + at))
        at = end
    if not found:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64)
    hashes, starts, ends = (np.concatenate(x) for x in zip(*found, strict=True))
    return hashes, starts, ends, np.searchsorted(starts, offsets, "left")


def shingles(hashes: np.ndarray, first: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): shingles of ``width`` words per text, not yet distinct.

    A text with fewer words has one shingle, its whole sequence; a text without words has none.
    """
    count = np.diff(first)
    n = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    out_first = np.concatenate([[0], np.cumsum(n)])
    text = np.repeat(np.arange(len(n)), n)
    start = first[:-1][text] + (np.arange(len(text)) - out_first[:-1][text])
    length = np.minimum(count[text], width)
    out = length.astype(np.uint64)
    padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
    for k in range(width):
        with np.errstate(over="ignore"):
            value = out * np.uint64(0x9FB21C651E98DF25) + padded[start + k]
        out = np.where(k < length, mixed(value), out)
    return out, out_first


def distinct(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each text, in order, and where each text's begin."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((values, text))
    values, text = values[order], text[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    values, text = values[new], text[new]
    return values, np.searchsorted(text, np.arange(len(first)))
